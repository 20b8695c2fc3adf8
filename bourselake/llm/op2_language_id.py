"""Language by compression: the language whose dictionary shortens a text the most.

Each language gets a Zstandard dictionary of raw content: pieces of training texts.
A text is compressed with every dictionary, block by block so that a long text is
measured against the dictionary and not against itself, and the language with the
smallest total wins. If the runner-up is nearly as small, the text is rejected.

Only the dictionaries are fitted on a sample, bounded by ``pieces`` per language;
every document is scored whole. The dictionaries, ``pieces * piece_bytes`` each, travel
with the task.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and is
rejected; so is every text if no document has a language to learn from. A tie goes
to the language with more training documents, then to the first by name. A null lang
trains nothing; rows with a null id count as training rows. No rows give no rows.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourselake.llm.common import bound_batches, id_remainder, packed

UNKNOWN = "und"
#: Training pieces per language, and the bytes taken from the middle of each text.
PIECES, PIECE_BYTES = 128, 1024
#: Text compressed at a time; small against the dictionary.
BLOCK_BYTES = 1 << 13
#: A lead below this share of the runner-up's size is too narrow to decide.
NARROW = 0.003
NOT_LETTERS = re.compile(r"[\W\d_]+")


def _number_signs(first: int, last: int) -> re.Pattern:
    """Signs such as ½, ² and Ⅳ: word characters to a pattern, but no letters."""
    signs = [
        sign
        for sign in map(chr, range(first, last + 1))
        if sign.isnumeric() and not sign.isalpha() and not sign.isdecimal()
    ]
    return re.compile(f"[{''.join(signs)}]")


# Apart, because a pattern of signs from both planes is ten times as slow.
NUMBER_SIGNS, RARE_NUMBER_SIGNS = _number_signs(0, 0xFFFF), _number_signs(0x10000, sys.maxunicode)
RARE = re.compile("[\U00010000-\U0010ffff]")


def letters_only(text: str | None) -> bytes:
    """Lower-case letters with single spaces between the runs; empty without letters."""
    plain = (text or "").lower()
    if not plain.isascii():
        plain = NUMBER_SIGNS.sub(" ", plain)
        if RARE.search(plain):
            plain = RARE_NUMBER_SIGNS.sub(" ", plain)
    return NOT_LETTERS.sub(" ", plain).strip().encode()


def training_pieces(docs: DataFrame, pieces: int = PIECES) -> DataFrame:
    """(lang, place, text) of up to ``pieces`` training documents per language.

    The choice is by hash of the id; ids are ranked first, so texts are read for the
    chosen ones only and a language with most of the rows sorts ids, not texts.
    """
    usable = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (id_remainder(3) != 1)
    ).select("doc_id", "lang", "text")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        usable.select("doc_id", "lang")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= pieces)
    )
    return usable.join(F.broadcast(chosen), ["doc_id", "lang"])


def fit(
    docs: DataFrame, pieces: int = PIECES, piece_bytes: int = PIECE_BYTES
) -> dict[str, bytes]:
    """Dictionary content by language, languages with more training rows first."""
    sizes = docs.filter(F.col("lang").isNotNull() & (id_remainder(3) != 1)).groupBy("lang")
    ranked = sorted(sizes.count().collect(), key=lambda r: (-r["count"], r["lang"]))
    # At most ``pieces`` rows per language, each cut where it is read.
    middle = F.greatest(F.lit(1), (F.length("text") / 2).cast("int") - piece_bytes // 2)
    rows = (
        training_pieces(docs, pieces)
        .select("lang", "place", F.substring("text", middle, piece_bytes).alias("piece"))
        .collect()
    )
    content = {r["lang"]: b"" for r in ranked}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"], r["piece"])):
        content[row["lang"]] += letters_only(row["piece"])[:piece_bytes] + b" "
    # Zstandard takes dictionaries of eight bytes and more.
    return {lang: own[: pieces * piece_bytes] for lang, own in content.items() if len(own) >= 8}


class Classifier:
    """Compressed sizes of a text under each language's dictionary."""

    def __init__(self, content: dict[str, bytes]):
        settings = zstandard.ZstdCompressionParameters.from_level(
            3,
            min_match=3,
            strategy=zstandard.STRATEGY_BTOPT,
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
        )
        raw = zstandard.DICT_TYPE_RAWCONTENT
        self.compressors = [
            (
                lang,
                zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(own, dict_type=raw),
                    compression_params=settings,
                ),
            )
            for lang, own in content.items()
        ]

    def sizes(self, text: str | None) -> list[tuple[int, str]]:
        plain = letters_only(text)
        blocks = [plain[i : i + BLOCK_BYTES] for i in range(0, len(plain), BLOCK_BYTES)]
        return [(sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the lead is too narrow."""
        found = self.sizes(text)
        if not found or not any(size for size, _ in found):
            return UNKNOWN, 0.0, True
        # A stable sort keeps the order of the dictionaries on a tie.
        found.sort(key=lambda pair: pair[0])
        best, lang = found[0]
        if len(found) == 1:
            return lang, 1.0, False
        lead = (found[1][0] - best) / found[1][0]
        return lang, lead / (lead + 0.01), lead < NARROW


def prediction(content: dict[str, bytes]):
    """A column function: text to (lang_pred, score, rejected)."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Classifier(content)
        for texts in batches:
            found = [model.predict(text) for text in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    return classify


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    bound_batches(spark)
    own = docs.select(
        "doc_id",
        (id_remainder(3) == 1).alias("held_out"),
        prediction(fit(docs))("text").alias("found"),
    )
    return own.select("doc_id", "held_out", "found.*")


def recognised(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents whose language is decided."""
    bound_batches(spark)
    found = packed(docs, "text").withColumn("_found", prediction(fit(docs))("text"))
    return found.filter(~F.col("_found.rejected")).select("_row.*")
