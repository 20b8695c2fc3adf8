"""Pack tokenized documents into sequences by swap-based local search.

Texts become token ids in the scan; only (id, piece, start, length, checksum) of each
piece go on. Full pieces are sequences of their own. The others are dealt at random to
shards of bounded size; each shard is packed best fit first, then improved by moves and
swaps. The emptiest bins of all shards are opened again and their pieces packed anew
in far fewer shards, until one shard is left, so shards cost no sequences. After the first
round a shard opens bins with at most half of its pieces, so each round places the others.

Random shards hold alike mixes of lengths, whatever source or group of copies has most
rows. Each round is written to the shared scratch folder.

Defined cases: a null text is empty; an empty text is its end token alone; repeated
rows are packed each; null ids are kept; no rows give no rows.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.llm import bins
from bourselake.llm.common import bound_batches, part_count
from bourselake.session import staged

CAPACITY = 2048
END = 0
#: Pieces in a shard, about, and bins per shard whose pieces are packed again.
SHARD_PIECES, OPEN_BINS = 20_000, 64


class TextTokenizer:
    """Token ids of whole texts, as little-endian 32-bit bytes.

    ``ranks`` is the tokenizer's vocabulary as a rank file, whose reader gives the same
    ids three times as fast. A text with a string that the tokenizer itself takes for a
    special token is encoded by the tokenizer.
    """

    def __init__(self, path: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encoding.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


@functools.lru_cache(maxsize=1)
def text_tokenizer(path: str, ranks: str) -> TextTokenizer:
    """One tokenizer for all tasks of a Python process."""
    return TextTokenizer(path, ranks)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; of a long one only the first may be short."""
    first = length if length <= capacity else (length % capacity or capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(docs: DataFrame, path: str, ranks: str, capacity: int) -> DataFrame:
    """The pieces of every document, with the checksum of their ids."""
    end = np.array([END], dtype="<u4").tobytes()
    kind = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"

    @F.pandas_udf(kind)
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = text_tokenizer(path, ranks)
        for texts in batches:
            found = []
            for text in texts:
                ids = tokenizer(text or "") + end
                found.append(
                    [
                        (n, s, k, zlib.crc32(ids[4 * s : 4 * (s + k)]))
                        for n, (s, k) in enumerate(cut(len(ids) // 4, capacity))
                    ]
                )
            yield pd.Series(found, dtype=object)

    # Else the optimizer filters by the array before it unpacks it, and tokenizes twice.
    once = tokenize.asNondeterministic()
    own = docs.select(F.col("doc_id").cast("bigint"), once("text").alias("p"))
    return own.select("doc_id", F.inline("p"))


def pack_shards(items: DataFrame, shards: int, round_: int, capacity: int) -> DataFrame:
    """Each shard packed; with more than one, its emptiest bins are marked open."""

    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        sizes = shard["length"].to_numpy()
        packed = bins.pack(sizes, capacity)
        fills = np.array([int(sizes[own].sum()) for own in packed])
        reopened = set()
        if shards > 1:
            under = np.flatnonzero(fills < capacity)
            under = under[np.argsort(fills[under], kind="stable")][:OPEN_BINS]
            if round_:  # else few bins of many short pieces would all be opened for ever
                held = np.cumsum([len(packed[b]) for b in under])
                under = under[held <= len(sizes) // 2]
            reopened = set(under.tolist())
        number = np.empty(len(sizes), dtype=np.int64)
        offset = np.empty(len(sizes), dtype=np.int64)
        for bin_, own in enumerate(packed):
            number[own] = bin_
            offset[own] = np.cumsum(sizes[own]) - sizes[own]
        first = (round_ << 56) + (int(shard["shard"].iloc[0]) << 28)
        return shard.drop(columns="shard").assign(
            sequence_id=first + number,
            offset=offset,
            open=np.isin(number, list(reopened)),
        )

    schema = "row bigint, length bigint, sequence_id bigint, offset bigint, open boolean"
    dealt = items.select(
        "row", "length", F.pmod(F.xxhash64("row", F.lit(round_)), F.lit(shards)).alias("shard")
    )
    return dealt.groupBy("shard").applyInPandas(pack, schema)


def pack(
    spark: SparkSession, docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY
) -> DataFrame:
    """Every piece of every document with its sequence_id and offset."""
    bound_batches(spark)
    own = staged(
        spark,
        pieces(docs, path, ranks, capacity).withColumn("row", F.monotonically_increasing_id()),
        "pieces",
    )
    full = own.filter(F.col("length") == capacity).select(
        "row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    placed, items, round_ = full, own.filter(F.col("length") < capacity), 0
    while True:
        count = items.count()
        shards = part_count(spark, count, SHARD_PIECES) if round_ == 0 else count // SHARD_PIECES + 1
        tried = staged(spark, pack_shards(items, shards, round_, capacity), "packed")
        placed = placed.unionByName(
            tried.filter(~F.col("open")).select("row", "sequence_id", "offset")
        )
        if shards == 1:
            break
        items, round_ = tried.filter("open"), round_ + 1
    return own.join(placed, "row").drop("row")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return tuple(public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return pack(spark, docs, *tokenizer_paths())
