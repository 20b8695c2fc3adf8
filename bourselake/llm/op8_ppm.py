"""Language model scores by prediction by partial matching, pretrained on the corpus.

The score of a byte depends on its gram alone, the bytes of its context and itself. So
documents are dealt into blocks of bounded size by hash; a block sends each distinct
gram and word once, with the count among its training documents. Counts are summed
over all blocks; the probability of every wanted gram is computed where the counts of its
contexts meet; and each block gets back the values of its own grams and words, with
which its documents are scored. Nothing the size of the vocabulary is broadcast or
collected: the model and the messages grow with the corpus and stay spread out. A word
that makes up much of the corpus is one row per block.

Contexts that end in the same two bytes meet in one group; the counts of the two
shortest context lengths, at most 65,536 grams, are sent to all.

Defined cases: a null text is empty, with the end as its one token and symbol; rows
with a null id count as training rows; without training rows each symbol is equally
likely and base_score is 0; rows with equal ids are scored each. No rows give no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.llm import ppm
from bourselake.llm.common import id_remainder, part_count, words_of
from bourselake.session import staged

ORDER = 3
#: Characters of text in a block, about.
BLOCK_CHARS = 8_000_000
#: Not a word: words have no space.
END = b" "


def _blocks(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out and the block of every document."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = part_count(spark, chars, BLOCK_CHARS)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        (id_remainder(7) == 2).alias("held_out"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
    )


def requests(docs: DataFrame, order: int) -> DataFrame:
    """(block, word, gram, n): distinct words and grams with their training counts."""

    def gather(table: pa.Table) -> pa.Table:
        words: dict[bool, Counter] = {False: Counter(), True: Counter()}
        codes: dict[bool, list] = {False: [], True: []}
        for text, held_out in zip(table["text"].to_pylist(), table["held_out"].to_pylist(), strict=True):
            words[held_out].update(words_of(text))
            words[held_out][END] += 1
            codes[held_out].append(ppm.grams(text.encode(), order))
        for word in words[True]:
            words[False].setdefault(word, 0)
        wanted, counts = _tallied(codes)
        names = [None] * len(wanted) + list(words[False])
        n_words = len(words[False])
        return pa.table(
            {
                "block": pa.array(np.full(len(names), table["block"][0].as_py(), dtype=np.int32)),
                "word": pa.array(names, pa.binary()),
                "gram": pa.array([*wanted.tolist(), *[None] * n_words], pa.int64()),
                "n": pa.array([*counts.tolist(), *words[False].values()], pa.int64()),
            }
        )

    schema = "block int, word binary, gram bigint, n bigint"
    return docs.groupBy("block").applyInArrow(gather, schema)


def _tallied(codes: dict[bool, list]) -> tuple[np.ndarray, np.ndarray]:
    """All distinct grams, with their counts in the training texts."""
    none = [np.empty(0, dtype=np.int64)]
    train = np.concatenate(codes[False] or none)
    both = np.unique(np.concatenate([train, *codes[True]]))
    seen, counts = np.unique(train, return_counts=True)
    out = np.zeros(len(both), dtype=np.int64)
    out[np.searchsorted(both, seen)] = counts
    return both, out


def gram_scores(spark: SparkSession, counts: DataFrame, order: int) -> DataFrame:
    """(gram, value): log10 probability of every wanted gram; ``counts`` has gram, n."""
    if not 2 <= order <= 6:
        raise ValueError("the order must lie between 2 and 6")
    short = F.col("gram").bitwiseAND(F.lit(0xFFFF)).alias("short")
    low = counts.filter("n > 0").groupBy(short).agg(F.sum("n").alias("n")).toPandas()
    # Pairs of bytes: at most 65,536 rows.
    pairs = spark.sparkContext.broadcast(
        (low["short"].to_numpy(dtype=np.int64), low["n"].to_numpy(dtype=np.int64))
    )

    def score(group: pd.DataFrame) -> pd.DataFrame:
        codes = group["gram"].to_numpy(dtype=np.int64)
        counted = group["n"].to_numpy(dtype=np.int64)
        seen = counted > 0
        high = ppm.levels(codes[seen], counted[seen], order, 2)
        trie = high + ppm.levels(*pairs.value, 1, 0)
        lengths = range(order, -1, -1)
        value = ppm.log_probabilities(codes, list(zip(lengths, trie, strict=True)))
        return pd.DataFrame({"gram": codes, "value": value})

    ends = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF)).alias("ends")
    return (
        counts.select("gram", "n", ends)
        .groupBy("ends")
        .applyInPandas(score, "gram bigint, value double")
    )


def word_scores(counts: DataFrame) -> tuple[DataFrame, int]:
    """(word, value, known) by smoothed frequency, and the number of training tokens."""
    totals = counts.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1))).first()
    tokens, kinds = int(totals[0] or 0), int(totals[1] or 0)
    value = F.log10((F.col("n") + 1) / F.lit(float(tokens + kinds + 1)))
    return counts.select("word", value.alias("value"), (F.col("n") > 0).alias("known")), tokens


def score_blocks(docs: DataFrame, replies: DataFrame, order: int, tokens: int) -> DataFrame:
    """Documents scored with the values that their block has received."""

    def score(own: pa.Table, values: pa.Table) -> pa.Table:
        is_word = values["gram"].is_null().to_numpy()
        value = values["value"].to_numpy()
        codes = values["gram"].filter(pa.array(~is_word)).to_numpy()
        by_code = np.argsort(codes)
        codes, code_value = codes[by_code], value[~is_word][by_code]
        words = values["word"].filter(pa.array(is_word)).to_pylist()
        known = values["known"].filter(pa.array(is_word)).to_numpy()
        worth = dict(zip(words, zip(value[is_word].tolist(), known.tolist(), strict=True), strict=True))
        rows = []
        for text in own["text"].to_pylist():
            found = ppm.grams(text.encode(), order)
            total = float(code_value[np.searchsorted(codes, found)].sum())
            each = [worth[w] for w in words_of(text)] + [worth[END]]
            rows.append((len(each), sum(k for _, k in each), sum(v for v, _ in each), total))
        n_tokens, n_known, base, scores = zip(*rows, strict=True)
        return pa.table(
            {
                "doc_id": own["doc_id"],
                "held_out": own["held_out"],
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array([tokens] * len(rows), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(scores, pa.float64()),
            }
        )

    return (
        docs.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(
            score,
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
            "train_tokens bigint, base_score double, score double",
        )
    )


def language_model(spark: SparkSession, docs: DataFrame, order: int = ORDER) -> DataFrame:
    own = _blocks(spark, docs)
    asked = staged(spark, requests(own, order), "requests")
    words = asked.filter("word is not null")
    grams = asked.filter("gram is not null")
    scores, tokens = word_scores(
        staged(spark, words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    )
    counted = staged(spark, grams.groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    none = F.lit(None)
    replies = (
        words.select("block", "word")
        .join(scores, "word")
        .select("block", "word", none.cast("bigint").alias("gram"), "value", "known")
        .unionByName(
            grams.select("block", "gram")
            .join(gram_scores(spark, counted, order), "gram")
            .select("block", none.cast("binary").alias("word"), "gram", "value", F.lit(True).alias("known"))
        )
    )
    return score_blocks(own, replies, order, tokens)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return language_model(spark, docs)
