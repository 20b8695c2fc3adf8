"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base expressions find e-mail addresses, IP addresses, card and phone numbers; they are
the seeds. Words around a seed form its patterns: the two words before it, and the word
on either side. Other identifier-like strings are the candidates. Patterns and strings
are the two sides of a graph, and scores go to and fro: a pattern is worth the mean of its
strings for a kind, a string is worth its best pattern. A candidate that ends above a
threshold becomes a find of that kind, wherever it occurs.

Texts are read once, in the scan. The graph holds distinct (string, pattern) pairs, so
a text copied a million times adds what one copy does, and scores are summed per task
before they are shuffled.

Defined cases: a null text is empty: counts 0, spans an empty string, base_sha256 the
hash of the empty string; a failing match is dropped and its text not tried again within
that kind; finds never overlap base spans; rows with equal ids are kept apart. No rows
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bourselake.session import staged

KINDS = ("email", "ip", "card", "phone")
# The base expressions. A run is entered at its start only, or where the
# last match ended: elsewhere in it the outcome is the same, and long runs stay cheap.
# Possessive repeats match the same, as nothing follows them, without deep recursion.
_MAIL = "[A-Za-z0-9._%+-]"
EXPRESSIONS = {
    "email": rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TOKEN = "[A-Za-z0-9@._%+-]"
CANDIDATE = rf"(?<!{_TOKEN})(?=[A-Za-z._%+-]*+[0-9@]){_TOKEN}{{6,}}+"
#: Fewest digits of a candidate without an at sign.
CANDIDATE_DIGITS = 4
#: Characters looked at on either side of a string for its patterns.
CONTEXT = 40
#: Rounds of scoring; least distinct seeds of a pattern; least score of a find.
ROUNDS, SUPPORT, ACCEPT = 3, 5, 0.9

SPAN = "struct<kind:int,start:int,end:int,value:string>"


def found(text: Column, expression: str, kind: int) -> Column:
    """(kind, start, end, value) of all matches; code points, the end exclusive.

    Positions are the summed lengths of the pieces between the matches.
    """
    pieces = F.split(text, expression, -1)
    hits = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["hit"])
        span = F.struct(
            F.lit(kind).alias("kind"),
            begin.alias("start"),
            end.alias("end"),
            pair["hit"].alias("value"),
        )
        return F.struct(
            end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")
        )

    pairs = F.zip_with(
        F.slice(pieces, 1, F.size(hits)),
        hits,
        lambda p, h: F.struct(p.alias("piece"), h.alias("hit")),
    )
    return F.aggregate(pairs, start, step, lambda state: state["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, nines cast out; the sum ends in 0."""
    length = F.length(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(digit * 2 > 9, digit * 2 - 9).otherwise(digit * 2)
        return F.when((length - i) % 2 == 1, doubled).otherwise(digit)

    summed = F.aggregate(
        F.sequence(F.lit(1), F.greatest(length, F.lit(1))),
        F.lit(0),
        lambda acc, i: acc + F.coalesce(worth(i), F.lit(0)),
    )
    return summed % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & _passes_luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _valid_only(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda span: valid(kind, span["value"]))


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def base_spans(text: Column) -> Column:
    """The valid base matches, by kind and then start."""
    numeric = text.rlike("[0-9]")
    gates = {
        "email": F.contains(text, F.lit("@")),
        "ip": numeric,
        "card": numeric,
        "phone": F.contains(text, F.lit("+")),
    }
    return F.concat(
        *[
            F.when(
                gates[kind],
                _valid_only(found(text, EXPRESSIONS[kind], number), kind),
            ).otherwise(_none())
            for number, kind in enumerate(KINDS)
        ]
    )


def candidates(text: Column, base: Column) -> Column:
    """Identifier-like strings that touch no base span."""
    likely = text.rlike(f"[0-9]{{{CANDIDATE_DIGITS}}}|@|[0-9][A-Za-z._%+-]*[0-9]")
    strings = F.filter(
        found(text, CANDIDATE, -1),
        lambda s: (F.contains(s["value"], F.lit("@")) | (F.length(_digits(s["value"])) >= CANDIDATE_DIGITS))
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return F.when(likely, strings).otherwise(_none())


def patterns(text: Column, span: Column) -> Column:
    """The lexical patterns of one span: words before it, and words on both sides."""
    from_ = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.substring(text, from_ + 1, span["start"] - from_)
    after = F.substring(text, span["end"] + 1, F.lit(CONTEXT))
    apart = r"[^\p{L}\p{N}=:#]+"
    left = F.array_remove(F.split(F.lower(before), apart), "")
    right = F.array_remove(F.split(F.lower(after), apart), "")
    last = F.coalesce(F.try_element_at(left, F.lit(-1)), F.lit("^"))
    second = F.coalesce(F.try_element_at(left, F.lit(-2)), F.lit("^"))
    first = F.coalesce(F.try_element_at(right, F.lit(1)), F.lit("$"))
    return F.array(
        F.concat(second, F.lit(" "), last, F.lit(" _")),
        F.concat(last, F.lit(" _ "), first),
    )


def occurrences(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Base spans, and the patterns of every span and candidate, of each document."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    based = own.withColumn("base", base_spans(F.col("text")))
    both = based.withColumn("other", candidates(F.col("text"), F.col("base")))
    told = F.transform(
        F.concat("base", "other"),
        lambda s: F.struct(
            s["kind"].alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lower(s["value"]).alias("value"),
            patterns(F.col("text"), s).alias("patterns"),
        ),
    )
    seen = both.select("doc_id", "base", told.alias("told"))
    return staged(spark, seen.withColumn("row", F.monotonically_increasing_id()), "occurrences")


def accepted(spark: SparkSession, seen: DataFrame) -> DataFrame:
    """(value, kind) of the candidates that the graph scores high enough.

    A seed is worth 1 for its kind; a candidate starts at 0 for all. The mean of a
    pattern counts one worthless string more than it has, so that few strings
    prove little.
    """
    told = seen.select(F.explode("told").alias("t")).select("t.kind", "t.value", "t.patterns")
    edges = staged(
        spark,
        told.select("kind", "value", F.explode("patterns").alias("pattern")).distinct(),
        "edges",
    )
    sizes = edges.groupBy("pattern").agg(F.count_distinct("value").alias("strings"))
    seeds = edges.filter("kind >= 0")
    supported = (
        seeds.groupBy("pattern", "kind")
        .agg(F.count("*").alias("support"))
        .filter(F.col("support") >= SUPPORT)
        .join(sizes, "pattern")
        .select("pattern", "kind", "strings", "support")
    )
    # Only patterns with enough seeds can pass a score on.
    open_ = edges.filter("kind < 0").select("value", "pattern")
    model = staged(spark, supported, "patterns")
    graph = staged(spark, open_.join(model, "pattern"), "graph")
    scores = None
    for _ in range(ROUNDS):
        if scores is None:
            worth = model.select("pattern", "kind", (F.col("support") / (F.col("strings") + 1)).alias("worth"))
        else:
            added = (
                graph.select("value", "pattern", "kind")
                .join(scores, ["value", "kind"])
                .groupBy("pattern", "kind")
                .agg(F.sum("score").alias("added"))
            )
            total = F.col("support") + F.coalesce("added", F.lit(0.0))
            worth = model.join(added, ["pattern", "kind"], "left").select(
                "pattern", "kind", (total / (F.col("strings") + 1)).alias("worth")
            )
        scores = staged(
            spark,
            graph.select("value", "pattern", "kind")
            .join(worth, ["pattern", "kind"])
            .groupBy("value", "kind")
            .agg(F.max("worth").alias("score")),
            "scores",
        )
    best = scores.groupBy("value").agg(
        F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b")
    )
    return best.filter(F.col("b.score") >= ACCEPT).select("value", (-F.col("b.k")).alias("kind"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]),
        ),
        ",",
    )


def personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts and spans of every document, base finds first and learned ones added."""
    seen = occurrences(spark, docs)
    place = "struct<kind:int,start:int,end:int>"
    learned = (
        seen.select("row", F.explode(F.filter("told", lambda t: t["kind"] < 0)).alias("t"))
        .select("row", "t.start", "t.end", "t.value")
        .join(accepted(spark, seen), "value")
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("learned"))
    )
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = seen.select("row", "doc_id", base.alias("base")).join(learned, "row", "left")
    more = F.coalesce("learned", F.array().cast(f"array<{place}>"))
    counts = [_count("base", n).alias(f"n_{kind}") for n, kind in enumerate(KINDS)]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat(F.col("base"), more))).alias("spans"),
        F.size(more).cast("bigint").alias("n_learned"),
    )


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return personal_data(spark, docs)
