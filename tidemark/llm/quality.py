"""Quality rules as a short-circuit cascade, in SQL functions only.

Every document gets its base measures. The further rules are then asked one after
the other, and a document leaves at the first that rejects it. Their order comes
from a sample: the time a rule takes and the share it rejects are measured, and
rules with more rejections per second go first. The order decides only how much
work is done, never the verdict: a document is kept if no rule rejects it.

All work is within a row; nothing is shuffled and no UDF is used. A null text has
no words (and so fails the base rule); repeated rows give repeated results.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# What a word and a symbol are, and the base limits.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SAMPLE_ROWS = 500  # bound of the sample that the rules are timed on

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """``rejects(text)`` is true for a document to drop; it may use the measures as columns."""

    name: str
    rejects: Callable[[Column], Column]


def count_of(text: Column, chars: str | tuple[str, ...]) -> Column:
    """How often the given one-byte characters occur."""
    total = F.lit(0)
    for c in chars:
        total = total + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c)))
    return total


def per_cent(part: Column, whole: Column, limit: int) -> Column:
    return part * 100 > whole * limit


# Limits in common use for web text. They are wide, so that prose in any language passes.
RULES = (
    Rule("symbols", lambda t: per_cent(F.col("n_symbols"), F.col("n_words"), 10)),
    Rule("repeated_lines", lambda t: F.col("n_dup_lines") * 100 > F.greatest(F.lit(1), count_of(t, ("\n",)) + 1) * 30),
    Rule("word_length", lambda t: (F.col("word_chars") < F.col("n_words") * 2) | (F.col("word_chars") > F.col("n_words") * 15)),
    Rule("few_letters", lambda t: F.regexp_count(t, F.lit(r"[\p{L}\p{M}]")) * 100 < F.col("word_chars") * 60),
    Rule("capitals", lambda t: F.regexp_count(t, F.lit(r"\p{Lu}")) * 100 > F.col("word_chars") * 40),
    Rule("bullets", lambda t: per_cent(F.regexp_count(t, F.lit(r"(?m)^[ \t]*[-*•●·]")), F.regexp_count(t, F.lit(r"(?m)^.*\S")), 90)),
    Rule("ellipses", lambda t: per_cent(F.regexp_count(t, F.lit(r"(?m)(?:…|\.\.\.)[ \t]*$")), F.regexp_count(t, F.lit(r"(?m)^.*\S")), 30)),
    Rule("code", lambda t: count_of(t, "{};") * 100 > F.col("word_chars") * 5),
)


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base measures and ``base_failed`` added.

    A clashing column of ``docs`` is replaced. A word run of 8 is compared by its
    64-bit hash, inside one document only.
    """
    own = [c for c in docs.columns if c not in (*MEASURES, "base_failed")]
    text = F.coalesce(F.col("__text"), F.lit(""))
    # Each select makes the next one's input a plain column, so nothing is computed twice.
    df = docs.select(*own, F.col(text_col).alias("__text"))
    df = df.withColumns({"__text": text}).withColumns(
        {"__words": F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)), "__lines": F.filter(F.split("__text", "\n"), lambda x: x.rlike(WORD))}
    )
    # Single elements are read in place; slice() would copy the whole array for every window.
    run_hash = lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(WINDOW)])
    windows = F.transform(F.sequence(F.lit(0), F.size("__words") - WINDOW), run_hash)
    df = df.select(
        *own,
        "__text",
        F.size("__words").cast("long").alias("n_words"),
        (F.char_length("__text") - count_of(F.col("__text"), SEPARATORS)).cast("long").alias("word_chars"),
        count_of(F.col("__text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("__words") > WINDOW, windows).alias("__runs"),
    )
    # Most documents repeat no run; only the others sort theirs.
    repeats = F.size(F.array_distinct("__runs")) < F.size("__runs")
    placed = F.transform("__runs", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("__sorted", F.when(repeats, F.sort_array(placed))).drop("__runs")
    s = F.col("__sorted")
    twin = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
    places = F.sort_array(F.transform(F.filter(s, lambda x, j: F.coalesce(twin(x, j), F.lit(False))), lambda x: x["i"]))
    df = df.withColumn("__places", F.when(s.isNotNull(), places)).drop("__sorted")
    covered = F.aggregate(
        "__places",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__places")
    # A filter on a measure must not be pushed below and computed again inside the lambdas: it stops at inline().
    df = df.select(*own, "__text", F.inline(F.array(F.struct(*MEASURES))))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return df.withColumn("base_failed", failed)


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules, by rejections per second on a sample of at most ``sample_rows`` documents.

    Only documents that pass the base rule are of interest: the cascade sees no others.
    An empty sample leaves the order as given.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "quality-sample")
    # limit() before anything else stops each task after its first rows.
    measured(docs.select(text_col).limit(sample_rows), text_col).where("not base_failed").coalesce(1).write.parquet(folder)
    sample = spark.read.parquet(folder)
    text = F.col("__text")

    def run(condition: Column) -> tuple[int, int, float]:
        began = time.perf_counter()
        row = sample.agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("out")).first()
        return row["n"], row["out"], time.perf_counter() - began

    rows, _, _ = run(F.lit(False))  # the first job also opens the files
    if not rows:
        return list(rules)
    base = run(F.octet_length(text) < 0)[2]
    worth = {}
    for rule in rules:
        _, out, took = run(F.coalesce(rule.rejects(text), F.lit(False)))
        worth[rule.name] = out / rows / max(took - base, 1e-3)
    return sorted(rules, key=lambda r: (-worth[r.name], r.name))


def judged(docs: DataFrame, rules: list[Rule] | tuple[Rule, ...] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with the base measures, ``base_failed`` and ``kept``.

    Without ``rules`` the standard ones are ordered on a sample first. CASE stops
    at the first true branch, which is what makes the cascade short-circuit.
    """
    ordered = order_rules(docs, text_col=text_col) if rules is None else rules
    df = measured(docs.drop("kept"), text_col)
    verdict = F.when(F.col("base_failed"), False)
    for rule in ordered:
        verdict = verdict.when(F.coalesce(rule.rejects(F.col("__text")), F.lit(False)), False)
    return df.withColumn("kept", verdict.otherwise(True)).drop("__text")


def accepted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that no rule rejects, with their columns as they were."""
    helper = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text_col).alias("__body"))
    return judged(helper, order_rules(docs, text_col=text_col), "__body").where("kept").select("__row.*")
