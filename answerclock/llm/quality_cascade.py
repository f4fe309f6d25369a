"""Quality rules as a short-circuit cascade.

Measures of a text are expressions inside its row. Each rule is a condition that rejects;
on a sample of about ``SAMPLE_ROWS`` documents its cost (seconds) and its share of
rejections are measured, and rules run in the order of rejections per second: the first
that rejects ends the work for that document (CASE evaluates no later branch). The order
changes the cost, never the verdict.

Null and empty texts measure 0 and fail the base rule. Three-word windows of one text are
compared by a 64-bit hash. Repeated rows are judged each on its own; an empty table gives
an empty result; only the named columns are read.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerclock.llm.words import word_array
from answerclock.operators.storage import stored

SAMPLE_ROWS = 1000
SAMPLE_SEED = 17

# Symbols, separators, and the limits of the rules.
SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
RULES: Mapping[str, str] = {
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 40 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
    "long_word": "exists(words, word -> length(word) > 200)",
    "shouting": r"2 * regexp_count(text, '\\p{Lu}') > word_chars",
}


def _without(text: str | Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _with_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with ``n_repeat_words``: words inside three-word windows that occur twice or more.

    Windows are hashed; only where some are equal are they sorted together with their places.
    Each step is a column of its own, so that it is worked out once.
    """
    words, placed, starts = F.col("words"), F.col("_placed"), F.col("_starts")
    every = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    hashes = F.slice(every, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    marked = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    some_equal = F.size(F.array_distinct("_hashes")) < F.size("_hashes")

    def same(entry: Column, place: Column) -> Column:
        return F.coalesce(entry["h"] == F.get(placed, place)["h"], F.lit(False))

    twins = F.filter(placed, lambda x, k: same(x, k - 1) | same(x, k + 1))
    covers = F.transform(
        starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3)))
    )
    total = F.aggregate(covers, F.lit(0), lambda held, n: held + n)
    return (
        rows.withColumn("_hashes", hashes)
        .withColumn("_placed", F.when(some_equal, F.sort_array(marked)))
        .withColumn("_starts", F.sort_array(F.transform(twins, lambda x: x["i"])))
        .withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))
        .drop("_hashes", "_placed", "_starts")
    )


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key with text, words and the measures of the text that the rules name."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    has_word = lambda line: _without(line, SEPARATORS) > 0
    counted = _with_repeats(rows.withColumn("words", word_array("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n", -1), has_word)
    )
    return counted.select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        _without("text", SEPARATORS).cast("long").alias("word_chars"),
        (F.length("text") - _without("text", SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _seconds(job) -> tuple[float, object]:
    start = time.perf_counter()
    result = job()
    return time.perf_counter() - start, result


def ordered_rules(docs: DataFrame, rules: Mapping[str, str] = RULES) -> list[str]:
    """Names of ``rules`` by falling rejections per second, measured on a sample of ``docs``."""
    rows = docs.count()
    if not rows:
        return list(rules)
    share = min(1.0, SAMPLE_ROWS / rows)
    sample = stored(docs.select("doc_id", "text").sample(share, SAMPLE_SEED))
    measured = stored(measures(sample))
    plain = lambda: measured.agg(F.count("text")).first()
    plain()
    idle = min(_seconds(plain)[0] for _ in range(2))
    value = {}
    for name, rule in rules.items():
        job = lambda rule=rule: measured.agg(F.count_if(F.expr(rule))).first()[0]
        runs = [_seconds(job) for _ in range(2)]
        cost = max(min(seconds for seconds, _ in runs) - idle, 1e-3)
        value[name] = runs[0][1] / cost
    return sorted(rules, key=lambda name: (-value[name], name))


def judged(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rules: Mapping[str, str] = RULES,
    order: list[str] | None = None,
) -> DataFrame:
    """(doc_id, the measures, base_failed, failed_rule, kept) of every row of ``docs``.

    ``failed_rule`` is the first rule of the cascade that rejects, or null.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    names = ordered_rules(rows, rules) if order is None else order
    found = measures(rows).withColumn("base_failed", base_failed())
    cascade = F.when(F.col("base_failed"), F.lit("base"))
    for name in names:
        cascade = cascade.when(F.expr(rules[name]), F.lit(name))
    return found.withColumn("failed_rule", cascade).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "failed_rule",
        F.col("failed_rule").isNull().alias("kept"),
    )
