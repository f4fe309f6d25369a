"""Sentences whose ends are told from abbreviations learned in the same texts.

A token that nearly always has a period is an abbreviation. How sure that is says the published
log-likelihood test for such pairs: the chance of the counts if the period followed tokens by
chance, against that if it followed this one in 99 of 100 cases, weighed down for long tokens
and for each time the token stands without a period, and up for periods inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerclock.functions.words import sentence_array
from answerclock.operators.lookups import join_lookup
from answerclock.operators.storage import stored

# Fixed values of the published test: chance of a period after an abbreviation, least score.
PERIOD_CHANCE = 0.99
LEAST_SCORE = 0.3
# White space, and signs that do not belong to a token.
SPACE = r"[ \t\r\n\f]+"
OPENING = r"^[\"'(\[{]+"
CLOSING = r"[,;:!?\"')\]}]+$"


def _bare(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, OPENING, ""), CLOSING, "")


def _is_word(token: Column) -> Column:
    return token.rlike(r"\p{L}")


def period_counts(df: DataFrame, text: str) -> DataFrame:
    """(token, with_period, without_period) of all lower-cased tokens that have a letter."""
    raw = F.explode(F.split(F.lower(F.col(text)), SPACE, -1)).alias("raw")
    tokens = df.select(raw).select(_bare(F.col("raw")).alias("t"))
    ended = F.endswith("t", F.lit("."))
    typed = tokens.select(
        F.when(ended, F.expr("left(t, length(t) - 1)")).otherwise(F.col("t")).alias("token"),
        ended.cast("long").alias("ended"),
    )
    return typed.filter(_is_word(F.col("token"))).groupBy("token").agg(
        F.sum("ended").alias("with_period"), F.sum(1 - F.col("ended")).alias("without_period")
    )


def period_scores(df: DataFrame, text: str) -> DataFrame:
    """(token, with_period, without_period, score) of every token that ever has a period.

    The score is 0 for tokens that have one no more often than others.
    """
    counts = stored(period_counts(df, text))
    k, rest = F.col("with_period").cast("double"), F.col("without_period").cast("double")
    totals = counts.agg(F.sum(k).alias("_periods"), F.sum(k + rest).alias("_tokens"))  # one row
    rows = counts.filter(F.col("with_period") > 0).join(F.broadcast(totals))
    chance = F.least(F.col("_periods") / F.col("_tokens"), F.lit(1 - 1e-9))
    by_chance = k * F.log(chance) + rest * F.log(1 - chance)
    by_habit = k * F.log(F.lit(PERIOD_CHANCE)) + rest * F.log(F.lit(1 - PERIOD_CHANCE))
    periods = F.length("token") - F.length(F.translate("token", ".", ""))
    size = (F.length("token") - periods).cast("double")
    score = (
        2 * (by_habit - by_chance) * F.exp(-size) * (periods + 1) * F.pow(size, -rest)
    )
    return rows.select("token", "with_period", "without_period", F.when(score > 0, score).otherwise(0.0).alias("score"))


def _last_token(piece: Column) -> Column:
    """The token that ends a piece of text, lower-cased; its period is still there."""
    return F.regexp_replace(F.regexp_extract(F.lower(piece), r"([^ \t\r\n\f]+)$", 1), OPENING, "")


def learned_sentences(
    df: DataFrame, key: str, text: str, least_score: float = LEAST_SCORE
) -> DataFrame:
    """(key, pos, sentence): text cut after ``.``, ``!`` or ``?`` and white space, but not always.

    Not after a learned abbreviation, a single letter, or digits that a small letter or digit
    follows. White space at a place where the text is not cut becomes one space. ``key`` is
    unique. Texts meet the abbreviations that they hold themselves, a list no longer than the
    text; the table of all abbreviations is broadcast under a checked size and else joined.
    """
    known = period_scores(df, text).filter(F.col("score") >= least_score)
    known = known.select(F.concat("token", F.lit(".")).alias("last"), "with_period")
    docs = df.select(key, sentence_array(text).alias("pieces"))
    lasts = F.array_distinct(F.transform("pieces", _last_token))
    held = docs.select(key, F.explode(lasts).alias("last"))
    held = join_lookup(held, known, "last", "with_period", "left_semi")
    held = held.groupBy(key).agg(F.collect_set("last").alias("_known"))
    joined = docs.join(held, key, "left")
    pieces = F.col("pieces")
    nothing = F.array().cast("array<string>")
    rows = joined.select(
        key,
        "pieces",
        F.coalesce("_known", nothing).alias("_known"),
        F.transform(pieces, _last_token).alias("_lasts"),
    )

    def begins(i: Column) -> Column:
        last = F.get("_lasts", i - 1)
        number = last.rlike(r"^[0-9]+\.$") & F.get(pieces, i).rlike(r"^[\p{Ll}0-9]")
        goes_on = F.array_contains("_known", last) | last.rlike(r"^\p{L}\.$") | number
        return (i == 0) | ~goes_on

    places = F.sequence(F.lit(0), F.size(pieces) - 1)
    rows = rows.filter(pieces.isNotNull()).withColumn("_starts", F.filter(places, begins))
    starts = F.col("_starts")
    ends = F.array_append(F.slice(starts, 2, F.size(starts)), F.size(pieces))
    whole = F.zip_with(starts, ends, lambda a, b: F.array_join(F.slice(pieces, a + 1, b - a), " "))
    return rows.select(key, F.posexplode(whole).alias("pos", "sentence"))
