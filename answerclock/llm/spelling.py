"""Spelling variants: words one code point apart, found by sorting permuterm rotations.

Every word is ended by a terminator and rotated to each of its places. A rotation without its
last character is a word with one character skipped, wherever in the word that one stood. So
the words that differ by a replaced character are those whose rotations share such a prefix,
and a word with a character less has that prefix as a whole rotation of its own. Each rotation
is therefore a row twice, as a prefix that skips a character and as a whole; the rows are
dealt by prefix, sorted, and scanned group by group.

A group has one row at most for each character that can stand in the skipped place and one for
the whole rotation: at most as many as the alphabet has letters, and one more. From a group
comes one row for each member, with the number of its neighbours there and the best of them,
so pairs are never spelled out. Deleting any character of a run like "ss" gives the same word;
only the run's first one counts there, so that no pair meets in two groups.

Words are counted with a combined aggregation; texts never move. Null texts have no words; a
null key is the empty string in the rule that damages runs; repeated rows count as often as
they stand there; an empty table has no words; other columns are ignored. Among equally
frequent neighbours the smallest in code-point order is the best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerclock.llm.cluster import map_arrow
from answerclock.llm.words import ascii_lower
from answerclock.operators.storage import stored

# Runs of letters, the share of runs that lose a letter, and the least word.
RUN = r"[A-Za-zÀ-ÿ]+"
DAMAGED = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
FORM_FACTOR = 2
TERMINATOR = "$"

NEAR = "word string, near long, best_n long, best string"


def damaged(key: Column, run: Column) -> Column:
    """``run`` without one code point if the checksum of key and run says so."""
    check = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run))
    place = (check % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(check % DAMAGED == 0, shorter).otherwise(run)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``LEAST_LENGTH`` with ``LEAST_COUNT`` occurrences."""
    lowered = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    runs = docs.select(
        F.col(key).alias("key"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"),
    )
    words = runs.filter(F.length("run") >= LEAST_LENGTH).select(
        damaged(F.col("key"), F.col("run")).alias("word")
    )
    words = words.filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, whole, first, word, n): every rotation as a whole and without its last letter.

    ``first`` tells that the skipped letter is the first of its run of equal letters.
    """
    marked = F.concat("word", F.lit(TERMINATOR))
    place = F.explode(F.sequence(F.lit(0), F.length("word"))).alias("place")
    at = F.col("place")
    rows = words.select("word", "n", marked.alias("marked"), place)
    before = F.substring("marked", F.lit(1), at)
    rest = F.length("marked")
    whole = F.concat(F.substring("marked", at + 1, rest), before)
    skipped = F.concat(F.substring("marked", at + 2, rest), before)
    letter = F.substring("marked", at + 1, F.lit(1))
    first = (at == 0) | (letter != F.substring("marked", at, F.lit(1)))
    kinds = F.array(
        F.struct(whole.alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first")),
        F.struct(skipped.alias("prefix"), F.lit(False).alias("whole"), first.alias("first")),
    )
    kinds = F.when(letter == TERMINATOR, F.slice(kinds, 1, 1)).otherwise(kinds)
    return rows.select("word", "n", F.explode(kinds).alias("kind")).select("kind.*", "word", "n")


def _scanned(table: pa.Table) -> pa.RecordBatch:
    """What the members of each group have there; rows come in order of prefix and quality."""
    n = table.num_rows
    prefix = table["prefix"].combine_chunks()
    new = np.ones(n, bool)
    new[1:] = pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    whole = table["whole"].to_numpy()
    first = table["first"].to_numpy()
    place = np.arange(n)

    def least(values: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(values, starts)[group]

    def total(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(np.int64), starts)[group]

    # Rows that come first are better, so the best of some rows is the least place.
    skipping = np.where(whole, n, place)
    best = least(skipping)
    second = least(np.where(place == best, n, skipping))
    own_whole = np.where(first, least(np.where(whole, place, n)), n)
    other = np.where(place == best, second, best)
    chosen = np.where(whole, least(np.where(first & ~whole, place, n)), np.minimum(other, own_whole))
    near = np.where(whole, total(first & ~whole), total(~whole) - 1 + (own_whole < n))
    kept = np.flatnonzero(near > 0)
    return pa.RecordBatch.from_arrays(
        [
            table["word"].combine_chunks().take(kept),
            pa.array(near[kept], pa.int64()),
            table["n"].combine_chunks().take(chosen[kept]),
            table["word"].combine_chunks().take(chosen[kept]),
        ],
        ["word", "near", "best_n", "best"],
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan whole groups; the last one of a batch waits for the next batch."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        if table.num_rows == 0:
            continue
        prefix = table["prefix"]
        # The rows are sorted, so those of the last group stand together at the end.
        last = int(pc.sum(pc.equal(prefix, prefix[-1])).as_py())
        whole, held = table.slice(0, table.num_rows - last), table.slice(table.num_rows - last)
        if whole.num_rows:
            yield _scanned(whole)
    if held is not None:
        yield _scanned(held)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of every word of ``words`` that is near another one."""
    ordered = (
        rotations(words)
        .repartition("prefix")
        .sortWithinPartitions("prefix", F.col("n").desc(), "word")
    )
    parts = map_arrow(ordered, _scan, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    found = parts.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("top"))
    return found.select("word", "n_near", "top.best", (-F.col("top.less")).alias("best_n"))


def roots(links: DataFrame, most: int) -> DataFrame:
    """(word, root): where the forms of (word, form) rows lead, by doubling the steps.

    A form is at least ``FORM_FACTOR`` times as frequent as its word, so from counts of
    ``LEAST_COUNT`` to ``most`` there are only so many steps.
    """
    steps = math.log(max(most, LEAST_COUNT) / LEAST_COUNT, FORM_FACTOR)
    found = stored(links.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(max(1.0, steps)))):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        joined = found.join(further, "root", "left")
        found = stored(joined.select("word", F.coalesce("_further", "root").alias("root")))
    return found


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = stored(word_counts(docs, key, text))
    joined = words.join(neighbours(words), "word", "left")
    good = F.col("best_n") >= FORM_FACTOR * F.col("n")
    judged = stored(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best")).alias("form"),
            F.when(good, F.col("best_n")).alias("form_n"),
        )
    )
    most = words.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    leads = roots(judged.filter("form IS NOT NULL"), most)
    return judged.join(leads, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
