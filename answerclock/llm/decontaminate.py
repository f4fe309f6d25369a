"""Benchmark decontamination by a prefix-filtered join of item windows with documents.

A window is ``WINDOW_WORDS`` consecutive words of an item (all of them in a shorter item).
Its necessary prefix token is its rarest pair of neighbouring words (a single word in a
one-word item) by their count over all documents: a document that holds the window holds
that pair, at the pair's offset. So

1. pairs of all documents that are in any item are counted (order by rarity);
2. every pair of a document is looked up among the prefix tokens;
3. the offset gives the only place where the window can lie; it must begin at word 0 or
   later and end within the document (position and length bounds);
4. there all its words are compared (exact containment).

Documents stay whole in their row: a hit carries the numbers of the windows found, never a
pair per item and document before the check. The prefix tokens are dealt into parts of at
most ``PART_BYTES``; each part is broadcast in its own pass, so a benchmark of any size
keeps that bound (one pass for all usual ones).

Null texts have no words; null, empty and wordless items have no window. Repeated rows are
judged each on its own, and so are equal keys. Items with equal ids count as one. Only the
named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerclock.llm.cluster import unused
from answerclock.llm.words import ascii_lower
from answerclock.operators.storage import stored

# Fixed value: after lowering A to Z, a word is a run of anything but these.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
PART_BYTES = 32 * 1024 * 1024


def lowered_words(text: str) -> Column:
    """The words of a text; null and wordless texts have none."""
    plain = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return F.array_remove(F.split(plain, GAPS, -1), "")


def _pairs(words: Column) -> Column:
    """Neighbouring words joined by a space, the last word alone at the end."""
    return F.transform(
        words,
        lambda word, i: F.concat_ws(" ", word, F.get(words, i + 1)),
    )


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(words, item_ids): every distinct window with the items it is in."""
    rows = items.select(F.col(key).cast("string").alias("item"), lowered_words(text).alias("all"))
    last = F.greatest(F.size("all") - WINDOW_WORDS, F.lit(0))
    starts = F.explode(F.sequence(F.lit(0), last))
    placed = rows.filter(F.size("all") > 0).select("item", "all", starts.alias("at"))
    window = F.slice("all", F.col("at") + 1, F.lit(WINDOW_WORDS))
    return placed.select("item", window.alias("words")).groupBy("words").agg(
        F.collect_set("item").alias("item_ids")
    )


def _document_pairs(docs: DataFrame) -> DataFrame:
    """``docs`` (row, words) with one row for each (at, token): two words from ``at`` on.

    The last word stands alone there, as the only token of a one-word document.
    """
    placed = docs.select("*", F.posexplode_outer("words").alias("at", "word"))
    following = F.get("words", F.col("at") + 1)
    return placed.withColumn("token", F.concat_ws(" ", "word", following))


def prefix_tokens(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """(token, windows): for each prefix token its windows as (number, offset, words).

    A one-word window has no choice, so its word is not counted.
    """
    single = F.size("words") == 1
    pairs = F.when(single, F.col("words")).otherwise(
        F.slice(_pairs(F.col("words")), F.lit(1), F.size("words") - 1)
    )
    offsets = windows.select("window", "words", F.posexplode(pairs).alias("offset", "token"))
    known = stored(offsets.select("token").distinct())
    counts = _each_part(known, lambda part: _counted(docs, part))
    ranked = offsets.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = ranked.groupBy("window", "words").agg(
        F.min(F.struct("n", "token", "offset")).alias("first")
    )
    entry = F.struct("window", "first.offset", "words").alias("entry")
    return rarest.select("first.token", entry).groupBy("token").agg(
        F.collect_list("entry").alias("windows")
    )


def _counted(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    found = _document_pairs(docs).select("token").join(F.broadcast(tokens), "token")
    return found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def _parts(rows: DataFrame, bytes_of_row: Column) -> list[DataFrame]:
    """``rows``, dealt by hash into tables of at most about ``PART_BYTES``."""
    size = rows.agg(F.coalesce(F.sum(bytes_of_row.cast("long")), F.lit(0))).first()[0]
    n = max(1, -(-2 * size // PART_BYTES)) if size > PART_BYTES else 1
    place = F.pmod(F.xxhash64(F.col("token")), F.lit(n))
    return [rows] if n == 1 else [rows.filter(place == i) for i in range(n)]


def _each_part(tokens: DataFrame, job) -> DataFrame:
    results = [job(part) for part in _parts(tokens, F.octet_length("token") + 16)]
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


def _hits(docs: DataFrame, part: DataFrame, single: bool) -> DataFrame:
    """(row, n_words, hits) of documents; hits are (start, length, window) that were verified.

    Every document appears at least once, with no hits where there are none.
    """
    placed = _document_pairs(docs)
    if single:
        placed = placed.withColumn("token", F.col("word"))
    joined = placed.join(F.broadcast(part), "token", "left")
    here = joined.filter(F.col("windows").isNotNull() | (F.coalesce("at", F.lit(0)) == 0))
    candidates = F.transform(
        "windows",
        lambda w: F.struct(
            (F.col("at") - w["offset"]).alias("start"),
            F.size(w["words"]).alias("length"),
            w["window"].alias("window"),
            w["words"].alias("words"),
        ),
    )
    verified = F.filter(
        candidates,
        lambda c: (c["start"] >= 0)
        & (c["start"] + c["length"] <= F.size("words"))
        & (F.slice("words", c["start"] + 1, c["length"]) == c["words"]),
    )
    plain = F.transform(
        verified, lambda c: F.struct(c["start"], c["length"], c["window"])
    )
    return here.select("row", "doc_id", F.size("words").alias("n_words"), plain.alias("hits"))


def hit_words(hits: Column) -> Column:
    """Number of words inside any of the sorted (start, length, window) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        hits,
        start,
        lambda held, hit: F.struct(
            (
                held["n"]
                + F.greatest(
                    F.lit(0), hit["start"] + hit["length"] - F.greatest(held["upto"], hit["start"])
                )
            ).alias("n"),
            F.greatest(held["upto"], hit["start"] + hit["length"]).alias("upto"),
        ),
        lambda held: held["n"],
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, spans) of every row of ``docs``.

    ``item_ids`` are the sorted items with windows in the document, ``spans`` the
    (start, length, window) found.
    """
    rows = docs.select(F.col(key).alias("doc_id"), lowered_words(text).alias("words"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    windows = stored(
        item_windows(items, item_key, item_text).withColumn(
            "window", F.monotonically_increasing_id()
        )
    )
    tokens = stored(prefix_tokens(windows, rows))
    alone = F.size(F.col("windows")[0]["words"]) == 1
    size = F.octet_length("token") + 16 + F.size("windows") * (24 + 32 * WINDOW_WORDS)
    passes = [(part, False) for part in _parts(tokens.filter(~alone), size)]
    if not tokens.filter(alone).isEmpty():
        passes += [(part, True) for part in _parts(tokens.filter(alone), size)]
    if len(passes) > 1:
        rows = stored(rows)  # every pass must see the same row numbers
    found = _hits(rows, *passes[0])
    for part, single in passes[1:]:
        found = found.unionByName(_hits(rows, part, single))
    grouped = found.groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"),
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("spans"),
    )
    spans = grouped.withColumn("n_hit", hit_words(F.col("spans")))
    hit_rows = spans.filter("n_hit > 0").select("row", F.explode("spans.window").alias("window"))
    named = hit_rows.distinct().join(windows.select("window", "item_ids"), "window")
    of_row = named.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids")
    )
    none = F.array().cast("array<string>")
    return spans.join(of_row, "row", "left").select(
        "doc_id", "n_words", "n_hit", F.coalesce("item_ids", none).alias("item_ids"), "spans"
    )


def digest(found: DataFrame) -> DataFrame:
    """The counts and the hash of the item ids instead of the items and spans."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of an item."""
    mark = unused(docs, "_item_mark")
    marked = docs.withColumn(mark, F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text")))
    found = contamination(marked, items, mark, text)
    hit = found.filter("n_hit > 0").select(F.col("doc_id").alias(mark)).distinct()
    return marked.join(hit, mark, "left_anti").select(*docs.columns)
