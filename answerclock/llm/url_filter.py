"""URL filter: rules for hosts and paths, and naive Bayes over segmented names for the rest.

Rules name a domain and the start of a path; the longest one that fits decides. Every other
URL gets the verdict of a multinomial naive Bayes over tokens:

1. The labels of a host (without its last one and ``www``) are cut at anything but letters,
   and each piece is split into words by unigram Viterbi. The unigram counts are those of the
   words of all pages, counted only for words that are part of some piece. The words in
   ``SEEDS`` count ``SEED_COUNT`` more. A word has at most ``MAX_WORD`` letters.
2. Path tokens are its runs of letters, and the number of digits of its numbers.
3. Labels come from two places: a URL that fits a rule has the rule's verdict, any other one
   whose host holds a seed word is ``block``; the rest teaches nothing. What made the label is
   taken away first (the seeds of a seed's URL), so the tokens around it are learned. A seed
   itself counts as ``SEED_PAGES`` blocked pages, a belief that the labels can outweigh.
4. A fifth of the labelled URLs, chosen by their checksum, is held out of the training;
   ``held_out_accuracy`` compares the method and the bare list of seeds with their labels.

Pieces are segmented once each, however many pages share a host; a piece meets only its own
parts, so nothing that grows with the pages is broadcast unmeasured. Null URLs and URLs
without ``://`` have an empty host and path and no rule, and get the prior verdict. Repeated
rows are judged each on its own. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerclock.llm.cluster import map_arrow
from answerclock.llm.words import ascii_lower
from answerclock.operators.lookups import join_lookup
from answerclock.operators.storage import stored

# The rules of the registered query, and words of hosts to be blocked.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
SEEDS = (
    "ad ads adult advert advertising bet bets betting bonus casino cheap click clicks dating "
    "escort gambling jackpot lottery malware phish phishing pills poker popup porn promo sex "
    "slots spam track tracker tracking viagra warez xxx"
).split()
SEED_COUNT = 1000
SEED_PAGES = 20
FOLDS = 5  # every fifth labelled URL is held out
MAX_WORD = 20
SMOOTHING = 1.0
DIGITS = 9

LETTERS = r"[a-z]+"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host in lower case (A to Z) and path of a URL; both empty without ``://``."""
    mark = F.instr(F.col(url), "://")
    rest = F.when(mark > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(rule, domain, start, verdict) from (rule, verdict)."""
    rows = [(rule, *_cut(rule), verdict) for rule, verdict in rules]
    return spark.createDataFrame(rows, "rule string, domain string, start string, verdict string")


def _cut(rule: str) -> tuple[str, str]:
    domain, slash, path = rule.partition("/")
    return domain, slash + path


def fitting_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, rule, rule_verdict): the longest rule that fits each of ``pages`` (row, host, path).

    A host meets the rules of its own domains by equality, and of those only the ones whose
    start is one of its path's starts, so a domain with very many rules costs no more.
    """
    lengths = rules.groupBy("domain").agg(F.collect_set(F.length("start")).alias("lengths"))
    parts = F.split("host", r"\.", -1)
    domains = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )
    placed = pages.select("row", "path", F.explode(domains).alias("domain")).join(lengths, "domain")
    starts = placed.withColumn("length", F.explode("lengths")).filter(
        F.length("path") >= F.col("length")
    )
    keyed = starts.select("row", "domain", F.expr("substring(path, 1, length)").alias("start"))
    found = keyed.join(rules, ["domain", "start"])
    longest = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    return found.groupBy("row").agg(longest).select(
        "row", "best.rule", F.col("best.verdict").alias("rule_verdict")
    )


def host_pieces(host: str) -> Column:
    """Runs of letters of a host's labels, without the last label and ``www``."""
    labels = F.split(host, r"\.", -1)
    inner = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0)))
    named = F.array_join(F.array_remove(inner, "www"), " ")
    return F.regexp_extract_all(named, F.lit(LETTERS), F.lit(0))


def path_tokens(path: str) -> Column:
    """Runs of letters of a path in lower case, and ``#n`` for a number of n digits."""
    runs = F.regexp_extract_all(ascii_lower(path), F.lit(r"[a-z]+|[0-9]+"), F.lit(0))
    return F.transform(
        runs,
        lambda run: F.when(
            run.rlike("^[0-9]"), F.concat(F.lit("#"), F.length(run).cast("string"))
        ).otherwise(run),
    )


def unigrams(pages: DataFrame, parts: DataFrame, html: str = "html") -> DataFrame:
    """(word, n): how often each word of ``parts`` occurs in all pages, seeds counted up."""
    spark = pages.sparkSession
    words = F.regexp_extract_all(ascii_lower(F.coalesce(html, F.lit(""))), F.lit(LETTERS), F.lit(0))
    rows = pages.select(F.explode(words).alias("word")).filter(F.length("word") <= MAX_WORD)
    # Counted first: what meets the parts is one row per word, not one per occurrence.
    every = rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = every.join(parts.select("word").distinct(), "word")
    seeds = spark.createDataFrame([(w,) for w in SEEDS], "word string")
    extra = seeds.select("word", F.lit(SEED_COUNT).cast("long").alias("n"))
    return counts.unionByName(extra).groupBy("word").agg(F.sum("n").alias("n"))


def best_split(piece: str, counts: dict[str, int], total: int) -> list[str]:
    """The split of ``piece`` into words with the largest product of unigram shares.

    A word that was never seen counts 1 / (total * 10 ** its length); the longer last word
    wins a tie.
    """
    best = [(0.0, 0)]
    for end in range(1, len(piece) + 1):
        found = []
        for start in range(max(0, end - MAX_WORD), end):
            word = piece[start:end]
            n = counts.get(word)
            share = math.log(n / total) if n else -math.log(total) - len(word) * math.log(10)
            found.append((best[start][0] + share, -start))
        score, start = max(found)
        best.append((score, -start))
    words, end = [], len(piece)
    while end:
        start = best[end][1]
        words.append(piece[start:end])
        end = start
    return words[::-1]


def segmented(pieces: DataFrame, counts: DataFrame, parts: DataFrame) -> DataFrame:
    """(piece, words) of every distinct piece."""
    total = max(1, counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    known = parts.join(counts, "word").groupBy("piece").agg(
        F.collect_list(F.struct("word", "n")).alias("known")
    )

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            words = [
                best_split(name, {x["word"]: x["n"] for x in own or []}, total)
                for name, own in zip(names, batch.column(1).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.list_(pa.string()))], ["piece", "words"]
            )

    rows = pieces.join(known, "piece", "left").select("piece", "known")
    return map_arrow(rows, kernel, "piece string, words array<string>")


def host_tokens(hosts: DataFrame, pages: DataFrame, html: str = "html") -> DataFrame:
    """(host, tokens) of every distinct host: the words of its pieces, marked ``host:``."""
    cut = stored(hosts.select("host", F.explode(host_pieces("host")).alias("piece")))
    pieces = cut.select("piece").distinct()
    ends = F.explode(F.sequence(F.lit(1), F.least(F.length("piece") - F.col("at"), F.lit(MAX_WORD))))
    starts = F.explode(F.sequence(F.lit(0), F.length("piece") - 1))
    placed = pieces.select("piece", starts.alias("at")).select("piece", "at", ends.alias("n"))
    parts = stored(
        placed.select("piece", F.expr("substring(piece, at + 1, n)").alias("word")).distinct()
    )
    counts = stored(unigrams(pages, parts, html))
    split = segmented(pieces, counts, parts)
    words = cut.join(split, "piece").groupBy("host").agg(
        F.flatten(F.collect_list("words")).alias("words")
    )
    marked = F.transform("words", lambda w: F.concat(F.lit("host:"), w))
    return words.select("host", marked.alias("tokens"))


def token_weights(tokens: DataFrame, labelled: DataFrame) -> tuple[DataFrame, float]:
    """((token, weight, n), prior): log odds of ``block`` against ``allow``, smoothed.

    ``tokens`` has (token, bad) of the rows of ``labelled``; the seeds are added as tokens of
    ``SEED_PAGES`` blocked pages.
    """
    rows, blocked = labelled.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0))
    ).first()
    prior = math.log(blocked + SMOOTHING) - math.log(rows - blocked + SMOOTHING)
    bad = F.sum(F.col("bad").cast("long")).alias("bad")
    seen = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"), bad)
    names = [("host:" + word, SEED_PAGES, SEED_PAGES) for word in SEEDS]
    believed = tokens.sparkSession.createDataFrame(names, "token string, n long, bad long")
    both = seen.unionByName(believed).groupBy("token")
    counts = stored(both.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    size, held, held_bad = counts.agg(F.count(F.lit(1)), F.sum("n"), F.sum("bad")).first()
    spread = SMOOTHING * size
    in_bad = F.log((F.col("bad") + SMOOTHING) / F.lit(held_bad + spread))
    in_good = F.log((F.col("n") - F.col("bad") + SMOOTHING) / F.lit(held - held_bad + spread))
    return counts.select("token", (in_bad - in_good).alias("weight"), "n"), prior


def held_out_accuracy(judged_pages: DataFrame) -> DataFrame:
    """(labelled, right, right_by_seeds) over the labelled URLs that were held out."""
    rows = judged_pages.filter("held_out AND label IS NOT NULL")
    by_seeds = F.when(F.col("has_seed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.agg(
        F.count(F.lit(1)).alias("labelled"),
        F.count_if(F.col("learned") == F.col("label")).alias("right"),
        F.count_if(by_seeds == F.col("label")).alias("right_by_seeds"),
    )


def judged(
    pages: DataFrame,
    rules: DataFrame | None = None,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, learned, label, has_seed, held_out) of every row.

    ``score`` is the log odds of ``block`` by naive Bayes and ``learned`` its verdict, whether or
    not a rule decides; ``label`` is what the row taught or was held out with, or null.
    """
    rules = rule_table(pages.sparkSession) if rules is None else rules
    host, path = host_and_path(url)
    cut = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = stored(cut.withColumn("row", F.monotonically_increasing_id()))
    hosts = rows.select("host").distinct()
    of_host = stored(host_tokens(hosts, pages, html))
    seeds = F.array(*[F.lit("host:" + word) for word in SEEDS])
    joined = rows.join(of_host, "host", "left").join(fitting_rules(rows, rules), "row", "left")
    own = F.coalesce("tokens", F.array().cast(T.ArrayType(T.StringType())))
    has_seed = F.arrays_overlap(own, seeds)
    by_seed = F.when(has_seed, F.lit("block"))
    labelled = stored(
        joined.select(
            "row",
            "page_id",
            "host",
            "path",
            "rule",
            "rule_verdict",
            F.concat(own, path_tokens("path")).alias("tokens"),
            has_seed.alias("has_seed"),
            F.coalesce("rule_verdict", by_seed).alias("label"),
            (F.crc32(F.concat("host", "path")) % FOLDS == 0).alias("held_out"),
        )
    )
    taught = labelled.filter("label IS NOT NULL AND NOT held_out").select(
        F.when(F.col("rule").isNull(), F.filter("tokens", lambda t: ~F.array_contains(seeds, t)))
        .otherwise(F.col("tokens"))
        .alias("tokens"),
        (F.col("label") == "block").alias("bad"),
    )
    weights, prior = token_weights(taught.select("bad", F.explode("tokens").alias("token")), taught)
    tokens = labelled.select("row", F.explode("tokens").alias("token"))
    sums = join_lookup(tokens, weights, "token", "n").groupBy("row").agg(F.sum("weight").alias("sum"))
    found = labelled.join(sums, "row", "left")
    score = F.round(F.coalesce("sum", F.lit(0.0)) + F.lit(prior), DIGITS)
    learned = F.when(score > 0, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", learned).alias("verdict"),
        score.alias("score"),
        learned.alias("learned"),
        "label",
        "has_seed",
        "held_out",
    )
