"""Secrets in texts: fixed patterns, and strings that pass a battery of randomness tests.

Patterns give the base spans, leftmost and not overlapping for each kind. Any other run of
``CANDIDATE`` characters that meets no base span is a candidate. Its encoding is the
smallest alphabet that holds all its characters; under the hypothesis that it was drawn
evenly from that alphabet three tests give a probability each: chi-squared of the symbol
counts, number of runs above and below the middle, and correlation of neighbours. They are
combined by Fisher's sum.

A random string passes with evenly spread probabilities, other strings pile up near 0. So in
each class (encoding, length to a power of two) the share of other strings among those
above a limit can be estimated from the upper half of the distribution, and the class gets
the smallest limit of ``GRID`` at which that share is at most ``FALSE_SHARE``, else the highest.
Short strings, on which the tests have little power, thus get higher limits than long ones. In
a class of fewer than ``SPARSE`` candidates each test is held against a fixed level instead.
Strings of fewer than 20 characters are no candidates.

Everything is an expression inside the row of the text. Only counts per class and twentieth
are shuffled, at most a few thousand rows. Null texts are empty and have no span. Repeated
rows are judged each on its own; other columns are ignored; an empty table gives an empty
result. Places are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerclock.operators.storage import stored

# Kinds in their order, patterns, and least lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
ASSIGN_VALUE = 12
ACCESS_LENGTH = 18
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# Candidates with fewer symbols before their padding cannot be tested; rule lines of "=" are such.
TESTED_SYMBOLS = 8

# Cheap conditions that every text with a match fulfils.
_ASSIGN_HINT = r"(?i:passw|secret|token|api_?key)"
_ACCESS_HINT = r"AKIA[A-Z0-9]"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_DIGITS = "0123456789"
# Alphabets from the smallest to the largest; padding is cut off before.
ENCODINGS = {
    "decimal": _DIGITS,
    "hex_lower": _DIGITS + "abcdef",
    "hex_upper": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "upper": _UPPER,
    "base32": _UPPER + "234567",
    "lower_digits": _DIGITS + _LOWER,
    "upper_digits": _DIGITS + _UPPER,
    "letters": _UPPER + _LOWER,
    "alphanumeric": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64_url": _UPPER + _LOWER + _DIGITS + "-_",
    "any": _UPPER + _LOWER + _DIGITS + "+/-_",
}

FALSE_SHARE = 0.05
# A class of fewer candidates has no estimate: those that pass each of the tests at LEVEL are
# accepted, which loses a random string in at most three times LEVEL of all cases.
SPARSE = 20
LEVEL = 0.02
BINS = 20
GRID = tuple(i / BINS for i in range(BINS // 2 + 1))

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def found_spans(
    text: Column, pattern: str, kind: str, keep: Callable[[Column, Column], Column], group: int = 0
) -> Column:
    """Spans of all matches that ``keep`` (of match and group) accepts.

    The pieces between the matches and the matches themselves add up to their places.
    """
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("piece"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(held: Column, entry: Column) -> Column:
        at = held["at"] + F.length(entry["piece"])
        end = at + F.coalesce(F.length(entry["match"]), F.lit(0))
        span = F.struct(
            at.alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            end.alias("end"),
            entry["match"].alias("value"),
        )
        good = F.coalesce(keep(entry["match"], entry["value"]), F.lit(False))
        found = F.when(good, F.concat(held["found"], F.array(span))).otherwise(held["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(zipped, start, step, lambda held: held["found"])


def _if_hinted(hint: Column, spans: Column) -> Column:
    return F.when(hint, spans).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of the fixed patterns by kind."""
    return {
        "assign": _if_hinted(
            text.rlike(_ASSIGN_HINT),
            found_spans(text, ASSIGN, "assign", lambda m, v: F.length(v) >= ASSIGN_VALUE, 2),
        ),
        "access": _if_hinted(
            text.rlike(_ACCESS_HINT),
            found_spans(text, ACCESS, "access", lambda m, v: F.length(m) >= ACCESS_LENGTH),
        ),
        "hex": _if_hinted(
            text.rlike(HEX), found_spans(text, HEX, "hex", lambda m, v: m.isNotNull())
        ),
    }


def _tails(z: dict[str, Column]) -> list[dict[str, Column]]:
    """Columns, step by step, of P(Z > z) of the standard normal for each named ``z``.

    Good to about 1e-7 (a published polynomial). What a step uses more than once is a column
    of the step before, so that no expression is spelled out twice.
    """
    terms, series, tails = {}, {}, {}
    for name in z:
        terms[f"_t_{name}"] = 1 / (1 + 0.2316419 * F.abs(f"_z_{name}"))
        t = F.col(f"_t_{name}")
        value = F.lit(1.330274429)
        for c in (-1.821255978, 1.781477937, -0.356563782, 0.319381530):
            value = value * t + c
        at = F.col(f"_z_{name}")
        series[f"_tail_{name}"] = F.exp(-at * at / 2) / 2.5066282746310002 * value * t
        tail = F.col(f"_tail_{name}")
        tails[f"_p_{name}"] = F.when(at >= 0, tail).otherwise(1 - tail)
    return [{f"_z_{name}": column for name, column in z.items()}, terms, series, tails]


def randomness(candidates: DataFrame) -> DataFrame:
    """``candidates`` (with ``value``), their ``encoding``, probability ``p`` and ``p_least``.

    ``p_least`` is the least of the three tests. The alphabet is a column, taken from
    ``ENCODINGS`` by the number of the encoding, so that every test is one expression for
    all of them. Strings of one symbol only have a square sum that no test divides by; those
    of fewer than ``TESTED_SYMBOLS`` have probabilities of 0.
    """
    raw, alphabet, n, m = F.col("_raw"), F.col("_alphabet"), F.col("_n"), F.col("_m")
    alphabets = F.array(*[F.lit(a) for a in ENCODINGS.values()])
    names = F.array(*[F.lit(name) for name in ENCODINGS])
    holds = F.transform(
        alphabets, lambda a: F.length(F.call_function("translate", raw, a, F.lit(""))) == 0
    )
    middle = F.floor(m / 2).cast("int")
    digits = F.concat(F.repeat(F.lit("0"), middle), F.repeat(F.lit("1"), m.cast("int") - middle))
    counts = F.transform(
        F.split(alphabet, ""), lambda c: F.length(raw) - F.length(F.replace(raw, c, F.lit("")))
    )
    squares = F.aggregate(counts, F.lit(0.0), lambda held, x: held + x.cast("double") * x)
    codes = F.transform(
        F.split(raw, ""), lambda c: F.greatest(F.instr(alphabet, c) - 1, F.lit(0))
    )
    halves, plain = F.col("_halves"), F.col("_codes")
    ones = F.length(F.translate(halves, "0", "")).cast("double")
    changes = sum(
        (F.length(halves) - F.length(F.replace(halves, F.lit(x), F.lit("")))) / 2
        for x in ("01", "10")
    )
    mean, expected, spread = F.col("_mean"), F.col("_expected"), F.col("_spread")
    pairs = F.transform(plain, lambda x, i: (x - mean) * (F.get(plain, i + 1) - mean))
    z_runs = F.when(spread > 0, (F.col("_changes") + 1 - expected) / F.sqrt(spread))
    share = F.when(F.col("_power") > 0, F.col("_product") / F.col("_power")).otherwise(1.0)
    free, cube = m - 1, F.col("_cube")
    width = 2 / (9 * free)
    z = {
        "chi": (cube - (1 - width)) / F.sqrt(width),
        "runs": F.abs(z_runs),
        "serial": F.abs(share * F.sqrt(n)),
    }
    least = lambda p: F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-30))
    each = [F.col("_p_chi"), 2 * F.col("_p_runs"), 2 * F.col("_p_serial")]
    half = F.col("_half")
    total = F.exp(-half) * (1 + half + half * half / 2)
    tested = lambda p: F.when(F.col("_length") >= TESTED_SYMBOLS, p).otherwise(0.0)
    steps = [
        {"_padded": F.rtrim(F.col("value"), F.lit("="))},
        {"_raw": F.translate("_padded", "=", ""), "_length": F.length("_padded")},
        {"_number": F.coalesce(F.nullif(F.array_position(holds, True), F.lit(0)), F.size(names))},
        {
            "encoding": F.element_at(names, F.col("_number").cast("int")),
            "_alphabet": F.element_at(alphabets, F.col("_number").cast("int")),
            "_raw": F.col("_padded"),
            "_n": F.greatest("_length", F.lit(TESTED_SYMBOLS)).cast("double"),
        },
        {"_m": F.length("_alphabet").cast("double"), "_codes": codes, "_squares": squares},
        {"_halves": F.call_function("translate", raw, alphabet, digits)},
        {"_ones": ones, "_changes": changes},
        {"_mean": F.aggregate(plain, F.lit(0.0), lambda held, x: held + x) / n},
        {
            "_expected": 1 + 2 * F.col("_ones") * (n - F.col("_ones")) / n,
            "_power": F.aggregate(plain, F.lit(0.0), lambda held, x: held + x * x) - n * mean**2,
            "_product": F.aggregate(
                pairs, F.lit(0.0), lambda held, x: held + F.coalesce(x, F.lit(0.0))
            ),
            "_cube": F.pow(F.greatest(m / n * F.col("_squares") - n, F.lit(0.0)) / free, F.lit(1 / 3)),
        },
        {"_spread": (expected - 1) * (expected - 2) / (n - 1)},
        *_tails(z | {"runs": F.coalesce(z["runs"], F.sqrt(n))}),
        {f"_each_{i}": least(p) for i, p in enumerate(each)},
        {"_half": -sum(F.log(f"_each_{i}") for i in range(3))},
        {"p": tested(total), "p_least": tested(F.least(*[F.col(f"_each_{i}") for i in range(3)]))},
    ]
    rows = candidates
    for step in steps:
        rows = rows.withColumns(step)
    return rows.drop(*[c for c in rows.columns if c.startswith("_") and c not in candidates.columns])


def _class(encoding: Column, value: Column) -> Column:
    return F.concat_ws(":", encoding, F.floor(F.log2(F.length(value))).cast("string"))


def class_limits(tested: DataFrame) -> DataFrame:
    """(class, limit): the least probability at which a candidate of the class is accepted.

    Null for classes of fewer than ``SPARSE`` candidates, from which no share can be estimated.
    """
    place = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int")
    counts = tested.groupBy("class", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    above = [F.sum(F.when(F.col("bin") >= i, F.col("n")).otherwise(0)) for i in range(BINS // 2 + 1)]
    sums = counts.groupBy("class").agg(*[n.alias(f"above_{i}") for i, n in enumerate(above)])
    limit = F.lit(GRID[-1])
    for i in reversed(range(BINS // 2)):
        random = 2 * F.col(f"above_{BINS // 2}") * (1 - GRID[i])
        accepted = F.col(f"above_{i}")
        good = accepted - F.least(random, accepted) <= FALSE_SHARE * accepted
        limit = F.when(good, F.lit(GRID[i])).otherwise(limit)
    known = F.when(F.col("above_0") >= SPARSE, limit)
    return sums.select("class", known.alias("limit"))


def accepted(tested: DataFrame) -> DataFrame:
    """The candidates at or above the limit of their class, or that pass every test by itself."""
    limits = F.broadcast(class_limits(tested))  # a few hundred classes at most
    good = F.coalesce(F.col("p") >= F.col("limit"), F.col("p_least") >= LEVEL)
    return tested.join(limits, "class").filter(good)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, random): arrays of (start, kind, end) of every row of ``docs``.

    ``kind`` is the place in ``KINDS``; ``base`` has the patterns' spans, ``random`` those of
    the battery.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    spans = base_spans(F.col("text"))
    with_base = rows.withColumns({f"_{kind}": column for kind, column in spans.items()})
    runs = _if_hinted(
        F.col("text").rlike(CANDIDATE),
        found_spans(F.col("text"), CANDIDATE, "random", lambda m, v: m.isNotNull()),
    )
    base = F.concat(*[F.col(f"_{kind}") for kind in KINDS[:3]])
    free = F.filter(
        F.col("_runs"),
        lambda c: ~F.exists(
            F.col("base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])
        ),
    )
    found = with_base.withColumn("base", base).withColumn("_runs", runs)
    found = found.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "base", free.alias("free")
    )
    kept = stored(found)
    candidates = kept.select("row", F.explode("free").alias("span")).select("row", "span.*")
    candidates = candidates.filter(F.length(F.rtrim("value", F.lit("="))) >= TESTED_SYMBOLS)
    tested = randomness(stored(candidates))
    tested = stored(tested.withColumn("class", _class(F.col("encoding"), F.col("value"))))
    extra = accepted(tested).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("random")
    )
    plain = F.array_sort(
        F.transform("base", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    )
    joined = kept.join(extra, "row", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return joined.select("doc_id", plain.alias("base"), F.coalesce("random", none).alias("random"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as text."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{KINDS[i]}")
        for i in range(3)
    ]
    everything = F.array_sort(F.concat("base", "random"))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(everything).alias("spans"),
    )
