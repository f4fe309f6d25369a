from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import pytest

from answerclock.llm import url_filter

URLS = [
    "https://www.Example.ORG/es/1?x#y",
    "http://example.org/en/19",
    "http://example.org/en/2",
    "http://a.b.example.org/en/1",
    "http://notexample.org/es/",
    "https://x.com/fr/1",
    "https://x.com/de/1",
    "https://x.com/fr",
    "https://spamfarm.example.net/en/1",
    "https://cheap-pills.example.net/en/1",
    "https://theater.example.net/en/1?q=://a",
    "ftp://h.net#/de/",
    "nothing",
    "://",
    "",
    None,
    "https://org",
    "https://" + "longname" * 40 + ".net/" + "p/" * 200,
]


def plain_cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i, c in enumerate(rest) if c in "/?#"] or [len(rest)]
    host, path = rest[: ends[0]], rest[ends[0] :]
    stops = [i for i, c in enumerate(path) if c in "?#"] or [len(path)]
    return host.lower(), path[: stops[0]]


def plain_rule(host, path):
    fits = []
    for rule, verdict in url_filter.RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


@pytest.fixture(scope="module")
def pages(spark):
    html = "<p>theater theater the spam farm names of the farm</p>"
    rows = [(i, u, html if i % 2 else None, "x", 1) for i, u in enumerate(URLS)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, row int")


def test_hosts_paths_and_rules(pages):
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = plain_cut(url)
        rule, verdict = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert verdict is None or got[i].verdict == verdict


def plain_scores(html_of, urls=URLS):
    """Log odds of every URL by a naive Bayes over dictionaries."""
    names = [
        re.findall("[a-z]+", " ".join(x for x in plain_cut(u)[0].split(".")[:-1] if x != "www"))
        for u in urls
    ]
    held = {p[a:b] for own in names for p in own for a in range(len(p)) for b in range(a + 1, len(p) + 1)}
    counts = Counter(dict.fromkeys(url_filter.SEEDS, url_filter.SEED_COUNT))
    for html in html_of:
        counts.update(w for w in re.findall("[a-z]+", (html or "").lower()) if w in held)
    total = sum(counts.values())
    rows, bad, good, labels = [], Counter(), Counter(), []
    seeds = {"host:" + word for word in url_filter.SEEDS}
    for url, own in zip(urls, names):
        host = ["host:" + w for p in own for w in url_filter.best_split(p, counts, total)]
        cut = plain_cut(url)
        runs = re.findall("[a-z]+|[0-9]+", cut[1].lower())
        tokens = host + [f"#{len(r)}" if r[0].isdigit() else r for r in runs]
        rows.append(tokens)
        rule, label = plain_rule(*cut)
        if rule is None and seeds & set(host):
            label, tokens = "block", [t for t in tokens if t not in seeds]
        if label is not None and zlib.crc32("".join(cut).encode()) % 5:
            (bad if label == "block" else good).update(tokens)
            labels.append(label)
    bad.update(dict.fromkeys(seeds, url_filter.SEED_PAGES))
    size = len({*bad, *good})
    blocked = labels.count("block")
    prior = math.log(blocked + 1) - math.log(len(labels) - blocked + 1)

    def weight(token):
        if token not in bad and token not in good:
            return 0.0
        return math.log((bad[token] + 1) / (bad.total() + size)) - math.log(
            (good[token] + 1) / (good.total() + size)
        )

    return [prior + sum(map(weight, tokens)) for tokens in rows]


def test_scores_equal_a_plain_naive_bayes(pages):
    want = plain_scores(r.html for r in pages.collect())
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    assert [got[i].score for i in range(len(URLS))] == pytest.approx(want, abs=1e-8)
    for i in got:
        assert got[i].learned == ("block" if want[i] > 0 else "allow")
        if got[i].rule is None:
            assert got[i].verdict == got[i].learned


def test_what_stands_around_labels_is_learned(spark):
    """Rules block pages with ``deals``, and seeds come along with ``win``."""
    urls = [f"https://shop{chr(97 + i % 20)}.example.com/de/deals/{i}" for i in range(200)]
    urls += [f"https://news{chr(97 + i % 20)}.example.org/en/story/{i}" for i in range(400)]
    urls += [f"https://casino-win{chr(97 + i % 5)}.example.net/en/{i}" for i in range(60)]
    others = [
        "https://plain.example.net/deals/deals/7",  # no seed, but what blocked pages have
        "https://win-now.example.net/9",
        "https://plain.example.net/en/story/7",
        "https://track.example.net/en/story/en/story/story/8",  # a seed among what allowed pages have
    ]
    rows = [(i, u, "<p>win now story deals casino</p>") for i, u in enumerate(urls + others)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = url_filter.judged(df)
    got = {r.page_id: r for r in found.collect()}
    verdicts = [got[len(urls) + i].verdict for i in range(4)]
    assert verdicts == ["block", "block", "allow", "allow"]
    want = plain_scores([r[2] for r in rows], urls + others)
    assert [got[i].score for i in range(len(rows))] == pytest.approx(want, abs=1e-8)
    (held,) = url_filter.held_out_accuracy(found).collect()
    assert held.labelled > 100 and held.right > 0.95 * held.labelled > held.right_by_seeds


def test_viterbi_finds_the_best_of_all_splits():
    counts = {"spam": 50, "farm": 20, "far": 30, "m": 9, "spa": 40, "a": 80}
    total = 1000

    def score(words):
        return sum(
            math.log(counts[w] / total) if w in counts else -math.log(total) - len(w) * math.log(10)
            for w in words
        )

    for piece in ("spamfarm", "aspa", "xspamx", "farmspa"):
        splits = []
        for n in range(len(piece)):
            for cuts in itertools.combinations(range(1, len(piece)), n):
                edges = [0, *cuts, len(piece)]
                splits.append([piece[a:b] for a, b in itertools.pairwise(edges)])
        best = url_filter.best_split(piece, counts, total)
        assert score(best) == pytest.approx(max(map(score, splits)))
    assert url_filter.best_split("spamfarm", counts, total) == ["spam", "farm"]


def test_empty_table_and_repeated_rows(pages):
    assert url_filter.judged(pages.limit(0)).count() == 0
    twice = pages.unionByName(pages)
    assert url_filter.judged(twice).count() == 2 * len(URLS)
