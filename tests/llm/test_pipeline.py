from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from answerclock.llm import components, language_id
from answerclock.llm.registry import END_ID, tokenizer_path
from tests.llm import test_decontaminate, test_dedup_minmax, test_mixing
from tests.llm.helpers import Groups, sentences


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    item = sentences(rng, 200, 30)
    rows = [(i, sentences(rng, 200, rng.randrange(8, 90)), "en", f"s{i % 4}", 0) for i in range(120)]
    rows += [(200 + i, rows[i % 7][1], "en", "s1", 0) for i in range(30)]
    rows += [(300 + i, f"x {item} y", "en", "s2", 0) for i in range(3)]
    rows += [(400, None, None, None, None), (401, "", "en", "s0", 0), (402, "12 !", None, "s1", 4)]
    path = tmp_path_factory.mktemp("tables")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    return str(path), rows, item


def brute_force(spark, folder):
    path, rows, item = folder
    model = language_id.fit(spark.read.parquet(f"{path}/documents.parquet"))
    rejected = model.predict([r[1] for r in rows])[2]
    rows = [r for r, bad in zip(rows, rejected) if not bad]
    group = test_dedup_minmax.expected([(r[0], r[1]) for r in rows])
    rows = [r for r in rows if group[r[0]][1] == r[0]]
    rows = [r for r in rows if not test_decontaminate.expected(r[1], [(1, item)])[-1]]
    taken = test_mixing.expected([(r[0], r[3], r[1]) for r in rows])[1]
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for i, text, *_ in sorted(rows):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, END_ID]
        for _ in range(taken[i][2] // taken[i][0]):
            out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    return out


def test_equals_brute_force(spark, folder):
    got = sorted(map(tuple, corpus_pipeline.run(spark, folder[0]).collect()))
    want = brute_force(spark, folder)
    assert got == want and len(want) > 50


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).schema.simpleString() == docs.schema.simpleString()


def test_an_empty_table_passes(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0


def test_every_operator_and_the_pipeline_are_registered():
    names = contract.queries()
    numbers = {int(n[2:].split("_")[0]) for n in names if n[:2] == "op" and n[2].isdigit()}
    assert numbers == set(range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(2000, 2100)]
    groups = Groups({n for pair in links for n in pair})
    for a, b in links:
        groups.link(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {n: groups.least(n) for a, b in links if a != b for n in (a, b)}


def test_near_copies_from_four_fifths_on_go(spark):
    """Sets of 100 shingles: 90 common ones of 110 are 0.82, 88 of 112 are 0.79."""
    def text(common, mark):
        return " ".join([f"w{i}" for i in range(common + 4)] + [f"{mark}{i}" for i in range(100 - common)])

    rows = [(1, text(90, "a")), (2, text(90, "b")), (3, text(88, "c").replace("w", "v")), (4, text(88, "d").replace("w", "v"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, df, "").collect()) == [1, 3, 4]
