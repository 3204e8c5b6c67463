import re

import corpus_pipeline
import numpy as np
import pytest
from tapeline.llm import queries, shared

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(shared.written(stage(spark, out[-1], SF), "test"))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_stay_until_the_last_stage(steps):
    assert all(s.schema.names == steps[0].schema.names for s in steps[:-1])
    assert all([t for _, t in s.dtypes] == [t for _, t in steps[0].dtypes] for s in steps[:-1])


def test_each_stage_equals_its_query_on_the_same_rows(spark, steps):
    scores = queries.QUERIES["op3_quality_kernel_ridge"](spark, SF).collect()
    assert ids(steps[1]) == {r.doc_id for r in scores if r.predicted}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    second = ids(steps[2])
    known = [i for i in ids(steps[1]) if i in labels]
    assert np.mean([i in second for i in known if not labels[i].toxic]) > 0.99
    assert np.mean([i not in second for i in known if labels[i].toxic]) > 0.6  # few labels are there to learn from


def test_near_duplicates_by_brute_force(steps):
    rows = steps[2].select("doc_id", "text").collect()
    sets = {}
    for r in rows:
        w = (r.text or "").encode().lower().split()
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    order, index, changed = sorted(sets), {}, True
    for i in order:
        for x in sets[i]:
            index.setdefault(x, []).append(i)
    links = {(a, b) for m in index.values() for k, a in enumerate(m) for b in m[k + 1:]}
    links = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            changed |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    assert ids(steps[3]) == {i for i in comp if comp[i] == i}


def test_secrets_are_masked(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    for r in steps[4].collect():
        assert not re.search(r'AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}|token = "[0-9a-f]{40}', r.text or "")
        assert r.n_chars == len(r.text)
        if "[SECRET]" not in r.text:
            assert r.text == before[r.doc_id]
    assert ids(steps[4]) == set(before)


def test_packing_holds_what_is_left(spark, steps):
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == ids(steps[4])
    whole = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows}
    assert whole == {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in queries.QUERIES["pipeline"](spark, SF).collect()}


def test_odd_rows(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, None, None, None, None), (None, "some words", "en", "s", 10), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = shared.written(stage(spark, docs, str(tmp_path)), "odd")
        assert docs.count() <= len(data)
