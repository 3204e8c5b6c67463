import numpy as np
import pytest
from tapeline.llm import graph, jaccard
from tapeline.llm.jaccard import jaccard_components


def brute(rows, width=5, percent=75):
    """All pairs of sets of word tuples, components by repeated minima."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    comp = {p: p for p, _ in rows}
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            changed |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    return {(p, len(s), comp[p]) for (p, _), s in zip(rows, sets)}


def corpus(seed, n, words=60, vocabulary=500):
    """Bases, copies at many distances, a common passage, chains of small edits."""
    rng = np.random.default_rng(seed)
    word = lambda k: [f"W{x}" for x in rng.integers(0, vocabulary, k)]
    passage, bases, rows = word(20), [word(words) for _ in range(max(2, n // 12))], []
    for i in range(n):
        text = list(bases[rng.integers(0, len(bases)) if i % 3 else 0])
        for _ in range(rng.integers(0, 5)):
            text[rng.integers(0, len(text))] = word(1)[0]
        if i % 4 == 0:
            text += passage
        if i % 7 == 0:
            text = word(words) + passage
        rows.append((i + 5, " ".join(text)))
    chain = word(80)
    for i in range(15):
        chain = chain[2:] + word(2)
        rows.append((1000 - i, "\t".join(chain)))
    return rows


def result(df):
    return {(r.path, r.n_shingles, r.component) for r in df.collect()}


@pytest.mark.parametrize("seed,small,block,hot", [(1, 8, 1024, 4096), (2, 2, 7, 4096), (3, 2, 5, 3), (4, 8, 16, 0)])
def test_against_all_pairs(spark, frame, monkeypatch, seed, small, block, hot):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus(seed, 220)
    assert result(jaccard_components(frame(rows).repartition(5), hot=hot)) == brute(rows)


def test_buckets_across_batches(spark, frame, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = corpus(9, 150)
        assert result(jaccard_components(frame(rows))) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_without_broadcast(spark, frame, monkeypatch):
    monkeypatch.setattr(jaccard, "MANY_ROWS", 0)
    rows = corpus(5, 60) + [(7777, corpus(5, 60)[0][1])]
    assert result(jaccard_components(frame(rows))) == brute(rows)


def test_edge_rows(frame):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a B c"), (5, "A b C"), (6, "a b c d e"), (7, "a b c d e f g"), (8, "a b c d e f"),
            (9, "É b c"), (10, "é b c"), (11, "a b c"), (12, "x " * 30_000), (12, "x " * 30_000), (13, "x " * 9)]
    got = result(jaccard_components(frame(rows)))
    assert got == {r for r in brute(rows[:-2] + rows[-1:])}
    null = jaccard_components(frame([(None, "a b c d e"), (6, "a b c d e")])).collect()
    assert {(r.path, r.n_shingles, r.component) for r in null} == {(None, 1, None), (6, 1, 6)}
    assert jaccard_components(frame([])).collect() == []


def test_shingle_hashes_tell_sets_apart():
    assert len(jaccard.shingles("a b c d e f")) == 2
    assert (jaccard.shingles("a b c d") != jaccard.shingles("a b c d e")).all()
    assert len(jaccard.shingles(" ".join(f"{i % 7}" for i in range(100)))) == 7


def test_parity_bound_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64)) for _ in "ab")
        b = np.unique(np.concatenate([a[: rng.integers(0, 300)], b[: rng.integers(0, 300)]]))
        bits = [np.frombuffer(jaccard.parities(x), dtype=np.uint64)[None] for x in (a, b)]
        assert jaccard.apart(*bits)[0] <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("chunk", [1, 3, 100_000])
def test_components_of_chains_stars_and_cycles(spark, monkeypatch, chunk):
    monkeypatch.setattr(graph, "CHUNK", chunk)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(7, 8), (8, 9), (9, 7), (3, 3), (8, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 500 for k in range(500, 560)}, 7: 7, 8: 7, 9: 7}
