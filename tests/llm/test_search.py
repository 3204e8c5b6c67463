import math
import re
from collections import Counter

import numpy as np
import pytest
from tapeline.llm import search
from tapeline.llm.search import search_documents, terms_of


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, queries, k):
    bags = [Counter(words(t)) for _, t in docs]
    n, average = len(docs), sum(sum(b.values()) for b in bags) / max(1, len(docs))
    df = Counter(w for b in bags for w in b)
    out = []
    for q, text in queries:
        scores = []
        for (p, _), bag in zip(docs, bags):
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * 2.2 / (bag[w] + 1.2 * (0.25 + 0.75 * sum(bag.values()) / average))
                    for w in set(words(text)) if w in bag)
            if s:
                scores.append((-round(s, 6), p is None, p))
        out += [(q, i + 1, p, -s) for i, (s, _, p) in enumerate(sorted(scores)[:k])]
    return out


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    word = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(300)]
    share = 1 / np.arange(1, 301)
    return [(i, " ".join(word[x] for x in rng.choice(300, rng.integers(1, 60), p=share / share.sum()))) for i in range(n)]


@pytest.mark.parametrize("k,shard,first,dense", [(10, 50, 16, 8), (3, 1000, 1, 0), (1, 20, 1, 2), (500, 64, 2, 1000)])
def test_against_brute_force(spark, frame, monkeypatch, k, shard, first, dense):
    monkeypatch.setattr(search, "FIRST_BLOCKS", first)
    monkeypatch.setattr(search, "DENSE", dense)
    monkeypatch.setattr(search, "BLOCK", 4)
    docs = corpus(3, 240) + [(400 + i, corpus(3, 5)[4][1]) for i in range(6)]
    queries = docs[::20] + [(9000, "w1 nothing"), (9001, "absent"), (9002, None), (9003, "")]
    asked = spark.createDataFrame(queries, "query long, doc string")
    got = search_documents(frame(docs).repartition(6), asked, k, shard_documents=shard).collect()
    want = brute(docs, queries, k)
    assert sorted((r.query, r.rank, r.path) for r in got) == sorted(w[:3] for w in want)
    score = {w[:3]: w[3] for w in want}
    assert all(abs(score[(r.query, r.rank, r.path)] - r.score) < 2e-6 for r in got)


def test_blocks_are_pruned(monkeypatch):
    """A rare word settles the best documents, and most blocks are never scored."""
    rng = np.random.default_rng(0)
    texts = [terms_of(" ".join(f"w{x}" for x in rng.integers(0, 50, 20))) for _ in range(3000)]
    texts[7] = terms_of("rare words here rare")
    index = search.Shard(texts, 20.0)
    seen = []
    monkeypatch.setattr(search, "_ranges", lambda s, n, f=search._ranges: seen.append(int(n.sum())) or f(s, n))
    rows, scores = index.top(np.unique(terms_of("rare words here w1")), np.full(4, 5.0), 1)
    assert rows.tolist() == [7] and seen[1] + sum(seen[2:]) < len(index.docs) / 2


def test_edge_rows(spark, frame):
    rows = [(1, None), (2, ""), (None, "gate step"), (4, "gate step"), (4, "gate step"), (5, "gate " * 50_000)]
    asked = spark.createDataFrame([(1, "GATE!"), (2, None)], "query long, doc string")
    got = search_documents(frame(rows), asked).collect()
    assert sorted((r.path is None, r.path or 0, r.query) for r in got) == [(False, 4, 1), (False, 4, 1), (False, 5, 1), (True, 0, 1)]
    assert search_documents(frame([]), asked).collect() == []
    assert search_documents(frame(rows), asked.where("false")).collect() == []


def test_scores_of_one_shard_prune_the_next():
    """Queries go together, with what the task has found before; both shards give what one over all documents gives."""
    texts = [terms_of(t) for _, t in corpus(5, 800)]
    parts = [search.Shard(t, 20.0) for t in (texts, texts[:400], texts[400:])]
    asked = [np.unique(t) for t in texts[::7]]
    terms, at = np.unique(np.concatenate(asked), return_inverse=True)
    idf, sizes, k = 1 + np.sin(terms % 1000) ** 2, np.array([len(a) for a in asked]), 5
    whole, known = np.zeros((len(asked), k)), np.zeros((len(asked), k))
    one, first, second = (p.best(terms, idf, at, sizes, h) for p, h in zip(parts, (whole, known, known)))
    assert np.array_equal(np.sort(whole), np.sort(known)) and (known > 0).all()
    pairs = lambda q, r, s: {(i, j) for i, j, x in zip(q.tolist(), r.tolist(), s) if x >= whole[i].min()}
    assert pairs(*one) == pairs(*first) | pairs(second[0], second[1] + 400, second[2])
    assert len(second[0]) < 0.75 * len(first[0])


def test_near_ties_of_long_texts(spark, frame):
    """Scores in the thousands that differ in the last digits are told apart, and equal ones go to the smaller path."""
    rng = np.random.default_rng(8)
    base = [f"v{x}" for x in rng.integers(0, 4000, 3000)]
    docs = [(i, " ".join(base[:j] + base[j + 1 :])) for i, j in enumerate(rng.integers(0, 3000, 60).tolist())]
    docs += [(100 + i, docs[i][1]) for i in range(20)]
    asked = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[:1500]))], "query long, doc string")
    got = search_documents(frame(docs).repartition(4), asked, 7, shard_documents=12).collect()
    want = brute(docs, [(1, " ".join(base)), (2, " ".join(base[:1500]))], 7)
    assert sorted((r.query, r.rank, r.path) for r in got) == sorted(w[:3] for w in want)


def test_copies_leave_a_shard_as_k_rows(spark, frame, monkeypatch):
    """Of many equal documents no more than k of a task's shard reach the merge, those with the smallest paths."""
    docs = [(i, "gate step lamp") for i in range(500)] + [(900 + i, f"gate w{i}") for i in range(50)]
    asked = spark.createDataFrame([(1, "gate lamp")], "query long, doc string")
    seen = []
    coalesce = type(asked).coalesce

    def spied(self, n):
        out = coalesce(self, n)
        if "doc" in self.columns and "path" in self.columns:
            map_in_arrow = out.mapInArrow
            out.mapInArrow = lambda f, schema: seen.append(found := map_in_arrow(f, schema)) or found
        return out

    monkeypatch.setattr(type(asked), "coalesce", spied)
    got = search_documents(frame(docs).coalesce(1), asked, 3).collect()
    assert [r.path for r in sorted(got, key=lambda r: r["rank"])] == [0, 1, 2]
    assert seen[0].count() == 3
