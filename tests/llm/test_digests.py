import hashlib
from collections import Counter

import numpy as np
import pytest
from tapeline.llm import queries
from tapeline.llm.digests import BUCKETS, HEAD, document_digests, edited, fingerprint, likeness

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text):
    """The same digest, counted triplet by triplet with plain integers."""
    raw = b"\xff\xff" + text.encode() + b"\xff\xff"
    counts = Counter()
    for a, b, c in zip(raw, raw[1:], raw[2:]):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x2C1B3C6D & 0xFFFFFFFF
        h ^= h >> 13
        counts[h % BUCKETS] += 1
    ordered = sorted(counts[i] for i in range(BUCKETS))
    q = [ordered[BUCKETS * k // 4 - 1] for k in (1, 2, 3)]
    bits = "".join(f"{sum(counts[i] > x for x in q):02b}" for i in range(BUCKETS))
    return f"{int(bits, 2):0{BUCKETS // 2}x}"


@pytest.mark.parametrize("text", ["", "a", "manifest", "é日本😀", "one step of the gate " * 200])
def test_fingerprint_by_brute_force(text):
    assert fingerprint(text)[HEAD:] == slow_fingerprint(text)


def test_likeness():
    rng = np.random.default_rng(0)
    word = lambda: "".join(chr(97 + i) for i in rng.integers(0, 26, rng.integers(2, 9)))
    a, b = (" ".join(word() for _ in range(400)) for _ in "ab")
    pa, pb, pe = fingerprint(a), fingerprint(b), fingerprint(edited(a, b))
    assert likeness(pa, pa) == 1 and likeness(pa, pb) == likeness(pb, pa)
    assert likeness(pa, pe) > 0.6 > 0.4 > likeness(pa, pb)
    assert likeness(fingerprint("a"), fingerprint("b")) < 0.7 and likeness(fingerprint(""), pa) == 0


def brute(rows):
    """In one list on the driver."""
    out = []
    for (key, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        e = edited(text, following)
        p, pe, pn = fingerprint(text), fingerprint(e), fingerprint(following)
        out.append((key, len(text), hashlib.sha256(e.encode()).hexdigest(), p, pe, likeness(p, pe), likeness(p, pn)))
    return out


def test_every_document_against_brute_force(spark):
    rows = [tuple(r) for r in queries.QUERIES["op4_quartile_bucket_digest"](spark, SF).collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()]
    assert sorted(rows) == sorted(brute(docs))
    edits, nexts = np.array([r[5] for r in rows]), np.array([r[6] for r in rows])
    assert np.median(edits) > 0.65 and np.median(nexts) < 0.3 and np.quantile(edits, 0.1) > np.median(nexts)


def test_edge_rows(frame):
    rows = [(1, None), (2, ""), (3, "é😀ab"), (5, "x" * 200_000), (9, "abc")]
    assert sorted(map(tuple, document_digests(frame(rows)).collect())) == sorted(brute(rows))
    one = document_digests(frame([(7, "only one text")])).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert document_digests(frame([])).collect() == []
    odd = document_digests(frame([(None, "a"), (None, "a"), (4, "b"), (4, "c"), (4, "c")])).collect()
    assert len(odd) == 5 and sorted(r.n_chars for r in odd) == [1] * 5
