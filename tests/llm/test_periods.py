import hashlib
import re
import zlib

import numpy as np
from tapeline.llm import periods, queries
from tapeline.llm.periods import periodic_runs, runs_of, word_numbers

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """Every run by trying each period at each place."""
    n, found = len(words), set()
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                smaller = any(all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q))
                if not smaller:
                    found.add((i, length, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found_runs(texts):
    words, numbers, begin, end = word_numbers([t.encode() for t in texts])
    place, length, period = runs_of(numbers, begin, end)
    out = [[] for _ in texts]
    for p, n, q in zip(place.tolist(), length.tolist(), period.tolist()):
        d = int(np.searchsorted(begin, p, side="right")) - 1
        out[d].append((p - int(begin[d]), n, q))
    return out


def test_levels_join():
    levels = list(periods.gram_levels(10_000))
    assert levels[:3] == [(1, 5), (6, 18), (19, 57)]
    for first, last in levels:
        assert all(last <= periods.least_length(q) - q and q <= last for q in range(first, last + 1))
    assert [a for a, _ in levels[1:]] == [b + 1 for _, b in levels[:-1]]


def test_random_words_of_small_alphabets():
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(600):
        size = int(rng.integers(1, 4))
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            root = rng.integers(0, size, int(rng.integers(1, 30))).tolist()
            parts += (root * int(rng.integers(1, 8)))[: int(rng.integers(1, 120))]
        texts.append(" ".join("gate"[: 1 + c] for c in parts))
    assert found_runs(texts) == [brute_runs(t.split()) for t in texts]


def test_nested_and_overlapping_runs():
    inner = "a a a a a a b"  # a run of period 1 inside each period of 7
    texts = [" ".join([inner] * 5), "x " * 6 + "x y " * 4, "a b " * 3, "a b c d " * 4, "a b c d " * 4 + "a b c d a", "q " * 5]
    got = found_runs(texts)
    assert got == [brute_runs(t.split()) for t in texts]
    assert (0, 35, 7) in got[0] and got[2] == [] and got[3] == [(0, 16, 4)] and got[5] == []


def test_equal_documents_do_not_meet():
    """Runs never cross the border of two documents, and copies are no occurrences of each other."""
    assert found_runs(["retry gate"] * 12) == [[] for _ in range(12)]


def test_long_runs_are_fast():
    texts = ["log " * 200_000, " ".join(f"w{i % 50_000}" for i in range(200_000)), " ".join(map(str, range(200_000)))]
    assert found_runs(texts) == [[(0, 200_000, 1)], [(0, 200_000, 50_000)], []]


def test_edge_rows(frame):
    note = "GEO_STEP\tretry\x0b" * 3
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, note), (5, note), (5, note), (6, "a a " * 6), (7, "a\u0085b\u001cc")]
    got = periodic_runs(frame(rows)).collect()
    assert [r.path for r in got] == [k for k, _ in rows]
    assert [[tuple(x) for x in r.runs] for r in got] == [[], [], [], [], [], [], [(0, 6, 1)], []]
    assert [r.collapsed for r in got][:3] == ["", "", ""] and got[6].collapsed == "a a" and got[7].n_words == 1
    assert got[4].collapsed == "GEO_STEP retry GEO_STEP retry GEO_STEP retry"
    assert periodic_runs(frame([])).collect() == []


def test_progress_log_of_a_retrying_step(frame):
    note = "B1 gate blocked wait retry "
    row = periodic_runs(frame([(1, "start " + note * 9 + "done")])).first()
    assert [tuple(r) for r in row.runs] == [(1, 45, 5)]
    assert row.collapsed == "start " + note + "done" and row.n_words == 47


def test_query_against_brute_force(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op11_seeded_periodic_runs"](spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(texts)
    planted = 0
    for d in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
            planted += 1
        runs = found_runs([" ".join(words)])[0] if n > 400 else brute_runs(words)
        r = rows[d.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 10
