import numpy as np
import pytest
from tapeline.llm import queries
from tapeline.llm.fitting import commonest, isotonic
from tapeline.llm.quality import STATISTICS, QualityModel, quality_scores, statistics

SF = "/root/testdata/sf0.01"


def test_statistics_of_odd_texts():
    for text in ("", " ", "\n\n", "\0", "a", "日本", "x" * 100_000, "a\ta\ta"):
        found = statistics(text)
        assert len(found) == len(STATISTICS) and np.isfinite(found).all()


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 9, 40)
    ones = rng.binomial(counts, np.linspace(0.1, 0.9, 40))
    got = isotonic(ones, counts, prior=0)
    at = np.flatnonzero(counts)
    # min-max formula of isotonic regression
    for k, i in enumerate(at):
        best = max(min(ones[at[a : b + 1]].sum() / counts[at[a : b + 1]].sum() for b in range(k, len(at))) for a in range(k + 1))
        assert got[i] == pytest.approx(best)
    assert (np.diff(got) >= 0).all()


def test_commonest(spark):
    counted = spark.createDataFrame([(f"w{i}", 1000 // (i + 1)) for i in range(200)], "word string, n long")
    got = commonest(counted, "word", "n", 20)
    assert 10 <= len(got) <= 20 and set(got) == {f"w{i}" for i in range(len(got))}
    assert commonest(counted.where("false"), "word", "n", 5) == {}


def test_waves_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(1)
    d, width = len(STATISTICS), 4.0
    m = QualityModel(np.zeros(d), np.ones(d), rng.normal(0, 1 / width, (d, 20_000)), rng.uniform(0, 2 * np.pi, 20_000), None, None, None)
    x = rng.normal(0, 1, (6, d))
    phi = m.features(x)[:, :20_000]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * width**2))
    assert np.abs(phi @ phi.T - exact).max() < 0.05


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op3_quality_kernel_ridge"](spark, SF).collect()
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in quality]
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == quality[r.doc_id] for r in held]) > 0.97


def test_edge_rows(spark, frame):
    docs = [(1, "fine words here"), (1, "fine words here"), (2, None), (3, ""), (None, "###"), (4, "a " * 50_000)]
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (9, 0), (4, None)], "path long, accepted int")
    rows = quality_scores(frame(docs), labels).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    none = quality_scores(frame(docs), labels.where("false")).collect()
    assert all(r.score == pytest.approx(0.5, abs=0.001) for r in none)
    assert quality_scores(frame([]), labels).collect() == []
