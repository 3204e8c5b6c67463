"""Operators on small fixtures with known answers, and on skewed data against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tapeline.functions import numbers as N
from tapeline.functions import paths as P
from tapeline.functions import scoring as Sc
from tapeline.functions import times as T
from tapeline.operators import cluster as K
from tapeline.operators import compare as D
from tapeline.operators import contracts as C
from tapeline.operators import facts as A
from tapeline.operators import geometry as G
from tapeline.operators import scale
from tapeline.operators import slices as L
from tapeline.plans import jobs
from tapeline.sources import records, sinks, survey


def one(df):
    return df.first().asDict(recursive=True)


def col(spark, expr, values, kind="string"):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in d.select("i", expr(F.col("c")).alias("o")).orderBy("i").select("o").collect()]


def test_parse_number(spark):
    got = col(spark, N.parse_number, ["245,0", "1,736", "12,345.6", "1,234,567", " 9999 ", "", "abc", "12d", None, "-3,5"])
    assert got == [245.0, 1.736, 12345.6, 1234567.0, 9999.0, None, None, None, None, -3.5]


def test_units_and_ids(spark):
    assert col(spark, lambda c: N.to_meters(c, F.lit("mm")), [1736.4, float("nan"), float("inf"), None], "double") == [1.736, None, None, None]
    assert col(spark, lambda c: N.to_meters(c, F.lit("ft")), [1.0], "double") == [None]
    assert col(spark, N.clean_id, ["00001234", "12.0", "1.2E3", None, " 7 "]) == ["00001234", "12", "1200", "", "7"]


def test_size_token(spark):
    got = col(spark, Sc.size_token, ["75A", "60b", "75G", None, "90f"])
    assert (got[0]["underbust_m"], round(got[0]["bust_m"], 3), got[0]["code"]) == (0.75, 0.85, None)
    assert [g["code"] for g in got[1:4]] == ["RANGE_VIOLATION", "FORMAT_VIOLATION", "FORMAT_VIOLATION"]
    assert round(got[4]["bust_m"], 3) == 1.125


def test_scores(spark):
    d = spark.createDataFrame([(0.0, 0.0, 0.0), (0.1, -0.1, 0.1), (9.0, 0.0, None)], "a double, b double, c double")
    s = [r[0] for r in d.select(Sc.residual_score({k: F.col(k) for k in "abc"})).collect()]
    assert s[0] == 100 and round(s[1], 6) == 70 and s[2] == 0
    assert col(spark, Sc.score_bucket, [70.0, 69.999], "double") == ["OK", "LOW"]


def test_paths_and_times(spark):
    assert col(spark, lambda c: P.glob_match(c, "exports/runs/**/geometry_manifest.json"), ["exports/runs/a/b/geometry_manifest.json", "x/geometry_manifest.json"]) == [True, False]
    assert col(spark, P.is_safe_relative, ["a/b.json", "/a", "C:/a", "a/../b"]) == [True, False, False, False]
    assert col(spark, P.gate_codes, ['"A"', '["A","B"]', "[]", None]) == [["A"], ["A", "B"], [], []]
    assert col(spark, T.created_at_code, ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.123Z", "2024-01-01", None]) == ["OK", "MILLIS", "FORMAT", "MISSING"]
    secs = col(spark, lambda c: F.unix_timestamp(T.event_time(c)), ["2024-01-01T09:00:00+09:00", "2024-01-01T00:00:00", "bad"])
    assert secs == [1704067200, 1704067200, None]


def test_quantiles_with_a_hot_group(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", float(v)) for v in rng.normal(size=3000)] + [("few", float(v)) for v in (1, 2, 3, 10)] + [("same", 5.0)] * 50
    rows += [(None, 1.0), (None, 3.0), ("empty", None)]
    d = spark.createDataFrame(rows, "g string, v double")
    probs = {"p01": 0.01, "p50": 0.5, "p90": 0.9}
    got = {r["g"]: r for r in scale.order_stats(d, ["g"], "v", probs, splits=16).collect()}
    for g in ("hot", "few", "same", None):
        values = [v for k, v in rows if k == g]
        assert got[g]["n_values"] == len(values)
        for n, p in probs.items():
            assert got[g][n] == pytest.approx(np.quantile(values, p), abs=1e-12)
    assert got["empty"]["n_rows"] == 1 and got["empty"]["n_values"] == 0 and got["empty"]["p50"] is None
    near = {r["g"]: r["q"] for r in scale.exact_quantiles(d, ["g"], "v", {"q": 0.95}, nearest=True).collect()}
    hot = sorted(v for k, v in rows if k == "hot")
    assert near["hot"] == hot[min(int(len(hot) * 0.95), len(hot) - 1)]


def test_running_sum_and_neighbour(spark):
    rows = [(i % 3 if i % 2 else 0, i, i % 5) for i in range(400)]
    d = spark.createDataFrame(rows, "k int, o long, v int")
    run = scale.running_sum(d, ["k"], ["o"], "v", F.floor(F.col("o") / 17), "r").collect()
    back = scale.neighbour(d, ["k"], ["o"], ["v"], F.floor(F.col("o") / 17), False, "p_").collect()
    for k in (0, 1, 2):
        mine = [r for r in rows if r[0] == k]
        total, prev = 0, None
        want_run, want_prev = {}, {}
        for _, o, v in mine:
            total += v
            want_run[o], want_prev[o], prev = total, prev, v
        assert {r["o"]: r["r"] for r in run if r["k"] == k} == want_run
        assert {r["o"]: r["p_v"] for r in back if r["k"] == k} == want_prev


def ring_mesh(spark, levels=11, n=8, r=0.3):
    rows = []
    for l in range(levels):
        for i in range(n):
            a = 2 * math.pi * i / n
            rows.append(("ring", len(rows), r * math.cos(a), l / (levels - 1), r * math.sin(a)))
    return spark.createDataFrame(rows, "case_id string, vertex_id long, x double, y double, z double")


def test_ring_mesh(spark):
    v = ring_mesh(spark)
    boxes = G.bounding_boxes(v)
    b = one(boxes)
    assert b["height_m"] == 1.0 and round(b["span_x"], 6) == 0.6 and b["longest_axis"] == "y"
    per = 16 * 0.3 * math.sin(math.pi / 8)
    slices = L.slice_table(L.slice_points(v, boxes, L.CIRC_BANDS)).collect()
    assert slices and all(s["n_points"] == 8 for s in slices)
    assert all(abs(s["perimeter_m"] - per) < 1e-5 for s in slices)
    rings = L.loop_quality(L.ordered_rings(v.where("y = 0.5"), ["case_id"])).first()
    assert rings["perimeter_m"] == pytest.approx(per, abs=1e-9) and rings["validity"] == "VALID"
    w = {r["key"]: r for r in G.band_widths(v, boxes).collect()}
    assert round(w["WAIST"]["width_m"], 6) == 0.6 and w["CHEST"]["width_m"] is None
    out = {r["standard_key"]: r["value"] for r in jobs.measure(v).collect()}
    assert out["HEIGHT_M"] == 1.0 and out["BUST_CIRC_M"] == pytest.approx(per, abs=1e-5)


def test_hull_against_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = np.round(rng.normal(size=(5000, 2)), 3)
    rows = [("a", i, float(x), float(z)) for i, (x, z) in enumerate(pts)] + [("line", i, i / 10, i / 5) for i in range(6)] + [("two", i, float(i), 0.0) for i in range(2)]
    d = spark.createDataFrame(rows, "g string, vertex_id long, x double, z double").repartition(5)
    got = {r["g"]: r for r in L.hull_measures(d, ["g"]).collect()}

    def brute(p):
        p = np.unique(p, axis=0)
        c = p.mean(axis=0)
        start = p[np.argmax(((p - c) ** 2).sum(axis=1))]
        total, cur = 0.0, start
        while True:
            nxt = p[0] if not np.array_equal(p[0], cur) else p[1]
            for q in p:
                cr = (nxt[0] - cur[0]) * (q[1] - cur[1]) - (nxt[1] - cur[1]) * (q[0] - cur[0])
                if cr < 0 or (cr == 0 and ((q - cur) ** 2).sum() > ((nxt - cur) ** 2).sum()):
                    nxt = q
            total += float(np.hypot(*(nxt - cur)))
            cur = nxt
            if np.array_equal(cur, start):
                return total

    assert got["a"]["perimeter_m"] == pytest.approx(brute(pts), abs=1e-6) and got["a"]["n_points"] == 5000
    assert got["line"]["perimeter_m"] == pytest.approx(2 * math.hypot(0.5, 1.0), abs=1e-9)
    assert got["two"]["perimeter_m"] is None and got["two"]["error"] is None


def test_slice_parts_against_brute_force(spark):
    rng = np.random.default_rng(5)
    pts = np.round(np.vstack([rng.normal(0, 0.02, (300, 2)), rng.normal(0.3, 0.01, (200, 2)), [[1, 1], [1.004, 1], [1.002, 1.003]]]), 6)
    rows = [("c", "K", 0, float(x), float(z)) for x, z in pts]
    d = spark.createDataFrame(rows, "case_id string, key string, slice int, x double, z double")
    got = sorted(r["n_points"] for r in L.slice_parts(d, 0.01).collect())
    q = np.round(pts / 1e-6).astype(np.int64)
    left, sizes = set(range(len(q))), []
    while left:
        todo, part = [left.pop()], 0
        while todo:
            i = todo.pop()
            part += 1
            near = [j for j in left if ((q[i] - q[j]) ** 2).sum() < 10_000**2]
            left -= set(near)
            todo += near
        if part >= 3:
            sizes.append(part)
    assert got == sorted(sizes)


def test_mesh_text(spark, tmp_path):
    text = "o m\nv 0 0 0\nv 1 0 0\nv 0 1 0\nv 2 0 0\nv x 0 0\nf 1 2 3\nf 1/1 2/2/2 4//1\nf 1 2\n"
    (tmp_path / "m.obj").write_text(text)
    verts, faces = records.read_obj(spark, str(tmp_path))
    assert [r["x"] for r in verts.orderBy("vertex_id").collect()] == [0, 1, 0, 2]
    assert [r["idx"] for r in faces.orderBy("face_id").collect()] == [[0, 1, 2], [0, 1, 3]]
    q = one(G.mesh_quality(G.face_quality(faces, verts)))
    assert (q["n_faces"], q["n_invalid"], q["min_area"], q["invalid_face_flag"]) == (2, 1, 0.0, True)


def test_event_log_source(spark, tmp_path):
    lines = ['{"ts":"2024-01-01T00:00:00Z","module":"body","event":"round_end","gate_codes":["A"]}', "not json", "", '{"module":"body","gate_code":"B","warnings":["[C] x"]}', "[1]"]
    (tmp_path / "log.jsonl").write_text("﻿" + "\n".join(lines))
    e = records.read_events(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in e] == [1, 4] and e[0]["event_type"] == "round_end"
    assert (e[0]["gate_codes"], e[1]["gate_codes"]) == ('["A"]', "B")
    every = records.read_events(spark, str(tmp_path), "report")
    assert sorted(r["ordinal"] for r in every.where("bad_line").collect()) == [2, 5]


def test_curate_job(spark, tmp_path):
    head = "제목,,,,\n,,,,\n,표준 측정항목 명,키,허리둘레,없는키\n,표준 측정항목 코드,A1,A2,A3\n1.0 HUMAN_ID,성별,,,나이\n"
    rows = [f"{i:08d},남,{1700 + i}.0,{700 + i},{20 + i % 50}" for i in range(120)] + ['00000999,여,9999,"1,2",30']
    mapping = """{"version":"2","keys":[
      {"standard_key":"HUMAN_ID","ko_term":"id","sources":{"7th":{"column":"1.0 HUMAN_ID","present":true},"8th_3d":{"column":"1.0 HUMAN_ID","present":true}}},
      {"standard_key":"SEX","ko_term":"sex","sources":{"7th":{"column":"성별","present":true},"8th_3d":{"column":"성별","present":true}}},
      {"standard_key":"AGE","ko_term":"age","sources":{"7th":{"column":"나이","present":true},"8th_3d":{"column":"나이","present":true}}},
      {"standard_key":"HEIGHT_M","ko_term":"h","sources":{"7th":{"column":"키","present":true},"8th_3d":{"column":"키","present":true}}},
      {"standard_key":"WAIST_CIRC_M","ko_term":"w","sources":{"7th":{"column":"허리둘레","present":true},"8th_3d":{"column":"허리둘레","present":true}}},
      {"standard_key":"NECK_CIRC_M","ko_term":"n","sources":{"7th":{"column":null,"present":false},"8th_3d":{"column":"목","present":true}}}]}"""
    head = head.replace("없는키", "나이").replace(",성별,,,나이", ",성별,,,")
    (tmp_path / "map.json").write_text(mapping, encoding="utf-8")
    sheets = {}
    for s, enc in (("7th", "cp949"), ("8th_3d", "utf-8-sig")):
        p = tmp_path / f"{s}.csv"
        p.write_bytes((head + "\n".join(rows) + "\n").encode(enc))
        sheets[s] = str(p)
    table, warnings, report = jobs.curate(spark, sheets, str(tmp_path / "map.json"))
    got = table.where("HUMAN_ID = '00000005'").collect()
    assert len(got) == 2 and all(r["HEIGHT_M"] == 1.705 for r in got)
    by = {r["_source"]: r for r in got}
    assert by["7th"]["SEX"] == "M" and by["7th"]["WAIST_CIRC_M"] == 0.705 and by["8th_3d"]["WAIST_CIRC_M"] == 7.05
    assert table.where("AGE > 59 or AGE < 20").isEmpty()
    reasons = {(r["source"], r["column"], r["reason"]) for r in warnings.collect()}
    assert ("7th", "NECK_CIRC_M", "column_not_present") in reasons and ("8th_3d", "NECK_CIRC_M", "column_not_found") in reasons
    assert ("7th", "HEIGHT_M", "unit_conversion_applied") in reasons and ("8th_3d", "NECK_CIRC_M", "ALL_NULL_BY_SOURCE") in reasons
    assert ("7th", "HEIGHT_M", "SENTINEL_MISSING") in reasons and ("7th", "NECK_CIRC_M", "ALL_NULL_EXTRACTED") in reasons
    assert ("7th", "AGE", "age_filter_applied") in reasons and ("7th", "WAIST_CIRC_M", "CROSS_SOURCE_SUSPECTED") in reasons
    assert ("7th", "NECK_CIRC_M", "value_missing") in reasons
    assert {r["n_rows"] for r in report.collect()} == {121}
    jobs.write_curation(table, warnings, str(tmp_path / "out"))
    assert sinks.read_curated(spark, str(tmp_path / "out/curated")).count() == table.count()


def test_header_names():
    assert survey.dedupe_names(["a", "b", "a", "a"]) == ["a", "b", "a__dup1", "a__dup2"]


def test_subset_policy(spark):
    keys = ["BUST_CIRC_M", "WAIST_CIRC_M", "HIP_CIRC_M"]
    schema = "case_id string, " + ", ".join(f"{k} double" for k in keys)
    soft = spark.createDataFrame([("a", None, 0.7, 0.9), ("b", 0.8, 0.7, 0.9)], schema)
    bad = spark.createDataFrame([("a", None, None, 0.9), ("b", 0.8, 0.7, 0.9)], schema)
    assert one(A.subset_nullness(soft, keys))["code"] == "U1_SUBSET_NULL_SOFT"
    assert one(A.subset_nullness(bad, keys))["code"] == "U1_SUBSET_NULL_DEGRADED_HIGH"


def test_gate(spark):
    s = spark.createDataFrame([(88.0, 0, 0.8, 0.9, -0.7, 0.9)], "score_p90 double, failures int, p90_B double, p90_W double, p90_H double, fraction_above double")
    assert one(D.gate(s, "BWH", 70, 1.0, 0))["candidate"] is True
    tight = one(D.gate(s, "BWH", 70, 0.8, 0))
    assert tight["candidate"] is False and tight["failed_rules"] == "residual_W"


def test_documents(spark):
    docs = spark.createDataFrame([('{"a":NaN}',), ("[1]",), ('{"a":1}',), ('{"t":"NaN here"}',)], "doc string")
    assert [r["v"] is None for r in C.parse(docs).selectExpr("cast(v as string) v").collect()] == [True, True, False, False]


def test_cluster_is_deterministic(spark):
    rng = np.random.default_rng(17)
    rows = [(f"case-{i * 3 % 31}", *map(float, rng.normal(1.0 + (i % 2) / 4, 0.02, 3))) for i in range(31)]
    cols = ["BUST_CIRC_M", "WAIST_CIRC_M", "HIP_CIRC_M"]
    d = spark.createDataFrame(rows, "subject_id string, " + ", ".join(f"{c} double" for c in cols))
    a = jobs.cluster(d.repartition(3), cols, 2, "subject_id")
    b = jobs.cluster(d.repartition(7), cols, 2, "subject_id")
    assert np.array_equal(a["centroids"], b["centroids"])
    count = lambda r: sorted(x["n"] for x in r["assignments"].groupBy("cluster").agg(F.count("*").alias("n")).collect())
    assert count(a) == count(b) and sum(count(a)) == 31
    lib = K.library_kmeans(d, cols, 2, restarts=2)
    assert np.array_equal(lib, K.library_kmeans(d, cols, 2, restarts=2))
