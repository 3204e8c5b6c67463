"""Breakdowns, signals and the contract and log job on small rows with known answers."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from tapeline.operators import compare as D
from tapeline.operators import contracts as X
from tapeline.operators import diagnostics as A
from tapeline.operators import events as E
from tapeline.operators import geometry as G
from tapeline.operators import plan as L
from tapeline.plans import jobs
from tapeline.sources import records
from tapeline.functions import times


@pytest.mark.parametrize("kind,message,code", [
    ("RuntimeError", "Slice is EMPTY", "SLICE_EMPTY"), ("RuntimeError", "too few vertices", "TOO_FEW_POINTS"), ("RuntimeError", "points < 3", "TOO_FEW_POINTS"),
    ("RuntimeError", "got NaN", "NUMERIC_ERROR"), ("IndexError", "at 3", "NUMERIC_ERROR"), ("KeyError", "x", "UNHANDLED_EXCEPTION"), ("KeyError", None, "UNHANDLED_EXCEPTION"),
])
def test_sub_codes_and_fingerprints(spark, kind, message, code):
    d = spark.createDataFrame([(kind, message)], "kind string, message string")
    r = d.select(A.exec_fail_subcode(F.col("kind"), F.col("message")).alias("c"), A.exception_fingerprint(F.col("kind"), F.col("message")).alias("f")).first()
    assert r.c == code and r.f == hashlib.md5(f"{kind}:{(message or '')[:200]}".encode()).hexdigest()[:8]


def test_fingerprints_look_at_the_start_of_a_message_only(spark):
    rows = [("ValueError", "é" * 200 + "a"), ("ValueError", "é" * 200 + "b"), ("TypeError", "é" * 200), (None, "x")]
    d = spark.createDataFrame(rows, "kind string, message string")
    got = [r.f for r in d.select(A.exception_fingerprint(F.col("kind"), F.col("message")).alias("f")).collect()]
    assert got[0] == got[1] != got[2] and got[3] is None


def test_failure_breakdown_keeps_the_five_commonest(spark):
    rows = [("K", f"r{i}", "ValueError" if i % 2 else None) for i in range(8) for _ in range(i + 1)] + [(None, "r0", "X")]
    d = spark.createDataFrame(rows, "key string, reason string, kind string")
    got = A.failure_breakdown(d, ["key"], {"reason": F.col("reason"), "type": F.col("kind")}).collect()
    assert [(r["item"], r.n) for r in sorted(got, key=lambda r: r["rank"]) if (r.key, r.kind) == ("K", "reason")] == [(f"r{i}", i + 1) for i in range(7, 2, -1)]
    assert [(r["item"], r.n) for r in got if (r.key, r.kind) == ("K", "type")] == [("ValueError", 20)] and sum(r.key is None for r in got) == 2


def test_enabled_skips(spark):
    rows = [(f"c{i}", i % 2 == 0, "load", "verts_missing") for i in range(9)] + [("d1", True, "sink", None), ("d2", None, "load", "verts_missing"), ("e", True, "measure", "success")]
    got = {(r.kind, r["item"]): r for r in A.enabled_skips(spark.createDataFrame(rows, "case_id string, has_mesh_path boolean, stage string, reason string")).collect()}
    r = got[("reason", "verts_missing")]
    assert (r.n, r["rank"], r.sample_ids) == (5, 1, "c0,c2,c4") and got[("stage", "load")].n == 5
    assert got[("outcome", "verts_missing")].n == 10 and got[("outcome", "success")].n == 1 and got[("outcome", "unknown")].n == 1


def test_diagnostics_in_one_pass(spark):
    rows = [("K", float(v), "hull" if v % 2 else None, 0.1001 if v < 3 else 5.0) for v in range(10)] + [("K", None, None, None), (None, 4.0, "box", 1.0)]
    d = spark.createDataFrame(rows, "key string, shift double, method string, factor double")
    counts = A.diagnostic_counts(d, ["key"], {"shift": F.col("shift")}, {"method": F.col("method"), "scale": A.scale_marks(F.col("factor"))})
    n = {(r.key, r.field): r for r in A.diagnostic_numbers(counts, ["key"]).collect()}
    assert (n["K", "shift"].n_values, n["K", "shift"].n_zero, n["K", "shift"].p50, n["K", "shift"].max_value) == (10, 1, 4.5, 9.0)
    assert n[None, "shift"].p95 == 4.0
    labels = {(r.key, r.field, r["item"]): r for r in A.diagnostic_labels(counts, ["key"]).collect()}
    assert labels["K", "method", "hull"].n == 5 and labels["K", "method", "hull"].rate == pytest.approx(5 / 11)
    assert labels["K", "scale", "near_0.1"].n == 3 and labels[None, "scale", "near_1.0"].n == 1


def test_extremes_and_signs(spark):
    d = spark.createDataFrame([(i, float(i % 7)) for i in range(30)] + [(99, None)], "id long, score double")
    got = A.extremes(d, "score", ["id"], 3).collect()
    assert [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.side == "worst"] == [0, 7, 14]
    assert [r.id for r in sorted(got, key=lambda r: r["rank"]) if r.side == "best"] == [6, 13, 20]
    s = spark.createDataFrame([(0.1, -0.1, None)], "a double, b double, c double").select(A.sign_pattern([F.col(c) for c in "abc"])).first()[0]
    assert s == "+,-,0"


def test_degradation_needs_both_sides(spark):
    rates = lambda rows: spark.createDataFrame(rows, "run string, standard_key string, nan_rate double")
    values = lambda rows: spark.createDataFrame(rows, "run string, standard_key string, value double")
    cur, base = rates([("a", "K1", 0.5), ("a", "K2", 0.1), ("b", "K1", 0.0)]), rates([("a", "K1", 0.2), ("b", "K1", 0.4)])
    now = values([("a", "HEIGHT_M", 1.8), ("a", "HEIGHT_M", 1.6), ("b", "HEIGHT_M", 1.7), ("c", "HEIGHT_M", 1.0)])
    then = values([("a", "HEIGHT_M", 1.6), ("b", "K1", 1.0)])
    got = {r.run: r for r in D.degradation_signals(D.degraded_keys(cur, base, ["run"]), now, then, ["run"]).collect()}
    assert set(got) == {"a", "b"} and got["a"].degraded_keys == "K1,K2" and got["a"].height_p50_shift == pytest.approx(0.1)
    assert (got["b"].degradation_flag, got["b"].degraded_keys, got["b"].height_p50_shift) == (False, "", None)


def test_implied_rates_and_missing_share(spark):
    s = spark.createDataFrame([(0.98437,), (float("nan"),), (None,)], "fraction_above double")
    assert [tuple(r)[1:] for r in D.implied_rates(s, [60, 70], 70).collect()] == [(0.9844, 70, ""), (None, None, "FRACTION_NOT_AVAILABLE"), (None, None, "FRACTION_NOT_AVAILABLE")]
    assert D.implied_rates(s, [60], 70).first().note == "fraction_from_summary_single_threshold_only"


def test_existence_of_columns(spark):
    d = spark.createDataFrame([("s", 1), ("s", None)], "source string, HUMAN_ID int")
    got = {r["column"]: tuple(r)[2:] for r in A.column_existence(d, ["HUMAN_ID", "BUST_CIRC_M"], ["source"]).collect()}
    assert got == {"HUMAN_ID": (True, 1, 1, 0.5), "BUST_CIRC_M": (False, None, None, None)}


def test_empty_band_takes_the_nearest_plane(spark):
    """Levels at 0, 0.5 and 1 m; the waist band of 0.5 lies bare, and 8 mm above it stand four vertices."""
    rows = [("a", i, float(i % 2), y, float(i // 2)) for y in (0.0, 0.528, 1.0) for i in range(4)] + [("b", i, 0.1, float(i % 2), 0.2) for i in range(4)]
    v = spark.createDataFrame(rows, "case_id string, vertex_id int, x double, y double, z double")
    w = {(r.case_id, r.key): r for r in G.band_widths(v, G.bounding_boxes(v)).collect()}
    r = w["a", "WAIST"]
    assert (r.width_m, r.depth_m, r.n_points, r.plane_code) == (1.0, 1.0, 4, "NEAREST_VALID_PLANE_FALLBACK") and r.shift_mm == pytest.approx(9.0)
    assert w["a", "CHEST"].width_m is None and w["b", "WAIST"].shift_mm is None and w["b", "WAIST"].n_points == 0
    out = {(r.case_id, r.standard_key): r for r in jobs.measure(v).collect()}
    assert out["a", "WAIST_WIDTH_M"].shift_mm == pytest.approx(9.0) and "NEAREST_VALID_PLANE_FALLBACK" in out["a", "WAIST_WIDTH_M"].code


def test_audit_of_a_tree_and_a_log(spark, tmp_path):
    """The job on files: its findings are those of the single operators on the same rows."""
    run = tmp_path / "runs" / "r1"
    texts = {
        "body/geometry_manifest.json": {"schema_version": "geometry_manifest.v1", "module_name": "body", "artifacts": ["/abs"]},
        "body/body_measurements_subset.json": {"unit": "cm", "pose_id": "PZ1", "measurements": {"BUST_CIRC_M": None}, "warnings": []},
        "fitting/fitting_facts_summary.json": {"garment_input_path_used": "npz", "early_exit": False, "early_exit_reason": None, "warnings_summary": [], "degraded_state": "none"},
        "garment/garment_proxy_meta.json": {"negative_face_area_flag": True, "self_intersection_flag": False, "invalid_face_flag": False}, "garment/other.json": {},
    }
    for name, doc in texts.items():
        (run / name).parent.mkdir(parents=True, exist_ok=True)
        (run / name).write_text(json.dumps(doc))
    (run / "broken").mkdir()
    (run / "broken" / "geometry_manifest.json").write_text("{no json")
    (run / "fitting" / "cloth.npz").write_bytes(b"x")
    lines = [
        {"ts": "2024-01-01T00:00:00Z", "module": "body", "event": "round_start", "step_id": "B1", "status": "OK", "m_level": "M1"},
        {"ts": "2024-01-01T01:00:00Z", "module": "nobody", "event_type": "note"},
        {"ts": "2024-01-01T02:00:00Z", "module": "body", "event_type": "fix", "step_id": "B1", "gate_codes": ["SCHEMA_VIOLATION_BACKFILLED"], "note": "referenced_line=2"},
        {"ts": "2024-01-01T03:00:00Z", "module": "body", "event_type": "round_end", "step_id": "B1", "evidence_paths": ["exports/runs/lane1/run_1/geometry_manifest.json"], "gate_codes": ["U1_SUBSET_NULL_SOFT"]},
        {"module": "garment", "event_type": "round_start", "step_id": "G1"},
    ]
    (tmp_path / "log.jsonl").write_text("\n".join(map(json.dumps, lines)))
    documents = records.read_documents(spark, str(tmp_path / "runs"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path / "runs")).select("path")
    events = records.read_events(spark, str(tmp_path / "log.jsonl")).withColumn("ts_text", F.col("ts")).withColumn("time", times.event_time(F.col("ts")))
    events = events.withColumn("paths", F.coalesce("evidence_paths", F.array().cast("array<string>")))
    steps = spark.createDataFrame([("B1", "body", "P0", "M1"), ("G1", "garment", "P0", "M1"), ("F1", "fitting", "P9", "M1")], "step_id string, module string, phase string, m_level string")
    edges = spark.createDataFrame([("F1", "G1", "M1"), ("G1", "B1", "M0")], "step_id string, from_step string, min_level string")
    ledger = [{"consumer_module": "fitting", "gate_code": "BODY_MANIFEST_MISSING", "enforcement_u1": "warn", "required_paths_any": ["exports/runs/**/geometry_manifest.json"]}]
    registry = E.registry_records(events).limit(0)
    now = F.lit("2024-01-01T12:00:00Z").cast("timestamp")
    out = jobs.audit(documents.withColumnRenamed("folder", "label"), files, events, steps, edges, ledger, registry, now)
    found = out.findings.collect()
    of = lambda area: {(r.subject, r.code) for r in found if r.area == area}
    assert of("log") == {(str(r.ordinal), r.code) for r in E.without_exempted(E.schema_findings(events), events).collect()} == {("5", "TS_MISSING")}
    assert of("lint") == {("F1", "bad_phase")} and of("plan") == {("F1", "STEP_BLOCKED")}
    assert of("ledger") == {("nobody", "BODY_MANIFEST_MISSING"), ("garment", "BODY_MANIFEST_MISSING")}
    assert of("blocker") == {(None, r.code) for r in E.blockers(events).collect()}
    assert of("balance") == {("garment", "ROUND_END_MISSING")}
    manifest = X.parse(documents.where(F.col("path").endswith("geometry_manifest.json")).drop("v"))
    want = {(r.path, r.label) for r in X.check_rows(manifest, ["path"], X.manifest_checks(F.col("v"))).where("severity <> 'PASS'").collect()}
    assert of("manifest") == want and any(label == "parse" and "broken" in path for path, label in want)
    assert {c for _, c in of("body")} == {"unit", "missingness", "BUST_CIRC_M", "WAIST_CIRC_M", "HIP_CIRC_M"}
    assert of("fitting") == set() and {c for _, c in of("garment")} == {"negative_face_area_flag", "hard_gate", "mesh"}
    assert [(r.lane, r.run_id) for r in out.registry.collect()] == [("lane1", "run_1")]
    assert {r.step_id: r.state for r in out.plan.collect()} == {"B1": "done", "G1": "ready", "F1": "blocked"}
    assert out.severities.count() == 5
