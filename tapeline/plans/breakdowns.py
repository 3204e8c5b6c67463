"""Queries that break results, fits and comparisons down: failures, diagnostics, extremes, signals, existence."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.functions import scoring as P
from tapeline.operators import compare as D
from tapeline.operators import contracts as K
from tapeline.operators import diagnostics as A
from tapeline.plans.documents import FILES, _files
from tapeline.plans.inputs import RESIDUALS, RESULTS, SURVEY_RAW, residuals, results, survey_raw, with_sql
from tapeline.plans.registry import query, table
from tapeline.plans.runs import DAYS, GATE_SUMMARY, RATES, U1_KEYS, _cur_prev, _gate_summary, _scored, r
from tapeline.sources import sinks
from tapeline.sources.shared import scratch

FAILED = """failed AS (SELECT *, CASE WHEN k < 3 THEN 'slice is empty at level ' || CAST(k AS VARCHAR) WHEN k < 10 THEN 'too few points in section' WHEN k >= 95 THEN repeat('long message ', 20) || CAST(k AS VARCHAR)
    WHEN k >= 90 THEN 'cannot convert' ELSE NULL END AS message,
  CASE WHEN k < 10 THEN 'ValueError' WHEN k >= 95 THEN 'RuntimeError' WHEN k >= 90 THEN 'TypeError' END AS kind FROM results WHERE value IS NULL),
fk AS (SELECT standard_key, coalesce(split_part(warnings[1], ':', 1), 'UNKNOWN') AS reason, kind AS exception_type, substr(md5(kind || ':' || substr(coalesce(message, ''), 1, 200)), 1, 8) AS fingerprint,
  CASE WHEN contains(message, 'empty') THEN 'SLICE_EMPTY' WHEN contains(message, 'too few') THEN 'TOO_FEW_POINTS' WHEN kind IN ('ValueError', 'TypeError', 'IndexError') THEN 'NUMERIC_ERROR' ELSE 'UNHANDLED_EXCEPTION' END AS sub_code FROM failed),
fl AS (SELECT standard_key, 'reason' AS kind, reason AS item FROM fk UNION ALL SELECT standard_key, 'exception_type', exception_type FROM fk
  UNION ALL SELECT standard_key, 'fingerprint', fingerprint FROM fk UNION ALL SELECT standard_key, 'sub_code', sub_code FROM fk),
fc AS (SELECT standard_key, kind, item, count(*) AS n FROM fl WHERE item IS NOT NULL GROUP BY 1, 2, 3)"""


@query(
    "failure_breakdown", "A18",
    with_sql(RESULTS, FAILED, """
SELECT standard_key, kind, item, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY standard_key, kind ORDER BY n DESC, item) AS rank FROM fc) WHERE rank <= 5"""),
)
def failure_breakdown(spark, sf):
    k = F.col("k")
    kind = F.when(k < 10, "ValueError").when(k >= 95, "RuntimeError").when(k >= 90, "TypeError")
    message = (
        F.when(k < 3, F.concat(F.lit("slice is empty at level "), k.cast("string"))).when(k < 10, "too few points in section")
        .when(k >= 95, F.concat(F.repeat(F.lit("long message "), 20), k.cast("string"))).when(k >= 90, "cannot convert")
    )
    failed = results(spark, sf).where("value IS NULL")
    reason = F.coalesce(F.substring_index(F.try_element_at("warnings", F.lit(1)), ":", 1), F.lit("UNKNOWN"))
    kinds = {"reason": reason, "exception_type": kind, "fingerprint": A.exception_fingerprint(kind, message), "sub_code": A.exec_fail_subcode(kind, message)}
    return A.failure_breakdown(failed, ["standard_key"], kinds)


SKIPS = """oc AS (SELECT case_id, k % 4 <> 1 AS has_mesh_path, CASE WHEN k < 10 THEN 'load' WHEN k < 50 THEN 'measure' ELSE 'sink' END AS stage,
  CASE WHEN k < 10 THEN 'verts_missing' WHEN k >= 90 THEN 'sink_skip' WHEN k BETWEEN 55 AND 64 THEN 'exec_fail' WHEN k % 11 = 0 THEN 'r' || CAST(k AS VARCHAR) ELSE 'success' END AS reason FROM results),
sk AS (SELECT * FROM oc WHERE has_mesh_path AND reason <> 'success'),
sl AS (SELECT case_id, 'reason' AS kind, reason AS item FROM sk UNION ALL SELECT case_id, 'stage', stage FROM sk),
sr AS (SELECT kind, item, count(*) AS n FROM sl GROUP BY 1, 2),
si AS (SELECT item, string_agg(case_id, ',' ORDER BY case_id) AS sample_ids FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY case_id) AS rn FROM (SELECT DISTINCT item, case_id FROM sl WHERE kind = 'reason')) WHERE rn <= 3 GROUP BY 1)"""


@query(
    "enabled_skips", "A19",
    with_sql(RESULTS, SKIPS, """
SELECT t.kind, t.item, t.n, coalesce(t.rank, 0) AS rank, coalesce(si.sample_ids, '') AS sample_ids FROM (
  SELECT kind, item, n, row_number() OVER (PARTITION BY kind ORDER BY n DESC, item) AS rank FROM sr) t LEFT JOIN si ON t.kind = 'reason' AND si.item = t.item WHERE t.rank <= 10
UNION ALL SELECT 'outcome', reason, count(*), 0, '' FROM oc GROUP BY 2"""),
)
def enabled_skips(spark, sf):
    k = F.col("k")
    outcomes = results(spark, sf).select(
        "case_id", (k % 4 != 1).alias("has_mesh_path"), F.when(k < 10, "load").when(k < 50, "measure").otherwise("sink").alias("stage"),
        F.when(k < 10, "verts_missing").when(k >= 90, "sink_skip").when(k.between(55, 64), "exec_fail")
        .when(k % 11 == 0, F.concat(F.lit("r"), k.cast("string"))).otherwise("success").alias("reason"),
    )
    return A.enabled_skips(outcomes).withColumns({"rank": F.coalesce("rank", F.lit(0)), "sample_ids": F.coalesce("sample_ids", F.lit(""))})


DIAGNOSTICS = """dg AS (SELECT standard_key, CASE WHEN starts_with(case_id, 'normal_') OR starts_with(case_id, 'varied_') THEN 'valid' ELSE 'expected_fail' END AS case_class, k, value,
  CASE WHEN k < 50 THEN k % 13 END AS candidates, CASE WHEN k > 70 AND k % 7 > 0 THEN k % 7 END AS fallback_candidates, CASE WHEN k % 9 = 0 THEN k / 10.0::DOUBLE END AS shift_mm,
  [1.0::DOUBLE, 0.5, 0.1, 0.01, 10, 100, 1.3][k % 7 + 1] * (1 + (k % 3) / 100.0::DOUBLE) AS factor FROM results),
lg AS (SELECT standard_key, case_class, unnest([{'f': 'candidates_count', 'v': candidates::DOUBLE}, {'f': 'fallback_candidates_count', 'v': fallback_candidates::DOUBLE}, {'f': 'shift_mm', 'v': shift_mm},
    {'f': 'scale_factor', 'v': factor}, {'f': 'value', 'v': value}]) AS e FROM dg),
lb AS (SELECT standard_key, case_class, 'reason' AS field, CASE WHEN k < 50 AND candidates = 0 THEN 'mesh_empty_at_height' WHEN k < 5 THEN 'empty_slice' WHEN k BETWEEN 50 AND 54 THEN 'too_thin_slice' END AS item FROM dg
  UNION ALL SELECT standard_key, case_class, 'method', ['hull', 'ordered', 'proxy'][k % 3 + 1] FROM dg UNION ALL SELECT standard_key, case_class, 'fallback', CASE WHEN k % 9 = 0 THEN 'nearest_valid_plane' END FROM dg
  UNION ALL SELECT standard_key, case_class, 'scale_factor', unnest(list_concat(CASE WHEN abs(factor - 1) < 0.02 THEN ['near_1.0'] ELSE [] END, CASE WHEN abs(factor - 0.5) < 0.01 THEN ['near_0.5'] ELSE [] END,
    CASE WHEN abs(factor - 0.1) < 0.002 THEN ['near_0.1'] ELSE [] END, CASE WHEN abs(factor - 0.01) < 0.0002 THEN ['near_0.01'] ELSE [] END, CASE WHEN abs(factor - 10) < 0.2 THEN ['near_10'] ELSE [] END, CASE WHEN abs(factor - 100) < 2 THEN ['near_100'] ELSE [] END)) FROM dg)"""


def _diagnostics(spark, sf):
    k = F.col("k")
    factors = F.array(*[F.lit(float(x)) for x in (1.0, 0.5, 0.1, 0.01, 10, 100, 1.3)])
    d = results(spark, sf).withColumn("case_class", P.case_class(F.lit(None).cast("string"), F.col("case_id"))).withColumns(
        {"candidates": F.when(k < 50, k % 13), "factor": F.element_at(factors, k % 7 + 1) * (1 + (k % 3) / 100.0)}
    )
    numbers = {
        "candidates_count": F.col("candidates"), "fallback_candidates_count": F.when((k > 70) & (k % 7 > 0), k % 7),
        "shift_mm": F.when(k % 9 == 0, k / 10.0), "scale_factor": F.col("factor"), "value": F.col("value"),
    }
    labels = {
        "reason": F.when((k < 50) & (F.col("candidates") == 0), "mesh_empty_at_height").when(k < 5, "empty_slice").when(k.between(50, 54), "too_thin_slice"),
        "method": F.element_at(F.array(*map(F.lit, ("hull", "ordered", "proxy"))), k % 3 + 1),
        "fallback": F.when(k % 9 == 0, "nearest_valid_plane"), "scale_factor": A.scale_marks(F.col("factor")),
    }
    return A.diagnostic_counts(d, ["standard_key", "case_class"], numbers, labels)


@query(
    "diagnostic_numbers", "A17 A22",
    with_sql(RESULTS, DIAGNOSTICS, """
SELECT standard_key, case_class, e.f AS field, count(e.v) AS n_values, count(*) FILTER (WHERE e.v = 0) AS n_zero, round(min(e.v), 6) AS min_value, round(max(e.v), 6) AS max_value,
  round(quantile_cont(e.v, 0.5), 6) AS p50, round(quantile_cont(e.v, 0.95), 6) AS p95 FROM lg WHERE e.v IS NOT NULL GROUP BY 1, 2, 3"""),
)
def diagnostic_numbers(spark, sf):
    out = A.diagnostic_numbers(_diagnostics(spark, sf), ["standard_key", "case_class"])
    return out.select("standard_key", "case_class", "field", "n_values", "n_zero", *[r(c) for c in ("min_value", "max_value", "p50", "p95")])


@query(
    "diagnostic_labels", "A17 A22",
    with_sql(RESULTS, DIAGNOSTICS, """
lc AS (SELECT standard_key, case_class, field, item, count(*) AS n FROM lb WHERE item IS NOT NULL GROUP BY 1, 2, 3, 4),
al AS (SELECT standard_key, case_class, count(*) AS n_all FROM dg GROUP BY 1, 2)""", """
SELECT standard_key, case_class, field, item, n, rank, round(n / n_all::DOUBLE, 6) AS rate FROM (
  SELECT *, row_number() OVER (PARTITION BY standard_key, case_class, field ORDER BY n DESC, item) AS rank FROM lc) JOIN al USING (standard_key, case_class) WHERE rank <= 5"""),
)
def diagnostic_labels(spark, sf):
    out = A.diagnostic_labels(_diagnostics(spark, sf), ["standard_key", "case_class"])
    return out.select("standard_key", "case_class", "field", "item", "n", "rank", r("rate"))


# --- fits -----------------------------------------------------------------------------------------

DOMINANT = """CASE WHEN abs(b) >= abs(w) AND abs(b) >= abs(coalesce(h, 0)) THEN 'TORSO_UPPER' WHEN abs(w) >= abs(coalesce(h, 0)) THEN 'TORSO_MID' ELSE 'TORSO_LOWER' END"""


def _dominant():
    return P.dominant_region(P.ranked_keys({k: F.col(k) for k in U1_KEYS}))


@query(
    "fit_counts", "A29",
    with_sql(RESIDUALS, f"""
kinds AS (SELECT l_returnflag, unnest([{{'kind': 'bucket', 'item': CASE WHEN score >= 70 THEN 'OK' ELSE 'LOW' END}}, {{'kind': 'dominant', 'item': {DOMINANT}}},
  {{'kind': 'failure_type', 'item': CASE WHEN h IS NULL THEN 'ValueError' WHEN abs(w) > 0.09 THEN 'NoConvergence' END}}]) AS e FROM scored)""", """
SELECT l_returnflag, e.kind AS kind, e.item AS item, count(*) AS n FROM kinds WHERE e.item IS NOT NULL GROUP BY 1, 2, 3"""),
)
def fit_counts(spark, sf):
    failure = F.when(F.col("HIP_CIRC_M").isNull(), "ValueError").when(F.abs("WAIST_CIRC_M") > 0.09, "NoConvergence")
    kinds = {"bucket": P.score_bucket(F.col("score")), "dominant": _dominant(), "failure_type": failure}
    return A.fit_counts(_scored(spark, sf), ["l_returnflag"], kinds)


@query(
    "residual_extremes", "A30",
    with_sql(RESIDUALS, f"""
sx AS (SELECT l_orderkey, l_linenumber, round(score, 5) AS score, round(b * 100, 5) AS bust_cm, round(w * 100, 5) AS waist_cm, coalesce(round(h * 100, 5), 0) AS hip_cm, {DOMINANT} AS dominant FROM scored),
wo AS (SELECT 'worst' AS side, row_number() OVER (ORDER BY score, l_orderkey, l_linenumber) AS rank, * FROM sx),
be AS (SELECT 'best' AS side, row_number() OVER (ORDER BY score DESC, l_orderkey, l_linenumber) AS rank, * FROM sx)""", """
SELECT * FROM wo WHERE rank <= 20 UNION ALL SELECT * FROM be WHERE rank <= 20"""),
)
def residual_extremes(spark, sf):
    d = _scored(spark, sf)
    cm = lambda k, n: F.coalesce(F.round(F.col(k) * 100, 5), F.lit(0.0)).alias(n)
    fits = d.select("l_orderkey", "l_linenumber", r("score", digits=5), *[cm(k, n) for k, n in zip(U1_KEYS, ("bust_cm", "waist_cm", "hip_cm"))], _dominant().alias("dominant"))
    return A.extremes(fits, "score", ["l_orderkey", "l_linenumber"])


@query(
    "sign_patterns", "A30",
    with_sql(RESIDUALS, """
sg AS (SELECT concat_ws(',', CASE WHEN b > 0 THEN '+' WHEN b < 0 THEN '-' ELSE '0' END, CASE WHEN w > 0 THEN '+' WHEN w < 0 THEN '-' ELSE '0' END, CASE WHEN h > 0 THEN '+' WHEN h < 0 THEN '-' ELSE '0' END) AS pattern FROM scored)""", """
SELECT pattern, count(*) AS n FROM sg GROUP BY 1"""),
)
def sign_patterns(spark, sf):
    pattern = A.sign_pattern([F.col(k) for k in U1_KEYS])
    return residuals(spark, sf).groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "implied_rates", "A32",
    with_sql(RESIDUALS, GATE_SUMMARY, """
SELECT l_returnflag, c.t AS candidate, round(fraction_above, 4) AS implied_ok_fraction, 70 AS at_threshold_score, CASE WHEN c.t = 70 THEN '' ELSE 'fraction_from_summary_single_threshold_only' END AS note
FROM gs, (VALUES (70), (75)) c(t)"""),
)
def implied_rates(spark, sf):
    summary, out = _gate_summary(spark, sf), []
    for candidate in (70, 75):
        rates = D.implied_rates(summary, [candidate], int(P.SCORE_OK)).withColumn("candidate", F.lit(candidate))
        out.append(rates.select("l_returnflag", "candidate", "implied_ok_fraction", "at_threshold_score", "note"))
    return out[0].unionByName(out[1])


@query(
    "method_delta", "A35",
    with_sql(RESIDUALS, """
ml AS (SELECT l_returnflag, l_linestatus AS m, 'HIP' AS key, h * 100 AS v, (l_linenumber = 1)::INT AS nw FROM scored UNION ALL SELECT l_returnflag, l_linestatus, 'WAIST', w * 100, 0 FROM scored
  UNION ALL SELECT l_returnflag, l_linestatus, 'BUST', l_linenumber / 10.0::DOUBLE - l_linenumber / 10.0::DOUBLE, 0 FROM scored),
mp AS (SELECT l_returnflag, m, key, quantile_cont(v, 0.9) AS p90, count(*) - count(v) AS nn, sum(nw) AS nw FROM ml GROUP BY 1, 2, 3),
mo AS (SELECT l_returnflag, key, coalesce(max(p90) FILTER (WHERE m = 'F'), 0) AS a, coalesce(max(p90) FILTER (WHERE m = 'O'), 0) AS b FROM mp WHERE key <> 'HIP' GROUP BY 1, 2),
mh AS (SELECT l_returnflag, max(p90) FILTER (WHERE m = 'F') AS pa, max(p90) FILTER (WHERE m = 'O') AS pb, max(nn) FILTER (WHERE m = 'F') AS na, max(nn) FILTER (WHERE m = 'O') AS nb,
  CAST(max(nw) FILTER (WHERE m = 'F') AS BIGINT) AS wa, CAST(max(nw) FILTER (WHERE m = 'O') AS BIGINT) AS wb FROM mp WHERE key = 'HIP' GROUP BY 1),
mu AS (SELECT l_returnflag, bool_and(abs(a - b) <= greatest(1e-6, 1e-6 * greatest(abs(a), abs(b)))) AS same FROM mo GROUP BY 1)""", """
SELECT l_returnflag, round(pa, 5) AS p90_a, round(pb, 5) AS p90_b, na AS null_a, nb AS null_b, wa AS warnings_a, wb AS warnings_b, same AS others_unchanged, round(pb - pa, 5) AS delta_p90, round(abs(pb) - abs(pa), 5) AS delta_abs_p90
FROM mh JOIN mu USING (l_returnflag)"""),
)
def method_delta(spark, sf):
    d = residuals(spark, sf)
    entry = lambda k, v, w: F.struct(F.lit(k).alias("key"), v.cast("double").alias("residual_cm"), w.cast("long").alias("n_warnings"))
    flat = F.col("l_linenumber") / 10.0 - F.col("l_linenumber") / 10.0
    items = F.array(entry("HIP", F.col("HIP_CIRC_M") * 100, (F.col("l_linenumber") == 1).cast("int")), entry("WAIST", F.col("WAIST_CIRC_M") * 100, F.lit(0)), entry("BUST", flat, F.lit(0)))
    long = d.select("l_returnflag", "l_linestatus", F.inline(items))
    out = D.method_delta(long, "l_linestatus", "F", "O", ["l_returnflag"], "HIP", "n_warnings")
    five = ["p90_a", "p90_b", "delta_p90", "delta_abs_p90"]
    return out.select("l_returnflag", *[r(c, digits=5) for c in five], "null_a", "null_b", "warnings_a", "warnings_b", "others_unchanged")


# --- runs -----------------------------------------------------------------------------------------


@query(
    "degradation_signals", "A34",
    with_sql(RESULTS, RATES, DAYS, """
rs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY rise DESC, standard_key) AS rank FROM (
  SELECT c.run_id, c.standard_key, c.nan_rate - coalesce(p.nan_rate, 0) AS rise FROM cur c LEFT JOIN prv p USING (run_id, standard_key)) WHERE rise > 0) WHERE rank <= 3),
tp AS (SELECT run_id, string_agg(standard_key, ',' ORDER BY rank) AS degraded_keys FROM rs GROUP BY 1),
hn AS (SELECT run_id, quantile_cont(value, 0.5) AS m FROM results WHERE standard_key = 'CLICK_M' GROUP BY 1),
hp AS (SELECT 'run_' || strftime(strptime(substr(run_id, 5), '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') AS run_id, m FROM hn)""", """
SELECT run_id, degraded_keys IS NOT NULL AS degradation_flag, coalesce(degraded_keys, '') AS degraded_keys, round(hn.m - hp.m, 4) AS height_p50_shift
FROM (SELECT DISTINCT run_id FROM results JOIN (SELECT DISTINCT run_id FROM prv) USING (run_id)) LEFT JOIN tp USING (run_id) LEFT JOIN hn USING (run_id) LEFT JOIN hp USING (run_id)"""),
)
def degradation_signals(spark, sf):
    cur, prev = _cur_prev(spark, sf)
    now = results(spark, sf).select("run_id", "standard_key", "value")
    day = F.to_date(F.substring("run_id", 5, 8), "yyyyMMdd")
    then = now.withColumn("run_id", F.concat(F.lit("run_"), F.date_format(F.date_add(day, 1), "yyyyMMdd")))
    out = D.degradation_signals(D.degraded_keys(cur, prev, ["run_id"]), now, then, ["run_id"], "CLICK_M")
    return out.withColumn("height_p50_shift", F.round("height_p50_shift", 4))


@query(
    "conflict_positions", "JN16",
    """
WITH reg AS (SELECT o_orderkey AS position, 'd' || CAST(o_custkey AS VARCHAR) AS run_dir, sha256(o_orderstatus || strftime(o_orderdate, '%Y%m%d')) AS content FROM orders),
pr AS (SELECT c_custkey AS entry_id, 'd' || CAST(c_custkey AS VARCHAR) AS run_dir, sha256('F' || strftime(DATE '1992-01-01' + CAST(c_custkey AS INTEGER), '%Y%m%d')) AS content FROM customer)
SELECT entry_id, 'duplicate_run_dir' AS conflict, position FROM pr JOIN reg USING (run_dir) UNION ALL SELECT entry_id, 'duplicate_content', position FROM pr JOIN reg USING (content)""",
)
def conflict_positions(spark, sf):
    reg = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("position"), F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("run_dir"),
        F.sha2(F.concat("o_orderstatus", F.date_format("o_orderdate", "yyyyMMdd")), 256).alias("content"),
    )
    day = F.date_add(F.lit("1992-01-01").cast("date"), F.col("c_custkey").cast("int"))
    prop = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entry_id"), F.concat(F.lit("d"), F.col("c_custkey").cast("string")).alias("run_dir"),
        F.sha2(F.concat(F.lit("F"), F.date_format(day, "yyyyMMdd")), 256).alias("content"),
    )
    return D.conflict_positions(prop, reg, ["run_dir", "content"])


@query(
    "ease_facts", "A37",
    """
WITH e AS (SELECT p_brand, unnest([{'f': 'bust_ease_ratio', 'g': CASE WHEN p_type <> 'PROMO' THEN p_retailprice END, 'b': CASE WHEN p_size > 5 THEN p_size - 10.0::DOUBLE END},
    {'f': 'hip_ease_ratio', 'g': NULL::DOUBLE, 'b': p_size::DOUBLE}, {'f': 'waist_ease_ratio', 'g': p_retailprice, 'b': p_size + 1.0::DOUBLE}]) AS x FROM part),
rt AS (SELECT p_brand, x.f AS f, x.g / nullif(x.b, 0) AS ratio, CASE WHEN x.b IS NULL OR x.b = 0 THEN 'zero_division' WHEN x.g IS NULL THEN 'missing_key' END AS reason FROM e),
us AS (SELECT p_brand, string_agg(DISTINCT f, ',' ORDER BY f) AS used_keys FROM rt WHERE ratio IS NOT NULL GROUP BY 1),
rr AS (SELECT p_brand, string_agg(reason || ':' || CAST(n AS VARCHAR), ',' ORDER BY reason) AS reasons FROM (SELECT p_brand, reason, count(*) AS n FROM rt WHERE reason IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT p_brand, n_total, n_nan, round(n_nan / n_total::DOUBLE, 6) AS nan_rate, coalesce(used_keys, '') AS used_keys, coalesce(reasons, '') AS reasons
FROM (SELECT p_brand, count(*) AS n_total, count(*) - count(ratio) AS n_nan FROM rt GROUP BY 1) LEFT JOIN us USING (p_brand) LEFT JOIN rr USING (p_brand)""",
)
def ease_facts(spark, sf):
    size, price = F.col("p_size"), F.col("p_retailprice")
    fields = {
        "bust_ease_ratio": P.ease_ratio(F.when(F.col("p_type") != "PROMO", price), F.when(size > 5, size - 10.0)),
        "hip_ease_ratio": P.ease_ratio(F.lit(None).cast("double"), size.cast("double")),
        "waist_ease_ratio": P.ease_ratio(price, size + 1.0),
    }
    out = A.ease_facts(table(spark, sf, "part"), ["p_brand"], fields)
    return out.select("p_brand", "n_total", "n_nan", r("nan_rate"), "used_keys", F.coalesce("reasons", F.lit("")).alias("reasons"))


@query(
    "distinct_warnings", "A43",
    with_sql(FILES, """
mf AS (SELECT run_id, path || ':' || event_type AS place, unnest([upper(event_type), CASE WHEN depth = 1 THEN 'SCALE_' || event_type ELSE '' END]) AS warning FROM (
  SELECT f.*, CASE WHEN path LIKE 'x/%' THEN substr(path, 3, length(path) - 6) ELSE 'none' END AS event_type FROM files f))""", """
SELECT run_id, warning, count(*) AS n, min(place) AS first_place FROM mf WHERE warning <> '' GROUP BY 1, 2"""),
)
def distinct_warnings(spark, sf):
    p = F.col("path")
    kind = F.when(p.startswith("x/"), F.expr("substring(path, 3, length(path) - 6)")).otherwise("none")
    d = _files(spark, sf).withColumn("kind", kind).select(
        "run_id", F.concat("path", F.lit(":"), "kind").alias("place"), F.array(F.upper("kind")).alias("gate_codes"),
        F.array(F.when(F.col("depth") == 1, F.concat(F.lit("SCALE_"), "kind")).otherwise("")).alias("warnings"),
    )
    return K.distinct_warnings(d, ["run_id"], "place")


@query(
    "column_existence", "A14",
    with_sql(SURVEY_RAW, """
ex AS (SELECT source, count(*) AS n_rows, count(HUMAN_ID) AS a, count(KNEE_HEIGHT_M) AS b FROM survey_raw GROUP BY 1)""", """
SELECT source, unnest(['HUMAN_ID', 'KNEE_HEIGHT_M', 'UNDERBUST_CIRC_M']) AS "column", unnest([true, true, false]) AS "exists", unnest([a, b, NULL]) AS non_null_count,
  unnest([n_rows - a, n_rows - b, NULL]) AS null_count, unnest([round(1 - a / n_rows::DOUBLE, 6), round(1 - b / n_rows::DOUBLE, 6), NULL]) AS missing_rate FROM ex"""),
)
def column_existence(spark, sf):
    out = A.column_existence(survey_raw(spark, sf), ["HUMAN_ID", "KNEE_HEIGHT_M", "UNDERBUST_CIRC_M"], ["source"])
    return out.withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "centroids_roundtrip", "S10",
    """
SELECT label AS cluster, count(*) AS n, round(avg(embedding[1]), 6) AS x0, round(avg(embedding[64]), 6) AS x63 FROM embeddings GROUP BY 1""",
)
def centroids_roundtrip(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("cluster"), *[F.element_at("embedding", i + 1).cast("double").alias(f"x{i}") for i in range(64)])
    where = scratch(spark)
    centroids = e.groupBy("cluster").agg(*[F.avg(f"x{i}").alias(f"x{i}") for i in range(64)])
    sinks.write_centroids(centroids, e.select("vec_id", "cluster"), where)
    sizes = sinks.read_curated(spark, f"{where}/assignments").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return sinks.read_curated(spark, f"{where}/centroids").join(sizes, "cluster").select("cluster", "n", r("x0"), r("x63"))
