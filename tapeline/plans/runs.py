"""Queries over measurement results and runs: facts, KPI, differences, scores, gates, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.functions import numbers as N
from tapeline.functions import scoring as P
from tapeline.operators import cluster as K
from tapeline.operators import compare as D
from tapeline.operators import facts as A
from tapeline.operators.scale import first_k
from tapeline.plans.inputs import RESIDUALS, RESULTS, residuals, results, with_sql
from tapeline.plans.registry import query, table



def r(c, name=None, digits=6):
    return F.round(F.col(c) if isinstance(c, str) else c, digits).alias(name or c)


FACTS_SQL = """count(*) AS n_rows, count(value) AS n_values, count(*) - count(value) AS nan_count,
  round((count(*) - count(value)) / count(*)::DOUBLE, 6) AS nan_rate, min(value) AS min_value, max(value) AS max_value,
  round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 4) AS mean_value"""


def _facts(df, keys):
    return df.select(
        *keys, "n_rows", "n_values", "nan_count", r("nan_rate"), "min_value", "max_value", r("median"), r("mean_value", digits=4)
    )


@query("facts_per_key", "A16 A18", with_sql(RESULTS, f"SELECT standard_key, {FACTS_SQL} FROM results GROUP BY 1"))
def facts_per_key(spark, sf):
    return _facts(A.key_facts(results(spark, sf)), ["standard_key"])


CLASS_SQL = "CASE WHEN starts_with(case_id, 'normal_') OR starts_with(case_id, 'varied_') THEN 'valid' ELSE 'expected_fail' END"


@query(
    "facts_by_class", "A17 P31",
    with_sql(RESULTS, f"SELECT standard_key, {CLASS_SQL} AS case_class, {FACTS_SQL} FROM results GROUP BY 1, 2"),
)
def facts_by_class(spark, sf):
    cls = P.case_class(F.lit(None).cast("string"), F.col("case_id"))
    keys = ["standard_key", "case_class"]
    return _facts(A.key_facts(results(spark, sf).withColumn("case_class", cls), keys), keys)


@query(
    "warnings_topk", "A16 T1",
    with_sql(RESULTS, """
c AS (SELECT standard_key, split_part(w, ':', 1) AS prefix, count(*) AS n FROM (SELECT standard_key, unnest(warnings) AS w FROM results) GROUP BY 1, 2)""", """
SELECT standard_key, prefix, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY standard_key ORDER BY n DESC, prefix) AS rank FROM c) WHERE rank <= 5"""),
)
def warnings_topk(spark, sf):
    return A.top_k_counts(A.prefix_counts(results(spark, sf), ["standard_key"]), ["standard_key"], "prefix", 5)


@query(
    "failure_reasons", "A18",
    with_sql(RESULTS, """
f AS (SELECT standard_key, coalesce(CASE WHEN k < 3 THEN 'empty_slice' END, split_part(warnings[1], ':', 1), 'UNKNOWN') AS reason,
  coalesce(CASE WHEN starts_with(warnings[1], 'EXEC_FAIL:') THEN regexp_extract(warnings[1], '^EXEC_FAIL:(.*)$', 1) END, '') AS sub_code
  FROM results WHERE value IS NULL OR k BETWEEN 55 AND 64)""", """
SELECT standard_key, reason, sub_code, count(*) AS n FROM f GROUP BY 1, 2, 3"""),
)
def failure_reasons(spark, sf):
    bad = results(spark, sf).where(F.col("value").isNull() | F.col("k").between(55, 64))
    w = F.col("warnings")
    none = F.lit(None).cast("string")
    reason = A.failure_reason(w, F.when(F.col("k") < 3, "empty_slice"), none)
    return bad.groupBy(
        "standard_key", reason.alias("reason"), F.coalesce(A.exec_fail_code(w), F.lit("")).alias("sub_code")
    ).agg(F.count("*").alias("n"))


@query(
    "flag_rates", "A17",
    with_sql(RESULTS, """
SELECT standard_key, count(*) AS n_rows, round(avg(CASE WHEN k % 4 = 0 THEN 1.0 ELSE 0 END)::DOUBLE, 6) AS proxy_used,
  round(avg(CASE WHEN k > 70 THEN 1.0 ELSE 0 END)::DOUBLE, 6) AS band_scan_used, round(avg(CASE WHEN value > 200 THEN 1.0 ELSE 0 END)::DOUBLE, 6) AS slice_shared FROM results GROUP BY 1"""),
)
def flag_rates(spark, sf):
    out = A.flag_rates(
        results(spark, sf), ["standard_key"],
        {"proxy_used": F.col("k") % 4 == 0, "band_scan_used": F.col("k") > 70, "slice_shared": F.col("value") > 200},
    )
    return out.select("standard_key", "n_rows", r("proxy_used"), r("band_scan_used"), r("slice_shared"))


@query(
    "first_qualifying_key", "W8",
    with_sql(RESULTS, """
SELECT run_id || '/' || case_id AS case_id, ['VIEW_M', 'CLICK_M', 'ERROR_M'][min(CASE standard_key WHEN 'VIEW_M' THEN 1 WHEN 'CLICK_M' THEN 2 ELSE 3 END)] AS first_key, count(*) AS n_qualifying
FROM results WHERE standard_key IN ('VIEW_M', 'CLICK_M', 'ERROR_M') AND value > 20 GROUP BY 1"""),
)
def first_qualifying_key(spark, sf):
    d = results(spark, sf).withColumn("case_id", F.concat_ws("/", "run_id", "case_id"))
    return A.first_qualifying(d, ["VIEW_M", "CLICK_M", "ERROR_M"], F.col("value") > 20)


OUTCOMES = """outcomes AS (SELECT case_id, event_id AS seq, CASE WHEN k < 10 THEN 'load' WHEN k < 50 THEN 'measure' ELSE 'sink' END AS stage,
  CASE WHEN k < 10 THEN 'verts_missing' WHEN k >= 90 THEN 'sink_skip' WHEN k BETWEEN 55 AND 64 THEN 'exec_fail' ELSE 'success' END AS reason FROM results)"""


def _outcomes(spark, sf):
    k = F.col("k")
    return results(spark, sf).select(
        "case_id", F.col("event_id").alias("seq"),
        F.when(k < 10, "load").when(k < 50, "measure").otherwise("sink").alias("stage"),
        F.when(k < 10, "verts_missing").when(k >= 90, "sink_skip").when(k.between(55, 64), "exec_fail").otherwise("success").alias("reason"),
    )


@query(
    "outcome_audit", "A19",
    with_sql(RESULTS, OUTCOMES, """
ids AS (SELECT stage, reason, string_agg(case_id, ',' ORDER BY case_id) AS sample_ids FROM (
  SELECT *, row_number() OVER (PARTITION BY stage, reason ORDER BY case_id) AS rn FROM (SELECT DISTINCT stage, reason, case_id FROM outcomes)) WHERE rn <= 3 GROUP BY 1, 2)""", """
SELECT stage, reason, n, n_cases, sample_ids FROM (SELECT stage, reason, count(*) AS n, count(DISTINCT case_id) AS n_cases FROM outcomes GROUP BY 1, 2) JOIN ids USING (stage, reason)"""),
)
def outcome_audit(spark, sf):
    return A.outcome_audit(_outcomes(spark, sf))


@query(
    "duplicate_cases", "A20",
    with_sql(RESULTS, "SELECT case_id, count(*) AS n FROM results GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, case_id LIMIT 10"),
)
def duplicate_cases(spark, sf):
    return A.duplicate_cases(results(spark, sf))[1]


@query(
    "duplicate_totals", "A20",
    with_sql(RESULTS, """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, count(*) FILTER (WHERE n >= 2) AS n_duplicated FROM (SELECT case_id, count(*) AS n FROM results GROUP BY 1)"""),
)
def duplicate_totals(spark, sf):
    return A.duplicate_cases(results(spark, sf))[0]


@query(
    "one_record_per_case", "A21",
    with_sql(RESULTS, OUTCOMES, """
lg AS (SELECT * FROM outcomes WHERE reason <> 'success'),
f AS (SELECT case_id, reason AS outcome FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY seq) AS rn FROM lg WHERE stage = 'load') WHERE rn = 1)""", """
SELECT outcome, count(*) AS n FROM (SELECT c.case_id, coalesce(f.outcome, 'missing_record') AS outcome FROM (SELECT DISTINCT case_id FROM results) c LEFT JOIN f USING (case_id)) GROUP BY 1"""),
)
def one_record_per_case(spark, sf):
    logged = _outcomes(spark, sf).where((F.col("reason") != "success") & (F.col("stage") == "load"))
    out = A.fill_outcomes(results(spark, sf), logged.withColumnRenamed("reason", "outcome"))
    return out.groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    "log_gaps", "JN8",
    with_sql(RESULTS, OUTCOMES, """
e AS (SELECT DISTINCT run_id || '/' || case_id AS c FROM results), l AS (SELECT DISTINCT run_id || '/' || case_id AS c FROM results WHERE k >= 30),
s AS (SELECT DISTINCT run_id || '/' || case_id AS c FROM results WHERE k >= 60), p AS (SELECT DISTINCT run_id || '/' || case_id AS c FROM results WHERE k >= 70),
v AS (SELECT DISTINCT run_id || '/' || case_id AS c FROM results WHERE k >= 85)""", """
SELECT 'entered_not_logged' AS gap, count(*) AS n FROM (FROM e EXCEPT FROM l) UNION ALL
SELECT 'success_not_processed', count(*) FROM (FROM s EXCEPT FROM p) UNION ALL SELECT 'processed_without_verts', count(*) FROM (FROM p EXCEPT FROM v)"""),
)
def log_gaps(spark, sf):
    c = results(spark, sf).select(F.concat_ws("/", "run_id", "case_id").alias("case_id"), "k")
    at = lambda n: c.where(F.col("k") >= n)
    logged = at(30).withColumn("outcome", F.when(F.col("k") >= 60, "success").otherwise("skip"))
    return A.log_gaps(c, logged, at(70), at(85)).groupBy("gap").agg(F.count("*").alias("n"))


@query(
    "field_summary", "A22",
    with_sql(RESULTS, """
l AS (SELECT standard_key, 'k' AS field, k::DOUBLE AS v FROM results UNION ALL SELECT standard_key, 'value', value FROM results)""", """
SELECT standard_key, field, count(*) AS n_rows, count(v) AS n_values, min(v) AS min_value, max(v) AS max_value, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.95), 6) AS p95 FROM l GROUP BY 1, 2"""),
)
def field_summary(spark, sf):
    out = A.field_summary(results(spark, sf), ["standard_key"], ["k", "value"])
    return out.select("standard_key", "field", "n_rows", "n_values", "min_value", "max_value", r("p50"), r("p95"))


@query(
    "cohort_quality", "A23",
    with_sql(RESULTS, """
SELECT standard_key, cohort, 'value' AS field, count(v) AS n_values, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.95), 6) AS p95
FROM (SELECT standard_key, CASE WHEN k % 7 = 0 THEN 'recovery_used' ELSE 'none' END AS cohort, CASE WHEN value > 0 THEN value END AS v FROM results) GROUP BY 1, 2"""),
)
def cohort_quality(spark, sf):
    d = results(spark, sf).withColumn("cohort", F.when(F.col("k") % 7 == 0, "recovery_used").otherwise("none"))
    out = A.cohort_quality(d, ["standard_key", "cohort"], ["value"])
    return out.select("standard_key", "cohort", "field", "n_values", r("p50"), r("p95"))


@query(
    "validity_histogram", "A23",
    with_sql(RESULTS, """
SELECT standard_key, [3, 5, 7][k % 3 + 1] AS alpha_k, CASE WHEN value IS NULL THEN 'EMPTY' WHEN value < 1 THEN 'TOO_FEW_POINTS' ELSE 'VALID' END AS validity, count(*) AS n FROM results GROUP BY 1, 2, 3"""),
)
def validity_histogram(spark, sf):
    v = F.col("value")
    d = results(spark, sf).select(
        "standard_key", F.element_at(F.array(F.lit(3), F.lit(5), F.lit(7)), F.col("k") % 3 + 1).alias("alpha_k"),
        F.when(v.isNull(), "EMPTY").when(v < 1, "TOO_FEW_POINTS").otherwise("VALID").alias("validity"),
    )
    return A.value_histogram(d, ["standard_key", "alpha_k"], "validity")


PAIRS = """long AS (SELECT run_id || '/' || case_id AS case_id, standard_key, max(value) AS value FROM results GROUP BY 1, 2),
pairs AS (SELECT a.case_id, a.value AS a, b.value AS b, a.value - b.value AS delta, abs(a.value - b.value) AS abs_delta, (a.value - b.value) / nullif(b.value, 0) * 100 AS pct
  FROM long a JOIN long b ON a.case_id = b.case_id AND a.standard_key = 'CLICK_M' AND b.standard_key = 'VIEW_M' WHERE a.value IS NOT NULL AND b.value IS NOT NULL)"""


def _pairs(spark, sf):
    d = results(spark, sf).select(F.concat_ws("/", "run_id", "case_id").alias("case_id"), "standard_key", "value")
    return A.paired_deltas(d, "CLICK_M", "VIEW_M")


@query(
    "delta_pairs", "JN10",
    with_sql(RESULTS, PAIRS, "SELECT case_id, a, b, round(delta, 6) AS delta, round(abs_delta, 6) AS abs_delta, round(pct, 4) AS pct FROM pairs"),
)
def delta_pairs(spark, sf):
    return _pairs(spark, sf).select("case_id", "a", "b", r("delta"), r("abs_delta"), r("pct", digits=4))


@query(
    "delta_stats", "A24",
    with_sql(RESULTS, PAIRS, """
l AS (SELECT 'delta' AS field, delta AS v FROM pairs UNION ALL SELECT 'abs_delta', abs_delta FROM pairs UNION ALL SELECT 'pct', pct FROM pairs)""", """
SELECT field, count(v) AS n_values, round(min(v), 4) AS min_value, round(max(v), 4) AS max_value, round(quantile_cont(v, 0.5), 4) AS p50,
  round(quantile_cont(v, 0.9), 4) AS p90, round(quantile_cont(v, 0.95), 4) AS p95, round(avg(v), 4) AS mean_value FROM l GROUP BY 1"""),
)
def delta_stats(spark, sf):
    return A.delta_stats(_pairs(spark, sf)).select(
        "field", "n_values", *[r(c, digits=4) for c in ("min_value", "max_value", "p50", "p90", "p95", "mean_value")]
    )


SUBSET = """sub AS (SELECT run_id, case_id, max(CASE WHEN standard_key = 'CLICK_M' THEN value END) AS BUST_CIRC_M,
  max(CASE WHEN standard_key = 'VIEW_M' THEN value END) AS WAIST_CIRC_M, max(CASE WHEN standard_key = 'ERROR_M' THEN value END) AS HIP_CIRC_M FROM results GROUP BY 1, 2)"""
U1_KEYS = ["BUST_CIRC_M", "WAIST_CIRC_M", "HIP_CIRC_M"]


def _subset(spark, sf):
    pick = lambda k, n: F.max(F.when(F.col("standard_key") == k, F.col("value"))).alias(n)
    return results(spark, sf).groupBy("run_id", "case_id").agg(
        pick("CLICK_M", U1_KEYS[0]), pick("VIEW_M", U1_KEYS[1]), pick("ERROR_M", U1_KEYS[2])
    )


@query(
    "subset_nullness", "A26",
    with_sql(RESULTS, SUBSET, """
SELECT run_id, count(*) AS n_cases, count(*) - count(BUST_CIRC_M) AS null_BUST_CIRC_M, count(*) - count(WAIST_CIRC_M) AS null_WAIST_CIRC_M, count(*) - count(HIP_CIRC_M) AS null_HIP_CIRC_M,
  max(nn) AS worst, CASE WHEN max(nn) >= 2 THEN 'U1_SUBSET_NULL_DEGRADED_HIGH' WHEN max(nn) = 1 THEN 'U1_SUBSET_NULL_SOFT' ELSE 'NONE' END AS code
FROM (SELECT *, (BUST_CIRC_M IS NULL)::INT + (WAIST_CIRC_M IS NULL)::INT + (HIP_CIRC_M IS NULL)::INT AS nn FROM sub) GROUP BY 1"""),
)
def subset_nullness(spark, sf):
    return A.subset_nullness(_subset(spark, sf), U1_KEYS, ["run_id"])


@query(
    "first_case_legacy", "A27",
    with_sql(RESULTS, SUBSET, """
SELECT run_id, BUST_CIRC_M AS bust, WAIST_CIRC_M AS waist, HIP_CIRC_M AS hip, concat_ws(',', CASE WHEN BUST_CIRC_M IS NULL THEN 'bust' END,
  CASE WHEN WAIST_CIRC_M IS NULL THEN 'waist' END, CASE WHEN HIP_CIRC_M IS NULL THEN 'hip' END) AS missing
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY case_id) AS rn FROM sub) WHERE rn = 1"""),
)
def first_case_legacy(spark, sf):
    return A.first_case(_subset(spark, sf), ["case_id"], dict(zip(U1_KEYS, ("bust", "waist", "hip"))), ["run_id"])


RATES = """rates AS (SELECT run_id, standard_key, (count(*) - count(value)) / count(*)::DOUBLE AS nan_rate FROM results GROUP BY 1, 2)"""


def _rates(spark, sf):
    return results(spark, sf).groupBy("run_id", "standard_key").agg(
        N.ratio(F.count("*") - F.count("value"), F.count("*")).alias("nan_rate")
    )


@query(
    "kpi_top_missing", "A33",
    with_sql(RESULTS, RATES, """
SELECT run_id, standard_key, round(nan_rate, 6) AS nan_rate, rank FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY nan_rate DESC, standard_key) AS rank FROM rates) WHERE rank <= 3"""),
)
def kpi_top_missing(spark, sf):
    return D.kpi(_rates(spark, sf), k=3).select("run_id", "standard_key", r("nan_rate"), "rank")


@query(
    "kpi_values", "A33",
    with_sql(RESULTS, """
SELECT run_id, standard_key, count(value) AS n_values, max(value) AS max_value, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  list_sort(list(value) FILTER (WHERE value IS NOT NULL))[least(CAST(floor(count(value) * 0.95) AS BIGINT), count(value) - 1) + 1] AS nearest_p95 FROM results GROUP BY 1, 2"""),
)
def kpi_values(spark, sf):
    d, keys = results(spark, sf), ["run_id", "standard_key"]
    near = D.nearest_rank(d, keys, "value", {"nearest_p95": 0.95})
    return D.value_kpi(d, keys).join(near, keys).select(*keys, "n_values", "max_value", r("p50"), r("p95"), "nearest_p95")


DAYS = """cur AS (SELECT * FROM rates WHERE NOT (run_id LIKE '%01' AND standard_key = 'VIEW_M')),
prv AS (SELECT 'run_' || strftime(strptime(substr(run_id, 5), '%Y%m%d') + INTERVAL 1 DAY, '%Y%m%d') AS run_id, standard_key, nan_rate FROM rates)"""


def _cur_prev(spark, sf):
    rates = _rates(spark, sf)
    day = F.to_date(F.substring("run_id", 5, 8), "yyyyMMdd")
    prev = rates.withColumn("run_id", F.concat(F.lit("run_"), F.date_format(F.date_add(day, 1), "yyyyMMdd")))
    cur = rates.where(~(F.col("run_id").endswith("01") & (F.col("standard_key") == "VIEW_M")))
    return cur, prev


@query(
    "kpi_diff", "JN9",
    with_sql(RESULTS, RATES, DAYS, """
SELECT run_id, standard_key, round(c.nan_rate, 6) AS current, round(p.nan_rate, 6) AS reference, round(c.nan_rate - p.nan_rate, 6) AS delta,
  CASE WHEN p.nan_rate IS NULL THEN 'new' WHEN c.nan_rate IS NULL THEN 'dropped' WHEN abs(c.nan_rate - p.nan_rate) < 0.01 THEN 'same'
    WHEN c.nan_rate > p.nan_rate THEN 'increased' ELSE 'decreased' END AS status FROM cur c FULL JOIN prv p USING (run_id, standard_key)"""),
)
def kpi_diff(spark, sf):
    cur, prev = _cur_prev(spark, sf)
    out = D.diff_rates(cur, prev, ["run_id", "standard_key"])
    return out.select("run_id", "standard_key", r("current"), r("reference"), r("delta"), "status")


@query(
    "degradation", "A34",
    with_sql(RESULTS, RATES, DAYS, """
SELECT run_id, standard_key, round(rise, 6) AS rise, rank FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY rise DESC, standard_key) AS rank FROM (
  SELECT c.run_id, c.standard_key, c.nan_rate - coalesce(p.nan_rate, 0) AS rise FROM cur c LEFT JOIN prv p USING (run_id, standard_key)) WHERE rise > 0) WHERE rank <= 3"""),
)
def degradation(spark, sf):
    cur, prev = _cur_prev(spark, sf)
    return D.degraded_keys(cur, prev, ["run_id"]).select("run_id", "standard_key", r("rise"), "rank")


@query(
    "regression_codes", "A36",
    with_sql(RESULTS, PAIRS, """
SELECT case_id, concat_ws(',', CASE WHEN abs(delta) > 0.3 THEN 'ABS_DELTA' END, CASE WHEN abs(pct) > 5 THEN 'PCT_DELTA' END, CASE WHEN b / 1000 > 0.05 THEN 'FAIL_RATE' END) AS codes FROM pairs"""),
)
def regression_codes(spark, sf):
    codes = D.regression_codes(F.col("delta"), F.col("pct"), F.col("b") / 1000)
    return _pairs(spark, sf).select("case_id", F.array_join(codes, ",").alias("codes"))


@query(
    "prev_run", "W3",
    """
WITH ru AS (SELECT o_orderpriority AS lane, o_orderkey AS round_num, 'run_' || CAST(o_orderkey AS VARCHAR) AS run_id FROM orders)
SELECT lane, round_num, run_id, coalesce(lag(run_id) OVER (PARTITION BY lane ORDER BY round_num), CASE lane WHEN '1-URGENT' THEN 'run_base' END) AS prev_run FROM ru""",
)
def prev_run(spark, sf):
    runs = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("lane"), F.col("o_orderkey").alias("round_num"),
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_id"),
    )
    base = spark.createDataFrame([("1-URGENT", "run_base")], "lane string, run_id string")
    out = D.with_baseline(D.previous_runs(runs, block=1000), F.broadcast(base))
    return out.select("lane", "round_num", "run_id", "prev_run")


@query(
    "registry_conflicts", "JN16",
    """
WITH reg AS (SELECT o_orderkey AS position, 'd' || CAST(o_custkey AS VARCHAR) AS run_dir, sha256(o_orderstatus || strftime(o_orderdate, '%Y%m%d')) AS content FROM orders),
pr AS (SELECT c_custkey AS entry_id, 'd' || CAST(c_custkey AS VARCHAR) AS run_dir, sha256('F' || strftime(DATE '1992-01-01' + CAST(c_custkey AS INTEGER), '%Y%m%d')) AS content FROM customer)
SELECT entry_id, 'duplicate_run_dir' AS conflict, count(*) AS n_hits, min(position) AS first_position FROM pr JOIN reg USING (run_dir) GROUP BY 1
UNION ALL SELECT entry_id, 'duplicate_content', count(*), min(position) FROM pr JOIN reg USING (content) GROUP BY 1""",
)
def registry_conflicts(spark, sf):
    reg = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("position"), F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("run_dir"),
        F.sha2(F.concat("o_orderstatus", F.date_format("o_orderdate", "yyyyMMdd")), 256).alias("content"),
    )
    day = F.date_add(F.lit("1992-01-01").cast("date"), F.col("c_custkey").cast("int"))
    prop = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entry_id"), F.concat(F.lit("d"), F.col("c_custkey").cast("string")).alias("run_dir"),
        F.sha2(F.concat(F.lit("F"), F.date_format(day, "yyyyMMdd")), 256).alias("content"),
    )
    return D.registry_conflicts(prop, reg, ["run_dir", "content"])


@query(
    "determinism_diff", "JN15",
    """
WITH a AS (SELECT o_orderkey AS id, sha256(o_orderstatus) AS h FROM orders WHERE o_orderpriority <> '1-URGENT'),
b AS (SELECT o_orderkey AS id, sha256(CASE WHEN o_orderpriority = '2-HIGH' THEN 'P' ELSE o_orderstatus END) AS h FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT kind, count(*) AS n FROM (SELECT CASE WHEN a.h IS NULL THEN 'missing_in_first' WHEN b.h IS NULL THEN 'missing_in_second' WHEN a.h <> b.h THEN 'mismatch' END AS kind
  FROM a FULL JOIN b USING (id)) WHERE kind IS NOT NULL GROUP BY 1""",
)
def determinism_diff(spark, sf):
    o, p = table(spark, sf, "orders"), F.col("o_orderpriority")
    a = o.where(p != "1-URGENT").select(F.col("o_orderkey").alias("id"), F.sha2("o_orderstatus", 256).alias("h"))
    other = F.when(p == "2-HIGH", "P").otherwise(F.col("o_orderstatus"))
    b = o.where(p != "5-LOW").select(F.col("o_orderkey").alias("id"), F.sha2(other, 256).alias("h"))
    return D.hash_diff(a, b, "id", "h").groupBy("kind").agg(F.count("*").alias("n"))


# --- scores and gates -----------------------------------------------------------------------------


def _res():
    return {k: F.col(k) for k in U1_KEYS}


def _scored(spark, sf):
    return residuals(spark, sf).withColumn("score", P.residual_score(_res()))


@query(
    "residual_score", "P23",
    with_sql(RESIDUALS, """
SELECT bucket, dominant, ranked, pattern, count(*) AS n, round(sum(score), 2) AS score_sum FROM (SELECT score, CASE WHEN score >= 70 THEN 'OK' ELSE 'LOW' END AS bucket,
  CASE WHEN ab >= aw AND ab >= ah THEN 'TORSO_UPPER' WHEN aw >= ah THEN 'TORSO_MID' ELSE 'TORSO_LOWER' END AS dominant,
  CASE WHEN ab >= aw AND aw >= ah THEN 'B>W>H' WHEN ab >= ah AND ah > aw THEN 'B>H>W' WHEN aw > ab AND ab >= ah THEN 'W>B>H' WHEN aw >= ah AND ah > ab THEN 'W>H>B' WHEN ah > ab AND ab >= aw THEN 'H>B>W' ELSE 'H>W>B' END AS ranked,
  CASE WHEN b < 0 THEN '-' ELSE '+' END || ',' || CASE WHEN w < 0 THEN '-' ELSE '+' END || ',' || CASE WHEN coalesce(h, 0) < 0 THEN '-' ELSE '+' END AS pattern
  FROM (SELECT *, abs(b) AS ab, abs(w) AS aw, abs(coalesce(h, 0)) AS ah FROM scored)) GROUP BY 1, 2, 3, 4"""),
)
def residual_score(spark, sf):
    ranked = P.ranked_keys(_res())
    short = F.concat_ws(">", F.transform(ranked, lambda k: F.substring(k, 1, 1)))
    return (
        _scored(spark, sf)
        .select(
            "score", P.score_bucket(F.col("score")).alias("bucket"), P.dominant_region(ranked).alias("dominant"),
            short.alias("ranked"), P.sign_pattern([F.col(k) for k in U1_KEYS]).alias("pattern"),
        )
        .groupBy("bucket", "dominant", "ranked", "pattern")
        .agg(F.count("*").alias("n"), F.round(F.sum("score"), 2).alias("score_sum"))
    )


RES_LONG = """rl AS (SELECT l_returnflag, 'BUST_CIRC_M' AS key, b * 100 AS v FROM scored UNION ALL SELECT l_returnflag, 'WAIST_CIRC_M', w * 100 FROM scored
  UNION ALL SELECT l_returnflag, 'HIP_CIRC_M', h * 100 FROM scored)"""


def _res_cm(spark, sf):
    return _scored(spark, sf).select("l_returnflag", "l_orderkey", "l_linenumber", "score", *[(F.col(k) * 100).alias(k) for k in U1_KEYS])


@query(
    "fit_summary", "A29",
    with_sql(RESIDUALS, RES_LONG, """
SELECT l_returnflag, key, count(v) AS n_values, round(quantile_cont(v, 0.5), 5) AS p50, round(quantile_cont(v, 0.9), 5) AS p90, round(quantile_cont(v, 0.95), 5) AS p95, round(max(v), 5) AS max_value FROM rl GROUP BY 1, 2"""),
)
def fit_summary(spark, sf):
    out = D.fit_summary(_res_cm(spark, sf).select("l_returnflag", *U1_KEYS), U1_KEYS, ["l_returnflag"])
    return out.select("l_returnflag", "key", "n_values", r("p50", digits=5), r("p90", digits=5), r("p95", digits=5), r("max_value", digits=5))


@query(
    "score_summary", "A29",
    with_sql(RESIDUALS, """
SELECT l_returnflag, count(score) AS n_values, round(min(score), 5) AS min_value, round(max(score), 5) AS max_value, round(quantile_cont(score, 0.5), 5) AS p50, round(quantile_cont(score, 0.9), 5) AS p90,
  count(*) FILTER (WHERE score >= 70) AS n_ok, count(*) FILTER (WHERE score < 70) AS n_low, round(avg(CASE WHEN score >= 70 THEN 1.0 ELSE 0 END)::DOUBLE, 6) AS fraction_above FROM scored GROUP BY 1"""),
)
def score_summary(spark, sf):
    out = D.score_summary(_scored(spark, sf), P.SCORE_OK, ["l_returnflag"])
    return out.select(
        "l_returnflag", "n_values", *[r(c, digits=5) for c in ("min_value", "max_value", "p50", "p90")], "n_ok", "n_low", r("fraction_above")
    )


@query(
    "residual_worst", "A30 T2 T3",
    with_sql(RESIDUALS, """
SELECT l_orderkey, l_linenumber, round(w * 100, 5) AS waist_cm, round(score, 5) AS score FROM residuals JOIN scored USING (l_orderkey, l_linenumber, l_returnflag, l_linestatus, b, w) ORDER BY abs(round(w * 100, 5)) DESC, l_orderkey, l_linenumber LIMIT 20""").replace(
        "FROM residuals JOIN scored USING (l_orderkey, l_linenumber, l_returnflag, l_linestatus, b, w)", "FROM scored"),
)
def residual_worst(spark, sf):
    return (
        _res_cm(spark, sf)
        .select("l_orderkey", "l_linenumber", r("WAIST_CIRC_M", "waist_cm", 5), r("score", digits=5))
        .orderBy(F.desc(F.abs("waist_cm")), "l_orderkey", "l_linenumber").limit(20)
    )


@query(
    "score_worst_by_group", "T3",
    with_sql(RESIDUALS, """
SELECT l_returnflag, l_orderkey, l_linenumber, s AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY s, l_orderkey, l_linenumber) AS rank FROM (
  SELECT l_returnflag, l_orderkey, l_linenumber, round(score, 5) AS s FROM scored)) WHERE rank <= 10"""),
)
def score_worst_by_group(spark, sf):
    d = _scored(spark, sf).select("l_returnflag", "l_orderkey", "l_linenumber", r("score", digits=5))
    return first_k(d, ["l_returnflag"], [F.asc("score"), F.asc("l_orderkey"), F.asc("l_linenumber")], 10)


GATE_SUMMARY = """gs AS (SELECT s.l_returnflag, round(quantile_cont(score, 0.9), 6) AS score_p90, min(score) AS score_min, count(*) FILTER (WHERE h IS NULL) AS failures,
  round(quantile_cont(b * 100, 0.9), 6) AS pb, round(quantile_cont(w * 100, 0.9), 6) AS pw, round(quantile_cont(h * 100, 0.9), 6) AS ph,
  round(avg(CASE WHEN score >= 70 THEN 1.0 ELSE 0 END)::DOUBLE, 6) AS fraction_above FROM scored s GROUP BY 1)"""


def _gate_summary(spark, sf):
    """Residuals and score as one long table: a single quantile tree for all of them, and one scan for the counts."""
    cm = _res_cm(spark, sf)
    long = D.fit_summary(cm.select("l_returnflag", "score", *U1_KEYS), ["score", *U1_KEYS], ["l_returnflag"])
    of = lambda k, c: F.max(F.when(F.col("key") == k, F.col(c)))
    wide = long.groupBy("l_returnflag").agg(
        *[r(of(k, "p90"), f"p90_{k}") for k in U1_KEYS], r(of("score", "p90"), "score_p90"), of("score", "min_value").alias("score_min"),
        (of("HIP_CIRC_M", "n_rows") - of("HIP_CIRC_M", "n_values")).alias("failures"),
    )
    share = cm.groupBy("l_returnflag").agg(F.round(F.avg((F.col("score") >= P.SCORE_OK).cast("double")), 6).alias("fraction_above"))
    return wide.join(share, "l_returnflag")


@query(
    "gate_eval", "A31",
    with_sql(RESIDUALS, GATE_SUMMARY, """
SELECT l_returnflag, score_p90, failures, failures <= 100000 AND score_p90 >= 85 AND abs(pb) <= 8 AND abs(pw) <= 8 AND abs(ph) <= 8 AND fraction_above >= 0.5 AS candidate,
  concat_ws(',', CASE WHEN failures > 100000 THEN 'failures' END, CASE WHEN score_p90 < 85 THEN 'score_p90' END, CASE WHEN abs(pb) > 8 THEN 'residual_BUST_CIRC_M' END,
    CASE WHEN abs(pw) > 8 THEN 'residual_WAIST_CIRC_M' END, CASE WHEN abs(ph) > 8 THEN 'residual_HIP_CIRC_M' END, CASE WHEN fraction_above < 0.5 THEN 'fraction' END) AS failed_rules FROM gs"""),
)
def gate_eval(spark, sf):
    return D.gate(_gate_summary(spark, sf), U1_KEYS, 85.0, 8.0, 100_000, 0.5).select(
        "l_returnflag", "score_p90", "failures", "candidate", "failed_rules"
    )


@query(
    "threshold_grid", "A32 JN12",
    with_sql(RESIDUALS, GATE_SUMMARY, """
SELECT l_returnflag, rt AS residual_thr, st AS score_thr, abs(pb) <= rt AND abs(pw) <= rt AND abs(ph) <= rt AS keys_ok, score_p90 >= st AS quality_ok, score_min >= st AS least_ok,
  failures <= 100000 AND abs(pb) <= rt AND abs(pw) <= rt AND abs(ph) <= rt AND score_p90 >= st AS would_pass
FROM gs, (VALUES (1.0::DOUBLE), (5.0), (9.0), (12.0)) r(rt), (VALUES (70.0::DOUBLE), (90.0), (97.0)) s(st)"""),
)
def threshold_grid(spark, sf):
    out = D.threshold_grid(_gate_summary(spark, sf), U1_KEYS, [1, 5, 9, 12], [70, 90, 97], 100_000)
    return out.select("l_returnflag", "residual_thr", "score_thr", "keys_ok", "quality_ok", "least_ok", "would_pass")


@query(
    "ab_compare", "A35",
    with_sql(RESIDUALS, """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(h) AS n_values, round(quantile_cont(h * 100, 0.5), 5) AS p50, round(quantile_cont(h * 100, 0.9), 5) AS p90, round(max(abs(h * 100)), 5) AS max_abs FROM scored GROUP BY 1, 2"""),
)
def ab_compare(spark, sf):
    d = residuals(spark, sf).withColumn("residual_cm", F.col("HIP_CIRC_M") * 100)
    out = D.compare_methods(d, ["l_returnflag", "l_linestatus"])
    return out.select("l_returnflag", "l_linestatus", "n_rows", "n_values", r("p50", digits=5), r("p90", digits=5), r("max_abs", digits=5))


@query(
    "best_config", "A35",
    with_sql(RESIDUALS, """
SELECT l_linestatus, l_returnflag, round(p90, 5) AS p90 FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY round(abs(p90), 9), l_returnflag) AS rn FROM (
  SELECT l_linestatus, l_returnflag, quantile_cont(b * 100, 0.9) AS p90 FROM scored GROUP BY 1, 2)) WHERE rn = 1"""),
)
def best_config(spark, sf):
    d = residuals(spark, sf).withColumn("residual_cm", F.col("BUST_CIRC_M") * 100)
    stats = D.compare_methods(d, ["l_linestatus", "l_returnflag"])
    return D.best_config(stats, "l_returnflag", ["l_linestatus"]).withColumn("p90", F.round("p90", 5))


@query(
    "prediction_gap", "JN13",
    """
SELECT p_brand, count(*) AS n, round(sum(p_retailprice - p_size * 1.5), 2) AS target_sum FROM part GROUP BY 1""",
)
def prediction_gap(spark, sf):
    p = table(spark, sf, "part")
    res = p.select("p_partkey", (F.col("p_size") * 1.5).alias("res"))
    gap = D.prediction_gap(p, res, "p_partkey", "p_retailprice", "res")
    return gap.join(p.select("p_partkey", "p_brand"), "p_partkey").groupBy("p_brand").agg(
        F.count("*").alias("n"), F.round(F.sum("target"), 2).alias("target_sum")
    )


@query(
    "ease_ratio", "P24 A37",
    """
WITH e AS (SELECT p_brand, g / nullif(b, 0) AS ratio, CASE WHEN b IS NULL OR b = 0 THEN 'zero_division' WHEN g IS NULL THEN 'missing_key' ELSE 'ok' END AS reason
  FROM (SELECT p_brand, CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS g, CASE WHEN p_size > 5 THEN p_size - 10.0::DOUBLE END AS b FROM part))
SELECT p_brand, reason, count(*) AS n, count(ratio) AS n_ratio, round(sum(ratio), 4) AS ratio_sum FROM e GROUP BY 1, 2""",
)
def ease_ratio(spark, sf):
    garment = F.when(F.col("p_type") != "PROMO", F.col("p_retailprice"))
    body = F.when(F.col("p_size") > 5, F.col("p_size") - 10.0)
    ratio, reason = P.ease_ratio(garment, body)
    e = table(spark, sf, "part").select("p_brand", ratio.alias("ratio"), F.coalesce(reason, F.lit("ok")).alias("reason"))
    return e.groupBy("p_brand", "reason").agg(
        F.count("*").alias("n"), F.count("ratio").alias("n_ratio"), F.round(F.sum("ratio"), 4).alias("ratio_sum")
    )


@query(
    "size_token", "P19",
    """
WITH t AS (SELECT CAST(60 + p_size AS VARCHAR) || CASE WHEN p_type = 'PROMO' THEN 'x9' ELSE lower(chr(65 + CAST(p_partkey % 7 AS INTEGER))) END AS tok FROM part),
m AS (SELECT upper(tok) AS tok, regexp_matches(upper(tok), '^(\\d+)([A-F])$') AS fits FROM t),
b AS (SELECT *, CASE WHEN fits THEN CAST(regexp_extract(tok, '^(\\d+)([A-F])$', 1) AS INTEGER) END AS band, CASE WHEN fits THEN right(tok, 1) END AS cup FROM m)
SELECT tok, count(*) AS n, coalesce(CASE WHEN NOT fits THEN 'FORMAT_VIOLATION' WHEN band NOT BETWEEN 65 AND 90 THEN 'RANGE_VIOLATION' END, '') AS code,
  round(CASE WHEN band BETWEEN 65 AND 90 THEN band / 100.0::DOUBLE END, 6) AS underbust_m,
  round(CASE WHEN band BETWEEN 65 AND 90 THEN band / 100.0::DOUBLE + (10 + 2.5 * (ascii(cup) - 65)) / 100.0::DOUBLE END, 6) AS bust_m FROM b GROUP BY tok, fits, band, cup""",
)
def size_token(spark, sf):
    letter = F.char(F.col("p_partkey") % 7 + 65)
    tok = F.concat((F.col("p_size") + 60).cast("string"), F.when(F.col("p_type") == "PROMO", "x9").otherwise(F.lower(letter)))
    s = table(spark, sf, "part").select(F.upper(tok).alias("tok"), P.size_token(tok).alias("s"))
    return s.groupBy("tok").agg(F.count("*").alias("n"), F.first("s").alias("s")).select(
        "tok", "n", F.coalesce("s.code", F.lit("")).alias("code"), r(F.col("s.underbust_m"), "underbust_m"), r(F.col("s.bust_m"), "bust_m")
    )


@query(
    "material_profile", "P25",
    """
WITH m AS (SELECT lower(trim(tok)) AS name, th, st FROM (SELECT CASE p_size % 6 WHEN 0 THEN ' Cotton ' WHEN 1 THEN 'denim' WHEN 2 THEN 'Spandex' WHEN 3 THEN 'silk' WHEN 4 THEN NULL ELSE '' END AS tok,
   CASE WHEN p_type = 'PROMO' THEN p_size / 10000.0::DOUBLE END AS th, CASE WHEN p_size % 2 = 0 THEN 'soft' END AS st FROM part)),
x AS (SELECT coalesce(name, '') AS name, th, st, coalesce(th > 0 AND st IS NOT NULL, false) AS ex FROM m)
SELECT CASE WHEN name = '' THEN 'UNSPECIFIED' ELSE name END AS material_token,
  CASE WHEN ex THEN st ELSE CASE name WHEN 'cotton' THEN 'low' WHEN 'denim' THEN 'low' WHEN 'spandex' THEN 'high' ELSE 'balanced' END END AS stretch_class,
  CASE WHEN ex THEN th ELSE CASE name WHEN 'cotton' THEN 0.0012 WHEN 'denim' THEN 0.0028 WHEN 'spandex' THEN 0.001 ELSE 0.002 END END::DOUBLE AS thickness_m,
  CASE WHEN ex OR name IN ('cotton', 'denim', 'spandex') THEN '' WHEN name = '' THEN 'material_token_missing' ELSE 'material_token_unknown:' || name END AS default_reason,
  CASE WHEN ex THEN 'proxy_meta_existing' WHEN name IN ('cotton', 'denim', 'spandex') THEN 'material_token_policy' ELSE 'default_policy' END AS source, count(*) AS n FROM x GROUP BY ALL""",
)
def material_profile(spark, sf):
    s = F.col("p_size")
    tok = F.when(s % 6 == 0, " Cotton ").when(s % 6 == 1, "denim").when(s % 6 == 2, "Spandex").when(s % 6 == 3, "silk").when(s % 6 == 5, "")
    thick = F.when(F.col("p_type") == "PROMO", s / 10000.0)
    return (
        table(spark, sf, "part").select(P.material_profile(tok, thick, F.when(s % 2 == 0, "soft")).alias("m")).select("m.*")
        .groupBy("material_token", "stretch_class", "thickness_m", "default_reason", "source").agg(F.count("*").alias("n"))
    )


@query(
    "hard_gate", "P26",
    """
WITH s AS (SELECT o_orderpriority AS p, o_orderstatus AS st, o_totalprice AS v FROM orders),
g AS (SELECT coalesce(CASE WHEN p = '1-URGENT' THEN true WHEN p = '2-HIGH' THEN false END, CASE WHEN st = 'P' THEN true END, false) AS flag,
  CASE WHEN p = '1-URGENT' THEN 'garment_hard_gate_violation: signal' WHEN st = 'F' AND p = '3-MEDIUM' THEN 'early' WHEN p = '5-LOW' THEN 'garment_hard_gate_violation: status=HARD_GATE' END AS reason,
  greatest(0, least(1, v / 300000)) AS sc FROM s)
SELECT flag, coalesce(reason, '') AS reason, reason IS NOT NULL AS early_exit, count(*) AS n, round(sum(sc), 3) AS score FROM g GROUP BY 1, 2, 3""",
)
def hard_gate(spark, sf):
    p, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    top = F.when(p == "1-URGENT", True).when(p == "2-HIGH", False)
    flags = P.gate_flags({f: top for f in P.GATE_FLAGS}, {f: F.when(st == "P", True) for f in P.GATE_FLAGS})
    none = F.lit(None).cast("string")
    e = P.early_exit(
        p == "1-URGENT", none, (st == "F") & (p == "3-MEDIUM"), F.lit("early"), F.when(p == "5-LOW", "hard_gate"), none
    )
    return (
        table(spark, sf, "orders")
        .select(flags[P.GATE_FLAGS[0]].alias("flag"), e.alias("e"), P.foreign_score(F.col("o_totalprice") / 300000).alias("sc"))
        .groupBy("flag", F.coalesce("e.reason", F.lit("")).alias("reason"), F.col("e.early_exit").alias("early_exit"))
        .agg(F.count("*").alias("n"), F.round(F.sum("sc"), 3).alias("score"))
    )


@query(
    "representative_value", "P29",
    """
SELECT p_brand, count(*) AS n, count(v) AS n_found, round(sum(v), 2) AS total FROM (SELECT p_brand, CASE p_size % 4 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size * 2.0::DOUBLE WHEN 2 THEN NULL ELSE p_size * 3.0::DOUBLE END AS v FROM part) GROUP BY 1""",
)
def representative_value(spark, sf):
    s, price = F.col("p_size"), F.col("p_retailprice")
    key = lambda inner: F.struct(inner.alias("HIP_CIRC_M"))
    a = F.to_json(F.struct(key(F.struct(F.struct(price.alias("median")).alias("value_stats"))).alias("summary")))
    b = F.to_json(key(F.struct((s * 2.0).alias("p50"))))
    c = F.to_json(F.struct(key(F.struct(s.alias("mean"))).alias("summary"), key(F.struct(s.alias("p50"))).alias("by_key")))
    d = F.to_json(F.struct(key(F.struct((s * 3.0).alias("median"), s.alias("p50"))).alias("per_key")))
    doc = F.when(s % 4 == 0, a).when(s % 4 == 1, b).when(s % 4 == 2, c).otherwise(d)
    v = P.representative(F.col("doc"), "HIP_CIRC_M")
    return table(spark, sf, "part").select("p_brand", doc.alias("doc")).select("p_brand", v.alias("v")).groupBy("p_brand").agg(
        F.count("*").alias("n"), F.count("v").alias("n_found"), F.round(F.sum("v"), 2).alias("total")
    )


# --- clusters -------------------------------------------------------------------------------------

DIMS = [f"x{i}" for i in range(64)]
CENTROIDS = 384
every_dim = lambda form, sep=", ": sep.join(form.format(d=d) for d in DIMS)
VECTORS = "vec AS (SELECT vec_id, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS {d}" for i, d in enumerate(DIMS)) + " FROM embeddings)"


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", *[F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate(DIMS)]
    )


@query(
    "zscore", "ML1",
    with_sql(
        VECTORS, "p AS (SELECT " + every_dim("avg({d}) AS m_{d}, stddev_pop({d}) AS s_{d}") + " FROM vec)",
        "SELECT vec_id, " + every_dim("round(({d} - m_{d}) / s_{d}, 6) AS {d}") + " FROM vec, p",
    ),
)
def zscore(spark, sf):
    z, _ = K.zscore(_vectors(spark, sf), DIMS)
    return z.select("vec_id", *[r(c) for c in DIMS])


def _step(n, prev):
    """One round: the nearest centroid of each vector, the means of each cluster; an empty one keeps its centroid."""
    square = every_dim("(v.{d} - c.{d}) ** 2", " + ")
    return f"""a{n} AS (SELECT v.vec_id, min_by(c.i, (round({square}, 15), c.i)) AS i FROM vec v, {prev} c GROUP BY 1),
m{n} AS (SELECT i, {every_dim("avg({d}) AS {d}")} FROM a{n} JOIN vec USING (vec_id) GROUP BY 1),
c{n} AS (SELECT p.i, {every_dim("coalesce(m.{d}, p.{d}) AS {d}")} FROM {prev} p LEFT JOIN m{n} m USING (i))"""


LLOYD = [
    VECTORS, f"c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, {every_dim('{d}')} FROM (SELECT * FROM vec ORDER BY vec_id LIMIT {CENTROIDS}))",
    _step(1, "c0"), _step(2, "c1"),
]


@query("lloyd_2_iterations", "ML2 T5", with_sql(*LLOYD, "SELECT CAST(i AS INTEGER) AS cluster, " + every_dim("round({d}, 6) AS {d}") + " FROM c2"))
def lloyd_2_iterations(spark, sf):
    c = K.lloyd(_vectors(spark, sf), DIMS, CENTROIDS, ["vec_id"], max_iter=2)
    return K.centroid_frame(spark, c, DIMS).select("cluster", *[r(f"c_{d}", d) for d in DIMS])


@query(
    "lloyd_converged", "ML2 T5",
    f"SELECT CAST(least(count(*), {CENTROIDS}) AS BIGINT) AS n_clusters, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_moved FROM embeddings",
)
def lloyd_converged(spark, sf):
    """Rounds until unchanged: one more round of assignments and means moves no centroid."""
    v = _vectors(spark, sf)
    c = K.lloyd(v, DIMS, CENTROIDS, ["vec_id"])
    means = K.assign(v, DIMS, c).groupBy("cluster").agg(F.count("*").alias("n"), *[F.avg(d).alias(d) for d in DIMS])
    both = K.centroid_frame(spark, c, DIMS).join(means, "cluster", "left")
    moved = F.greatest(*[F.abs(F.col(d) - F.col(f"c_{d}")) for d in DIMS]) > 1e-9
    return both.agg(F.count("*").alias("n_clusters"), F.sum("n").alias("n_rows"), F.count_if(moved).alias("n_moved"))


def _assigned(spark, sf, **rounds):
    """Rows with their cluster and distance, after rounds until unchanged or ``max_iter`` rounds."""
    v = _vectors(spark, sf)
    c = K.lloyd(v, DIMS, CENTROIDS, ["vec_id"], **rounds)
    return K.original_distance(K.assign(v, DIMS, c), K.centroid_frame(spark, c, DIMS), DIMS)


ASSIGNED = [*LLOYD, _step(3, "c2"), "ds AS (SELECT a3.vec_id, a3.i, sqrt(" + every_dim("(v.{d} - c2.{d}) ** 2", " + ") + ") AS d FROM a3 JOIN c2 USING (i) JOIN vec v USING (vec_id))"]


@query("assign_distance", "ML4 JN13", with_sql(*ASSIGNED, "SELECT vec_id, CAST(i AS INTEGER) AS cluster, round(d, 6) AS distance FROM ds"))
def assign_distance(spark, sf):
    """After two rounds, as far as the SQL is unrolled; ``assign_distance_converged`` runs to the end."""
    return _assigned(spark, sf, max_iter=2).select("vec_id", "cluster", r("distance"))


@query("assign_distance_converged", "ML4 JN13")
def assign_distance_converged(spark, sf):
    return _assigned(spark, sf).select("vec_id", "cluster", r("distance"))


@query(
    "assignment_stats", "A28",
    with_sql(*ASSIGNED, """
SELECT (SELECT count(*) FROM ds) AS n_rows, round(min(d), 6) AS dist_min, round(quantile_cont(d, 0.5), 6) AS dist_p50, round(quantile_cont(d, 0.9), 6) AS dist_p90, round(max(d), 6) AS dist_max,
  (SELECT count(DISTINCT i) FROM ds) AS n_clusters, (SELECT min(n)::DOUBLE FROM (SELECT count(*) AS n FROM ds GROUP BY i)) AS size_min,
  (SELECT quantile_cont(n::DOUBLE, 0.5) FROM (SELECT count(*) AS n FROM ds GROUP BY i)) AS size_p50, (SELECT max(n)::DOUBLE FROM (SELECT count(*) AS n FROM ds GROUP BY i)) AS size_max FROM ds"""),
)
def assignment_stats(spark, sf):
    """After two rounds, as far as the SQL is unrolled; ``assignment_stats_converged`` runs to the end."""
    return _stats(_assigned(spark, sf, max_iter=2))


@query("assignment_stats_converged", "A28")
def assignment_stats_converged(spark, sf):
    return _stats(_assigned(spark, sf))


def _stats(assigned):
    # kept in memory or on disk: three order statistics read these two columns, and the plan behind them is wide
    out = K.assignment_stats(assigned.select("cluster", "distance").persist())
    return out.select("n_rows", *[r(c) for c in ("dist_min", "dist_p50", "dist_p90", "dist_max")], "n_clusters", "size_min", "size_p50", "size_max")


@query("worst_subjects", "T4", with_sql(*ASSIGNED, "SELECT vec_id, CAST(i AS INTEGER) AS cluster, round(d, 6) AS distance FROM ds ORDER BY round(d, 9) DESC, vec_id LIMIT 10"))
def worst_subjects(spark, sf):
    """After two rounds, as far as the SQL is unrolled; ``worst_subjects_converged`` runs to the end."""
    return K.worst_subjects(_assigned(spark, sf, max_iter=2), "vec_id").select("vec_id", "cluster", r("distance"))


@query("worst_subjects_converged", "T4")
def worst_subjects_converged(spark, sf):
    return K.worst_subjects(_assigned(spark, sf), "vec_id").select("vec_id", "cluster", r("distance"))


@query("kmeans_library", "ML3")
def kmeans_library(spark, sf):
    v = _vectors(spark, sf)
    c = K.library_kmeans(v, DIMS, CENTROIDS, restarts=10, max_iter=300)
    return K.assign(v, DIMS, c).groupBy("cluster").agg(F.count("*").alias("n"), F.sqrt(F.avg("sq_dist")).alias("rms"))
