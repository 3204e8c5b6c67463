"""Queries of the curation job: number repair, units, filters, sensors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.functions import keys as K
from tapeline.functions import numbers as N
from tapeline.operators import curate as C
from tapeline.operators import sensors as S
from tapeline.operators.scale import rows_where
from tapeline.plans.inputs import (
    CANON, SURVEY_KEYS, SURVEY_LONG, SURVEY_RAW, UNITS, sql_parse, survey_canonical_counts, survey_long, survey_raw, survey_units, with_sql,
)
from tapeline.plans.registry import query, table


def r6(c, name=None):
    out = F.round(F.col(c) if isinstance(c, str) else c, 6)
    return out.alias(name or c)


@query(
    "completeness", "A7 P7 P8",
    with_sql(SURVEY_RAW, SURVEY_LONG, UNITS, CANON, """
SELECT source, key, count(*) AS n_rows, count(value_m) AS n_values, count(*) - count(value_m) AS n_missing,
  round((count(*) - count(value_m)) / count(*)::DOUBLE, 6) AS missing_rate,
  round(min(value_m), 6) AS min_value, round(max(value_m), 6) AS max_value,
  round(quantile_cont(value_m, 0.01), 6) AS p01, round(quantile_cont(value_m, 0.5), 6) AS p50,
  round(quantile_cont(value_m, 0.99), 6) AS p99,
  CASE WHEN key = 'WEIGHT_KG' OR quantile_cont(value_m, 0.5) IS NULL THEN 'not_checked'
       WHEN quantile_cont(value_m, 0.5) > 10 THEN 'too_large'
       WHEN quantile_cont(value_m, 0.5) < 0.01 THEN 'too_small' ELSE 'ok' END AS scale
FROM canon GROUP BY source, key"""),
)
def completeness(spark, sf):
    out = S.completeness(survey_canonical_counts(spark, sf), "value_m", "n")
    return out.select(
        "source", "key", "n_rows", "n_values", "n_missing", r6("missing_rate"), r6("min_value"),
        r6("max_value"), r6("p01"), r6("p50"), r6("p99"), "scale",
    )


@query(
    "parse_number", "P2",
    with_sql(SURVEY_RAW, f"""
SELECT HEIGHT_M AS raw, {sql_parse('HEIGHT_M')} AS parsed, count(*) AS n FROM survey_raw GROUP BY 1, 2"""),
)
def parse_number(spark, sf):
    return (
        survey_raw(spark, sf)
        .select(F.col("HEIGHT_M").alias("raw"), N.parse_number(F.col("HEIGHT_M")).alias("parsed"))
        .groupBy("raw", "parsed")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "null_sentinels", "P3",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT source, key, count(*) FILTER (WHERE is_sentinel) AS sentinel_count, count(*) FILTER (WHERE is_blank) AS blank_count
FROM survey_long GROUP BY 1, 2"""),
)
def null_sentinels(spark, sf):
    return C.sentinel_counts(survey_long(spark, sf))


@query(
    "parse_failures", "P4",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT source, key, count(raw) AS non_null_before, count(parsed) AS non_null_after,
  count(raw) - count(parsed) AS failures FROM survey_long GROUP BY 1, 2"""),
)
def parse_failures(spark, sf):
    return C.parse_failures(survey_long(spark, sf), ["source", "key"])


@query(
    "normalize_sex", "P5",
    with_sql(SURVEY_RAW, """
SELECT source, coalesce(sex, 'none') AS sex, count(*) AS n FROM (
  SELECT source, CASE WHEN source = '7th' AND SEX = '남' THEN 'M' WHEN source = '7th' AND SEX = '여' THEN 'F'
    WHEN upper(SEX) IN ('M', 'F') THEN upper(SEX) END AS sex FROM survey_raw) GROUP BY 1, 2"""),
)
def normalize_sex(spark, sf):
    return (
        survey_raw(spark, sf)
        .select("source", F.coalesce(N.normalize_sex(F.col("SEX"), F.col("source")), F.lit("none")).alias("sex"))
        .groupBy("source", "sex")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "infer_units", "P9 W7",
    with_sql(SURVEY_RAW, SURVEY_LONG, UNITS, "SELECT source, key, round(sample_median, 6) AS sample_median, n_sample, unit FROM units"),
)
def infer_units(spark, sf):
    return survey_units(spark, sf).select(
        "source", "key", r6("sample_median"), "n_sample", "unit"
    )


@query(
    "to_meters", "P7 P10",
    with_sql(SURVEY_RAW, SURVEY_LONG, UNITS, CANON, """
SELECT source, key, treatment, coalesce(used_unit, 'none') AS used_unit, count(*) AS n_rows, count(value_m) AS n_values,
  round(sum(value_m), 4) AS total FROM canon GROUP BY 1, 2, 3, 4"""),
)
def to_meters(spark, sf):
    return (
        survey_canonical_counts(spark, sf)
        .groupBy("source", "key", "treatment", F.coalesce("used_unit", F.lit("none")).alias("used_unit"))
        .agg(
            F.sum("n").alias("n_rows"), rows_where(F.col("value_m").isNotNull(), "n").alias("n_values"),
            F.round(F.sum(F.col("value_m") * F.col("n")), 4).alias("total"),
        )
    )


@query(
    "unit_findings", "P10 P11",
    with_sql(SURVEY_RAW, SURVEY_LONG, UNITS, CANON, """
SELECT * FROM (SELECT source, key, treatment, coalesce(unit, 'none') AS unit, count(value) AS non_null_before,
  count(value_m) AS non_null_after, count(*) FILTER (WHERE isinf(value)) AS non_finite,
  CASE WHEN treatment IN ('default_mm', 'override_mm') THEN 'unit_conversion_applied'
    WHEN treatment = 'undetermined' THEN 'unit_undetermined'
    WHEN treatment = 'failed' OR count(*) FILTER (WHERE isinf(value)) > 0 THEN 'unit_conversion_failed' END AS reason
  FROM canon GROUP BY source, key, treatment, unit) WHERE reason IS NOT NULL"""),
)
def unit_findings(spark, sf):
    return C.unit_findings(survey_canonical_counts(spark, sf), "n").withColumn("unit", F.coalesce("unit", F.lit("none")))


@query(
    "finite_only", "P11 1.3",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT source, key, count(*) FILTER (WHERE isinf(parsed)) AS n_inf, count(CASE WHEN NOT isinf(parsed) AND NOT isnan(parsed) THEN parsed END) AS n_finite
FROM survey_long GROUP BY 1, 2"""),
)
def finite_only(spark, sf):
    p = F.col("parsed")
    return survey_long(spark, sf).groupBy("source", "key").agg(
        F.count_if(N.is_infinite(p)).alias("n_inf"), F.count(N.finite(p)).alias("n_finite")
    )


@query(
    "row_filters", "P12",
    with_sql(SURVEY_RAW, f"""
SELECT source, count(*) AS n_rows,
  count(*) FILTER (WHERE coalesce(age BETWEEN 20 AND 59, false)) AS age_kept, count(*) - count(*) FILTER (WHERE coalesce(age BETWEEN 20 AND 59, false)) AS age_removed,
  count(*) FILTER (WHERE coalesce(ok, false)) AS outlier_kept, count(*) - count(*) FILTER (WHERE coalesce(ok, false)) AS outlier_removed
FROM (SELECT source, CAST(AGE AS INTEGER) AS age, h / 1000 BETWEEN 1.0 AND 2.2 AND w BETWEEN 20 AND 250 AS ok
  FROM (SELECT *, {sql_parse('HEIGHT_M')} AS h, {sql_parse('WEIGHT_KG')} AS w FROM survey_raw)) GROUP BY 1"""),
)
def row_filters(spark, sf):
    raw = survey_raw(spark, sf)
    h, w = N.parse_number(F.col("HEIGHT_M")) / 1000, N.parse_number(F.col("WEIGHT_KG"))
    return C.filter_report(
        raw, ["source"],
        {
            "age": F.col("AGE").cast("int").between(*C.AGE_RANGE),
            "outlier": h.between(*C.HEIGHT_BOUNDS) & w.between(*C.WEIGHT_BOUNDS),
        },
    )


@query(
    "drop_missing", "P13",
    with_sql(SURVEY_RAW, """
SELECT source, count(*) AS n_kept FROM survey_raw WHERE CHEST_CIRC_M_REF IS NOT NULL AND KNEE_HEIGHT_M IS NOT NULL GROUP BY 1"""),
)
def drop_missing(spark, sf):
    return (
        C.drop_missing(survey_raw(spark, sf), ["CHEST_CIRC_M_REF", "KNEE_HEIGHT_M"])
        .groupBy("source").agg(F.count(F.lit(1)).alias("n_kept"))
    )


@query(
    "impute_median", "P13",
    with_sql(SURVEY_RAW, """
m AS (SELECT quantile_cont(CAST(CHEST_CIRC_M_REF AS DOUBLE), 0.5) AS mc, quantile_cont(CAST(KNEE_HEIGHT_M AS DOUBLE), 0.5) AS mk FROM survey_raw)""", """
SELECT source, count(*) AS n, round(sum(coalesce(CAST(CHEST_CIRC_M_REF AS DOUBLE), mc)), 4) AS chest,
  round(sum(coalesce(CAST(KNEE_HEIGHT_M AS DOUBLE), mk)), 4) AS knee FROM survey_raw, m GROUP BY 1"""),
)
def impute_median(spark, sf):
    cols = ["CHEST_CIRC_M_REF", "KNEE_HEIGHT_M"]
    num = survey_raw(spark, sf).select("source", *[N.to_double(F.col(c)).alias(c) for c in cols])
    return C.impute_median(num, cols).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(cols[0]), 4).alias("chest"),
        F.round(F.sum(cols[1]), 4).alias("knee"),
    )


@query(
    "key_rules", "P8",
    with_sql("""k AS (SELECT upper(replace(p_name, ' ', '_')) || CASE WHEN p_size < 10 THEN '_CIRC_M' WHEN p_size < 20 THEN '_WIDTH_M_REF'
      WHEN p_size < 30 THEN '_HEIGHT_M' WHEN p_size < 40 THEN '_KG' ELSE '' END AS key FROM part)""", """
SELECT key, count(*) AS n, key NOT LIKE '%\\_KG' ESCAPE '\\' AND key LIKE '%\\_M%' ESCAPE '\\' AS meter,
  coalesce(CASE WHEN key LIKE '%\\_CIRC\\_%' ESCAPE '\\' THEN 0.2 WHEN key LIKE '%\\_WIDTH\\_%' ESCAPE '\\' THEN 0.05
    WHEN key LIKE '%\\_HEIGHT\\_%' ESCAPE '\\' THEN 0.1 END, -1)::DOUBLE AS low,
  coalesce(CASE WHEN key LIKE '%\\_CIRC\\_%' ESCAPE '\\' THEN 2.5 WHEN key LIKE '%\\_WIDTH\\_%' ESCAPE '\\' THEN 1.0
    WHEN key LIKE '%\\_HEIGHT\\_%' ESCAPE '\\' THEN 1.5 END, -1)::DOUBLE AS high
FROM k GROUP BY key"""),
)
def key_rules(spark, sf):
    s = F.col("p_size")
    suffix = (
        F.when(s < 10, "_CIRC_M").when(s < 20, "_WIDTH_M_REF").when(s < 30, "_HEIGHT_M").when(s < 40, "_KG").otherwise("")
    )
    key = F.concat(F.upper(F.regexp_replace("p_name", " ", "_")), suffix).alias("key")
    lo, hi = K.physical_range(F.col("key"))
    return (
        table(spark, sf, "part").select(key).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        .select(
            "key", "n", K.expects_meter(F.col("key")).alias("meter"),
            F.coalesce(lo, F.lit(-1.0)).alias("low"), F.coalesce(hi, F.lit(-1.0)).alias("high"),
        )
    )


@query(
    "sensor_all_null", "A1",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT * FROM (SELECT source, key, count(*) AS n_rows, count(raw) AS n_text, count(parsed) AS n_number,
  CASE WHEN count(raw) = 0 THEN 'ALL_NULL_EXTRACTED' WHEN count(parsed) = 0 THEN 'NON_NUMERIC_VALUES' END AS reason
FROM (SELECT source, key, raw, parsed FROM survey_long
      UNION ALL SELECT source, 'SEX', SEX, TRY_CAST(SEX AS DOUBLE) FROM survey_raw) GROUP BY 1, 2) WHERE reason IS NOT NULL"""),
)
def sensor_all_null(spark, sf):
    raw = survey_raw(spark, sf)
    sex = raw.select("source", F.lit("SEX").alias("key"), F.col("SEX").alias("raw"), N.parse_number(F.col("SEX")).alias("parsed"))
    return S.all_null(survey_long(spark, sf).select("source", "key", "raw", "parsed").unionByName(sex))


@query(
    "sensor_all_null_by_source", "A2",
    with_sql(SURVEY_RAW, SURVEY_LONG, UNITS, CANON, """
SELECT source, key, count(*) AS n_rows, 'ALL_NULL_BY_SOURCE' AS reason FROM canon GROUP BY 1, 2 HAVING count(value_m) = 0"""),
)
def sensor_all_null_by_source(spark, sf):
    return S.all_null_by_source(survey_canonical_counts(spark, sf), "value_m", "n")


@query(
    "sensor_massive_null", "A3",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT * FROM (SELECT source, key, count(raw) AS n_before, count(keep) AS n_after, count(raw) - count(keep) AS dropped,
  round((count(raw) - count(keep)) / nullif(count(raw), 0)::DOUBLE, 6) AS drop_rate
FROM (SELECT *, CASE WHEN key IN ('HIP_WIDTH_M', 'KNEE_HEIGHT_M') AND parsed < 430 AND parsed <> 0.7 THEN NULL ELSE parsed END AS keep FROM survey_long)
GROUP BY 1, 2) WHERE dropped >= 50 AND drop_rate >= 0.5"""),
)
def sensor_massive_null(spark, sf):
    p = F.col("parsed")
    lost = F.col("key").isin("HIP_WIDTH_M", "KNEE_HEIGHT_M") & (p < 430) & (p != 0.7)
    long = survey_long(spark, sf).withColumn("keep", F.when(lost, None).otherwise(p))
    return S.massive_null(long, F.col("raw"), F.col("keep"), drop=0.5, rows=50).withColumn(
        "drop_rate", F.round("drop_rate", 6)
    )


@query(
    "sensor_scale_range", "A4",
    with_sql(SURVEY_RAW, SURVEY_LONG, UNITS, CANON, """
st AS (SELECT source, key, quantile_cont(value_m, 0.01) AS p01, quantile_cont(value_m, 0.5) AS p50, quantile_cont(value_m, 0.99) AS p99,
  min(value_m) AS min_value, max(value_m) AS max_value,
  count(*) FILTER (WHERE CASE WHEN key = 'HEIGHT_M' THEN value_m < 0.8 OR value_m > 2.5
     WHEN key LIKE '%\\_CIRC\\_%' ESCAPE '\\' THEN value_m < 0.2 OR value_m > 2.5
     WHEN key LIKE '%\\_WIDTH\\_%' ESCAPE '\\' THEN value_m < 0.05 OR value_m > 1.0
     WHEN key LIKE '%\\_HEIGHT\\_%' ESCAPE '\\' THEN value_m < 0.1 OR value_m > 1.5 ELSE false END) AS out_of_range
  FROM canon WHERE key <> 'WEIGHT_KG' GROUP BY 1, 2 HAVING count(value_m) > 0),
hit AS (SELECT 'SCALE_SUSPECTED' AS reason, * FROM st WHERE p50 > 10 OR p50 < 0.01
  UNION ALL SELECT 'RANGE_SUSPECTED', * FROM st WHERE out_of_range >= 50)""", """
SELECT source, key, reason, round(p01, 6) AS p01, round(p50, 6) AS p50, round(p99, 6) AS p99, round(min_value, 6) AS min_value,
  round(max_value, 6) AS max_value, out_of_range FROM hit"""),
)
def sensor_scale_range(spark, sf):
    out = S.scale_and_range(survey_canonical_counts(spark, sf), "value_m", "n")
    return out.select(
        "source", "key", "reason", r6("p01"), r6("p50"), r6("p99"), r6("min_value"), r6("max_value"), "out_of_range"
    )


@query(
    "missing_net_sentinel", "A5",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT * FROM (SELECT source, key, count(*) FILTER (WHERE value IS NULL) AS missing, count(*) FILTER (WHERE is_sentinel OR is_blank) AS explained,
  greatest(count(*) FILTER (WHERE value IS NULL) - count(*) FILTER (WHERE is_sentinel OR is_blank), 0) AS net_missing
FROM survey_long GROUP BY 1, 2) WHERE net_missing > 0"""),
)
def missing_net_sentinel(spark, sf):
    return S.missing_net(survey_long(spark, sf))


@query(
    "source_quality", "A6",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT source, key, count(*) AS n_rows, count(value) AS n_values, count(*) - count(value) AS n_missing,
  round((count(*) - count(value)) / count(*)::DOUBLE, 6) AS missing_rate FROM survey_long GROUP BY 1, 2"""),
)
def source_quality(spark, sf):
    return S.source_quality(survey_long(spark, sf)).withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "high_missing", "A8",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT source, key, count(*) AS n_rows, count(value) AS n_values, count(*) - count(value) AS n_missing,
  round((count(*) - count(value)) / count(*)::DOUBLE, 6) AS missing_rate FROM survey_long GROUP BY 1, 2
HAVING (count(*) - count(value)) / count(*)::DOUBLE >= 0.95"""),
)
def high_missing(spark, sf):
    return S.high_missing(S.source_quality(survey_long(spark, sf))).withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "source_key_order", "A8",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT source, key, round(missing_rate, 6) AS missing_rate, row_number() OVER (PARTITION BY source ORDER BY missing_rate DESC, key) AS position
FROM (SELECT source, key, (count(*) - count(value)) / count(*)::DOUBLE AS missing_rate FROM survey_long GROUP BY 1, 2)"""),
)
def source_key_order(spark, sf):
    return S.source_order(S.source_quality(survey_long(spark, sf))).select("source", "key", r6("missing_rate"), "position")


@query(
    "stage_trace", "A9",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
st AS (SELECT 'raw' AS stage, source, key, row_idx, raw FROM survey_long
  UNION ALL SELECT 'repaired', source, key, row_idx, CASE WHEN value IS NULL THEN NULL ELSE raw END FROM survey_long),
m AS (SELECT *, CASE WHEN regexp_matches(trim(raw), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') OR regexp_matches(trim(raw), '(?i)^[+-]?(inf|infinity|nan)$')
   THEN TRY_CAST(trim(raw) AS DOUBLE) END AS num FROM st WHERE key IN ('HEIGHT_M', 'WAIST_CIRC_M')),
b AS (SELECT *, coalesce(isinf(num), false) AS inf, coalesce(isinf(num), false) OR (raw IS NOT NULL AND num IS NULL) AS bad FROM m),
sm AS (SELECT stage, source, key, string_agg(raw, '|' ORDER BY rk) AS samples FROM (
   SELECT *, row_number() OVER (PARTITION BY stage, source, key ORDER BY bad DESC, row_idx, raw) AS rk FROM b WHERE raw IS NOT NULL) WHERE rk <= 20 GROUP BY 1, 2, 3)""", """
SELECT g.*, sm.samples FROM (SELECT stage, source, key, count(*) AS total_rows, count(raw) AS non_null, count(*) FILTER (WHERE inf) AS non_finite,
  count(*) FILTER (WHERE raw IS NOT NULL AND num IS NULL) AS non_numeric, min(CASE WHEN NOT inf THEN num END) AS min_value,
  max(CASE WHEN NOT inf THEN num END) AS max_value FROM b GROUP BY 1, 2, 3) g LEFT JOIN sm USING (stage, source, key)"""),
)
def stage_trace(spark, sf):
    long = survey_long(spark, sf).select("source", "key", "row_idx", "raw", "value")
    stages = long.withColumn(
        "_s",
        F.explode(
            F.array(
                F.struct(F.lit("raw").alias("stage"), F.col("raw").alias("t")),
                F.struct(F.lit("repaired").alias("stage"), F.when(F.col("value").isNotNull(), F.col("raw")).alias("t")),
            )
        ),
    ).select(F.col("_s.stage").alias("stage"), "source", "key", "row_idx", F.col("_s.t").alias("raw"))
    return S.stage_trace(stages, ["HEIGHT_M", "WAIST_CIRC_M"], ["row_idx", "raw"])


@query(
    "reason_histogram", "A10",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN is_sentinel THEN 'SENTINEL_MISSING' WHEN is_blank THEN 'value_missing'
    WHEN raw IS NOT NULL AND parsed IS NULL THEN 'parse_failed' END AS reason FROM survey_long) WHERE reason IS NOT NULL GROUP BY 1"""),
)
def reason_histogram(spark, sf):
    reason = (
        F.when(F.col("is_sentinel"), "SENTINEL_MISSING").when(F.col("is_blank"), "value_missing")
        .when(F.col("raw").isNotNull() & F.col("parsed").isNull(), "parse_failed")
    )
    return S.reason_histogram(survey_long(spark, sf).select(reason.alias("reason")).where(F.col("reason").isNotNull()))


@query(
    "header_variants", "A11",
    """
WITH n AS (SELECT p_type || CASE WHEN p_size > 40 THEN '.1' WHEN p_size > 30 THEN '.2' ELSE '' END AS name,
   count(CASE WHEN p_size % 5 <> 0 THEN 1 END) AS non_null FROM part GROUP BY 1),
b AS (SELECT regexp_replace(name, '\\.\\d+$', '') AS base, name, non_null FROM n)
SELECT base, name, CAST(non_null AS BIGINT) AS non_null, n_variants FROM (SELECT *, count(*) OVER (PARTITION BY base) AS n_variants FROM b) WHERE n_variants > 1""",
)
def header_variants(spark, sf):
    s = F.col("p_size")
    name = F.concat("p_type", F.when(s > 40, ".1").when(s > 30, ".2").otherwise(""))
    names = table(spark, sf, "part").groupBy(name.alias("name")).agg(F.count_if(s % 5 != 0).alias("non_null"))
    return S.header_variants(names)


@query(
    "header_candidates", "A12",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
pr AS (SELECT key AS name, count(*) AS n_rows, count(raw) AS n_values FROM survey_long GROUP BY 1),
pt AS (SELECT * FROM (VALUES ('CIRC'), ('HEIGHT'), ('_M')) t(pattern))""",
    "SELECT pattern, name, n_rows, n_values FROM pr JOIN pt ON contains(name, pattern)"),
)
def header_candidates(spark, sf):
    profile = survey_long(spark, sf).groupBy(F.col("key").alias("name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("raw").alias("n_values")
    )
    patterns = spark.createDataFrame([("CIRC",), ("HEIGHT",), ("_M",)], "pattern string")
    return S.header_candidates(profile, patterns).select("pattern", "name", "n_rows", "n_values")


@query(
    "value_profile", "A13",
    with_sql(SURVEY_RAW, SURVEY_LONG, """
dr AS (SELECT source, key, value, row_number() OVER (PARTITION BY source, key ORDER BY md5('42,' || array_to_string(row_idx, ',')), row_idx) AS s FROM survey_long WHERE value IS NOT NULL AND NOT isinf(value))""", """
SELECT source, key, min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value, count(*) AS n_valid,
  string_agg(CAST(value AS VARCHAR), '|' ORDER BY s) FILTER (WHERE s <= 5) AS sample_values FROM dr WHERE s <= 20 GROUP BY 1, 2"""),
)
def value_profile(spark, sf):
    long = survey_long(spark, sf).where(~N.is_infinite(F.col("value")))
    out = S.value_profile(long, ["source", "key"], ["row_idx"])
    shown = F.array_join(F.transform("sample_values", lambda v: v.cast("string")), "|")
    return out.withColumns({"sample_values": shown, "mean_value": F.round("mean_value", 6)})


@query(
    "id_quality", "A14",
    with_sql(SURVEY_RAW, """
SELECT source, count(*) AS n_rows, count(DISTINCT HUMAN_ID) AS n_distinct,
  round(1 - count(DISTINCT HUMAN_ID) / count(*)::DOUBLE, 6) AS duplicate_rate FROM survey_raw GROUP BY 1"""),
)
def id_quality(spark, sf):
    return S.id_quality(survey_raw(spark, sf), ["HUMAN_ID"], ["source"]).withColumn("duplicate_rate", F.round("duplicate_rate", 6))


@query(
    "missing_ratio", "A15",
    with_sql(SURVEY_RAW, "SELECT source, " + ", ".join(
        f"round(avg(CASE WHEN {k} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS {k}" for k in SURVEY_KEYS
    ) + " FROM survey_raw GROUP BY 1"),
)
def missing_ratio(spark, sf):
    out = S.missing_ratio(survey_raw(spark, sf), SURVEY_KEYS, ["source"])
    return out.select("source", *[r6(k) for k in SURVEY_KEYS])


@query(
    "cross_source_ratio", "JN14",
    with_sql(SURVEY_RAW, SURVEY_LONG, UNITS, CANON, """
md AS (SELECT source, key, quantile_cont(value_m, 0.5) AS p50 FROM canon GROUP BY 1, 2 HAVING count(value_m) > 0)""", """
SELECT a.key, a.source AS source_a, b.source AS source_b, round(a.p50, 6) AS p50_a, round(b.p50, 6) AS p50_b,
  round(a.p50 / b.p50, 6) AS p50_ratio, a.p50 / b.p50 BETWEEN 0.5 AND 2.0 AS consistent
FROM md a JOIN md b ON a.key = b.key AND a.source < b.source"""),
)
def cross_source_ratio(spark, sf):
    out = S.cross_source_ratio(survey_canonical_counts(spark, sf), value="value_m", weight="n")
    return out.select("key", "source_a", "source_b", r6("p50_a"), r6("p50_b"), r6("p50_ratio"), "consistent")
