"""Relations the queries share, derived from the given tables, with the same relations as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.operators import curate as C
from tapeline.plans.registry import spread, table
from tapeline.sources.shared import written

SURVEY_KEYS = [
    "HEIGHT_M", "WAIST_CIRC_M", "CHEST_CIRC_M_REF", "HIP_WIDTH_M", "KNEE_HEIGHT_M", "WEIGHT_KG",
]


def with_sql(*parts: str) -> str:
    """CTEs followed by the final SELECT."""
    *ctes, last = parts
    return "WITH " + ",\n".join(ctes) + "\n" + last if ctes else last


def line_order():
    """The place of a line: its columns in order, which neither overflow nor collide however large the keys are."""
    return F.array(*[F.col(c).cast("bigint") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def survey_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw survey text from ``lineitem``: three sources by return flag; the line number decides which
    kind of dirt a row carries (commas, sentinels, blanks, words, infinities, NULLs)."""
    li = spread(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_returnflag", "l_linestatus",
        )
    )
    q = F.col("l_quantity").cast("bigint")
    h = (1000 + F.floor(F.round(F.col("l_extendedprice") * 100).cast("bigint") / 10000)).cast("bigint").cast("string")
    ln = F.col("l_linenumber")
    src = F.when(F.col("l_returnflag") == "A", "7th").when(F.col("l_returnflag") == "N", "8th_direct").otherwise("8th_3d")
    sex7 = F.when(F.col("l_linestatus") == "F", "여").otherwise("남")
    sex8 = F.when(F.col("l_linestatus") == "F", "f").otherwise("m")
    height = (
        F.when(ln == 1, F.concat(F.substring(h, 1, 1), F.lit(","), F.substring(h, 2, 3)))
        .when(ln == 2, F.concat(h, F.lit(",3")))
        .when(ln == 3, "9999")
        .when(ln == 4, "")
        .when(ln == 5, F.concat(F.substring(h, 1, 1), F.lit(","), F.substring(h, 2, 3), F.lit(".3")))
        .when(ln == 6, "n/a")
        .otherwise(F.concat(h, F.lit(".3")))
    )
    return li.select(
        src.alias("source"),
        line_order().alias("row_idx"),
        F.concat(F.lpad(F.col("l_orderkey").cast("string"), 8, "0"), F.when(ln == 1, ".0").otherwise("")).alias("HUMAN_ID"),
        F.when(ln == 3, "X").when(F.col("l_returnflag") == "A", sex7).otherwise(sex8).alias("SEX"),
        (q + 15).cast("string").alias("AGE"),
        height.alias("HEIGHT_M"),
        F.when(ln == 7, "inf").otherwise((q * 2 + 50).cast("string")).alias("WAIST_CIRC_M"),
        F.when(ln != 2, (q * 10 + 700).cast("string")).alias("CHEST_CIRC_M_REF"),
        F.when(q == 50, "9999").otherwise(F.concat(F.lit("0."), (q + 20).cast("string"))).alias("HIP_WIDTH_M"),
        F.when(F.col("l_returnflag") != "R", (q + 400).cast("string")).alias("KNEE_HEIGHT_M"),
        F.when(ln == 1, F.concat((q + 30).cast("string"), F.lit(",3"))).otherwise((q + 30).cast("string")).alias("WEIGHT_KG"),
    )


SURVEY_RAW = """survey_raw AS (
  SELECT CASE l_returnflag WHEN 'A' THEN '7th' WHEN 'N' THEN '8th_direct' ELSE '8th_3d' END AS source,
    [l_orderkey, l_linenumber, l_partkey, l_suppkey] AS row_idx,
    lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || CASE WHEN l_linenumber = 1 THEN '.0' ELSE '' END AS HUMAN_ID,
    CASE WHEN l_linenumber = 3 THEN 'X'
         WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'F' THEN '여' ELSE '남' END
         WHEN l_linestatus = 'F' THEN 'f' ELSE 'm' END AS SEX,
    CAST(q + 15 AS VARCHAR) AS AGE,
    CASE l_linenumber
      WHEN 1 THEN substr(h, 1, 1) || ',' || substr(h, 2, 3)
      WHEN 2 THEN h || ',3'
      WHEN 3 THEN '9999'
      WHEN 4 THEN ''
      WHEN 5 THEN substr(h, 1, 1) || ',' || substr(h, 2, 3) || '.3'
      WHEN 6 THEN 'n/a'
      ELSE h || '.3' END AS HEIGHT_M,
    CASE WHEN l_linenumber = 7 THEN 'inf' ELSE CAST(q * 2 + 50 AS VARCHAR) END AS WAIST_CIRC_M,
    CASE WHEN l_linenumber <> 2 THEN CAST(q * 10 + 700 AS VARCHAR) END AS CHEST_CIRC_M_REF,
    CASE WHEN q = 50 THEN '9999' ELSE '0.' || CAST(q + 20 AS VARCHAR) END AS HIP_WIDTH_M,
    CASE WHEN l_returnflag <> 'R' THEN CAST(q + 400 AS VARCHAR) END AS KNEE_HEIGHT_M,
    CASE WHEN l_linenumber = 1 THEN CAST(q + 30 AS VARCHAR) || ',3' ELSE CAST(q + 30 AS VARCHAR) END AS WEIGHT_KG
  FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q,
          CAST(1000 + CAST(round(l_extendedprice * 100) AS BIGINT) // 10000 AS VARCHAR) AS h FROM lineitem)
)"""


def sql_parse(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches(trim({c}), '^[+-]?\\d{{1,4}},\\d+$') "
        f"THEN TRY_CAST(replace(trim({c}), ',', '.') AS DOUBLE) "
        f"ELSE TRY_CAST(replace(trim({c}), ',', '') AS DOUBLE) END"
    )


def survey_long(spark: SparkSession, sf: str) -> DataFrame:
    """(source, row_idx, key, raw, parsed, is_sentinel, is_blank, value): number repair applied."""
    long = C.to_long(survey_raw(spark, sf), ["source", "row_idx"], SURVEY_KEYS, "raw")
    return C.repair(long)


SURVEY_LONG = (
    """long_raw AS (
"""
    + "\n  UNION ALL ".join(
        f"SELECT source, row_idx, '{k}' AS key, {k} AS raw FROM survey_raw" for k in SURVEY_KEYS
    )
    + """
),
survey_long AS (
  SELECT *, coalesce(parsed = 9999, false) AS is_sentinel, coalesce(trim(raw) = '', false) AS is_blank,
    nullif(parsed, 9999) AS value
  FROM (SELECT *, """
    + sql_parse("raw")
    + """ AS parsed FROM long_raw)
)"""
)

UNITS = """head AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, key ORDER BY row_idx, value) AS r
                 FROM survey_long WHERE value IS NOT NULL) WHERE r <= 100
),
units AS (
  SELECT source, key, sample_median, n_sample,
    CASE WHEN key = 'WEIGHT_KG' THEN 'kg' WHEN source = '7th' AND key LIKE '%\\_M%' ESCAPE '\\' THEN 'mm'
         WHEN sample_median > 1000 THEN 'mm' WHEN sample_median > 10 THEN 'cm' ELSE 'm' END AS unit
  FROM (SELECT source, key, quantile_cont(value, 0.5) AS sample_median, count(*) AS n_sample FROM head GROUP BY 1, 2)
)"""

CANON = """canon AS (
  SELECT *, CASE WHEN isinf(vm) OR isnan(vm) THEN NULL ELSE vm END AS value_m FROM (
    SELECT *, CASE WHEN treatment = 'none' THEN value
        WHEN isinf(value) OR isnan(value) THEN NULL
        ELSE round(value / CASE used_unit WHEN 'mm' THEN 1000.0::DOUBLE WHEN 'cm' THEN 100.0::DOUBLE WHEN 'm' THEN 1.0::DOUBLE END, 3) END AS vm
    FROM (SELECT *, CASE WHEN treatment IN ('default_mm', 'override_mm') THEN 'mm' WHEN treatment = 'applied' THEN unit END AS used_unit
      FROM (SELECT l.*, u.unit, CASE WHEN l.key = 'WEIGHT_KG' THEN 'none'
          WHEN u.unit IS NULL AND l.key LIKE '%\\_M' ESCAPE '\\' THEN 'default_mm'
          WHEN u.unit IS NULL THEN 'undetermined'
          WHEN l.source = '7th' AND l.key LIKE '%\\_M%' ESCAPE '\\' THEN 'override_mm'
          WHEN u.unit IN ('mm', 'cm', 'm') THEN 'applied' ELSE 'failed' END AS treatment
        FROM survey_long l LEFT JOIN units u ON l.source = u.source AND l.key = u.key)))
)"""


def survey_units(spark: SparkSession, sf: str) -> DataFrame:
    return C.infer_units(survey_long(spark, sf), ["row_idx", "value"])


def survey_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return C.canonicalize(survey_long(spark, sf), survey_units(spark, sf))


def survey_canonical_counts(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`survey_canonical` with equal texts of a source and key as one row, which stands for ``n`` rows: numbers are
    read and converted once per distinct text. Written, so that several uses count once."""
    long = C.to_long(survey_raw(spark, sf), ["source"], SURVEY_KEYS, "raw")
    counts = written(long.groupBy("source", "key", "raw").agg(F.count(F.lit(1)).alias("n")))
    return C.canonicalize(C.repair(counts), survey_units(spark, sf))


def cloud(spark: SparkSession, sf: str) -> DataFrame:
    """Vertex table from ``lineitem``: one case per supplier, quantity / price / discount as x / y / z."""
    li = spread(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
        )
    )
    return li.select(
        F.col("l_suppkey").alias("case_id"), line_order().alias("vertex_id"),
        (F.col("l_quantity") / 50.0).alias("x"), (F.col("l_extendedprice") / 100000.0).alias("y"),
        F.col("l_discount").alias("z"), (F.col("l_tax") * 10.0).alias("arm_w"),
    )


CLOUD = """cloud AS (
  SELECT l_suppkey AS case_id, [l_orderkey, l_linenumber, l_partkey, l_suppkey] AS vertex_id,
    l_quantity / 50.0::DOUBLE AS x, l_extendedprice / 100000.0::DOUBLE AS y, l_discount AS z, l_tax * 10.0::DOUBLE AS arm_w,
    CAST(round(l_quantity) AS BIGINT) AS u, CAST(round(l_discount * 100) AS BIGINT) AS v FROM lineitem
)"""

BOXES = """boxes AS (
  SELECT *, x_max - x_min AS span_x, y_max - y_min AS span_y, z_max - z_min AS span_z FROM (
    SELECT case_id, count(*) AS n_verts, min(x) AS x_min, max(x) AS x_max, min(y) AS y_min, max(y) AS y_max,
      min(z) AS z_min, max(z) AS z_max, avg(x) AS x_mean, avg(y) AS y_mean, avg(z) AS z_mean FROM cloud GROUP BY 1)
)"""


def sql_bands(bands: dict) -> str:
    rows = ", ".join(f"('{k}', {b[0]}::DOUBLE, {b[1]}::DOUBLE, '{b[2]}', '{b[3]}')" for k, b in bands.items())
    return f"bands AS (SELECT * FROM (VALUES {rows}) t(key, lo, hi, rule, tie))"


def sql_slices(adaptive: bool = True, axis: str = "y", lo: str = "y_min", span: str = "span_y", src: str = "cloud") -> str:
    tol = (
        "greatest(least(greatest(list_sort([span_x, span_y, span_z])[2] * 0.002, base), 0.01), 1e-5)" if adaptive else "base"
    )
    return f"""planes AS (
  SELECT case_id, key, slice, start + slice * step AS y_slice, {tol} AS tolerance FROM (
    SELECT *, step * 0.5 AS base FROM (
      SELECT *, (stop - start) / 19 AS step FROM (
        SELECT b.*, k.key, b.{lo} + k.lo * b.{span} AS start, b.{lo} + k.hi * b.{span} AS stop FROM boxes b, bands k))),
    (SELECT CAST(range AS INTEGER) AS slice FROM range(20))
),
sp AS (SELECT p.case_id, p.key, p.slice, p.y_slice, c.* EXCLUDE (case_id) FROM planes p JOIN {src} c
  ON p.case_id = c.case_id AND abs(c.{axis} - p.y_slice) < p.tolerance)"""


def sql_hull(src: str, keys: str, su: str = "50.0", sv: str = "100.0", out: str = "hulls") -> str:
    """Hull perimeter and area per group by definition: an edge has every other point on its left."""
    on = lambda a, b: " AND ".join(f"{a}.{k.strip()} = {b}.{k.strip()}" for k in keys.split(","))
    ks = ", ".join(f"p.{k.strip()}" for k in keys.split(","))
    cross = "((q.u - p.u) * (r.v - p.v) - (q.v - p.v) * (r.u - p.u))"
    dot = "((r.u - p.u) * (r.u - q.u) + (r.v - p.v) * (r.v - q.v))"
    return f"""d_{out} AS (SELECT DISTINCT {keys}, u, v FROM {src}),
e_{out} AS (
  SELECT {ks}, p.u AS pu, p.v AS pv, q.u AS qu, q.v AS qv FROM d_{out} p JOIN d_{out} q ON {on('p', 'q')} AND (p.u <> q.u OR p.v <> q.v)
  WHERE NOT EXISTS (SELECT 1 FROM d_{out} r WHERE {on('r', 'p')} AND ({cross} < 0 OR ({cross} = 0 AND {dot} > 0)))
),
{out} AS (
  SELECT {keys}, sum(sqrt(((qu - pu) / {su}) ** 2 + ((qv - pv) / {sv}) ** 2)) AS perimeter_m,
    abs(sum((pu * qv - qu * pv) / ({su} * {sv}))) / 2 AS area_m2 FROM e_{out} GROUP BY ALL
)"""


SLICE_ROWS = """cnt AS (SELECT case_id, key, slice, min(y_slice) AS y_slice, count(*) AS n_points, count(DISTINCT (u, v)) AS nd,
  max(x) - min(x) AS width_m, max(z) - min(z) AS depth_m FROM sp GROUP BY 1, 2, 3),
st AS (SELECT c.*, round(h.perimeter_m, 9) AS p FROM cnt c JOIN hulls h USING (case_id, key, slice) WHERE c.nd >= 3)"""

PICKED = """md AS (SELECT case_id, key, quantile_cont(p, 0.5) AS med, count(*) AS n_candidates FROM st GROUP BY 1, 2),
picked AS (SELECT * FROM (SELECT st.*, md.n_candidates, row_number() OVER (PARTITION BY st.case_id, st.key ORDER BY
    CASE b.rule WHEN 'max' THEN -p WHEN 'min' THEN p ELSE round(abs(p - med), 9) END, CASE b.tie WHEN 'high' THEN -slice ELSE slice END) AS rn
  FROM st JOIN md ON st.case_id = md.case_id AND st.key = md.key JOIN bands b ON b.key = st.key) WHERE rn = 1)"""


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Measurement results from ``events``: user = case, type = key, day = run; ``k`` of the properties
    decides missing values and warnings."""
    e = table(spark, sf, "events")
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("int")
    key = F.concat(F.upper("event_type"), F.lit("_M"))
    none = F.array().cast("array<string>")
    warnings = (
        F.when(F.col("k") >= 80, F.array(F.concat(F.lit("SCALE_SUSPECTED:"), F.col("standard_key")), F.lit("RANGE_SUSPECTED")))
        .when(F.col("k") >= 60, F.array(F.lit("EXEC_FAIL:TYPE_ERROR")))
        .when(F.col("k") >= 55, F.array(F.lit("EXEC_FAIL:VALUE_ERROR"), F.lit("NOTE")))
        .otherwise(none)
    )
    kind = F.when(F.col("user_id") % 3 == 0, "normal_").when(F.col("user_id") % 3 == 1, "varied_").otherwise("other_")
    e = e.withColumn("k", k).withColumn("standard_key", key)
    return e.select(
        F.concat(kind, F.col("user_id").cast("string")).alias("case_id"), "event_id",
        F.concat(F.lit("run_"), F.date_format("ts", "yyyyMMdd")).alias("run_id"), "standard_key", "k",
        F.when((F.col("k") < 10) | (F.col("k") >= 90), None).otherwise(F.col("value")).alias("value"),
        warnings.alias("warnings"),
    )


RESULTS = """results AS (
  SELECT CASE user_id % 3 WHEN 0 THEN 'normal_' WHEN 1 THEN 'varied_' ELSE 'other_' END || CAST(user_id AS VARCHAR) AS case_id, event_id,
    'run_' || strftime(ts, '%Y%m%d') AS run_id, standard_key, k, CASE WHEN k < 10 OR k >= 90 THEN NULL ELSE value END AS value,
    CASE WHEN k >= 80 THEN ['SCALE_SUSPECTED:' || standard_key, 'RANGE_SUSPECTED'] WHEN k >= 60 THEN ['EXEC_FAIL:TYPE_ERROR']
      WHEN k >= 55 THEN ['EXEC_FAIL:VALUE_ERROR', 'NOTE'] ELSE [] END AS warnings
  FROM (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k, upper(event_type) || '_M' AS standard_key FROM events)
)"""


def residuals(spark: SparkSession, sf: str) -> DataFrame:
    """Three residuals (metres) per line from ``lineitem``; NULL hip where the discount is zero."""
    li = spread(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
        )
    )
    return li.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
        ((F.col("l_quantity") - 25) / 1000).alias("BUST_CIRC_M"),
        ((F.col("l_extendedprice") - 50000) / 500000).alias("WAIST_CIRC_M"),
        F.when(F.col("l_discount") != 0, (F.col("l_tax") - F.col("l_discount")) / 2).alias("HIP_CIRC_M"),
    )


RESIDUALS = """residuals AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, (l_quantity - 25) / 1000::DOUBLE AS b, (l_extendedprice - 50000) / 500000::DOUBLE AS w,
    CASE WHEN l_discount <> 0 THEN (l_tax - l_discount) / 2::DOUBLE END AS h FROM lineitem
),
scored AS (SELECT *, greatest(0, least(100, 100 - (abs(b) * 100 + abs(w) * 100 + coalesce(abs(h) * 100, 0)))) AS score FROM residuals)"""


# The comparison SQL of a progress log derived from ``events``.
PROGRESS = """progress AS (
  SELECT event_id AS ordinal, ts, k,
    CASE user_id % 3 WHEN 0 THEN 'body' WHEN 1 THEN 'fitting' ELSE 'garment' END AS module,
    CASE event_type WHEN 'click' THEN 'round_start' WHEN 'signup' THEN 'round_end' ELSE event_type END AS event_type,
    CASE WHEN k < 8 THEN 'UNSPECIFIED' WHEN k >= 12 THEN 'S' || CAST(user_id % 20 AS STRING) END AS step_id,
    CASE WHEN k % 5 = 0 THEN ' ' ELSE 'R' || substr(CAST(ts AS STRING), 9, 2) END AS round_id,
    CASE WHEN k < 70 THEN 'short' WHEN k = 88 THEN 'referenced_line=' || CAST(user_id AS STRING) || '/' || CAST(event_id - 5 AS STRING)
      ELSE 'a longer note, k=' || CAST(k AS STRING) END AS note,
    CASE WHEN k = 97 THEN 'not-a-time' ELSE substr(CAST(ts AS STRING), 1, 10) || 'T' || substr(CAST(ts AS STRING), 12, 8)
      || CASE WHEN k % 2 = 0 THEN 'Z' ELSE '+09:00' END END AS ts_text,
    CASE WHEN k < 20 THEN '"STEP_ID_MISSING"' WHEN k < 30 THEN '["STEP_ID_BACKFILLED","EXTRA"]' WHEN k < 40 THEN '[]'
      WHEN k = 88 THEN '["SCHEMA_VIOLATION_BACKFILLED"]' END AS gate_codes,
    CASE WHEN k BETWEEN 40 AND 45 THEN '[EVENT_THIN] few words' WHEN k BETWEEN 46 AND 50 THEN 'plain text' ELSE '' END AS warning,
    CAST(k % 3 AS INT) AS dod_done_delta, CASE WHEN k % 7 <> 0 THEN CAST(5 + k % 4 AS INT) END AS dod_total,
    CASE WHEN k % 4 = 3 THEN '' ELSE 'exports/runs/lane' || CAST(user_id % 4 AS STRING) || '/run_' || substr(CAST(ts AS STRING), 9, 2) || '/'
      || CASE k % 4 WHEN 0 THEN 'geometry_manifest.json:12' WHEN 1 THEN 'facts_summary.json' ELSE 'RUN_README.md' END END AS path1,
    CASE WHEN k % 6 = 0 THEN 'exports/runs/other/run_x/geometry_manifest.json' ELSE 'docs' || chr(92) || 'note.md' END AS path2
  FROM (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) AS k FROM events)
)"""


def progress(spark: SparkSession, sf: str) -> DataFrame:
    """A progress log from ``events``: the user decides module, step, lane and run, ``k`` of the properties everything else."""
    from tapeline.functions.times import event_time

    e = table(spark, sf, "events").withColumn("k", F.regexp_extract("props", r'"k": ([0-9]+)', 1).cast("int"))
    k, user, kind = F.col("k"), F.col("user_id"), F.col("event_type")
    ts, text = F.col("ts").cast("string"), lambda c: c.cast("string")
    day = F.substring(ts, 9, 2)
    stamp = F.concat(F.substring(ts, 1, 10), F.lit("T"), F.substring(ts, 12, 8), F.when(k % 2 == 0, "Z").otherwise("+09:00"))
    name = F.when(k % 4 == 0, "geometry_manifest.json:12").when(k % 4 == 1, "facts_summary.json").otherwise("RUN_README.md")
    p = e.select(
        F.col("event_id").alias("ordinal"), "ts", "k",
        F.when(user % 3 == 0, "body").when(user % 3 == 1, "fitting").otherwise("garment").alias("module"),
        F.when(kind == "click", "round_start").when(kind == "signup", "round_end").otherwise(kind).alias("event_type"),
        F.when(k < 8, "UNSPECIFIED").when(k >= 12, F.concat(F.lit("S"), text(user % 20))).alias("step_id"),
        F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit("R"), day)).alias("round_id"),
        F.when(k < 70, "short").when(k == 88, F.concat(F.lit("referenced_line="), text(user), F.lit("/"), text(F.col("event_id") - 5)))
        .otherwise(F.concat(F.lit("a longer note, k="), text(k))).alias("note"),
        F.when(k == 97, "not-a-time").otherwise(stamp).alias("ts_text"),
        F.when(k < 20, '"STEP_ID_MISSING"').when(k < 30, '["STEP_ID_BACKFILLED","EXTRA"]').when(k < 40, "[]")
        .when(k == 88, '["SCHEMA_VIOLATION_BACKFILLED"]').alias("gate_codes"),
        F.when(k.between(40, 45), "[EVENT_THIN] few words").when(k.between(46, 50), "plain text").otherwise("").alias("warning"),
        (k % 3).alias("dod_done_delta"), F.when(k % 7 != 0, k % 4 + 5).alias("dod_total"),
        F.when(k % 4 == 3, "").otherwise(F.concat(F.lit("exports/runs/lane"), text(user % 4), F.lit("/run_"), day, F.lit("/"), name)).alias("path1"),
        F.when(k % 6 == 0, "exports/runs/other/run_x/geometry_manifest.json").otherwise("docs\\note.md").alias("path2"),
    )
    return p.withColumns(
        {
            "warnings": F.filter(F.array("warning"), lambda w: w != ""),
            "paths": F.array("path2", "path1"),
            "time": event_time(F.col("ts_text")),
        }
    )
