"""Queries that go through files and streams: the tables are written as the text a source reads, then
read back by the source, a sink or a stream. The comparison SQL skips the files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.functions import paths as P
from tapeline.operators import events as E
from tapeline.plans.inputs import CLOUD, PROGRESS, RESULTS, SURVEY_RAW, cloud, progress, results, survey_raw, with_sql
from tapeline.plans.logs import CODES, FINDINGS
from tapeline.plans.registry import query, table
from tapeline.sources import records as R
from tapeline.sources import sinks as K
from tapeline.sources import survey as V
from tapeline.sources.shared import scratch
from tapeline.streaming import jobs as J


@query(
    "source_events", "S7",
    with_sql(PROGRESS, CODES, """
SELECT module, event_type, count(*) AS n, CAST(sum(dod_done_delta) AS BIGINT) AS delta, count(step_id) AS n_steps, CAST(sum(len(gc)) AS BIGINT) AS n_codes, count(*) FILTER (WHERE warning <> '') AS n_warnings
FROM coded WHERE k <> 97 GROUP BY 1, 2"""),
)
def source_events(spark, sf):
    p = progress(spark, sf)
    body = F.to_json(F.struct(F.col("ts_text").alias("ts"), "module", "event_type", "step_id", "note", "warnings", "dod_done_delta"))
    line = F.concat(F.regexp_replace(body, "}$", ""), F.lit(',"gate_codes":'), F.coalesce("gate_codes", F.lit("null")), F.lit("}"))
    where = scratch(spark)
    p.select(F.when(F.col("k") == 97, F.substring(line, 1, 30)).otherwise(line).alias("value")).write.text(where)
    e = R.read_events(spark, where)
    return e.groupBy("module", "event_type").agg(
        F.count("*").alias("n"), F.sum("dod_done_delta").alias("delta"), F.count("step_id").alias("n_steps"),
        F.sum(F.size(P.gate_codes(F.col("gate_codes")))).cast("bigint").alias("n_codes"),
        F.count_if(F.size("warnings") > 0).alias("n_warnings"),
    )


@query(
    "source_documents", "S8",
    """
SELECT CAST(l_suppkey AS BIGINT) AS suppkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity, l_suppkey % 10 = 3 AS broken FROM lineitem GROUP BY l_suppkey""",
)
def source_documents(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    doc = F.to_json(F.struct("n", "quantity"))
    where = scratch(spark)
    text = F.when(F.col("l_suppkey") % 10 == 3, F.regexp_replace(doc, "}$", "")).otherwise(doc)
    g.select(F.col("l_suppkey").alias("run"), text.alias("value")).repartition("run").write.partitionBy("run").text(where)
    d = R.read_documents(spark, where, "*.txt")
    key = F.regexp_extract("path", r"run=(\d+)", 1).cast("bigint")
    num = lambda n: F.regexp_extract("doc", f'"{n}":(\\d+)', 1).cast("bigint").alias(n)
    return d.select(key.alias("suppkey"), num("n"), num("quantity"), F.col("v").isNull().alias("broken"))


@query(
    "source_mesh", "S9",
    with_sql(CLOUD, """
SELECT case_id, count(*) FILTER (WHERE v <> 10) AS n_verts, count(*) FILTER (WHERE v <> 10) - 1 AS last_id, CAST(sum(u) FILTER (WHERE v <> 10) AS DOUBLE) AS x_sum,
  count(*) FILTER (WHERE v > 4) AS n_faces FROM cloud GROUP BY 1"""),
)
def source_mesh(spark, sf):
    c = cloud(spark, sf)
    u, v = F.round(F.col("x") * 50).cast("int").cast("string"), F.round(F.col("z") * 100).cast("int")
    vert = F.concat(F.lit("v "), u, F.when(v == 10, " bad ").otherwise(" 1.5  "), v.cast("string"))
    face = F.when(v > 4, "f 1/1/1 2//2 3 x").otherwise("f 1 2")
    where = scratch(spark)
    c.select("case_id", F.explode(F.array(vert, F.lit("# note"), face)).alias("value")).repartition("case_id").write.partitionBy("case_id").text(where)
    verts, faces = R.read_obj(spark, where)
    case = F.regexp_extract("case_id", r"case_id=(\d+)", 1).cast("bigint").alias("case_id")
    a = verts.groupBy(case).agg(F.count("*").alias("n_verts"), F.max("vertex_id").alias("last_id"), F.sum("x").alias("x_sum"))
    b = faces.groupBy(case).agg(F.count("*").alias("n_faces"))
    return a.join(b, "case_id", "left").na.fill(0, ["n_faces"])


CELLS = """cells AS (SELECT l_orderkey AS file, CAST(l_linenumber AS INT) AS row_idx, l_suppkey % 7 AS col_idx,
  CASE WHEN l_linenumber = 2 AND l_quantity < 25 THEN ' 표준 측정항목 명' WHEN l_linenumber = 3 AND l_discount > 0.05 THEN 'x 표준 측정항목 코드' WHEN l_linenumber = 5 AND l_tax > 0.04 THEN '12.0 성별'
    WHEN l_quantity < 5 THEN '' WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 15 THEN 'Unnamed: 3' WHEN l_quantity < 30 THEN '목둘레' ELSE 'A-' || l_returnflag END AS cell FROM lineitem)"""


def _cells(spark, sf):
    q, ln = F.col("l_quantity"), F.col("l_linenumber")
    cell = (
        F.when((ln == 2) & (q < 25), " 표준 측정항목 명").when((ln == 3) & (F.col("l_discount") > 0.05), "x 표준 측정항목 코드")
        .when((ln == 5) & (F.col("l_tax") > 0.04), "12.0 성별").when(q < 5, "").when(q < 10, None)
        .when(q < 15, "Unnamed: 3").when(q < 30, "목둘레").otherwise(F.concat(F.lit("A-"), "l_returnflag"))
    )
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("file"), ln.alias("row_idx"), (F.col("l_suppkey") % 7).alias("col_idx"), cell.alias("cell")
    )


HEADER = """pr AS (SELECT file, min(row_idx) FILTER (WHERE trim(cell) = '표준 측정항목 명') AS p FROM cells GROUP BY 1),
hd AS (SELECT file, coalesce(max(p), CASE WHEN file % 4 < 3 THEN 6 ELSE 4 END) AS "primary", min(row_idx) FILTER (WHERE row_idx = p + 1 AND contains(cell, '표준 측정항목 코드')) AS code,
  min(row_idx) FILTER (WHERE row_idx BETWEEN p + 1 AND p + 6 AND contains(cell, '성별')) AS secondary FROM cells JOIN pr USING (file) GROUP BY 1)"""


def _header_default():
    """Three of four files are sheets of the three surveys, the fourth is of no known source."""
    kind = F.col("file") % 4
    return V.default_header(F.when(kind == 0, "7th").when(kind == 1, "8th_direct").when(kind == 2, "8th_3d").otherwise("other"))


@query("header_rows", "S2", with_sql(CELLS, HEADER, """SELECT "primary", coalesce(code, -1) AS code, coalesce(secondary, -1) AS secondary, count(*) AS n FROM hd GROUP BY 1, 2, 3"""))
def header_rows(spark, sf):
    h = V.locate_header_rows(_cells(spark, sf), strip_prefix=True, default=_header_default())
    c = [F.coalesce(x, F.lit(-1)).alias(x) for x in ("code", "secondary")]
    return h.groupBy("primary", *c).agg(F.count("*").alias("n"))


@query(
    "header_cut", "S3",
    with_sql(CELLS, HEADER, """
SELECT row_idx, count(*) AS n FROM cells JOIN hd USING (file) WHERE row_idx > greatest("primary", coalesce(code, -1), coalesce(secondary, -1)) GROUP BY 1"""),
)
def header_cut(spark, sf):
    c = _cells(spark, sf)
    return V.cut_header(c, V.locate_header_rows(c, default=_header_default())).groupBy("row_idx").agg(F.count("*").alias("n"))


SCORES = """pv AS (SELECT file, row_idx, CASE WHEN coalesce(trim(cell), '') <> '' THEN trim(cell) END AS v, count(*) AS n, count(*) FILTER (WHERE starts_with(cell, 'Unnamed:')) AS u FROM cells GROUP BY 1, 2, 3),
ag AS (SELECT file, row_idx, sum(n) AS nc, sum(n) FILTER (WHERE v IS NOT NULL) AS nf, sum(CASE WHEN v IS NULL THEN n ELSE u END) AS nb, count(v) AS nu,
  sum(CASE WHEN regexp_matches(v, '[가-힣]') THEN n ELSE 0 END) AS nh, count(*) FILTER (WHERE v IS NOT NULL AND n > 1) AS nr FROM pv GROUP BY 1, 2),
sc AS (SELECT file, row_idx, CASE WHEN coalesce(nf, 0) = 0 THEN 0 ELSE (1 - nb / nc) * 40 + nu / nc * 30 + nh / nf * 20 + CASE WHEN nf > 1 THEN (1 - nr / nu) * 10 ELSE 0 END END AS score
  FROM (SELECT file, row_idx, nc::DOUBLE AS nc, nf::DOUBLE AS nf, nb::DOUBLE AS nb, nu::DOUBLE AS nu, nh::DOUBLE AS nh, nr::DOUBLE AS nr FROM ag))"""


@query("header_scores", "P16", with_sql(CELLS, SCORES, "SELECT file, row_idx, round(score, 6) AS score FROM sc"))
def header_scores(spark, sf):
    return V.score_header_rows(_cells(spark, sf)).select("file", "row_idx", F.round("score", 6).alias("score"))


@query(
    "best_header", "P16",
    with_sql(CELLS, SCORES, """
SELECT row_idx, count(*) AS n, round(sum(s), 3) AS total FROM (SELECT file, row_idx, round(score, 9) AS s, row_number() OVER (PARTITION BY file ORDER BY round(score, 9) DESC, row_idx) AS rn FROM sc) WHERE rn = 1 GROUP BY 1"""),
)
def best_header(spark, sf):
    b = V.best_header_row(V.score_header_rows(_cells(spark, sf)))
    return b.groupBy("row_idx").agg(F.count("*").alias("n"), F.round(F.sum("score"), 3).alias("total"))


@query(
    "merge_headers", "P17",
    with_sql(CELLS, """
pr AS (SELECT file, col_idx, coalesce(max(trim(cell)) FILTER (WHERE row_idx = 6), '') AS u, coalesce(max(trim(cell)) FILTER (WHERE row_idx = 7), '') AS l FROM cells GROUP BY 1, 2),
cd AS (SELECT file, count(*) FILTER (WHERE regexp_matches(u, '^[A-Za-z0-9\\-_\\[\\]]+$')) > count(*) * 0.5 AS codes FROM pr WHERE u <> '' GROUP BY 1)""", """
SELECT name, count(*) AS n FROM (SELECT CASE WHEN l <> '' AND (u = '' OR coalesce(codes, false)) THEN l WHEN u <> '' AND l <> '' THEN u || '_' || l ELSE u END AS name FROM pr LEFT JOIN cd USING (file)) GROUP BY 1"""),
)
def merge_headers(spark, sf):
    return V.merge_headers(_cells(spark, sf), ["file"], 6, 7).groupBy("name").agg(F.count("*").alias("n"))


@query(
    "dedupe_names", "P17 W6",
    """
SELECT o_custkey AS file, position, CASE WHEN n = 0 THEN name ELSE name || '__dup' || CAST(n AS VARCHAR) END AS unique_name FROM (
  SELECT o_custkey, o_orderkey AS position, o_orderstatus AS name, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) - 1 AS n FROM orders)""",
)
def dedupe_names(spark, sf):
    n = table(spark, sf, "orders").select(F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("position"), F.col("o_orderstatus").alias("name"))
    return V.dedupe_name_rows(n, ["file"]).select("file", "position", "unique_name")


@query(
    "scan_to_long", "S11",
    """
SELECT sex, age, name, count(*) AS n, count(v) AS n_values, round(sum(v), 3) AS total FROM (
  SELECT l_linestatus AS sex, CAST(20 + l_linenumber AS INTEGER) AS age, l_returnflag AS name, CASE WHEN l_tax > 0.05 THEN NULL ELSE round_even((floor(l_extendedprice) + 0.3::DOUBLE) / 1000, 3) END AS v
  FROM lineitem WHERE l_discount <> 0.1) GROUP BY 1, 2, 3""",
)
def scan_to_long(spark, sf):
    li = table(spark, sf, "lineitem")
    gone = F.col("l_discount") == 0.1
    text = F.concat(F.floor("l_extendedprice").cast("string"), F.lit(".3"))
    sheet = li.select(
        F.when(~gone, F.col("l_orderkey").cast("string")).alias("no"), F.when(gone, " ").otherwise("C").alias("code"),
        F.when(~gone, F.col("l_returnflag")).alias("name"), F.when(gone, None).when(F.col("l_tax") > 0.05, "-").otherwise(text).alias("value"),
        F.concat(F.lit("sex : "), F.lower("l_linestatus"), F.lit(" / age : "), (F.col("l_linenumber") + 20).cast("string")).alias("meta"),
    )
    return V.scan_to_long(sheet, "meta").groupBy("sex", "age", "name").agg(
        F.count("*").alias("n"), F.count("value_m").alias("n_values"), F.round(F.sum("value_m"), 3).alias("total")
    )


@query("limit_rows", "S14", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50")
def limit_rows(spark, sf):
    return V.limit_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 50, "o_orderkey")


@query(
    "latest_run", "S12",
    """
WITH f AS (SELECT user_id % 4 AS lane, '/exports/' || CASE WHEN k < 20 THEN 'old' ELSE 'runs' END || '/lane/run_' || strftime(ts, '%Y%m%d_%H%M%S') || '/e' || CAST(event_id AS VARCHAR) AS path, date_trunc('second', ts) AS t
  FROM (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) AS k FROM events))
SELECT lane, max_by(path, (t, path)) AS path FROM f WHERE path NOT LIKE '%/old/%' GROUP BY 1""",
)
def latest_run(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.regexp_extract("props", r'"k": (\d+)', 1).cast("int"))
    stamp = F.date_format("ts", "yyyyMMdd_HHmmss")
    path = F.concat(
        F.lit("/exports/"), F.when(F.col("k") < 20, "old").otherwise("runs"), F.lit("/lane/run_"), stamp, F.lit("/e"), F.col("event_id").cast("string")
    )
    files = e.select((F.col("user_id") % 4).alias("lane"), path.alias("path"), F.timestamp_seconds(F.lit(0)).alias("modified"))
    return R.latest_run(files, ["lane"], exclude="old")


@query(
    "safe_json", "S13",
    with_sql(RESULTS, """
SELECT standard_key, count(*) AS n, count(*) FILTER (WHERE value IS NULL OR k = 50) AS n_null FROM results GROUP BY 1"""),
)
def safe_json(spark, sf):
    nan = F.when(F.col("k") == 50, F.lit(float("nan"))).otherwise(F.col("value"))
    where = scratch(spark)
    K.write_safe_json(results(spark, sf).select("standard_key", nan.alias("value")), where)
    back = spark.read.text(where).select(F.from_json("value", "standard_key string, value double").alias("r"), F.get_json_object("value", "$.value").alias("raw"))
    return back.groupBy("r.standard_key").agg(F.count("*").alias("n"), F.count_if(F.col("raw").isNull()).alias("n_null"))


@query(
    "curated_roundtrip", "S5 S10",
    with_sql(SURVEY_RAW, "SELECT source, count(*) AS n, count(KNEE_HEIGHT_M) AS n_knee, min(HUMAN_ID) AS first_id FROM survey_raw GROUP BY 1"),
)
def curated_roundtrip(spark, sf):
    where = scratch(spark)
    K.write_curated(survey_raw(spark, sf).withColumnRenamed("source", "_source"), where)
    return K.read_curated(spark, where).groupBy(F.col("_source").alias("source")).agg(
        F.count("*").alias("n"), F.count("KNEE_HEIGHT_M").alias("n_knee"), F.min("HUMAN_ID").alias("first_id")
    )


@query(
    "warnings_roundtrip", "S6",
    with_sql(PROGRESS, "SELECT code, count(*) AS n, count(DISTINCT ordinal) AS n_rows FROM (SELECT ordinal, 'STEP_ID_MISSING' AS code FROM progress WHERE step_id IS NULL) GROUP BY 1"),
)
def warnings_roundtrip(spark, sf):
    where = scratch(spark)
    K.write_warnings(E.schema_findings(progress(spark, sf)), where)
    return spark.read.schema("ordinal long, code string").json(where).groupBy("code").agg(
        F.count("*").alias("n"), F.count_distinct("ordinal").alias("n_rows")
    )


# --- streams --------------------------------------------------------------------------------------


def _stream(spark, sf, *cols):
    where = scratch(spark)
    rows = progress(spark, sf).select(*cols)
    rows.write.parquet(f"{where}/in")
    return spark.readStream.schema(rows.schema).parquet(f"{where}/in"), where


@query(
    "stream_cursor", "ST1",
    with_sql(PROGRESS, "SELECT module, count(*) AS n, max(ordinal) AS last_ordinal FROM progress WHERE event_type = 'round_end' GROUP BY 1"),
)
def stream_cursor(spark, sf):
    s, where = _stream(spark, sf, "module", "event_type", "ordinal")
    for _ in range(2):
        J.run_once(J.only(s, "round_end"), f"{where}/out", f"{where}/cursor")
    return spark.read.parquet(f"{where}/out").groupBy("module").agg(F.count("*").alias("n"), F.max("ordinal").alias("last_ordinal"))


@query(
    "streaming_dedupe", "ST2",
    with_sql(PROGRESS, CODES, "SELECT DISTINCT module, step_id, event_type FROM coded WHERE tm IS NOT NULL AND step_id IS NOT NULL"),
)
def streaming_dedupe(spark, sf):
    keys = ["module", "step_id", "event_type"]
    s, where = _stream(spark, sf, *keys, "time")
    known = s.where(F.col("time").isNotNull() & F.col("step_id").isNotNull())
    J.run_once(J.first_records(known, keys, look_back="60 days"), f"{where}/out", f"{where}/state")
    return spark.read.parquet(f"{where}/out").select(*keys)


@query(
    "streaming_transitions", "ST3",
    with_sql(PROGRESS, """
SELECT key, ordinal FROM (SELECT *, lag(flag, 1, false) OVER (PARTITION BY key ORDER BY ordinal) AS was FROM (
  SELECT module || '/' || step_id AS key, ordinal, k >= 80 AS flag FROM progress WHERE step_id IS NOT NULL)) WHERE flag AND NOT was"""),
)
def streaming_transitions(spark, sf):
    s, where = _stream(spark, sf, "module", "step_id", "k", "ordinal")
    flags = s.where(F.col("step_id").isNotNull()).select(
        F.concat_ws("/", "module", "step_id").alias("key"), (F.col("k") >= 80).alias("flag"), "ordinal"
    )
    J.run_batches(flags, J.transition_batches(f"{where}/out", 1000), f"{where}/state")
    return J.found_transitions(spark, f"{where}/out")


@query(
    "streaming_window", "ST4",
    with_sql(PROGRESS, CODES, """
w AS (SELECT CAST(floor(epoch(tm) / 86400) * 86400 AS BIGINT) AS start_s, module, count(*) FILTER (WHERE event_type = 'round_start') AS starts, count(*) FILTER (WHERE event_type = 'round_end') AS ends,
  count(*) AS n_events, CAST(max(epoch(tm)) AS BIGINT) AS last_s FROM coded WHERE tm IS NOT NULL GROUP BY 1, 2)""", """
SELECT start_s, module, starts, ends, n_events, last_s, starts > ends AS end_missing FROM w WHERE start_s + 86400 <= (SELECT max(epoch(tm)) - 3600 FROM coded)"""),
)
def streaming_window(spark, sf):
    s, where = _stream(spark, sf, "module", "event_type", "time")
    J.run_once(J.balance_windows(s), f"{where}/out", f"{where}/state")
    return spark.read.parquet(f"{where}/out").select(
        F.unix_timestamp("start").alias("start_s"), "module", "starts", "ends", "n_events", F.unix_timestamp("last_time").alias("last_s"), "end_missing"
    )


@query(
    "streaming_correction", "ST5",
    with_sql(PROGRESS, CODES, FINDINGS, """
ex AS (SELECT DISTINCT TRY_CAST(unnest(string_split(regexp_extract(note, 'referenced_line=([0-9/]+)', 1), '/')) AS BIGINT) AS ordinal FROM coded WHERE list_contains(gc, 'SCHEMA_VIOLATION_BACKFILLED'))""", """
SELECT ordinal, code FROM fd WHERE ordinal NOT IN (SELECT ordinal FROM ex WHERE ordinal IS NOT NULL)"""),
)
def streaming_correction(spark, sf):
    s, where = _stream(spark, sf, "ordinal", "ts_text", "module", "step_id", "event_type", "gate_codes", "note")
    J.run_batches(s, J.correct_batch(f"{where}/out"), f"{where}/state")
    return J.corrected_findings(spark, f"{where}/out")
