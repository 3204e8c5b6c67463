"""Queries over the progress log, the plan, names and paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.functions import keys as K
from tapeline.functions import paths as P
from tapeline.functions import times as T
from tapeline.operators import curate as C
from tapeline.operators import events as E
from tapeline.operators import plan as L
from tapeline.operators import sets as S
from tapeline.plans.inputs import PROGRESS, progress, with_sql
from tapeline.plans.registry import query, table

NOW = 1706616000  # 2024-01-30T12:00:00Z

CODES = """coded AS (SELECT *, CASE WHEN gate_codes LIKE '[%' THEN from_json(gate_codes, '["VARCHAR"]') WHEN gate_codes IS NULL THEN [] ELSE [trim(gate_codes, '"')] END AS gc,
  CASE WHEN regexp_matches(warning, '^\\[([^\\]]+)\\]') THEN [regexp_extract(warning, '^\\[([^\\]]+)\\]', 1)] ELSE [] END AS wc,
  CASE WHEN ts_text = 'not-a-time' THEN NULL ELSE TRY_CAST(ts_text AS TIMESTAMPTZ) END AS tm FROM progress)"""


def _now():
    return F.timestamp_seconds(F.lit(NOW))


@query(
    "last_n_events", "W1",
    with_sql(PROGRESS, """
SELECT module, ordinal, coalesce(step_id, '') AS step_id FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY ordinal DESC) AS b FROM progress) WHERE b <= 30"""),
)
def last_n_events(spark, sf):
    return E.last_n(progress(spark, sf), 30).select("module", "ordinal", F.coalesce("step_id", F.lit("")).alias("step_id"))


@query(
    "last_known", "W2",
    with_sql(PROGRESS, """
SELECT module, max_by(step_id, ordinal) FILTER (WHERE step_id IS NOT NULL) AS step_id, max_by(dod_total, ordinal) FILTER (WHERE dod_total IS NOT NULL) AS dod_total,
  max_by(gate_codes, ordinal) FILTER (WHERE gate_codes IS NOT NULL) AS gate_codes FROM progress GROUP BY 1"""),
)
def last_known(spark, sf):
    return E.last_known(progress(spark, sf), ["module"], {c: F.col(c) for c in ("step_id", "dod_total", "gate_codes")})


@query(
    "event_codes", "P21",
    with_sql(PROGRESS, CODES, "SELECT module, code, count(*) AS n FROM (SELECT module, unnest(list_concat(gc, wc)) AS code FROM coded) GROUP BY 1, 2"),
)
def event_codes(spark, sf):
    c = E.with_codes(progress(spark, sf)).select("module", F.explode("codes").alias("code"))
    return c.groupBy("module", "code").agg(F.count("*").alias("n"))


@query(
    "blockers_net", "A38",
    with_sql(PROGRESS, CODES, """
rec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY ordinal DESC) AS b FROM coded) WHERE b <= 50),
cd AS (SELECT module, unnest(list_concat(gc, wc)) AS code FROM rec),
net AS (SELECT CAST(sum(greatest(coalesce(m, 0) - f, 0)) AS BIGINT) AS n FROM (SELECT module, count(*) FILTER (WHERE list_contains(gc, 'STEP_ID_BACKFILLED') OR warning LIKE '%STEP_ID_BACKFILLED%') AS f FROM rec GROUP BY 1)
   LEFT JOIN (SELECT module, count(*) FILTER (WHERE code = 'STEP_ID_MISSING') AS m FROM cd GROUP BY 1) USING (module))""", """
SELECT code, n FROM (SELECT code, count(*) AS n FROM cd WHERE code <> 'STEP_ID_MISSING' GROUP BY 1 UNION ALL SELECT 'STEP_ID_MISSING', n FROM net WHERE n > 0) ORDER BY n DESC, code LIMIT 5"""),
)
def blockers_net(spark, sf):
    return E.blockers(progress(spark, sf))


@query(
    "progress_by_step", "A39",
    with_sql(PROGRESS, """
SELECT module, step_id, CAST(sum(dod_done_delta) AS BIGINT) AS done, count(*) AS n_events, max_by(dod_total, ordinal) FILTER (WHERE dod_total IS NOT NULL) AS total,
  max_by(ts_text, ordinal) AS last_ts, max_by(note, ordinal) AS last_note,
  coalesce(sum(dod_done_delta) > max_by(dod_total, ordinal) FILTER (WHERE dod_total IS NOT NULL), false) AS over_total FROM progress WHERE step_id IS NOT NULL GROUP BY 1, 2"""),
)
def progress_by_step(spark, sf):
    return E.step_progress(progress(spark, sf))


@query(
    "module_progress", "A39",
    with_sql(PROGRESS, CODES, """
SELECT module, CAST(sum(dod_done_delta) FILTER (WHERE step_id IS NOT NULL) AS BIGINT) AS done, max_by(step_id, ordinal) FILTER (WHERE step_id <> 'UNSPECIFIED') AS last_step,
  max_by(note, ordinal) FILTER (WHERE step_id <> 'UNSPECIFIED') AS last_note,
  greatest(count(*) FILTER (WHERE step_id = 'UNSPECIFIED') - count(*) FILTER (WHERE list_contains(gc, 'STEP_ID_BACKFILLED')), 0) AS net_missing FROM coded GROUP BY 1"""),
)
def module_progress(spark, sf):
    return E.module_progress(progress(spark, sf))


@query(
    "done_overflow", "W5",
    with_sql(PROGRESS, """
pl AS (SELECT module, step_id, CAST(count(*) // 2 AS BIGINT) AS planned FROM progress WHERE step_id IS NOT NULL GROUP BY 1, 2),
rn AS (SELECT module, step_id, ordinal, CAST(sum(dod_done_delta) OVER (PARTITION BY module, step_id ORDER BY ordinal) AS BIGINT) AS running FROM progress WHERE step_id IS NOT NULL)""", """
SELECT module, step_id, min(ordinal) AS first_ordinal, min_by(running, ordinal) AS running FROM rn JOIN pl USING (module, step_id) WHERE running > planned GROUP BY 1, 2"""),
)
def done_overflow(spark, sf):
    p = progress(spark, sf)
    planned = p.where(F.col("step_id").isNotNull()).groupBy("module", "step_id").agg(
        F.floor(F.count("*") / 2).alias("planned")
    )
    return E.first_overflow(p, planned, block=1000)


@query(
    "hygiene", "A40",
    with_sql(PROGRESS, CODES, """
rec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY ordinal DESC) AS b FROM coded) WHERE b <= 10),
ag AS (SELECT module, count(*) AS n, count(*) FILTER (WHERE length(coalesce(note, '')) < 12) AS n_thin, max_by(epoch(tm), ordinal) FILTER (WHERE true) AS lt,
  count(DISTINCT coalesce(step_id, '')) AS ns, max(coalesce(step_id, '')) AS os FROM rec GROUP BY 1)""", """
SELECT module, n, n_thin, concat_ws(',', CASE WHEN lt < 1706616000 - 86400 THEN 'STALE_PROGRESS' END, CASE WHEN n >= 5 AND ns = 1 AND os <> '' THEN 'STEP_STUCK' END,
  CASE WHEN n >= 7 AND n_thin >= 7 THEN 'EVENT_THIN' END) AS codes FROM ag"""),
)
def hygiene(spark, sf):
    return E.hygiene(progress(spark, sf), _now())


@query(
    "round_balance", "A41",
    with_sql(PROGRESS, CODES, """
SELECT module, starts, ends, starts > ends AS end_missing FROM (SELECT module, count(*) FILTER (WHERE event_type = 'round_start') AS starts, count(*) FILTER (WHERE event_type = 'round_end') AS ends
FROM coded WHERE tm IS NULL OR epoch(tm) >= 1706616000 - 86400 GROUP BY 1)"""),
)
def round_balance(spark, sf):
    return E.round_balance(progress(spark, sf), _now())


@query(
    "event_times", "P30",
    with_sql(PROGRESS, CODES, """
SELECT module, CASE WHEN ts_text = 'not-a-time' THEN 'FORMAT' WHEN ts_text LIKE '%Z' THEN 'OK' ELSE 'FORMAT' END AS code, count(*) AS n, count(tm) AS n_read, CAST(min(epoch(tm)) AS BIGINT) AS first_s, CAST(max(epoch(tm)) AS BIGINT) AS last_s FROM coded GROUP BY 1, 2"""),
)
def event_times(spark, sf):
    p = progress(spark, sf)
    s = F.unix_timestamp("time")
    return p.groupBy("module", T.created_at_code(F.col("ts_text")).alias("code")).agg(
        F.count("*").alias("n"), F.count("time").alias("n_read"), F.min(s).alias("first_s"), F.max(s).alias("last_s")
    )


REG = """en AS (SELECT *, list_filter([trim(replace(split_part(path2, ':', 1), chr(92), '/')), trim(replace(split_part(path1, ':', 1), chr(92), '/'))], lambda p: p <> '') AS pa FROM coded WHERE event_type = 'round_end'),
ev AS (SELECT *, list_filter(list_distinct(pa), lambda p: true) AS x, list_filter(pa, lambda p: regexp_matches(p, 'exports/runs/([^/]+)/([^/]+)(/|$)')) AS evd FROM en),
e2 AS (SELECT *, evd[-1] AS lastp, regexp_extract(evd[-1], 'exports/runs/([^/]+)/([^/]+)', 1) AS lane, regexp_extract(evd[-1], 'exports/runs/([^/]+)/([^/]+)', 2) AS run_id FROM ev WHERE len(evd) > 0),
e3 AS (SELECT *, list_filter(evd, lambda p: contains(lower(p), 'manifest')) AS mf FROM e2),
e4 AS (SELECT *, list_filter(mf, lambda p: starts_with(p, 'exports/runs/' || lane || '/' || run_id || '/')) AS own FROM e3),
recs AS (SELECT ordinal, module, lane, run_id, CASE WHEN trim(round_id) = '' THEN 'N/A' ELSE trim(round_id) END AS round_id, coalesce(step_id, '') AS step_id,
  array_to_string(evd, ',') AS evidence, array_to_string(list_concat(gc, CASE WHEN trim(round_id) = '' THEN ['REGISTRY_INCOMPLETE'] ELSE [] END,
    CASE WHEN len(mf) > 0 AND len(own) = 0 THEN ['REGISTRY_MANIFEST_MISMATCH'] ELSE [] END), ',') AS gate_codes, coalesce(own[1], mf[1]) AS manifest_path FROM e4)"""


@query(
    "registry_records", "P22 P20 ST2",
    with_sql(PROGRESS, CODES, REG, "SELECT ordinal, module, lane, run_id, round_id, step_id, evidence, gate_codes, manifest_path FROM recs"),
)
def registry_records(spark, sf):
    return E.registry_records(progress(spark, sf))


@query(
    "registry_append", "JN7 W4",
    with_sql(PROGRESS, CODES, REG, """
kn AS (SELECT module, lane, run_id, round_id FROM (SELECT * FROM recs WHERE ordinal % 10 < 3)),
fr AS (SELECT * FROM recs r WHERE NOT EXISTS (SELECT 1 FROM kn WHERE kn.module = r.module AND kn.lane = r.lane AND kn.run_id = r.run_id AND kn.round_id = r.round_id))""", """
SELECT ordinal, module, lane, run_id, round_id FROM (SELECT *, row_number() OVER (PARTITION BY module, lane, run_id, round_id ORDER BY ordinal) AS rn FROM fr) WHERE rn = 1"""),
)
def registry_append(spark, sf):
    recs = E.registry_records(progress(spark, sf))
    known = recs.where(F.col("ordinal") % 10 < 3)
    return E.new_records(recs, known).select("ordinal", *E.REGISTRY_KEY)


FINDINGS = """fd AS (SELECT ordinal, 'STEP_ID_MISSING' AS code FROM progress WHERE step_id IS NULL)"""


@query("event_schema", "X11", with_sql(PROGRESS, FINDINGS, "SELECT ordinal, code FROM fd"))
def event_schema(spark, sf):
    return E.schema_findings(progress(spark, sf))


@query(
    "tombstone_exempt", "JN17 ST5",
    with_sql(PROGRESS, CODES, FINDINGS, """
ex AS (SELECT DISTINCT TRY_CAST(unnest(string_split(regexp_extract(note, 'referenced_line=([0-9/]+)', 1), '/')) AS BIGINT) AS ordinal FROM coded WHERE list_contains(gc, 'SCHEMA_VIOLATION_BACKFILLED'))""", """
SELECT ordinal, code FROM fd WHERE ordinal NOT IN (SELECT ordinal FROM ex WHERE ordinal IS NOT NULL)"""),
)
def tombstone_exempt(spark, sf):
    p = progress(spark, sf)
    return E.without_exempted(E.schema_findings(p), p)


# --- plan -----------------------------------------------------------------------------------------

PLAN = """steps AS (SELECT 'S' || CAST(p_partkey AS VARCHAR) AS step_id, CASE p_type WHEN 'ECONOMY' THEN 'body' WHEN 'PROMO' THEN 'other' ELSE 'garment' END AS module,
  'P' || CAST(p_size % 5 AS VARCHAR) AS phase, 'M' || CAST(p_size % 3 AS VARCHAR) AS m_level FROM part),
edges AS (SELECT 'S' || CAST(p_partkey AS VARCHAR) AS step_id, 'S' || CAST(p_partkey - p_size AS VARCHAR) AS from_step, 'M' || CAST(p_size % 4 AS VARCHAR) AS min_level FROM part WHERE p_size > 10
  UNION ALL SELECT 'S' || CAST(p_partkey AS VARCHAR), 'S' || CAST(p_partkey - p_size % 10 AS VARCHAR), 'M0' FROM part),
evs AS (SELECT 'S' || CAST(o_custkey AS VARCHAR) AS step_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'M2' WHEN '2-HIGH' THEN 'M1' WHEN '5-LOW' THEN 'bad' ELSE 'M0' END AS m_level FROM orders WHERE o_orderstatus = 'F'),
rk AS (SELECT step_id, max(CASE m_level WHEN 'M2' THEN 2 WHEN 'M1' THEN 1 ELSE 0 END) AS reached FROM evs GROUP BY 1)"""


def _plan(spark, sf):
    p = table(spark, sf, "part")
    s, k = F.col("p_size"), F.col("p_partkey")
    sid = lambda c: F.concat(F.lit("S"), c.cast("string"))
    steps = p.select(
        sid(k).alias("step_id"),
        F.when(F.col("p_type") == "ECONOMY", "body").when(F.col("p_type") == "PROMO", "other").otherwise("garment").alias("module"),
        F.concat(F.lit("P"), (s % 5).cast("string")).alias("phase"), F.concat(F.lit("M"), (s % 3).cast("string")).alias("m_level"),
    )
    edges = p.where(s > 10).select(
        sid(k).alias("step_id"), sid(k - s).alias("from_step"), F.concat(F.lit("M"), (s % 4).cast("string")).alias("min_level")
    ).unionByName(p.select(sid(k).alias("step_id"), sid(k - s % 10).alias("from_step"), F.lit("M0").alias("min_level")))
    pr = F.col("o_orderpriority")
    events = table(spark, sf, "orders").select(
        sid(F.col("o_custkey")).alias("step_id"), F.when(F.col("o_orderstatus") == "F", "OK").otherwise("NO").alias("status"),
        F.when(pr == "1-URGENT", "M2").when(pr == "2-HIGH", "M1").when(pr == "5-LOW", "bad").otherwise("M0").alias("m_level"),
    )
    return steps, edges, events


@query("step_levels", "A46", with_sql(PLAN, "SELECT step_id, reached FROM rk"))
def step_levels(spark, sf):
    return L.reached_levels(_plan(spark, sf)[2])


STATE = """hv AS (SELECT s.*, r.reached, coalesce(r.reached >= CASE m_level WHEN 'M2' THEN 2 WHEN 'M1' THEN 1 ELSE 0 END, false) AS done FROM steps s LEFT JOIN rk r USING (step_id)),
nd AS (SELECT step_id, from_step, max(CASE min_level WHEN 'M2' THEN 2 WHEN 'M1' THEN 1 ELSE 0 END) AS need FROM edges GROUP BY 1, 2),
um AS (SELECT n.step_id, count(*) AS n FROM nd n LEFT JOIN hv h ON h.step_id = n.from_step WHERE NOT (coalesce(h.done, false) AND coalesce(h.reached >= n.need, false)) GROUP BY 1),
state AS (SELECT step_id, module, phase, CASE WHEN done THEN 'done' WHEN coalesce(um.n, 0) > 0 THEN 'blocked' ELSE 'ready' END AS state, CASE WHEN done THEN 0 ELSE coalesce(um.n, 0) END AS n_unmet FROM hv LEFT JOIN um USING (step_id))"""


@query("ready_blocked", "JN11", with_sql(PLAN, STATE, "SELECT * FROM state"))
def ready_blocked(spark, sf):
    return L.plan_state(*_state_args(spark, sf))


@query("unmet_requirements", "JN11", with_sql(PLAN, STATE, """
SELECT n.step_id, n.from_step FROM nd n LEFT JOIN hv h ON h.step_id = n.from_step
WHERE NOT (coalesce(h.done, false) AND coalesce(h.reached >= n.need, false))"""))
def unmet_requirements(spark, sf):
    return L.unmet_requirements(*_state_args(spark, sf))


def _state_args(spark, sf):
    steps, edges, events = _plan(spark, sf)
    return steps, edges, L.reached_levels(events)


@query("next_steps", "T7", with_sql(PLAN, STATE, "SELECT step_id, phase, n_unmet FROM state WHERE state = 'blocked' ORDER BY phase, step_id LIMIT 25"))
def next_steps(spark, sf):
    return L.next_steps(L.plan_state(*_state_args(spark, sf)), "blocked", 25).select("step_id", "phase", "n_unmet")


@query(
    "plan_lint", "X10",
    with_sql(PLAN, """
f AS (SELECT 'bad_module' AS code FROM steps WHERE module = 'other' UNION ALL SELECT 'bad_phase' FROM steps WHERE phase = 'P4'
  UNION ALL SELECT 'unknown_dependency' FROM edges WHERE from_step NOT IN (SELECT step_id FROM steps)
  UNION ALL SELECT 'self_dependency' FROM edges WHERE step_id = from_step UNION ALL SELECT 'bad_min_level' FROM edges WHERE min_level = 'M3')""",
    "SELECT code, count(*) AS n FROM f GROUP BY 1"),
)
def plan_lint(spark, sf):
    steps, edges, _ = _plan(spark, sf)
    return L.lint(steps, edges).groupBy("code").agg(F.count("*").alias("n"))


# --- sets and names -------------------------------------------------------------------------------


@query(
    "union_sources", "U1",
    """
SELECT nationkey, count(*) AS n, count(seg) AS n_seg, round(sum(bal), 2) AS bal FROM (SELECT c_nationkey AS nationkey, c_acctbal AS bal, c_mktsegment AS seg FROM customer
UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier) GROUP BY 1""",
)
def union_sources(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    s = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nationkey"))
    return C.union_sources([c, s]).groupBy("nationkey").agg(
        F.count("*").alias("n"), F.count("seg").alias("n_seg"), F.round(F.sum("bal"), 2).alias("bal")
    )


@query(
    "presence_matrix", "U2",
    """
SELECT p_name AS name, bool_or(p_type = 'ECONOMY') AS ECONOMY, bool_or(p_type = 'PROMO') AS PROMO, bool_or(p_type = 'STANDARD') AS STANDARD, count(DISTINCT p_type) AS n_sources FROM part GROUP BY 1""",
)
def presence_matrix(spark, sf):
    n = table(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_type").alias("source"))
    return S.presence_matrix(n, ["ECONOMY", "PROMO", "STANDARD"])


DAYS = "dn AS (SELECT DISTINCT substr(CAST(ts AS VARCHAR), 1, 10) AS day, user_id FROM events)"
COMMON = "cm AS (SELECT user_id FROM dn GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT day) FROM dn))"


def _days(spark, sf):
    return table(spark, sf, "events").select(F.substring(F.col("ts").cast("string"), 1, 10).alias("day"), "user_id").distinct()


@query("column_intersect", "U3", with_sql(DAYS, COMMON, "SELECT user_id FROM cm"))
def column_intersect(spark, sf):
    return S.in_every(_days(spark, sf), "day", "user_id")


@query("column_diff", "U4", with_sql(DAYS, COMMON, "SELECT day, user_id FROM dn WHERE user_id NOT IN (SELECT user_id FROM cm)"))
def column_diff(spark, sf):
    return S.beyond_common(_days(spark, sf), "day", "user_id")


@query(
    "newly_true", "U5",
    """
SELECT user_id FROM (SELECT user_id, bool_or(value > 250) AS f FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1) WHERE f
EXCEPT SELECT user_id FROM (SELECT user_id, bool_or(value > 250) AS f FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1) WHERE f""",
)
def newly_true(spark, sf):
    e = table(spark, sf, "events")
    late = F.col("ts").cast("string") >= "2024-01-16"
    flag = lambda d: d.groupBy("user_id").agg(F.bool_or(F.col("value") > 250).alias("f"))
    return S.newly_true(flag(e.where(late)), flag(e.where(~late)), ["user_id"], "f")


NAMES = """nm AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN p_brand || '_목둘레' WHEN 1 THEN '7_허리 높이_' || p_type WHEN 2 THEN p_type WHEN 3 THEN p_brand || '_' || p_type ELSE ' 키_' END AS name,
  CASE p_size % 4 WHEN 0 THEN 'neck-base' WHEN 1 THEN 'Waist Height' WHEN 2 THEN '' END AS en FROM part),
tm AS (SELECT *, CASE p_size % 5 WHEN 0 THEN '목둘레' WHEN 1 THEN '허리 높이' WHEN 2 THEN name WHEN 3 THEN p_type ELSE '키' END AS term FROM nm JOIN part USING (p_partkey))"""


def _names(spark, sf):
    s, lit = F.col("p_size"), F.lit
    name = (
        F.when(s % 5 == 0, F.concat("p_brand", lit("_목둘레"))).when(s % 5 == 1, F.concat(lit("7_허리 높이_"), "p_type"))
        .when(s % 5 == 2, F.col("p_type")).when(s % 5 == 3, F.concat("p_brand", lit("_"), "p_type")).otherwise(" 키_")
    )
    en = F.when(s % 4 == 0, "neck-base").when(s % 4 == 1, "Waist Height").when(s % 4 == 2, "")
    return table(spark, sf, "part").select(name.alias("name"), en.alias("en"))


@query("ko_term", "P14", with_sql(NAMES, "SELECT name, term, count(*) AS n FROM tm GROUP BY 1, 2"))
def ko_term(spark, sf):
    return _names(spark, sf).select("name", K.ko_term(F.col("name")).alias("term")).groupBy("name", "term").agg(F.count("*").alias("n"))


@query(
    "standard_key", "P15 JN2",
    with_sql(NAMES, """
dm AS (SELECT term, en, CASE WHEN contains(term, '둘레') OR contains(lower(coalesce(en, '')), 'circumference') THEN 'circ' WHEN contains(lower(coalesce(en, '')), 'width') THEN 'width'
  WHEN contains(term, '길이') THEN 'length' WHEN contains(term, '높이') OR contains(lower(coalesce(en, '')), 'height') THEN 'height' ELSE 'length' END AS dim FROM tm)""", """
SELECT term, dim, CASE WHEN coalesce(en, '') = '' THEN 'UNMATCHED_' || replace(upper(term), ' ', '_') ELSE replace(replace(upper(en), ' ', '_'), '-', '_') ||
  CASE dim WHEN 'circ' THEN '_CIRC_M' WHEN 'width' THEN '_WIDTH_M' WHEN 'height' THEN '_HEIGHT_M' ELSE '_LENGTH_M' END END AS key,
  CASE WHEN term IN ('키', '몸무게', '가슴둘레', '허리둘레', '엉덩이둘레') THEN 'must' ELSE 'optional' END AS priority, count(*) AS n FROM dm GROUP BY ALL"""),
)
def standard_key(spark, sf):
    d = _names(spark, sf).select(K.ko_term(F.col("name")).alias("term"), "en")
    out = d.select(
        "term", K.dimension_type(F.col("term"), F.col("en")).alias("dim"), K.standard_key(F.col("term"), F.col("en")).alias("key"),
        K.priority(F.col("term")).alias("priority"),
    )
    return out.groupBy("term", "dim", "key", "priority").agg(F.count("*").alias("n"))


@query(
    "glossary_join", "JN2",
    """
SELECT n_name, coalesce(r_name, 'unmatched') AS region, count(c_custkey) AS n FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA' LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def glossary_join(spark, sf):
    r = table(spark, sf, "region").where("r_name <> 'ASIA'")
    n = table(spark, sf, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return n.join(c, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        "n_name", F.coalesce("r_name", F.lit("unmatched")).alias("region"), F.coalesce("n", F.lit(0)).alias("n")
    )


MATCH = """tr AS (SELECT DISTINCT split_part(p_name, ' ', CAST(1 + p_size % 2 AS INTEGER)) AS term FROM part),
hd AS (SELECT name, name AS position FROM (SELECT DISTINCT CASE WHEN p_size < 25 THEN p_name ELSE split_part(p_name, ' ', 1) END AS name FROM part))"""


def _match(spark, sf):
    p = table(spark, sf, "part")
    terms = p.select(F.element_at(F.split("p_name", " "), F.col("p_size") % 2 + 1).alias("term")).distinct()
    name = F.when(F.col("p_size") < 25, F.col("p_name")).otherwise(F.element_at(F.split("p_name", " "), 1))
    head = p.select(name.alias("name")).distinct().withColumn("position", F.col("name"))
    return terms, head


@query(
    "first_match", "JN3",
    with_sql(MATCH, """
ht AS (SELECT term, name, CASE WHEN term = name THEN 0 ELSE 1 END AS kind, position FROM tr JOIN hd ON term = name OR contains(name, term) OR contains(term, name)),
bs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY kind, position) AS rn FROM ht) WHERE rn = 1)""", """
SELECT term, bs.name, CASE kind WHEN 0 THEN 'exact' WHEN 1 THEN 'partial' ELSE 'none' END AS match FROM tr LEFT JOIN bs USING (term)"""),
)
def first_match(spark, sf):
    return S.first_match(*_match(spark, sf))


@query(
    "nearest_names", "JN4",
    with_sql(MATCH, """
d AS (SELECT term, name, levenshtein(term, name) AS distance FROM tr, hd WHERE length(name) <= length(term) * 3 + 8)""", """
SELECT term, name, distance, rank FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY distance, name) AS rank FROM d) WHERE rank <= 3"""),
)
def nearest_names(spark, sf):
    terms, head = _match(spark, sf)
    return S.nearest_names(terms, head.select("name"))


ALIASES = [("bust_circ_m", "BUST_CIRC_M"), ("chest_circumference", "BUST_CIRC_M"), ("bust", "BUST_CIRC_M"), ("waist", "WAIST_CIRC_M"), ("hips", "HIP_CIRC_M")]
ALIAS_SQL = """pr AS (SELECT user_id AS id, CASE event_type WHEN 'click' THEN ' Bust-Circ  M' WHEN 'view' THEN 'CHEST circumference' WHEN 'error' THEN 'waist' WHEN 'signup' THEN 'Hips_' ELSE 'arm' END AS key, max(value) AS value FROM events GROUP BY 1, 2),
km AS (SELECT *, CASE key WHEN ' Bust-Circ  M' THEN 'BUST_CIRC_M' WHEN 'CHEST circumference' THEN 'BUST_CIRC_M' WHEN 'waist' THEN 'WAIST_CIRC_M' WHEN 'Hips_' THEN 'HIP_CIRC_M' END AS canonical FROM pr)"""


@query(
    "alias_resolve", "P18",
    with_sql(ALIAS_SQL, """
SELECT id, key, canonical, CASE WHEN canonical IS NULL THEN 'unmapped' WHEN key = min(key) OVER (PARTITION BY id, canonical) THEN 'mapped' ELSE 'tie_broken' END AS status, value FROM km"""),
)
def alias_resolve(spark, sf):
    t = F.col("event_type")
    key = (
        F.when(t == "click", " Bust-Circ  M").when(t == "view", "CHEST circumference").when(t == "error", "waist")
        .when(t == "signup", "Hips_").otherwise("arm")
    )
    pairs = table(spark, sf, "events").groupBy(F.col("user_id").alias("id"), key.alias("key")).agg(F.max("value").alias("value"))
    return S.resolve_aliases(pairs, spark.createDataFrame(ALIASES, "alias string, canonical string"), ["id"])


@query(
    "refresh_mapping", "JN19",
    """
SELECT p_partkey AS standard_key, p_type AS source, CASE WHEN p_size > 45 THEN 'over_' || p_brand WHEN p_size % 2 = 0 THEN 'ref_' || p_name ELSE p_name END AS "column" FROM part""",
)
def refresh_mapping(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("standard_key"), F.col("p_type").alias("source"), "p_name", "p_brand", "p_size")
    pick = lambda d, c: d.select("standard_key", "source", c.alias("column"))
    ref = pick(p.where("p_size % 2 = 0"), F.concat(F.lit("ref_"), "p_name"))
    over = pick(p.where("p_size > 45"), F.concat(F.lit("over_"), "p_brand"))
    return S.refresh_mapping(pick(p, F.col("p_name")), ref, over)


@query(
    "positional_join", "JN1",
    """
SELECT o_orderstatus, count(*) AS n, count(l.q) AS n_joined, round(sum(l.q), 2) AS total FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem WHERE l_linenumber < 3 GROUP BY 1) l ON l_orderkey = o_orderkey GROUP BY 1""",
)
def positional_join(spark, sf):
    meta = table(spark, sf, "lineitem").where("l_linenumber < 3").groupBy(F.col("l_orderkey").alias("row_idx")).agg(F.sum("l_quantity").alias("q"))
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_idx"), "o_orderstatus")
    return C.attach_by_position(rows, meta, ["q"], "row_idx").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.count("q").alias("n_joined"), F.round(F.sum("q"), 2).alias("total")
    )


# --- paths and text -------------------------------------------------------------------------------

PATHS = """ph AS (SELECT source, CASE lang WHEN 'en' THEN 'modules' || chr(92) || 'body/' WHEN 'fr' THEN 'modules/fitting/' WHEN 'de' THEN 'tools/ops/' ELSE '../exports/logs/' END
  || 'facts/' || source || '/r' || CAST(doc_id AS VARCHAR) || CASE WHEN n_chars % 3 = 0 THEN '/geometry_manifest.json' ELSE '/facts_summary.json' END AS path FROM documents),
px AS (SELECT *, replace(path, chr(92), '/') AS p FROM ph)"""


def _paths(spark, sf):
    lang = F.col("lang")
    head = F.when(lang == "en", "modules\\body/").when(lang == "fr", "modules/fitting/").when(lang == "de", "tools/ops/").otherwise("../exports/logs/")
    tail = F.when(F.col("n_chars") % 3 == 0, "/geometry_manifest.json").otherwise("/facts_summary.json")
    return table(spark, sf, "documents").select(
        "source", F.concat(head, F.lit("facts/"), "source", F.lit("/r"), F.col("doc_id").cast("string"), tail).alias("path")
    )


@query(
    "path_rules", "P20",
    with_sql(PATHS, """
SELECT source, CASE WHEN starts_with(p, 'tools/ops/') THEN 'allowlisted' WHEN starts_with(p, 'modules/body/') THEN 'body' WHEN starts_with(p, 'modules/fitting/') THEN 'fitting' ELSE 'other' END AS region,
  CASE WHEN contains(p, 'geometry_manifest') THEN 'MANIFEST' ELSE 'OTHER' END AS class, source AS lane, NOT contains(p, '..') AS safe, count(*) AS n FROM px GROUP BY ALL"""),
)
def path_rules(spark, sf):
    p = F.col("path")
    d = _paths(spark, sf).select(
        "source", P.change_region(p).alias("region"), P.path_class(p).alias("class"), P.module_lane(p).alias("lane"), P.is_safe_relative(p).alias("safe")
    )
    return d.groupBy(*d.columns).agg(F.count("*").alias("n"))


@query(
    "mixed_regions", "P20",
    with_sql(PATHS, """
SELECT source, bool_or(starts_with(p, 'modules/body/')) AND bool_or(starts_with(p, 'modules/fitting/')) AS mixed FROM px GROUP BY 1"""),
)
def mixed_regions(spark, sf):
    return _paths(spark, sf).groupBy("source").agg(P.mixes_regions(P.change_region(F.col("path"))).alias("mixed"))


@query(
    "glob_match", "P28",
    """
SELECT url, (starts_with(url, 'https://') AND ends_with(url, '.html')) AS deep, regexp_matches(url, '^.*/en/[^/]$|^.*/en/.*$') AND regexp_matches(url, '^http.*/en/.*$') AS shallow, regexp_matches(url, '^http.://.*$') AS one FROM pages""",
)
def glob_match(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "url", P.glob_match(u, "https://**.html").alias("deep"), P.glob_match(u, "http*/en/*").alias("shallow"), P.glob_match(u, "http?://*").alias("one")
    )


@query(
    "log_facts", "P32",
    """
SELECT lang, CAST(sum(n_chars) AS BIGINT) AS n_rows, CAST(sum(doc_id % 7) AS BIGINT) AS n_columns, count(*) * 2 AS n_warnings FROM documents GROUP BY 1""",
)
def log_facts(spark, sf):
    head = F.concat(
        F.lit("Curated\nRows: "), F.col("n_chars").cast("string"), F.lit("\nColumns:"), (F.col("doc_id") % 7).cast("string"),
        F.lit("\nwarnings: "), F.col("lang"), F.lit(" , B,\n"), F.col("text"),
    )
    f = table(spark, sf, "documents").select("lang", P.log_facts(head).alias("f"))
    return f.groupBy("lang").agg(
        F.sum("f.n_rows").alias("n_rows"), F.sum("f.n_columns").alias("n_columns"), F.sum(F.size("f.warnings")).alias("n_warnings")
    )


@query(
    "fingerprint", "P27",
    """
SELECT o_orderkey, sha256('{"o_custkey":' || CAST(o_custkey AS VARCHAR) || ',"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '"}') AS digest FROM orders""",
)
def fingerprint(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", P.fingerprint("o_orderstatus", "o_custkey", "o_orderpriority").alias("digest"))
