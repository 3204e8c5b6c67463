"""Queries over run documents: contract checks, audits, roll-ups, rules, dependencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.operators import contracts as D
from tapeline.operators import sets as S
from tapeline.plans.inputs import PROGRESS, progress, with_sql
from tapeline.plans.registry import ORACLE, dealt, query, table

# The document texts are one expression for both engines; the comparison SQL then derives the expected
# severities from the columns behind them, without reading the JSON.
MANIFEST = """'{"schema_version":"' || CASE WHEN o_orderstatus = 'P' THEN 'geometry_manifest.v0' ELSE 'geometry_manifest.v1' END || '"'
  || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE ',"module_name":"' || CASE o_custkey % 4 WHEN 0 THEN 'body' WHEN 1 THEN 'fitting' WHEN 2 THEN 'garment' ELSE 'other' END || '"' END
  || ',"contract_version":"c1","created_at":"' || substr(CAST(o_orderdate AS STRING), 1, 10) || 'T00:00:00' || CASE o_custkey % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '.123Z' ELSE '+09:00' END
  || '","inputs_fingerprint":"' || CASE o_custkey % 5 WHEN 0 THEN 'abc' WHEN 1 THEN '' ELSE md5(CAST(o_orderkey AS STRING)) || md5('x') END
  || '","version_keys":{"snapshot_version":"s1","semantic_version":"' || CASE o_custkey % 3 WHEN 0 THEN 'UNSPECIFIED' ELSE 'v1' END || '"'
  || CASE WHEN o_custkey % 7 = 0 THEN '' ELSE ',"geometry_impl_version":"g1"' END || ',"dataset_version":null},"artifacts":["a.json","'
  || CASE o_custkey % 6 WHEN 0 THEN '/abs/x' WHEN 1 THEN '../escape.txt' ELSE 'b/c.npz' END || '"]'
  || CASE WHEN o_custkey % 11 = 0 THEN ',"score":NaN' ELSE '' END || CASE WHEN o_custkey % 13 = 0 THEN ',"extra_field":1' ELSE '' END || '}'"""
SUBSET = """'{"unit":"' || CASE WHEN o_orderstatus = 'P' THEN 'cm' ELSE 'm' END || '","pose_id":"PZ1"'
  || CASE WHEN o_custkey % 9 = 0 THEN '' ELSE ',"measurements":{"BUST_CIRC_M":' || CASE WHEN o_custkey % 2 = 0 THEN 'null' ELSE '0.9' END
    || CASE WHEN o_custkey % 5 = 0 THEN '' ELSE ',"WAIST_CIRC_M":' || CASE WHEN o_custkey % 3 = 0 THEN 'null' ELSE '0.7' END END
    || ',"HIP_CIRC_M":' || CASE o_custkey % 7 WHEN 0 THEN '"big"' WHEN 1 THEN 'null' ELSE '1' END || '}' END || ',"warnings":[]}'"""
FITTING = """'{"garment_input_path_used":"' || CASE o_custkey % 3 WHEN 0 THEN 'npz' WHEN 1 THEN 'glb_fallback' ELSE 'obj' END || '","early_exit":'
  || CASE o_custkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN '"true"' ELSE 'false' END || CASE WHEN o_custkey % 5 = 0 THEN ',"early_exit_reason":"gate"' WHEN o_custkey % 5 = 1 THEN ',"early_exit_reason":7' ELSE ',"early_exit_reason":null' END
  || ',"warnings_summary":' || CASE WHEN o_orderstatus = 'P' THEN '{}' ELSE '[]' END || ',"degraded_state":"' || CASE o_custkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'high_warning_degraded' ELSE 'odd' END || '"}'"""
GARMENT = """'{"negative_face_area_flag":' || CASE WHEN o_custkey % 8 = 0 THEN 'true' ELSE 'false' END || ',"self_intersection_flag":' || CASE WHEN o_custkey % 5 = 0 THEN '1' ELSE 'false' END
  || CASE WHEN o_custkey % 6 = 0 THEN '' ELSE ',"invalid_face_flag":' || CASE WHEN o_orderstatus = 'F' AND o_custkey % 7 = 0 THEN 'true' ELSE 'false' END END || '}'"""
CHAIN = """'{"limits":{"max_retry":' || CASE WHEN o_custkey % 4 = 0 THEN '3' ELSE '2' END || CASE WHEN o_custkey % 3 = 0 THEN '' ELSE ',"iter_max_per_attempt":100' END || '},"inputs_fingerprint":"'
  || CASE WHEN o_custkey % 5 = 0 THEN '' ELSE 'f1' END || '"' || CASE WHEN o_custkey % 2 = 0 THEN ',"fingerprint_algo":"sha256"' ELSE '' END || ',"artifacts":{"npz_path":' || CASE o_custkey % 3 WHEN 0 THEN '"/abs.npz"' WHEN 1 THEN '"a/b.npz"' ELSE 'null' END
  || ',"mesh_path":"m.glb"' || CASE WHEN o_custkey % 7 = 0 THEN ',"measurements_path":"m.json"' ELSE '' END || '},"created_at":"2024-01-01T00:00:00' || CASE WHEN o_orderstatus = 'F' THEN 'Z' ELSE '' END || '"}'"""


def docs(spark, sf, text):
    o = dealt(table(spark, sf, "orders"), "o_orderkey")
    return D.parse(o.withColumn("doc", F.expr(text)))


def sev(**labels):
    """Comparison SQL: (label, severity, n) from one CASE expression per label over ``orders``."""
    parts = [f"SELECT '{k.replace('__', ':')}' AS label, {v} AS severity, o_orderkey FROM orders" for k, v in labels.items()]
    return "WITH c AS (" + " UNION ALL ".join(parts) + ") SELECT label, severity, count(*) AS n FROM c WHERE severity IS NOT NULL GROUP BY 1, 2"


def ok(cond, bad="FAIL"):
    return f"CASE WHEN {cond} THEN 'PASS' ELSE '{bad}' END"


def counted(rows):
    return rows.groupBy("label", "severity").agg(F.count("*").alias("n"))


_NAN = "o_custkey % 11 = 0"


def _if_parsed(expr):
    return f"CASE WHEN {_NAN} THEN NULL ELSE {expr} END"


@query(
    "manifest_checks", "X3 X2",
    sev(
        parse=ok(f"NOT ({_NAN})"), schema_version=_if_parsed(ok("o_orderstatus <> 'P'")),
        module_name=_if_parsed(ok("o_orderpriority <> '5-LOW' AND o_custkey % 4 <> 3")), contract_version=_if_parsed("'PASS'"),
        created_at=_if_parsed(ok("o_custkey % 3 = 0")),
        inputs_fingerprint=_if_parsed("CASE o_custkey % 5 WHEN 0 THEN 'WARN' WHEN 1 THEN 'FAIL' ELSE 'PASS' END"),
        artifacts=_if_parsed(ok("o_custkey % 6 <> 0")), version_keys__snapshot_version=_if_parsed("'PASS'"),
        version_keys__semantic_version=_if_parsed(ok("o_custkey % 3 <> 0", "WARN")),
        version_keys__geometry_impl_version=_if_parsed(ok("o_custkey % 7 <> 0")), version_keys__dataset_version=_if_parsed("'FAIL'"),
    ),
)
def manifest_checks(spark, sf):
    return counted(D.checked(docs(spark, sf, MANIFEST), ["o_orderkey"], D.manifest_checks))


@query(
    "severity_rollup", "A45",
    """
WITH s AS (SELECT o_orderkey, CASE WHEN o_custkey % 11 = 0 THEN [1, 0] ELSE
   [(o_orderstatus = 'P')::INT + (o_orderpriority = '5-LOW' OR o_custkey % 4 = 3)::INT + (o_custkey % 3 <> 0)::INT + (o_custkey % 5 = 1)::INT + (o_custkey % 6 = 0)::INT + (o_custkey % 7 = 0)::INT + 1,
    (o_custkey % 5 = 0)::INT + (o_custkey % 3 = 0)::INT] END AS c, o_custkey % 11 = 0 AS nan FROM orders)
SELECT o_orderkey, 'FAIL' AS worst, CAST(c[1] AS BIGINT) AS n_worst, CAST(CASE WHEN nan THEN 1 ELSE 11 END AS BIGINT) AS n_checks FROM s""",
)
def severity_rollup(spark, sf):
    return D.roll_up(D.checked(docs(spark, sf, MANIFEST), ["o_orderkey"], D.manifest_checks), ["o_orderkey"])


@query(
    "conformance_audit", "A44",
    """
WITH a AS (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN ['module_name'] ELSE [] END AS m1, CASE WHEN o_custkey % 7 = 0 THEN ['version_keys.geometry_impl_version'] ELSE [] END AS m2,
  o_custkey % 6 IN (0, 1) AS bp, o_orderstatus = 'P' AS e1, o_orderpriority = '5-LOW' OR o_custkey % 4 = 3 AS e2 FROM orders WHERE o_custkey % 11 <> 0)
SELECT o_orderkey, array_to_string(list_concat(m1, m2), ',') AS missing, CASE WHEN o_custkey % 13 = 0 THEN 'extra_field' ELSE '' END AS extra,
  CASE o_custkey % 6 WHEN 0 THEN '/abs/x' WHEN 1 THEN '../escape.txt' ELSE '' END AS bad_paths, concat_ws(',', CASE WHEN e1 THEN 'schema_version' END, CASE WHEN e2 THEN 'module_name' END) AS errors,
  len(list_concat(m1, m2)) = 0 AND NOT bp AND NOT e1 AND NOT e2 AS valid FROM a""",
)
def conformance_audit(spark, sf):
    readable = docs(spark, sf, MANIFEST).where(F.col("v").isNotNull())
    a = D.conformance(readable, ["o_orderkey"])
    lists = ("missing", "extra", "bad_paths", "errors")
    return a.select("o_orderkey", *[F.array_join(c, ",").alias(c) for c in lists], "valid")


@query(
    "common_mismatches", "A44",
    """
WITH a AS (SELECT o_orderpriority AS g, unnest(list_concat(CASE WHEN o_orderpriority = '5-LOW' THEN ['module_name'] ELSE [] END, CASE WHEN o_custkey % 7 = 0 THEN ['version_keys.geometry_impl_version'] ELSE [] END)) AS field FROM orders WHERE o_custkey % 11 <> 0)
SELECT field, count(DISTINCT g) AS n_groups, count(*) AS n FROM a GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 5""",
)
def common_mismatches(spark, sf):
    readable = docs(spark, sf, MANIFEST).where(F.col("v").isNotNull())
    return D.common_mismatches(D.conformance(readable, ["o_orderpriority"]), "o_orderpriority")


_HAS = "o_custkey % 9 <> 0"


@query(
    "body_checks", "X5",
    sev(
        unit=ok("o_orderstatus <> 'P'"), pose_id="'PASS'", measurements=f"CASE WHEN NOT ({_HAS}) THEN 'FAIL' END",
        warnings=f"CASE WHEN {_HAS} THEN 'PASS' END",
        missingness=f"CASE WHEN {_HAS} THEN CASE WHEN (o_custkey % 2 = 0) OR (o_custkey % 5 <> 0 AND o_custkey % 3 = 0) OR o_custkey % 7 = 1 THEN 'WARN' ELSE 'PASS' END END",
        BUST_CIRC_M=f"CASE WHEN {_HAS} THEN CASE WHEN o_custkey % 2 = 0 THEN 'WARN' ELSE 'PASS' END END",
        WAIST_CIRC_M=f"CASE WHEN {_HAS} THEN CASE WHEN o_custkey % 5 = 0 THEN 'FAIL' WHEN o_custkey % 3 = 0 THEN 'WARN' ELSE 'PASS' END END",
        HIP_CIRC_M=f"CASE WHEN {_HAS} THEN CASE o_custkey % 7 WHEN 0 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END END",
    ),
)
def body_checks(spark, sf):
    return counted(D.checked(docs(spark, sf, SUBSET), ["o_orderkey"], D.body_checks))


@query(
    "fitting_checks", "X6",
    sev(
        input_priority="CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_custkey % 3 = 0 THEN 'PASS' ELSE 'FAIL' END WHEN o_orderstatus = 'P' THEN CASE WHEN o_custkey % 3 = 1 THEN 'PASS' ELSE 'FAIL' END WHEN o_custkey % 3 < 2 THEN 'WARN' ELSE 'FAIL' END",
        garment_input_path_used=ok("o_custkey % 3 < 2"), early_exit=ok("o_custkey % 4 <> 1"),
        early_exit_reason="CASE o_custkey % 5 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' ELSE CASE WHEN o_custkey % 4 = 0 THEN 'WARN' ELSE 'PASS' END END",
        warnings_summary=ok("o_orderstatus <> 'P'"), degraded_state=ok("o_custkey % 3 < 2"),
    ),
)
def fitting_checks(spark, sf):
    st = F.col("o_orderstatus")
    return counted(D.checked(docs(spark, sf, FITTING), ["o_orderkey"], D.fitting_checks, st == "F", st == "P"))


_GATE = "(o_custkey % 8 = 0 OR (o_custkey % 6 <> 0 AND o_orderstatus = 'F' AND o_custkey % 7 = 0))"


@query(
    "garment_checks", "X7",
    sev(
        negative_face_area_flag=ok("o_custkey % 8 <> 0", "WARN"), self_intersection_flag=ok("o_custkey % 5 <> 0"),
        invalid_face_flag="CASE WHEN o_custkey % 6 = 0 THEN 'FAIL' WHEN o_orderstatus = 'F' AND o_custkey % 7 = 0 THEN 'WARN' ELSE 'PASS' END",
        hard_gate=ok(f"NOT {_GATE}", "WARN"), mesh=f"CASE WHEN o_orderpriority = '1-URGENT' THEN 'PASS' WHEN {_GATE} THEN 'WARN' ELSE 'FAIL' END",
    ),
)
def garment_checks(spark, sf):
    return counted(D.checked(docs(spark, sf, GARMENT), ["o_orderkey"], D.garment_checks, F.col("o_orderpriority") == "1-URGENT"))


@query(
    "chain_checks", "X8",
    sev(
        limits__max_retry=ok("o_custkey % 4 <> 0"), limits__iter_max_per_attempt="CASE WHEN o_custkey % 3 <> 0 THEN 'PASS' END",
        fingerprint_algo=f"CASE WHEN o_custkey % 5 <> 0 THEN {ok('o_custkey % 2 = 0')} END", inputs=ok("o_custkey % 3 = 1 OR o_custkey % 7 = 0"),
        created_at=ok("o_orderstatus = 'F'"),
    ),
)
def chain_checks(spark, sf):
    return counted(D.checked(docs(spark, sf, CHAIN), ["o_orderkey"], D.chain_checks))


@query(
    "scenario_checks", "X9",
    """
WITH s AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'ok' WHEN '2-HIGH' THEN 'hardgate' ELSE 'degraded' END AS sc, o_custkey % 3 AS m3, o_custkey % 4 AS m4, o_custkey % 5 AS m5,
  {gate} AS gate, CASE WHEN o_custkey % 9 = 0 THEN 3 ELSE (o_custkey % 2 = 0)::INT + (o_custkey % 5 = 0 OR o_custkey % 3 = 0)::INT + (o_custkey % 7 = 1)::INT END AS nulls FROM orders),
c AS (SELECT sc, 'ok:early_exit' AS label, CASE WHEN m4 > 1 THEN 'PASS' ELSE 'FAIL' END AS severity FROM s WHERE sc = 'ok' UNION ALL SELECT sc, 'ok:degraded_state', CASE WHEN m3 = 0 THEN 'PASS' ELSE 'FAIL' END FROM s WHERE sc = 'ok'
 UNION ALL SELECT sc, 'hardgate:detected', CASE WHEN gate THEN 'PASS' ELSE 'FAIL' END FROM s WHERE sc = 'hardgate' UNION ALL SELECT sc, 'hardgate:early_exit', CASE WHEN m4 = 0 THEN 'PASS' ELSE 'FAIL' END FROM s WHERE sc = 'hardgate'
 UNION ALL SELECT sc, 'hardgate:reason', CASE WHEN m5 < 2 THEN 'PASS' ELSE 'WARN' END FROM s WHERE sc = 'hardgate'
 UNION ALL SELECT sc, 'degraded:null_count', CASE WHEN nulls >= 2 THEN 'PASS' ELSE 'FAIL' END FROM s WHERE sc = 'degraded' UNION ALL SELECT sc, 'degraded:state', CASE WHEN m3 = 1 THEN 'PASS' ELSE 'FAIL' END FROM s WHERE sc = 'degraded')
SELECT sc AS scenario, label, severity, count(*) AS n FROM c GROUP BY 1, 2, 3""".replace("{gate}", _GATE),
)
def scenario_checks(spark, sf):
    body = docs(spark, sf, SUBSET).select("o_orderkey", "o_orderpriority", F.col("v").alias("body"))
    fit = docs(spark, sf, FITTING).select("o_orderkey", F.col("v").alias("fitting"))
    gar = docs(spark, sf, GARMENT).select("o_orderkey", F.col("v").alias("garment"))
    p = F.col("o_orderpriority")
    three = body.join(fit, "o_orderkey").join(gar, "o_orderkey").withColumn(
        "scenario", F.when(p == "1-URGENT", "ok").when(p == "2-HIGH", "hardgate").otherwise("degraded")
    )
    rows = D.check_rows(
        three, ["scenario"], D.scenario_checks(F.col("body"), F.col("fitting"), F.col("garment"), F.col("scenario"))
    )
    return rows.groupBy("scenario", "label", "severity").agg(F.count("*").alias("n"))


SPEC = {
    "require_fields": ["unit", "measurements"], "require_any_fields": [["values", "measurements"], ["pose_id"]],
    "require_keys_any": ["WAIST_CIRC_M"], "require_keys_any_in": "measurements", "unit_exact": "m", "no_nan": True,
}


@query(
    "doc_checks", "X1",
    sev(
        field__unit="'PASS'", field__measurements=ok(_HAS), any_of__0=ok(_HAS), any_of__1="'PASS'",
        keys_any=ok(f"{_HAS} AND o_custkey % 5 <> 0"), unit=ok("o_orderstatus <> 'P'"), no_nan="'PASS'",
    ),
)
def doc_checks(spark, sf):
    return counted(D.check_rows(docs(spark, sf, SUBSET), ["o_orderkey"], D.required_checks(F.col("doc"), F.col("v"), SPEC)))


@query(
    "non_finite_documents", "X2",
    """
SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE o_custkey % 11 = 0) AS n_bad FROM orders GROUP BY 1""",
)
def non_finite_documents(spark, sf):
    return docs(spark, sf, MANIFEST).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.count_if(D.has_non_finite(F.col("doc"))).alias("n_bad")
    )


WSUM = """'{"CODE_' || substr(o_orderpriority, 1, 1) || '":{"count":' || CASE WHEN o_custkey % 3 = 0 THEN '-1' ELSE '2' END || ',"samples":["a","b"' || CASE WHEN o_custkey % 5 = 0 THEN ',"c","d","e","f"' ELSE '' END
  || ']' || CASE WHEN o_custkey % 7 = 0 THEN '' ELSE ',"truncated":false' END || '},"OTHER":{"count":0,"samples":[],"truncated":true}}'"""


@query(
    "warning_summary_checks", "X12",
    """
WITH f AS (SELECT 'CODE_' || substr(o_orderpriority, 1, 1) AS code, unnest(list_concat(CASE WHEN o_custkey % 3 = 0 THEN ['count'] ELSE [] END, CASE WHEN o_custkey % 5 = 0 THEN ['samples'] ELSE [] END, CASE WHEN o_custkey % 7 = 0 THEN ['truncated'] ELSE [] END)) AS problem FROM orders)
SELECT code, problem, count(*) AS n FROM f GROUP BY 1, 2""",
)
def warning_summary_checks(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(WSUM).alias("doc"))
    return D.warning_summary_findings(o, ["o_orderkey"], "doc").groupBy("code", "problem").agg(F.count("*").alias("n"))


@query(
    "warning_summary", "X12",
    """
WITH t AS (SELECT o_orderpriority AS code, count(*) AS "count" FROM orders GROUP BY 1),
s AS (SELECT code, string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY o_orderkey) AS samples FROM (SELECT o_orderpriority AS code, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 5 GROUP BY 1)
SELECT code, "count", samples, "count" > 5 AS truncated FROM t JOIN s USING (code)""",
)
def warning_summary(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("code"), "o_orderkey")
    return D.warning_summary(o, [], "code", "o_orderkey", ["o_orderkey"])


FILES = """files AS (SELECT 'run_' || substr(CAST(ts AS VARCHAR), 9, 2) || '_' || CAST(user_id % 40 AS VARCHAR) AS run_id, k % 2 AS depth,
  CASE k % 9 WHEN 0 THEN 'a/geometry_manifest.json' WHEN 1 THEN 'b/my_facts_summary_v1.json' WHEN 2 THEN 'RUN_README.md' ELSE 'x/' || event_type || '.txt' END AS path FROM (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) AS k FROM events))"""


def _files(spark, sf):
    e = table(spark, sf, "events")
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("int")
    e = e.withColumn("k", k)
    path = (
        F.when(F.col("k") % 9 == 0, "a/geometry_manifest.json").when(F.col("k") % 9 == 1, "b/my_facts_summary_v1.json")
        .when(F.col("k") % 9 == 2, "RUN_README.md").otherwise(F.concat(F.lit("x/"), "event_type", F.lit(".txt")))
    )
    return e.select(
        F.concat(F.lit("run_"), F.substring(F.col("ts").cast("string"), 9, 2), F.lit("_"), (F.col("user_id") % 40).cast("string")).alias("run_id"),
        (F.col("k") % 2).alias("depth"), path.alias("path"), "event_type",
    )


@query(
    "run_minimum_set", "A42",
    with_sql(FILES, """
g AS (SELECT run_id, bool_or(path LIKE '%geometry_manifest.json') AS has_manifest, bool_or(path LIKE '%facts_summary%') AS has_facts, bool_or(path LIKE '%README%') AS has_readme,
  bool_or(path LIKE '%geometry_manifest.json' AND depth = 0) AS root_manifest, count(*) AS n_files FROM files GROUP BY 1)""", """
SELECT *, has_manifest::INT + has_facts::INT + has_readme::INT >= 2 AS complete, has_manifest AND NOT root_manifest AS root_missing FROM g"""),
)
def run_minimum_set(spark, sf):
    return D.run_minimum_set(_files(spark, sf))


@query(
    "document_presence", "A43",
    with_sql(FILES, """
SELECT run_id, bool_or(path LIKE '%facts_summary%') AS has_facts, bool_or(path LIKE '%.txt') AS has_text, count(*) AS n_files FROM files GROUP BY 1"""),
)
def document_presence(spark, sf):
    p = F.col("path")
    return D.presence(_files(spark, sf), {"facts": p.contains("facts_summary"), "text": p.endswith(".txt")}, ["run_id"])


ARTIFACTS = {"manifest": ["**geometry_manifest.json"], "facts": ["b/*facts*"], "readme": ["RUN_README.??"], "clicks": ["x/click.txt", "x/nothing*"]}
TREE = {
    "type": "and",
    "items": [
        {"type": "or", "items": [{"type": "artifact_observed", "artifact_id": "manifest"}, {"type": "artifact_observed", "artifact_id": "facts"}]},
        {"type": "not", "item": {"type": "artifact_observed", "artifact_id": "clicks"}},
    ],
}
FLAGS = """fl AS (SELECT run_id, bool_or(path LIKE '%geometry_manifest.json') AS manifest, bool_or(path LIKE '%facts_summary%') AS facts, bool_or(path LIKE '%README%') AS readme, bool_or(path = 'x/click.txt') AS clicks FROM files GROUP BY 1)"""


@query(
    "rule_tree", "X4 A47",
    with_sql(FILES, FLAGS, """
SELECT run_id, manifest, facts, readme, clicks, (manifest OR facts) AND NOT clicks AS unlocked, concat_ws(',', CASE WHEN NOT manifest THEN 'manifest' END, CASE WHEN NOT facts THEN 'facts' END,
  CASE WHEN NOT readme THEN 'readme' END, CASE WHEN NOT clicks THEN 'clicks' END) AS missing FROM fl"""),
)
def rule_tree(spark, sf):
    flags = D.artifact_flags(_files(spark, sf), ARTIFACTS, ["run_id"])
    return flags.select(
        "*", D.rule(TREE, {n: F.col(n) for n in ARTIFACTS}).alias("unlocked"), D.missing_artifacts(list(ARTIFACTS)).alias("missing")
    )


@query(
    "newly_unlocked", "U5 A47",
    with_sql(FILES, FLAGS, """
u AS (SELECT substr(run_id, 5, 2) AS day, substr(run_id, 8) AS u, (manifest OR facts) AND NOT clicks AS f FROM fl)""", """
SELECT u FROM u WHERE day = '20' AND f EXCEPT SELECT u FROM u WHERE day = '19' AND f"""),
)
def newly_unlocked(spark, sf):
    flags = D.artifact_flags(_files(spark, sf), ARTIFACTS, ["run_id"])
    u = flags.select(
        F.substring("run_id", 5, 2).alias("day"), F.regexp_extract("run_id", r"_\d+_(\d+)$", 1).alias("u"),
        D.rule(TREE, {n: F.col(n) for n in ARTIFACTS}).alias("f"),
    )
    return S.newly_true(u.where("day = '20'"), u.where("day = '19'"), ["u"], "f")


LEDGER = [
    {"consumer_module": "fitting", "gate_code": "BODY_MANIFEST_MISSING", "enforcement_u1": "warn", "required_paths_any": ["exports/runs/**/geometry_manifest.json"]},
    {"consumer_module": "garment", "gate_code": "BODY_FACTS_MISSING", "enforcement_u1": "warn", "required_paths_any": ["exports/runs/lane9/**facts_summary.json", "none*"]},
    {"consumer_module": "ops", "gate_code": "README_MISSING", "enforcement_u1": "warn", "required_paths_any": ["exports/runs/lane1/**RUN_README.md"]},
    {"consumer_module": "ops", "gate_code": "NOT_ENFORCED", "enforcement_u1": "off", "required_paths_any": ["zzz"]},
]


@query(
    "ledger_unmet", "JN6 P28",
    with_sql(PROGRESS, """
f AS (SELECT module, step_id, bool_or(p LIKE 'exports/runs/%geometry_manifest.json') AS d0, false AS d1, bool_or(p LIKE 'exports/runs/lane1/%RUN_README.md') AS d2
  FROM (SELECT module, coalesce(step_id, '') AS step_id, split_part(path1, ':', 1) AS p FROM progress) GROUP BY 1, 2)""", """
SELECT module, step_id, 'fitting' AS consumer, 'BODY_MANIFEST_MISSING' AS gate_code FROM f WHERE NOT d0 UNION ALL SELECT module, step_id, 'garment', 'BODY_FACTS_MISSING' FROM f WHERE NOT d1
UNION ALL SELECT module, step_id, 'ops', 'README_MISSING' FROM f WHERE NOT d2"""),
)
def ledger_unmet(spark, sf):
    p = progress(spark, sf).select("module", F.coalesce("step_id", F.lit("")).alias("step_id"), F.substring_index("path1", ":", 1).alias("path"))
    return D.unmet_dependencies(p, LEDGER, ["module", "step_id"])


@query(
    "warnings_ordered", "T6",
    """
SELECT '[' || gate_code || '] ' || consumer || ' | expected=' || module || '/' || step_id AS warning, gate_code AS code, module || '/' || step_id AS place
FROM ({ledger}) ORDER BY code, place, warning""".replace("{ledger}", ORACLE["ledger_unmet"]),
)
def warnings_ordered(spark, sf):
    unmet = ledger_unmet(spark, sf)
    return D.ordered_warnings(unmet.select(F.format_string("[%s] %s | expected=%s/%s", "gate_code", "consumer", "module", "step_id").alias("warning")))


@query(
    "top_issues", "A44",
    """
WITH c AS (SELECT o_orderpriority AS g, 'unit' AS label FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_orderpriority, 'measurements' FROM orders WHERE NOT ({h})
 UNION ALL SELECT o_orderpriority, 'missingness' FROM orders WHERE {h} AND ((o_custkey % 2 = 0) OR (o_custkey % 5 <> 0 AND o_custkey % 3 = 0) OR o_custkey % 7 = 1)
 UNION ALL SELECT o_orderpriority, 'BUST_CIRC_M' FROM orders WHERE {h} AND o_custkey % 2 = 0 UNION ALL SELECT o_orderpriority, 'WAIST_CIRC_M' FROM orders WHERE {h} AND (o_custkey % 5 = 0 OR o_custkey % 3 = 0)
 UNION ALL SELECT o_orderpriority, 'HIP_CIRC_M' FROM orders WHERE {h} AND o_custkey % 7 < 2)
SELECT o_orderpriority, label, n, rank FROM (SELECT g AS o_orderpriority, label, count(*) AS n, row_number() OVER (PARTITION BY g ORDER BY count(*) DESC, label) AS rank FROM c GROUP BY 1, 2) WHERE rank <= 5""".replace("{h}", _HAS),
)
def top_issues(spark, sf):
    rows = D.checked(docs(spark, sf, SUBSET), ["o_orderpriority"], D.body_checks)
    return D.top_issues(rows, ["o_orderpriority"])
