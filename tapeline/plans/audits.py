"""The contract and log job over the tables: documents and log derived from ``orders`` and ``events``, one call, all findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.operators import events as E
from tapeline.plans import jobs
from tapeline.plans.documents import FITTING, GARMENT, LEDGER, MANIFEST, SUBSET
from tapeline.plans.inputs import PROGRESS, progress, with_sql
from tapeline.plans.logs import CODES, FINDINGS, PLAN, REG, STATE, _now, _plan
from tapeline.plans.registry import ORACLE, dealt, query, table

LEVELS = """rk AS (SELECT step_id, max(CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END) AS reached FROM progress WHERE k % 2 = 0 AND step_id IS NOT NULL GROUP BY 1)"""
PLAN_OF_LOG = PLAN[: PLAN.index("evs AS")] + LEVELS
UNMET = """un AS (SELECT module, bool_or(p LIKE 'exports/runs/%geometry_manifest.json') AS d0, bool_or(p LIKE 'exports/runs/lane1/%RUN_README.md') AS d2
  FROM (SELECT module, unnest([split_part(path1, ':', 1), path2]) AS p FROM progress) GROUP BY 1)"""
checked = lambda kind, name: f"SELECT '{kind}' AS area, label AS code, severity, n FROM ({ORACLE[name]}) WHERE severity <> 'PASS'"
AUDIT_SQL = " UNION ALL ".join([
    checked("manifest", "manifest_checks"), checked("body", "body_checks"), checked("fitting", "fitting_checks"), checked("garment", "garment_checks"),
    f"SELECT 'log', code, 'FAIL', count(*) FROM ({ORACLE['tombstone_exempt']}) GROUP BY 2",
    f"SELECT 'hygiene', unnest(string_split(codes, ',')) AS code, 'WARN', 1 FROM ({ORACLE['hygiene']}) WHERE codes <> ''",
    f"SELECT 'balance', 'ROUND_END_MISSING', 'WARN', 1 FROM ({ORACLE['round_balance']}) WHERE end_missing",
    f"SELECT 'blocker', code, 'WARN', n FROM ({ORACLE['blockers_net']})",
    "SELECT 'ledger', 'BODY_MANIFEST_MISSING', 'WARN', 1 FROM un WHERE NOT d0 UNION ALL SELECT 'ledger', 'BODY_FACTS_MISSING', 'WARN', 1 FROM un UNION ALL SELECT 'ledger', 'README_MISSING', 'WARN', 1 FROM un WHERE NOT d2",
    f"SELECT 'lint', code, 'FAIL', n FROM ({ORACLE['plan_lint']})",
    "SELECT 'plan', 'STEP_BLOCKED', 'WARN', 1 FROM state WHERE state = 'blocked'",
    f"SELECT 'registry', 'NEW_RECORD', 'PASS', 1 FROM ({ORACLE['registry_append']})",
    "SELECT 'state', state, 'PASS', 1 FROM state",
    "SELECT 'document', 'CHECKED', 'PASS', 4 FROM orders",
])


def _runs(spark, sf):
    """Four documents of each order in folders of their module, and the inputs that lie beside them."""
    o = table(spark, sf, "orders")
    place = lambda module, name: F.concat(F.lit("runs/"), F.col("o_orderkey").cast("string"), F.lit(f"/{module}/{name}"))
    texts = [("body", "geometry_manifest.json", MANIFEST), ("body", "body_measurements_subset.json", SUBSET),
             ("fitting", "fitting_facts_summary.json", FITTING), ("garment", "garment_proxy_meta.json", GARMENT)]
    documents = dealt(o, "o_orderkey").select(F.inline(F.array(*[F.struct(place(m, n).alias("path"), F.expr(t).alias("doc")) for m, n, t in texts])))
    st, urgent = F.col("o_orderstatus"), F.col("o_orderpriority") == "1-URGENT"
    inputs = F.array(
        F.when(st == "F", place("fitting", "input.npz")), F.when(st == "P", place("fitting", "input.GLB")), F.when(urgent, place("garment", "mesh.obj")),
        place("garment", "note.txt"),
    )
    return documents, o.select(F.explode(F.array_compact(inputs)).alias("path"))


@query(
    "audit_job", "A38 A40 A41 A45 JN6 JN7 JN11 X3 X5 X6 X7 X10 X11",
    with_sql(PROGRESS, CODES, FINDINGS, REG, PLAN_OF_LOG, STATE, UNMET, f"every AS ({AUDIT_SQL})", "SELECT area, code, severity, CAST(sum(n) AS BIGINT) AS n FROM every GROUP BY 1, 2, 3"),
)
def audit_job(spark, sf):
    documents, files = _runs(spark, sf)
    k = F.col("k")
    log = progress(spark, sf).withColumns(
        {"status": F.when(k % 2 == 0, "OK").otherwise("NO"), "m_level": F.when(k % 4 == 0, "M2").when(k % 4 == 1, "M1").otherwise("M0")}
    )
    steps, edges, _ = _plan(spark, sf)
    known = E.registry_records(log).where(F.col("ordinal") % 10 < 3)
    found = jobs.audit(documents, files, log, steps, edges, LEDGER, known, _now())
    count = lambda df, area, code, severity: df.groupBy(area.alias("area"), code.alias("code"), severity.alias("severity"))
    n = F.when(F.col("area") == "blocker", F.col("detail").cast("bigint")).otherwise(1)
    counts = found.findings.groupBy("area", "code", "severity").agg(F.sum(n).alias("n"))
    rest = [(found.registry, F.lit("registry"), F.lit("NEW_RECORD")), (found.plan, F.lit("state"), F.col("state")), (found.severities, F.lit("document"), F.lit("CHECKED"))]
    for df, area, code in rest:
        counts = counts.unionByName(count(df, area, code, F.lit("PASS")).agg(F.count(F.lit(1)).alias("n")))
    return counts
