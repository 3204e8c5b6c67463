"""Progress-log analytics: last events, codes, progress, hygiene, balance, registry records.

Events carry ``ordinal``, the line number of the append-only log; "last" always means by ordinal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions import paths as P
from tapeline.operators.scale import first_k, join_keys, running_sum

# Look-back sizes and hygiene limits.
BLOCKER_EVENTS = 50
HYGIENE_EVENTS = 10
STUCK_MIN = 5
THIN_MIN = 7
THIN_CHARS = 12
STALE_HOURS = 24
EVIDENCE_SHOWN = 3
MISSING, BACKFILLED = "STEP_ID_MISSING", "STEP_ID_BACKFILLED"
ORDINAL_BLOCK = 100_000


def last_n(events: DataFrame, n: int, by: Sequence[str] = ("module",)) -> DataFrame:
    """The last ``n`` events per group; every task passes on at most ``n`` rows per group."""
    return first_k(events, list(by), [F.desc("ordinal")], n, "_back")


def last_known(events: DataFrame, by: Sequence[str], fields: dict[str, Column]) -> DataFrame:
    """Last non-NULL value of each field per group, as a combinable aggregate."""
    return events.groupBy(*by).agg(
        *[F.max_by(c, F.when(c.isNotNull(), F.col("ordinal"))).alias(n) for n, c in fields.items()]
    )


def with_codes(events: DataFrame) -> DataFrame:
    """Adds ``codes``: gate codes (string or list) and ``[CODE]`` marks of the warnings."""
    return events.withColumn("codes", F.concat(P.gate_codes(F.col("gate_codes")), P.warning_codes(F.col("warnings"))))


def blockers(events: DataFrame, n_events: int = BLOCKER_EVENTS, k: int = 5) -> DataFrame:
    """Most frequent codes over the last events of each module; a backfill cancels one missing step id
    of its module, never below zero."""
    recent = with_codes(last_n(events, n_events)).select(
        "module", "codes",
        (
            F.array_contains(P.gate_codes(F.col("gate_codes")), BACKFILLED)
            | F.exists("warnings", lambda w: w.contains(BACKFILLED))
        ).alias("backfill"),
    )
    codes = recent.select("module", F.explode("codes").alias("code"))
    plain = codes.where(F.col("code") != MISSING).groupBy("code").agg(F.count("*").alias("n"))
    net = (
        recent.groupBy("module")
        .agg(
            F.sum(F.size(F.filter("codes", lambda c: c == MISSING))).alias("missing"),
            F.count_if("backfill").alias("fixed"),
        )
        .agg(F.sum(F.greatest(F.col("missing") - F.col("fixed"), F.lit(0))).alias("n"))
        .select(F.lit(MISSING).alias("code"), "n")
        .where(F.col("n") > 0)
    )
    return plain.unionByName(net).orderBy(F.desc("n"), "code").limit(k)


def step_progress(events: DataFrame) -> DataFrame:
    """Per module and step: done sum, last total, last time and note."""
    stepped = events.where(F.col("step_id").isNotNull())
    last = last_known(
        stepped, ["module", "step_id"],
        {"total": F.col("dod_total"), "last_ts": F.col("ts_text"), "last_note": F.nullif(F.col("note"), F.lit(""))},
    )
    done = stepped.groupBy("module", "step_id").agg(F.sum("dod_done_delta").alias("done"), F.count("*").alias("n_events"))
    return join_keys(done, last, ["module", "step_id"]).withColumn("over_total", F.coalesce(F.col("done") > F.col("total"), F.lit(False)))


def module_progress(events: DataFrame) -> DataFrame:
    """Per module: done sum, last specified step, missing step ids net of backfills."""
    named = F.col("step_id").isNotNull() & (F.col("step_id") != "UNSPECIFIED")
    fixed = F.array_contains(P.gate_codes(F.col("gate_codes")), BACKFILLED)
    return events.groupBy("module").agg(
        F.sum(F.when(F.col("step_id").isNotNull(), F.col("dod_done_delta"))).alias("done"),
        F.max_by("step_id", F.when(named, F.col("ordinal"))).alias("last_step"),
        F.max_by("note", F.when(named, F.col("ordinal"))).alias("last_note"),
        F.greatest(
            F.count_if(F.col("step_id") == "UNSPECIFIED") - F.count_if(F.coalesce(fixed, F.lit(False))), F.lit(0)
        ).alias("net_missing"),
    )


def first_overflow(events: DataFrame, planned: DataFrame, block: int = ORDINAL_BLOCK) -> DataFrame:
    """Per module and step the first event at which the running done total passes the planned total."""
    run = running_sum(
        events.where(F.col("step_id").isNotNull()).select("module", "step_id", "ordinal", "dod_done_delta"),
        ["module", "step_id"], ["ordinal"], "dod_done_delta", F.floor(F.col("ordinal") / block), "running",
    )
    over = run.join(planned, ["module", "step_id"]).where(F.col("running") > F.col("planned"))
    return over.groupBy("module", "step_id").agg(
        F.min("ordinal").alias("first_ordinal"), F.min_by("running", "ordinal").alias("running")
    )


def hygiene(events: DataFrame, now: Column) -> DataFrame:
    """STALE_PROGRESS, STEP_STUCK and EVENT_THIN over the last ten events of each module."""
    recent = last_n(events, HYGIENE_EVENTS)
    agg = recent.groupBy("module").agg(
        F.count("*").alias("n"),
        F.max_by("time", "ordinal").alias("last_time"),
        F.count_distinct(F.coalesce("step_id", F.lit(""))).alias("n_steps"),
        F.max(F.coalesce("step_id", F.lit(""))).alias("one_step"),
        F.count_if(F.length(F.coalesce("note", F.lit(""))) < THIN_CHARS).alias("n_thin"),
    )
    codes = F.array_compact(
        F.array(
            F.when(F.col("last_time") < now - F.expr(f"INTERVAL '{STALE_HOURS}' HOUR"), "STALE_PROGRESS"),
            F.when((F.col("n") >= STUCK_MIN) & (F.col("n_steps") == 1) & (F.col("one_step") != ""), "STEP_STUCK"),
            F.when((F.col("n") >= THIN_MIN) & (F.col("n_thin") >= THIN_MIN), "EVENT_THIN"),
        )
    )
    return agg.select("module", "n", "n_thin", F.array_join(codes, ",").alias("codes"))


def round_balance(events: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Round starts against ends in the window; an event without a readable time still counts."""
    recent = events.where(F.col("time").isNull() | (F.col("time") >= now - F.expr(f"INTERVAL '{hours}' HOUR")))
    return recent.groupBy("module").agg(
        F.count_if(F.lower("event_type") == "round_start").alias("starts"),
        F.count_if(F.lower("event_type") == "round_end").alias("ends"),
    ).withColumn("end_missing", F.col("starts") > F.col("ends"))


def registry_records(events: DataFrame, shown: int = EVIDENCE_SHOWN) -> DataFrame:
    """Registry records of round-end events: up to ``shown`` evidence paths, lane and run of the last of them,
    gate codes with the two quality codes, the manifest path."""
    ends = events.where(F.lower("event_type") == "round_end").withColumn("paths", P.event_paths(F.col("paths")))
    ev = F.slice(F.filter("paths", lambda p: P.run_id_of(p).isNotNull()), 1, shown)
    e = ends.withColumn("evidence", ev).where(F.size("evidence") > 0)
    last = F.try_element_at("evidence", F.lit(-1))
    e = e.withColumns({"lane": P.lane_of(last), "run_id": P.run_id_of(last)})
    prefix = F.concat(F.lit("exports/runs/"), F.col("lane"), F.lit("/"), F.col("run_id"), F.lit("/"))
    manifests = F.filter("evidence", lambda p: F.lower(p).contains("manifest"))
    own = F.filter(manifests, lambda p: p.startswith(prefix))
    rid = F.nullif(F.trim(F.coalesce("round_id", F.lit(""))), F.lit(""))
    e = e.withColumn("manifest_path", F.coalesce(F.try_element_at(own, F.lit(1)), F.try_element_at(manifests, F.lit(1))))
    quality = F.array_compact(
        F.array(
            F.when(rid.isNull(), "REGISTRY_INCOMPLETE"),
            F.when(F.col("manifest_path").isNotNull() & (F.size(own) == 0), "REGISTRY_MANIFEST_MISMATCH"),
        )
    )
    codes = F.array_distinct(F.concat(P.gate_codes(F.col("gate_codes")), quality))
    return e.select(
        "ordinal", "module", "lane", "run_id", F.coalesce(rid, F.lit("N/A")).alias("round_id"),
        F.coalesce("step_id", F.lit("")).alias("step_id"), F.array_join("evidence", ",").alias("evidence"),
        F.array_join(codes, ",").alias("gate_codes"), "manifest_path",
    )


REGISTRY_KEY = ["module", "lane", "run_id", "round_id"]


def new_records(records: DataFrame, registry: DataFrame, lookback: int | None = None) -> DataFrame:
    """First record per key that the registry does not hold; with ``lookback``, that is not among its last entries."""
    known = registry if lookback is None else registry.orderBy(F.desc("ordinal")).limit(lookback)
    known = known.select(*REGISTRY_KEY).distinct()
    fresh = records.join(known, REGISTRY_KEY, "left_anti")
    return first_k(fresh, REGISTRY_KEY, [F.asc("ordinal")], 1, "_r").drop("_r")


def tombstones(events: DataFrame) -> DataFrame:
    """Line numbers that a backfill event's note exempts (``referenced_line=3/7``)."""
    marked = events.where(F.array_contains(P.gate_codes(F.col("gate_codes")), "SCHEMA_VIOLATION_BACKFILLED"))
    text = F.regexp_extract("note", r"referenced_line=([\d/]+)", 1)
    return marked.select(F.explode(F.split(text, "/")).alias("t")).where("t <> ''").select(
        F.col("t").try_cast("bigint").alias("ordinal")
    ).distinct()


def without_exempted(findings: DataFrame, events: DataFrame) -> DataFrame:
    return findings.join(tombstones(events), "ordinal", "left_anti")


def schema_findings(events: DataFrame) -> DataFrame:
    """Event contract by line: time, module, step and event type (``raw_*`` columns keep the text)."""
    checks = {
        "TS_MISSING": F.col("ts_text").isNull(),
        "MODULE_MISSING": F.col("module").isNull(),
        "MODULE_INVALID": ~F.lower("module").isin("body", "fitting", "garment"),
        "STEP_ID_MISSING": F.col("step_id").isNull(),
        "EVENT_TYPE_MISSING": F.col("event_type").isNull(),
    }
    codes = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in checks.items()]))
    return events.select("ordinal", F.explode(codes).alias("code"))
