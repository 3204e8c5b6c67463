"""The batch jobs end to end, composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions import paths as H
from tapeline.functions import scoring as P
from tapeline.operators import cluster as K
from tapeline.operators import compare as D
from tapeline.operators import contracts as X
from tapeline.operators import curate as C
from tapeline.operators import events as E
from tapeline.operators import facts as A
from tapeline.operators import geometry as G
from tapeline.operators import plan as L
from tapeline.operators import sensors as S
from tapeline.operators import slices as W
from tapeline.operators.scale import join_keys
from tapeline.sources import sinks, survey
from tapeline.sources.shared import written


def curate(spark: SparkSession, sheets: dict[str, str], mapping_path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Survey sheets to (curated table, warnings, completeness).

    The sensors look at the rows before the age filter, the filter then applies to the table.
    """
    mapping = survey.read_mapping(spark, mapping_path)
    frames, notes, texts = [], [], []
    for source, path in sheets.items():
        sheets_of = survey.read_survey(spark, path, strip_prefix=source.startswith("8th"), source=source)
        # files one behind the other: a row is known by its file and its place there
        rows = sheets_of.rows.withColumn("row", F.format_string("%s#%012d", "file", "row_idx"))
        frame, lost = C.standardize(rows, sheets_of.names, mapping, source, keep=["row"])
        wide, found, repaired = C.curate_source(spark, frame, lost, source, "row")
        frames.append(wide)
        notes.append(found)
        texts.append(repaired)
    every = C.union_sources(frames)
    keys = [c for c in every.columns if not c.startswith("_") and c not in ("HUMAN_ID", "SEX", "AGE")]
    long = C.to_long(every.select(F.col("_source").alias("source"), *keys), ["source"], keys)
    report = S.completeness(long)
    seen = S.scale_and_range(long).select(
        "source", F.col("key").alias("column"), "reason",
        F.format_string("p01=%.4f, p50=%.4f, p99=%.4f, min=%.4f, max=%.4f", "p01", "p50", "p99", "min_value", "max_value").alias("details"),
    )
    empty = S.all_null_by_source(long).select("source", F.col("key").alias("column"), "reason")
    warnings = C.union_sources([*notes, C.as_warnings(seen), C.as_warnings(empty), *sensor_warnings(C.union_sources(texts), every, long)])
    return C.age_filter(every, "AGE"), warnings, report


def sensor_warnings(repaired: DataFrame, every: DataFrame, long: DataFrame) -> list[DataFrame]:
    """What was lost on the way: sentinels, missing values, empty and emptied columns, rows outside the age window,
    and medians that differ between sources."""
    named = lambda df, reason, details, *more: C.as_warnings(
        df.select("source", F.col("key").alias("column"), reason.alias("reason"), details.alias("details"), *more)
    )
    marks = C.sentinel_counts(repaired).where("sentinel_count + blank_count > 0")
    lost = S.massive_null(repaired, F.col("raw"), F.col("parsed"))
    adult = F.col("AGE").between(*C.AGE_RANGE)
    ages = C.filter_report(every.withColumnRenamed("_source", "source"), ["source"], {"age": adult}).where("age_removed > 0")
    pairs = S.cross_source_ratio(long).where(~F.col("consistent")).withColumnRenamed("source_a", "source")
    none = F.lit(None).cast("string")
    return [
        named(marks, F.lit("SENTINEL_MISSING"), F.format_string("blank=%d", "blank_count"), F.lit("9999").alias("sentinel_value"), "sentinel_count"),
        named(S.missing_net(repaired), F.lit("value_missing"), F.format_string("missing=%d", "net_missing")),
        named(S.all_null(repaired), F.col("reason"), none),
        named(lost, F.lit("MASSIVE_NULL_INTRODUCED"), F.format_string("dropped=%d of %d", "dropped", "n_before")),
        named(ages.withColumn("key", F.lit("AGE")), F.lit("age_filter_applied"), F.format_string("removed=%d of %d", "age_removed", "n_rows")),
        named(pairs, F.lit("CROSS_SOURCE_SUSPECTED"), F.format_string("%s: p50 ratio %.4f", "source_b", "p50_ratio")),
    ]


def write_curation(curated: DataFrame, warnings: DataFrame, path: str, fmt: str = "parquet") -> None:
    sinks.write_curated(curated, f"{path}/curated", fmt)
    sinks.write_warnings(warnings, f"{path}/warnings")


def measure(verts: DataFrame) -> DataFrame:
    """Vertex table to long results (case_id, standard_key, value, code, shift_mm of values taken at a nearby plane)."""
    fixed = G.repair_scale(verts).drop("scaled", "max_abs")
    boxes = G.bounding_boxes(fixed)
    girths = W.measurement_outcomes(fixed, boxes).select("case_id", "standard_key", "value", "code")
    widths = G.band_widths(fixed, boxes).select(
        "case_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.concat("key", F.lit(f"_{n}_M")).alias("standard_key"), F.col(f"{c}_m").alias("value"),
                        F.nullif(F.concat_ws(",", "plane_code", f"{c}_code"), F.lit("")).alias("code"), "shift_mm",
                    )
                    for n, c in (("WIDTH", "width"), ("DEPTH", "depth"))
                ]
            )
        ),
    )
    body = boxes.select(
        "case_id",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("standard_key"), F.col(c).alias("value"), F.col("height_code").alias("code"))
                    for k, c in (("HEIGHT_M", "height_m"), ("CROTCH_HEIGHT_M", "crotch_height_m"), ("KNEE_HEIGHT_M", "knee_height_m"))
                ]
            )
        ),
    )
    arms = G.arm_lengths(fixed, boxes).select("case_id", F.lit("ARM_LEN_M").alias("standard_key"), F.col("arm_len_m").alias("value"), "code")
    return C.union_sources([girths, widths, body, arms])


def summarise(results: DataFrame) -> DataFrame:
    return A.key_facts(results)


def cluster(curated: DataFrame, features: Sequence[str], k: int, order: str, missing: str = "drop", max_iter: int = 300) -> dict:
    """Filter, handle missing values, standardise, cluster; centroids come back in original units."""
    rows = C.outlier_filter(curated) if {"HEIGHT_M", "WEIGHT_KG"} <= set(curated.columns) else curated
    used = C.drop_missing(rows, features) if missing == "drop" else C.impute_median(rows, features)
    z, params = K.zscore(used, features)
    zc = K.lloyd(z, features, k, [order], max_iter)
    centroids = K.to_original_scale(zc, features, params)
    back = K.assign(z, features, zc).withColumns({c: F.col(c) * s + m for c, (m, s) in params.items()})
    distances = K.original_distance(back, K.centroid_frame(curated.sparkSession, centroids, features), features)
    return {"centroids": centroids, "assignments": distances, "stats": K.assignment_stats(distances)}


def score(residuals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Residuals in metres to score, bucket, dominant region, ranked keys and sign pattern."""
    cols = {k: F.col(k) for k in keys}
    ranked = P.ranked_keys(cols)
    s = residuals.withColumn("score", P.residual_score(cols))
    return s.withColumns(
        {
            "bucket": P.score_bucket(F.col("score")), "ranked": ranked, "dominant": P.dominant_region(ranked),
            "pattern": P.sign_pattern(list(cols.values())),
        }
    )


def compare_runs(current: DataFrame, reference: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fact rows of two runs to (difference per key, keys that got worse)."""
    cur = current.withColumn("run", F.lit("current"))
    ref = reference.withColumn("run", F.lit("current"))
    return D.diff_rates(current, reference, ["standard_key"]), D.degraded_keys(cur, ref, ["run"])


class Audit(NamedTuple):
    """What the contract and log job finds: problems one by one, the registry's new records, the state of the plan."""

    findings: DataFrame  # area, subject, code, severity, detail
    severities: DataFrame  # path, worst, n_worst, n_checks of every document
    registry: DataFrame
    plan: DataFrame


#: Which document is of which kind, by the end of its name.
DOCUMENT_KINDS = {
    "manifest": ("geometry_manifest.json",), "body": ("body_measurements_subset.json",),
    "fitting": ("fitting_facts_summary.json",), "garment": ("garment_proxy_meta.json",),
}


def document_checks(documents: DataFrame, files: DataFrame) -> DataFrame:
    """(path, kind, label, severity) of every check of every document of a known kind. Each text is parsed once, with those
    of its kind, for the checks of all kinds in one step grow past the size of code that the JVM compiles. Which inputs lie
    beside a document is told by ``files`` (path), summed up per folder."""
    name = F.substring_index("path", "/", -1)
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder")
    has = lambda *ends: F.bool_or(F.lower("path").rlike("(" + "|".join(ends) + r")$"))
    beside = files.groupBy(folder).agg(has(r"\.npz").alias("npz"), has(r"\.glb").alias("glb"), has(r"\.glb", r"\.obj", r"\.npz").alias("mesh"))
    there = lambda c: F.coalesce(F.col(c), F.lit(False))
    of_kind = {
        "manifest": (X.manifest_checks, []), "body": (X.body_checks, []), "fitting": (X.fitting_checks, ["npz", "glb"]),
        "garment": (X.garment_checks, ["mesh"]),
    }
    rows = None
    for k, (checks, inputs) in of_kind.items():
        mine = documents.where(name.isin(*DOCUMENT_KINDS[k])).select("path", "doc", F.lit(k).alias("kind"), folder)
        if inputs:
            mine = join_keys(mine, beside, ["folder"], "left")
        found = X.checked(X.parse(mine), ["path", "kind"], checks, *[there(c) for c in inputs])
        rows = found if rows is None else rows.unionByName(found)
    return rows


def audit(
    documents: DataFrame, files: DataFrame, events: DataFrame, steps: DataFrame, edges: DataFrame, ledger: Sequence[dict],
    registry: DataFrame, now: Column,
) -> Audit:
    """Contract and log job: run documents (path, doc), the files of the runs, the progress log (``ts_text``, ``time``, ``paths``
    beside the fields of an event), the plan, the dependency ledger and the registry, to all findings.

    Documents and log are each read once and written to the shared folder in the few columns that are needed; the checks,
    the ledger, hygiene, balance, blockers, schema, registry and plan fan out from there. A finding of a document is a
    check that does not pass; lines a tombstone exempts have none.
    """
    documents = written(documents.select("path", "doc"))
    events = written(events.select(
        "ordinal", "module", "event_type", "step_id", "round_id", "note", "ts_text", "time", "gate_codes", "warnings", "paths", "status", "m_level"
    ))
    rows = written(document_checks(documents, files))
    reached = L.reached_levels(events)
    plan = L.plan_state(steps, edges, reached)
    none = F.lit(None).cast("string")

    def found(df: DataFrame, area: Column, subject: Column, code: Column, severity: Column, detail: Column = none) -> DataFrame:
        columns = {"area": area, "subject": subject, "code": code, "severity": severity, "detail": detail}
        return df.select(*[c.cast("string").alias(n) for n, c in columns.items()])

    col, warn, fail = F.col, F.lit(X.WARN), F.lit(X.FAIL)
    codes = F.explode(F.split("codes", ",")).alias("code")
    # a module whose events name no path has none of what it needs
    observed = events.select("module", F.explode_outer(H.event_paths(col("paths"))).alias("path")).na.fill("", ["path"])
    parts = [
        found(rows.where(col("severity") != X.PASS), col("kind"), col("path"), col("label"), col("severity")),
        found(E.without_exempted(E.schema_findings(events), events), F.lit("log"), col("ordinal"), col("code"), fail),
        found(E.hygiene(events, now).where("codes <> ''").select("module", codes), F.lit("hygiene"), col("module"), col("code"), warn),
        found(E.round_balance(events, now).where("end_missing"), F.lit("balance"), col("module"), F.lit("ROUND_END_MISSING"), warn),
        found(E.blockers(events), F.lit("blocker"), none, col("code"), warn, col("n")),
        found(X.unmet_dependencies(observed, ledger, ["module"]), F.lit("ledger"), col("module"), col("gate_code"), warn, col("consumer")),
        found(L.lint(steps, edges), F.lit("lint"), col("step_id"), col("code"), fail, col("detail")),
        found(plan.where("state = 'blocked'"), F.lit("plan"), col("step_id"), F.lit("STEP_BLOCKED"), warn, col("n_unmet")),
    ]
    findings = parts[0]
    for p in parts[1:]:
        findings = findings.unionByName(p)
    return Audit(findings, X.roll_up(rows, ["path"]), E.new_records(E.registry_records(events), registry), plan)
