"""Facts about measured cases: long results (case_id, standard_key, value, warnings) to per-key facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.functions import numbers as N
from tapeline.operators.scale import first_k, join_keys, order_stats, sample_text

MEDIAN = {"median": 0.5}


def key_facts(results: DataFrame, keys: Sequence[str] = ("standard_key",), value: str = "value") -> DataFrame:
    """Count, missing count and rate, min / median / max / mean per key (or key and class)."""
    keys = list(keys)
    s = order_stats(results, keys, value, MEDIAN)
    mean = results.groupBy(*keys).agg(F.avg(value).alias("mean_value"))
    s = join_keys(s, mean, keys, "left").withColumn("nan_count", F.col("n_rows") - F.col("n_values"))
    return s.withColumn("nan_rate", N.ratio(F.col("nan_count"), F.col("n_rows")))


def prefix_counts(results: DataFrame, keys: Sequence[str], texts: str = "warnings") -> DataFrame:
    """Warnings by their text before the first ``:``."""
    w = results.select(*keys, F.explode(texts).alias("w"))
    return w.groupBy(*keys, F.substring_index("w", ":", 1).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def top_k_counts(counts: DataFrame, keys: Sequence[str], item: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent items per group; ties by the item."""
    return first_k(counts, keys, [F.desc("n"), F.asc(item)], k, "rank")


def failure_reason(warnings: Column, found: Column, failed: Column) -> Column:
    """First failure reason of a missing value: debug reasons, else the first warning's prefix."""
    first = F.try_element_at(warnings, F.lit(1))
    return F.coalesce(found, failed, F.when(first.isNotNull(), F.substring_index(first, ":", 1)), F.lit("UNKNOWN"))


def exec_fail_code(warnings: Column) -> Column:
    """Sub-code of the first warning when it is an execution failure."""
    first = F.try_element_at(warnings, F.lit(1))
    return F.when(first.startswith("EXEC_FAIL:"), F.regexp_extract(first, "^EXEC_FAIL:(.*)$", 1))


def flag_rates(results: DataFrame, keys: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Share of results with each flag (proxy used, band scan, shared slice, unknown pose, ...)."""
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(F.coalesce(c, F.lit(False)).cast("double")).alias(n) for n, c in flags.items()],
    )


def outcome_audit(outcomes: DataFrame, samples: int = 3) -> DataFrame:
    """Cases by (stage, reason) with a few sample ids each."""
    g = ["stage", "reason"]
    counts = outcomes.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("case_id").alias("n_cases"))
    distinct = outcomes.select(*g, "case_id").distinct()
    ids = sample_text(distinct, g, [F.col("case_id")], samples, "case_id", "sample_ids")
    return join_keys(counts, ids, g, "left")


def duplicate_cases(cases: DataFrame, k: int = 10, samples: int = 3) -> tuple[DataFrame, DataFrame]:
    """Totals (rows, distinct, duplicated ids) and the ``k`` most repeated case ids."""
    per = cases.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"))
    totals = per.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), F.count_if(F.col("n") >= 2).alias("n_duplicated")
    )
    top = per.where(F.col("n") >= 2).orderBy(F.desc("n"), "case_id").limit(k)
    return totals, top


def fill_outcomes(expected: DataFrame, logged: DataFrame) -> DataFrame:
    """Exactly one record per expected case: the first logged one, or a filled ``missing_record``."""
    one = first_k(logged, ["case_id"], [F.col("seq")], 1, "_r").drop("_r").select("case_id", "outcome")
    gaps = expected.select("case_id").distinct().join(one, "case_id", "left_anti")
    return one.join(expected.select("case_id").distinct(), "case_id", "left_semi").unionByName(
        gaps.select("case_id", F.lit("missing_record").alias("outcome"))
    )


def log_gaps(entered: DataFrame, logged: DataFrame, processed: DataFrame, with_verts: DataFrame) -> DataFrame:
    """Audit differences: entered but not logged, logged as success but not processed, processed
    without vertices; one row per case and gap."""
    success = logged.where(F.col("outcome") == "success")
    gap = lambda a, b, name: a.select("case_id").distinct().join(b.select("case_id").distinct(), "case_id", "left_anti").select(
        F.lit(name).alias("gap"), "case_id"
    )
    return gap(entered, logged, "entered_not_logged").unionByName(
        gap(success, processed, "success_not_processed")
    ).unionByName(gap(processed, with_verts, "processed_without_verts"))


def field_summary(results: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Min / max / p50 / p95 of several diagnostic fields per key, in one unpivoted pass."""
    long = results.select(*keys, *[F.col(f).cast("double").alias(f) for f in fields]).unpivot(
        list(keys), list(fields), "field", "value"
    )
    return order_stats(long, [*keys, "field"], "value", {"p50": 0.5, "p95": 0.95})


def cohort_quality(results: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """p50 / p95 / count of the positive values of each field per key and cohort."""
    positive = results.select(*keys, *[F.when(F.col(f) > 0, F.col(f)).alias(f) for f in fields])
    return field_summary(positive, keys, fields).where(F.col("n_values") > 0)


def value_histogram(results: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    return results.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))


def paired_deltas(results: DataFrame, first: str, second: str, key: str = "standard_key", value: str = "value") -> DataFrame:
    """Two variants of one measure side by side per case: delta, absolute and percent difference.

    A pivot by conditional aggregation, so the pairing costs one shuffle and no self-join.
    """
    pair = results.where(F.col(key).isin(first, second)).groupBy("case_id").agg(
        F.max(F.when(F.col(key) == first, F.col(value))).alias("a"),
        F.max(F.when(F.col(key) == second, F.col(value))).alias("b"),
    )
    d = F.col("a") - F.col("b")
    return pair.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select(
        "case_id", "a", "b", d.alias("delta"), F.abs(d).alias("abs_delta"),
        (N.ratio(d, F.col("b")) * 100).alias("pct"),
    )


def delta_stats(pairs: DataFrame) -> DataFrame:
    fields = ["delta", "abs_delta", "pct"]
    long = pairs.unpivot([], fields, "field", "value")
    s = order_stats(long, ["field"], "value", {"p50": 0.5, "p90": 0.9, "p95": 0.95})
    return s.join(long.groupBy("field").agg(F.avg("value").alias("mean_value")), "field")


def subset_nullness(subset: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """NULLs per key and per case; DEGRADED when a case lacks two or more, SOFT when one lacks one."""
    per_case = sum((F.col(k).isNull().cast("int") for k in keys), F.lit(0))
    s = subset.withColumn("_nulls", per_case)
    worst = F.max("_nulls")
    return s.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_cases"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
        worst.alias("worst"),
        F.when(worst >= 2, "U1_SUBSET_NULL_DEGRADED_HIGH").when(worst == 1, "U1_SUBSET_NULL_SOFT").otherwise("NONE").alias("code"),
    )


def first_case(subset: DataFrame, order: Sequence[str], names: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """The first case of each group under the legacy names, with the names that lack a value."""
    row = F.min_by(F.struct(*names), F.struct(*order))
    out = subset.groupBy(*by).agg(row.alias("r"))
    missing = F.array_compact(F.array(*[F.when(F.col("r")[k].isNull(), F.lit(v)) for k, v in names.items()]))
    return out.select(*by, *[F.col("r")[k].alias(v) for k, v in names.items()], F.array_join(missing, ",").alias("missing"))




def first_qualifying(results: DataFrame, keys: Sequence[str], cond: Column, key: str = "standard_key") -> DataFrame:
    """Per case the first key in the given key order whose result meets the condition: recorded once."""
    rank = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col(key))
    hit = results.where(cond & F.col(key).isin(*keys))
    return hit.groupBy("case_id").agg(F.min_by(key, rank).alias("first_key"), F.count("*").alias("n_qualifying"))
