"""Quality sensors over the long survey table (source, key, value): one unpivot, one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions import keys as K
from tapeline.functions import numbers as N
from tapeline.operators.scale import (
    NULL_KEY, exact_quantiles, first_candidates, first_k, join_keys, order_stats, rows_where, sample_text, stats_of_counts, value_counts,
)
from tapeline.operators.sets import containing

# Sensor thresholds.
SCALE_HIGH = 10.0
SCALE_LOW = 0.01
RANGE_MIN_COUNT = 50
MASSIVE_DROP = 0.95
MASSIVE_ROWS = 1000
HIGH_MISSING = 0.95


def all_null(long: DataFrame, text: str = "raw", number: str = "parsed") -> DataFrame:
    """ALL_NULL_EXTRACTED for a key without values, NON_NUMERIC_VALUES for one with text only."""
    agg = long.groupBy("source", "key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(text).alias("n_text"), F.count(number).alias("n_number")
    )
    reason = F.when(F.col("n_text") == 0, "ALL_NULL_EXTRACTED").when(F.col("n_number") == 0, "NON_NUMERIC_VALUES")
    return agg.withColumn("reason", reason).where(F.col("reason").isNotNull())


def all_null_by_source(long: DataFrame, value: str = "value", weight: str | None = None) -> DataFrame:
    """ALL_NULL_BY_SOURCE: a key of the final table that has no value in one source."""
    return (
        long.groupBy("source", "key")
        .agg(rows_where(F.lit(True), weight).alias("n_rows"), rows_where(F.col(value).isNotNull(), weight).alias("n_values"))
        .where((F.col("n_values") == 0) & (F.col("n_rows") > 0))
        .select("source", "key", "n_rows", F.lit("ALL_NULL_BY_SOURCE").alias("reason"))
    )


def massive_null(
    long: DataFrame, before: Column, after: Column, drop: float = MASSIVE_DROP, rows: int = MASSIVE_ROWS
) -> DataFrame:
    """MASSIVE_NULL_INTRODUCED: share and count of values a step turned into NULL."""
    agg = long.groupBy("source", "key").agg(F.count(before).alias("n_before"), F.count(after).alias("n_after"))
    lost = F.col("n_before") - F.col("n_after")
    return (
        agg.withColumn("dropped", lost)
        .withColumn("drop_rate", N.ratio(F.col("dropped"), F.col("n_before")))
        .where((F.col("dropped") >= rows) & (F.col("drop_rate") >= drop))
    )


SURVEY_PROBS = {"p01": 0.01, "p50": 0.5, "p99": 0.99}


def completeness(long: DataFrame, value: str = "value", weight: str | None = None) -> DataFrame:
    """Per source and key: counts, missing rate, order statistics and the scale they suggest."""
    s = order_stats(long, ["source", "key"], value, SURVEY_PROBS, weight=weight)
    p50, key = F.col("p50"), F.col("key")
    scale = (
        F.when(~K.expects_meter(key) | p50.isNull(), "not_checked")
        .when(p50 > SCALE_HIGH, "too_large")
        .when(p50 < SCALE_LOW, "too_small")
        .otherwise("ok")
    )
    return (
        s.withColumn("n_missing", F.col("n_rows") - F.col("n_values"))
        .withColumn("missing_rate", N.ratio(F.col("n_missing"), F.col("n_rows")))
        .withColumn("scale", scale)
    )


def scale_and_range(long: DataFrame, value: str = "value", weight: str | None = None) -> DataFrame:
    """SCALE_SUSPECTED and RANGE_SUSPECTED findings on metre keys, with the order statistics."""
    metre = long.where(K.expected_unit(F.col("key")) == "m").withColumn("_v", N.finite(F.col(value)))
    counts = value_counts(metre, ["source", "key"], "_v", weight)  # equal values once: both the order and the range need no more
    lo, hi = K.physical_range(F.col("_k1"))
    outside = counts.groupBy("_k0", "_k1").agg(
        F.sum(F.when((F.col("_v") < lo) | (F.col("_v") > hi), F.col("_n")).otherwise(0)).alias("out_of_range")
    )
    back = lambda k, name: F.when(F.col(k) != NULL_KEY, F.col(k)).alias(name)
    s = stats_of_counts(counts, SURVEY_PROBS).join(outside, ["_k0", "_k1"]).select(
        back("_k0", "source"), back("_k1", "key"), *SURVEY_PROBS, "min_value", "max_value", "out_of_range"
    )
    found = s.where(F.col("p50").isNotNull()).withColumn(
        "reason",
        F.explode(
            F.array_compact(
                F.array(
                    F.when((F.col("p50") > SCALE_HIGH) | (F.col("p50") < SCALE_LOW), "SCALE_SUSPECTED"),
                    F.when(F.col("out_of_range") >= RANGE_MIN_COUNT, "RANGE_SUSPECTED"),
                )
            )
        ),
    )
    return found.select(
        "source", "key", "reason", "p01", "p50", "p99", "min_value", "max_value", "out_of_range"
    )


def missing_net(long: DataFrame) -> DataFrame:
    """``value_missing`` per key without the sentinels and blanks that other findings already name."""
    return (
        long.groupBy("source", "key")
        .agg(
            F.count_if(F.col("value").isNull()).alias("missing"),
            F.count_if(F.col("is_sentinel") | F.col("is_blank")).alias("explained"),
        )
        .withColumn("net_missing", F.greatest(F.col("missing") - F.col("explained"), F.lit(0)))
        .where(F.col("net_missing") > 0)
    )


def source_quality(long: DataFrame, value: str = "value") -> DataFrame:
    return (
        long.groupBy("source", "key")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_values"))
        .withColumn("n_missing", F.col("n_rows") - F.col("n_values"))
        .withColumn("missing_rate", N.ratio(F.col("n_missing"), F.col("n_rows")))
    )


def high_missing(quality: DataFrame, rate: float = HIGH_MISSING) -> DataFrame:
    """Keys missing nearly everywhere, worst first within each source."""
    return quality.where(F.col("missing_rate") >= rate).orderBy("source", F.desc("missing_rate"), "key")


def source_order(quality: DataFrame) -> DataFrame:
    """Keys of each source ranked by missing rate, worst first (a row per source and column)."""
    worst = Window.partitionBy("source").orderBy(F.desc("missing_rate"), F.asc("key"))
    return quality.withColumn("position", F.row_number().over(worst))


def stage_trace(stages: DataFrame, keys: Sequence[str], order: Sequence[str], samples: int = 20) -> DataFrame:
    """Per stage, source and chosen key: counts, non-finite and non-numeric values, bounds, samples.

    Samples list the invalid values first, then the rows in order.
    """
    chosen = stages.where(F.col("key").isin(*keys))
    num = N.to_double(F.col("raw"))
    inf = F.coalesce(N.is_infinite(num), F.lit(False))
    marked = chosen.withColumn("_num", num).withColumn("_inf", inf).withColumn(
        "_bad", inf | (F.col("raw").isNotNull() & num.isNull())
    )
    g = ["stage", "source", "key"]
    agg = marked.groupBy(*g).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("raw").alias("non_null"),
        F.count_if("_inf").alias("non_finite"),
        F.count_if(F.col("raw").isNotNull() & F.col("_num").isNull()).alias("non_numeric"),
        F.min(N.finite(F.col("_num"))).alias("min_value"),
        F.max(N.finite(F.col("_num"))).alias("max_value"),
    )
    texts = marked.where(F.col("raw").isNotNull())
    lead = F.get(order[0], F.lit(0)) if texts.schema[order[0]].dataType.typeName() == "array" else F.col(order[0])
    near = first_candidates(texts, [*g, "_bad"], lead, samples)
    shown = sample_text(near, g, [F.desc("_bad"), *[F.col(c) for c in order]], samples, "raw", "samples", "|")
    return join_keys(agg, shown, g, "left")


def reason_histogram(warnings: DataFrame) -> DataFrame:
    return warnings.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def header_variants(names: DataFrame) -> DataFrame:
    """Columns that pandas-style suffixes made distinct (``x``, ``x.1``): value count per variant."""
    base = F.regexp_replace("name", r"\.\d+$", "")
    counted = names.groupBy(base.alias("base"), "name").agg(F.sum("non_null").alias("non_null"))
    groups = counted.groupBy("base").agg(F.count(F.lit(1)).alias("n_variants")).where(F.col("n_variants") > 1)
    return join_keys(counted, groups, ["base"])


def header_candidates(profile: DataFrame, patterns: DataFrame) -> DataFrame:
    """Columns whose name holds one of the patterns, with their completeness."""
    return containing(profile, "name", patterns, "pattern")


def value_profile(
    long: DataFrame, keys: Sequence[str], row_id: Sequence[str], n_rows: int = 20, shown: int = 5, seed: int = 42
) -> DataFrame:
    """Min, max, mean and a few values over a seeded sample of rows per source.

    The sample is the first ``n_rows`` rows by the MD5 of the seed and the parts of their id, joined by commas: the same on
    every run and on every engine.
    """
    many = {f.name for f in long.select(*row_id).schema.fields if f.dataType.typeName() == "array"}
    parts = [F.col(c).cast("array<string>" if c in many else "string") for c in row_id]
    order = [F.md5(F.concat_ws(",", F.lit(str(seed)), *parts).cast("binary")), *[F.col(c) for c in row_id]]
    lead = F.conv(F.substring(order[0], 1, 15), 16, 10).cast("bigint")  # 60 bits of the digest, in the same order
    picked = first_k(first_candidates(long.where(F.col("value").isNotNull()), keys, lead, n_rows), keys, order, n_rows, "_s")
    head = F.array_sort(
        F.collect_list(F.when(F.col("_s") <= shown, F.struct("_s", F.col("value").alias("v"))))
    )
    return picked.groupBy(*keys).agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("mean_value"),
        F.count(F.lit(1)).alias("n_valid"),
        F.transform(head, lambda s: s["v"]).alias("sample_values"),
    )


def id_quality(df: DataFrame, ids: Sequence[str], by: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows, distinct ids and duplicate share per group. ``approximate`` trades exactness for one pass."""
    if approximate:
        distinct = F.approx_count_distinct(F.struct(*ids))
    else:
        distinct = F.count_distinct(*ids)
    return (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_distinct"))
        .withColumn("duplicate_rate", 1 - N.ratio(F.col("n_distinct"), F.col("n_rows")))
    )


def missing_ratio(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])


def cross_source_ratio(
    long: DataFrame, low: float = 0.5, high: float = 2.0, value: str = "value", weight: str | None = None
) -> DataFrame:
    """Pairs of sources whose medians of one key differ by more than the allowed factor.

    Joins two dictionary-sized relations of medians, never the rows.
    """
    med = exact_quantiles(long, ["source", "key"], value, {"p50": 0.5}, weight=weight)
    a = med.select("key", F.col("source").alias("source_a"), F.col("p50").alias("p50_a"))
    b = med.select("key", F.col("source").alias("source_b"), F.col("p50").alias("p50_b"))
    r = N.ratio(F.col("p50_a"), F.col("p50_b"))
    return (
        a.join(b, "key")
        .where(F.col("source_a") < F.col("source_b"))
        .withColumn("p50_ratio", r)
        .withColumn("consistent", F.coalesce(F.col("p50_ratio").between(low, high), F.lit(False)))
    )
