"""What went wrong and how: failures by fingerprint, outcomes of enabled cases, diagnostics of many fields in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions import numbers as N
from tapeline.operators.facts import top_k_counts
from tapeline.operators.scale import NULL_KEY, join_keys, sample_text, stats_of_counts

# How much of a message counts, length of a fingerprint, exceptions that are numeric errors, and scale
# factors that point to a unit mix-up with how near counts as near.
MESSAGE_CHARS = 200
FINGERPRINT_CHARS = 8
NUMERIC_EXCEPTIONS = ("ValueError", "TypeError", "IndexError")
SUSPICIOUS_FACTORS = {"near_1.0": (1.0, 0.02), "near_0.5": (0.5, 0.01), "near_0.1": (0.1, 0.002), "near_0.01": (0.01, 0.0002), "near_10": (10.0, 0.2), "near_100": (100.0, 2.0)}


def exception_fingerprint(kind: Column, message: Column) -> Column:
    """Short stable hash of an exception: its type and the start of its message; NULL without a type."""
    start = F.substring(F.coalesce(message, F.lit("")), 1, MESSAGE_CHARS)
    return F.substring(F.md5(F.concat(kind, F.lit(":"), start).cast("binary")), 1, FINGERPRINT_CHARS)


def exec_fail_subcode(kind: Column, message: Column) -> Column:
    """Sub-code of an execution failure by the words of its message, else by its type."""
    text = F.lower(F.coalesce(message, F.lit("")))
    few = text.contains("too few") | (text.contains("points") & (text.contains("<") | text.contains("few")))
    numeric = text.contains("numeric") | text.contains("nan") | text.contains("inf") | F.coalesce(kind, F.lit("")).isin(*NUMERIC_EXCEPTIONS)
    return F.when(text.contains("empty"), "SLICE_EMPTY").when(few, "TOO_FEW_POINTS").when(numeric, "NUMERIC_ERROR").otherwise("UNHANDLED_EXCEPTION")


def failure_breakdown(failed: DataFrame, keys: Sequence[str], kinds: dict[str, Column], k: int = 5) -> DataFrame:
    """(keys, kind, item, n, rank): the ``k`` most frequent items of each kind per key, such as reasons, sub-codes, exception
    types and fingerprints, from one pass over the failed results. NULL items do not count."""
    items = F.array(*[F.struct(F.lit(name).alias("kind"), c.cast("string").alias("item")) for name, c in kinds.items()])
    long = failed.select(*keys, F.inline(items)).where(F.col("item").isNotNull())
    counts = long.groupBy(*keys, "kind", "item").agg(F.count(F.lit(1)).alias("n"))
    return top_k_counts(counts, [*keys, "kind"], "item", k)


def enabled_skips(outcomes: DataFrame, k: int = 10, samples: int = 3) -> DataFrame:
    """(kind, item, n, rank, sample_ids): the commonest reasons and stages of cases that have a mesh (``has_mesh_path``) and yet
    did not succeed, the first case ids of each reason, and the number of outcomes of each reason of all cases."""
    skipped = outcomes.where(F.coalesce(F.col("has_mesh_path"), F.lit(False)) & (F.col("reason") != "success"))
    kinds = F.array(*[F.struct(F.lit(n).alias("kind"), F.coalesce(c, F.lit("unknown")).alias("item")) for n, c in (("reason", F.col("reason")), ("stage", F.col("stage")))])
    long = skipped.select("case_id", F.inline(kinds))
    counts = long.groupBy("kind", "item").agg(F.count(F.lit(1)).alias("n"))
    top = top_k_counts(counts, ["kind"], "item", k)
    ids = sample_text(long.where(F.col("kind") == "reason").distinct(), ["kind", "item"], [F.col("case_id")], samples, "case_id", "sample_ids")
    every = outcomes.groupBy(F.coalesce("reason", F.lit("unknown")).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    every = every.select(F.lit("outcome").alias("kind"), "item", "n", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("sample_ids"))
    return top.join(ids, ["kind", "item"], "left").select("kind", "item", "n", "rank", "sample_ids").unionByName(every)


def scale_marks(factor: Column) -> Column:
    """The suspicious values a scale factor is near to, as an array."""
    near = [F.when(F.abs(factor - value) < within, F.lit(name)) for name, (value, within) in SUSPICIOUS_FACTORS.items()]
    return F.array_compact(F.array(*near))


def diagnostic_counts(results: DataFrame, keys: Sequence[str], numbers: dict[str, Column], labels: dict[str, Column]) -> DataFrame:
    """(keys, field, label, value, n): every number and label of the results counted by value, in one pass.

    A label is a text or an array of texts; NULLs are left out. The field ``_rows`` counts the results. The shuffle is on
    the value after a map-side combine, so a key with most results is spread like any other.
    """
    entry = lambda f, l, v: F.struct(F.lit(f).alias("field"), l.cast("string").alias("label"), v.cast("double").alias("value"))
    none = F.lit(None)
    items = [F.array(entry("_rows", none, none), *[entry(f, none, c) for f, c in numbers.items()])]
    for f, c in labels.items():
        many = results.select(c.alias("c")).schema["c"].dataType.typeName() == "array"
        named = lambda field: lambda x: entry(field, x, none)
        items.append(F.transform(F.coalesce(c, F.array().cast("array<string>")) if many else F.array(c), named(f)))
    long = results.select(*keys, F.inline(F.concat(*items)))
    kept = long.where((F.col("field") == "_rows") | F.col("label").isNotNull() | F.col("value").isNotNull())
    return kept.groupBy(*keys, "field", "label", "value").agg(F.count(F.lit(1)).alias("n"))


def diagnostic_numbers(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, field, n_values, n_zero, min_value, max_value, p50, p95) of the numbers of :func:`diagnostic_counts`."""
    every = [*keys, "field"]
    text = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)).alias(f"_k{i}") for i, c in enumerate(every)]
    valued = counts.where(F.col("value").isNotNull())
    stats = stats_of_counts(valued.select(*text, F.col("value").alias("_v"), F.col("n").alias("_n")), {"p50": 0.5, "p95": 0.95})
    zero = valued.groupBy(*every).agg(F.sum(F.when(F.col("value") == 0, F.col("n")).otherwise(0)).alias("n_zero"))
    types = {c: counts.schema[c].dataType for c in every}
    named = stats.select(
        *[F.when(F.col(f"_k{i}") != NULL_KEY, F.col(f"_k{i}")).cast(types[c]).alias(c) for i, c in enumerate(every)],
        "n_values", "min_value", "max_value", "p50", "p95",
    )
    return join_keys(named, zero, every).select(*every, "n_values", "n_zero", "min_value", "max_value", "p50", "p95")


def diagnostic_labels(counts: DataFrame, keys: Sequence[str], k: int = 5) -> DataFrame:
    """(keys, field, item, n, rate, rank): the ``k`` commonest labels of each field and their share of the key's results."""
    rows = counts.where(F.col("field") == "_rows").select(*keys, F.col("n").alias("_all"))
    named = counts.where(F.col("label").isNotNull()).select(*keys, "field", F.col("label").alias("item"), "n")
    top = join_keys(top_k_counts(named, [*keys, "field"], "item", k), rows, list(keys))
    return top.withColumn("rate", N.ratio(F.col("n"), F.col("_all"))).drop("_all")


def fit_counts(fits: DataFrame, by: Sequence[str], kinds: dict[str, Column]) -> DataFrame:
    """(by, kind, item, n): fits by bucket, dominant region, failure type and whatever else ``kinds`` names, in one pass."""
    items = F.array(*[F.struct(F.lit(n).alias("kind"), c.cast("string").alias("item")) for n, c in kinds.items()])
    return fits.select(*by, F.inline(items)).where(F.col("item").isNotNull()).groupBy(*by, "kind", "item").agg(F.count(F.lit(1)).alias("n"))


def extremes(fits: DataFrame, score: str, order: Sequence[str], k: int = 20) -> DataFrame:
    """The ``k`` fits with the lowest and the ``k`` with the highest score (side, rank), ties by ``order``; a missing score is
    zero. Each side is a top-k of Spark, not a sort."""
    value = F.coalesce(F.col(score), F.lit(0.0))
    out = None
    for side, first in (("worst", value.asc()), ("best", value.desc())):
        top = fits.orderBy(first, *order).limit(k)
        ranked = top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(first, *order))).withColumn("side", F.lit(side))
        out = ranked if out is None else out.unionByName(ranked)
    return out


def sign_pattern(residuals: Sequence[Column]) -> Column:
    """``+,0,-`` of the residuals; NULL counts as zero."""
    return F.concat_ws(",", *[F.when(r > 0, "+").when(r < 0, "-").otherwise("0") for r in residuals])


def ease_facts(ratios: DataFrame, by: Sequence[str], fields: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per group: number of ease ratios, missing ones and their rate, the fields that were used, and the reasons of missing ones
    (``reason:n``, joined). ``fields`` gives each ratio and its reason."""
    items = F.array(*[F.struct(F.lit(f).alias("field"), v.cast("double").alias("ratio"), w.cast("string").alias("reason")) for f, (v, w) in fields.items()])
    counts = ratios.select(*by, F.inline(items)).groupBy(*by, "field", "reason").agg(F.count(F.lit(1)).alias("n"), F.count(N.finite(F.col("ratio"))).alias("_used"))
    used = F.array_sort(F.collect_set(F.when(F.col("_used") > 0, F.col("field"))))
    totals = counts.groupBy(*by).agg(F.sum("n").alias("n_total"), (F.sum("n") - F.sum("_used")).alias("n_nan"), F.array_join(used, ",").alias("used_keys"))
    reasons = counts.where(F.col("reason").isNotNull()).groupBy(*by, "reason").agg(F.sum("n").alias("n"))
    lines = F.array_sort(F.collect_list(F.concat("reason", F.lit(":"), F.col("n").cast("string"))))
    out = join_keys(totals, reasons.groupBy(*by).agg(F.array_join(lines, ",").alias("reasons")), list(by), "left")
    return out.withColumn("nan_rate", N.ratio(F.col("n_nan"), F.col("n_total")))


def column_existence(table: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, exists, non_null_count, null_count, missing_rate) of columns a table should have; those it lacks have no
    counts. One pass over the table for all of them."""
    have = [c for c in columns if c in table.columns]
    sums = table.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(have)])
    entry = lambda c, n: F.struct(F.lit(c).alias("column"), F.lit(n is not None).alias("exists"), (F.col(n) if n else F.lit(None)).cast("long").alias("non_null_count"))
    items = F.array(*[entry(c, f"_n{have.index(c)}" if c in have else None) for c in columns])
    return sums.select(*by, "_rows", F.inline(items)).select(
        *by, "column", "exists", "non_null_count", (F.col("_rows") - F.col("non_null_count")).alias("null_count"),
        (1 - N.ratio(F.col("non_null_count"), F.col("_rows"))).alias("missing_rate"),
    )
