"""Curation of survey sources: column mapping, repair, units, filters, missing-value policy."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.functions import keys as K
from tapeline.functions import numbers as N
from tapeline.operators.scale import exact_quantiles, first_candidates, first_k, join_keys, rows_where

WARNING_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("row_index", T.LongType()),
        T.StructField("original_value", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("sentinel_value", T.StringType()),
        T.StructField("sentinel_count", T.LongType()),
    ]
)

# The age window, the height and weight outlier bounds.
AGE_RANGE = (20, 59)
HEIGHT_BOUNDS = (1.0, 2.2)
WEIGHT_BOUNDS = (20.0, 250.0)
FORCED_MM_SOURCE = "7th"


def as_warnings(df: DataFrame) -> DataFrame:
    """Give a relation of findings the warning layout; absent fields become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in WARNING_SCHEMA.fields
        ]
    )


def mapping_frame(raw: DataFrame) -> DataFrame:
    """Nested mapping document to rows (ord, standard_key, ko_term, source, column, present)."""
    one = raw.select(F.posexplode("keys").alias("ord", "k"))
    return one.select(
        "ord",
        F.col("k.standard_key").alias("standard_key"),
        F.col("k.ko_term").alias("ko_term"),
        F.explode(F.map_entries("k.sources")).alias("s"),
    ).select(
        "ord",
        "standard_key",
        "ko_term",
        F.col("s.key").alias("source"),
        F.col("s.value.column").alias("column"),
        F.coalesce(F.col("s.value.present"), F.lit(False)).alias("present"),
    )


def standardize(
    rows: DataFrame, names: DataFrame, mapping: DataFrame, source: str, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Sheet rows (``fields``: text by column name) as one column per standard key, in mapping order, NULL where the
    sheet has none, and the findings as rows: ``column_not_present`` (not mapped) and ``column_not_found`` (mapped, but
    in none of the sheets whose ``names`` are given).

    ``mapping`` has (ord, standard_key, source, column, present). Only the part of this source, a row per column of
    the table to be built, visits the driver: it is the plan itself.
    """
    own = mapping.where(F.col("source") == source)
    cols = [F.col(c) for c in keep]
    for m in sorted(own.select("ord", "standard_key", "column", "present").collect(), key=lambda m: m.ord):
        text = F.try_element_at("fields", F.lit(m.column)) if m.present and m.column is not None else F.lit(None).cast("string")
        cols.append(text.alias(m.standard_key))
    known = names.select(F.col("name").alias("_found")).distinct()
    lost = own.join(known, F.col("column") == F.col("_found"), "left").where("NOT present OR _found IS NULL")
    reason = F.when(F.col("present"), "column_not_found").otherwise("column_not_present")
    notes = lost.select("source", F.col("standard_key").alias("column"), reason.alias("reason"), F.col("column").alias("original_value"))
    return rows.select(*cols), notes


def attach_by_position(primary: DataFrame, secondary: DataFrame, cols: Sequence[str], ordinal: str) -> DataFrame:
    """Meta columns of the secondary-header frame put beside the primary rows by row position."""
    return primary.join(secondary.select(ordinal, *cols), ordinal, "left")


def to_long(df: DataFrame, ids: Sequence[str], keys: Sequence[str], value: str = "value") -> DataFrame:
    """Wide survey rows to (ids, key, value) in one pass over the columns. The columns must be of one type.

    A row is repeated per key and picks its column; unlike ``unpivot`` this leaves plans that Spark recognises as the
    same, so what is counted from these rows is computed once however often it is used.
    """
    rows = df.withColumn("key", F.explode(F.array(*[F.lit(k) for k in keys])))
    picked = None
    for k in keys:
        picked = F.when(F.col("key") == k, F.col(f"`{k}`")) if picked is None else picked.when(F.col("key") == k, F.col(f"`{k}`"))
    return rows.select(*ids, "key", picked.alias(value))


def repair(long: DataFrame, raw: str = "raw") -> DataFrame:
    """Text to number with the sentinel and blank rules; keeps what each rule removed."""
    parsed = N.parse_number(F.col(raw))
    return (
        long.withColumn("parsed", parsed)
        .withColumn("is_sentinel", F.coalesce(F.col("parsed") == N.SENTINEL, F.lit(False)))
        .withColumn("is_blank", F.coalesce(F.trim(F.col(raw)) == "", F.lit(False)))
        .withColumn("value", N.null_sentinel(F.col("parsed")))
    )


def sentinel_counts(repaired: DataFrame, keys: Sequence[str] = ("source", "key")) -> DataFrame:
    """SENTINEL_MISSING findings: how many sentinels and blanks became NULL per key."""
    return repaired.groupBy(*keys).agg(
        F.count_if("is_sentinel").alias("sentinel_count"), F.count_if("is_blank").alias("blank_count")
    )


def parse_failures(df: DataFrame, keys: Sequence[str], raw: str = "raw", parsed: str = "parsed") -> DataFrame:
    """Values that were present as text but are no number, per key."""
    return df.groupBy(*keys).agg(
        F.count(raw).alias("non_null_before"),
        F.count(parsed).alias("non_null_after"),
        (F.count(raw) - F.count(parsed)).alias("failures"),
    )


def infer_units(long: DataFrame, order: Sequence[str], sample_size: int = 100) -> DataFrame:
    """Source unit per (source, key) from the first ``sample_size`` values in row order.

    Weight is kg, every length of the 7th survey is mm; otherwise the sample median decides:
    above 1000 mm, above 10 cm, else m. The sample is bounded, so the median is a plain aggregate.
    """
    lengths = long.where(F.col("value").isNotNull() & ~K.is_meta(F.col("key")))
    lead = F.col(order[0])
    if lengths.schema[order[0]].dataType.typeName() == "array":
        lead = F.get(lead, F.lit(0))
    near = first_candidates(lengths, ["source", "key"], lead, sample_size)
    head = first_k(near, ["source", "key"], [F.col(c) for c in order], sample_size, "_r")
    med = head.groupBy("source", "key").agg(
        F.percentile("value", F.lit(0.5)).alias("sample_median"), F.count(F.lit(1)).alias("n_sample")
    )
    key, m = F.col("key"), F.col("sample_median")
    unit = (
        F.when(key == "WEIGHT_KG", "kg")
        .when((F.col("source") == FORCED_MM_SOURCE) & K.expects_meter(key), "mm")
        .when(m > 1000, "mm")
        .when(m > 10, "cm")
        .otherwise("m")
    )
    return med.withColumn("unit", unit)


def canonicalize(long: DataFrame, units: DataFrame) -> DataFrame:
    """Apply the unit map; every row says how its key was treated.

    ``treatment``: none (weight), applied, override_mm (7th survey), default_mm (no unit known for a
    ``_M`` key), undetermined (no unit and no ``_M``), failed (unit is no length).
    """
    key, unit = F.col("key"), F.col("unit")
    joined = join_keys(long, units.select("source", "key", "unit"), ["source", "key"], "left")
    treatment = (
        F.when(key == "WEIGHT_KG", "none")
        .when(unit.isNull() & key.endswith("_M"), "default_mm")
        .when(unit.isNull(), "undetermined")
        .when((F.col("source") == FORCED_MM_SOURCE) & K.expects_meter(key), "override_mm")
        .when(unit.isin(*N.UNIT_DIVISOR), "applied")
        .otherwise("failed")
    )
    used = F.when(F.col("treatment").isin("default_mm", "override_mm"), "mm").when(
        F.col("treatment") == "applied", unit
    )
    value = F.when(F.col("treatment") == "none", F.col("value")).otherwise(
        N.to_meters(F.col("value"), F.col("used_unit"))
    )
    return (
        joined.withColumn("treatment", treatment)
        .withColumn("used_unit", used)
        .withColumn("value_m", N.finite(value))
    )


def unit_findings(canonical: DataFrame, weight: str | None = None) -> DataFrame:
    """One warning per key whose unit was assumed, overridden, missing or wrong; a row stands for ``weight`` rows."""
    agg = canonical.groupBy("source", "key", "treatment", "unit").agg(
        rows_where(F.col("value").isNotNull(), weight).alias("non_null_before"),
        rows_where(F.col("value_m").isNotNull(), weight).alias("non_null_after"),
        rows_where(N.is_infinite(F.col("value")), weight).alias("non_finite"),
    )
    reason = (
        F.when(F.col("treatment").isin("default_mm", "override_mm"), "unit_conversion_applied")
        .when(F.col("treatment") == "undetermined", "unit_undetermined")
        .when((F.col("treatment") == "failed") | (F.col("non_finite") > 0), "unit_conversion_failed")
    )
    return agg.withColumn("reason", reason).where(F.col("reason").isNotNull())


def apply_units_wide(df: DataFrame, unit_map: dict[str, str], source: str) -> DataFrame:
    """The same conversion on the wide table, as one projection from a collected unit map."""
    cols = []
    for c in df.columns:
        if c in K.META_KEYS or c == "WEIGHT_KG" or c.startswith("_"):
            cols.append(F.col(c))
            continue
        unit = unit_map.get(c)
        meter = "_M" in c and not c.endswith("_KG")
        if (source == FORCED_MM_SOURCE and meter) or (unit is None and c.endswith("_M")):
            unit = "mm"
        if unit in N.UNIT_DIVISOR:
            cols.append(N.to_meters(F.col(c).cast("double"), F.lit(unit)).alias(c))
        else:
            cols.append(F.lit(None).cast("double").alias(c))
    return df.select(*cols)


def age_filter(df: DataFrame, age: str = "age") -> DataFrame:
    """Adults 20..59; a row without age is dropped."""
    return df.where(F.col(age).between(*AGE_RANGE))


def outlier_filter(df: DataFrame, height: str = "HEIGHT_M", weight: str = "WEIGHT_KG") -> DataFrame:
    return df.where(F.col(height).between(*HEIGHT_BOUNDS) & F.col(weight).between(*WEIGHT_BOUNDS))


def filter_report(df: DataFrame, keys: Sequence[str], checks: dict) -> DataFrame:
    """Rows, kept and removed per group for each named predicate, in one aggregation."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for name, cond in checks.items():
        kept = F.count_if(F.coalesce(cond, F.lit(False)))
        aggs += [kept.alias(f"{name}_kept"), (F.count(F.lit(1)) - kept).alias(f"{name}_removed")]
    return df.groupBy(*keys).agg(*aggs)


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill each column with its exact median over the whole table (one row of medians)."""
    long = df.select(*cols).unpivot([], list(cols), "key", "value")
    medians = exact_quantiles(long, ["key"], "value", {"med": 0.5})
    one = medians.groupBy().agg(*[F.max(F.when(F.col("key") == c, F.col("med"))).alias(f"_m_{c}") for c in cols])
    filled = df.crossJoin(F.broadcast(one))
    for c in cols:
        filled = filled.withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}")))
    return filled.drop(*[f"_m_{c}" for c in cols])


def finite_only(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, N.finite(F.col(c)))
    return df


def non_finite_counts(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(N.is_infinite(F.col(c))).alias(c) for c in cols])


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All sources by name; a column one source lacks is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def curate_source(
    spark: SparkSession, frame: DataFrame, notes: DataFrame, source: str, order: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One source from standardized text columns to metres, its findings (with the ``notes`` on its columns), and the
    repaired long rows the sensors look at. All are lazy plans over the same input; only the unit map (one row
    per key) visits the driver."""
    numeric = [c for c in frame.columns if c not in (order, "HUMAN_ID", "SEX", "AGE")]
    meta = {
        "HUMAN_ID": lambda c: N.clean_id(c),
        "SEX": lambda c: N.normalize_sex(c, F.lit(source)),
        "AGE": lambda c: N.parse_number(c).cast("int"),
    }
    fixed = frame.select(
        order,
        *[
            (meta[c](F.col(c)) if c in meta else N.null_sentinel(N.parse_number(F.col(c)))).alias(c)
            for c in frame.columns
            if c != order
        ],
    )
    tagged = fixed.withColumn("source", F.lit(source))
    unpivoted = lambda d, keys: to_long(d.select("source", order, *keys), ["source", order], keys)
    long = unpivoted(tagged, numeric)
    # one row per column of the mapping, collected once: the plans below do not infer the units again
    units = spark.createDataFrame(infer_units(long, [order]).collect(), "source string, key string, sample_median double, n_sample long, unit string")
    unit_map = {r["key"]: r["unit"] for r in units.collect()}
    wide = apply_units_wide(fixed.withColumnRenamed(order, "_" + order), unit_map, source)
    found = unit_findings(canonicalize(long, units)).select(
        "source", F.col("key").alias("column"), "reason",
        F.concat(F.lit("treatment="), "treatment").alias("details"),
    )
    texts = to_long(frame.select(F.lit(source).alias("source"), order, *numeric), ["source", order], numeric, "raw")
    return wide.withColumn("_source", F.lit(source)), as_warnings(notes).unionByName(as_warnings(found)), repair(texts)
