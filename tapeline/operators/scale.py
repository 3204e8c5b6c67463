"""Plan shapes that stay whole when one key holds a large share of the rows.

Everything here avoids sorting, collecting or buffering a full group in one task:

* exact quantiles work on pre-aggregated value counts, cut into value buckets per group;
* running sums and previous-row lookups work in chunks, with one carry row per chunk;
* first-k and last-n use ``row_number() <= k``, which Spark limits before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", hint: str | None = None) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the key columns appear once.

    ``hint`` names a join strategy. Tables read back from files need ``merge`` when they grow with the input: Spark
    goes by the size of the compressed files, and a table that just fits its limit fills the driver when it is sent out.
    """
    marked = right
    for k in keys:
        marked = marked.withColumnRenamed(k, f"_r_{k}")
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(marked.hint(hint) if hint else marked, cond, how).drop(*[f"_r_{k}" for k in keys])


def rows_where(condition: Column, weight: str | None = None) -> Column:
    """Number of rows that meet the condition; a row stands for ``weight`` rows."""
    return F.sum(F.when(condition, F.col(weight)).otherwise(0)) if weight else F.count_if(condition)


NULL_KEY = "\0"


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """(``_k0``.. key texts, ``_v``, ``_n``): equal values counted once, NULL included; a row stands for ``weight`` rows.

    The shuffle is on (keys, value) after a map-side combine, so a hot key spreads over all tasks. Keys
    travel as non-NULL text, which makes later joins on them plain equi-joins.
    """
    cols = [F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)).alias(f"_k{i}") for i, k in enumerate(keys)]
    cols = cols or [F.lit("").alias("_k0")]
    g = [f"_k{i}" for i in range(len(cols))]
    rows = df.select(*cols, F.col(value).cast("double").alias("_v"), *([F.col(weight).alias("_w")] if weight else []))
    return rows.groupBy(*g, "_v").agg((F.sum("_w") if weight else F.count(F.lit(1))).alias("_n"))


def stats_of_counts(
    counts: DataFrame, probs: dict[str, float], splits: int = 64, nearest: bool = False
) -> DataFrame:
    """n_rows, n_values, min_value, max_value and exact quantiles from :func:`value_counts`, keyed by
    the key texts. Quantiles interpolate between ranks, or with ``nearest`` take the value at rank
    ``floor(n * p)`` (the last one when that is past the end); a group without values has NULLs.

    1. draw ``splits`` distinct values per group by hash order as cut points: the draw depends on
       the data only, so a recomputed stage sees the same cuts;
    2. a histogram over the cuts gives the totals and tells which bucket holds each wanted rank;
    3. only those buckets are ordered, each in a task of its own.

    The filter on the cut values needs the count, so it cannot sink below the shuffle of the counts
    and turn it into a different one that Spark could not reuse.
    """
    g = [c for c in counts.columns if c.startswith("_k")]
    valued = counts.where(F.when(F.col("_n") > 0, F.col("_v")).isNotNull())
    drawn = Window.partitionBy(*g).orderBy(F.xxhash64("_v"), F.col("_v"))
    cuts = (
        valued.withColumn("_r", F.row_number().over(drawn))
        .where(F.col("_r") <= splits)
        .groupBy(*g)
        .agg(F.array_sort(F.collect_list("_v")).alias("_cuts"))
    )
    bucket = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    tagged = (
        counts.join(cuts, g, "left")
        .withColumn("_b", F.when(F.col("_v").isNull(), -1).otherwise(bucket))
        .drop("_cuts")
    )
    whole = Window.partitionBy(*g)
    real = F.when(F.col("_b") >= 0, F.col("_bn")).otherwise(0)
    hist = (
        tagged.groupBy(*g, "_b")
        .agg(F.sum("_n").alias("_bn"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
        .withColumns(
            {
                "_end": F.sum(real).over(whole.orderBy("_b")),
                "_tot": F.sum(real).over(whole),
                "_rows": F.sum("_bn").over(whole),
                "_mn": F.min("_mn").over(whole),
                "_mx": F.max("_mx").over(whole),
            }
        )
        .withColumn("_start", F.col("_end") - real)
    )

    def rank_of(p):
        if nearest:
            return F.least(F.floor(F.col("_tot") * F.lit(float(p))), F.col("_tot") - 1).cast("double")
        return (F.col("_tot") - 1) * F.lit(float(p))

    item = lambda i, side, pos: F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), pos.cast("bigint").alias("pos"))
    ranks = []
    for i, p in enumerate(probs.values()):
        ranks += [item(i, 0, F.floor(rank_of(p))), item(i, 1, F.ceil(rank_of(p)))]
    here = F.filter(F.array(*ranks), lambda w: (w["pos"] >= F.col("_start")) & (w["pos"] < F.col("_end")))
    # A group without values keeps its one NULL row so that it still gets an output row.
    wanted = (
        hist.withColumn("_want", F.when(F.col("_tot") == 0, F.array(item(-1, 0, F.lit(-1)))).otherwise(here))
        .where(F.size("_want") > 0)
        .select(*g, "_b", "_start", "_tot", "_rows", "_mn", "_mx", "_want")
    )
    in_bucket = Window.partitionBy(*g, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    covers = lambda w: (w["i"] < 0) | ((w["pos"] >= F.col("_run") - F.col("_n")) & (w["pos"] < F.col("_run")))
    hits = (
        tagged.join(wanted, [*g, "_b"])
        .withColumn("_run", F.col("_start") + F.sum("_n").over(in_bucket))
        .withColumn("_hit", F.explode(F.filter("_want", covers)))
    )
    aggs = [F.max(c).alias(c) for c in ("_tot", "_rows", "_mn", "_mx")]
    for i, _ in enumerate(probs):
        for side in (0, 1):
            mine = (F.col("_hit.i") == i) & (F.col("_hit.side") == side)
            aggs.append(F.max(F.when(mine, F.col("_v"))).alias(f"_q{i}_{side}"))
    out = hits.groupBy(*g).agg(*aggs)
    cols = []
    for i, (name, p) in enumerate(probs.items()):
        h = rank_of(p)
        lo, hi = F.col(f"_q{i}_0"), F.col(f"_q{i}_1")
        cols.append((lo + (hi - lo) * (h - F.floor(h))).alias(name))
    return out.select(
        *g, F.col("_rows").alias("n_rows"), F.col("_tot").alias("n_values"), F.col("_mn").alias("min_value"),
        F.col("_mx").alias("max_value"), *cols,
    )


def order_stats(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], splits: int = 64, nearest: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """n_rows, n_values, min_value, max_value and exact quantiles per group, from one value count."""
    out = stats_of_counts(value_counts(df, keys, value, weight), probs, splits, nearest)
    types = {k: df.select(k).schema[0].dataType for k in keys}
    return out.select(
        *[F.when(F.col(f"_k{i}") != NULL_KEY, F.col(f"_k{i}")).cast(types[k]).alias(k) for i, k in enumerate(keys)], "n_rows", "n_values", "min_value", "max_value", *probs
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], splits: int = 64, nearest: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Exact quantiles of the groups that have values, one output column per entry of ``probs``."""
    out = order_stats(df, keys, value, probs, splits, nearest, weight).where(F.col("n_values") > 0)
    return out.select(*keys, *probs)


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence, k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group in ``order``, with their 1-based rank."""
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.partitionBy(F.lit(1)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_candidates(df: DataFrame, keys: Sequence[str], lead: Column, k: int) -> DataFrame:
    """The rows that can be among the first ``k`` of their group in an order that starts with ``lead`` (ascending): a few
    more than ``k``, where ordering all rows of a group to find its head would sort and spill the whole input.

    Rows are dealt into parts by the hash of ``lead`` and each part gives its least one. When ``k`` parts have one
    of at most ``b``, so have ``k`` rows, and what is past ``b`` cannot be among the first. A group with fewer parts keeps all
    its rows. Groups are few (sources and columns): their bounds, a row each, go into the plan.
    """
    groups = [F.col(c).alias(f"_g{i}") for i, c in enumerate(keys)]
    g = [f"_g{i}" for i in range(len(groups))]
    part = F.pmod(F.xxhash64("_lead"), F.lit(8 * k)).alias("_part")
    least = df.select(*groups, lead.alias("_lead")).groupBy(*g, part).agg(F.min("_lead").alias("_lead"))
    heads = first_k(least, g, [F.asc("_lead")], k, "_r").groupBy(*g).agg(F.max(F.when(F.col("_r") == k, F.col("_lead"))).alias("_b")).collect()
    bounds = [r["_b"] for r in heads]
    if not bounds or all(b is None for b in bounds):
        return df
    bound = F.lit(None)
    for r in heads:
        if r["_b"] is not None:
            here = F.lit(True)
            for c, name in zip(keys, g):
                here = here & F.col(c).eqNullSafe(F.lit(r[name]))
            bound = F.when(here, F.lit(r["_b"])).otherwise(bound)
    if all(b is not None for b in bounds):  # a bound of all groups can reach the files
        df = df.where(lead.isNull() | (lead <= F.lit(max(bounds))))
    return df.where(F.coalesce(lead <= bound, F.lit(True)))


def sample_text(
    df: DataFrame, keys: Sequence[str], order: Sequence, k: int, text: str, out: str, sep: str = ","
) -> DataFrame:
    """The first ``k`` values of ``text`` per group, joined; at most ``k`` values are ever collected."""
    picked = first_k(df, keys, order, k, "_rk")
    pairs = F.array_sort(F.collect_list(F.struct("_rk", F.col(text).cast("string").alias("t"))))
    return picked.groupBy(*keys).agg(F.array_join(F.transform(pairs, lambda s: s["t"]), sep).alias(out))


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, chunk: Column, out: str
) -> DataFrame:
    """Running total of ``value`` per group in ``order``.

    ``chunk`` must never decrease along ``order`` (a day, a block of ordinals). Each chunk is summed
    on its own and receives the total of the chunks before it, so no task orders a whole group.
    """
    cut = df.withColumn("_chunk", chunk)
    sums = cut.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_cs"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*keys, "_chunk", F.coalesce(F.sum("_cs").over(before), F.lit(0)).alias("_carry"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        join_keys(cut, carry, [*keys, "_chunk"])
        .withColumn(out, F.col("_carry") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_chunk", "_carry")
    )


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    chunk: Column,
    forward: bool,
    prefix: str,
) -> DataFrame:
    """Values of the previous (or next) row per group, chunk by chunk as in :func:`running_sum`."""
    cut = df.withColumn("_chunk", chunk)
    ordered = F.struct(*order)
    packed = F.struct(*cols)
    edge_agg = F.min_by(packed, ordered) if forward else F.max_by(packed, ordered)
    edges = cut.groupBy(*keys, "_chunk").agg(edge_agg.alias("_edge"))
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk")
    shift = F.lead("_edge") if forward else F.lag("_edge")
    carry = edges.select(*keys, "_chunk", shift.over(over_chunks).alias("_carry"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    step = F.lead(packed) if forward else F.lag(packed)
    joined = (
        join_keys(cut, carry, [*keys, "_chunk"])
        .withColumn("_near", F.coalesce(step.over(inside), F.col("_carry")))
    )
    return joined.select(
        *[c for c in df.columns], *[F.col("_near")[c].alias(prefix + c) for c in cols]
    )
