"""Runs against runs: KPI rows, differences, regressions, previous run, registry conflicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions import numbers as N
from tapeline.operators.scale import exact_quantiles, first_k, join_keys, order_stats

# Tolerance of "same", regression limits.
SAME_RATE = 0.01
MAX_ABS_DELTA = 0.3
MAX_PCT = 5.0
MAX_FAIL_RATE = 0.05


def kpi(facts: DataFrame, run: Sequence[str] = ("run_id",), k: int = 5) -> DataFrame:
    """The ``k`` keys with the highest missing rate of each run."""
    return first_k(facts, list(run), [F.desc("nan_rate"), F.asc("standard_key")], k, "rank")


def value_kpi(results: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """p50, the real p95 and the maximum per run and key."""
    return order_stats(results, list(keys), value, {"p50": 0.5, "p95": 0.95})


def nearest_rank(results: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    return exact_quantiles(results, list(keys), value, probs, nearest=True)


def diff_rates(current: DataFrame, reference: DataFrame, keys: Sequence[str], rate: str = "nan_rate") -> DataFrame:
    """Every key of both runs: delta and whether it is same, increased, decreased, new or dropped."""
    a = current.select(*keys, F.col(rate).alias("current"), F.lit(True).alias("_in_a"))
    b = reference.select(*keys, F.col(rate).alias("reference"), F.lit(True).alias("_in_b"))
    d = F.col("current") - F.col("reference")
    status = (
        F.when(F.col("_in_b").isNull(), "new")
        .when(F.col("_in_a").isNull(), "dropped")
        .when(F.abs(d) < SAME_RATE, "same")
        .when(d > 0, "increased")
        .otherwise("decreased")
    )
    return a.join(b, list(keys), "full_outer").select(*keys, "current", "reference", d.alias("delta"), status.alias("status"))


def degraded_keys(current: DataFrame, baseline: DataFrame, by: Sequence[str], k: int = 3, rate: str = "nan_rate") -> DataFrame:
    """Keys whose missing rate rose against the baseline (absent there counts as zero), worst first."""
    base = baseline.select(*by, "standard_key", F.col(rate).alias("_base"))
    d = current.join(base, [*by, "standard_key"], "left").withColumn(
        "rise", F.col(rate) - F.coalesce("_base", F.lit(0.0))
    )
    worse = d.where(F.col("rise") > 0).select(*by, "standard_key", "rise")
    return first_k(worse, list(by), [F.desc("rise"), F.asc("standard_key")], k, "rank")


def degradation_signals(rises: DataFrame, current: DataFrame, baseline: DataFrame, by: Sequence[str], height: str = "HEIGHT_M",
                        key: str = "standard_key", value: str = "value") -> DataFrame:
    """One row per run that has a baseline: whether any key's missing rate rose, the keys that rose most (from
    :func:`degraded_keys`), and the shift of the median height in metres, NULL where one side has none."""
    by = list(by)
    top = F.transform(F.array_sort(F.collect_list(F.struct("rank", key))), lambda x: x[key])
    worst = rises.groupBy(*by).agg(F.array_join(top, ",").alias("degraded_keys"))
    median = lambda df, name: exact_quantiles(df.where(F.col(key) == height), by, value, {name: 0.5})
    both = join_keys(current.select(*by).distinct(), baseline.select(*by).distinct(), by)
    out = join_keys(join_keys(join_keys(both, worst, by, "left"), median(current, "_now"), by, "left"), median(baseline, "_then"), by, "left")
    return out.select(
        *by, F.col("degraded_keys").isNotNull().alias("degradation_flag"), F.coalesce("degraded_keys", F.lit("")).alias("degraded_keys"),
        (F.col("_now") - F.col("_then")).alias("height_p50_shift"),
    )


def compare_methods(results: DataFrame, by: Sequence[str], value: str = "residual_cm") -> DataFrame:
    """Per method or config: p50, p90, largest absolute value, missing count."""
    s = order_stats(results, list(by), value, {"p50": 0.5, "p90": 0.9})
    return s.select(
        *by, "n_rows", "n_values", "p50", "p90",
        F.greatest(F.abs("min_value"), F.abs("max_value")).alias("max_abs"),
    )


def method_delta(long: DataFrame, method: str, first: str, second: str, by: Sequence[str], changed: str, warnings: str,
                 key: str = "key", value: str = "residual_cm") -> DataFrame:
    """Two methods side by side per group: p90 of the key the methods change and its differences, missing values and warnings
    of each, and whether the other keys stayed as they were.

    ``long`` has a row per case, method and key; ``warnings`` counts the warnings of a row.
    """
    by, near = list(by), 1e-6
    stats = order_stats(long, [*by, method, key], value, {"p90": 0.9})
    noted = long.where(F.col(key) == changed).groupBy(*by, method).agg(F.sum(warnings).alias("_w"))
    side = lambda m, c: F.max(F.when((F.col(method) == m) & (F.col(key) == changed), c))
    others = stats.where(F.col(key) != changed).groupBy(*by, key).agg(
        *[F.coalesce(F.max(F.when(F.col(method) == m, F.col("p90"))), F.lit(0.0)).alias(n) for m, n in ((first, "_a"), (second, "_b"))]
    )
    close = F.abs(F.col("_a") - F.col("_b")) <= F.greatest(F.lit(near), near * F.greatest(F.abs("_a"), F.abs("_b")))
    same = others.groupBy(*by).agg(F.bool_and(close).alias("others_unchanged"))
    out = stats.groupBy(*by).agg(
        *[side(m, F.col("p90")).alias(f"p90_{n}") for m, n in ((first, "a"), (second, "b"))],
        *[side(m, F.col("n_rows") - F.col("n_values")).alias(f"null_{n}") for m, n in ((first, "a"), (second, "b"))],
    )
    warned = noted.groupBy(*by).agg(*[F.max(F.when(F.col(method) == m, F.col("_w"))).alias(f"warnings_{n}") for m, n in ((first, "a"), (second, "b"))])
    return join_keys(join_keys(out, warned, by), same, by, "left").withColumns(
        {"delta_p90": F.col("p90_b") - F.col("p90_a"), "delta_abs_p90": F.abs("p90_b") - F.abs("p90_a")}
    )


def best_config(stats: DataFrame, config: str, by: Sequence[str] = ()) -> DataFrame:
    """The config with the smallest absolute p90; ties by name."""
    return stats.groupBy(*by).agg(
        F.min_by(F.struct(config, "p90"), F.struct(F.round(F.abs("p90"), 9), F.col(config))).alias("b")
    ).select(*by, f"b.{config}", "b.p90")


def regression_codes(delta: Column, pct: Column, fail_rate: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(F.abs(delta) > MAX_ABS_DELTA, "ABS_DELTA"),
            F.when(F.abs(pct) > MAX_PCT, "PCT_DELTA"),
            F.when(fail_rate > MAX_FAIL_RATE, "FAIL_RATE"),
        )
    )


def previous_runs(runs: DataFrame, lane: str = "lane", number: str = "round_num", run: str = "run_id",
                  block: int = 100_000) -> DataFrame:
    """Previous run of each lane: the largest round number below the current one, else the baseline.

    Runs are grouped into number blocks, so a lane with very many runs is not ordered in one task.
    """
    blocks = runs.withColumn("_block", F.floor(F.col(number) / block))
    per_round = blocks.groupBy(lane, "_block", number).agg(F.max(run).alias("_run"))
    edges = per_round.groupBy(lane, "_block").agg(F.max_by("_run", number).alias("_edge"))
    over = Window.partitionBy(lane).orderBy("_block")
    carry = edges.select(lane, "_block", F.lag("_edge").over(over).alias("_carry"))
    inside = Window.partitionBy(lane, "_block").orderBy(number)
    prev = join_keys(per_round, carry, [lane, "_block"]).select(
        lane, number, F.coalesce(F.lag("_run").over(inside), F.col("_carry")).alias("prev_run")
    )
    return runs.join(prev, [lane, number])


def with_baseline(runs: DataFrame, baselines: DataFrame, lane: str = "lane") -> DataFrame:
    """Fall back to the lane's baseline run where there is no previous one."""
    return runs.join(baselines.select(lane, F.col("run_id").alias("_base")), lane, "left").withColumn(
        "prev_run", F.coalesce("prev_run", "_base")
    ).drop("_base")


def registry_conflicts(proposed: DataFrame, registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Proposed entries that repeat a registered value of any of ``keys``: hits and first position.

    The registry is counted per value before the join, so a value that fills a third of it still
    meets each proposal once.
    """
    out = None
    for k in keys:
        known = registry.groupBy(k).agg(F.count(F.lit(1)).alias("n_hits"), F.min("position").alias("first_position"))
        one = proposed.select("entry_id", k).join(known, k).select(
            "entry_id", F.lit(f"duplicate_{k}").alias("conflict"), "n_hits", "first_position"
        )
        out = one if out is None else out.unionByName(one)
    return out


def conflict_positions(proposed: DataFrame, registry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every registered position that repeats a value of a proposed entry: (entry_id, conflict, position).

    Proposals are few and the registry is long; each proposal is known by its value once, so positions are only listed
    where they are asked for, a row each.
    """
    out = None
    for k in keys:
        one = registry.select("position", k).join(proposed.select("entry_id", k), k).select("entry_id", F.lit(f"duplicate_{k}").alias("conflict"), "position")
        out = one if out is None else out.unionByName(one)
    return out


def hash_diff(first: DataFrame, second: DataFrame, key: str, digest: str) -> DataFrame:
    """Determinism check: rows missing on either side or with another digest."""
    a = first.select(key, F.col(digest).alias("_a"))
    b = second.select(key, F.col(digest).alias("_b"))
    kind = F.when(F.col("_a").isNull(), "missing_in_first").when(F.col("_b").isNull(), "missing_in_second").when(
        F.col("_a") != F.col("_b"), "mismatch"
    )
    return a.join(b, key, "full_outer").select(key, kind.alias("kind")).where(F.col("kind").isNotNull())


def fit_summary(results: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Residual p50 / p90 / p95 / max per key, from one unpivoted pass."""
    long = results.unpivot(list(by), list(keys), "key", "residual_cm")
    return order_stats(long, [*by, "key"], "residual_cm", {"p50": 0.5, "p90": 0.9, "p95": 0.95})


def score_summary(results: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    s = order_stats(results, list(by), "score", {"p50": 0.5, "p90": 0.9})
    above = results.groupBy(*by).agg(
        F.count_if(F.col("score") >= threshold).alias("n_ok"), F.count_if(F.col("score") < threshold).alias("n_low"),
        F.avg((F.col("score") >= threshold).cast("double")).alias("fraction_above"),
    )
    joined = join_keys(s, above, list(by)) if by else s.crossJoin(F.broadcast(above))
    return joined.drop("n_rows")


def gate(summary: DataFrame, keys: Sequence[str], score: float, residual: float, max_failures: int,
         fraction: float | None = None) -> DataFrame:
    """Verdict over summary rows (``p90_<key>``, ``score_p90``, ``failures``, ``fraction_above``).

    Every rule that has its metric must hold; a missing metric does not fail and is listed.
    """
    ok = lambda c: F.coalesce(c, F.lit(True))
    rules = {"failures": F.col("failures") <= max_failures, "score_p90": F.col("score_p90") >= score}
    for k in keys:
        rules[f"residual_{k}"] = F.abs(F.col(f"p90_{k}")) <= residual
    if fraction is not None:
        rules["fraction"] = F.col("fraction_above") >= fraction
    verdict = F.lit(True)
    failed, absent = [], []
    for n, c in rules.items():
        verdict = verdict & ok(c)
        failed.append(F.when(~ok(c), F.lit(n)))
        absent.append(F.when(c.isNull(), F.lit(n)))
    return summary.select(
        "*", verdict.alias("candidate"),
        F.array_join(F.array_compact(F.array(*failed)), ",").alias("failed_rules"),
        F.array_join(F.array_compact(F.array(*absent)), ",").alias("missing_metrics"),
    )


def threshold_grid(summary: DataFrame, keys: Sequence[str], residuals: Sequence[float], scores: Sequence[float],
                   max_failures: int) -> DataFrame:
    """Each summary row against every pair of candidate thresholds (two short constant lists)."""
    r = F.explode(F.array(*[F.lit(float(x)) for x in residuals])).alias("residual_thr")
    s = F.explode(F.array(*[F.lit(float(x)) for x in scores])).alias("score_thr")
    grid = summary.select("*", r).select("*", s)
    least = F.coalesce(F.col("score_min") >= F.col("score_thr"), F.lit(False)) if "score_min" in summary.columns else F.lit(None).cast("boolean")
    keys_ok = F.lit(True)
    for k in keys:
        keys_ok = keys_ok & F.coalesce(F.abs(F.col(f"p90_{k}")) <= F.col("residual_thr"), F.lit(False))
    quality = F.coalesce(F.col("score_p90") >= F.col("score_thr"), F.lit(False))
    return grid.withColumns({"keys_ok": keys_ok, "quality_ok": quality, "least_ok": least}).withColumn(
        "would_pass", F.col("keys_ok") & F.col("quality_ok") & (F.col("failures") <= max_failures)
    )


def implied_rates(summary: DataFrame, scores: Sequence[int], at_score: int) -> DataFrame:
    """The share of fits above the threshold of the summary, as the rate the candidate scores imply: exact at that
    threshold only, and a note where it is none of the candidates or the share is missing."""
    share = F.round(N.finite(F.col("fraction_above")), 4)
    note = F.when(share.isNull(), "FRACTION_NOT_AVAILABLE").when(F.lit(at_score not in scores), "fraction_from_summary_single_threshold_only").otherwise("")
    return summary.withColumns(
        {"implied_ok_fraction": share, "at_threshold_score": F.when(share.isNotNull(), F.lit(at_score)), "note": note}
    )


def prediction_gap(predicted: DataFrame, residuals: DataFrame, key: str, value: str, residual: str) -> DataFrame:
    """Target recovered as prediction minus residual, per prototype."""
    return predicted.select(key, F.col(value).alias("predicted")).join(
        residuals.select(key, F.col(residual).alias("residual")), key
    ).withColumn("target", F.col("predicted") - F.col("residual"))


