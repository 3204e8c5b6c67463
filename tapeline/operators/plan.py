"""Plan state: reached levels, ready and blocked steps, plan lint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Levels in order, valid modules and phases.
LEVELS = ("M0", "M1", "M2")
MODULES = ("body", "garment", "fitting", "common")
PHASES = ("P0", "P1", "P2", "P3")


def level_rank(level: Column) -> Column:
    """0, 1, 2; anything else counts as the lowest."""
    return F.when(level == LEVELS[2], 2).when(level == LEVELS[1], 1).otherwise(0)


def reached_levels(events: DataFrame) -> DataFrame:
    """Highest level per step over events with status OK."""
    return (
        events.where((F.col("status") == "OK") & F.col("step_id").isNotNull())
        .groupBy("step_id")
        .agg(F.max(level_rank(F.col("m_level"))).alias("reached"))
    )


def unmet_requirements(steps: DataFrame, edges: DataFrame, reached: DataFrame) -> DataFrame:
    """(step_id, from_step) of every requirement that a step lacks, whatever the step's own state.

    ``edges`` (step_id, from_step, min_level): the strongest of a repeated requirement holds. A
    dependency counts when it is itself done and reached the asked level.
    """
    have = _with_done(steps, reached)
    need = edges.groupBy("step_id", "from_step").agg(F.max(level_rank(F.col("min_level"))).alias("need"))
    met = need.join(have.select(F.col("step_id").alias("from_step"), "done", "reached"), "from_step", "left")
    unmet = ~(F.coalesce("done", F.lit(False)) & F.coalesce(F.col("reached") >= F.col("need"), F.lit(False)))
    return met.where(unmet).select("step_id", "from_step")


def _with_done(steps: DataFrame, reached: DataFrame) -> DataFrame:
    return steps.join(reached, "step_id", "left").withColumn(
        "done", F.coalesce(F.col("reached") >= level_rank(F.col("m_level")), F.lit(False))
    )


def plan_state(steps: DataFrame, edges: DataFrame, reached: DataFrame) -> DataFrame:
    """Each step as done, ready or blocked, with how many of its :func:`unmet_requirements` it lacks."""
    lack = unmet_requirements(steps, edges, reached).groupBy("step_id").agg(F.count("*").alias("n_unmet"))
    out = _with_done(steps, reached).join(lack, "step_id", "left")
    state = F.when(F.col("done"), "done").when(F.col("n_unmet") > 0, "blocked").otherwise("ready")
    return out.select(
        "step_id", "module", "phase", state.alias("state"),
        F.when(F.col("done"), 0).otherwise(F.coalesce("n_unmet", F.lit(0))).cast("bigint").alias("n_unmet"),
    )


def next_steps(state: DataFrame, kind: str, n: int) -> DataFrame:
    return state.where(F.col("state") == kind).orderBy("phase", "step_id").limit(n)


def lint(steps: DataFrame, edges: DataFrame) -> DataFrame:
    """Findings: duplicate ids, unknown module / phase / level, unknown or self dependencies."""
    bad = lambda df, code, detail: df.select("step_id", F.lit(code).alias("code"), detail.cast("string").alias("detail"))
    dup = steps.groupBy("step_id").agg(F.count("*").alias("n")).where("n > 1")
    ids = steps.select(F.col("step_id").alias("from_step")).distinct()
    parts = [
        bad(dup, "duplicate_step", F.col("n")),
        bad(steps.where(~F.col("module").isin(*MODULES)), "bad_module", F.col("module")),
        bad(steps.where(~F.col("phase").isin(*PHASES)), "bad_phase", F.col("phase")),
        bad(steps.where(~F.col("m_level").isin(*LEVELS)), "bad_level", F.col("m_level")),
        bad(edges.join(ids, "from_step", "left_anti"), "unknown_dependency", F.col("from_step")),
        bad(edges.where(F.col("step_id") == F.col("from_step")), "self_dependency", F.col("from_step")),
        bad(edges.where(~F.col("min_level").isin(*LEVELS)), "bad_min_level", F.col("min_level")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
