"""Column expressions that score, gate or classify one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeline.functions import numbers as N

# Score threshold and weights, dominant regions, size-token table, material table.
SCORE_OK = 70.0
REGION_BY_KEY = {"BUST_CIRC_M": "TORSO_UPPER", "WAIST_CIRC_M": "TORSO_MID", "HIP_CIRC_M": "TORSO_LOWER"}
BAND_CM = (65, 90)
CUP_DELTA_CM = {"A": 10.0, "B": 12.5, "C": 15.0, "D": 17.5, "E": 20.0, "F": 22.5}
MATERIALS = {
    "cotton": ("low", 0.0012),
    "denim": ("low", 0.0028),
    "wool": ("medium", 0.0024),
    "polyester": ("medium", 0.0016),
    "spandex": ("high", 0.0010),
}
DEFAULT_STRETCH = "balanced"
DEFAULT_THICKNESS_M = 0.002
GATE_FLAGS = ("negative_face_area_flag", "self_intersection_flag", "invalid_face_flag")
VALID_PREFIXES = ("normal_", "varied_")


def residual_score(residuals_m: dict[str, Column], weights: dict[str, float] | None = None) -> Column:
    """100 minus the weighted absolute residuals in cm, kept in 0..100; a NULL residual costs nothing."""
    penalty = F.lit(0.0)
    for k, r in residuals_m.items():
        penalty = penalty + F.coalesce(F.abs(r) * 100.0 * (weights or {}).get(k, 1.0), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 - penalty))


def score_bucket(score: Column, threshold: float = SCORE_OK) -> Column:
    return F.when(score >= threshold, "OK").otherwise("LOW")


def ranked_keys(residuals_m: dict[str, Column]) -> Column:
    """Keys from the largest to the smallest absolute residual; equal ones keep their given order."""
    items = F.array(
        *[
            F.struct((-F.abs(F.coalesce(r, F.lit(0.0)))).alias("a"), F.lit(i).alias("i"), F.lit(k).alias("k"))
            for i, (k, r) in enumerate(residuals_m.items())
        ]
    )
    return F.transform(F.array_sort(items), lambda s: s["k"])


def dominant_region(ranked: Column) -> Column:
    first = F.element_at(ranked, 1)
    out = None
    for k, region in REGION_BY_KEY.items():
        out = F.when(first == k, region) if out is None else out.when(first == k, region)
    return out.otherwise("TORSO_MID")


def sign_pattern(residuals: Sequence[Column]) -> Column:
    """``+,+,-`` style text; zero and NULL count as ``+``."""
    return F.concat_ws(",", *[F.when(F.coalesce(r, F.lit(0.0)) < 0, "-").otherwise("+") for r in residuals])


def size_token(c: Column) -> Column:
    """``75A`` to (band_cm, cup, underbust_m, bust_m, code). Codes: FORMAT_VIOLATION, RANGE_VIOLATION."""
    token = F.upper(c)
    pattern = r"^(\d+)([A-F])$"
    fits = F.coalesce(token.rlike(pattern), F.lit(False))
    band = F.when(fits, F.regexp_extract(token, pattern, 1).try_cast("int"))
    ranged = F.coalesce(band.between(*BAND_CM), F.lit(False))
    cup = F.when(ranged, F.regexp_extract(token, pattern, 2))
    delta = F.lit(None).cast("double")
    for letter, cm in CUP_DELTA_CM.items():
        delta = F.when(cup == letter, F.lit(cm)).otherwise(delta)
    under = F.when(ranged, band / 100.0)
    return F.struct(
        F.when(ranged, band).alias("band_cm"),
        cup.alias("cup"),
        under.alias("underbust_m"),
        (under + delta / 100.0).alias("bust_m"),
        F.when(~fits, "FORMAT_VIOLATION").when(~ranged, "RANGE_VIOLATION").alias("code"),
    )


def ease_ratio(garment: Column, body: Column) -> tuple[Column, Column]:
    """garment / body and the reason when there is none (the denominator is looked at first)."""
    reason = F.when(body.isNull() | (body == 0), "zero_division").when(garment.isNull(), "missing_key")
    return N.ratio(garment, body), reason


def material_profile(token: Column, thickness: Column, stretch: Column) -> Column:
    """Stretch class and thickness: existing values, else the material table, else the default."""
    name = F.lower(F.trim(F.coalesce(token, F.lit(""))))
    existing = F.coalesce((thickness > 0) & stretch.isNotNull(), F.lit(False))
    t_thick, t_stretch = F.lit(None).cast("double"), F.lit(None).cast("string")
    for k, (s, t) in MATERIALS.items():
        t_thick = F.when(name == k, F.lit(t)).otherwise(t_thick)
        t_stretch = F.when(name == k, F.lit(s)).otherwise(t_stretch)
    known = name.isin(*MATERIALS)
    given = F.coalesce(F.nullif(F.trim(stretch), F.lit("")), F.lit(DEFAULT_STRETCH))
    return F.struct(
        F.when(name == "", "UNSPECIFIED").otherwise(name).alias("material_token"),
        F.when(existing, given).otherwise(F.coalesce(t_stretch, F.lit(DEFAULT_STRETCH))).alias("stretch_class"),
        F.when(existing, thickness).otherwise(F.coalesce(t_thick, F.lit(DEFAULT_THICKNESS_M))).alias("thickness_m"),
        F.when(existing | known, "").when(name == "", "material_token_missing")
        .otherwise(F.concat(F.lit("material_token_unknown:"), name)).alias("default_reason"),
        F.when(existing, "proxy_meta_existing").when(known, "material_token_policy").otherwise("default_policy").alias("source"),
    )


def gate_flags(top: dict[str, Column], nested: dict[str, Column]) -> dict[str, Column]:
    """Each flag: the top-level boolean, else the nested one, else false."""
    return {f: F.coalesce(top[f], nested[f], F.lit(False)) for f in GATE_FLAGS}


def early_exit(hard_gate: Column, hard_reason: Column, early: Column, early_reason: Column, status: Column, reason: Column) -> Column:
    """(early_exit, reason): hard gate first, then the early-exit mark, then the status text."""
    lead = "garment_hard_gate_violation: "
    none = lambda c: F.nullif(c, F.lit(""))
    yes = lambda c: F.coalesce(c, F.lit(False))
    by_status = yes(F.upper(status) == "HARD_GATE")
    why = (
        F.when(yes(hard_gate), F.coalesce(none(hard_reason), F.lit(lead + "signal")))
        .when(yes(early), F.coalesce(none(early_reason), F.lit(lead + "early_exit")))
        .when(by_status, F.coalesce(none(reason), F.lit(lead + "status=HARD_GATE")))
    )
    return F.struct((yes(hard_gate) | yes(early) | by_status).alias("early_exit"), why.alias("reason"))


def foreign_score(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(score, F.lit(0.0))))


def case_class(given: Column, case_id: Column) -> Column:
    """Given class, else by id prefix: two prefixes are valid cases, the rest should fail."""
    valid = F.lit(False)
    for p in VALID_PREFIXES:
        valid = valid | case_id.startswith(p)
    return F.coalesce(given, F.when(valid, "valid").otherwise("expected_fail"))


def representative(facts_json: Column, key: str) -> Column:
    """Median of ``key`` in a facts document: key spaces in order, then the stat names in order.

    The first space that holds the key decides, even when it has no usable value.
    """
    spaces = ("summary", "", "value_stats_by_key", "stats_by_key", "per_key", "by_key")
    stats = ("value_stats.median", "value_stats.p50", "median", "p50")
    out = F.lit(None).cast("double")
    for space in reversed(spaces):
        base = "$." + (space + "." if space else "") + key
        entry = F.get_json_object(facts_json, base)
        value = F.coalesce(*[F.get_json_object(facts_json, f"{base}.{s}").try_cast("double") for s in stats])
        out = F.when(entry.isNotNull(), value).otherwise(out)
    return out
