"""Measures over the long vertex table (case_id, vertex_id, x, y, z): metres, y up.

A mesh is never gathered in one place: boxes, bands and planes are aggregates, joined back by case.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeline.functions import numbers as N
from tapeline.operators.scale import exact_quantiles, first_k, join_keys

# Landmark ratios, band heights, limits.
CROTCH_RATIO = 0.45
KNEE_RATIO = 0.25
HEIGHT_LIMITS = (0.1, 3.0)
LEVEL_RATIO = {"CHEST": 0.35, "WAIST": 0.50, "HIP": 0.60}
HALF_BAND = 0.02
MIN_HALF_BAND = 0.005
MIN_BAND_POINTS = 3
WIDTH_LIMITS = (0.05, 1.0)
MAX_SHIFT_M = 0.010
PLANE_STEP_M = 0.001
SHIFTED_LEVELS = ("WAIST", "HIP")  # levels that may move to the nearest plane
MM_LIMIT = 10.0
ARM_FACTOR = 1.05
TOLERANCE_SHARE = 0.002
TOLERANCE_LIMITS = (1e-5, 0.01)
PELVIS_BAND = (0.45, 0.55)
EPS_AREA = 1e-12
PROXY_WEIGHTS = (0.7, 0.3)


def repair_scale(verts: DataFrame) -> DataFrame:
    """Meshes whose largest coordinate exceeds 10 are in millimetres: divide and say so."""
    top = verts.groupBy("case_id").agg(
        F.max(F.greatest(F.abs("x"), F.abs("y"), F.abs("z"))).alias("max_abs")
    )
    d = F.when(F.col("max_abs") > MM_LIMIT, F.lit(1000.0)).otherwise(F.lit(1.0))
    return verts.join(top, "case_id").select(
        "case_id", "vertex_id", *[(F.col(c) / d).alias(c) for c in "xyz"],
        (F.col("max_abs") > MM_LIMIT).alias("scaled"), "max_abs",
    )


def scale_warnings(repaired: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest scale repairs, with the total number of them."""
    cases = repaired.where("scaled").groupBy("case_id").agg(F.max("max_abs").alias("max_abs"))
    total = cases.agg(F.count(F.lit(1)).alias("n_total"))
    return cases.orderBy(F.desc("max_abs"), "case_id").limit(k).crossJoin(F.broadcast(total))


def bounding_boxes(verts: DataFrame) -> DataFrame:
    """Box, spans, body height, longest axis and the height-ratio landmarks per case."""
    box = verts.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("n_verts"),
        *[f(c).alias(f"{c}_{n}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))],
        *[F.avg(c).alias(f"{c}_mean") for c in "xyz"],
    )
    sx, sy, sz = (F.col(f"{c}_max") - F.col(f"{c}_min") for c in "xyz")
    box = box.withColumns({"span_x": sx, "span_y": sy, "span_z": sz})
    longest = (
        F.when((F.col("span_x") >= F.col("span_y")) & (F.col("span_x") >= F.col("span_z")), "x")
        .when(F.col("span_y") >= F.col("span_z"), "y")
        .otherwise("z")
    )
    h = F.col("span_y")
    return box.withColumns(
        {
            "height_m": h,
            "longest_axis": longest,
            "crotch_height_m": h * CROTCH_RATIO,
            "knee_height_m": h * KNEE_RATIO,
            "height_code": F.when(h < HEIGHT_LIMITS[0], "HEIGHT_SMALL").when(h > HEIGHT_LIMITS[1], "HEIGHT_LARGE"),
        }
    )


def slice_tolerance(base: Column) -> Column:
    """Half thickness of a slice: at least 0.2 % of the middle positive span, kept in limits."""
    spans = F.array_sort(F.filter(F.array("span_x", "span_y", "span_z"), lambda s: s > 0))
    n = F.size(spans)
    median = (
        F.when(n == 3, F.try_element_at(spans, F.lit(2)))
        .when(n == 2, (F.try_element_at(spans, F.lit(1)) + F.try_element_at(spans, F.lit(2))) / 2)
        .otherwise(F.try_element_at(spans, F.lit(1)))
    )
    wide = F.greatest(median * TOLERANCE_SHARE, base)
    return F.greatest(F.least(wide, F.lit(TOLERANCE_LIMITS[1])), F.lit(TOLERANCE_LIMITS[0]))


def _levels(levels: dict[str, float]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(r).alias("ratio")) for k, r in levels.items()])


def _half_band(key: Column, span_y: Column) -> Column:
    half = span_y * HALF_BAND
    return F.when(key == "CHEST", half).otherwise(F.greatest(half, F.lit(MIN_HALF_BAND)))


def band_widths(verts: DataFrame, boxes: DataFrame, levels: dict[str, float] | None = None, shifted: Sequence[str] = SHIFTED_LEVELS) -> DataFrame:
    """Width (x span) and depth (z span) of the vertices in a thin band at each level.

    Fewer than three points leave the value NULL; every (case, level) has a row. Where the band of one of the ``shifted``
    levels holds no vertex at all, the nearest plane within 10 mm that holds three stands in, with its ``shift_mm`` and
    the code NEAREST_VALID_PLANE_FALLBACK; only those cases are probed.
    """
    levels = levels or LEVEL_RATIO
    frame = boxes.select("case_id", "y_min", "y_max", "span_y", F.explode(_levels(levels)).alias("l")).select(
        "case_id",
        F.col("l.key").alias("key"),
        (F.col("y_min") + F.col("l.ratio") * F.col("span_y")).alias("y_target"),
        _half_band(F.col("l.key"), F.col("span_y")).alias("half"), "y_min", "y_max",
    )
    hit = F.filter(
        _levels(levels),
        lambda l: F.abs(F.col("y") - (F.col("y_min") + l["ratio"] * F.col("span_y")))
        < _half_band(l["key"], F.col("span_y")),
    )
    inside = (
        verts.join(boxes.select("case_id", "y_min", "span_y"), "case_id")
        .select("case_id", "x", "z", F.explode(hit).alias("l"))
        .groupBy("case_id", F.col("l.key").alias("key"))
        .agg(
            F.count(F.lit(1)).alias("n_points"),
            (F.max("x") - F.min("x")).alias("width"),
            (F.max("z") - F.min("z")).alias("depth"),
        )
    )
    band = frame.join(inside, ["case_id", "key"], "left")
    empty = band.where(F.col("n_points").isNull() & F.col("key").isin(*shifted)).select("case_id", "key", "y_target", "half", "y_min", "y_max")
    plane = planes_near(verts, empty).select("case_id", "key", "shift_mm", *[F.col(c).alias(f"_{c}") for c in ("n_points", "width", "depth")])
    enough = F.col("n_points") >= MIN_BAND_POINTS
    out = band.join(plane, ["case_id", "key"], "left").withColumns(
        {c: F.coalesce(c, f"_{c}") for c in ("n_points", "width", "depth")}
    ).select(
        "case_id", "key", "y_target", "half",
        F.coalesce("n_points", F.lit(0)).alias("n_points"),
        F.when(enough, F.col("width")).alias("width_m"),
        F.when(enough, F.col("depth")).alias("depth_m"),
        "shift_mm", F.when(F.col("shift_mm").isNotNull(), "NEAREST_VALID_PLANE_FALLBACK").alias("plane_code"),
    )
    code = lambda c: F.when(c < WIDTH_LIMITS[0], "SMALL").when(c > WIDTH_LIMITS[1], "LARGE")
    return out.withColumns({"width_code": code(F.col("width_m")), "depth_code": code(F.col("depth_m"))})


def nearest_planes(verts: DataFrame, boxes: DataFrame, levels: dict[str, float], half: float) -> DataFrame:
    """For each level the closest plane within 10 mm, in 1 mm steps, that holds three points."""
    targets = boxes.select("case_id", "y_min", "y_max", "span_y", F.explode(_levels(levels)).alias("l")).select(
        "case_id", F.col("l.key").alias("key"), (F.col("y_min") + F.col("l.ratio") * F.col("span_y")).alias("y_target"),
        F.lit(half).alias("half"), "y_min", "y_max",
    )
    return planes_near(verts, targets).select("case_id", "key", "shift_mm", "plane", "n_points")


def planes_near(verts: DataFrame, targets: DataFrame) -> DataFrame:
    """The closest plane to each of the ``targets`` (case_id, key, y_target, half, y_min, y_max) within 10 mm, in 1 mm
    steps from the lowest, whose band of ``half`` on either side holds three points, and what that band measures.

    Vertices meet only the targets of their case that they lie near; the candidate planes of a vertex follow by
    arithmetic, and planes are then counted.
    """
    lo = F.greatest(F.col("y_min"), F.col("y_target") - MAX_SHIFT_M)
    hi = F.least(F.col("y_max"), F.col("y_target") + MAX_SHIFT_M)
    near = (
        verts.select("case_id", "x", "y", "z").join(targets, "case_id")
        .where(F.abs(F.col("y") - F.col("y_target")) < MAX_SHIFT_M + F.col("half"))
        .withColumns({"lo": lo, "hi": hi})
        .withColumn("steps", F.floor((F.col("hi") - F.col("lo")) / PLANE_STEP_M).cast("int"))
    )
    first = F.greatest(F.floor((F.col("y") - F.col("half") - F.col("lo")) / PLANE_STEP_M).cast("int"), F.lit(0))
    last = F.least(F.ceil((F.col("y") + F.col("half") - F.col("lo")) / PLANE_STEP_M).cast("int"), F.col("steps"))
    span = lambda c: (F.max(c) - F.min(c))
    planes = (
        near.withColumns({"i0": first, "i1": last})
        .where(F.col("i0") <= F.col("i1"))
        .withColumn("i", F.explode(F.sequence("i0", "i1")))
        .withColumn("plane", F.col("lo") + F.col("i") * PLANE_STEP_M)
        .where((F.abs(F.col("y") - F.col("plane")) < F.col("half")) & (F.col("plane") <= F.col("hi")))
        .groupBy("case_id", "key", "i")
        .agg(
            F.count(F.lit(1)).alias("n_points"), F.min("plane").alias("plane"), F.min("y_target").alias("y_target"),
            span("x").alias("width"), span("z").alias("depth"),
        )
        .where(F.col("n_points") >= MIN_BAND_POINTS)
        .withColumn("shift_mm", F.abs(F.col("plane") - F.col("y_target")) * 1000.0)
    )
    best = F.min_by(F.struct("shift_mm", "plane", "n_points", "width", "depth"), F.struct(F.round("shift_mm", 9), "i"))
    return planes.groupBy("case_id", "key").agg(best.alias("b")).select("case_id", "key", "b.*")


def arm_lengths(verts: DataFrame, boxes: DataFrame) -> DataFrame:
    """Right arm from the right-most vertices of the shoulder and wrist bands, times 1.05."""
    at = {"shoulder": 0.15, "wrist": 0.50}
    near = lambda r: F.abs(F.col("y") - (F.col("y_max") - r * F.col("span_y"))) < 0.05 * F.col("span_y")
    v = verts.join(boxes.select("case_id", "y_max", "span_y"), "case_id")
    pick = lambda r: F.min_by(F.struct("x", "y", "z"), F.when(near(r), F.struct((-F.col("x")).alias("x"), "vertex_id")))
    ends = v.groupBy("case_id").agg(
        *[F.when(F.count_if(near(r)) > 0, pick(r)).alias(n) for n, r in at.items()]
    )
    return ends.withColumn("arm_len_m", distance("shoulder", "wrist") * ARM_FACTOR).withColumn(
        "code", F.when(F.col("arm_len_m").isNull(), "LANDMARK_REGIONS_NOT_FOUND")
    )


def arm_lengths_from_joints(joints: DataFrame) -> DataFrame:
    """Arm length from the ``R_shoulder`` and ``R_wrist`` joint structs of each case."""
    return joints.select("case_id", (distance("R_shoulder", "R_wrist") * ARM_FACTOR).alias("arm_len_m"))


def distance(a: str, b: str) -> Column:
    parts = [F.pow(F.col(a)[c] - F.col(b)[c], F.lit(2.0)) for c in "xyz"]
    return F.sqrt(parts[0] + parts[1] + parts[2])


def pelvis_frames(verts: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pelvis origin: mean of the vertices at 45..55 % of the height; box centre when under three."""
    lo, hi = (F.col("y_min") + r * F.col("span_y") for r in PELVIS_BAND)
    band = (F.col("y") >= lo) & (F.col("y") <= hi)
    j = verts.join(boxes.select("case_id", "y_min", "span_y", "x_mean", "y_mean", "z_mean"), "case_id")
    agg = j.groupBy("case_id").agg(
        F.count_if(band).alias("n_band"),
        *[F.avg(F.when(band, F.col(c))).alias(f"b{c}") for c in "xyz"],
        *[F.min(f"{c}_mean").alias(f"m{c}") for c in "xyz"],
    )
    ok = F.col("n_band") >= 3
    return agg.select(
        "case_id", "n_band",
        *[F.when(ok, F.col(f"b{c}")).otherwise(F.col(f"m{c}")).alias(f"o{c}") for c in "xyz"],
        F.when(~ok, "PELVIS_BAND_TOO_FEW_POINTS").alias("code"),
    )


def face_quality(faces: DataFrame, verts: DataFrame, eps: float = EPS_AREA) -> DataFrame:
    """Area and validity of every face (fan triangulation), from the long face and vertex tables."""
    idx = F.col("idx")
    shaped = faces.select(
        "case_id", "face_id", "idx",
        (F.size(idx) < 3).alias("short"),
        (F.size(F.array_distinct(idx)) < F.size(idx)).alias("repeated"),
    )
    tri = F.transform(
        F.sequence(F.lit(1), F.size(idx) - 2),
        lambda i: F.struct(
            F.element_at(idx, 1).alias("a"), F.element_at(idx, i + 1).alias("b"), F.element_at(idx, i + 2).alias("c")
        ),
    )
    whole = shaped.where(~F.col("short") & ~F.col("repeated"))
    corners = whole.select("case_id", "face_id", F.posexplode(tri).alias("t", "abc")).select(
        "case_id", "face_id", "t",
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("corner"), F.col("abc")[n].alias("vertex_id")) for n in "abc"])
        ).alias("s"),
    ).select("case_id", "face_id", "t", "s.corner", F.col("s.vertex_id").cast("bigint").alias("vertex_id"))
    at = lambda n: F.max(F.when(F.col("corner") == n, F.struct("x", "y", "z"))).alias(n)
    placed = (
        corners.join(verts.select("case_id", "vertex_id", "x", "y", "z"), ["case_id", "vertex_id"])
        .groupBy("case_id", "face_id", "t")
        .agg(at("a"), at("b"), at("c"))
    )
    u = {c: F.col("b")[c] - F.col("a")[c] for c in "xyz"}
    w = {c: F.col("c")[c] - F.col("a")[c] for c in "xyz"}
    cross = [u["y"] * w["z"] - u["z"] * w["y"], u["z"] * w["x"] - u["x"] * w["z"], u["x"] * w["y"] - u["y"] * w["x"]]
    area = 0.5 * F.sqrt(cross[0] * cross[0] + cross[1] * cross[1] + cross[2] * cross[2])
    areas = placed.withColumn("_area", area).groupBy("case_id", "face_id").agg(F.sum("_area").alias("area"))
    bad = F.col("short") | F.col("repeated") | N.finite(F.col("area")).isNull() | (F.col("area") <= eps)
    return (
        shaped.join(areas, ["case_id", "face_id"], "left")
        .withColumn("invalid", F.coalesce(bad, F.lit(True)))
        .select(
            "case_id", "face_id", "invalid",
            F.when(F.col("short") | F.col("repeated"), F.lit(0.0)).otherwise(N.finite(F.col("area"))).alias("area"),
        )
    )


def mesh_quality(face_rows: DataFrame) -> DataFrame:
    return face_rows.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("n_faces"),
        F.count_if("invalid").alias("n_invalid"),
        F.min("area").alias("min_area"),
        F.bool_or("invalid").alias("invalid_face_flag"),
    )


def box_from_girths(df: DataFrame, bust: str = "bust", waist: str = "waist", hip: str = "hip") -> DataFrame:
    """A torso box estimated from three circumferences: widest circle, 0.8 deep, 0.6 high."""
    pi2 = 6.283185307179586
    r = lambda c, d: F.when(F.col(c) > 0, F.col(c) / pi2).otherwise(d)
    width = F.greatest(r(bust, 0.2), r(waist, 0.15), r(hip, 0.2)) * 2
    df = df.withColumn("_w", width)
    half = {"x": F.col("_w") / 2, "y": F.col("_w") * 0.8 / 2, "z": F.lit(0.3)}
    return df.select(
        "*", *[(-half[c]).alias(f"{c}_min") for c in "xyz"], *[half[c].alias(f"{c}_max") for c in "xyz"]
    ).drop("_w")


def _clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def fit_proxy(body_boxes: DataFrame, garment: DataFrame) -> DataFrame:
    """Clipping, penetration and violation scores of a garment against a body box, per pair.

    Each vertex meets the one box of its case for its depth, vertices are summed up per case, and only those rows
    and the boxes, one of each per case, are matched in full. Of several boxes of a case the smallest bounds count.
    A missing side scores a neutral 0.5.
    """
    keep = [f"b_{c}_{s}" for c in "xyz" for s in ("min", "max")]
    body = body_boxes.groupBy("case_id").agg(*[F.min(k[2:]).alias(k) for k in keep])
    inside = F.lit(True)
    for c in "xyz":
        inside = inside & F.col(c).between(F.col(f"b_{c}_min"), F.col(f"b_{c}_max"))
    depth = F.least(*[d for c in "xyz" for d in (F.col(c) - F.col(f"b_{c}_min"), F.col(f"b_{c}_max") - F.col(c))])
    worn = join_keys(garment, body, ["case_id"], "left").groupBy(F.col("case_id").alias("_case")).agg(
        *[F.min(c).alias(f"g_{c}_min") for c in "xyz"],
        *[F.max(c).alias(f"g_{c}_max") for c in "xyz"],
        F.count("x").alias("n_garment"),
        F.count_if(inside).alias("n_inside"),
        F.avg(F.when(inside, depth)).alias("mean_depth"),
        F.lit(True).alias("_worn"),
    )
    agg = worn.join(body, F.col("_case").eqNullSafe(F.col("case_id")), "full").withColumns(
        {"case_id": F.when(F.col("_worn"), F.col("_case")).otherwise(F.col("case_id")), "n_garment": F.coalesce("n_garment", F.lit(0)), "n_inside": F.coalesce("n_inside", F.lit(0))}
    ).drop("_case", "_worn")

    def vol(p):
        v = F.lit(1.0)
        for c in "xyz":
            v = v * (F.col(f"{p}_{c}_max") - F.col(f"{p}_{c}_min"))
        return F.greatest(v, F.lit(0.0))

    edges = [
        F.least(F.col(f"b_{c}_max"), F.col(f"g_{c}_max")) - F.greatest(F.col(f"b_{c}_min"), F.col(f"g_{c}_min"))
        for c in "xyz"
    ]
    inter = F.when((edges[0] > 0) & (edges[1] > 0) & (edges[2] > 0), edges[0] * edges[1] * edges[2]).otherwise(0.0)
    diag = F.sqrt(sum((F.pow(F.col(f"b_{c}_max") - F.col(f"b_{c}_min"), F.lit(2.0)) for c in "xyz"), F.lit(0.0)))
    agg = agg.withColumns({"inter": inter, "small": F.least(vol("b"), vol("g")), "diag": F.greatest(diag, F.lit(1e-12))})
    known = (F.col("n_garment") > 0) & F.col("b_x_min").isNotNull()
    share = F.when(F.col("small") > 1e-12, F.col("inter") / F.col("small")).otherwise(0.0)
    raw_pen = PROXY_WEIGHTS[0] * N.ratio(F.col("n_inside"), F.col("n_garment")) + PROXY_WEIGHTS[1] * F.coalesce(
        F.col("mean_depth") / F.col("diag"), F.lit(0.0)
    )
    agg = agg.withColumns(
        {
            "clipping": F.when(known, _clamp01(1 - share)).otherwise(0.5),
            "penetration": F.when(known, _clamp01(1 - raw_pen)).otherwise(0.5),
            "degraded": ~known,
        }
    )
    violation = _clamp01(0.5 * (1 - F.col("penetration")) + 0.5 * (1 - F.col("clipping")))
    return agg.select(
        "case_id", "n_garment", "n_inside", "clipping", "penetration",
        F.when(known, _clamp01(1 - violation)).otherwise(0.5).alias("violation"), "degraded",
    )


# --- shoulder width -----------------------------------------------------------------------------

# Arm weight, cone and landmark settings of the two shoulder rules.
ARM_WEIGHT = 0.55
CONE_RANGE = (0.02, 0.95)
CONE_RADIUS = (0.33, 0.22)
CAP_QUANTILES = (0.92, 0.87, 0.82, 0.77, 0.72, 0.67)
CAP_POINTS = 60
CAP_MIN = 5
CAP_TOP = 10
PLANE_TOLERANCE = 0.08
ARM_DISTANCE = 0.15
ARM_COSINE = 0.5
ARM_PROJECTION = 0.2
PLANE_MIN_POINTS = 30
LATERAL_QUANTILES = (0.05, 0.95)


def _dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _xyz(name: str) -> list[Column]:
    return [F.col(name)[c] for c in "xyz"]


def _minus(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [p - q for p, q in zip(a, b)]


@F.pandas_udf(T.BooleanType())
def _first_nearer(ax: pd.Series, ay: pd.Series, az: pd.Series, bx: pd.Series, by: pd.Series, bz: pd.Series) -> pd.Series:
    """Is the first difference the shorter one, or as long as the second? A vertex between both shoulders is decided by the
    last bit, and a square by the C library's ``pow``, which SQL engines call, rounds some squares unlike a product."""
    a, b = ax * ax + ay * ay + az * az, bx * bx + by * by + bz * bz
    out = (a <= b).to_numpy(copy=True)
    square = lambda s, i: math.pow(s.iat[i], 2.0)
    for i in np.flatnonzero((a - b).abs() <= 1e-12 * (a + b)):
        out[i] = square(ax, i) + square(ay, i) + square(az, i) <= square(bx, i) + square(by, i) + square(bz, i)
    return pd.Series(out)


def shoulder_width(verts: DataFrame, joints: DataFrame) -> DataFrame:
    """Shoulder width between lateral landmarks, after dropping arm vertices.

    ``verts`` carries ``arm_w`` (summed elbow and wrist weight); ``joints`` one row per case with the
    structs ``L_shoulder``, ``R_shoulder``, ``L_elbow``, ``R_elbow``. The landmark of a side is the mean
    of its most lateral vertices: the 0.92 quantile, relaxed in steps until 60 vertices remain; with
    fewer than five, the mean of the top ten; with none at all on either side, the joints themselves.
    """
    j = verts.join(joints, "case_id")
    p = [F.col(c) for c in "xyz"]
    arm = F.lit(False)
    for side in "LR":
        sh = _xyz(f"{side}_shoulder")
        axis = _minus(_xyz(f"{side}_elbow"), sh)
        length = F.sqrt(_dot(axis, axis))
        rel = _minus(p, sh)
        s = _dot(rel, axis) / length
        d = F.sqrt(F.greatest(_dot(rel, rel) - s * s, F.lit(0.0)))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), s / length))
        r = (CONE_RADIUS[0] + (CONE_RADIUS[1] - CONE_RADIUS[0]) * t) * length
        arm = arm | ((s >= CONE_RANGE[0] * length) & (s <= CONE_RANGE[1] * length) & (d <= r))
    kept = j.where((F.col("arm_w") < ARM_WEIGHT) & ~arm)
    left, right = _xyz("L_shoulder"), _xyz("R_shoulder")
    dl, dr = _minus(p, left), _minus(p, right)
    kept = kept.withColumn("side", F.when(_first_nearer(*dl, *dr), "L").otherwise("R"))
    side = F.col("side")
    mid = [0.5 * (a + b) for a, b in zip(left, right)]
    out_l, out_r = _minus(left, mid), _minus(right, mid)
    half = F.sqrt(_dot(out_l, out_l))
    score = F.when(side == "L", _dot(dl, out_l) / half).otherwise(_dot(dr, out_r) / half)
    pts = kept.select("case_id", "side", F.round(score, 12).alias("score"), "vertex_id", "x", "y", "z")
    names = {f"q{i}": q for i, q in enumerate(CAP_QUANTILES)}
    cuts = exact_quantiles(pts, ["case_id", "side"], "score", names)
    above = pts.join(cuts, ["case_id", "side"])
    # count and sums above every cut in one pass; which cut counts is known afterwards
    past = {n: F.col("score") >= F.round(F.col(n), 12) for n in names}
    levels = above.groupBy("case_id", "side").agg(
        *[F.count_if(c).alias(f"c{n}") for n, c in past.items()],
        *[F.sum(F.when(c, F.col(a))).alias(f"{a}{n}") for n, c in past.items() for a in "xyz"],
    )
    fields = lambda n: F.struct(F.col(f"c{n}").alias("n"), *[(F.col(f"{a}{n}") / F.col(f"c{n}")).alias(f"k{a}") for a in "xyz"])
    chosen = fields(list(names)[-1])
    for n in reversed(list(names)):
        chosen = F.when(F.col(f"c{n}") >= CAP_POINTS, fields(n)).otherwise(chosen)
    picked = levels.select("case_id", "side", chosen.alias("b")).select("case_id", "side", F.col("b.n").alias("n_kept"), "b.kx", "b.ky", "b.kz")
    top = first_k(pts, ["case_id", "side"], [F.desc("score"), F.asc("vertex_id")], CAP_TOP, "_r")
    top = top.groupBy("case_id", "side").agg(*[F.avg(c).alias(f"t{c}") for c in "xyz"])
    means = picked.join(top, ["case_id", "side"])
    mark = [F.when(F.col("n_kept") >= CAP_MIN, F.col(f"k{c}")).otherwise(F.col(f"t{c}")) for c in "xyz"]
    marks = means.select("case_id", "side", F.struct(*[m.alias(c) for m, c in zip(mark, "xyz")]).alias("m"))
    sides = marks.groupBy("case_id").agg(
        F.max(F.when(F.col("side") == "L", F.col("m"))).alias("ml"),
        F.max(F.when(F.col("side") == "R", F.col("m"))).alias("mr"),
    )
    out = joints.join(sides, "case_id", "left").select(
        "case_id",
        F.coalesce("ml", "L_shoulder").alias("ml"),
        F.coalesce("mr", "R_shoulder").alias("mr"),
        (F.col("ml").isNull() & F.col("mr").isNull()).alias("fallback"),
    )
    return out.select("case_id", distance("ml", "mr").alias("shoulder_width_m"), "fallback")


def shoulder_width_plane(verts: DataFrame, joints: DataFrame) -> DataFrame:
    """Older rule: lateral spread (q95 - q05) of the torso vertices at shoulder height."""
    j = verts.join(joints, "case_id")
    p = [F.col(c) for c in "xyz"]
    left, right = _xyz("L_shoulder"), _xyz("R_shoulder")
    level = 0.5 * (left[1] + right[1])
    slab = j.where(F.abs(F.col("y") - level) <= PLANE_TOLERANCE)
    arm = F.lit(False)
    for side in "LR":
        sh = _xyz(f"{side}_shoulder")
        axis = _minus(_xyz(f"{side}_elbow"), sh)
        length = F.sqrt(_dot(axis, axis))
        rel = _minus(p, sh)
        far = F.sqrt(_dot(rel, rel))
        along = _dot(rel, axis) / length
        arm = arm | (
            (far > ARM_DISTANCE) & (F.abs(along) > ARM_COSINE * far) & (along > ARM_PROJECTION * length)
        )
    axis = _minus(right, left)
    lateral = _dot(_minus(p, left), axis) / F.sqrt(_dot(axis, axis))
    marked = slab.select("case_id", arm.alias("arm"), lateral.alias("lateral"))
    counts = marked.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("n_slab"), F.count_if(~F.col("arm")).alias("n_torso")
    )
    q = exact_quantiles(
        marked.where(~F.col("arm")), ["case_id"], "lateral", dict(zip(("q05", "q95"), LATERAL_QUANTILES))
    )
    enough = (F.col("n_slab") >= PLANE_MIN_POINTS) & (F.col("n_torso") >= PLANE_MIN_POINTS)
    return (
        joints.join(counts, "case_id", "left")
        .join(q, "case_id", "left")
        .select(
            "case_id",
            F.when(enough, F.col("q95") - F.col("q05")).otherwise(distance("L_shoulder", "R_shoulder")).alias("shoulder_width_m"),
            (~F.coalesce(enough, F.lit(False))).alias("fallback"),
        )
    )
