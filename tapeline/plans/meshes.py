"""Queries of the mesh job: boxes, bands, slices, circumferences, shoulder width, fit proxy."""

from __future__ import annotations

from pyspark.sql import functions as F

from tapeline.operators import geometry as G
from tapeline.operators import slices as L
from tapeline.plans.inputs import (
    BOXES, CLOUD, PICKED, SLICE_ROWS, cloud, sql_bands, sql_hull, sql_slices, with_sql,
)
from tapeline.plans.registry import query, table

# The bands the comparison SQL goes by, written out from the contract and not taken from the operators.
CIRC_SQL = sql_bands({
    "NECK_CIRC_M": (0.75, 0.90, "median", "high"), "BUST_CIRC_M": (0.40, 0.70, "max", "low"), "UNDERBUST_CIRC_M": (0.30, 0.60, "median", "high"),
    "WAIST_CIRC_M": (0.42, 0.66, "median", "high"), "HIP_CIRC_M": (0.48, 0.78, "max", "low"), "THIGH_CIRC_M": (0.20, 0.40, "max", "low"),
    "MIN_CALF_CIRC_M": (0.05, 0.20, "min", "high"),
})
GROUP_SQL = sql_bands({"WAIST_GROUP": (0.42, 0.66, "min", "high"), "HIP_GROUP": (0.48, 0.78, "max", "low")})
HIP_SQL = sql_bands({
    "A": (0.50, 0.80, "max", "low"), "B": (0.48, 0.78, "max", "low"), "C": (0.50, 0.78, "max", "low"), "D": (0.52, 0.80, "max", "low"),
    "E": (0.46, 0.76, "max", "low"), "B_high": (0.48, 0.78, "max", "high"),
})
ORDERED_BANDS_SQL = sql_bands({"BUST": (0.30, 0.60, "max", "first"), "WAIST": (0.40, 0.70, "min", "first"), "HIP": (0.50, 0.80, "max", "first")})
UNDERBUST_SQL = sql_bands({"UNDERBUST": (0.30, 0.60, "median", "first"), "BUST": (0.40, 0.70, "max", "first")})
WAIST_SQL = sql_bands({"WAIST_CIRC_M": (0.42, 0.66, "median", "high")})
HULLS = sql_hull("sp", "case_id, key, slice")
ORDER_BLOCK = 50_000  # orders whose lines form a chunk of vertices


def r6(c, name=None):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


def r9(c):
    return F.round(c, 9).alias(c)


@query(
    "bbox_height", "A48",
    with_sql(CLOUD, BOXES, """
SELECT case_id, n_verts, round(span_x, 9) AS span_x, round(span_y, 9) AS height_m, round(span_z, 9) AS span_z,
  CASE WHEN span_x >= span_y AND span_x >= span_z THEN 'x' WHEN span_y >= span_z THEN 'y' ELSE 'z' END AS longest_axis,
  round(span_y * 0.45, 9) AS crotch_height_m, round(span_y * 0.25, 9) AS knee_height_m,
  coalesce(CASE WHEN span_y < 0.1 THEN 'HEIGHT_SMALL' WHEN span_y > 3 THEN 'HEIGHT_LARGE' END, '') AS height_code FROM boxes"""),
)
def bbox_height(spark, sf):
    b = G.bounding_boxes(cloud(spark, sf))
    return b.select(
        "case_id", "n_verts", r9("span_x"), r9("height_m"), r9("span_z"), "longest_axis", r9("crotch_height_m"),
        r9("knee_height_m"), F.coalesce("height_code", F.lit("")).alias("height_code"),
    )


@query(
    "widths_by_band", "A49",
    with_sql(CLOUD, BOXES, """
lv AS (SELECT b.*, k.key, y_min + k.ratio * span_y AS y_target, CASE WHEN k.key = 'CHEST' THEN span_y * 0.02 ELSE greatest(span_y * 0.02, 0.005) END AS half
  FROM boxes b, (VALUES ('CHEST', 0.35::DOUBLE), ('WAIST', 0.5::DOUBLE), ('HIP', 0.6::DOUBLE)) k(key, ratio))""", """
SELECT case_id, key, n_points, round(w, 6) AS width_m, round(d, 6) AS depth_m,
  coalesce(CASE WHEN w < 0.05 THEN 'SMALL' WHEN w > 1.0 THEN 'LARGE' END, '') AS width_code,
  coalesce(CASE WHEN d < 0.05 THEN 'SMALL' WHEN d > 1.0 THEN 'LARGE' END, '') AS depth_code FROM (
  SELECT lv.case_id, lv.key, count(c.x) AS n_points, CASE WHEN count(c.x) >= 3 THEN max(c.x) - min(c.x) END AS w,
    CASE WHEN count(c.x) >= 3 THEN max(c.z) - min(c.z) END AS d
  FROM lv LEFT JOIN cloud c ON c.case_id = lv.case_id AND abs(c.y - lv.y_target) < lv.half GROUP BY 1, 2)"""),
)
def widths_by_band(spark, sf):
    v = cloud(spark, sf)
    out = G.band_widths(v, G.bounding_boxes(v))
    return out.select(
        "case_id", "key", "n_points", r6("width_m"), r6("depth_m"),
        F.coalesce("width_code", F.lit("")).alias("width_code"), F.coalesce("depth_code", F.lit("")).alias("depth_code"),
    )


@query(
    "nearest_plane", "A50",
    with_sql(CLOUD, BOXES, """
lv AS (SELECT *, CAST(floor((hi - lo) / 0.001::DOUBLE) AS INTEGER) AS steps FROM (
  SELECT b.case_id, k.key, y_min + k.ratio * span_y AS y_target, greatest(y_min, y_min + k.ratio * span_y - 0.01::DOUBLE) AS lo,
    least(y_max, y_min + k.ratio * span_y + 0.01::DOUBLE) AS hi
  FROM boxes b, (VALUES ('WAIST', 0.5::DOUBLE), ('HIP', 0.6::DOUBLE)) k(key, ratio))),
pl AS (SELECT *, lo + i * 0.001::DOUBLE AS plane FROM lv, (SELECT CAST(range AS INTEGER) AS i FROM range(22)) WHERE i <= steps),
h AS (SELECT pl.case_id, pl.key, pl.i, min(plane) AS plane, min(y_target) AS y_target, count(*) AS n_points FROM pl JOIN cloud c
  ON c.case_id = pl.case_id AND abs(c.y - pl.plane) < 0.0015 AND pl.plane <= pl.hi GROUP BY 1, 2, 3 HAVING count(*) >= 3)""", """
SELECT case_id, key, round(shift, 6) AS shift_mm, round(plane, 6) AS plane, n_points FROM (
  SELECT *, row_number() OVER (PARTITION BY case_id, key ORDER BY round(shift, 9), i) AS rn FROM (SELECT *, abs(plane - y_target) * 1000 AS shift FROM h)) WHERE rn = 1"""),
)
def nearest_plane(spark, sf):
    v = cloud(spark, sf)
    out = G.nearest_planes(v, G.bounding_boxes(v), {"WAIST": 0.50, "HIP": 0.60}, 0.0015)
    return out.select("case_id", "key", r6("shift_mm"), r6("plane"), "n_points")


GAP = """gap AS (SELECT c.* FROM cloud c JOIN boxes b USING (case_id) WHERE NOT (c.case_id % 3 = 0 AND abs(c.y - (y_min + 0.5::DOUBLE * span_y)) < greatest(span_y * 0.02, 0.005))),
lv AS (SELECT b.*, k.key, y_min + k.ratio * span_y AS y_target, CASE WHEN k.key = 'CHEST' THEN span_y * 0.02 ELSE greatest(span_y * 0.02, 0.005) END AS half
  FROM boxes b, (VALUES ('CHEST', 0.35::DOUBLE), ('WAIST', 0.5::DOUBLE), ('HIP', 0.6::DOUBLE)) k(key, ratio)),
bd AS (SELECT lv.case_id, lv.key, count(c.x) AS n_points, max(c.x) - min(c.x) AS w, max(c.z) - min(c.z) AS d FROM lv LEFT JOIN gap c ON c.case_id = lv.case_id AND abs(c.y - lv.y_target) < lv.half GROUP BY 1, 2),
em AS (SELECT lv.*, greatest(y_min, y_target - 0.01::DOUBLE) AS lo, least(y_max, y_target + 0.01::DOUBLE) AS hi FROM lv JOIN bd USING (case_id, key) WHERE n_points = 0 AND key <> 'CHEST'),
pl AS (SELECT *, lo + i * 0.001::DOUBLE AS plane FROM em, (SELECT CAST(range AS INTEGER) AS i FROM range(22)) WHERE i <= floor((hi - lo) / 0.001::DOUBLE)),
ph AS (SELECT pl.case_id, pl.key, pl.i, abs(min(plane) - min(y_target)) * 1000 AS shift, count(*) AS n, max(c.x) - min(c.x) AS w, max(c.z) - min(c.z) AS d FROM pl JOIN gap c
  ON c.case_id = pl.case_id AND abs(c.y - pl.plane) < pl.half AND pl.plane <= pl.hi GROUP BY 1, 2, 3 HAVING count(*) >= 3),
bp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id, key ORDER BY round(shift, 9), i) AS rn FROM ph) WHERE rn = 1)"""


@query(
    "widths_shifted", "A49 A50",
    with_sql(CLOUD, BOXES, GAP, """
SELECT bd.case_id, bd.key, coalesce(bp.n, bd.n_points) AS n_points, round(CASE WHEN coalesce(bp.n, bd.n_points) >= 3 THEN coalesce(bp.w, bd.w) END, 6) AS width_m,
  round(CASE WHEN coalesce(bp.n, bd.n_points) >= 3 THEN coalesce(bp.d, bd.d) END, 6) AS depth_m, round(bp.shift, 6) AS shift_mm FROM bd LEFT JOIN bp USING (case_id, key)"""),
)
def widths_shifted(spark, sf):
    """Every third case has no vertex in its waist band, so the nearest plane stands in."""
    v = cloud(spark, sf)
    boxes = G.bounding_boxes(v)
    target, span = F.col("y_min") + 0.5 * F.col("span_y"), F.col("span_y")
    waist = F.abs(F.col("y") - target) < F.greatest(span * 0.02, F.lit(0.005))
    gap = v.join(boxes.select("case_id", "y_min", "span_y"), "case_id").where(~((F.col("case_id") % 3 == 0) & waist)).select(*v.columns)
    return G.band_widths(gap, boxes).select("case_id", "key", "n_points", r6("width_m"), r6("depth_m"), r6("shift_mm"))


@query(
    "arm_length", "A51",
    with_sql(CLOUD, BOXES, """
s AS (SELECT c.*, abs(y - (y_max - 0.15::DOUBLE * span_y)) < 0.05::DOUBLE * span_y AS sh, abs(y - (y_max - 0.50::DOUBLE * span_y)) < 0.05::DOUBLE * span_y AS wr FROM cloud c JOIN boxes USING (case_id)),
a AS (SELECT case_id, x, y, z, row_number() OVER (PARTITION BY case_id ORDER BY x DESC, vertex_id) AS rn FROM s WHERE sh),
b AS (SELECT case_id, x, y, z, row_number() OVER (PARTITION BY case_id ORDER BY x DESC, vertex_id) AS rn FROM s WHERE wr)""", """
SELECT k.case_id, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) * 1.05::DOUBLE, 6) AS arm_len_m
FROM boxes k LEFT JOIN a ON a.case_id = k.case_id AND a.rn = 1 LEFT JOIN b ON b.case_id = k.case_id AND b.rn = 1"""),
)
def arm_length(spark, sf):
    v = cloud(spark, sf)
    return G.arm_lengths(v, G.bounding_boxes(v)).select("case_id", r6("arm_len_m"))


@query(
    "scale_repair", "A54 A25 W9",
    """
WITH c AS (SELECT o_custkey AS case_id, o_totalprice / 10000 AS x, o_orderkey / 1000.0 AS y FROM orders),
t AS (SELECT case_id, max(greatest(abs(x), abs(y))) AS max_abs, count(*) AS n FROM c GROUP BY 1),
w AS (SELECT *, (SELECT count(*) FROM t WHERE max_abs > 30) AS n_total FROM t WHERE max_abs > 30 ORDER BY max_abs DESC, case_id LIMIT 20)
SELECT case_id, round(max_abs, 6) AS max_abs, n_total FROM (
  SELECT case_id, max_abs, n_total FROM (SELECT *, (SELECT count(*) FROM t WHERE max_abs > 10) AS nt FROM t) q, (SELECT (SELECT count(*) FROM t WHERE max_abs > 10) AS n_total)
  WHERE max_abs > 10 ORDER BY max_abs DESC, case_id LIMIT 20)""",
)
def scale_repair(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("case_id"), F.col("o_orderkey").alias("vertex_id"),
        (F.col("o_totalprice") / 10000).alias("x"), (F.col("o_orderkey") / 1000.0).alias("y"), F.lit(0.0).alias("z"),
    )
    return G.scale_warnings(G.repair_scale(o)).select("case_id", r6("max_abs"), "n_total")


@query(
    "pelvis_frame", "A55",
    with_sql(CLOUD, BOXES, """
SELECT c.case_id, count(*) FILTER (WHERE b) AS n_band,
  round(CASE WHEN count(*) FILTER (WHERE b) >= 3 THEN avg(x) FILTER (WHERE b) ELSE avg(x) END * count(*) FILTER (WHERE b), 7) AS ox,
  round(CASE WHEN count(*) FILTER (WHERE b) >= 3 THEN avg(y) FILTER (WHERE b) ELSE avg(y) END * count(*) FILTER (WHERE b), 7) AS oy,
  round(CASE WHEN count(*) FILTER (WHERE b) >= 3 THEN avg(z) FILTER (WHERE b) ELSE avg(z) END * count(*) FILTER (WHERE b), 7) AS oz
FROM (SELECT c.*, y >= y_min + 0.45::DOUBLE * span_y AND y <= y_min + 0.55::DOUBLE * span_y AS b FROM cloud c JOIN boxes USING (case_id)) c GROUP BY 1"""),
)
def pelvis_frame(spark, sf):
    v = cloud(spark, sf)
    return G.pelvis_frames(v, G.bounding_boxes(v)).select("case_id", "n_band", *[F.round(F.col(c) * F.col("n_band"), 7).alias(c) for c in ("ox", "oy", "oz")])


@query(
    "slice_tolerance", "A56",
    with_sql(CLOUD, BOXES, """
SELECT case_id, round(greatest(least(greatest(list_sort([span_x, span_y, span_z])[2] * 0.002, span_y / 200), 0.01), 1e-5), 10) AS tolerance FROM boxes"""),
)
def slice_tolerance(spark, sf):
    b = G.bounding_boxes(cloud(spark, sf))
    return b.select("case_id", F.round(G.slice_tolerance(F.col("span_y") / 200), 10).alias("tolerance"))


@query(
    "band_join_slices", "JN5",
    with_sql(CLOUD, BOXES, CIRC_SQL, sql_slices(), """
SELECT case_id, key, slice, round(min(y_slice), 6) AS y_slice, count(*) AS n_points FROM sp GROUP BY 1, 2, 3"""),
)
def band_join_slices(spark, sf):
    v = cloud(spark, sf)
    sp = L.slice_points(v, G.bounding_boxes(v), L.CIRC_BANDS)
    return sp.groupBy(*L.SLICE).agg(F.round(F.min("y_slice"), 6).alias("y_slice"), F.count(F.lit(1)).alias("n_points"))


@query(
    "hull_perimeter", "G1",
    with_sql(CLOUD, BOXES, CIRC_SQL, sql_slices(), HULLS, SLICE_ROWS, """
SELECT case_id, key, slice, n_points, round(h.perimeter_m, 6) AS perimeter_m, round(h.area_m2, 6) AS area_m2,
  round(width_m, 6) AS width_m, round(depth_m, 6) AS depth_m
FROM cnt JOIN hulls h USING (case_id, key, slice) WHERE nd >= 3"""),
)
def hull_perimeter(spark, sf):
    v = cloud(spark, sf)
    t = L.slice_table(L.slice_points(v, G.bounding_boxes(v), L.CIRC_BANDS)).where(F.col("perimeter_m").isNotNull())
    return t.select(
        *L.SLICE, "n_points", r6("perimeter_m"), r6("hull_area_m2", "area_m2"), r6("width_m"), r6("depth_m")
    )


@query(
    "circumference_select", "G2",
    with_sql(CLOUD, BOXES, CIRC_SQL, sql_slices(), HULLS, SLICE_ROWS, PICKED, """
SELECT case_id, key, slice, round(y_slice, 6) AS y_slice, round(p, 6) AS perimeter_m, n_candidates FROM picked"""),
)
def circumference_select(spark, sf):
    v = cloud(spark, sf)
    out = L.circumferences(v, G.bounding_boxes(v))
    return out.select("case_id", "key", "slice", r6("y_slice"), r6("perimeter_m"), "n_candidates")


@query(
    "measurement_outcomes", "G10",
    with_sql(CLOUD, BOXES, CIRC_SQL, sql_slices(), HULLS, SLICE_ROWS, PICKED, """
SELECT b.case_id, k.key AS standard_key, round(p, 6) AS value, coalesce(n_candidates, 0) AS n_candidates,
  CASE WHEN p IS NULL THEN 'EMPTY_CANDIDATES' WHEN k.key = 'MIN_CALF_CIRC_M' THEN 'MIN_SEARCH_USED' ELSE '' END AS code
FROM boxes b CROSS JOIN bands k LEFT JOIN picked ON picked.case_id = b.case_id AND picked.key = k.key"""),
)
def measurement_outcomes(spark, sf):
    v = cloud(spark, sf)
    out = L.measurement_outcomes(v, G.bounding_boxes(v))
    return out.select(
        "case_id", "standard_key", r6("value"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), F.coalesce("code", F.lit("")).alias("code")
    )


@query(
    "shared_slice_groups", "G3",
    with_sql(CLOUD, BOXES, GROUP_SQL, sql_slices(), HULLS, SLICE_ROWS, PICKED, """
SELECT case_id, slice, replace(key, '_GROUP', '') || '_' || n || '_M' AS standard_key,
  round(CASE n WHEN 'CIRC' THEN p WHEN 'WIDTH' THEN width_m ELSE depth_m END, 6) AS value_m
FROM picked, (VALUES ('CIRC'), ('WIDTH'), ('DEPTH')) t(n)"""),
)
def shared_slice_groups(spark, sf):
    v = cloud(spark, sf)
    return L.shared_slices(v, G.bounding_boxes(v)).select("case_id", "slice", "standard_key", r6("value_m"))


@query(
    "hip_band_sweep", "G5",
    with_sql(CLOUD, BOXES, HIP_SQL, sql_slices(), HULLS, SLICE_ROWS, PICKED, """
SELECT case_id, key AS config, slice, round(p, 6) AS perimeter_m FROM picked"""),
)
def hip_band_sweep(spark, sf):
    v = cloud(spark, sf)
    out = L.circumferences(v, G.bounding_boxes(v), L.HIP_CONFIGS)
    return out.select("case_id", F.col("key").alias("config"), "slice", r6("perimeter_m"))


PELVIS_HIP = {"HIP_H": (0.55, 0.75, "max", "low")}


@query(
    "pelvis_hip_band", "G6",
    with_sql(CLOUD, BOXES, sql_bands(PELVIS_HIP), """
fr AS (SELECT c.case_id, avg(x) AS ox, avg(y) AS oy, avg(z) AS oz FROM cloud c JOIN boxes USING (case_id)
  WHERE y >= y_min + 0.45::DOUBLE * span_y AND y <= y_min + 0.55::DOUBLE * span_y GROUP BY 1),
hc AS (SELECT c.case_id, vertex_id, y - oy AS h, u, v, c.x AS x, c.z AS z FROM cloud c JOIN fr USING (case_id)),
hb AS (SELECT b.case_id, b.span_x, b.span_y, b.span_z, b.y_min - fr.oy AS h_min FROM boxes b JOIN fr USING (case_id))""",
    sql_slices(axis="h", lo="h_min", src="hc").replace("FROM boxes b, bands k", "FROM hb b, bands k"),
    HULLS, SLICE_ROWS, PICKED, """
SELECT case_id, round(p, 6) AS perimeter_m, n_candidates FROM picked"""),
)
def pelvis_hip_band(spark, sf):
    v = cloud(spark, sf)
    frame = L.pelvis_heights(v, G.pelvis_frames(v, G.bounding_boxes(v)))
    out = L.circumferences(frame, G.bounding_boxes(frame), PELVIS_HIP)
    return out.select("case_id", r6("perimeter_m"), "n_candidates")


ORDERED_SQL = """nx AS (SELECT *, lead(x) OVER w AS nx, lead(z) OVER w AS nz, first_value(x) OVER w AS fx, first_value(z) OVER w AS fz
  FROM sp WINDOW w AS (PARTITION BY case_id, key, slice ORDER BY vertex_id)),
rg AS (SELECT case_id, key, slice, min(y_slice) AS y_slice, count(*) AS n_points,
    sum(sqrt((coalesce(nx, fx) - x) ** 2 + (coalesce(nz, fz) - z) ** 2)) AS perimeter_m,
    abs(sum(x * coalesce(nz, fz) - coalesce(nx, fx) * z)) / 2 AS area_m2 FROM nx GROUP BY 1, 2, 3),
st AS (SELECT *, round(perimeter_m, 9) AS p FROM rg WHERE n_points >= 3)"""


def _ordered(spark, sf, bands):
    v = cloud(spark, sf)
    pts = L.slice_points(v, G.bounding_boxes(v), bands, adaptive=False)
    return L.ordered_rings(pts, [*L.SLICE, "y_slice"], chunk=_order_chunk()).where(F.col("n_points") >= 3)


def _order_chunk():
    return F.floor(F.col("vertex_id")[0] / ORDER_BLOCK)


@query(
    "ordered_perimeter", "G4",
    with_sql(CLOUD, BOXES, ORDERED_BANDS_SQL, sql_slices(adaptive=False), ORDERED_SQL, PICKED, """
SELECT case_id, key, slice, n_points, round(perimeter_m, 6) AS perimeter_m, 'y:' || slice || ':' || format('{:.6f}', y_slice) AS section_id,
  coalesce(CASE WHEN perimeter_m < 0.1 THEN 'PERIMETER_SMALL' WHEN perimeter_m > 3 THEN 'PERIMETER_LARGE' END, '') AS code FROM picked"""),
)
def ordered_perimeter(spark, sf):
    v = cloud(spark, sf)
    out = L.ordered_circumferences(v, G.bounding_boxes(v), chunk=_order_chunk())
    return out.select("case_id", "key", "slice", "n_points", r6("perimeter_m"), "section_id", F.coalesce("code", F.lit("")).alias("code"))


@query(
    "bust_underbust", "G4",
    with_sql(CLOUD, BOXES, UNDERBUST_SQL, sql_slices(adaptive=False), ORDERED_SQL, PICKED, """
SELECT case_id, key, slice, round(perimeter_m, 6) AS perimeter_m FROM picked"""),
)
def bust_underbust(spark, sf):
    picked = L.select_slice(_ordered(spark, sf, L.BUST_UNDERBUST_BANDS), L.BUST_UNDERBUST_BANDS)
    return picked.select("case_id", "key", "slice", r6("perimeter_m"))


@query(
    "loop_quality", "G8",
    with_sql(CLOUD, BOXES, ORDERED_BANDS_SQL, sql_slices(adaptive=False), ORDERED_SQL, """
SELECT case_id, key, slice, round(area_m2, 6) AS area_m2, CASE WHEN area_m2 > 1e-10 THEN round(perimeter_m * perimeter_m / area_m2, 2) END AS shape_ratio,
  CASE WHEN area_m2 < 1e-10 THEN 'EMPTY' ELSE 'VALID' END AS validity FROM st"""),
)
def loop_quality(spark, sf):
    out = L.loop_quality(_ordered(spark, sf, L.ORDERED_BANDS))
    return out.select(*L.SLICE, r6("area_m2"), F.round("shape_ratio", 2).alias("shape_ratio"), "validity")


WAIST_ONLY = {"WAIST_CIRC_M": L.CIRC_BANDS["WAIST_CIRC_M"]}
PARTS_SQL = """dd AS (SELECT case_id, key, slice, u, v, count(*) AS n, sum(x) AS sx, sum(z) AS sz FROM sp GROUP BY ALL),
ed AS (SELECT a.case_id, a.key, a.slice, a.u AS au, a.v AS av, b.u AS bu, b.v AS bv FROM dd a JOIN dd b USING (case_id, key, slice)
  WHERE (20000 * (a.u - b.u)) ** 2 + (10000 * (a.v - b.v)) ** 2 < 25000 ** 2),
rc AS (SELECT case_id, key, slice, u AS su, v AS sv, u, v FROM dd
  UNION SELECT rc.case_id, rc.key, rc.slice, rc.su, rc.sv, ed.bu, ed.bv FROM rc JOIN ed ON rc.case_id = ed.case_id AND rc.key = ed.key
    AND rc.slice = ed.slice AND rc.u = ed.au AND rc.v = ed.av),
lb AS (SELECT case_id, key, slice, su AS u, sv AS v, min(u * 1000 + v) AS part FROM rc GROUP BY 1, 2, 3, 4, 5),
pp AS (SELECT dd.*, lb.part FROM dd JOIN lb USING (case_id, key, slice, u, v))"""


@query(
    "slice_parts", "G7",
    with_sql(CLOUD, BOXES, WAIST_SQL, sql_slices(), PARTS_SQL, sql_hull("pp", "case_id, key, slice, part", out="ph"), """
SELECT case_id, slice, t.n_points, round(CASE WHEN nd >= 3 THEN ph.area_m2 ELSE 0 END, 6) AS area_m2,
  round(CASE WHEN nd >= 3 THEN ph.perimeter_m END, 6) AS perimeter_m, round(cx, 6) AS centre_x, round(cz, 6) AS centre_z
FROM (SELECT case_id, key, slice, part, CAST(sum(n) AS BIGINT) AS n_points, count(*) AS nd, sum(sx) / sum(n) AS cx, sum(sz) / sum(n) AS cz FROM pp GROUP BY 1, 2, 3, 4) t
LEFT JOIN ph USING (case_id, key, slice, part) WHERE t.n_points >= 3""").replace("WITH ", "WITH RECURSIVE ", 1),
)
def slice_parts(spark, sf):
    v = cloud(spark, sf)
    parts = L.slice_parts(L.slice_points(v, G.bounding_boxes(v), WAIST_ONLY), 0.025)
    return parts.select(
        "case_id", "slice", "n_points", r6("area_m2"), r6("perimeter_m"), r6("centre_x"), r6("centre_z")
    )


TORSO_SQL = """pt AS (SELECT case_id, key, slice, t.n_points, CASE WHEN nd >= 3 THEN ph.area_m2 ELSE 0 END AS area, CASE WHEN nd >= 3 THEN ph.perimeter_m END AS perimeter, cx, cz
  FROM (SELECT case_id, key, slice, part, CAST(sum(n) AS BIGINT) AS n_points, count(*) AS nd, sum(sx) / sum(n) AS cx, sum(sz) / sum(n) AS cz FROM pp GROUP BY 1, 2, 3, 4) t
  LEFT JOIN ph USING (case_id, key, slice, part) WHERE t.n_points >= 3),
ds AS (SELECT pt.*, round(sqrt((cx - x_mean) ** 2 + (cz - z_mean) ** 2), 6) AS d FROM pt JOIN boxes USING (case_id)),
rk AS (SELECT *, min(d) OVER (PARTITION BY case_id, key, slice) AS first,
    row_number() OVER (PARTITION BY case_id, key, slice ORDER BY d, -round(area, 6), -round(perimeter, 6) NULLS FIRST, round(cx, 9), round(cz, 9)) AS rn,
    row_number() OVER (PARTITION BY case_id, key, slice ORDER BY area DESC, cx, cz) AS big FROM ds)"""


@query(
    "torso_part", "G7",
    with_sql(CLOUD, BOXES, WAIST_SQL, sql_slices(), PARTS_SQL, sql_hull("pp", "case_id, key, slice, part", out="ph"), TORSO_SQL, """
SELECT case_id, slice, count(*) AS n_parts, any_value(n_points) FILTER (WHERE rn = 1) AS n_points, round(any_value(area) FILTER (WHERE rn = 1), 6) AS area_m2,
  round(any_value(perimeter) FILTER (WHERE rn = 1), 6) AS perimeter_m, count(*) FILTER (WHERE d = first) > 1 AS tie_used, round(quantile_cont(area, 0.5), 6) AS area_p50,
  string_agg(format('{:.6f}', area), '|' ORDER BY big) FILTER (WHERE big <= 3) AS area_top3
FROM rk GROUP BY case_id, key, slice""").replace("WITH ", "WITH RECURSIVE ", 1),
)
def torso_part(spark, sf):
    v = cloud(spark, sf)
    boxes = G.bounding_boxes(v)
    out = L.torso_part(L.slice_parts(L.slice_points(v, boxes, WAIST_ONLY), 0.025), boxes)
    return out.select(
        "case_id", "slice", "n_parts", "n_points", r6("area_m2"), r6("perimeter_m"), "tie_used", r6("area_p50"), "area_top3"
    )


@query(
    "face_quality", "A52",
    """
WITH nv AS (SELECT count(*) // 20 AS n FROM part),
vx AS (SELECT p_partkey % 20 AS c, p_partkey // 20 AS i, p_size / 50.0::DOUBLE AS x, p_retailprice / 1000 AS y, (p_partkey % 7) / 7.0::DOUBLE AS z FROM part),
f AS (SELECT o_custkey % 20 AS c, o_orderkey AS f, o_orderkey % n AS a, o_custkey % n AS b, (o_orderkey + o_custkey) % n AS d, o_orderstatus = 'P' AS short FROM orders, nv),
e AS (SELECT f.*, p.x AS px, p.y AS py, p.z AS pz, q.x AS qx, q.y AS qy, q.z AS qz, r.x AS rx, r.y AS ry, r.z AS rz FROM f
  JOIN vx p ON p.c = f.c AND p.i = a JOIN vx q ON q.c = f.c AND q.i = b JOIN vx r ON r.c = f.c AND r.i = d),
g AS (SELECT c, f, short OR a = b OR b = d OR a = d AS deg, 0.5 * sqrt(
   ((qy - py) * (rz - pz) - (qz - pz) * (ry - py)) ** 2 + ((qz - pz) * (rx - px) - (qx - px) * (rz - pz)) ** 2 + ((qx - px) * (ry - py) - (qy - py) * (rx - px)) ** 2) AS ar FROM e)
SELECT c AS case_id, count(*) AS n_faces, count(*) FILTER (WHERE deg OR ar <= 1e-12) AS n_invalid,
  round(min(CASE WHEN deg THEN 0 ELSE ar END), 6) AS min_area, bool_or(deg OR ar <= 1e-12) AS invalid_face_flag FROM g GROUP BY 1""",
)
def face_quality(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    verts = p.select(
        (k % 20).alias("case_id"), F.floor(k / 20).alias("vertex_id"), (F.col("p_size") / 50.0).alias("x"),
        (F.col("p_retailprice") / 1000).alias("y"), ((k % 7) / 7.0).alias("z"),
    )
    n = F.col("n")
    o = table(spark, sf, "orders").crossJoin(F.broadcast(p.agg(F.floor(F.count("*") / 20).alias("n"))))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    two = F.array(k % n, c % n)
    faces = o.select(
        (c % 20).alias("case_id"), k.alias("face_id"),
        F.when(F.col("o_orderstatus") == "P", two).otherwise(F.concat(two, F.array((k + c) % n))).alias("idx"),
    )
    out = G.mesh_quality(G.face_quality(faces, verts))
    return out.withColumn("min_area", F.round("min_area", 6))


@query(
    "fit_proxy", "A53 JN18",
    with_sql(CLOUD, BOXES, """
bb AS (SELECT s_suppkey AS case_id, 0.2 AS x_min, 0.6 + s_acctbal / 40000 AS x_max, 0.1 AS y_min, 0.9 AS y_max, 0.01 AS z_min, 0.08 AS z_max FROM supplier),
j AS (SELECT b.*, c.x, c.y, c.z, c.x BETWEEN x_min AND x_max AND c.y BETWEEN y_min AND y_max AND c.z BETWEEN z_min AND z_max AS ins,
   least(c.x - x_min, x_max - c.x, c.y - y_min, y_max - c.y, c.z - z_min, z_max - c.z) AS dp FROM bb b LEFT JOIN cloud c USING (case_id)),
a AS (SELECT case_id, min(x_min) AS bx0, min(x_max) AS bx1, min(y_min) AS by0, min(y_max) AS by1, min(z_min) AS bz0, min(z_max) AS bz1,
   min(x) AS gx0, max(x) AS gx1, min(y) AS gy0, max(y) AS gy1, min(z) AS gz0, max(z) AS gz1, count(x) AS n_garment,
   count(*) FILTER (WHERE ins) AS n_inside, avg(dp) FILTER (WHERE ins) AS md FROM j GROUP BY 1),
s AS (SELECT *, greatest(least(bx1, gx1) - greatest(bx0, gx0), 0) * greatest(least(by1, gy1) - greatest(by0, gy0), 0) * greatest(least(bz1, gz1) - greatest(bz0, gz0), 0) AS inter,
   least((bx1 - bx0) * (by1 - by0) * (bz1 - bz0), (gx1 - gx0) * (gy1 - gy0) * (gz1 - gz0)) AS small,
   sqrt((bx1 - bx0) ** 2 + (by1 - by0) ** 2 + (bz1 - bz0) ** 2) AS diag FROM a),
c AS (SELECT case_id, n_garment, n_inside, greatest(0, least(1, 1 - CASE WHEN small > 1e-12 THEN inter / small ELSE 0 END)) AS cl,
   greatest(0, least(1, 1 - (0.7 * n_inside / n_garment + 0.3 * coalesce(md / diag, 0)))) AS pe FROM s)""", """
SELECT case_id, n_garment, n_inside, round(cl::DOUBLE, 6) AS clipping, round(pe::DOUBLE, 6) AS penetration, round((1 - (0.5 * (1 - pe) + 0.5 * (1 - cl)))::DOUBLE, 6) AS violation FROM c"""),
)
def fit_proxy(spark, sf):
    lit = lambda v: F.lit(float(v))
    body = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("case_id"), lit(0.2).alias("x_min"), (0.6 + F.col("s_acctbal") / 40000).alias("x_max"),
        lit(0.1).alias("y_min"), lit(0.9).alias("y_max"), lit(0.01).alias("z_min"), lit(0.08).alias("z_max"),
    )
    out = G.fit_proxy(body, cloud(spark, sf))
    return out.select("case_id", "n_garment", "n_inside", r6("clipping"), r6("penetration"), r6("violation"))


@query(
    "box_from_girths", "A53",
    """
SELECT c_custkey AS case_id, round(w / 2, 6) AS x_max, round(w * 0.8 / 2, 6) AS y_max, 0.3::DOUBLE AS z_max FROM (
  SELECT c_custkey, 2 * greatest(CASE WHEN b > 0 THEN b / 6.283185307179586 ELSE 0.2 END, CASE WHEN wa > 0 THEN wa / 6.283185307179586 ELSE 0.15 END,
     CASE WHEN h > 0 THEN h / 6.283185307179586 ELSE 0.2 END) AS w
  FROM (SELECT c_custkey, c_acctbal / 10000 AS b, c_nationkey / 25.0::DOUBLE AS wa, length(c_mktsegment) / 10.0::DOUBLE AS h FROM customer))""",
)
def box_from_girths(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("case_id"), (F.col("c_acctbal") / 10000).alias("bust"),
        (F.col("c_nationkey") / 25.0).alias("waist"), (F.length("c_mktsegment") / 10.0).alias("hip"),
    )
    return G.box_from_girths(c).select("case_id", r6("x_max"), r6("y_max"), F.col("z_max").cast("double").alias("z_max"))


def _joints(spark, sf):
    at = lambda x, y, z: F.struct(x.alias("x"), y.alias("y"), z.alias("z"))
    lit = lambda v: F.lit(float(v))
    d = F.col("s_acctbal") / 100000
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("case_id"),
        at(lit(0.3) + d, lit(0.8), lit(0.05)).alias("L_shoulder"),
        at(lit(0.7) - d, lit(0.8), lit(0.05)).alias("R_shoulder"),
        at(lit(0.1), lit(0.5), lit(0.05)).alias("L_elbow"),
        at(lit(0.9), lit(0.5), lit(0.05)).alias("R_elbow"),
        at(lit(0.95), lit(0.2), lit(0.04)).alias("R_wrist"),
    )


JOINTS = """jt AS (SELECT s_suppkey AS case_id, 0.3::DOUBLE + s_acctbal / 100000 AS lx, 0.7::DOUBLE - s_acctbal / 100000 AS rx, 0.8::DOUBLE AS sy, 0.05::DOUBLE AS sz,
  0.1::DOUBLE AS lex, 0.9::DOUBLE AS rex, 0.5::DOUBLE AS ey FROM supplier),
rel AS (SELECT c.case_id, c.vertex_id, c.x, c.y, c.z, c.arm_w, j.lx, j.rx, j.sy, j.sz,
  sqrt((lex - lx) ** 2 + (ey - sy) ** 2) AS ll, sqrt((rex - rx) ** 2 + (ey - sy) ** 2) AS rl,
  ((x - lx) * (lex - lx) + (y - sy) * (ey - sy)) / sqrt((lex - lx) ** 2 + (ey - sy) ** 2) AS ls,
  ((x - rx) * (rex - rx) + (y - sy) * (ey - sy)) / sqrt((rex - rx) ** 2 + (ey - sy) ** 2) AS rs,
  (x - lx) ** 2 + (y - sy) ** 2 + (z - sz) ** 2 AS ld2, (x - rx) ** 2 + (y - sy) ** 2 + (z - sz) ** 2 AS rd2
  FROM cloud c JOIN jt j USING (case_id))"""


@query(
    "shoulder_width", "G9",
    with_sql(CLOUD, JOINTS, """
kp AS (SELECT *, CASE WHEN ld2 <= rd2 THEN 'L' ELSE 'R' END AS side,
   round(CASE WHEN ld2 <= rd2 THEN (x - lx) * (lx - 0.5 * (lx + rx)) / abs(lx - 0.5 * (lx + rx)) ELSE (x - rx) * (rx - 0.5 * (lx + rx)) / abs(lx - 0.5 * (lx + rx)) END, 12) AS score
  FROM rel WHERE arm_w < 0.55 AND NOT (
   (ls >= 0.02 * ll AND ls <= 0.95 * ll AND sqrt(greatest(ld2 - ls * ls, 0)) <= (0.33::DOUBLE - 0.11::DOUBLE * greatest(0, least(1, ls / ll))) * ll) OR
   (rs >= 0.02 * rl AND rs <= 0.95 * rl AND sqrt(greatest(rd2 - rs * rs, 0)) <= (0.33::DOUBLE - 0.11::DOUBLE * greatest(0, least(1, rs / rl))) * rl))),
qs AS (SELECT case_id, side, 0 AS i, round(quantile_cont(score, 0.92), 12) AS cut FROM kp GROUP BY 1, 2
  UNION ALL SELECT case_id, side, 1, round(quantile_cont(score, 0.87), 12) FROM kp GROUP BY 1, 2 UNION ALL SELECT case_id, side, 2, round(quantile_cont(score, 0.82), 12) FROM kp GROUP BY 1, 2
  UNION ALL SELECT case_id, side, 3, round(quantile_cont(score, 0.77), 12) FROM kp GROUP BY 1, 2 UNION ALL SELECT case_id, side, 4, round(quantile_cont(score, 0.72), 12) FROM kp GROUP BY 1, 2
  UNION ALL SELECT case_id, side, 5, round(quantile_cont(score, 0.67), 12) FROM kp GROUP BY 1, 2),
nn AS (SELECT q.case_id, q.side, q.i, q.cut, count(*) AS n FROM qs q JOIN kp k ON k.case_id = q.case_id AND k.side = q.side AND k.score >= q.cut GROUP BY 1, 2, 3, 4),
ch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id, side ORDER BY n < 60, CASE WHEN n >= 60 THEN i ELSE -i END) AS rn FROM nn) WHERE rn = 1),
tp AS (SELECT case_id, side, avg(x) AS tx, avg(y) AS ty, avg(z) AS tz FROM (SELECT *, row_number() OVER (PARTITION BY case_id, side ORDER BY score DESC, vertex_id) AS rn FROM kp) WHERE rn <= 10 GROUP BY 1, 2),
mk AS (SELECT c.case_id, c.side, CASE WHEN c.n >= 5 THEN avg(k.x) ELSE min(tx) END AS mx, CASE WHEN c.n >= 5 THEN avg(k.y) ELSE min(ty) END AS my, CASE WHEN c.n >= 5 THEN avg(k.z) ELSE min(tz) END AS mz
  FROM ch c JOIN kp k ON k.case_id = c.case_id AND k.side = c.side AND k.score >= c.cut JOIN tp ON tp.case_id = c.case_id AND tp.side = c.side GROUP BY c.case_id, c.side, c.n)""", """
SELECT j.case_id, round(sqrt((coalesce(l.mx, lx) - coalesce(r.mx, rx)) ** 2 + (coalesce(l.my, sy) - coalesce(r.my, sy)) ** 2 + (coalesce(l.mz, sz) - coalesce(r.mz, sz)) ** 2), 6) AS shoulder_width_m,
  l.mx IS NULL AND r.mx IS NULL AS fallback
FROM jt j LEFT JOIN mk l ON l.case_id = j.case_id AND l.side = 'L' LEFT JOIN mk r ON r.case_id = j.case_id AND r.side = 'R'"""),
)
def shoulder_width(spark, sf):
    return G.shoulder_width(cloud(spark, sf), _joints(spark, sf)).select("case_id", r6("shoulder_width_m"), "fallback")


@query(
    "shoulder_width_plane", "G11",
    with_sql(CLOUD, JOINTS, """
sl AS (SELECT *, (sqrt(ld2) > 0.15 AND abs(ls) > 0.5 * sqrt(ld2) AND ls > 0.2 * ll) OR (sqrt(rd2) > 0.15 AND abs(rs) > 0.5 * sqrt(rd2) AND rs > 0.2 * rl) AS arm,
   (x - lx) * (rx - lx) / abs(rx - lx) AS lat FROM rel WHERE abs(y - sy) <= 0.08),
q AS (SELECT case_id, count(*) AS ns, count(*) FILTER (WHERE NOT arm) AS nt, quantile_cont(lat, 0.95) FILTER (WHERE NOT arm) - quantile_cont(lat, 0.05) FILTER (WHERE NOT arm) AS w FROM sl GROUP BY 1)""", """
SELECT jt.case_id, round(CASE WHEN ns >= 30 AND nt >= 30 THEN w ELSE abs(lx - rx) END, 6) AS shoulder_width_m, NOT coalesce(ns >= 30 AND nt >= 30, false) AS fallback
FROM jt LEFT JOIN q USING (case_id)"""),
)
def shoulder_width_plane(spark, sf):
    return G.shoulder_width_plane(cloud(spark, sf), _joints(spark, sf)).select("case_id", r6("shoulder_width_m"), "fallback")


@query(
    "arm_length_joints", "A51",
    """
SELECT s_suppkey AS case_id, round(sqrt((0.95 - (0.7::DOUBLE - s_acctbal / 100000)) ** 2 + 0.36 + 0.0001) * 1.05::DOUBLE, 6) AS arm_len_m FROM supplier""",
)
def arm_length_joints(spark, sf):
    return G.arm_lengths_from_joints(_joints(spark, sf)).select("case_id", r6("arm_len_m"))
