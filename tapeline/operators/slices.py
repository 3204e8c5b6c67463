"""Horizontal slices of a mesh: which vertices fall in which slice, perimeters, selection.

The band join is arithmetic: a slice index computed from y replaces the scan of every slice. Hulls are
merged like a combiner, in the map task and then batch by batch per slice, so even one slice holding a
third of all vertices is only ever seen as hulls of its parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.operators.components import connected_components
from tapeline.operators.geometry import TOLERANCE_LIMITS, slice_tolerance
from tapeline.operators.scale import join_keys, neighbour
from tapeline.sources.shared import written

N_SLICES = 20
QUANTUM = 1e-6
CONNECT_M = 0.01

# Height bands by key with the rule that picks a slice. ``low`` / ``high`` is the y that
# wins a tie.
CIRC_BANDS = {
    "NECK_CIRC_M": (0.75, 0.90, "median", "high"),
    "BUST_CIRC_M": (0.40, 0.70, "max", "low"),
    "UNDERBUST_CIRC_M": (0.30, 0.60, "median", "high"),
    "WAIST_CIRC_M": (0.42, 0.66, "median", "high"),
    "HIP_CIRC_M": (0.48, 0.78, "max", "low"),
    "THIGH_CIRC_M": (0.20, 0.40, "max", "low"),
    "MIN_CALF_CIRC_M": (0.05, 0.20, "min", "high"),
}
GROUP_BANDS = {"WAIST_GROUP": (0.42, 0.66, "min", "high"), "HIP_GROUP": (0.48, 0.78, "max", "low")}
HIP_CONFIGS = {
    "A": (0.50, 0.80, "max", "low"),
    "B": (0.48, 0.78, "max", "low"),
    "C": (0.50, 0.78, "max", "low"),
    "D": (0.52, 0.80, "max", "low"),
    "E": (0.46, 0.76, "max", "low"),
    "B_high": (0.48, 0.78, "max", "high"),
}
ORDERED_BANDS = {
    "BUST": (0.30, 0.60, "max", "first"),
    "WAIST": (0.40, 0.70, "min", "first"),
    "HIP": (0.50, 0.80, "max", "first"),
}
BUST_UNDERBUST_BANDS = {"UNDERBUST": (0.30, 0.60, "median", "first"), "BUST": (0.40, 0.70, "max", "first")}
PERIMETER_LIMITS = (0.1, 3.0)
SLICE = ["case_id", "key", "slice"]


def band_array(bands: dict) -> Column:
    return F.array(
        *[
            F.struct(F.lit(k).alias("key"), F.lit(float(b[0])).alias("lo"), F.lit(float(b[1])).alias("hi"))
            for k, b in bands.items()
        ]
    )


def slice_points(
    verts: DataFrame, boxes: DataFrame, bands: dict, adaptive: bool = True, axis: str = "y",
    lo: str = "y_min", span: str = "span_y", n_slices: int = N_SLICES,
) -> DataFrame:
    """Vertices with the (key, slice) they belong to: ``|y - y_k| < tolerance``.

    ``adaptive`` widens or limits the tolerance by the mesh scale. Start, step and tolerance of a band are computed once per
    case, not per vertex. The few slices a vertex can touch follow from its height, so nothing is compared with slices it
    cannot be in.
    """
    cols = ["case_id", *dict.fromkeys([lo, span, "span_x", "span_y", "span_z"])]
    b = boxes.select(*cols, F.explode(band_array(bands)).alias("b")).where(F.col(span) >= 1e-6)
    start = F.col(lo) + F.col("b.lo") * F.col(span)
    end = F.col(lo) + F.col("b.hi") * F.col(span)
    b = b.withColumns({"_start": start, "_end": end}).withColumn("_step", (F.col("_end") - F.col("_start")) / (n_slices - 1))
    base = F.col("_step") * 0.5
    b = b.select(
        "case_id", F.col("b.key").alias("key"), "_start", "_end", "_step", (slice_tolerance(base) if adaptive else base).alias("tolerance")
    )
    e = verts.select("case_id", "vertex_id", "x", "y", "z", F.col(axis).alias("_at")).join(b, "case_id")
    e = e.where((F.col("_at") > F.col("_start") - 2 * F.col("tolerance")) & (F.col("_at") < F.col("_end") + 2 * F.col("tolerance")))
    first = F.greatest(F.floor((F.col("_at") - F.col("tolerance") - F.col("_start")) / F.col("_step")).cast("int"), F.lit(0))
    last = F.least(
        F.ceil((F.col("_at") + F.col("tolerance") - F.col("_start")) / F.col("_step")).cast("int"), F.lit(n_slices - 1)
    )
    e = e.withColumns({"_i0": first, "_i1": last}).where(F.col("_i0") <= F.col("_i1"))
    e = e.withColumn("slice", F.explode(F.sequence("_i0", "_i1"))).withColumn(
        "y_slice", F.col("_start") + F.col("slice") * F.col("_step")
    )
    e = e.where(F.abs(F.col("_at") - F.col("y_slice")) < F.col("tolerance"))
    return e.select("case_id", "key", "slice", "y_slice", "tolerance", "vertex_id", "x", "y", "z")


# --- convex hulls ---------------------------------------------------------------------------------

PASS_POINTS = 48
HELD_POINTS = 200_000  # hull points a map task holds before it passes them on
FAN_IN = 64  # map tasks whose hulls of a group meet first


def chain(pts: list) -> list:
    """Hull of sorted distinct points, counter-clockwise. Fewer than three points come back as they are;
    collinear points as their two ends and one more, so a merged hull still knows it had three."""
    if len(pts) < 3:
        return pts

    def half(seq):
        out = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (
                p[0] - out[-2][0]
            ):
                out.pop()
            out.append(p)
        return out[:-1]

    ring = half(pts) + half(pts[::-1])
    return ring if len(ring) > 2 else [pts[0], pts[len(pts) // 2], pts[-1]]


def hull(pts: np.ndarray) -> list:
    """Hull of any 2-D points; points inside the polygon of a few extreme ones are dropped first."""
    pts = np.unique(pts, axis=0)
    if len(pts) > PASS_POINTS:
        angles = np.linspace(0, 2 * np.pi, 16, endpoint=False)
        ext = pts[np.unique(np.argmax(pts @ np.vstack([np.cos(angles), np.sin(angles)]), axis=0))]
        ring = np.array(chain([tuple(p) for p in np.unique(ext, axis=0).tolist()]))
        inside = np.ones(len(pts), dtype=bool)
        for p, q in zip(ring, np.roll(ring, -1, axis=0)):
            inside &= (q[0] - p[0]) * (pts[:, 1] - p[1]) - (q[1] - p[1]) * (pts[:, 0] - p[0]) > 1e-12
        pts = pts[~inside]
    return chain([tuple(p) for p in pts.tolist()])


def ring_area(ring: list) -> float:
    if len(ring) < 3:
        return 0.0
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))) / 2


def ring_length(ring: list) -> float | None:
    """Closed length of a hull, None under three points; collinear points count there and back."""
    if len(ring) < 3:
        return None
    total = sum(((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5 for p, q in zip(ring, ring[1:] + ring[:1]))
    return total if total > 2e-6 else None


def _runs(pdf: pd.DataFrame, keys: Sequence[str]) -> list[tuple[int, int]]:
    """Start and end of each run of equal keys."""
    new = np.zeros(len(pdf), dtype=bool)
    new[:1] = True
    for k in keys:
        c = pdf[k].to_numpy()
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return list(zip(at.tolist(), [*at[1:].tolist(), len(pdf)]))


def _thin(keys: list[str]):
    """Crowded groups of a task shrink to their hull, batch by batch: the combiner of the hull. Other points pass."""

    def rows(key, points: list, w: int) -> pd.DataFrame:
        px, pz = map(list, zip(*points))
        return pd.DataFrame({**dict(zip(keys, key)), "px": px, "pz": pz, "w": [w] + [0] * (len(px) - 1)})[[*keys, "px", "pz", "w"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[list, int]] = {}
        for batch in batches:
            largest = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate([([], "count_all")])["count_all"]
            if max(largest.to_pylist(), default=0) <= PASS_POINTS:
                yield batch
                continue
            send = lambda df, schema=batch.schema: pa.RecordBatch.from_pandas(df, schema=schema, preserve_index=False)
            pdf = batch.to_pandas()
            sizes = pdf.groupby(keys, sort=False, dropna=False)["px"].transform("size")
            small = pdf[sizes <= PASS_POINTS]
            if len(small):
                yield send(small)
            for key, part in pdf[sizes > PASS_POINTS].groupby(keys, sort=False, dropna=False):
                points, w = held.get(key, ([], 0))
                held[key] = hull(np.array(points + list(zip(part["px"].tolist(), part["pz"].tolist())))), w + int(part["w"].sum())
            if sum(len(points) for points, _ in held.values()) > HELD_POINTS:
                yield send(pd.concat([rows(key, *h) for key, h in held.items()]))
                held = {}
        if held:
            yield send(pd.concat([rows(key, *h) for key, h in held.items()]))

    return run


def _convex(run: np.ndarray, x: np.ndarray, z: np.ndarray, side: int) -> np.ndarray:
    """Places of the lower (``side`` 1) or upper (-1) hull of each run of distinct points in order, for all runs at once: a
    point on or behind the line of its neighbours is none of it, and is dropped until no point is."""
    at = np.arange(len(run))
    while len(at) > 2:
        px, pz, r = x[at], z[at], run[at]
        cross = (px[1:-1] - px[:-2]) * (pz[2:] - pz[:-2]) - (pz[1:-1] - pz[:-2]) * (px[2:] - px[:-2])
        drop = (r[:-2] == r[2:]) & (side * cross <= 0)
        if not drop.any():
            break
        at = at[np.concatenate([[True], ~drop, [True]])]
    return at


def _measure_runs(run: np.ndarray, x: np.ndarray, z: np.ndarray, n_runs: int) -> dict[str, np.ndarray]:
    """Perimeter, area, size and extents of the hull of each run of 2-D points."""
    order = np.lexsort((z, x, run))
    run, x, z = run[order], x[order], z[order]
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (x[1:] != x[:-1]) | (z[1:] != z[:-1])
    run, x, z = run[new], x[new], z[new]
    distinct = np.bincount(run, minlength=n_runs)
    length, area, size = np.zeros(n_runs), np.zeros(n_runs), np.full(n_runs, -2)
    ends = np.concatenate([[0], np.cumsum(distinct)])
    x0, z0 = x[ends[:-1]], z[ends[:-1]]
    for side in (1, -1):
        at = _convex(run, x, z, side)
        r, px, pz = run[at], x[at], z[at]
        same = r[1:] == r[:-1]
        dx, dz = px[1:] - px[:-1], pz[1:] - pz[:-1]
        length += np.bincount(r[1:][same], np.sqrt(dx * dx + dz * dz)[same], n_runs)
        here = r[:-1]
        turn = (px[:-1] - x0[here]) * (pz[1:] - z0[here]) - (px[1:] - x0[here]) * (pz[:-1] - z0[here])
        area += np.bincount(here[same], (side * turn)[same], n_runs)
        size += np.bincount(r, minlength=n_runs)
    return {
        "perimeter_m": np.where((distinct > 2) & (length > 2e-6), length, np.nan),
        "hull_area_m2": np.where(distinct > 2, np.abs(area) / 2, 0.0),
        "n_hull": np.where(distinct > 2, np.maximum(size, 3), distinct),
        "width_m": x[ends[1:] - 1] - x0,
        "depth_m": np.maximum.reduceat(z, ends[:-1]) - np.minimum.reduceat(z, ends[:-1]),
    }


def _finish(keys: list[str]):
    """Measure the hull of each group from rows sorted by group, all groups of a batch at once; a long group keeps only its
    hull, and the last group of a batch waits for the next."""
    names = [*keys, "n_points", "perimeter_m", "hull_area_m2", "n_hull", "width_m", "depth_m", "error"]

    def shrunk(pdf: pd.DataFrame, spans: list[tuple[int, int]]) -> tuple[pd.DataFrame, list[tuple[int, int]]]:
        """Groups past ``PASS_POINTS`` as their hull, whose first row counts for all."""
        if all(hi - lo <= PASS_POINTS for lo, hi in spans):
            return pdf, spans
        parts = []
        for lo, hi in spans:
            part = pdf.iloc[lo:hi]
            if hi - lo > PASS_POINTS:
                ring = np.array(hull(part[["px", "pz"]].to_numpy()))
                n = int(part["w"].sum())
                part = part.iloc[: len(ring)].assign(px=ring[:, 0], pz=ring[:, 1], w=[n] + [0] * (len(ring) - 1))
            parts.append(part)
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return pd.concat(parts, ignore_index=True), list(zip([0, *ends[:-1]], ends))

    def measured(pdf: pd.DataFrame, spans: list[tuple[int, int]]) -> pd.DataFrame:
        starts = np.array([lo for lo, _ in spans])
        out = pdf.iloc[starts][keys].reset_index(drop=True)
        out["n_points"] = np.add.reduceat(pdf["w"].to_numpy(), starts)
        run = np.repeat(np.arange(len(spans)), [hi - lo for lo, hi in spans])
        # One bad group must not stop the others: it becomes a NULL value with a reason.
        try:
            values = _measure_runs(run, pdf["px"].to_numpy(), pdf["pz"].to_numpy(), len(spans))
            return out.assign(**values, error=None)[names]
        except (ArithmeticError, ValueError, TypeError, IndexError) as e:
            if len(spans) > 1:
                return pd.concat([measured(pdf.iloc[lo:hi], [(0, hi - lo)]) for lo, hi in spans])
            return out.assign(perimeter_m=np.nan, hull_area_m2=np.nan, n_hull=len(pdf), width_m=np.nan, depth_m=np.nan, error=f"EXEC_FAIL:{type(e).__name__}")[names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            if not len(pdf):
                continue
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            pdf, spans = shrunk(pdf, _runs(pdf, keys))
            held = pdf.iloc[spans[-1][0] :]
            if len(spans) > 1:
                yield measured(pdf.iloc[: spans[-1][0]], spans[:-1])
        if held is not None:
            yield measured(held, [(0, len(held))])

    return run


def _key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)


def hull_measures(points: DataFrame, keys: Sequence[str], u: str = "x", v: str = "z") -> DataFrame:
    """Hull perimeter, area and extents of each group of 2-D points (quantised to a micron).

    Hulls combine like sums, as a tree: in the map task, then those of ``FAN_IN`` map tasks, then all. So a
    task receives the hulls of a group, a few hundred points each, of some map tasks or of some such parts,
    and folds them batch by batch; no task ever sees a whole group.
    """
    keys = list(keys)
    flat = points.select(
        *keys,
        (F.rint(F.col(u) / QUANTUM) * QUANTUM).alias("px"),
        (F.rint(F.col(v) / QUANTUM) * QUANTUM).alias("pz"),
        F.lit(1).cast("bigint").alias("w"),
    )
    ks = _key_schema(points, keys)
    shape = f"{ks}, px double, pz double, w long"
    near = F.floor(F.spark_partition_id() / FAN_IN).alias("_part")
    parts = flat.mapInArrow(_thin(keys), shape).select("*", near).repartition(*keys, "_part").drop("_part").mapInArrow(_thin(keys), shape)
    return (
        parts.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInPandas(
            _finish(keys),
            f"{ks}, n_points long, perimeter_m double, hull_area_m2 double, n_hull long, width_m double, depth_m double, error string",
        )
    )


def slice_table(points: DataFrame) -> DataFrame:
    """One row per (case, key, slice): height, vertex count, hull perimeter, width and depth."""
    return hull_measures(points, [*SLICE, "y_slice"]).where(F.col("n_points") >= 3)


def select_slice(slices: DataFrame, bands: dict, size: str = "perimeter_m", digits: int = 9) -> DataFrame:
    """Pick one slice per (case, key): largest, smallest, or closest to the median perimeter.

    At most twenty slices per group; compared after rounding so that ties are ties on every plan.
    """
    picked, keep = _picked(slices.where(F.col(size).isNotNull()), bands, size, digits)
    return picked.select("case_id", "key", *[F.col("b")[c].alias(c) for c in keep])


def _picked(slices: DataFrame, bands: dict, size: str = "perimeter_m", digits: int = 9, *also: Column) -> tuple[DataFrame, list[str]]:
    """(case, key, b) with the picked slice as the struct ``b`` (NULL where none has a size) and further aggregates over
    all slices of the band, so that the slices are computed once; and the fields of ``b``."""
    rules = band_rules(slices.sparkSession, bands)
    twenty = Window.partitionBy("case_id", "key")
    s = slices.withColumn("_p", F.round(size, digits)).withColumns(
        {"_med": F.percentile("_p", F.lit(0.5)).over(twenty), "n_candidates": F.count("_p").over(twenty)}
    )
    s = s.join(F.broadcast(rules), "key")
    miss = (
        F.when(F.col("rule") == "max", -F.col("_p"))
        .when(F.col("rule") == "min", F.col("_p"))
        .otherwise(F.round(F.abs(F.col("_p") - F.col("_med")), digits))
    )
    tie = F.when(F.col("tie") == "high", -F.col("slice")).otherwise(F.col("slice"))
    keep = [*[c for c in slices.columns if c not in ("case_id", "key")], "n_candidates"]
    best = F.min_by(F.struct(*keep), F.when(F.col("_p").isNotNull(), F.struct(miss.alias("m"), tie.alias("t"))))
    return s.groupBy("case_id", "key").agg(best.alias("b"), *also), keep


def band_rules(spark, bands: dict) -> DataFrame:
    return spark.createDataFrame([(k, b[2], b[3]) for k, b in bands.items()], "key string, rule string, tie string")


def circumferences(verts: DataFrame, boxes: DataFrame, bands: dict | None = None) -> DataFrame:
    """Circumference per case and key: 20 slices in the key's height band, one selected."""
    bands = bands or CIRC_BANDS
    return select_slice(slice_table(slice_points(verts, boxes, bands)), bands)


def measurement_outcomes(verts: DataFrame, boxes: DataFrame, bands: dict | None = None) -> DataFrame:
    """One row per (case, key), measured or not: value, and why there is none."""
    bands = bands or CIRC_BANDS
    picked, _ = _picked(slice_table(slice_points(verts, boxes, bands)), bands, "perimeter_m", 9, F.min("error").alias("failed"))
    names = F.explode(F.array(*[F.lit(k) for k in bands])).alias("key")
    code = (
        F.when(F.col("span_y") < 1e-6, "BODY_AXIS_TOO_SHORT")
        .when(F.col("perimeter_m").isNull(), F.coalesce("failed", F.lit("EMPTY_CANDIDATES")))
        .when(F.col("key") == "MIN_CALF_CIRC_M", "MIN_SEARCH_USED")
    )
    return (
        boxes.select("case_id", "span_y", names)
        .join(picked.select("case_id", "key", "b.perimeter_m", "b.n_candidates", "failed"), ["case_id", "key"], "left")
        .select("case_id", F.col("key").alias("standard_key"), F.col("perimeter_m").alias("value"), "n_candidates", code.alias("code"))
    )


def shared_slices(verts: DataFrame, boxes: DataFrame) -> DataFrame:
    """Waist and hip groups: one slice table, one slice per group, three values from that slice."""
    picked = circumferences(verts, boxes, GROUP_BANDS)
    part = F.regexp_extract("key", "^([A-Z]+)_", 1)
    values = F.array(
        *[
            F.struct(F.concat(part, F.lit(f"_{n}_M")).alias("standard_key"), F.col(c).alias("value_m"))
            for n, c in (("CIRC", "perimeter_m"), ("WIDTH", "width_m"), ("DEPTH", "depth_m"))
        ]
    )
    return picked.select("case_id", "slice", "y_slice", F.inline(values))


def pelvis_heights(verts: DataFrame, frames: DataFrame, up: Sequence[float] = (0.0, 1.0, 0.0)) -> DataFrame:
    """Vertices in the pelvis frame: height ``h`` on the up axis and two in-plane coordinates."""
    u = np.asarray(up, dtype=float)
    u = u / np.linalg.norm(u)
    e1 = np.cross(u, [1.0, 0.0, 0.0] if abs(u[0]) < 0.9 else [0.0, 0.0, 1.0])
    e1 = e1 / np.linalg.norm(e1)
    e2 = np.cross(u, e1)
    rel = [F.col(c) - F.col(f"o{c}") for c in "xyz"]
    on = lambda a: rel[0] * float(a[0]) + rel[1] * float(a[1]) + rel[2] * float(a[2])
    return verts.join(frames.select("case_id", "ox", "oy", "oz"), "case_id").select(
        "case_id", "vertex_id", on(e1).alias("x"), on(u).alias("y"), on(e2).alias("z")
    )


# --- ordered sums ---------------------------------------------------------------------------------


def ordered_rings(
    points: DataFrame, keys: Sequence[str], u: str = "x", v: str = "z", block: int = 50_000, chunk: Column | None = None
) -> DataFrame:
    """Perimeter and shoelace area of points taken in vertex order, the last joined to the first.

    ``chunk`` must not decrease along ``vertex_id``; without it vertex numbers are cut into blocks.
    """
    chunk = F.floor(F.col("vertex_id") / block) if chunk is None else chunk
    nxt = neighbour(points.select(*keys, "vertex_id", u, v), keys, ["vertex_id"], [u, v], chunk, True, "n_")
    du, dv = F.col(f"n_{u}") - F.col(u), F.col(f"n_{v}") - F.col(v)
    agg = nxt.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.coalesce(F.sum(F.sqrt(du * du + dv * dv)), F.lit(0.0)).alias("_len"),
        F.coalesce(F.sum(F.col(u) * F.col(f"n_{v}") - F.col(f"n_{u}") * F.col(v)), F.lit(0.0)).alias("_twice"),
        F.min_by(F.struct(u, v), "vertex_id").alias("_a"),
        F.max_by(F.struct(u, v), "vertex_id").alias("_b"),
    )
    a, b = F.col("_a"), F.col("_b")
    du, dv = a[u] - b[u], a[v] - b[v]
    enough = F.col("n_points") >= 3
    return agg.select(
        *keys, "n_points",
        F.when(enough, F.col("_len") + F.sqrt(du * du + dv * dv)).alias("perimeter_m"),
        F.when(enough, F.abs(F.col("_twice") + b[u] * a[v] - a[u] * b[v]) / 2).alias("area_m2"),
    )


def loop_quality(rings: DataFrame) -> DataFrame:
    """Area, perimeter^2 / area and validity of an ordered loop."""
    area = F.col("area_m2")
    return rings.withColumn(
        "shape_ratio", F.when(area > 1e-10, F.col("perimeter_m") * F.col("perimeter_m") / area)
    ).withColumn(
        "validity", F.when(area.isNull(), "TOO_FEW_POINTS").when(area < 1e-10, "EMPTY").otherwise("VALID")
    )


def ordered_circumferences(verts: DataFrame, boxes: DataFrame, bands: dict | None = None, chunk: Column | None = None) -> DataFrame:
    """Ordered-sum variant: vertex order kept, no tolerance from the mesh scale, limit codes."""
    bands = bands or ORDERED_BANDS
    pts = slice_points(verts, boxes, bands, adaptive=False)
    rings = ordered_rings(pts, [*SLICE, "y_slice"], chunk=chunk).where(F.col("n_points") >= 3)
    picked = select_slice(rings, bands)
    code = F.when(F.col("perimeter_m") < PERIMETER_LIMITS[0], "PERIMETER_SMALL").when(
        F.col("perimeter_m") > PERIMETER_LIMITS[1], "PERIMETER_LARGE"
    )
    section = F.concat_ws(":", F.lit("y"), F.col("slice").cast("string"), F.format_number("y_slice", 6))
    return picked.withColumns({"code": code, "section_id": section})


# --- connected parts of a slice -------------------------------------------------------------------


def _meet(limit: int):
    """The pairs of cells (rows with the points of both, ``p`` and ``q``) that hold two points closer than the limit."""

    def points(column: pa.Array) -> list[np.ndarray]:
        flat = column.flatten()
        xz = np.column_stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("qx", "qz")])
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        return np.split(xz, ends[:-1])

    def near(a: np.ndarray, b: np.ndarray) -> bool:
        for _ in range(2):  # only what is near the other cell's box can count
            a = a[((a > b.min(axis=0) - limit) & (a < b.max(axis=0) + limit)).all(axis=1)]
            if not len(a):
                return False
            a, b = b, a
        for lo in range(0, len(a), 256):
            d = a[lo : lo + 256, None, :] - b[None, :, :]
            if ((d * d).sum(axis=2) < limit * limit).any():
                return True
        return False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                met = [near(a, b) for a, b in zip(points(part.column("p")), points(part.column("q")))]
                yield part.filter(pa.array(met, pa.bool_())).drop_columns(["p", "q"])

    return run


def cell_table(points: DataFrame, connect: float) -> DataFrame:
    """One row per slice and grid cell: vertex count and sums, extent in microns, and its outermost points.

    A cell's diagonal is ``connect``, so its vertices are one part. Whether two cells meet depends only on the first and last
    vertex per micron row and column of each: as many points as the cell has microns along its sides, at most.
    """
    cell = connect / 2**0.5
    q = points.select(
        *SLICE, "x", "z",
        F.round(F.col("x") / QUANTUM).cast("bigint").alias("qx"),
        F.round(F.col("z") / QUANTUM).cast("bigint").alias("qz"),
    ).withColumns(
        {
            "cx": F.floor(F.col("qx") * QUANTUM / cell).cast("bigint"),
            "cz": F.floor(F.col("qz") * QUANTUM / cell).cast("bigint"),
        }
    )
    g = [*SLICE, "cx", "cz"]
    sums = [F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("z").alias("sz")]
    none = [F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sz")]
    ends = lambda c: F.array_distinct(F.array(F.min(c), F.max(c)))
    rows = q.groupBy(*g, "qz").agg(*sums, ends("qx").alias("a")).select(
        *g, "n", "sx", "sz", F.transform("a", lambda x: F.struct(x.alias("qx"), F.col("qz"))).alias("p")
    )
    cols = q.groupBy(*g, "qx").agg(ends("qz").alias("a")).select(
        *g, *none, F.transform("a", lambda z: F.struct(F.col("qx"), z.alias("qz"))).alias("p")
    )
    merged = rows.unionByName(cols).groupBy(*g).agg(
        F.sum("n").alias("n"), F.sum("sx").alias("sx"), F.sum("sz").alias("sz"), F.array_distinct(F.flatten(F.collect_list("p"))).alias("p")
    )
    extent = {f"{m}_{c}": (F.array_min if m == "lo" else F.array_max)(F.col(f"p.{c}")) for c in ("qx", "qz") for m in ("lo", "hi")}
    return merged.withColumns(extent).withColumn("node", F.shiftleft("cx", 32) + F.col("cz"))


def slice_parts(points: DataFrame, connect: float = CONNECT_M) -> DataFrame:
    """Connected parts of each slice: vertices closer than ``connect`` belong together.

    Vertices become grid cells (:func:`cell_table`). Each cell meets its occupied neighbours by an equi-join on
    cell coordinates; the extents settle most pairs, the outermost points the others. Components of the cells are
    settled in rounds, and hulls fold per part. No task holds a slice.
    """
    limit = round(connect / QUANTUM)
    cells = written(cell_table(points, connect))
    ahead = [(dx, dz) for dx in range(0, 3) for dz in range(-2, 3) if (dx, dz) > (0, 0)]
    offsets = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dz).alias("dz")) for dx, dz in ahead])).alias("o")
    extent = ["lo_qx", "hi_qx", "lo_qz", "hi_qz"]
    light = cells.select(*SLICE, "cx", "cz", "node", *extent)
    shifted = light.select("*", offsets).select(
        *SLICE, (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cz") + F.col("o.dz")).alias("cz"), F.col("node").alias("a"),
        *[F.col(c).alias(f"a_{c}") for c in extent],
    )
    pairs = join_keys(shifted, light.withColumnRenamed("node", "b"), [*SLICE, "cx", "cz"], hint="merge")
    gap2 = far2 = F.lit(0).cast("bigint")
    for c in ("qx", "qz"):
        gap = F.greatest(F.col(f"lo_{c}") - F.col(f"a_hi_{c}"), F.col(f"a_lo_{c}") - F.col(f"hi_{c}"), F.lit(0))
        far = F.greatest(f"hi_{c}", f"a_hi_{c}") - F.least(f"lo_{c}", f"a_lo_{c}")
        gap2, far2 = gap2 + gap * gap, far2 + far * far
    pairs = pairs.where(gap2 < limit * limit).select(*SLICE, "a", "b", (far2 < limit * limit).alias("sure"))
    unsure = pairs.where("NOT sure").drop("sure")
    for side, name in (("a", "p"), ("b", "q")):
        unsure = join_keys(unsure, cells.select(*SLICE, F.col("node").alias(side), F.col("p").alias(name)), [*SLICE, side], hint="merge")
    unsure = unsure.select(*SLICE, "a", "b", "p", "q")
    met = unsure.mapInArrow(_meet(limit), unsure.drop("p", "q").schema)
    found = connected_components(pairs.where("sure").drop("sure").unionByName(met), SLICE)
    parted = join_keys(cells, found, [*SLICE, "node"], "left", "merge").withColumn("part", F.coalesce("component", "node"))
    by = [*SLICE, "part"]
    sums = parted.groupBy(*by).agg(F.sum("n").alias("n_points"), F.sum("sx").alias("_sx"), F.sum("sz").alias("_sz")).where("n_points >= 3")
    outline = parted.select(*by, F.inline("p")).select(*by, (F.col("qx") * QUANTUM).alias("x"), (F.col("qz") * QUANTUM).alias("z"))
    rings = hull_measures(outline, by).select(*by, F.col("hull_area_m2").alias("area_m2"), "perimeter_m")
    return join_keys(sums, rings, by, hint="merge").select(
        *SLICE, "n_points", "area_m2", "perimeter_m", (F.col("_sx") / F.col("n_points")).alias("centre_x"), (F.col("_sz") / F.col("n_points")).alias("centre_z")
    )


def torso_part(parts: DataFrame, boxes: DataFrame) -> DataFrame:
    """The part nearest the body centre (then larger area, larger perimeter, smaller centre) of each
    slice, whether that took a tie-break, and the spread of area and perimeter over its parts.

    A slice has few parts (limbs), so they are ranked and summarised per slice directly.
    """
    dx, dz = F.col("centre_x") - F.col("x_mean"), F.col("centre_z") - F.col("z_mean")
    whole = Window.partitionBy(*SLICE)
    d = parts.join(boxes.select("case_id", "x_mean", "z_mean"), "case_id").withColumn(
        "centre_distance", F.sqrt(dx * dx + dz * dz)
    )
    d = d.withColumn("_d", F.round("centre_distance", 6)).withColumn("_first", F.min("_d").over(whole))
    order = F.struct(
        F.col("_d"), (-F.round("area_m2", 6)).alias("a"), (-F.round("perimeter_m", 6)).alias("p"),
        F.round("centre_x", 9).alias("x"), F.round("centre_z", 9).alias("z"),
    )
    fields = ["n_points", "area_m2", "perimeter_m", "centre_x", "centre_z", "centre_distance"]
    aggs = [
        F.count(F.lit(1)).alias("n_parts"),
        F.min_by(F.struct(*fields), order).alias("b"),
        (F.count_if(F.col("_d") == F.col("_first")) > 1).alias("tie_used"),
    ]
    for c, n in (("area_m2", "area"), ("perimeter_m", "perimeter")):
        d = d.withColumn(f"_{n}", F.row_number().over(whole.orderBy(F.desc(c), "centre_x", "centre_z")))
        top = F.array_sort(F.collect_list(F.when(F.col(f"_{n}") <= 3, F.struct(F.col(f"_{n}").alias("r"), F.format_number(c, 6).alias("t")))))
        aggs += [
            F.min(c).alias(f"{n}_min"), F.max(c).alias(f"{n}_max"),
            F.percentile(c, F.lit(0.5)).alias(f"{n}_p50"), F.percentile(c, F.lit(0.95)).alias(f"{n}_p95"),
            F.array_join(F.transform(top, lambda s: s["t"]), "|").alias(f"{n}_top3"),
        ]
    out = d.groupBy(*SLICE).agg(*aggs)
    return out.select(*SLICE, "b.*", *[c for c in out.columns if c not in (*SLICE, "b")])
