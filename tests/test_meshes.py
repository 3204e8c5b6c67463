"""Mesh operators on groups that hold a large share of all rows, and against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tapeline.operators import geometry as G
from tapeline.operators import slices as L
from tapeline.operators.components import connected_components


def brute_components(edges):
    label = {}
    for a, b in edges:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(7)
    edges = [("r", int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2)) if a != b]
    edges += [("path", i, i + 1) for i in rng.permutation(500).tolist()] + [("star", 0, i) for i in range(1, 200)]
    edges += [(None, 5, 3), (None, 3, 9), ("loop", 4, 4), ("r", 1, 2), ("r", 1, 2)]
    got = connected_components(spark.createDataFrame(edges, "g string, a long, b long").repartition(9), ["g"]).collect()
    want = {g: brute_components([(a, b) for k, a, b in edges if k == g and a != b]) for g in {e[0] for e in edges}}
    assert sorted((str(r.g), r.node, r.component) for r in got) == sorted((str(g), n, c) for g, label in want.items() for n, c in label.items())
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def part_sizes(pts, limit):
    q = np.round(pts / 1e-6).astype(np.int64)
    left, sizes = set(range(len(q))), []
    while left:
        todo, part = [left.pop()], 0
        while todo:
            i = todo.pop()
            part += 1
            rest = np.array(sorted(left), dtype=int)
            near = rest[((q[rest] - q[i]) ** 2).sum(axis=1) < limit**2].tolist() if len(rest) else []
            left -= set(near)
            todo += near
        if part >= 3:
            sizes.append(part)
    return sorted(sizes)


def test_parts_of_a_slice_with_a_third_of_all_vertices(spark):
    """A ring of many cells, a spot inside it and far specks, beside many small slices."""
    rng = np.random.default_rng(8)
    angle = rng.uniform(0, 2 * np.pi, 4000)
    ring = np.column_stack([np.cos(angle), np.sin(angle)]) * rng.uniform(0.29, 0.31, (4000, 1))
    pts = np.round(np.vstack([ring, rng.normal(0, 0.01, (500, 2)), [[2, 2], [2.004, 2], [2.002, 2.003], [3, 3]]]), 6)
    rows = [("hot", "K", 0, float(x), float(z)) for x, z in pts]
    rows += [(f"c{i}", "K", i % 5, float(x), float(z)) for i in range(90) for x, z in np.round(rng.normal(0, 0.02, (100, 2)), 6)]
    d = spark.createDataFrame(rows, "case_id string, key string, slice int, x double, z double").repartition(12)
    parts = L.slice_parts(d, 0.01).collect()
    assert sorted(p.n_points for p in parts if p.case_id == "hot") == part_sizes(pts, 10_000)
    small = np.array([(x, z) for c, _, _, x, z in rows if c == "c7"])
    assert sorted(p.n_points for p in parts if p.case_id == "c7") == part_sizes(small, 10_000)
    whole = max((p for p in parts if p.case_id == "hot"), key=lambda p: p.n_points)
    assert whole.area_m2 == pytest.approx(np.pi * 0.31**2, rel=0.01) and abs(whole.centre_x) < 0.02


def test_hull_tree_keeps_tasks_small(spark, monkeypatch):
    """Hulls of a group from many map tasks meet in parts first; values are those of all points at once."""
    monkeypatch.setattr(L, "FAN_IN", 2)
    monkeypatch.setattr(L, "HELD_POINTS", 100)
    rng = np.random.default_rng(9)
    pts = np.round(rng.normal(size=(30_000, 2)), 4)
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", float(x), float(z)) for i, (x, z) in enumerate(pts)]
    d = spark.createDataFrame(rows, "g string, x double, z double").repartition(24)
    got = {r.g: r for r in L.hull_measures(d, ["g"]).collect()}
    for g in ("hot", "g7"):
        own = np.array([(x, z) for k, x, z in rows if k == g])
        ring = L.chain([tuple(p) for p in np.unique(own, axis=0).tolist()])
        assert got[g].perimeter_m == pytest.approx(L.ring_length(ring), abs=1e-9) and got[g].n_points == len(own)
        assert got[g].hull_area_m2 == pytest.approx(L.ring_area(ring), abs=1e-9)
    plan = L.hull_measures(d, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(g") == 2


def test_fit_proxy_matches_small_tables_only(spark):
    box = "case_id string, x_min double, x_max double, y_min double, y_max double, z_min double, z_max double"
    boxes = spark.createDataFrame([("a", 0.0, 1.0, 0.0, 1.0, 0.0, 1.0), ("bare", 0.0, 1.0, 0.0, 1.0, 0.0, 1.0), (None, 0.0, 1.0, 0.0, 1.0, 0.0, 1.0)], box)
    worn = [("a", 0.5, 0.5, 0.5), ("a", 2.0, 0.5, 0.5), ("loose", 0.1, 0.1, 0.1), (None, 0.2, 0.5, 0.5)]
    garment = spark.createDataFrame(worn, "case_id string, x double, y double, z double")
    out = G.fit_proxy(boxes, garment)
    got = {r.case_id: r for r in out.collect()}
    assert len(got) == 4 and (got["a"].n_garment, got["a"].n_inside) == (2, 1)
    assert (got["bare"].n_garment, got["bare"].clipping) == (0, 0.5) and (got["loose"].n_garment, got["loose"].penetration) == (1, 0.5)
    assert (got[None].n_garment, got[None].n_inside) == (1, 1)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("FullOuter"):]
    assert "Aggregate" in below.split("LeftOuter")[0]


def test_full_join_is_past_the_sums(spark):
    """A case with most vertices is summed up before the two sides are matched."""
    garment = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("case_id"), (F.col("id") / 3000).alias("x"), F.lit(0.5).alias("y"), F.lit(0.5).alias("z"))
    boxes = spark.createDataFrame([("hot", 0.0, 0.5, 0.0, 1.0, 0.0, 1.0)], "case_id string, x_min double, x_max double, y_min double, y_max double, z_min double, z_max double")
    hot = G.fit_proxy(boxes, garment).where("case_id = 'hot'").first()
    assert hot.n_garment == 1000 and hot.n_inside == 501


def test_cells_of_slices_are_not_sent_to_every_task(spark):
    """Cell tables grow with the input; their files are small for what they hold, so none may be broadcast."""
    rows = [("a", "K", s, v, 0.004 * v, 0.002 * (v % 5)) for s in range(3) for v in range(60)]
    points = spark.createDataFrame(rows, "case_id string, key string, slice int, vertex_id long, x double, z double")
    parts = L.slice_parts(points)
    assert "Broadcast" not in parts._jdf.queryExecution().executedPlan().toString()
    assert [r.n_points for r in parts.collect()] == [60, 60, 60]


def test_vertices_between_both_shoulders_go_to_the_side_sql_takes(spark, tmp_path):
    """Such a vertex is as far from one as from the other; the square's last bit decides, and rounds differently in ``pow``."""
    import duckdb
    from oracle_check import compare
    from tapeline.plans import catalogue

    sf, prices = str(tmp_path), [29672.53, 20895.2, 14685.43]
    con = duckdb.connect()
    con.execute("CREATE TABLE supplier AS SELECT 10 * i + g AS s_suppkey, 7483.2 + i::DOUBLE AS s_acctbal FROM range(40) t(i), range(3) u(g)")
    con.execute(f"""CREATE TABLE lineitem AS SELECT 10 * i + g AS l_suppkey, 1 AS l_orderkey, n + 1 AS l_linenumber, 1 AS l_partkey,
      (CASE n WHEN 0 THEN 25 WHEN 1 THEN 20 ELSE 35 END)::DOUBLE AS l_quantity, ({prices})[g + 1]::DOUBLE + 10 * n AS l_extendedprice,
      [0.03, 0.08, 0.08][g + 1]::DOUBLE AS l_discount, 0.0::DOUBLE AS l_tax FROM range(40) t(i), range(3) u(g), range(3) w(n)""")
    for t in ("supplier", "lineitem"):
        con.execute(f"COPY {t} TO '{sf}/{t}.parquet' (FORMAT parquet)")
    assert compare(spark, con, "shoulder_width", catalogue.QUERIES["shoulder_width"], catalogue.ORACLE["shoulder_width"], sf) == (None, 120)


def test_slices_are_computed_once_and_their_tolerance_per_case(spark):
    """Outcomes and failures come from one slice table; a band's tolerance is no work per vertex."""
    from tapeline.plans import catalogue

    plan = catalogue.QUERIES["measurement_outcomes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("n_points#") and sum(line.lstrip(" :+-").startswith("MapIn") for line in plan.splitlines()) == 3
    for name in ("circumference_select", "hip_band_sweep"):
        plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
        meet = max(i for i, line in enumerate(plan) if "Join Inner" in line and "case_id" in line)
        assert [i for i, line in enumerate(plan) if "array_sort" in line] and all(i > meet for i, line in enumerate(plan) if "array_sort" in line)


def test_hulls_of_a_batch_equal_hulls_one_by_one():
    """Groups of all sizes, cut anywhere into batches, with lines, copies and single points."""
    import pandas as pd

    rng = np.random.default_rng(3)
    for cut in (1, 7, 60, 1000):
        sizes = [1, 2, 3, 5, 9, 47, 48, 49, 300]
        points = [np.round(rng.normal(size=(n, 2)), 4) if g % 2 else rng.integers(0, 1 + g % 4, (n, 2)) / 8 for g, n in enumerate(sizes * 3)]
        d = pd.DataFrame([(g, x, z, 1) for g, p in enumerate(points) for x, z in p.tolist()], columns=["g", "px", "pz", "w"])
        got = pd.concat(list(L._finish(["g"])(d.iloc[i : i + cut] for i in range(0, len(d), cut)))).set_index("g")
        for g, p in enumerate(points):
            ring, r = L.chain(sorted(set(map(tuple, p.tolist())))), got.loc[g]
            want = L.ring_length(ring)
            assert np.isnan(r.perimeter_m) if want is None else r.perimeter_m == pytest.approx(want, abs=1e-12)
            assert r.hull_area_m2 == pytest.approx(L.ring_area(ring), abs=1e-12) and r.n_points == len(p) and r.n_hull == len(ring)
            assert (r.width_m, r.depth_m) == tuple(np.ptp(p, axis=0))
