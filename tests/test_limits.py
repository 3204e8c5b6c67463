"""Sizes and values past limits that operators once had."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tapeline.operators import cluster as K
from tapeline.operators import contracts as D
from tapeline.operators import curate as C
from tapeline.operators import events as E
from tapeline.operators import plan as L
from tapeline.operators import sensors as S
from tapeline.operators import sets
from tapeline.plans import catalogue, inputs, runs
from tapeline.sources import records, sinks, survey
from tapeline.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def test_large_keys_neither_overflow_nor_collide(spark, tmp_path):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    shifted = li.withColumns({"l_orderkey": F.col("l_orderkey") + 2**61, "l_suppkey": F.col("l_suppkey") + 10_007 * 5})
    shifted.write.parquet(str(tmp_path / "lineitem.parquet"))
    raw = inputs.survey_raw(spark, str(tmp_path))
    distinct = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").distinct().count()
    assert raw.select("row_idx").distinct().count() == distinct
    assert inputs.survey_units(spark, str(tmp_path)).count() == inputs.survey_units(spark, SF).count()


def test_every_key_of_a_source_is_ranked(spark):
    quality = spark.range(1500).select(F.lit("7th").alias("source"), F.format_string("K%05d", "id").alias("key"), (F.col("id") / 1500).alias("missing_rate"))
    ranked = S.source_order(quality)
    assert ranked.count() == 1500 and ranked.agg(F.max("position")).first()[0] == 1500


def test_all_unmet_steps_are_named(spark):
    steps = spark.createDataFrame([(f"S{i}", "body", "P1", "M1") for i in range(9)], "step_id string, module string, phase string, m_level string")
    edges = spark.createDataFrame([("S0", f"S{i}", "M1") for i in range(1, 9)], "step_id string, from_step string, min_level string")
    reached = spark.createDataFrame([("S1", 1)], "step_id string, reached int")
    unmet = L.unmet_requirements(steps, edges, reached)
    assert {r.from_step for r in unmet.collect()} == {f"S{i}" for i in range(2, 9)}
    state = {r.step_id: r for r in L.plan_state(steps, edges, reached).collect()}
    assert state["S0"].n_unmet == 7 and state["S0"].state == "blocked" and state["S1"].state == "done"


def test_units_with_a_missing_source(spark):
    rows = [(None, "HEIGHT_M", 1700.0, 1), ("8th_3d", "HEIGHT_M", 1.7, 2), ("8th_3d", "WEIGHT_KG", 60.0, 3)]
    units = C.infer_units(spark.createDataFrame(rows, "source string, key string, value double, row_idx long"), ["row_idx"])
    assert {(r.source, r.key): r.unit for r in units.collect()} == {(None, "HEIGHT_M"): "mm", ("8th_3d", "HEIGHT_M"): "m", ("8th_3d", "WEIGHT_KG"): "kg"}


def test_registry_is_searched_whole(spark):
    cols = "ordinal long, module string, lane string, run_id string, round_id string"
    old = spark.createDataFrame([(i, "body", "a", f"r{i}", "R") for i in range(3000)], cols)
    new = spark.createDataFrame([(5000, "body", "a", "r1", "R"), (5001, "body", "a", "r9999", "R"), (5002, "body", "a", "r9999", "R")], cols)
    assert [r.ordinal for r in E.new_records(new, old).collect()] == [5001]
    assert {r.ordinal for r in E.new_records(new, old, lookback=10).collect()} == {5000, 5001}


def test_names_meet_without_comparing_all(spark):
    names = spark.range(100_001).select(F.format_string("column-%06d-waist", "id").alias("name"), F.col("id").alias("position"))
    terms = spark.createDataFrame([("column-000007-waist",), ("042-wai",), ("xcolumn-000003-waistx",), ("none",), ("",)], "term string")
    got = {r.term: (r.name, r.match) for r in sets.first_match(terms, names).collect()}
    assert got["column-000007-waist"] == ("column-000007-waist", "exact") and got["042-wai"] == ("column-000042-waist", "partial")
    assert got["xcolumn-000003-waistx"] == ("column-000003-waist", "partial") and got["none"] == (None, "none")
    assert got[""] == ("column-000000-waist", "partial")


def test_containing_by_brute_force(spark):
    whole = ["abcab", "ab", "a", "", "xyz", None, "日本語表"]
    part = ["", "a", "ab", "bca", "abcab", "本", "本語表", "zz", None]
    a = spark.createDataFrame([(w,) for w in whole], "w string")
    b = spark.createDataFrame([(p,) for p in part], "p string")
    got = sorted((r.w, r.p) for r in sets.containing(a, "w", b, "p").collect())
    assert got == sorted((w, p) for w in whole for p in part if w is not None and p is not None and p in w)


def test_centroids_in_blocks(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    d = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(size=(50, 3))], "x double, y double, z double")
    c = rng.normal(size=(17, 3))
    key = lambda df: sorted((r.x, r.cluster, r.sq_dist) for r in df.collect())
    whole = key(K.assign(d, ["x", "y", "z"], c))
    monkeypatch.setattr(K, "CENTROID_CELLS", 12)
    assert key(K.assign(d, ["x", "y", "z"], c)) == whole


def test_sheets_with_own_headers_and_wide_late_rows(spark, tmp_path):
    first = "제목\n\n,표준 측정항목 명,키\nHUMAN_ID,,\n" + "\n".join(f"0{i},x,{1700 + i}" for i in range(30)) + "\n031,x,1,2,3,late\n"
    second = ",표준 측정항목 명,허리\nHUMAN_ID,,\n9,y,70\n"
    (tmp_path / "a.csv").write_text(first, encoding="utf-8")
    (tmp_path / "b.csv").write_text(second, encoding="utf-8")
    (tmp_path / "c.csv").write_bytes("표준 측정항목 명,엉덩이,엉덩이\n\"x, \"\"y\"\"\",8,9\n".encode("cp949"))
    sheets = survey.read_survey(spark, str(tmp_path), source="7th")
    got = [r.fields for r in sheets.rows.collect()]
    assert [f["키"] for f in got if f.get("HUMAN_ID") == "031"] == ["1"]
    assert sum(f.get("_c5") == "late" for f in got) == 1 and sum(f.get("허리") == "70" for f in got) == 1 and len(got) == 33
    assert [f for f in got if "엉덩이" in f] == [{"표준 측정항목 명": 'x, "y"', "엉덩이": "8", "엉덩이__dup1": "9"}]
    names = {(r.file[-5:], r.position, r["name"]) for r in sheets.names.collect()}
    assert {("a.csv", 0, "HUMAN_ID"), ("b.csv", 2, "허리"), ("c.csv", 2, "엉덩이__dup1")} <= names


@pytest.mark.parametrize("source,row", [("7th", 6), ("8th_3d", 6), ("other", 4), (None, 4)])
def test_default_header_by_source(spark, source, row):
    cells = spark.createDataFrame([("f", 0, 0, "x")], "file string, row_idx int, col_idx int, cell string")
    h = survey.locate_header_rows(cells, default=survey.default_header(F.lit(source))).first()
    assert h.primary == row and h.header_defaulted


def test_transitions_fire_again(spark, tmp_path):
    schema = "key string, flag boolean, ordinal long"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for rows in ([("a", True, 2), ("a", False, 1), ("b", False, 1)], [("a", False, 5)], [("a", True, 8), ("a", False, 7), ("a", True, 6), ("b", True, 9)]):
        write(rows)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        J.run_batches(stream, J.transition_batches(str(tmp_path / "out"), 2), str(tmp_path / "state"))
    got = sorted((r.key, r.ordinal) for r in J.found_transitions(spark, str(tmp_path / "out")).collect())
    assert got == [("a", 2), ("a", 6), ("a", 8), ("b", 9)]


def test_transitions_of_a_key_with_a_third_of_the_batch(spark, tmp_path):
    """Its rows are dealt to blocks of ordinals; no task orders more than a block."""
    rng = np.random.default_rng(11)
    rows = [("hot" if i % 3 == 0 else f"k{i % 500}" if i % 7 else None, bool(rng.integers(0, 2)) if i % 11 else None, i) for i in range(6000)]
    for part in (rows[:2500], rows[2500:]):
        spark.createDataFrame(part, "key string, flag boolean, ordinal long").repartition(5).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("key string, flag boolean, ordinal long").parquet(str(tmp_path / "in"))
        J.run_batches(stream, J.transition_batches(str(tmp_path / "out"), 100), str(tmp_path / "state"))
    last, want = {}, []
    for key, flag, ordinal in rows:
        if flag and not last.get(key):
            want.append((str(key), ordinal))
        last[key] = flag
    assert sorted((str(r.key), r.ordinal) for r in J.found_transitions(spark, str(tmp_path / "out")).collect()) == sorted(want)


def test_assignments_rest_on_converged_centroids(spark, monkeypatch):
    """Lloyd by brute force until unchanged; every distance, the statistics and the worst subjects from its end."""
    rows = sorted((r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect())
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], dtype=float)
    monkeypatch.setattr(runs, "CENTROIDS", k := 12)  # few, so that it takes more than two rounds
    c, rounds = x[:k].copy(), 0
    while True:
        near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[near == i].mean(0).round(12) if (near == i).any() else c[i] for i in range(k)])
        rounds, moved, c = rounds + 1, np.abs(new - c).max(), new
        if moved <= 1e-12:
            break
    square = ((x[:, None] - c[None]) ** 2).sum(2)
    near, dist = square.argmin(1), np.sqrt(square.min(1))
    assert rounds > 3
    got = {r.vec_id: r for r in catalogue.QUERIES["assign_distance_converged"](spark, SF).collect()}
    assert len(got) == len(ids)
    assert all(got[i].cluster == n and abs(got[i].distance - d) < 2e-6 for i, n, d in zip(ids, near, dist))
    stats = catalogue.QUERIES["assignment_stats_converged"](spark, SF).first()
    sizes = np.bincount(near)[np.bincount(near) > 0]
    want = (len(ids), dist.min(), np.quantile(dist, 0.5), np.quantile(dist, 0.9), dist.max(), len(sizes), sizes.min(), np.quantile(sizes, 0.5), sizes.max())
    assert np.allclose([float(v) for v in stats], want, atol=2e-6)
    worst = [r.vec_id for r in catalogue.QUERIES["worst_subjects_converged"](spark, SF).collect()]
    assert worst == [i for _, i in sorted(zip(-dist.round(9), ids))[:10]]
    assert catalogue.QUERIES["kmeans_library"](spark, SF).count() <= k


def test_library_clusters_hold_all_rows_and_cost_no_more(spark):
    """The fit of Spark's own k-means against the converged Lloyd rounds on the same rows."""
    rng = np.random.default_rng(12)
    points = np.vstack([rng.normal(m, 0.05, (40, 2)) for m in ((0, 0), (1, 1), (0, 1), (2, 0))])
    d = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    centres = K.library_kmeans(d, ["x", "y"], 4)
    sizes = [r["count"] for r in K.assign(d, ["x", "y"], centres).groupBy("cluster").count().collect()]
    assert sum(sizes) == 160 and len(sizes) == 4
    cost = lambda c: ((points[:, None, :] - np.asarray(c)[None]) ** 2).sum(2).min(1).sum()
    assert cost(centres) <= cost(K.lloyd(d, ["x", "y"], 4, ["id"])) * 1.01 + 1e-9


def test_case_manifest_head_events_and_json_without_nan(spark, tmp_path):
    (tmp_path / "cases.json").write_text('{"schema_version":"v1","meta_unit":"m","cases":[{"case_id":"c1","mesh_path":"a.obj"},{"case_id":"c2","mesh_path":null,"verts_path":"v.npz"}]}')
    got = [tuple(r) for r in records.read_cases(spark, str(tmp_path / "cases.json")).orderBy("case_id").collect()]
    assert got == [("m", "c1", "a.obj", None), ("m", "c2", None, "v.npz")]
    events = spark.createDataFrame([("f", i) for i in range(9, 0, -1)] + [("g", 5)], "file string, ordinal long")
    assert sorted(tuple(r) for r in records.head_events(events, 2).collect()) == [("f", 1), ("f", 2), ("g", 5)]
    sinks.write_safe_json(spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 0.5)], "id long, v double"), str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"id":1,"v":null}', '{"id":2,"v":null}', '{"id":3,"v":0.5}']


def test_all_warnings_are_ordered_by_code_and_place(spark):
    want = [
        ("[A_1] z | path=N/A", "A_1", "N/A"), ("[A_1] no place", "A_1", "[A_1] no place"), ("[A_1] a | expected= b/c ", "A_1", "b/c"),
        ("[B] y | id=1; expected=q; detail=d", "B", "1"), ("[B] x | path=2;", "B", "2"), ("[B] x | path=2;", "B", "2"), ("no code", "no code", ""),
    ]
    rows = [(w,) for w, _, _ in want[::-1]] + [(f"[Z] | path={i:03d}",) for i in reversed(range(200))]
    got = [tuple(r) for r in D.ordered_warnings(spark.createDataFrame(rows, "warning string").repartition(7)).collect()]
    assert [g for g in got if g[1] != "Z"] == want
    assert [g[2] for g in got if g[1] == "Z"] == [f"{i:03d}" for i in range(200)]
    table = [(r.code, r.place, r.warning) for r in catalogue.QUERIES["warnings_ordered"](spark, SF).collect()]
    assert table and table == sorted(table)
    assert catalogue.OPERATORS["warnings_ordered"] == "T6" and "T6" not in catalogue.OPERATORS["top_issues"].split()


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_nearest_names_equal_all_pairs_without_comparing_them(spark):
    rng = np.random.default_rng(10)
    letters = np.array(list("abcdé본"))
    word = lambda n: "".join(rng.choice(letters, n))
    names = [word(n) for n in rng.integers(0, 14, 300)] + ["waist girth", "waist girths", "waste girth", "hip girth", "", None, "waist girth"]
    terms = [word(n) for n in rng.integers(0, 12, 60)] + ["waist girth", "wast girt", "x" * 30, "", None, "zzzzzzzz"]
    got = sets.nearest_names(spark.createDataFrame([(t,) for t in terms], "term string"), spark.createDataFrame([(n,) for n in names], "name string"))
    found = {}
    for r in got.collect():
        found.setdefault(r.term, {})[r["rank"]] = (r.distance, r.name)
    for t in {t for t in terms if t is not None}:
        every = sorted((_distance(t, n), n.encode(), n) for n in {n for n in names if n is not None} if len(n) <= 3 * len(t) + 8)[:3]
        assert [found[t][i + 1] for i in range(len(every))] == [(d, n) for d, _, n in every]
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_the_head_of_a_group_is_found_without_ordering_all_rows(spark):
    from tapeline.operators.scale import first_candidates, first_k

    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, "a").alias("g"), ((F.col("id") * 7919) % 40_009).alias("n"), F.when(F.col("id") % 4 > 0, "1").otherwise("x").alias("raw")
    ).unionByName(spark.createDataFrame([("few", 5, "1"), ("few", None, "1"), ("same", 7, "1")], "g string, n long, raw string"))
    rows = rows.unionByName(spark.range(300).select(F.lit("same").alias("g"), F.lit(7).cast("long").alias("n"), F.lit("1").alias("raw")))
    assert first_candidates(rows.where("g = 'same'"), ["g"], F.col("n"), 20).count() == 301
    head = lambda d: sorted(map(str, first_k(d, ["g"], [F.asc("n")], 20, "r").collect()))
    near = first_candidates(rows, ["g"], F.col("n"), 20)
    assert head(near) == head(rows) and near.count() < 2_000


def test_numbers_are_read_once_per_text(spark):
    from tapeline.plans import curation

    texts = inputs.survey_canonical_counts(spark, SF)
    rows = inputs.survey_raw(spark, SF).count()
    assert texts.agg(F.sum("n")).first()[0] == rows * len(inputs.SURVEY_KEYS) and texts.count() < rows
    assert curation.completeness(spark, SF).agg(F.sum("n_rows")).first()[0] == rows * len(inputs.SURVEY_KEYS)


def test_nearest_centroids_are_those_of_all_comparisons():
    rng = np.random.default_rng(5)
    c = np.vstack([rng.normal(size=(60, 8)), rng.integers(0, 3, (40, 8)), rng.normal(size=(10, 8)) + 1e6])
    c = np.vstack([c, c[:20]])  # equal centroids: the lowest index wins
    x = np.vstack([rng.normal(size=(300, 8)), rng.integers(0, 3, (300, 8)), c, np.full((2, 8), np.nan), np.full((1, 8), np.inf)])
    d = np.zeros((len(x), len(c)))
    for j in range(8):
        d += (x[:, j, None] - c[None, :, j]) ** 2
    idx, dist = K.nearest_rows(x, c)
    assert (idx == d.argmin(axis=1)).all() and np.array_equal(dist, d.min(axis=1), equal_nan=True)


def test_every_field_of_a_document_is_looked_up_once(spark):
    """Spelled out in every check, the lookups were more code than the JVM compiles."""
    from tapeline.plans import jobs

    docs = spark.createDataFrame([("r/geometry_manifest.json", "{}")], "path string, doc string")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        for df, most in ((catalogue.QUERIES["body_checks"](spark, SF), 5), (catalogue.QUERIES["top_issues"](spark, SF), 5), (jobs.document_checks(docs, docs.select("path")), 20)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert 0 < plan.count("schema_of_variant(") + plan.count("SchemaOfVariant") <= most
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_documents_of_one_row_group_are_many_tasks(spark):
    """Splits that hold no row group have no rows: a count of splits says nothing."""
    from tapeline.plans import audits, documents

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for df in (documents.docs(spark, SF, documents.SUBSET), audits._runs(spark, SF)[0]):
            rows = df.groupBy(F.spark_partition_id()).count().collect()
            assert len(rows) >= 8 and max(r["count"] for r in rows) < 0.2 * sum(r["count"] for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_many_small_mesh_files_are_opened_and_parsed_once(spark, tmp_path):
    """Numbering takes two steps per table; none of them goes back to the text files."""
    for case in range(3):
        (tmp_path / f"case={case}").mkdir()
        (tmp_path / f"case={case}" / "mesh.obj").write_text("v 0 0 0\nv 1 x 0\n# note\nv 1 0 0\nf 1 2\n v 0 1 0\nf 1/1 2//2 3\n\nf 3 2 1 0\n")
    verts, faces = records.read_obj(spark, str(tmp_path))
    for df in (verts, faces):
        assert "Scan text" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.vertex_id, r.x, r.y) for r in verts.collect()) == sorted([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 0.0, 1.0)] * 3)
    assert sorted((r.face_id, r.idx) for r in faces.collect()) == sorted([(0, [0, 1, 2]), (1, [2, 1, 0])] * 3)


def test_library_rounds_of_all_starts_are_those_of_each_fit(spark):
    """The best of MLlib's own fits from the same seeds, without a task for each centroid in each round."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    rng, cols, k = np.random.default_rng(21), [f"x{i}" for i in range(60)], 130
    points = rng.normal(0, 1, (900, 60)) + 3 * rng.normal(0, 1, (40, 60))[rng.integers(0, 40, 900)]
    d = spark.createDataFrame(points.tolist(), ", ".join(f"{c} double" for c in cols)).repartition(5).cache()
    sc = spark.sparkContext
    sc.setJobGroup("library", "library_kmeans")
    try:
        got = K.library_kmeans(d, cols, k, seed=5, restarts=3, max_iter=40)
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("library") for s in tracker.getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages if s) < k
    rows = VectorAssembler(inputCols=cols, outputCol="features").transform(d)
    fits = [KMeans(k=k, seed=5 + i, maxIter=40).fit(rows) for i in range(3)]
    best = min(fits, key=lambda m: m.summary.trainingCost)
    assert best.summary.numIter > 2 and np.allclose(got, np.array(best.clusterCenters()), atol=1e-9)


def test_library_clusters_of_few_distinct_rows(spark):
    """Fewer distinct rows than clusters give a centroid each."""
    d = spark.createDataFrame([(float(i % 3), 1.0) for i in range(50)], "x double, y double").repartition(3)
    got = K.library_kmeans(d, ["x", "y"], 8, restarts=2)
    assert sorted(got.tolist()) == [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]]
