import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.synthetic import slide
from tilewright.functions import pixels, text
from tilewright.operators import artifacts, batch, checks, folds, grid, masks, measures, metadata, normalization, planes, slide_measures, tissue, verdict


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_grid_covers_every_pixel_once(spark):
    g = grid.tile_grid(spark.createDataFrame([(1, 35, 19), (2, 0, 5), (3, None, 4)], "slide int, w int, h int"), 16)
    seen = np.zeros((19, 35), int)
    for r in g.collect():
        assert r.slide == 1
        seen[r.y : r.y + r.th, r.x : r.x + r.tw] += 1
    assert (seen == 1).all() and g.count() == 6
    last = g.filter("col = 2 AND row = 1").first()
    assert (last.tw, last.th) == (3, 3)
    assert grid.tile_grid(spark.createDataFrame([(1, 2000, 1000)], "slide int, w int, h int"), 512).count() == 8


def test_overlap_finds_the_one_pixel(spark):
    g = grid.tile_grid(spark.createDataFrame([(1, 35, 19)], "slide int, w int, h int"), 16)
    feet = g.withColumns(grid.footprint(F.col("x"), F.col("y"), F.col("tw"), F.col("th"), F.lit(1.0), F.lit(1.0), F.lit(35), F.lit(19)))
    got = grid.tile_overlap(feet, spark.createDataFrame([(1, 34, 18)], "slide int, mx int, my int"))
    assert [(r.col, r.row, r.covered, r.area) for r in got.collect()] == [(2, 1, 1, 9)]


def test_footprint_join_is_block_size_invariant(spark):
    boxes = spark.createDataFrame([(1, 0, 0, 3, 70, 2, 90)], "slide int, col int, row int, mx0 int, mx1 int, my0 int, my1 int")
    px = spark.createDataFrame([(1, x, y) for x in range(0, 100, 7) for y in range(0, 100, 11)], "slide int, mx int, my int")
    counts = {grid.footprint_join(boxes, px, block=b).count() for b in (5, 64, 1000)}
    assert len(counts) == 1


def test_two_passes(spark):
    t = spark.createDataFrame([(0, 0.0, 0.9, None), (1, 0.5, 0.125, False), (2, 1.0, None, False), (3, 0.25, 0.25, False), (4, 1.0, 1.0, True), (5, None, None, False)], "ord int, coarse double, refined double, read_error boolean")
    got = {r.ord: (r.dropped_pass1, r.dropped_pass2, r.kept) for r in grid.two_pass_drop(t, 0.25).collect()}
    assert got == {0: (True, False, False), 1: (False, True, False), 2: (False, False, True), 3: (False, False, True), 4: (False, False, False), 5: (False, False, True)}
    kept = {r.ord for r in grid.two_pass_drop(t, None).filter("kept").collect()}
    assert kept == {0, 1, 2, 3, 5}  # what cannot be read is never kept


def test_level_plan(spark):
    s = spark.createDataFrame([(1, 0.5, [1.0, 4.0, 16.0], [(4096, 3072), (1024, 768), (256, 192)]), (2, 20.0, [1.0], [(100, 50)]), (3, None, [1.0], [(10, 10)])], "slide int, mpp double, downsamples array<double>, levels array<struct<w: int, h: int>>")
    got = {r.slide: (r.level, r.plane_w, r.plane_h, r.direction) for r in grid.level_plan(s, 8.0).collect()}
    assert got[1] == (2, 256, 192, "native") and got[2] == (0, 250, 125, "up") and got[3][0] is None


def test_window_origin(spark):
    assert [r[0] for r in spark.createDataFrame([(-5,), (3,), (98,)], "s int").select(grid.window_origin(F.col("s"), F.lit(10), F.lit(100))).collect()] == [0, 3, 90]


def test_scale_rules(spark):
    s = spark.createDataFrame([(1, 0.5016, 0.5016, 20.0), (2, 0.7, 0.7, 20.0), (3, None, None, 20.0), (4, 0.05, 0.05, 150.0), (5, 500.0, 500.0, None), (6, float("nan"), 0.5, 10.0)], "slide int, mpp_x double, mpp_y double, objective_power double")
    got = {r.slide: (r.scale_source, r.mpp_passed, r.implausible) for r in checks.scale_check(s).collect()}
    assert got == {1: ("stated", True, False), 2: ("stated", False, False), 3: ("derived from objective", True, False), 4: ("stated sub-floor", True, False), 5: (None, False, True), 6: ("derived from objective", False, False)}
    kept = checks.effective_scale(checks.scale_check(s)).filter("slide = 3").first()
    assert kept.mpp_x == 0.5 and kept.raw_mpp_x is None


def test_integrity(spark):
    s = spark.createDataFrame([(10, 10, [1.0, 4.0], [True]), (10, 10, [1.0, 1.0], [True]), (10, 10, [1.0], [None]), (0, 10, [1.0], [True]), (10, 10, [], [True])], "w int, h int, d array<double>, ok array<boolean>")
    assert [r[0] for r in s.select(checks.integrity(F.col("w"), F.col("h"), F.col("d"), F.col("ok"))).collect()] == [True, False, False, False, False]


def test_given_tiles(spark):
    t = spark.createDataFrame([(0, 0.0, 0.0, 8.0, 8.0), (1, 0.5, 0.0, 8.0, 8.0), (2, 0.0, 0.0, 8.0, 8.0), (3, 60.0, 0.0, 8.0, 8.0), (4, None, 0.0, 8.0, 8.0), (5, 0.0, 0.0, 65.0, 8.0)], "ord int, x double, y double, w double, h double").withColumns({"slide": F.lit(1), "pw": F.lit(64), "ph": F.lit(64)})
    got = {r.ord: r.problem for r in checks.valid_tiles(t, "pw", "ph", 32).collect()}
    assert got == {0: None, 1: "not whole numbers", 2: "duplicate", 3: "outside the plane", 4: "not whole numbers", 5: "larger than a tile"}


def test_names(spark):
    p = spark.createDataFrame([("gs://b/a.b.svs",), (".svs",), ("",), ("c/d",), ("gcs://x/y.tif",)], "p string")
    assert [r[0] for r in p.select(text.slide_id(F.col("p"))).collect()] == ["a.b", ".svs", "slide", "d", "y"]
    assert p.select(text.slide_key(F.col("p"))).collect()[4][0] == "gs://x/y.tif"
    e = spark.createDataFrame([("ReadError: x",), ("nothing",), (None,)], "m string")
    assert [r[0] for r in e.select(text.error_class(F.col("m"))).collect()] == ["ReadError", None, None]


def test_manifest_rows_merge_or_conflict(spark):
    m = spark.createDataFrame([("a/x.svs", 0, "HE", None), ("a/x.svs", 1, " ", "b1"), ("a/y.svs", 2, "Hirano", None), ("a/y.svs", 3, "AT8", None), ("b/x.svs", 4, None, None), (" ", 5, None, None)], "slide string, ord int, stain string, bank string")
    got = {r.slide: (r.stain, r.bank, r.problem) for r in batch.manifest_merge(m, ["stain", "bank"]).collect()}
    assert got["a/x.svs"] == ("HE", "b1", None)
    assert got["a/y.svs"] == ("Hirano", None, "conflicting stain: AT8, Hirano")
    keys = {r.slide: r.job_key for r in batch.job_keys(batch.manifest_merge(m, ["stain"])).collect()}
    assert keys["a/y.svs"] == "y" and keys["a/x.svs"] != keys["b/x.svs"] and keys["a/x.svs"].startswith("x~")


def test_latest_run_orders_suffixes_by_number(spark):
    r = spark.createDataFrame([("s", "t", "20260101T000000Z_2", "failed"), ("s", "t", "20260101T000000Z_10", "completed"), ("s", "a", "20250101T000000Z_99", "running")], "slide string, started string, folder string, state string")
    r = r.withColumn("suffix", batch.folder_suffix(F.col("folder")))
    assert batch.latest_runs(r).first().folder.endswith("_10")
    assert batch.latest_runs(r, state="failed").first().folder.endswith("_2")


def test_resume(spark):
    jobs = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "2"), ("e", None)], "slide string, fingerprint string")
    last = spark.createDataFrame([("a", "completed", "1"), ("b", "failed", "1"), ("d", "completed", "1"), ("c", "running", "1")], "slide string, state string, fingerprint string")
    action = lambda **k: {r.slide: r.action for r in batch.resume(jobs, last, **k).collect()}
    assert action() == {"a": "skip completed", "b": "skip failed", "c": "run", "d": "run", "e": "run"}
    assert action(retry_failed=True)["b"] == "run" and action(force=True)["a"] == "run"


def test_bounds_by_stain_alias_and_global(spark):
    m = spark.createDataFrame([(1, "NEUN", None, "x", 40.0), (2, "HE", None, "x", 40.0), (3, "LFB", None, "x", 40.0), (4, "zz", "HE", "x", 40.0), (5, None, None, "y", 1.0)], "slide int, stain string, alias string, metric string, value double")
    t = spark.createDataFrame([("x", "NEUN", 3.0, 5.0), ("x", "HE", 30.0, 50.0), ("x", None, 0.0, 10.0), ("x", "LFB", None, None)], "metric string, stain string, min double, max double")
    got = {r.slide: (r.band, r.flagged, r.counted) for r in verdict.evaluated(verdict.resolve_bounds(m, t, ["slide"])).collect()}
    assert got == {1: ("stain", True, True), 2: ("stain", False, True), 3: ("stain", False, False), 4: ("alias", False, True), 5: ("none", False, False)}


def test_verdict_without_anything_counted_is_null(spark):
    m = spark.createDataFrame([(1, None, 1.0, 2.0), (2, float("nan"), 1.0, 2.0), (3, 1.5, 3.0, 2.0), (4, 1.0, 1.0, None)], "slide int, value double, min double, max double")
    got = {r.slide: (r.n_evaluated, r.n_flags, r.passed) for r in verdict.verdict(verdict.evaluated(m), ["slide"]).collect()}
    assert got == {1: (0, 1, None), 2: (1, 1, False), 3: (0, 1, None), 4: (1, 0, True)}


def test_priority_lookup(spark):
    asked = spark.createDataFrame([(1, " lfb/h&e ", "part"), (2, "LFB/H&E", "OTHER"), (3, None, "part"), (4, "LFB-HE", None)], "slide int, stain string, bank string")
    bank = spark.createDataFrame([("LFB-HE", 1), ("LFB-HE/PART", 2)], "name string, entry int")
    got = {r.slide: r.entry for r in metadata.by_priority(asked, bank, "slide", {"lfb/h&e": "lfb-he"}).collect()}
    assert got == {1: 2, 2: 1, 3: None, 4: 1}


def test_merges_and_indexes(spark):
    r = spark.createDataFrame([("k", 0, "a"), ("k", 1, "b"), ("j", 0, "c"), (None, 0, "d"), (None, 1, "e")], "key string, ord int, v string")
    records, doubled = metadata.index(r, ["key"], ["ord"])
    assert {x.v for x in records.collect()} == {"a", "c", "d"} and doubled.count() == 2
    assert {x.v for x in metadata.last_wins(r, ["key"], ["ord"]).collect()} == {"b", "c", "e"}
    assert {(x.v, x.copies) for x in metadata.first_records(r, ["key"], ["ord"]).collect()} == {("a", 2), ("c", 1), ("d", 2)}
    m = spark.createDataFrame([("x", "y"), (" ", "y"), (None, "nan")], "cli_stain string, meta_stain string")
    assert [(x.stain, x.stain_origin) for x in metadata.merged_source(m, ["stain"]).collect()] == [("x", "cli"), ("y", "metadata"), (None, "none")]
    with pytest.raises(ValueError):
        metadata.adapt("nobody", r)
    w = spark.createDataFrame([("Z:\\a\\b.svs",)], "file_path string")
    assert metadata.adapt("windows_share", w, prefix="gs://bucket").first().slide_path == "gs://bucket/a/b.svs"


def test_artifact_fractions_label_and_merge(spark):
    cls = [[2 if y < 4 and x < 4 else 4 if y >= 4 and x < 4 else 7 for x in range(8)] for y in range(8)]
    m = spark.createDataFrame([(1, x, y, cls[y][x]) for y in range(8) for x in range(8)], "slide int, mx int, my int, cls int")
    t = spark.createDataFrame([(1, 0, 0, 0, 8, 0, 8)], "slide int, col int, row int, mx0 int, mx1 int, my0 int, my1 int")
    got = artifacts.labelled(artifacts.class_fractions(t, m)).first()
    assert (got.fold_fraction, got.pen_fraction, got.background_fraction, got.has_artifact, got.artifact_label) == (0.25, 0.25, 0.5, True, "fold")
    assert artifacts.labelled(artifacts.class_fractions(t, m), least=None).first().has_artifact is None
    with pytest.raises(ValueError):
        artifacts.class_id("dust")
    left = spark.createDataFrame([(1, 1, 1), (1, None, 1), (1, 9, 9)], "slide int, col int, row int")
    right = spark.createDataFrame([(1, 1, 1, 0, "old"), (1, 1, 1, 1, "new"), (1, None, 1, 0, "none")], "slide int, col int, row int, ord int, label string")
    assert {(r.col, r.label) for r in artifacts.merged(left, right).collect()} == {(1, "new"), (None, "none"), (9, None)}


def test_masks(spark):
    mask = lambda *p: spark.createDataFrame([(1, y, x) for y, x in p], "plane int, y int, x int")
    a, b = mask((0, 0), (0, 1), (5, 5)), mask((0, 1), (7, 7))
    assert masks.union(a, b).count() == 4 and masks.intersection(a, b).count() == 1 and masks.difference(a, b).count() == 2
    assert rows(masks.within(mask((0, 0), (9, 9)), mask((2, 2)))) == [(1, 0, 0)]
    assert rows(masks.unpacked(masks.packed(a.union(a)))) == rows(a)
    assert rows(masks.pyramid(mask((0, 0), (4, 8), (1, 1)), 3).filter("level = 2")) == [(1, 2, 0, 0), (1, 2, 1, 2)]
    assert rows(masks.halved(mask((0, 0), (4, 8), (1, 1)))) == [(1, 0, 0), (1, 2, 4)]
    with pytest.raises(ValueError):
        masks.combine(a, b, "xor")


def test_statistics(spark):
    g = np.random.default_rng(4).integers(0, 255, (6, 7))
    px = spark.createDataFrame([(1, y, x, int(g[y, x])) for y in range(6) for x in range(7)], "plane int, y int, x int, g int")
    p = np.pad(g, 1, mode="reflect")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g
    assert measures.focus(px, ["plane"], "g").first().focus == pytest.approx(lap.var(), rel=1e-12)
    got = measures.percentiles(px, ["plane"], "g", {"a": 0.05, "b": 0.95}).first()
    assert (got.a, got.b) == pytest.approx(tuple(np.percentile(g, [5, 95])))
    assert measures.otsu(measures.histogram(px, ["plane"], "g"), ["plane"], "g").first().threshold == __import__("tilewright.operators.kernels", fromlist=["x"]).otsu(g)
    n, _ = np.histogram(g, 30)
    assert [r.n for r in measures.binned(px, ["plane"], "g").orderBy("bin").collect()] == n.tolist()


def test_colours(spark):
    px = spark.createDataFrame([(128, 128, 128), (255, 0, 0), (0, 0, 0), (10, 200, 90)], "r int, g int, b int")
    c = [r[0] for r in px.select(pixels.chroma(F.col("r"), F.col("g"), F.col("b"))).collect()]
    assert c[0] < 0.01 and c[1] > 100
    lab = normalization.to_lab(np.array([[10, 200, 90]], np.uint8))[0]
    got = px.select(*pixels.lab(F.col("r"), F.col("g"), F.col("b"))).collect()[3]
    assert np.allclose(lab, got, atol=1e-6)
    for i in (0, 1, 255, 128):
        assert px.limit(1).select(pixels.density(F.lit(i))).first()[0] == pytest.approx(max(-np.log(max(i, 1) / 255), 1e-6))


def test_failed_planes_are_rows(spark):
    rgb, t, _ = slide()
    h, w = t.shape
    p = spark.createDataFrame([(1, h, w, bytearray(rgb.tobytes()), 8.0, "HE"), (2, h, w, bytearray(b"short"), 8.0, None)], "plane long, h int, w int, data binary, mpp double, stain string")
    seg = {r.plane: r for r in tissue.segment(p).collect()}
    assert seg[1].coverage == pytest.approx(t.mean(), abs=0.02) and seg[2].coverage is None and seg[2].error_type == "ValueError"
    masked = p.join(tissue.segment(p).select("plane", F.col("mask").alias("tissue")), "plane")
    f = {r.plane: r for r in folds.detect(masked).collect()}
    assert 0 <= f[1].fold_fraction <= 1 and f[2].error is not None
    m = {r.plane: r for r in slide_measures.measure(masked).collect()}
    assert m[1].focus > 0 and m[1].staining > 0 and m[2].focus is None
    fit = normalization.fit_planes(masked)
    out = {r.plane: r for r in normalization.normalize_planes(masked, fit, normalization.freeze(rgb, t)).collect()}
    assert len(out[1].data) == h * w * 3 and out[2].error.startswith("cannot") or "parameters" in out[2].error
    pen = {r.plane: r for r in slide_measures.pen(p, lambda image: image[..., 0] > 0.4).collect()}
    assert pen[1].pen_fraction == pytest.approx((~t).mean(), abs=0.02)


def test_chunks_of_both_kinds_are_segmented_again(spark):
    rgb, t, _ = slide()
    h, w = t.shape
    good, none, all_ = (bytearray(np.packbits(m).tobytes()) for m in (t, np.zeros_like(t), np.ones_like(t)))
    given = [(1, rgb, 0.1, none), (2, rgb, 0.11, none), (3, rgb, 1.0, all_), (4, np.full_like(rgb, 255), 0.5, good), (5, rgb, 0.05, good)]
    chunks = spark.createDataFrame([(k, h, w, bytearray(a.tobytes()), c, m) for k, a, c, m in given], "plane long, h int, w int, data binary, coarse double, support binary")
    got = {r.plane: r for r in slide_measures.refined_chunks(chunks).collect()}
    assert {k: r.state for k, r in got.items() if k != 4} == {1: "sparse", 2: "refined", 3: "interior", 5: "sparse"}
    assert got[1].refined == 0 and got[2].refined == pytest.approx(t.mean(), abs=0.02) and got[3].refined == 1
    assert got[4].state == "refined" or (got[4].reseg_error and bytes(got[4].mask) == bytes(good))
    counts = slide_measures.chunk_counts(spark.createDataFrame([(1, "sparse"), (1, "refined"), (1, "failed"), (1, "sparse")], "slide int, state string")).first()
    assert counts.asDict() == {"slide": 1, "n_chunks": 4, "n_resegmented": 1, "n_carried_sparse": 2, "n_carried_interior": 0, "n_reseg_failed": 1}
    # Tiles are segmented again also where the coarse mask has next to nothing.
    tile = {r.plane: r for r in slide_measures.tile_measures(chunks, 0.2).collect()}
    assert tile[5].resegmented and tile[1].resegmented and not tile[3].resegmented


def test_regions_by_plane(spark):
    m = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 5, 5), (2, 3, 3)], "plane long, y int, x int")
    assert rows(planes.labelled_pixels(m, 8, 8)) == [(1, 0, 0, 0), (1, 1, 1, 0), (1, 5, 5, 45), (2, 3, 3, 27)]
    r = artifacts.region_stats(planes.labelled_pixels(m, 8, 8), ["plane"])
    assert rows(artifacts.largest_region(r, ["plane"]).select("plane", "label", "area")) == [(1, 0, 2), (2, 27, 1)]


def test_results_do_not_depend_on_partitions(spark):
    t = spark.range(500).selectExpr("id % 7 AS slide", "id AS ord", "(id * 37 % 101) / 100D AS coarse", "(id * 53 % 101) / 100D AS refined", "id * 1.5D AS focus", "id % 13 = 0 AS read_error")
    got = [rows(measures.tile_summary(grid.two_pass_drop(t.repartition(n), 0.3))) for n in (1, 4, 16)]
    assert got[0] == got[1] == got[2]


def test_footprint_join_sends_no_side_to_the_driver(spark, tmp_path):
    from tilewright.plans.tile_queries import QUERIES

    spark.createDataFrame([(k, s) for k, s in enumerate([1, 7, 50, 70, 90, None, -3])], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    for name in ("tile_overlap", "class_fractions", "artifact_label"):
        plan = QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and plan.count("Exchange hashpartitioning(slide") == 3  # tiles, blocks of cells, groups; no cells
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    from tilewright.plans.tile_queries import ORACLE_SQL

    for name in ("tile_overlap", "class_fractions", "artifact_label"):
        got, want = QUERIES[name](spark, str(tmp_path)), con.execute(ORACLE_SQL[name])
        order = [d[0] for d in want.description]
        assert sorted(map(repr, (tuple(r) for r in got.select(*order).collect()))) == sorted(map(repr, want.fetchall()))
