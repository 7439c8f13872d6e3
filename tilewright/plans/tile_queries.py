"""Registered queries on grids, tiles and artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions.guards import fraction
from tilewright.operators import artifacts, checks, grid, measures
from tilewright.plans.standins import gray_planes, planes, read, sql, tiles

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return register


GRID_SQL = """
, grid AS (
  SELECT slide, w, h, CAST(c AS INT) AS col, CAST(r AS INT) AS row, CAST(c * 512 AS INT) AS x, CAST(r * 512 AS INT) AS y,
         CAST(least(512, w - c * 512) AS INT) AS tw, CAST(least(512, h - r * 512) AS INT) AS th
  FROM (SELECT slide, w, h, unnest(range(CAST(ceil(w / 512.0) AS BIGINT))) AS c FROM planes) a, LATERAL (SELECT unnest(range(CAST(ceil(a.h / 512.0) AS BIGINT))) AS r))"""


@query(sql("planes", body=GRID_SQL + " SELECT slide, col, row, x, y, tw, th FROM grid").replace(" , grid", ", grid"))
def tile_grid(spark: SparkSession, d: str) -> DataFrame:
    """Every tile of every plane."""
    return grid.tile_grid(planes(spark, d)).select("slide", "col", "row", "x", "y", "tw", "th")


TWO_PASS = """
, passes AS (
  SELECT *, coalesce(coarse < 0.3, false) AS dropped_pass1,
         NOT coalesce(coarse < 0.3, false) AND NOT read_error AND coalesce(refined < 0.3, false) AS dropped_pass2 FROM tiles)
, dropped AS (SELECT *, NOT dropped_pass1 AND NOT dropped_pass2 AND NOT read_error AS kept FROM passes)"""


def _dropped(spark: SparkSession, d: str) -> DataFrame:
    return grid.two_pass_drop(tiles(spark, d), 0.3)


@query(sql("tiles", body=TWO_PASS + " SELECT slide, dropped_pass1, dropped_pass2, kept, count(*) AS n FROM dropped GROUP BY ALL"))
def two_pass_drop(spark: SparkSession, d: str) -> DataFrame:
    """Tiles of each slide by what the two passes made of them."""
    return _dropped(spark, d).groupBy("slide", "dropped_pass1", "dropped_pass2", "kept").agg(F.count(F.lit(1)).alias("n"))


@query(sql("tiles", body=TWO_PASS + """
 SELECT slide, count(*) AS n_tiles, count(*) FILTER (dropped_pass1) AS n_dropped_pass1, count(*) FILTER (dropped_pass2) AS n_dropped_pass2,
        count(*) FILTER (NOT dropped_pass1 AND read_error) AS n_read_failed, count(*) FILTER (kept) AS n_kept,
        count(*) FILTER (kept) / CAST(count(*) AS DOUBLE) AS kept_fraction,
        round(quantile_cont(focus, 0.05) FILTER (NOT dropped_pass1 AND NOT read_error), 4) AS focus_p5,
        round(quantile_cont(focus, 0.5) FILTER (NOT dropped_pass1 AND NOT read_error), 4) AS focus_p50,
        round(quantile_cont(focus, 0.95) FILTER (NOT dropped_pass1 AND NOT read_error), 4) AS focus_p95
 FROM dropped GROUP BY slide"""))
def tile_summary(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: counters and focus percentiles of each slide after both passes."""
    s = measures.tile_summary(_dropped(spark, d))
    return s.select(*[F.round(c, 4).alias(c) if c.startswith("focus_") else F.col(c) for c in s.columns])


@query(sql("tiles", body=TWO_PASS + """
 , kinds AS (
   SELECT slide, 0 AS group_ord, 'read_error' AS kind, NULL::DOUBLE AS f, * EXCLUDE (slide) FROM dropped WHERE read_error
   UNION ALL SELECT slide, 1, 'reseg_error', NULL, * EXCLUDE (slide) FROM dropped WHERE reseg_error
   UNION ALL SELECT slide, 2, 'dropped_pass1', NULL, * EXCLUDE (slide) FROM dropped WHERE dropped_pass1
   UNION ALL SELECT slide, 3, 'dropped_pass2', NULL, * EXCLUDE (slide) FROM dropped WHERE dropped_pass2
   UNION ALL SELECT slide, 4, 'low_focus', focus, * EXCLUDE (slide) FROM dropped WHERE kept AND focus IS NOT NULL)
 , ranked AS (SELECT *, row_number() OVER (PARTITION BY slide, group_ord ORDER BY f, ord, col, row, focus, quantity) AS rank FROM kinds)
 SELECT slide, kind, CAST(rank AS INT) AS rank, ord, col, row, focus FROM ranked WHERE group_ord < 2 OR rank <= 5"""))
def outlier_union(spark: SparkSession, d: str) -> DataFrame:
    """The outlier list of each slide: errors all, of drops and low focus the first five."""
    got = grid.outliers(_dropped(spark, d), 5, order=["ord", "col", "row", "focus", "quantity"])
    return got.select("slide", "kind", "rank", "ord", "col", "row", "focus")


@query(sql("tiles", body=TWO_PASS + """
 SELECT slide, CAST(rank AS INT) AS rank, focus FROM (SELECT slide, focus, row_number() OVER (PARTITION BY slide ORDER BY focus) AS rank FROM dropped WHERE kept) WHERE rank <= 3"""))
def low_focus_outliers(spark: SparkSession, d: str) -> DataFrame:
    """The three least focus values among each slide's kept tiles."""
    got = grid.outliers(_dropped(spark, d), 3, order=["ord", "col", "row", "quantity"]).filter("kind = 'low_focus'")
    return got.select("slide", "rank", "focus")


#: A mask at an eighth of the plane's scale: a disc-like pattern that both engines can make.
MASK_SQL = """
, mask AS (
  SELECT slide, CAST(mx AS INT) AS mx, CAST(my AS INT) AS my FROM
   (SELECT slide, w, h, unnest(range(CAST(ceil(w / 64.0) AS BIGINT))) AS mx FROM planes) a, LATERAL (SELECT unnest(range(CAST(ceil(a.h / 64.0) AS BIGINT))) AS my)
  WHERE (mx * 7 + my * 5 + slide) % 11 < 4)
, dims AS (SELECT slide, CAST(ceil(w / 64.0) AS INT) AS mw, CAST(ceil(h / 64.0) AS INT) AS mh FROM planes)
, boxes AS (
  SELECT g.slide, col, row, least(greatest(CAST(floor(x * (mw / CAST(w AS DOUBLE))) AS INT), 0), mw - 1) AS mx0, least(greatest(CAST(floor(y * (mh / CAST(h AS DOUBLE))) AS INT), 0), mh - 1) AS my0,
         least(CAST(ceil((x + tw) * (mw / CAST(w AS DOUBLE))) AS INT), mw) AS ex, least(CAST(ceil((y + th) * (mh / CAST(h AS DOUBLE))) AS INT), mh) AS ey
  FROM grid g JOIN dims USING (slide))
, feet AS (SELECT slide, col, row, mx0, my0, greatest(ex, mx0 + 1) AS mx1, greatest(ey, my0 + 1) AS my1 FROM boxes)"""


def _feet(spark: SparkSession, d: str) -> DataFrame:
    p = planes(spark, d).withColumns({"mw": F.ceil(F.col("w") / 64).cast("int"), "mh": F.ceil(F.col("h") / 64).cast("int")})
    g = grid.tile_grid(p)
    sx, sy = F.col("mw") / F.col("w").cast("double"), F.col("mh") / F.col("h").cast("double")
    return g.withColumns(grid.footprint(F.col("x"), F.col("y"), F.col("tw"), F.col("th"), sx, sy, F.col("mw"), F.col("mh")))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    """(slide, bx, by, mx, my): every mask pixel, made where its block was dealt to."""
    spread = lambda first, last: F.explode(F.sequence(first, last))
    p = planes(spark, d).filter("w > 0 AND h > 0").select("slide", *[(F.ceil(F.col(c) / 64) - 1).alias(f"last_{c}") for c in "wh"])
    for c, at in (("w", "bx"), ("h", "by")):
        p = p.withColumn(at, spread(F.lit(0).cast("long"), F.floor(F.col(f"last_{c}") / grid.BLOCK)))
    p = p.repartition("slide", "bx", "by")
    for c, at, out in (("w", "bx", "mx"), ("h", "by", "my")):
        p = p.withColumn(out, spread(F.col(at) * grid.BLOCK, F.least(F.col(f"last_{c}"), F.col(at) * grid.BLOCK + grid.BLOCK - 1)))
    return p.select("slide", "bx", "by", F.col("mx").cast("int").alias("mx"), F.col("my").cast("int").alias("my"))


@query(sql("planes", body=GRID_SQL + MASK_SQL + """
 SELECT f.slide, col, row, count(*) AS covered, CAST((mx1 - mx0) * (my1 - my0) AS BIGINT) AS area, count(*) / CAST((mx1 - mx0) * (my1 - my0) AS DOUBLE) AS overlap
 FROM feet f JOIN mask m ON f.slide = m.slide AND m.mx >= mx0 AND m.mx < mx1 AND m.my >= my0 AND m.my < my1 GROUP BY f.slide, col, row, mx0, mx1, my0, my1"""))
def tile_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Tissue share of each tile that has any, from a coarse mask."""
    mask = _cells(spark, d).filter("(mx * 7 + my * 5 + slide) % 11 < 4")
    return grid.select_tiles(grid.tile_overlap(_feet(spark, d).select("slide", "col", "row", "mx0", "mx1", "my0", "my1"), mask, placed=True))


CLASS_SQL = """
, hits AS (
  SELECT f.slide, col, row, CAST((mx1 - mx0) * (my1 - my0) AS BIGINT) AS area, (m.mx * 3 + m.my * 5 + f.slide) % 7 + 1 AS cls
  FROM feet f JOIN (SELECT slide, CAST(mx AS INT) AS mx, CAST(my AS INT) AS my FROM (SELECT slide, h, unnest(range(CAST(ceil(w / 64.0) AS BIGINT))) AS mx FROM planes) a, LATERAL (SELECT unnest(range(CAST(ceil(a.h / 64.0) AS BIGINT))) AS my)) m
  ON f.slide = m.slide AND m.mx >= mx0 AND m.mx < mx1 AND m.my >= my0 AND m.my < my1)
, shares AS (
  SELECT slide, col, row, area, round(count(*) FILTER (cls = 2) / CAST(area AS DOUBLE), 4) AS fold_fraction, round(count(*) FILTER (cls = 3) / CAST(area AS DOUBLE), 4) AS darkspot_fraction,
         round(count(*) FILTER (cls = 4) / CAST(area AS DOUBLE), 4) AS pen_fraction, round(count(*) FILTER (cls = 5) / CAST(area AS DOUBLE), 4) AS bubble_fraction,
         round(count(*) FILTER (cls = 6) / CAST(area AS DOUBLE), 4) AS out_of_focus_fraction, round(count(*) FILTER (cls = 7) / CAST(area AS DOUBLE), 4) AS background_fraction
  FROM hits GROUP BY slide, col, row, area)"""


def _shares(spark: SparkSession, d: str) -> DataFrame:
    classes = _cells(spark, d).withColumn("cls", F.expr("(mx * 3 + my * 5 + slide) % 7 + 1"))
    return artifacts.class_fractions(_feet(spark, d).select("slide", "col", "row", "mx0", "mx1", "my0", "my1"), classes, placed=True)


@query(sql("planes", body=GRID_SQL + MASK_SQL + CLASS_SQL + " SELECT * FROM shares"))
def class_fractions(spark: SparkSession, d: str) -> DataFrame:
    """Share of each artifact class in each tile."""
    return _shares(spark, d)


@query(sql("planes", body=GRID_SQL + MASK_SQL + CLASS_SQL + """
 SELECT slide, col, row, m >= 0.18 AS has_artifact,
        CASE WHEN m >= 0.18 THEN CASE m WHEN fold_fraction THEN 'fold' WHEN darkspot_fraction THEN 'darkspot' WHEN pen_fraction THEN 'pen' WHEN bubble_fraction THEN 'bubble' ELSE 'out_of_focus' END END AS artifact_label
 FROM (SELECT *, greatest(fold_fraction, darkspot_fraction, pen_fraction, bubble_fraction, out_of_focus_fraction) AS m FROM shares)"""))
def artifact_label(spark: SparkSession, d: str) -> DataFrame:
    """Each tile's artifact, the first in class order on ties."""
    return artifacts.labelled(_shares(spark, d), least=0.18).select("slide", "col", "row", "has_artifact", "artifact_label")


@query("""
 SELECT l.slide, l.col, l.row, count(*) AS n, count(a.share) AS matched, max(a.share) AS share FROM
  (SELECT l_suppkey AS slide, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_partkey END AS col, l_linenumber AS row FROM lineitem) l
  LEFT JOIN (SELECT slide, col, row, share FROM (
     SELECT l_suppkey AS slide, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_partkey END AS col, l_linenumber AS row, l_quantity AS share,
            row_number() OVER (PARTITION BY 1, l_suppkey, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_partkey END, l_linenumber ORDER BY l_orderkey DESC, l_quantity DESC) AS r
     FROM lineitem WHERE l_returnflag = 'A') WHERE r = 1) a
  ON l.slide IS NOT DISTINCT FROM a.slide AND l.col IS NOT DISTINCT FROM a.col AND l.row IS NOT DISTINCT FROM a.row GROUP BY ALL""")
def artifact_merge_nullsafe(spark: SparkSession, d: str) -> DataFrame:
    """Tiles with the artifact row of the same place; missing places match, the last duplicate counts."""
    col = F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey"))
    rows = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("slide"), col.alias("col"), F.col("l_linenumber").alias("row"), "l_returnflag", "l_orderkey", F.col("l_quantity").alias("share"))
    right = rows.filter("l_returnflag = 'A'").select("slide", "col", "row", "share", F.struct("l_orderkey", "share").alias("ord"))
    both = artifacts.merged(rows.select("slide", "col", "row"), right)
    return both.groupBy("slide", "col", "row").agg(F.count(F.lit(1)).alias("n"), F.count("share").alias("matched"), F.max("share").alias("share"))


@query("""
 WITH t AS (SELECT l_suppkey AS slide, l_orderkey AS ord, l_linenumber AS line, l_partkey % 40 * 64 + CASE WHEN l_quantity > 45 THEN 0.5 ELSE 0 END AS x, l_quantity * 32 - 64 AS y, 64.0 AS w, CASE WHEN l_tax > 0.07 THEN 600.0 ELSE 64.0 END AS h FROM lineitem)
 , p AS (SELECT *, CASE WHEN x <> floor(x) OR y <> floor(y) THEN 'not whole numbers' WHEN w < 1 OR h < 1 THEN 'empty' WHEN w > 512 OR h > 512 THEN 'larger than a tile'
        WHEN x < 0 OR y < 0 OR x + w > 2048 OR y + h > 1600 THEN 'outside the plane' END AS problem FROM t)
 , q AS (SELECT slide, coalesce(problem, CASE WHEN row_number() OVER (PARTITION BY slide, problem, x, y, w, h ORDER BY ord, line) > 1 THEN 'duplicate' END) AS problem FROM p)
 SELECT slide, problem, count(*) AS n FROM q GROUP BY ALL""")
def tile_list_validation(spark: SparkSession, d: str) -> DataFrame:
    """Given tile lists: what is wrong with how many tiles of each slide."""
    t = read(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("slide"), F.struct("l_orderkey", "l_linenumber").alias("ord"),
        (F.col("l_partkey") % 40 * 64 + F.when(F.col("l_quantity") > 45, 0.5).otherwise(0.0)).alias("x"), (F.col("l_quantity") * 32 - 64).alias("y"),
        F.lit(64.0).alias("w"), F.when(F.col("l_tax") > 0.07, 600.0).otherwise(64.0).alias("h"), F.lit(2048).alias("pw"), F.lit(1600).alias("ph"),
    )
    return checks.valid_tiles(t, "pw", "ph", 512).groupBy("slide", "problem").agg(F.count(F.lit(1)).alias("n"))


@query(sql("tiles", body="""
 SELECT slide, n_kept / CAST(n AS DOUBLE) AS kept_fraction FROM (SELECT slide, count(*) AS n, count(*) FILTER (coarse >= 0.3 AND refined >= 0.3 AND NOT read_error) AS n_kept FROM tiles GROUP BY slide)"""))
def kept_fraction(spark: SparkSession, d: str) -> DataFrame:
    got = _dropped(spark, d).groupBy("slide").agg(F.count_if("kept").alias("k"), F.count(F.lit(1)).alias("n"))
    return got.select("slide", fraction(F.col("k"), F.col("n")).alias("kept_fraction"))


@query(sql("gray_planes", body="""
 SELECT label, CAST(least(floor((g - lo) / CAST(hi - lo AS DOUBLE) * 30), 29) AS INT) AS bin, count(*) AS n
 FROM gray_planes JOIN (SELECT label, min(g) AS lo, max(g) AS hi FROM gray_planes GROUP BY label) USING (label) GROUP BY ALL"""))
def range_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Histogram in 30 equal bins over each label's range, the last bin closed."""
    return measures.binned(gray_planes(spark, d), ["label"], "g").filter("n > 0").select("label", "bin", "n")
