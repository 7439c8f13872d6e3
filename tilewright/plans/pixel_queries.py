"""Registered queries on pixels: colour, thresholds, masks, focus, regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import pixels
from tilewright.operators import artifacts, masks, measures, planes
from tilewright.plans.standins import gray_planes, rgb_planes, sql

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return register


@query(sql("gray_planes", body=" SELECT label, g, count(*) AS n FROM gray_planes GROUP BY ALL"))
def gray_hist(spark: SparkSession, d: str) -> DataFrame:
    return measures.histogram(gray_planes(spark, d), ["label"], "g")


_OTSU = """
 , hist AS (SELECT plane, g AS v, count(*) AS n FROM gray_planes GROUP BY ALL)
 , sums AS (SELECT plane, v, sum(n) OVER a AS w0, sum(n * v) OVER a AS m0, sum(n) OVER (PARTITION BY plane) AS w, sum(n * v) OVER (PARTITION BY plane) AS m FROM hist WINDOW a AS (PARTITION BY plane ORDER BY v))
 , gaps AS (SELECT plane, v, CAST(m * w0 - m0 * w AS DOUBLE) AS gap, CAST(w0 * (w - w0) AS DOUBLE) AS ww FROM sums)
 , otsu AS (SELECT plane, v AS threshold FROM (SELECT plane, v, row_number() OVER (PARTITION BY plane ORDER BY CASE WHEN ww = 0 THEN -1 ELSE gap * gap / ww END DESC, v) AS r FROM gaps) WHERE r = 1)"""


@query(sql("gray_planes", body=_OTSU + " SELECT plane, threshold FROM otsu"))
def otsu_threshold(spark: SparkSession, d: str) -> DataFrame:
    """Otsu's threshold of each plane."""
    return measures.otsu(measures.histogram(gray_planes(spark, d), ["plane"], "g"), ["plane"], "g")


def _tissue(spark: SparkSession, d: str) -> DataFrame:
    p = gray_planes(spark, d)
    return p.join(measures.otsu(measures.histogram(p, ["plane"], "g"), ["plane"], "g"), "plane")


@query(sql("gray_planes", body=_OTSU + " SELECT plane, count(*) AS px, count(*) FILTER (g <= threshold) AS set_px, count(*) FILTER (g <= threshold) / CAST(count(*) AS DOUBLE) AS coverage FROM gray_planes JOIN otsu USING (plane) GROUP BY plane"))
def tissue_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Share of each plane that is darker than its threshold."""
    return measures.coverage(_tissue(spark, d), F.col("g") <= F.col("threshold"), ["plane"])


def _mask(spark: SparkSession, d: str, condition: str) -> DataFrame:
    return gray_planes(spark, d).filter(condition).select("plane", "y", "x")


@query(sql("gray_planes", body=" SELECT plane, count(*) AS px FROM gray_planes WHERE g > 140 OR (g + x) % 3 = 0 GROUP BY plane"))
def mask_union(spark: SparkSession, d: str) -> DataFrame:
    return masks.combine(_mask(spark, d, "g > 140"), _mask(spark, d, "(g + x) % 3 = 0")).groupBy("plane").agg(F.count(F.lit(1)).alias("px"))


@query(sql("gray_planes", body=" SELECT plane, count(*) AS px FROM gray_planes WHERE g > 140 AND (g + x) % 3 = 0 GROUP BY plane"))
def mask_intersect(spark: SparkSession, d: str) -> DataFrame:
    return masks.combine(_mask(spark, d, "g > 140"), _mask(spark, d, "(g + x) % 3 = 0"), "intersection").groupBy("plane").agg(F.count(F.lit(1)).alias("px"))


@query(sql("gray_planes", body=" SELECT plane, count(*) AS px FROM gray_planes WHERE g > 100 AND NOT g > 180 AND NOT (g + y) % 5 = 0 GROUP BY plane"))
def support_except(spark: SparkSession, d: str) -> DataFrame:
    """Tissue without folds and pen."""
    got = masks.support(_mask(spark, d, "g > 100"), _mask(spark, d, "g > 180"), _mask(spark, d, "(g + y) % 5 = 0"))
    return got.groupBy("plane").agg(F.count(F.lit(1)).alias("px"))


@query(sql("gray_planes", body="""
 SELECT plane, count(*) AS px FROM gray_planes s WHERE g >= 130 AND EXISTS (SELECT 1 FROM gray_planes h WHERE h.plane = s.plane AND h.g >= 180 AND abs(h.y - s.y) <= 2 AND abs(h.x - s.x) <= 2) GROUP BY plane"""))
def hysteresis_semi(spark: SparkSession, d: str) -> DataFrame:
    """Soft pixels near a hard one."""
    return masks.within(_mask(spark, d, "g >= 130"), _mask(spark, d, "g >= 180")).groupBy("plane").agg(F.count(F.lit(1)).alias("px"))


@query(sql("gray_planes", body="""
 SELECT plane, count(*) FILTER (g > 150) AS px, count(*) FILTER (g > 150 AND (g + x) % 4 = 0) AS overlap_px, count(*) FILTER (g > 150 AND (g + x) % 4 <> 0) AS kept_px, count(*) FILTER (g > 90) AS tissue_px,
   CASE WHEN count(*) FILTER (g > 90) > 0 THEN count(*) FILTER (g > 150 AND (g + x) % 4 <> 0) / CAST(count(*) FILTER (g > 90) AS DOUBLE) END AS fraction
 FROM gray_planes GROUP BY plane HAVING count(*) FILTER (g > 90 OR (g + x) % 4 = 0) > 0"""))
def pen_fold_subtract(spark: SparkSession, d: str) -> DataFrame:
    """Folds without pen, as a share of all tissue."""
    return masks.subtracted(_mask(spark, d, "g > 150"), _mask(spark, d, "(g + x) % 4 = 0"), _mask(spark, d, "g > 90"))


@query(sql("gray_planes", body="""
 , n AS (SELECT plane, g, coalesce(lag(g) OVER a, lead(g) OVER a) + coalesce(lead(g) OVER a, lag(g) OVER a) + coalesce(lag(g) OVER b, lead(g) OVER b) + coalesce(lead(g) OVER b, lag(g) OVER b) - 4 * g AS l
   FROM gray_planes WINDOW a AS (PARTITION BY plane, y ORDER BY x), b AS (PARTITION BY plane, x ORDER BY y))
 SELECT plane, count(*) AS px, CAST(count(*) * sum(l * l) - sum(l) * sum(l) AS DOUBLE) / CAST(count(*) * count(*) AS DOUBLE) AS focus FROM n GROUP BY plane"""))
def laplacian_focus(spark: SparkSession, d: str) -> DataFrame:
    """Sharpness of each plane."""
    return measures.focus(gray_planes(spark, d), ["plane"], "g")


_SAT = """
 , s AS (SELECT plane, (((greatest(r, g, b) - least(r, g, b)) * CAST(CASE WHEN greatest(r, g, b) > 0 THEN round_even(255 * 4096.0::DOUBLE / greatest(r, g, b), 0) ELSE 0 END AS INT) + 2048) >> 12) AS s FROM rgb_planes)"""


@query(sql("rgb_planes", body=_SAT + " SELECT plane, round(quantile_cont(s, 0.95), 4) AS p95, CASE WHEN quantile_cont(s, 0.95) > 60 THEN 'union_s' ELSE 'union' END AS route FROM s GROUP BY plane"))
def sat_p95_router(spark: SparkSession, d: str) -> DataFrame:
    """Which tissue method a plane's saturation asks for."""
    s = rgb_planes(spark, d).withColumn("s", pixels.saturation(F.col("r"), F.col("g"), F.col("b")))
    p = measures.percentiles(s, ["plane"], "s", {"p95": 0.95})
    return p.select("plane", F.round("p95", 4).alias("p95"), F.when(F.col("p95") > 60, "union_s").otherwise("union").alias("route"))


@query(sql("rgb_planes", body=" SELECT plane, count(*) AS px, CAST(sum((9798 * r + 19235 * g + 3735 * b + 16384) >> 15) AS BIGINT) AS gray_sum FROM rgb_planes GROUP BY plane"))
def rgb_gray(spark: SparkSession, d: str) -> DataFrame:
    g = pixels.gray(F.col("r"), F.col("g"), F.col("b"))
    return rgb_planes(spark, d).groupBy("plane").agg(F.count(F.lit(1)).alias("px"), F.sum(g.cast("long")).alias("gray_sum"))


@query(sql("rgb_planes", body="""
 , o AS (SELECT plane, -log10((r + 1) / 256.0::DOUBLE) AS r10, greatest(-ln(greatest(r, 1) / 255.0::DOUBLE), 1e-6) AS re FROM rgb_planes)
 SELECT plane, round(avg(r10), 6) AS mean_10, round(avg(re), 6) AS mean_e, round(max(re), 6) AS max_e FROM o GROUP BY plane"""))
def od_norm_stats(spark: SparkSession, d: str) -> DataFrame:
    """Optical densities in both conventions."""
    o = rgb_planes(spark, d).select("plane", pixels.density10(F.col("r")).alias("r10"), pixels.density(F.col("r")).alias("re"))
    return o.groupBy("plane").agg(F.round(F.avg("r10"), 6).alias("mean_10"), F.round(F.avg("re"), 6).alias("mean_e"), F.round(F.max("re"), 6).alias("max_e"))


@query(sql("rgb_planes", body="""
 , o AS (SELECT plane, greatest(-ln(greatest(r, 1) / 255.0::DOUBLE), 1e-6) AS r, greatest(-ln(greatest(g, 1) / 255.0::DOUBLE), 1e-6) AS g, greatest(-ln(greatest(b, 1) / 255.0::DOUBLE), 1e-6) AS b FROM rgb_planes)
 SELECT plane, count(*) AS n, round(covar_samp(r, r), 6) AS c_r_r, round(covar_samp(r, g), 6) AS c_r_g, round(covar_samp(r, b), 6) AS c_r_b, round(covar_samp(g, g), 6) AS c_g_g, round(covar_samp(g, b), 6) AS c_g_b, round(covar_samp(b, b), 6) AS c_b_b FROM o GROUP BY plane"""))
def stain_covariance(spark: SparkSession, d: str) -> DataFrame:
    """Covariance of optical densities, from which stain vectors are fitted."""
    o = rgb_planes(spark, d).select("plane", *[pixels.density(F.col(c)).alias(c) for c in "rgb"])
    c = measures.covariance(o, ["plane"], ["r", "g", "b"])
    return c.select("plane", "n", *[F.round(x, 6).alias(x) for x in c.columns[2:]])


_LAB = """
 , lin AS (SELECT plane, """ + ", ".join(f"CASE WHEN {c} / 255.0::DOUBLE > 0.04045 THEN pow(({c} / 255.0::DOUBLE + 0.055) / 1.055::DOUBLE, 2.4) ELSE {c} / 255.0::DOUBLE / 12.92::DOUBLE END AS {c}" for c in "rgb") + """ FROM rgb_planes)
 , xyz AS (SELECT plane, (r * 0.412453 + g * 0.357580 + b * 0.180423) / 0.95047::DOUBLE AS x, (r * 0.212671 + g * 0.715160 + b * 0.072169) / 1.0::DOUBLE AS y, (r * 0.019334 + g * 0.119193 + b * 0.950227) / 1.08883::DOUBLE AS z FROM lin)
 , f AS (SELECT plane, """ + ", ".join(f"CASE WHEN {c} > 0.008856 THEN cbrt({c}) ELSE 7.787 * {c} + 16.0::DOUBLE / 116 END AS {c}" for c in "xyz") + """ FROM xyz)
 , lab AS (SELECT plane, 116 * y - 16 AS l, 500 * (x - y) AS a, 200 * (y - z) AS bb FROM f)"""


@query(sql("rgb_planes", body=_LAB + " SELECT plane, count(*) AS n, round(avg(l), 6) AS mean_l, round(avg(a), 6) AS mean_a, round(avg(bb), 6) AS mean_bb, round(stddev_pop(l), 6) AS std_l, round(stddev_pop(a), 6) AS std_a, round(stddev_pop(bb), 6) AS std_bb FROM lab GROUP BY plane"))
def reinhard_stats(spark: SparkSession, d: str) -> DataFrame:
    """Mean and deviation of the Lab channels of each plane."""
    lab = pixels.lab(F.col("r"), F.col("g"), F.col("b"))
    rows = rgb_planes(spark, d).select("plane", *[c.alias(n) for c, n in zip(lab, ("l", "a", "bb"))])
    m = measures.channel_moments(rows, ["plane"], ["l", "a", "bb"])
    return m.select("plane", "n", *[F.round(c, 6).alias(c) for c in m.columns[2:]])


@query(sql("rgb_planes", body=_LAB + " SELECT plane, round(avg(sqrt(a * a + bb * bb)), 6) AS staining FROM lab GROUP BY plane"))
def staining_chroma(spark: SparkSession, d: str) -> DataFrame:
    """Mean chroma of each plane."""
    rows = rgb_planes(spark, d).select("plane", pixels.chroma(F.col("r"), F.col("g"), F.col("b")).alias("c"))
    return rows.groupBy("plane").agg(F.round(F.avg("c"), 6).alias("staining"))


@query(sql("rgb_planes", body="""
 , h AS (SELECT plane, (r + g + b) / 765.0::DOUBLE AS i, least(r, g, b) / 255.0::DOUBLE AS lo FROM rgb_planes)
 SELECT plane, round(avg(i), 6) AS mean_i, round(avg(CASE WHEN i > 0 THEN greatest(0, least(1, 1 - lo / i)) ELSE 0 END), 6) AS mean_s FROM h GROUP BY plane"""))
def hsi_means(spark: SparkSession, d: str) -> DataFrame:
    i, s = pixels.hsi(F.col("r"), F.col("g"), F.col("b"))
    return rgb_planes(spark, d).groupBy("plane").agg(F.round(F.avg(i), 6).alias("mean_i"), F.round(F.avg(s), 6).alias("mean_s"))


@query(sql("gray_planes", body=" SELECT plane, l AS level, CAST(y // (1 << l) AS INT) AS y, CAST(x // (1 << l) AS INT) AS x FROM (SELECT *, CAST(unnest(range(4)) AS INT) AS l FROM gray_planes WHERE g > 140) WHERE y % (1 << l) = 0 AND x % (1 << l) = 0"))
def mask_pyramid(spark: SparkSession, d: str) -> DataFrame:
    """A mask at four levels, each with every second pixel of the one before."""
    return masks.pyramid(_mask(spark, d, "g > 140")).select("plane", "level", "y", "x")


@query(sql("gray_planes", body=" SELECT plane, y, CAST(0 AS INT) AS byte_x, CAST(sum(1 << (7 - x)) AS INT) AS bits FROM gray_planes WHERE g > 140 GROUP BY plane, y"))
def mask_packed(spark: SparkSession, d: str) -> DataFrame:
    """Masks as packed bits; pixels that come twice set their bit once."""
    m = _mask(spark, d, "g > 140")
    return masks.packed(m.unionAll(m)).select("plane", "y", "byte_x", F.col("bits").cast("int").alias("bits"))


@query(sql("gray_planes", body="""
 , p AS (SELECT label, quantile_cont(g, 0.01) AS lo, quantile_cont(g, 0.99) AS hi FROM gray_planes GROUP BY label)
 SELECT plane, count(*) FILTER (i >= 200) AS hard_px, max(i) AS top FROM (SELECT plane, CAST(round_even(255 * greatest(0, least(1, (g - lo) / (hi - lo))), 0) AS INT) AS i FROM gray_planes JOIN p USING (label)) GROUP BY plane"""))
def fline_stretch(spark: SparkSession, d: str) -> DataFrame:
    """Hard pixels after a stretch between percentiles."""
    s = measures.stretched(gray_planes(spark, d), ["label"], "g")
    return s.groupBy("plane").agg(F.count_if("hard").alias("hard_px"), F.max("idx").alias("top"))


@query(sql("gray_planes", body="""
 , e AS (SELECT label, g / 40.0::DOUBLE AS v FROM gray_planes), r AS (SELECT label, min(v) AS lo, max(v) AS hi FROM e GROUP BY label)
 , c AS (SELECT label, CAST(least(floor((v - lo) / (hi - lo) * 30), 29) AS INT) AS bin, count(*) AS n FROM e JOIN r USING (label) GROUP BY ALL)
 , a AS (SELECT label, lo, hi, CAST(b AS INT) AS bin, coalesce(n, 0) AS n FROM (SELECT *, unnest(range(30)) AS b FROM r) x LEFT JOIN c USING (label) WHERE c.bin = b OR c.bin IS NULL)
 , f AS (SELECT r.label, r.lo, r.hi, CAST(t.b AS INT) AS bin, coalesce(c.n, 0) AS n FROM r CROSS JOIN (SELECT unnest(range(30)) AS b) t LEFT JOIN c ON c.label = r.label AND c.bin = t.b)
 , m AS (SELECT label, bin, n, lo + (hi - lo) * bin / 30 AS edge, coalesce(n < lag(n) OVER w AND n < lead(n) OVER w, false) AS low FROM f WINDOW w AS (PARTITION BY label ORDER BY bin))
 SELECT label, coalesce(arg_max(edge, bin) FILTER (low AND edge > 1 AND edge < 4), arg_min(edge, n * 100 + bin) FILTER (low), 2.5) AS threshold FROM m GROUP BY label""").replace(""" , a AS (SELECT label, lo, hi, CAST(b AS INT) AS bin, coalesce(n, 0) AS n FROM (SELECT *, unnest(range(30)) AS b FROM r) x LEFT JOIN c USING (label) WHERE c.bin = b OR c.bin IS NULL)
""", ""))
def entropy_local_minimum(spark: SparkSession, d: str) -> DataFrame:
    """The threshold at the last local minimum of each label's histogram."""
    e = gray_planes(spark, d).select("label", (F.col("g") / 40.0).alias("v"))
    return measures.minimum_threshold(measures.binned(e, ["label"], "v"), ["label"])


_REGIONS = """
 , m AS (SELECT plane, y, x FROM gray_planes WHERE g > 140)
 , reach AS (SELECT plane, y, x, y AS ry, x AS rx FROM m UNION SELECT r.plane, r.y, r.x, m.y, m.x FROM reach r JOIN m ON m.plane = r.plane AND abs(m.y - r.ry) <= 1 AND abs(m.x - r.rx) <= 1)
 , lab AS (SELECT plane, y, x, min(ry * 8 + rx) AS label FROM reach GROUP BY ALL)
 , reg AS (SELECT plane, label, count(*) AS area, min(y) AS y0, min(x) AS x0, max(y) + 1 AS y1, max(x) + 1 AS x1 FROM lab GROUP BY ALL)"""


def _regions(spark: SparkSession, d: str) -> DataFrame:
    labels = planes.labelled_pixels(_mask(spark, d, "g > 140"), 8, 8)
    return artifacts.region_stats(labels, ["plane"])


@query(sql("gray_planes", body=_REGIONS + " SELECT plane, label, area, y0, x0, y1, x1 FROM reg").replace("WITH", "WITH RECURSIVE", 1))
def component_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Regions of each plane's mask (8 neighbours) with their areas and boxes."""
    return _regions(spark, d).select("plane", "label", "area", "y0", "x0", "y1", "x1")


@query(sql("gray_planes", body=_REGIONS + " SELECT plane, label, area FROM (SELECT *, row_number() OVER (PARTITION BY plane ORDER BY area DESC, label) AS r FROM reg) WHERE r = 1").replace("WITH", "WITH RECURSIVE", 1))
def largest_component(spark: SparkSession, d: str) -> DataFrame:
    return artifacts.largest_region(_regions(spark, d), ["plane"]).select("plane", "label", "area")


@query(sql("gray_planes", body=_REGIONS + " SELECT plane, count(*) AS regions, CAST(sum(area) AS BIGINT) AS px FROM reg WHERE area > 3 GROUP BY plane").replace("WITH", "WITH RECURSIVE", 1))
def small_objects_removed(spark: SparkSession, d: str) -> DataFrame:
    """What is left of each mask without regions of up to three pixels."""
    return _regions(spark, d).filter("area > 3").groupBy("plane").agg(F.count(F.lit(1)).alias("regions"), F.sum("area").alias("px"))


@query(sql("gray_planes", body="""
 , c AS (SELECT plane, t, count(*) AS c FROM gray_planes, (SELECT unnest(range(0, 256, 16)) AS t) WHERE g > t GROUP BY ALL), m AS (SELECT plane, t, c, max(c) OVER (PARTITION BY plane) AS top FROM c)
 SELECT plane, CAST(coalesce(max(t) FILTER (c >= 0.64::DOUBLE * top), min(t)) AS INT) AS t_hard FROM m GROUP BY plane"""))
def threshold_inversion(spark: SparkSession, d: str) -> DataFrame:
    """The highest level at which the count is still a share of its maximum."""
    levels = gray_planes(spark, d).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(240), F.lit(16)))).filter("g > t")
    curve = levels.groupBy("plane", "t").agg(F.count(F.lit(1)).alias("c"))
    return measures.threshold_at(curve, ["plane"], 0.64, "t_hard")


@query(sql("gray_planes", body="""
 , m AS (SELECT plane, y, x FROM gray_planes WHERE g > 100), o AS (SELECT * FROM (VALUES (0,0),(0,1),(1,0),(0,-1),(-1,0)) o(dy, dx))
 , e AS (SELECT m.plane, m.y, m.x FROM m, o JOIN m n ON true WHERE n.plane = m.plane AND n.y = m.y + dy AND n.x = m.x + dx GROUP BY ALL HAVING count(*) = 5)
 SELECT plane, count(*) AS px FROM (SELECT DISTINCT e.plane, e.y + dy AS y, e.x + dx AS x FROM e, o) GROUP BY plane"""))
def mask_opening(spark: SparkSession, d: str) -> DataFrame:
    """Opening of each mask with a disc of radius one."""
    m = _mask(spark, d, "g > 100")
    return masks.dilate(masks.erode(m, masks.disk(1)), masks.disk(1)).groupBy("plane").agg(F.count(F.lit(1)).alias("px"))
