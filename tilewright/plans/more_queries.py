"""Registered queries on further operators: geometry, templates, adapters, overlays, integrity, and dense
kernels on small planes (the latter without SQL: NumPy tests hold them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import pixels
from tilewright.functions.guards import finite_or_null
from tilewright.operators import batch, checks, folds, grid, metadata, normalization, planes, slide_measures, tissue, verdict
from tilewright.plans.standins import read, rgb_planes, runs, sql

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return register


@query("SELECT l_suppkey AS slide, CAST(greatest(0, least(l_partkey * 7 - 300, 4096 - l_linenumber * 64)) AS BIGINT) AS origin, count(*) AS n FROM lineitem GROUP BY ALL")
def window_origin_clamp(spark: SparkSession, d: str) -> DataFrame:
    """Windows that would reach over an edge are moved inside."""
    start, size = F.col("l_partkey") * 7 - 300, F.col("l_linenumber") * 64
    rows = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("slide"), grid.window_origin(start, size, F.lit(4096)).cast("long").alias("origin"))
    return rows.groupBy("slide", "origin").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey AS slide, l AS level, (0.1::DOUBLE + p_size % 7 * 0.05::DOUBLE) * pow(4, l) AS mpp FROM part, (SELECT CAST(unnest(range(4)) AS INT) AS l)")
def pyramid_scales(spark: SparkSession, d: str) -> DataFrame:
    """Microns per pixel of each pyramid level."""
    p = read(spark, d, "part").select(F.col("p_partkey").alias("slide"), grid.level_mpps(0.1 + F.col("p_size") % 7 * 0.05, F.array(*[F.lit(4.0**k) for k in range(4)])).alias("m"))
    return p.select("slide", F.posexplode("m").alias("level", "mpp"))


@query(sql("runs", body="""
 , l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY started DESC, suffix DESC, folder DESC) AS r FROM runs WHERE state = 'completed') WHERE r = 1)
 SELECT c_custkey AS slide, CASE WHEN l.folder IS NOT NULL THEN 'run-' || l.folder || '/c' || c_custkey || '_tissue.png' END AS resolved FROM customer LEFT JOIN l ON l.slide = c_custkey"""))
def template_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Artifact paths filled in from each slide's latest completed run; none without one."""
    latest = batch.latest_runs(runs(spark, d), state="completed").select("slide", F.concat(F.lit("run-"), F.col("folder").cast("string")).alias("run_dir"))
    jobs = read(spark, d, "customer").select(F.col("c_custkey").alias("slide"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("slide_id")).withColumn("job_key", F.col("slide_id"))
    return batch.resolved_template(jobs.join(latest, "slide", "left"), "{run_dir}/{slide_id}_tissue.png").select("slide", "resolved")


@query("SELECT page_id AS slide, count(*) OVER (PARTITION BY regexp_replace(url, '[?#].*$', '')) > 1 AS collides FROM pages")
def output_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Jobs that would write to the same place."""
    p = read(spark, d, "pages").select(F.col("page_id").alias("slide"), F.regexp_replace("url", "[?#].*$", "").alias("to"))
    return batch.collisions(p, "to").select("slide", "collides")


@query(r"SELECT s_suppkey AS slide, 'gs://bank/' || regexp_replace(replace('slides\' || s_name, '\', '/'), '^/+', '') AS slide_path FROM supplier")
def adapter_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths of a shared drive as cloud paths."""
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("slide"), F.concat(F.lit("Z:\\slides\\"), "s_name").alias("file_path"))
    return metadata.adapt("windows_share", s, prefix="gs://bank").select("slide", "slide_path")


@query("SELECT c_custkey AS slide, c_mktsegment AS stain, CAST(NULL AS VARCHAR) AS block, c_name AS extra_name FROM customer")
def standard_record(spark: SparkSession, d: str) -> DataFrame:
    """Standard columns of a metadata table; what it lacks is null, what is left goes into a map."""
    c = read(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_name")
    got = metadata.standard(c, {"slide": "c_custkey", "stain": "c_mktsegment", "block": None})
    return got.select(F.col("slide").cast("long").alias("slide"), "stain", "block", F.element_at("extra", "c_name").alias("extra_name"))


@query("SELECT p_partkey AS slide, p_size > 3 AND p_size % 5 <> 0 AND p_size % 7 <> 0 AS sound FROM part")
def integrity_check(spark: SparkSession, d: str) -> DataFrame:
    """Pyramids that are empty, not ordered, or have an unreadable spot are not sound."""
    k = F.col("p_size")
    steps = F.when(k % 5 == 0, F.array(F.lit(1.0), F.lit(16.0), F.lit(4.0))).otherwise(F.array(F.lit(1.0), F.lit(4.0), F.lit(16.0)))
    spots = F.array(F.lit(True), k % 7 != 0)
    return read(spark, d, "part").select(F.col("p_partkey").alias("slide"), checks.integrity(k - 3, k, steps, spots).alias("sound"))


@query(sql("rgb_planes", body="""
 SELECT plane, CAST(sum(CASE WHEN g > 140 THEN CAST(floor(r * 0.6::DOUBLE + 255 * 0.4::DOUBLE) AS INT) ELSE r END) AS BIGINT) AS red, CAST(sum(CASE WHEN g > 140 THEN CAST(floor(b * 0.6::DOUBLE + 0 * 0.4::DOUBLE) AS INT) ELSE b END) AS BIGINT) AS blue FROM rgb_planes GROUP BY plane"""))
def overlay_blend(spark: SparkSession, d: str) -> DataFrame:
    """Sums of channels after a mask was tinted red."""
    p, where = rgb_planes(spark, d), F.col("g") > 140
    return p.groupBy("plane").agg(F.sum(pixels.blend(F.col("r"), 255, 0.4, where).cast("long")).alias("red"), F.sum(pixels.blend(F.col("b"), 0, 0.4, where).cast("long")).alias("blue"))


@query("""
 WITH t AS (SELECT l_suppkey AS slide, l_quantity / 50 AS t FROM lineitem)
 SELECT slide, round(sum(CASE WHEN t <= 0.5 THEN 255.0 ELSE 255 * (2 - 2 * t) END), 3) AS red, round(sum(CASE WHEN t <= 0.5 THEN 510 * t ELSE 255.0 END), 3) AS green FROM t GROUP BY slide""")
def heat_ramp(spark: SparkSession, d: str) -> DataFrame:
    """Colours of tiles from red over yellow to green."""
    red, green, _ = pixels.heat(F.col("l_quantity") / 50)
    return read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("slide")).agg(F.round(F.sum(red), 3).alias("red"), F.round(F.sum(green), 3).alias("green"))


@query("SELECT v AS density_of, CAST(floor(greatest(0, least(255, 255 * exp(-greatest(-ln(greatest(v, 1) / 255.0::DOUBLE), 1e-6)) + 1e-6))) AS INT) AS back FROM (SELECT DISTINCT CAST(p_size * 5 AS INT) AS v FROM part)")
def density_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Optical density and back (a little is added, as truncation would otherwise depend on the last bit)."""
    v = read(spark, d, "part").select((F.col("p_size") * 5).cast("int").alias("density_of")).distinct()
    back = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), 255 * F.exp(-pixels.density(F.col("density_of"))) + 1e-6))).cast("int")
    return v.select("density_of", back.alias("back"))


@query("""
 SELECT o_custkey AS slide, greatest(0, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS DOUBLE) - coalesce(CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) END) AS DOUBLE), 0)) AS rest FROM orders GROUP BY o_custkey""")
def unattributed_time(spark: SparkSession, d: str) -> DataFrame:
    """Seconds that no component accounts for."""
    s = F.col("o_totalprice").cast("long")
    got = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("slide")).agg(F.sum(s).cast("double").alias("total"), F.sum(F.when(F.col("o_orderstatus") == "F", s)).cast("double").alias("parts"))
    return got.select("slide", verdict.unattributed(F.col("total"), F.col("parts")).alias("rest"))


@query("SELECT event_id, CASE WHEN NOT isnan(value) AND abs(value) < 'inf'::DOUBLE THEN value END AS value FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'inf'::DOUBLE ELSE value END AS value FROM events)")
def json_safe_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers as reports keep them: what is not finite is null."""
    k = F.col("event_id") % 5
    v = F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).otherwise(F.col("value"))
    return read(spark, d, "events").select("event_id", finite_or_null(v).alias("value"))


def _dense(spark: SparkSession, d: str) -> DataFrame:
    return planes.packed_planes(rgb_planes(spark, d), 8, 8, ["r", "g", "b"])


@query()
def tissue_segmentation(spark: SparkSession, d: str) -> DataFrame:
    """Tissue of each small plane, by the adaptive method."""
    return tissue.segment(_dense(spark, d), "adaptive").select("plane", "coverage", "method", "error_type")


def _masked(spark: SparkSession, d: str) -> DataFrame:
    p = _dense(spark, d)
    return p.join(tissue.segment(p, "otsu").select("plane", F.col("mask").alias("tissue")), "plane")


@query()
def slide_quality(spark: SparkSession, d: str) -> DataFrame:
    """Focus and staining over the tissue of each small plane."""
    return slide_measures.measure(_masked(spark, d)).select("plane", "focus", "staining", "support_px", "error_type")


@query()
def fold_detection(spark: SparkSession, d: str) -> DataFrame:
    """Soft and line folds of each small plane."""
    found = folds.detect(_masked(spark, d).withColumn("mpp", F.lit(100.0)))
    return found.select("plane", "fold_fraction", "soft_fraction", "line_fraction", "line_error", "error_type")


@query()
def stain_fit(spark: SparkSession, d: str) -> DataFrame:
    """Frozen Macenko parameters of each small plane."""
    return normalization.fit_planes(_dense(spark, d)).select("plane", "params_hash", "n_px", "error_type")


@query()
def stain_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Each small plane moved to one target by Reinhard's method."""
    p = _dense(spark, d)
    target = {"method": "reinhard", "means": [60.0, 10.0, -5.0], "stds": [12.0, 6.0, 4.0], "n_px": 1}
    return normalization.normalize_planes(p, normalization.fit_planes(p, "reinhard"), target).select("plane", F.sha2("data", 256).alias("digest"), "error_type")
