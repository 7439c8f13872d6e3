"""Registered queries on records: acceptance, metadata, ledgers, verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import text
from tilewright.operators import batch, checks, grid, metadata, verdict
from tilewright.plans.standins import read, runs, sql, tiles

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return register


#: Headers: every supplier a slide whose scale is stated, finer than plausible, missing or nonsense.
_HEADERS = """
 h AS (SELECT s_suppkey AS slide,
   CASE s_suppkey % 5 WHEN 0 THEN 0.5 WHEN 1 THEN 0.05 WHEN 2 THEN NULL WHEN 3 THEN 500.0 ELSE 0.1 * (1 + s_nationkey) END AS mpp_x,
   CASE s_suppkey % 5 WHEN 0 THEN 0.5 WHEN 1 THEN 0.06 WHEN 2 THEN NULL WHEN 3 THEN 0.5 ELSE 0.1 * (1 + s_nationkey) END AS mpp_y,
   CASE s_suppkey % 4 WHEN 0 THEN 20.0 WHEN 1 THEN 150.0 WHEN 2 THEN NULL ELSE 10.0 END AS objective_power FROM supplier)
 , c AS (SELECT *, mpp_x BETWEEN 0.1 AND 10 AND mpp_y BETWEEN 0.1 AND 10 AS stated,
   coalesce(mpp_x > 0 AND mpp_x < 0.1 AND mpp_x * objective_power BETWEEN 5 AND 15, false) AND coalesce(mpp_y > 0 AND mpp_y < 0.1 AND mpp_y * objective_power BETWEEN 5 AND 15, false) AS fine,
   CASE WHEN objective_power > 0 THEN 10.0::DOUBLE / objective_power END AS derived FROM h)
 , s AS (SELECT *, CASE WHEN stated OR fine THEN greatest(mpp_x, mpp_y) WHEN derived BETWEEN 0.1 AND 10 THEN derived END AS effective_mpp,
   CASE WHEN stated THEN 'stated' WHEN fine THEN 'stated sub-floor' WHEN derived BETWEEN 0.1 AND 10 THEN 'derived from objective' END AS scale_source FROM c)
 , p AS (SELECT *, effective_mpp IS NULL AS implausible, coalesce(effective_mpp <= 0.5::DOUBLE + 0.05::DOUBLE, false) AS mpp_passed FROM s)"""


def _headers(spark: SparkSession, d: str) -> DataFrame:
    k, power = F.col("s_suppkey") % 5, F.col("s_suppkey") % 4
    own = F.lit(0.1) * (1 + F.col("s_nationkey"))
    x = F.when(k == 0, 0.5).when(k == 1, 0.05).when(k == 2, None).when(k == 3, 500.0).otherwise(own)
    y = F.when(k == 0, 0.5).when(k == 1, 0.06).when(k == 2, None).when(k == 3, 0.5).otherwise(own)
    p = F.when(power == 0, 20.0).when(power == 1, 150.0).when(power == 2, None).otherwise(10.0)
    return read(spark, d, "supplier").select(F.col("s_suppkey").alias("slide"), x.alias("mpp_x"), y.alias("mpp_y"), p.alias("objective_power"))


def _header_sql(body: str) -> str:
    # Literals with a point are decimals in DuckDB; headers are doubles.
    casts = " ".join(f"CAST({c} AS DOUBLE) AS {c}," for c in ("mpp_x", "mpp_y", "objective_power"))[:-1]
    return "WITH " + _HEADERS.replace("THEN 10.0::DOUBLE / objective_power", "THEN 10.0::DOUBLE / objective_power").replace("0.1 * (1 + s_nationkey)", "0.1::DOUBLE * (1 + s_nationkey)").replace("FROM h)", f"FROM (SELECT slide, {casts} FROM h))") + body


@query(_header_sql(" SELECT slide, effective_mpp, scale_source, implausible, mpp_passed FROM p"))
def mpp_check(spark: SparkSession, d: str) -> DataFrame:
    """What scale each slide has and whether it suffices."""
    return checks.scale_check(_headers(spark, d)).select("slide", "effective_mpp", "scale_source", "implausible", "mpp_passed")


@query(_header_sql(" SELECT slide, objective_power >= 20 AS passed FROM h"))
def magnification_check(spark: SparkSession, d: str) -> DataFrame:
    return _headers(spark, d).select("slide", checks.magnification(F.col("objective_power")).alias("passed"))


@query(_header_sql("""
 SELECT slide, CASE WHEN scale_source LIKE 'derived%' THEN effective_mpp ELSE mpp_x END AS mpp_x, mpp_x AS raw_mpp_x,
   CASE WHEN implausible THEN 'no plausible scale' END AS plane_gate, CASE WHEN implausible THEN 'no plausible scale' WHEN NOT mpp_passed THEN printf('scale %.4f is coarser than the target', effective_mpp) END AS tile_gate FROM p"""))
def scale_substitution_and_gates(spark: SparkSession, d: str) -> DataFrame:
    """The scale that later stages use, and why stages are gated."""
    return checks.gates(checks.effective_scale(checks.scale_check(_headers(spark, d)))).select("slide", "mpp_x", "raw_mpp_x", "plane_gate", "tile_gate")


@query(_header_sql("""
 , f AS (SELECT slide, coalesce(objective_power >= 20, false) AS mag, mpp_passed, slide % 6 <> 0 AS sound FROM p)
 SELECT slide, concat_ws(',', CASE WHEN NOT mag THEN 'magnification' END, CASE WHEN NOT mpp_passed THEN 'mpp' END) AS flags,
   CASE WHEN NOT sound OR NOT mpp_passed THEN 'quarantine' ELSE 'accept' END AS decision FROM f"""))
def quarantine_decision(spark: SparkSession, d: str) -> DataFrame:
    """Broken slides and those that fail the enforced policy are held back; other policies flag."""
    h = checks.scale_check(_headers(spark, d))
    got = checks.quarantine(h, {"magnification": checks.magnification(F.col("objective_power")), "mpp": F.col("mpp_passed")}, F.col("slide") % 6 != 0, enforced="mpp")
    return got.select("slide", F.concat_ws(",", "flags").alias("flags"), "decision")


@query("""
 WITH l AS (SELECT p_partkey AS slide, 0.1::DOUBLE + p_size % 7 * 0.05::DOUBLE AS mpp, p_size * 4096 AS w0, p_size * 3072 AS h0 FROM part)
 , e AS (SELECT slide, l, (mpp * pow(4, l)) AS m, CAST(w0 / pow(4, l) AS INT) AS lw, CAST(h0 / pow(4, l) AS INT) AS lh FROM l, range(4) t(l))
 , b AS (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY m <= 8.0::DOUBLE * (1 + 0.1::DOUBLE) DESC, CASE WHEN m <= 8.0::DOUBLE * (1 + 0.1::DOUBLE) THEN -m ELSE m END) AS r FROM e)
 SELECT slide, CAST(l AS INT) AS level, 8.0::DOUBLE / m AS ratio, greatest(1, CAST(round_even(lw / (8.0::DOUBLE / m), 0) AS INT)) AS plane_w, greatest(1, CAST(round_even(lh / (8.0::DOUBLE / m), 0) AS INT)) AS plane_h FROM b WHERE r = 1""")
def level_plan(spark: SparkSession, d: str) -> DataFrame:
    """Pyramid level and plane size for analysis at 8 microns a pixel."""
    p = read(spark, d, "part").select(F.col("p_partkey").alias("slide"), (0.1 + F.col("p_size") % 7 * 0.05).alias("mpp"), (F.col("p_size") * 4096).alias("w0"), (F.col("p_size") * 3072).alias("h0"))
    p = p.withColumn("downsamples", F.array(*[F.lit(4.0**k) for k in range(4)]))
    p = p.withColumn("levels", F.transform("downsamples", lambda s: F.struct((F.col("w0") / s).cast("int").alias("w"), (F.col("h0") / s).cast("int").alias("h"))))
    return grid.level_plan(p, 8.0).select("slide", "level", "ratio", "plane_w", "plane_h")


@query("SELECT l_suppkey AS slide, l_partkey AS record, count(*) AS copies, min(l_orderkey) AS first_order FROM lineitem GROUP BY ALL")
def metadata_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Index of metadata rows: the first of each key, and how often it came."""
    rows = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("slide"), F.col("l_partkey").alias("record"), "l_orderkey", "l_linenumber", "l_quantity")
    found = metadata.first_records(rows, ["slide", "record"], ["l_orderkey", "l_linenumber", "l_quantity"])
    return found.select("slide", "record", "copies", F.col("l_orderkey").alias("first_order"))


@query("""
 SELECT c_custkey AS slide, coalesce(cli, meta) AS stain, CASE WHEN cli IS NOT NULL THEN 'cli' WHEN meta IS NOT NULL THEN 'metadata' ELSE 'none' END AS stain_origin, r_name AS bank FROM
  (SELECT c_custkey, c_nationkey, nullif(trim(CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN '  ' END), '') AS cli, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS meta FROM customer)
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def source_merge(spark: SparkSession, d: str) -> DataFrame:
    """Explicit values over metadata, with where each came from, and the bank of each slide."""
    c, seg, k = read(spark, d, "customer"), F.col("c_mktsegment"), F.col("c_custkey")
    rows = c.select(k.alias("slide"), "c_nationkey", F.when(k % 3 == 0, seg).when(k % 3 == 1, "  ").alias("cli_stain"), F.when(k % 4 != 0, seg).alias("meta_stain"))
    bank = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("bank"))
    return metadata.lookup(metadata.merged_source(rows, ["stain"]), bank, "c_nationkey").select("slide", "stain", "stain_origin", "bank")


_BANK = "(VALUES ('LFB-HE', 1), ('lfb-he/ASIA', 2), ('he', 3), ('AT8/EUROPE', 4)) b(name, entry)"


@query(f"""
 WITH a AS (SELECT c_custkey AS slide, lower(CASE c_custkey % 5 WHEN 0 THEN ' lfb/h&e ' WHEN 1 THEN 'HE' WHEN 2 THEN 'AT8' WHEN 3 THEN NULL ELSE 'neun' END) AS s, lower(r_name) AS bank
   FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
 , t AS (SELECT slide, trim(s) AS s, CASE trim(s) WHEN 'lfb/h&e' THEN 'lfb-he' END AS al, bank FROM a)
 , k AS (SELECT slide, 0 AS r, s || '/' || bank AS name FROM t UNION ALL SELECT slide, 1, al || '/' || bank FROM t UNION ALL SELECT slide, 2, s FROM t UNION ALL SELECT slide, 3, al FROM t)
 , m AS (SELECT k.slide, k.r, b.entry, row_number() OVER (PARTITION BY k.slide ORDER BY k.r) AS n FROM k JOIN {_BANK} ON lower(b.name) = k.name)
 SELECT t.slide, m.entry FROM t LEFT JOIN m ON m.slide = t.slide AND m.n = 1""")
def priority_reference(spark: SparkSession, d: str) -> DataFrame:
    """The reference of each slide's stain and bank, by falling priority."""
    c, k = read(spark, d, "customer"), F.col("c_custkey")
    stain = F.when(k % 5 == 0, " lfb/h&e ").when(k % 5 == 1, "HE").when(k % 5 == 2, "AT8").when(k % 5 == 3, None).otherwise("neun")
    bank = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("bank"))
    asked = c.select(k.alias("slide"), stain.alias("stain"), "c_nationkey").join(bank, "c_nationkey").drop("c_nationkey")
    entries = spark.createDataFrame([("LFB-HE", 1), ("lfb-he/ASIA", 2), ("he", 3), ("AT8/EUROPE", 4)], "name string, entry int")
    return metadata.by_priority(asked, entries, "slide", {"lfb/h&e": "lfb-he"}).select("slide", "entry")


_THRESHOLDS = [("focus", None, 10000.0, None), ("focus", "HE", 20000.0, 60000.0), ("focus", "LFB", None, None), ("fold", None, None, 0.4), ("fold", "lfb-he", 0.5, 0.1), ("quantity", None, 3.0, 48.0)]
_THRESHOLD_SQL = "(VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else f"{x}::DOUBLE" if isinstance(x, float) else repr(x) for x in t) + ")" for t in _THRESHOLDS) + ") t(metric, stain, lo, hi)"
_METRICS_SQL = f"""
 WITH s AS (SELECT slide, CASE slide % 5 WHEN 0 THEN 'HE' WHEN 1 THEN 'LFB' WHEN 2 THEN 'lfb/h&e' WHEN 3 THEN 'AT8' END AS stain, CASE slide % 5 WHEN 2 THEN 'lfb-he' END AS alias,
     max(focus) AS focus, CASE WHEN slide % 7 <> 3 THEN min(coarse) END AS fold, CASE WHEN slide % 4 = 1 THEN 'NaN'::DOUBLE ELSE max(quantity) END AS quantity FROM tiles GROUP BY slide)
 , m AS (SELECT slide, stain, alias, 'focus' AS metric, focus AS value FROM s UNION ALL SELECT slide, stain, alias, 'fold', fold FROM s UNION ALL SELECT slide, stain, alias, 'quantity', quantity FROM s)
 , c AS (SELECT m.*, t.lo, t.hi, t.stain AS hit, t.metric IS NOT NULL AS found,
     row_number() OVER (PARTITION BY m.slide, m.metric ORDER BY CASE WHEN t.metric IS NULL THEN 9 WHEN t.stain = m.stain THEN 0 WHEN t.stain = m.alias THEN 1 ELSE 2 END) AS r
   FROM m LEFT JOIN {_THRESHOLD_SQL} ON t.metric = m.metric AND (t.stain IS NULL OR t.stain = m.stain OR t.stain = m.alias))
 , b AS (SELECT *, CASE WHEN NOT found THEN 'none' WHEN hit = stain THEN 'stain' WHEN hit = alias THEN 'alias' ELSE 'global' END AS band FROM c WHERE r = 1)
 , e AS (SELECT *, lo IS NOT NULL OR hi IS NOT NULL AS bounded, coalesce(lo > hi, false) AS wrong FROM b)
 , v AS (SELECT *, CASE WHEN NOT bounded THEN NULL WHEN wrong THEN 'invalid bounds' WHEN value IS NULL THEN 'missing' WHEN isnan(value) THEN 'not finite'
     WHEN value < lo THEN 'below minimum' WHEN value > hi THEN 'above maximum' END AS reason, bounded AND NOT wrong AND value IS NOT NULL AS counted FROM e)"""


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("slide") % 5
    s = tiles(spark, d).groupBy("slide").agg(F.max("focus").alias("focus"), F.min("coarse").alias("fold"), F.max("quantity").alias("quantity"))
    values = F.array(
        F.struct(F.lit("focus").alias("metric"), F.col("focus").alias("value")),
        F.struct(F.lit("fold").alias("metric"), F.when(F.col("slide") % 7 != 3, F.col("fold")).alias("value")),
        F.struct(F.lit("quantity").alias("metric"), F.when(F.col("slide") % 4 == 1, F.lit(float("nan"))).otherwise(F.col("quantity")).alias("value")),
    )
    s = s.select("slide", F.when(k == 0, "HE").when(k == 1, "LFB").when(k == 2, "lfb/h&e").when(k == 3, "AT8").alias("stain"), F.when(k == 2, "lfb-he").alias("alias"), F.explode(values).alias("v"))
    table = spark.createDataFrame(_THRESHOLDS, "metric string, stain string, min double, max double")
    return verdict.resolve_bounds(s.select("slide", "stain", "alias", "v.metric", "v.value"), table, ["slide"])


@query(sql("tiles", body=_METRICS_SQL.replace("WITH s AS", ", s AS") + " SELECT slide, metric, band, lo AS min, hi AS max FROM b"))
def bound_resolution(spark: SparkSession, d: str) -> DataFrame:
    """The bounds that hold for each metric of each slide, and whose they are."""
    return _metrics(spark, d).select("slide", "metric", "band", "min", "max")


@query(sql("tiles", body=_METRICS_SQL.replace("WITH s AS", ", s AS") + """
 SELECT slide, count(*) FILTER (counted) AS n_evaluated, count(*) FILTER (reason IS NOT NULL) AS n_flags,
   CASE WHEN count(*) FILTER (counted) > 0 THEN count(*) FILTER (reason IS NOT NULL) = 0 END AS passed, string_agg(coalesce(reason, '-'), ',' ORDER BY metric) AS reasons FROM v GROUP BY slide"""))
def threshold_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Verdict of each slide."""
    rows = verdict.evaluated(_metrics(spark, d))
    got = verdict.verdict(rows, ["slide"])
    reasons = rows.groupBy("slide").agg(F.transform(F.array_sort(F.collect_list(F.struct("metric", F.coalesce("reason", F.lit("-")).alias("r")))), lambda x: x["r"]).alias("rs"))
    return got.join(reasons, "slide").select("slide", "n_evaluated", "n_flags", "passed", F.concat_ws(",", "rs").alias("reasons"))


@query("""
 SELECT l_linestatus AS stage, l_returnflag AS component, CAST(grouping(l_linestatus) * 2 + grouping(l_returnflag) AS INT) AS level, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS seconds
 FROM lineitem GROUP BY ROLLUP (l_linestatus, l_returnflag)""")
def timing_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Seconds by component, stage and in all."""
    rows = read(spark, d, "lineitem").select(F.col("l_linestatus").alias("stage"), F.col("l_returnflag").alias("component"), F.col("l_quantity").cast("long").alias("seconds"))
    return verdict.timing(rows)


@query(sql("runs", body=" SELECT slide, started, suffix, folder, state FROM (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY started DESC, suffix DESC, folder DESC) AS r FROM runs) WHERE r = 1"))
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    return batch.latest_runs(runs(spark, d)).select("slide", "started", "suffix", "folder", "state")


@query(sql("runs", body="""
 , l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slide ORDER BY started DESC, suffix DESC, folder DESC) AS r FROM runs) WHERE r = 1)
 SELECT c_custkey AS slide, CASE WHEN l.state = 'completed' AND l.fingerprint = c_custkey % 3 THEN 'skip completed' WHEN l.state = 'failed' AND l.fingerprint = c_custkey % 3 THEN 'skip failed' ELSE 'run' END AS action
 FROM customer LEFT JOIN l ON l.slide = c_custkey"""))
def resume_decision(spark: SparkSession, d: str) -> DataFrame:
    """What a batch that starts again does with each slide."""
    jobs = read(spark, d, "customer").select(F.col("c_custkey").alias("slide"), (F.col("c_custkey") % 3).cast("int").alias("fingerprint"))
    return batch.resume(jobs, batch.latest_runs(runs(spark, d))).select("slide", "action")


@query(sql("runs", body="""
 SELECT 'state' AS dimension, state AS value, count(*) AS n FROM runs GROUP BY state UNION ALL SELECT 'priority', priority, count(*) FROM runs GROUP BY priority
 UNION ALL SELECT 'retry', coalesce(CASE WHEN suffix > 0 THEN CAST(suffix AS VARCHAR) END, 'None'), count(*) FROM runs GROUP BY ALL"""))
def summary_counts(spark: SparkSession, d: str) -> DataFrame:
    """Runs by state, priority and retry, in one pass."""
    r = runs(spark, d).withColumn("retry", F.when(F.col("suffix") > 0, F.col("suffix")))
    return batch.summary_counts(r, ["state", "priority", "retry"])


_MESSAGE = "CASE o_orderkey % 4 WHEN 0 THEN 'ReadError: tile ' || o_custkey WHEN 1 THEN 'ValueError: bad; OSError: gone' WHEN 2 THEN 'stopped' END"


@query(f"""
 SELECT coalesce(nullif(regexp_extract(m, '^([A-Z][A-Za-z0-9_]*(?:Error|Exception|Interrupt|Exit|Warning)):', 1), ''), 'other') AS error_type, count(*) AS n
 FROM (SELECT trim(unnest(string_split({_MESSAGE}, ';'))) AS m FROM orders) WHERE m <> '' GROUP BY ALL""")
def error_type_counts(spark: SparkSession, d: str) -> DataFrame:
    o, k = read(spark, d, "orders"), F.col("o_orderkey") % 4
    m = F.when(k == 0, F.concat(F.lit("ReadError: tile "), F.col("o_custkey").cast("string"))).when(k == 1, "ValueError: bad; OSError: gone").when(k == 2, "stopped")
    return batch.error_types(o.select(m.alias("message")))


@query(r"""
 WITH u AS (SELECT url AS slide, page_id AS ord, CASE page_id % 3 WHEN 0 THEN 'HE' WHEN 1 THEN ' ' END AS stain, CASE WHEN page_id % 7 = 0 THEN 'b' || page_id % 2 END AS bank FROM pages)
 SELECT slide, min(nullif(trim(stain), '')) AS stain, arg_min(bank, ord) FILTER (bank IS NOT NULL) AS bank,
   CASE WHEN count(DISTINCT bank) > 1 THEN 'conflicting bank: ' || min(bank) || ', ' || max(bank) END AS problem FROM u GROUP BY slide""")
def manifest_merge(spark: SparkSession, d: str) -> DataFrame:
    """One job for each listed slide, and rows that contradict each other."""
    k = F.col("page_id")
    rows = read(spark, d, "pages").select(F.col("url").alias("slide"), k.alias("ord"), F.when(k % 3 == 0, "HE").when(k % 3 == 1, " ").alias("stain"), F.when(k % 7 == 0, F.concat(F.lit("b"), (k % 2).cast("string"))).alias("bank"))
    return batch.manifest_merge(rows, ["stain", "bank"]).select("slide", "stain", "bank", "problem")


_URI_ID = r"""
 WITH u AS (SELECT DISTINCT url AS slide FROM pages), n AS (SELECT slide, regexp_extract(slide, '([^/]*)/*$', 1) AS name FROM u)
 , i AS (SELECT slide, coalesce(nullif(CASE WHEN regexp_extract(name, '^(.+?)(\.[^.]*)?$', 1) = '' THEN name ELSE regexp_extract(name, '^(.+?)(\.[^.]*)?$', 1) END, ''), 'slide') AS slide_id FROM n)"""


@query(_URI_ID + " SELECT slide, slide_id, substr(sha1(slide), 1, 8) AS hash, contains(slide, '://') AS remote FROM i")
def slide_id_of_uri(spark: SparkSession, d: str) -> DataFrame:
    u, s = read(spark, d, "pages").select(F.col("url").alias("slide")).distinct(), F.col("slide")
    return u.select("slide", text.slide_id(s).alias("slide_id"), text.short_hash(s).alias("hash"), text.is_remote(s).alias("remote"))


@query(_URI_ID + " SELECT slide, slide_id, CASE WHEN count(*) OVER (PARTITION BY slide_id) > 1 THEN slide_id || '~' || substr(sha1(slide), 1, 8) ELSE slide_id END AS job_key FROM i")
def job_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of jobs: the slide's id, with a hash where that is not unique."""
    return batch.job_keys(read(spark, d, "pages").select(F.col("url").alias("slide")).distinct()).select("slide", "slide_id", "job_key")


@query("SELECT event_id, json_extract_string(props, '$.k') AS metric, event_type AS state, value FROM events WHERE value IS NOT NULL AND NOT isnan(value)")
def json_metric_dig(spark: SparkSession, d: str) -> DataFrame:
    """A dotted path dug out of each status event's document, beside its finite value."""
    from tilewright.functions.guards import is_finite

    e = read(spark, d, "events").filter(is_finite(F.col("value")))
    return e.select("event_id", text.dig(F.col("props"), "k").alias("metric"), F.col("event_type").alias("state"), "value")


@query("""
 SELECT l_suppkey AS slide, count(*) AS n, sha256(string_agg(d, chr(10) ORDER BY d)) AS digest FROM
  (SELECT l_suppkey, sha256(concat_ws(chr(31), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_returnflag)) AS d FROM lineitem) GROUP BY ALL""")
def manifest_digest(spark: SparkSession, d: str) -> DataFrame:
    """A digest of each slide's list of tiles that does not depend on their order."""
    rows = read(spark, d, "lineitem").withColumn("slide", F.col("l_suppkey"))
    return batch.ordered_digest(rows, ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"], ["slide"])
