"""Stand-ins for slides, planes, tiles and runs, made from the driver's tables.

`view` gives each as a DataFrame; SQL has the same in SQL that other engines can run, so that a query's
oracle can be put before it as a common table expression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stains that the label of a vector stands for, in order.
STAINS = ("HE", "LFB", "Hirano", "AT8", "NeuN")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gray_planes(spark: SparkSession, d: str) -> DataFrame:
    """(plane, label, y, x, g): a vector's 64 components as 8x8 gray pixels."""
    e = read(spark, d, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("pos", "e"))
    g = F.least(F.lit(255), F.greatest(F.lit(0), F.floor((F.col("e").cast("double") + 0.5) * 255).cast("int")))
    return e.select(F.col("vec_id").alias("plane"), "label", F.floor(F.col("pos") / 8).cast("int").alias("y"), (F.col("pos") % 8).alias("x"), g.alias("g"))


def rgb_planes(spark: SparkSession, d: str) -> DataFrame:
    """(plane, y, x, r, g, b) from three vectors in a row."""
    p = gray_planes(spark, d).select(F.floor(F.col("plane") / 3).alias("plane"), "y", "x", (F.col("plane") % 3).alias("c"), F.col("g").alias("v"))
    channel = lambda k: F.max(F.when(F.col("c") == k, F.col("v")))
    return p.groupBy("plane", "y", "x").agg(F.count(F.lit(1)).alias("n"), channel(0).alias("r"), channel(1).alias("g"), channel(2).alias("b")).filter("n = 3").drop("n")


def tiles(spark: SparkSession, d: str) -> DataFrame:
    """Tile records: slide, col, row, ord, coarse and refined fraction, focus, errors."""
    return read(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("slide"), F.col("l_partkey").alias("col"), F.col("l_linenumber").alias("row"), F.col("l_orderkey").alias("ord"),
        (F.col("l_discount") * 10).alias("coarse"), (F.col("l_tax") * 12.5).alias("refined"), F.col("l_extendedprice").alias("focus"),
        (F.col("l_returnflag") == "R").alias("read_error"), ((F.col("l_linestatus") == "O") & (F.col("l_tax") >= 0.08)).alias("reseg_error"),
        F.col("l_quantity").alias("quantity"),
    )


def planes(spark: SparkSession, d: str) -> DataFrame:
    """(slide, w, h): planes of a few tiles each way."""
    return read(spark, d, "part").select(F.col("p_partkey").alias("slide"), (F.col("p_size") * 61 + 7).alias("w"), (F.col("p_size") * 37 + 5).alias("h"))


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Ledger: slide, started, suffix, folder, state, seconds, fingerprint, message."""
    o = read(spark, d, "orders")
    state = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "failed").otherwise("running")
    return o.select(
        F.col("o_custkey").alias("slide"), F.col("o_orderdate").alias("started"), (F.col("o_orderkey") % 11).cast("int").alias("suffix"), F.col("o_orderkey").alias("folder"),
        state.alias("state"), F.col("o_totalprice").alias("seconds"), (F.col("o_orderkey") % 3).cast("int").alias("fingerprint"), F.col("o_orderpriority").alias("priority"),
    )


SQL = {
    "gray_planes": """gray_planes AS (
      SELECT vec_id AS plane, label, CAST((i - 1) // 8 AS INT) AS y, CAST((i - 1) % 8 AS INT) AS x,
             least(255, greatest(0, CAST(floor((CAST(embedding[i] AS DOUBLE) + 0.5) * 255) AS INT))) AS g
      FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))""",
    "rgb_planes": """rgb_planes AS (
      SELECT plane // 3 AS plane, y, x, max(g) FILTER (plane % 3 = 0) AS r, max(g) FILTER (plane % 3 = 1) AS g, max(g) FILTER (plane % 3 = 2) AS b
      FROM gray_planes GROUP BY 1, 2, 3 HAVING count(*) = 3)""",
    "tiles": """tiles AS (
      SELECT l_suppkey AS slide, l_partkey AS col, l_linenumber AS row, l_orderkey AS ord, l_discount * 10 AS coarse, l_tax * 12.5 AS refined,
             l_extendedprice AS focus, l_returnflag = 'R' AS read_error, (l_linestatus = 'O' AND l_tax >= 0.08) AS reseg_error, l_quantity AS quantity FROM lineitem)""",
    "planes": "planes AS (SELECT p_partkey AS slide, p_size * 61 + 7 AS w, p_size * 37 + 5 AS h FROM part)",
    "runs": """runs AS (
      SELECT o_custkey AS slide, o_orderdate AS started, CAST(o_orderkey % 11 AS INT) AS suffix, o_orderkey AS folder,
             CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'running' END AS state,
             o_totalprice AS seconds, CAST(o_orderkey % 3 AS INT) AS fingerprint, o_orderpriority AS priority FROM orders)""",
}


def sql(*names: str, body: str) -> str:
    """A query with these stand-ins before it."""
    need = list(dict.fromkeys(x for n in names for x in (("gray_planes", n) if n == "rgb_planes" else (n,))))
    return "WITH " + ", ".join(SQL[n] for n in need) + " " + body
