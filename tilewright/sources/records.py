"""Manifests, metadata tables and run ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Extensions of slides, columns that name a slide, columns that key metadata.
SLIDE_EXTENSIONS = (".svs", ".tif", ".tiff", ".ndpi", ".scn", ".mrxs", ".vms", ".bif")
SLIDE_COLUMNS = ("slide", "slide_path", "path")
KEY_COLUMNS = ("slide_paths", "gs_file_path", "slide_path", "file_path", "path")


def folder(spark: SparkSession, path: str, extensions: tuple[str, ...] = SLIDE_EXTENSIONS, recursive: bool = True) -> DataFrame:
    """(slide, ord) of the slides below a folder, by name; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path")
    ends = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*extensions)
    return found.filter(ends).select(F.col("path").alias("slide"), F.col("path").alias("ord"))


def list_file(spark: SparkSession, path: str) -> DataFrame:
    """(slide, ord): one path a line; blank lines and those that begin with # do not count."""
    lines = spark.read.text(path).select(F.trim("value").alias("slide"), F.monotonically_increasing_id().cast("string").alias("ord"))
    return lines.filter((F.col("slide") != "") & ~F.startswith("slide", F.lit("#")))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV or TSV manifest as text columns, with slide and ord; a table without a slide column is refused."""
    rows = spark.read.option("header", True).option("sep", "\t" if path.endswith(".tsv") else ",").csv(path)
    named = next((c for c in SLIDE_COLUMNS if c in rows.columns), None)
    if named is None:
        raise ValueError(f"the manifest has none of the columns {', '.join(SLIDE_COLUMNS)}")
    return rows.withColumnRenamed(named, "slide").withColumn("ord", F.monotonically_increasing_id().cast("string"))


def discover(*parts: DataFrame) -> DataFrame:
    """All listed slides together; columns that a part lacks are null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def metadata(spark: SparkSession, paths: list[str], key: str | None = None) -> DataFrame:
    """Metadata tables as text, in file order: key, file_ord, row_ord and the columns of each."""
    out = None
    for n, path in enumerate(paths):
        rows = spark.read.option("header", True).csv(path)
        named = key or next((c for c in KEY_COLUMNS if c in rows.columns), None)
        if named is None or named not in rows.columns:
            raise ValueError(f"{path} has no key column")
        one = rows.withColumns({"key": F.trim(named), "file_ord": F.lit(n), "row_ord": F.monotonically_increasing_id()})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


STATUS = "slide_path string, state string, started_at string, finished_at string, report string, stage string, type string, message string, batch_fingerprint string"


def statuses(spark: SparkSession, path: str) -> DataFrame:
    """Run folders' status documents: their fields, folder, suffix, and read_error for damaged ones."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    doc = raw.withColumn("s", F.from_json("value", STATUS)).withColumn("folder", F.regexp_extract("file", r"([^/]+)/[^/]+$", 1))
    state = F.col("s.state")
    problem = F.when(~F.startswith(F.trim("value"), F.lit("{")), "not an object").when(F.col("s").isNull() | state.isNull(), "no state").when(~state.isin("running", "completed", "failed"), "unknown state")
    suffix = F.coalesce(F.nullif(F.regexp_extract("folder", r"(?:Z|UTC)_(\d+)$", 1), F.lit("")).try_cast("int"), F.lit(0))
    return doc.select("file", "folder", suffix.alias("suffix"), "s.*", F.try_to_timestamp("s.started_at").alias("started"), problem.alias("read_error"))
