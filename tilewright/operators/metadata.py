"""Metadata records: indexes, lookups, merges with explicit values, and dataset adapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions.text import clean, stain_name


def first_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """rows with rank and duplicates: the record of a key is its first row; the number of its rows tells
    what an index should report."""
    return rows.withColumns({"rank": F.row_number().over(Window.partitionBy(*key).orderBy(*order)), "copies": F.count(F.lit(1)).over(Window.partitionBy(*key))})


def _one_of_each(rows: DataFrame, key: list[str], order: list[str], pick) -> DataFrame:
    """One row a key and its copies, by an aggregate that is combined before the shuffle; null key parts are
    equal to each other, and nulls come first in the order."""
    whole, by = F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(*order)
    found = rows.groupBy(*key).agg(pick(whole, by).alias("__one"), F.count(F.lit(1)).alias("copies"))
    return found.select("__one.*", "copies")


def first_records(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by order, with `copies`, the number of its rows."""
    return _one_of_each(rows, key, order, F.min_by)


def index(rows: DataFrame, key: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The records (one a key), and (key, copies) of the keys that came more than once."""
    found = first_records(rows, key, order)
    return found.drop("copies"), found.filter("copies > 1").select(*key, "copies")


def last_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row a key, the last by order; null key parts are equal to each other."""
    return _one_of_each(rows, key, order, F.max_by).drop("copies")


def lookup(slides: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """slides with their record's columns (null where there is none) and metadata_found."""
    marked = records.withColumn("metadata_found", F.lit(True))
    return slides.join(marked, key, "left").withColumn("metadata_found", F.coalesce("metadata_found", F.lit(False)))


def merged_source(rows: DataFrame, fields: list[str], explicit: str = "cli_", found: str = "meta_") -> DataFrame:
    """rows with each field (the explicit value, else the metadata's) and its origin."""
    out = {}
    for f in fields:
        a, b = clean(F.col(explicit + f)), clean(F.col(found + f))
        out[f] = F.coalesce(a, b)
        out[f + "_origin"] = F.when(a.isNotNull(), "cli").when(b.isNotNull(), "metadata").otherwise("none")
    return rows.withColumns(out)


def standard(rows: DataFrame, columns: dict[str, str | None]) -> DataFrame:
    """The standard columns by name, from those named (null where there is none), the rest as a map."""
    used = {v for v in columns.values() if v}
    extra = [c for c in rows.columns if c not in used]
    pairs = [x for c in extra for x in (F.lit(c), clean(F.col(c)))]
    kept = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,string>")
    return rows.select(*[(clean(F.col(v)) if v else F.lit(None).cast("string")).alias(k) for k, v in columns.items()], kept.alias("extra"))


#: Dataset adapters: functions from rows of a dataset's table to (slide_path, slide_id, stain, block).
ADAPTERS: dict = {}


def adapter(name: str):
    def register(f):
        ADAPTERS[name] = f
        return f

    return register


@adapter("plain")
def _plain(rows: DataFrame, **_) -> DataFrame:
    return standard(rows, {"slide_path": "slide_path", "stain": "stain" if "stain" in rows.columns else None})


@adapter("windows_share")
def _windows_share(rows: DataFrame, prefix: str = "gs://", path: str = "file_path", **_) -> DataFrame:
    """Paths below a drive letter become cloud paths under a prefix."""
    tail = F.replace(F.regexp_replace(F.col(path), r"^[A-Za-z]:", ""), F.lit("\\"), F.lit("/"))
    return rows.withColumn("slide_path", F.concat(F.lit(prefix.rstrip("/") + "/"), F.regexp_replace(tail, "^/+", "")))


def adapt(name: str, rows: DataFrame, **options) -> DataFrame:
    if name not in ADAPTERS:
        raise ValueError(f"no adapter for {name!r}; there are {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[name](rows, **options)


def by_priority(asked: DataFrame, bank: DataFrame, key: str, aliases: dict[str, str]) -> DataFrame:
    """asked (key, stain, bank) with the entry of `bank` (entry key `name`, any columns) that fits best:
    stain/bank, alias/bank, stain, alias, names compared in lower case.  One row for each asked row."""
    stain, other = stain_name(F.col("stain")), _alias(stain_name(F.col("stain")), aliases)
    where = stain_name(F.col("bank"))
    names = [F.concat_ws("/", stain, where), F.concat_ws("/", other, where), stain, other]
    ranked = F.array(*[F.struct(F.lit(k).alias("rank"), n.alias("name")) for k, n in enumerate(names)])
    # Without a bank the first two are the last two.
    wanted = asked.withColumn("__c", F.explode(F.array_compact(F.transform(ranked, lambda c: F.when(c["name"].isNotNull(), c)))))
    wanted = wanted.withColumns({"__rank": F.col("__c.rank"), "__name": F.col("__c.name")}).drop("__c")
    entries = bank.withColumn("__name", F.lower(F.trim("name")))
    found = wanted.join(entries, "__name", "left")
    best = Window.partitionBy(key).orderBy(F.col("name").isNull(), "__rank")
    return found.withColumn("__r", F.row_number().over(best)).filter("__r = 1").drop("__r", "__name").withColumnRenamed("__rank", "match_rank")


def _alias(name: Column, aliases: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in aliases.items():
        out = F.when(name == k, F.lit(v)).otherwise(out)
    return out
