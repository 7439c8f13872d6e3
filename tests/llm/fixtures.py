"""Small tables with every awkward row: nulls, empty and long texts, repeats, clashing columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 8))) for _ in range(n))


def documents(spark, seed=0, n=60):
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randint(0, 120)), "en", f"src{i % 3}", 0) for i in range(n)]
    passage = words(rng, 150)
    rows += [(n, None, None, None, None), (n + 1, "", "en", "src0", 0), (n + 2, " \t\n", "", "", 3), (None, "no id here at all", "en", "src1", 1), (None, None, None, "src1", 1)]
    rows += [(n + 3, rows[5][1], "en", "src2", 0), (n + 3, rows[5][1], "en", "src2", 0)]  # a copy, twice
    rows += [(n + 4, "start " + passage + " one", "de", "src0", 0), (n + 5, passage.upper() + passage, "de", "src1", 0), (n + 6, "z " + passage, "de", None, 0)]
    rows += [(n + 7, "日本語 naïve\u3000café 😀 <|endoftext|> it're  x\n\n y", "ja", "src0", 0), (n + 8, "ab " * 4000, "en", "src1", 0), (n + 9, "x" * 9000, "en", "src2", 0)]
    return rows


def table(spark, rows=None, **options):
    """The rows as a DataFrame with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(documents(spark, **options) if rows is None else rows, SCHEMA)
    for c in ("id", "size", "n", "key", "spans", "fp", "copies", "shard", "h", "d", "t", "label", "first", "count"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


def empty(spark):
    return table(spark, [])
