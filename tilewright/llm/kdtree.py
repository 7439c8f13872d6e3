"""Shards of near-equal bytes by k-d tree partitioning of document metadata.

Equal texts form one group, with the metadata of its smallest id and the bytes of all its rows.  A
node of the tree is split along its widest dimension (spread of a dimension inside the node, relative
to that in the whole table) at the weighted median of bytes; halves are split again until leaves have
the target bytes.  Medians are found by counting: bytes are summed in the bins of a key range, the bin
that holds the median is cut finer, and after a few rounds a single key is left.  Keys end in bits of
the group's hash, so groups that agree in a dimension are still ordered.  Only these sums (at most
nodes x bins) reach the driver.

The group at the median goes to one side whole if that moves the cut by at most a small share of a
leaf; a heavier one is cut between its rows, at the row where the bytes are even.

Everything is DataFrame expressions."""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilewright.llm._common import numbered, staged, table

#: Bits of a key: position in a dimension, then hash; bits found in each counting round.
PLACE_BITS, HASH_BITS, ROUND_BITS = 28, 32, 10

#: A cut may move by this share of a leaf's bytes to keep a group of equal texts whole.
WHOLE_SHARE = 0.05


@dataclass(frozen=True)
class Split:
    """Rows of `node` whose (key, row offset in the group) is below (key, rows) go to its left child."""

    node: int
    dimension: int
    key: int
    rows: int


def default_dimensions() -> list[tuple[str, Column]]:
    return [("source", F.col("source_rank")), ("lang", F.col("lang_rank")), ("size", F.log("size")), ("doc_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.0)))]


def with_rank(groups: DataFrame, column: str) -> DataFrame:
    """groups with `column`_rank: the number of the value among the different ones in order, null first."""
    values = staged(groups.select(F.col(column).alias("v")).distinct(), "values")
    ranked = values.select("v", F.row_number().over(Window.orderBy(F.col("v").asc_nulls_first())).cast("double").alias(f"{column}_rank"))
    return groups.join(ranked, groups[column].eqNullSafe(ranked.v), "left").drop("v")


def keyed(groups: DataFrame, columns: list[str]) -> DataFrame:
    """groups with a key k0, k1, .. for each dimension: place in its range, then the hash h."""
    edge = groups.agg(*[F.min(c) for c in columns], *[F.max(c) for c in columns]).first()
    for i, c in enumerate(columns):
        low, high = edge[i] or 0.0, edge[len(columns) + i] or 0.0
        place = F.least((F.col(c) - F.lit(low)) / max(high - low, 1e-300), F.lit(1.0)) * ((1 << PLACE_BITS) - 1)
        groups = groups.withColumn(f"k{i}", place.cast("long") * (1 << HASH_BITS) + F.col("h"))
    return groups.drop(*columns)


def split_tree(keyed: DataFrame, leaves: int, dimensions: int) -> list[Split]:
    """The splits for 2^k leaves; keyed: (size, n, k0, k1, ..) of each group."""
    depth = int(math.log2(leaves))
    if 1 << depth != leaves:
        raise ValueError("the number of leaves must be a power of two")
    whole = keyed.agg(F.sum(F.col("size") * F.col("n"))).first()[0]
    if not whole:
        return []
    leaf, names = whole / leaves, range(dimensions)
    splits: list[Split] = []
    parts = keyed.withColumn("from", F.lit(0).cast("long")).withColumn("to", F.col("n"))
    total = PLACE_BITS + HASH_BITS
    for level in range(depth):
        here = parts.withColumn("node", node_of(splits, level))
        # A group that was cut has a part in both nodes: its rows below and from the cut on.
        found = here.groupBy("node").agg(F.sum(F.col("size") * (F.col("to") - F.col("from"))).alias("bytes"), *[F.min(f"k{i}").alias(f"low{i}") for i in range(dimensions)], *[F.max(f"k{i}").alias(f"high{i}") for i in range(dimensions)]).collect()
        search = {}
        for r in found:
            widths = [(r[f"high{i}"] >> HASH_BITS) - (r[f"low{i}"] >> HASH_BITS) for i in range(dimensions)]
            best = max(range(dimensions), key=lambda i: (widths[i], -i))
            # Without spread in any dimension the hash alone orders the groups.
            search[r["node"]] = [best, 0, 0, r["bytes"]]  # dimension, key prefix, bytes below it, bytes
        done = 0
        while done < total:
            step = min(ROUND_BITS, total - done)
            rest = total - done - step
            key = case_of("node", {n: f"k{s[0]}" for n, s in search.items()}, "cast(null AS bigint)")
            prefix = case_of("node", {n: f"{s[1]}L" for n, s in search.items()}, "-1L")
            bins = here.select("node", F.expr(key).alias("key"), F.expr(prefix).alias("prefix"), (F.col("size") * (F.col("to") - F.col("from"))).alias("bytes"))
            bins = bins.filter(F.shiftright("key", total - done) == F.col("prefix")).groupBy("node", F.shiftright("key", rest).alias("bin")).agg(F.sum("bytes").alias("bytes"))
            for n, rows in functools.reduce(lambda d, r: d.setdefault(r["node"], []).append(r) or d, bins.collect(), {}).items():
                s = search[n]
                for r in sorted(rows, key=lambda r: r["bin"]):
                    s[1] = r["bin"]
                    if 2 * (s[2] + r["bytes"]) >= s[3]:
                        break
                    s[2] += r["bytes"]
            done += step
        # At the median key: one group as a rule (more, if hashes are equal).
        key = case_of("node", {n: f"k{s[0]}" for n, s in search.items()}, "cast(null AS bigint)")
        at = case_of("node", {n: f"{s[1]}L" for n, s in search.items()}, "-1L")
        middle = {r["node"]: r for r in here.filter(F.expr(key) == F.expr(at)).groupBy("node").agg(F.sum(F.col("size") * (F.col("to") - F.col("from"))).alias("bytes"), F.min("from").alias("from"), F.max("to").alias("to"), F.max("size").alias("size")).collect()}
        for n, (dim, k, below, bytes_) in sorted(search.items()):
            m = middle[n]
            short = bytes_ / 2 - below  # what the left side lacks without this group
            if short <= WHOLE_SHARE * leaf and short <= m["bytes"] - short:
                rows = 0
            elif m["bytes"] - short <= WHOLE_SHARE * leaf:
                rows = (1 << 62)
            elif min(short, m["bytes"] - short) <= WHOLE_SHARE * leaf:
                rows = 0 if short <= m["bytes"] - short else (1 << 62)
            else:
                rows = m["from"] + round(short / m["bytes"] * (m["to"] - m["from"]))
            splits.append(Split(n, dim, k, rows))
        cuts = [s for s in splits if s.node >= (1 << level) and 0 < s.rows < 1 << 62]
        if cuts:  # the straddling groups become two parts
            cut = F.expr("CASE " + " ".join(f"WHEN node = {s.node} AND k{s.dimension} = {s.key}L AND `from` < {s.rows}L AND `to` > {s.rows}L THEN {s.rows}L" for s in cuts) + " END")
            halves = F.when(cut.isNotNull(), F.array(F.struct(F.col("from").alias("f"), cut.alias("t")), F.struct(cut.alias("f"), F.col("to").alias("t")))).otherwise(F.array(F.struct(F.col("from").alias("f"), F.col("to").alias("t"))))
            parts = here.withColumn("part", F.explode(halves)).drop("node", "from", "to").withColumn("from", F.col("part.f")).withColumn("to", F.col("part.t")).drop("part")
        else:
            parts = here.drop("node")
    return splits


def case_of(column: str, values: dict[int, str], otherwise: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE {otherwise} END" if values else otherwise


def node_of(splits: list[Split], levels: int, row: str = "`from`") -> Column:
    """The node (1 is the root, children 2n and 2n + 1) of a row with keys k0.. and its offset."""
    node = F.lit(1)
    for level in range(levels):
        # transform() names the node so far, so that each level's expression holds it once.
        node = F.transform(F.array(node), _child([s for s in splits if s.node >> level == 1], row))[0]
    return node


def _child(own: list[Split], row: str):
    def of(node: Column) -> Column:
        left = F.lit(True)
        for s in own:
            k = F.col(f"k{s.dimension}")
            left = F.when(node == s.node, (k < F.lit(s.key)) | ((k == F.lit(s.key)) & (F.expr(row) < F.lit(s.rows)))).otherwise(left)
        return node * 2 + F.when(left, 0).otherwise(1)

    return of


def sharded(docs: DataFrame, shards: int = 16, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of docs.

    size: bytes of the text in UTF-8 (null: none) plus 1.  slot: gapless from 0 inside a shard.  Null and
    empty texts are one group; their crc32 is 0; rows with null source, lang or id take part (before
    all others in that dimension); repeated rows are rows of their own; an empty table gives an empty
    result.  Other columns are not read."""
    data = F.coalesce(F.encode(docs[text], "utf-8"), F.lit(b""))
    rows = docs.select(docs[id].cast("long").alias("doc_id"), docs["source"], docs["lang"], (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.xxhash64(data).alias("g"))
    rows = staged(rows, "rows")
    own = ["g", "size", "text_crc32"]  # what tells texts apart
    groups = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "source", "lang")).alias("m"))
    groups = with_rank(with_rank(groups.select(*own, "n", "m.doc_id", "m.source", "m.lang"), "source"), "lang")
    columns = [f"d_{n}" for n, _ in default_dimensions()]
    groups = groups.select(*own, "n", *[c.alias(f"d_{n}") for n, c in default_dimensions()], F.shiftrightunsigned(F.xxhash64("g", "size"), 64 - HASH_BITS).alias("h"))
    groups = staged(keyed(staged(groups, "groups"), columns), "keys")
    depth = int(math.log2(shards))
    splits = split_tree(groups.drop(*own[:1], *own[2:]), shards, len(columns))
    # Rows of groups that no cut went through need no number inside their group.
    cut = [s for s in splits if 0 < s.rows < 1 << 62]
    torn = F.lit(False)
    for s in cut:
        torn |= (F.col(f"k{s.dimension}") == F.lit(s.key)) & (F.col("n") > 1)
    groups = groups.withColumn("torn", torn)
    whole = rows.join(groups.filter("NOT torn"), own).withColumn("from", F.lit(0).cast("long"))
    if cut:  # at most one group for each cut, so they can be sent to all executors
        split = staged(rows.join(F.broadcast(groups.filter("torn")), own), "torn")
        whole = whole.unionByName(numbered(split, own, ["doc_id"], out="from", few=True))
    sharded_ = staged(whole.select("doc_id", "size", "text_crc32", (node_of(splits, depth) - F.lit(shards)).cast("int").alias("shard")), "sharded")
    return numbered(sharded_, ["shard"], ["doc_id", "text_crc32"], out="slot", few=True).select("doc_id", "size", "text_crc32", "shard", "slot")


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sharded(table(spark, sf_dir, "documents"), 16)
    return made.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
