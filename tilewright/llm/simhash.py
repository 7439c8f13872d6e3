"""Near-duplicates by SimHash fingerprints, linked through deletion-variant signatures.

Two 64-bit fingerprints that differ in at most 3 bits have a half in which they differ in at most one
bit.  For each of a fingerprint's 64 bits the half that holds it is indexed with that bit as a
wildcard: two halves that differ in at most one bit share a variant.  Equal variants are brought
together by one shuffle, sorted, and every two fingerprints of a group are verified.

A group of many different fingerprints (a wide family of near copies) is not compared pair by pair:
it is indexed once more by the other half, cut into halves of its own by the same argument, and then
again.  After three levels the members of a group agree in all but 11 bits, which bounds its size.
Verified links leave a task as a star for each component found in it, so at most one link for each
member and group is written, however many pairs are near."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm._common import arrow_map, bytes_of, staged, table, task_memory
from tilewright.llm.components import components

#: Largest group that is compared pair by pair before the last level, and rows handled at once.
GROUP_LIMIT, ROWS_AT_ONCE = 512, 200_000


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Bit set if it is set in over half of the XXH64 values of the shingles; no words: zero."""
    words = text.lower().split()  # of bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(w), seed) for w in zip(*(words[k:] for k in range(shingle)))]
    each = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(each), 65536):
        ones += np.unpackbits(each[at : at + 65536], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(each)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, fp long): the fingerprint's bits as a signed integer, one row per row of docs.  Null,
    empty and blank texts: 0.  Other columns are not read."""

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, shingle) for t in bytes_of(b.column(1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(made)], ["doc_id", "fp"])

    return arrow_map(docs.select(docs[id].cast("long").alias("doc_id"), docs[text].alias("text")), kernel, "doc_id long, fp long")


def variants(rows: DataFrame, width: int) -> DataFrame:
    """(key, fp, at) from (key, fp, at): the `width` bits of fp from bit `at` are still free.  Each of
    them becomes a wildcard in its half; the other half is free in what comes out."""
    half, bit = width // 2, F.col("bit")
    low = bit < half
    segment = F.expr(f"shiftrightunsigned(fp, at + IF(bit < {half}, 0, {half})) & {(1 << half) - 1}L")
    cleared = segment.bitwiseAND(F.expr(f"~shiftleft(1L, bit % {half})"))
    key = F.expr("shiftleft(cast(bit AS long), 32)").bitwiseOR(cleared) if width == 64 else F.xxhash64("key", "bit", cleared)
    return rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("bit")).select(key.alias("key"), "fp", (F.col("at") + F.when(low, half).otherwise(0)).alias("at"))


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node it is connected with) that connect what the links a - b connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        m = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], m)
        np.minimum.at(new, label[y], m)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def near_pairs(key: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of equal key within `bits` bits; rows are sorted by key."""
    a, b = [], []
    at = np.flatnonzero(key[1:] == key[:-1])
    for d in range(1, len(key)):
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= bits]
        a.append(fp[near])
        b.append(fp[near + d])
        at = at[at + d + 1 < len(key)]
        at = at[key[at + d + 1] == key[at]]
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _grouped(last: bool, bits: int, limit: int):
    """Of rows sorted by key: links inside groups of up to `limit` rows (all groups, if last), and the
    rows of larger groups.  Rows come and go in blocks; at most a block and a small group are held."""

    def block(key, fp, at, hot_key):
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        large = np.repeat((sizes > limit) & (not last), sizes)
        if hot_key is not None:
            large |= key == hot_key
        small = ~large
        a, b = near_pairs(key[small], fp[small], bits)
        if len(a):
            a, b = stars(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32())], ["a", "b", "key", "at"])
        if large.any():
            n = int(large.sum())
            yield pa.RecordBatch.from_arrays([pa.array(fp[large].view(np.int64)), pa.nulls(n, pa.int64()), pa.array(key[large]), pa.array(at[large])], ["a", "b", "key", "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory():
            yield from blocks(batches)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n, hot_key = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            n += batch.num_rows
            if n < ROWS_AT_ONCE:
                continue
            key, fp, at = (np.concatenate(c) for c in zip(*held))
            cut = int(np.searchsorted(key, key[-1]))  # the last group may go on
            if not last and len(key) - cut > limit:  # it is large already
                yield from block(key, fp.view(np.uint64), at, hot_key)
                hot_key, held, n = key[-1], [], 0
                continue
            if cut:
                yield from block(key[:cut], fp[:cut].view(np.uint64), at[:cut], hot_key)
            held, n = [(key[cut:], fp[cut:], at[cut:])], len(key) - cut
        if n:
            key, fp, at = (np.concatenate(c) for c in zip(*held))
            yield from block(key, fp.view(np.uint64), at, hot_key)

    return run


def links(distinct: DataFrame, bits: int = 3, limit: int = GROUP_LIMIT) -> DataFrame:
    """(a, b): links among different fingerprints (column fp, each once) that connect exactly those
    which a chain of pairs within `bits` <= 3 differing bits connects."""
    if not 0 <= bits <= 3:
        raise ValueError("halves with one wildcard find up to 3 differing bits")
    rows, found = distinct.select(F.lit(0).cast("long").alias("key"), "fp", F.lit(0).alias("at")), []
    for width in (64, 32, 16):
        dealt = variants(rows, width).repartition("key").sortWithinPartitions("key")
        made = staged(dealt.mapInArrow(_grouped(width == 16, bits, limit), "a long, b long, key long, at int"), f"links{width}")
        found.append(made.filter("b IS NOT NULL").select("a", "b"))
        rows = made.filter("key IS NOT NULL").select("key", F.col("a").alias("fp"), "at")
        if width > 16 and not rows.limit(1).count():
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, text: str = "text", id: str = "doc_id", limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs; component_id is the smallest id that
    can be reached over links of at most `bits` differing bits, the row's own included.

    Rows with a null or empty text have the fingerprint zero and are linked like any others; rows with
    a null id get a fingerprint and the component of the others; repeated rows stay; an empty table
    gives an empty result; columns other than the two named are not read."""
    rows = staged(fingerprints(docs, shingle, text, id), "fingerprints")
    firsts = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = components(links(firsts.select("fp"), bits, limit))
    rooted = firsts.join(found, firsts.fp == found.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select(F.col("fp").alias("of"), "component_id")
    return rows.join(classes, rows.fp == classes.of).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
