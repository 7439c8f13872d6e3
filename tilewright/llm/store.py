"""A content-addressed store of token ids.

Each document's ids are cut into chunks where a rolling hash of the last few ids has given low bits, so that
equal runs of ids give equal chunks wherever they stand.  A chunk's address is the SHA-256 of its ids as
little-endian unsigned 32-bit integers; its file form is a zstd frame of 16-bit integers where the
vocabulary allows, else 32-bit.

    chunks/     digest, n, width, payload        each chunk once
    recipes/    doc_id, rows, start, n_tokens, digests, root   sorted by doc_id; digests in order
    manifest/   part, first, last, documents, root    one row for each recipe file's range, in order

A document's root is the Merkle root of its chunk digests, a part's that of its documents' roots; the
root of the whole store is that of its parts.  Readers verify each chunk by its address and each recipe by
its root."""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilewright.llm._common import arrow_map, configure, fresh_path, remove, scratch, staged, table, texts_of
from tilewright.llm.bpe import encoder
from tilewright.llm.library import LibraryEncoder
from tilewright.llm.vocab import public_path, vocabulary

#: Chunks: ids in the rolling window, bits that end one (mean length 2^bits), shortest and longest.
WINDOW, CUT_BITS, SHORTEST, LONGEST = 16, 10, 128, 8192

#: Bytes of text that are encoded together.
GATHER = 5 << 20

#: Fixed multipliers of the rolling hash.
MIX, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def cuts(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of a document's ids.  A place is an end if the hash of the WINDOW ids before it
    has its top bits zero, at least SHORTEST ids after the last end; after LONGEST ids there is one anyway."""
    n = len(ids)
    if n <= SHORTEST:
        return [n] if n else []
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX)
    # h[i] of 2^k ids from that of 2^(k-1): the window slides over all places at once.
    width, mult = 1, STEP
    while width < WINDOW:
        h = h[:-width] * np.uint64(mult) + h[width:]
        width, mult = 2 * width, mult * mult % (1 << 64)
    ends = np.flatnonzero(h >> np.uint64(64 - CUT_BITS) == 0) + WINDOW
    out, last = [], 0
    for e in ends.tolist():
        while e - last > LONGEST:
            last += LONGEST
            out.append(last)
        if e - last >= SHORTEST and e < n:
            out.append(e)
            last = e
    while n - last > LONGEST:
        last += LONGEST
        out.append(last)
    return [*out, n]


def merkle(digests: list[bytes]) -> bytes:
    """Root of a binary tree of SHA-256; an odd node goes up as it is; no leaves: the hash of nothing."""
    if not digests:
        return hashlib.sha256(b"").digest()
    while len(digests) > 1:
        digests = [hashlib.sha256(b"".join(digests[k : k + 2])).digest() if k + 1 < len(digests) else digests[k] for k in range(0, len(digests), 2)]
    return digests[0]


def _crc_tables() -> list[int]:
    """x^(8 * 2^k) modulo CRC-32's polynomial, for joining checksums."""
    powers = [1 << 30]  # x^1, reflected
    for _ in range(66):
        powers.append(_times(powers[-1], powers[-1]))
    return powers[3:]


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo CRC-32's (bit 31 is x^0)."""
    out, m = 0, 1 << 31
    while m:
        if a & m:
            out ^= b
        m >>= 1
        b = (b >> 1) ^ 0xEDB88320 if b & 1 else b >> 1
    return out


_POWERS = _crc_tables()


@functools.lru_cache(maxsize=1 << 16)
def _shift(n_bytes: int) -> int:
    """x^(8 n) modulo the polynomial."""
    shift, k = 1 << 31, 0
    while n_bytes:
        if n_bytes & 1:
            shift = _times(_POWERS[k], shift)
        n_bytes >>= 1
        k += 1
    return shift


def crc32_joined(first: int, second: int, second_bytes: int) -> int:
    """CRC-32 of two strings joined, from theirs and the second one's length."""
    return _times(_shift(second_bytes), first) ^ second if first else second


_DOCUMENT = "part int, pos long, doc_id long, last long, start long, n_tokens long, digests array<binary>, root binary, documents long"


def write(docs: DataFrame, path: str, vocab: str, end_id: int = 2, text: str = "text", id: str = "doc_id") -> None:
    """Writes the store of docs to the folder `path` (any that Spark can write).

    Documents stand in ascending order of their ids, null first; rows of equal ids in the order of a
    hash of their content, equal rows side by side.  Null and empty texts are the end id alone; an empty
    table gives an empty store.  Columns other than the two named are not read."""
    spark = docs.sparkSession
    narrow = max(vocabulary(vocab).size, end_id + 1) <= 1 << 16

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        end = np.array([end_id], np.uint32).tobytes()
        rows = []
        for d, packed in zip(b.column(0).to_pylist(), encoder(vocab, LibraryEncoder)(texts_of(b.column(1)))):
            data = packed + end
            ids, last = np.frombuffer(data, np.uint32), 0
            whole = xxhash.xxh3_64_intdigest(data) >> 1
            for k, e in enumerate(cuts(ids)):
                part = data[4 * last : 4 * e]
                rows.append((d, whole, k, hashlib.sha256(part).digest(), e - last, squeeze(ids[last:e].astype(np.uint16).tobytes() if narrow else part)))
                last = e
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "whole", "seq", "digest", "n", "payload"])

    rows = docs.select(docs[id].cast("long").alias("doc_id"), docs[text].alias("text"))
    cut = staged(arrow_map(rows, kernel, "doc_id long, whole long, seq int, digest binary, n int, payload binary", GATHER), "cut")
    unique = cut.dropDuplicates(["digest"]).select("digest", "n", F.lit(2 if narrow else 4).alias("width"), "payload")
    unique.write.option("compression", "none").parquet(f"{path}/chunks")
    # Equal rows are counted before the chunks of a document come together.
    once = cut.groupBy("doc_id", "whole", "seq", "digest", "n").agg(F.count(F.lit(1)).alias("copies"))
    lists = once.groupBy("doc_id", "whole").agg(F.max("copies").alias("copies"), F.array_sort(F.collect_list(F.struct("seq", "n", "digest"))).alias("c"))
    dealt = lists.repartitionByRange("doc_id", "whole").sortWithinPartitions("doc_id", "whole")
    dealt = dealt.select("doc_id", "copies", F.col("c.n").alias("n"), F.col("c.digest").alias("digests"))
    made = staged(dealt.mapInArrow(_recipes, _DOCUMENT), "recipes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    parts = made.filter("pos < 0").select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset"), F.col("doc_id").alias("first"), "last", "documents", "n_tokens", "root")
    parts.coalesce(1).write.parquet(f"{path}/manifest")
    offsets = spark.read.parquet(f"{path}/manifest").select("part", "offset")
    placed = made.filter("pos >= 0").join(offsets, "part").select("part", "pos", "doc_id", (F.col("offset") + F.col("start")).alias("start"), "n_tokens", "digests", "root")
    placed.write.option("compression", "zstd").parquet(f"{path}/recipes")


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Recipes of one range's sorted documents, `start` counted from the range's own; then its manifest
    row, at pos -1."""
    from pyspark import TaskContext

    part, pos, start, first, last, roots = TaskContext.get().partitionId(), 0, 0, None, None, []
    for b in batches:
        out = []
        for doc, copies, n, digests in zip(*(c.to_pylist() for c in b.columns)):
            root, total = merkle(digests), sum(n)
            for _ in range(copies):
                out.append((part, pos, doc, None, start, total, digests, root, None))
                roots.append(root)
                first, last = doc if pos == 0 else first, doc
                pos, start = pos + 1, start + total
                if len(out) >= 1000:
                    yield _document_batch(out)
                    out = []
        if out:
            yield _document_batch(out)
    if pos:
        yield _document_batch([(part, -1, first, last, None, start, None, merkle(roots), pos)])


def _document_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["part", "pos", "doc_id", "last", "start", "n_tokens", "digests", "root", "documents"])


def chunk_ids(payload: bytes, width: int, unpack=None) -> np.ndarray:
    data = (unpack or zstandard.ZstdDecompressor().decompress)(payload)
    return np.frombuffer(data, np.uint16 if width == 2 else np.uint32).astype(np.uint32)


def _chunk_digests(b: pa.RecordBatch) -> pa.RecordBatch:
    n, crc, unpack = [], [], zstandard.ZstdDecompressor().decompress
    for digest, width, payload in zip(*(c.to_pylist() for c in b.columns)):
        data = chunk_ids(payload, width, unpack).tobytes()
        if hashlib.sha256(data).digest() != digest:
            raise ValueError(f"chunk {digest.hex()} is damaged")
        n.append(len(data) // 4)
        crc.append(zlib.crc32(data))
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["digest", "n", "crc"])


def _joined(b: pa.RecordBatch) -> pa.RecordBatch:
    crcs = []
    for doc, tokens, root, chunks in zip(*(c.to_pylist() for c in b.columns[:1] + b.columns[2:])):
        if sum(c["n"] for c in chunks) != tokens or merkle([c["digest"] for c in chunks]) != root:
            raise ValueError(f"the recipe of document {doc} does not match its chunks")
        crc = 0
        for c in chunks:
            crc = crc32_joined(crc, c["crc"], 4 * c["n"])
        crcs.append(crc)
    return pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the store, from its files: every chunk is
    unpacked and verified once, and a document's checksum is joined from those of its chunks, so ids
    are not moved.  The manifest is verified first.  Raises if a chunk, a recipe or the manifest is
    damaged."""
    configure(spark)
    verify_manifest(spark, path)
    chunks = spark.read.parquet(f"{path}/chunks").select("digest", "width", "payload")
    known = arrow_map(chunks, _chunk_digests, "digest binary, n long, crc long")
    recipes = spark.read.parquet(f"{path}/recipes")
    each = recipes.select("part", "pos", F.posexplode("digests").alias("seq", "digest")).join(known, "digest")
    lists = each.groupBy("part", "pos").agg(F.array_sort(F.collect_list(F.struct("seq", "digest", "n", "crc"))).alias("chunks"))
    whole = recipes.select("part", "pos", "doc_id", "start", "n_tokens", "root").join(lists, ["part", "pos"], "left")
    return arrow_map(whole.select("doc_id", "start", "n_tokens", "root", "chunks"), _joined, "doc_id long, start long, n_tokens long, ids_crc32 long")


def restore(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<int>) of each document in the store; filter by doc_id to read a few."""
    configure(spark)

    def unpacked(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = [chunk_ids(p, w).astype(np.int32) for w, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["digest", "ids"])

    known = arrow_map(spark.read.parquet(f"{path}/chunks").select("digest", "width", "payload"), unpacked, "digest binary, ids array<int>")
    recipes = spark.read.parquet(f"{path}/recipes")
    each = recipes.select("part", "pos", "doc_id", "start", F.posexplode("digests").alias("seq", "digest")).join(known, "digest")
    lists = each.groupBy("part", "pos", "doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("seq", "ids"))).alias("c"))
    return lists.select("doc_id", "start", F.flatten(F.col("c.ids")).alias("ids"))


def verify_manifest(spark: SparkSession, path: str) -> str:
    """Recomputes the manifest from the recipes; returns the store's root as hex, or raises."""
    found = spark.read.parquet(f"{path}/recipes").groupBy("part").agg(F.min("start").alias("offset"), F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("documents"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "root"))), lambda x: x["root"]).alias("roots"))

    def roots(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*b.columns[:4], pa.array([merkle(r) for r in b.column(4).to_pylist()], pa.binary())], columns)

    columns = ["part", "offset", "n_tokens", "documents", "root"]
    made = arrow_map(found, roots, "part int, offset long, n_tokens long, documents long, root binary")
    stored = spark.read.parquet(f"{path}/manifest").select(columns)
    if made.exceptAll(stored).union(stored.exceptAll(made)).limit(1).count():
        raise ValueError("the manifest does not match the recipes")
    return merkle([r["root"] for r in stored.orderBy("part").select("root").toLocalIterator()]).hex()


def op10_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = fresh_path(spark, "store")
    try:
        with scratch(spark):
            write(docs, path, public_path(), 2)
        with scratch(spark):
            return staged(read_checksums(spark, path), "checksums", result=True)
    finally:
        remove(spark, path)
