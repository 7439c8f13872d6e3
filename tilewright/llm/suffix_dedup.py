"""Removal of long repeated passages, by a run-length compressed index.

Two equal strings of L bytes hold the same smallest hash of their k-byte substrings.  A text's L-byte
windows are therefore cut into runs of equal smallest hash; the bytes of such a run are a context, and
equal windows stand only in contexts of equal hash.  Contexts are counted by hash and content, so the
copies of a passage meet as one context with a number; a context that occurs twice is repeated as a
whole.  What is left are different contexts of one hash, and those that hold their hash twice.

These are indexed in groups of bounded size: a suffix order, its Burrows-Wheeler transform in runs,
and the longest common prefixes at the runs' first and last places only.  Elsewhere in a run the
matching statistic of a position is one less than that of the position before it, so one pass over
the text streams the statistics of all positions from these samples.  Windows whose statistic reaches
L are repeated.

A group beyond the bound (a passage in very many different surroundings) is split until its parts can be
indexed.  All its windows hold the same core, at different offsets.  A window reaches at least half of
what it has beside the core either to the right or to the left of it, so windows are dealt into two halves by
offset, and each half is grouped by those further bytes, which equal windows share: the core grows by
them.  Copies meet as one again in each part.  Cores cannot grow beyond the window, so this ends, and no
window is left out."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm._common import arrow_map, bytes_of, configure, free_name, scratch, staged, table, task_memory

#: Bytes of a passage that must repeat, of an anchor (a power of two), and most windows of a context.
LENGTH, ANCHOR, MOST_WINDOWS = 400, 128, 1024

#: Bytes of text whose windows are handled at once, of contexts indexed at once, and of one group.
AT_ONCE, INDEX_BYTES, GROUP_BYTES = 2 << 20, 1 << 20, 1 << 20

_MIX = 0x9E3779B97F4A7C15


def least_hashes(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each `anchor`-byte substring, and for each window of `length` bytes the smallest of
    its substrings'."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX)
    width, mult = 1, 0xD6E8FEB86659FD93
    while width < anchor:
        h = h[:-width] * np.uint64(mult) + h[width:]
        h ^= h >> np.uint64(32)
        width, mult = 2 * width, mult * mult % (1 << 64) | 1
    h *= np.uint64(_MIX)
    h ^= h >> np.uint64(29)
    each, room, step = h, length - anchor + 1, 1
    while 2 * step <= room:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return each, np.minimum(h[: len(h) - (room - step)], h[room - step :]) if step < room else h


def contexts(texts: list[bytes], length: int, anchor: int) -> Iterator[tuple[int, int, int, int, bool, bytes]]:
    """(text, smallest hash, first window, windows, again, bytes) of each run of windows.  again: the hash
    occurs more than once, so that windows of the run can equal each other."""
    run: list[tuple[int, int, bytes]] = []  # text, first window, bytes
    size = 0

    def flush():
        data = b"".join([p for _, _, p in run])
        each, least = least_hashes(np.frombuffer(data, np.uint8), length, anchor)
        at = 0
        for k, first, p in run:
            own = least[at : at + len(p) - length + 1]
            cuts = np.flatnonzero(own[1:] != own[:-1]) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)]):
                for b in range(s, e, MOST_WINDOWS):
                    n = min(e - b, MOST_WINDOWS)
                    value = own[b]
                    again = np.count_nonzero(each[at + b : at + b + n + length - anchor] == value) > 1
                    yield k, int(value), first + b, n, again, p[b : b + n - 1 + length]
            at += len(p)

    for k, t in enumerate(texts):
        for first in range(0, len(t) - length + 1, AT_ONCE):  # parts of long texts overlap by a window
            part = t[first : first + AT_ONCE + length - 1]
            run.append((k, first, part))
            size += len(part)
            if size >= AT_ONCE:
                yield from flush()
                run, size = [], 0
    if run:
        yield from flush()


class RunIndex:
    """Suffix order, run-length Burrows-Wheeler transform and sampled longest common prefixes of texts,
    held as one array with a separator (0) after each; bytes are stored plus 1."""

    def __init__(self, texts: list[bytes]):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = np.append(0, self.ends[:-1] + 1)
        joined = np.zeros(int(self.ends[-1]) + 1, np.uint16)
        inside = np.ones(len(joined), bool)
        inside[self.ends] = False
        joined[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
        self.text = joined
        self.left = np.repeat(self.ends, lengths + 1) - np.arange(len(joined))  # bytes up to the text's end
        self.order = self._sorted(int(lengths.max()) + 1)
        before = np.where(self.order > 0, joined[self.order - 1], 0)
        # A separator before a suffix never continues a run: there the text starts.
        change = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.run_starts = np.append(0, np.flatnonzero(change) + 1)

    def _sorted(self, depth: int) -> np.ndarray:
        """Suffixes in order of their first `depth` symbols, by doubling; a suffix that is alone in its
        class is not touched again."""
        n = len(self.text)
        key = np.zeros(n, np.int64)
        for k in range(6):  # the first six symbols
            key[: n - k] |= self.text[k:].astype(np.int64) << (9 * (5 - k))
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        first = np.append(True, ordered[1:] != ordered[:-1])
        heads = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = heads
        width = 6
        # Classes of more than one suffix: their places in the order.
        many = np.flatnonzero(~first | np.append(~first[1:], False))
        while width < depth and len(many):
            at = order[many]
            second = np.where(at + width < n, rank[np.minimum(at + width, n - 1)] + 1, 0)
            pair = rank[at] * (n + 1) + second
            by = np.argsort(pair, kind="stable")
            at, pair = at[by], pair[by]
            order[many] = at  # classes keep their places, as the rank leads
            first = np.append(True, pair[1:] != pair[:-1])
            heads = many[np.maximum.accumulate(np.where(first, np.arange(len(many)), 0))]
            rank[at] = heads
            many = many[~first | np.append(~first[1:], False)]
            width *= 2
        return order

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes a and b inside their texts."""
        room = np.minimum(self.left[a], self.left[b])
        out = np.zeros(len(a), np.int64)
        alive = np.arange(len(a))
        words, n = self._words(), len(self.text)
        while len(alive):
            x, y = a[alive] + out[alive], b[alive] + out[alive]
            same = (words[np.minimum(x, n - 1)] == words[np.minimum(y, n - 1)]) & (out[alive] + 8 <= room[alive])
            done = alive[~same]
            for _ in range(8):  # the last few bytes one by one
                go = done[out[done] < room[done]]
                go = go[self.text[a[go] + out[go]] == self.text[b[go] + out[go]]]
                out[go] += 1
                done = go
            alive = alive[same]
            out[alive] += 8
        return out

    def _words(self) -> np.ndarray:
        """Eight bytes from each place (separators read as zero bytes; lengths are checked elsewhere)."""
        n = len(self.text)
        low = (np.maximum(self.text, 1) - 1).astype(np.uint64)
        out = np.zeros(n, np.uint64)
        for k in range(8):
            out[: n - k] |= low[k:] << np.uint64(8 * k)
        return out

    def statistics(self) -> np.ndarray:
        """For each place the length of the longest match that starts there and occurs elsewhere."""
        n = len(self.order)
        value = np.zeros(n, np.int64)
        heads = self.run_starts[self.run_starts > 0]
        common = self._common(self.order[heads - 1], self.order[heads])
        np.maximum.at(value, self.order[heads], common)  # first of a run, with the suffix above
        np.maximum.at(value, self.order[heads - 1], common)  # last of a run, with the suffix below
        # Between samples: one less than at the place before.
        place = np.arange(n)
        reach = np.maximum.accumulate(value + place)
        return np.minimum(np.maximum(reach - place, 0), self.left)


def covered(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Runs of bytes covered by strings of `length` bytes at ascending starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist()))


def repeated_parts(group: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Of different texts: the runs of each that strings of `length` bytes cover which occur elsewhere."""
    index = RunIndex(group)
    hit = index.statistics() >= length
    return [covered(np.flatnonzero(hit[s:e]), length) for s, e in zip(index.starts.tolist(), index.ends.tolist())]


_SPANS = "array<struct<f: int, t: int>>"


def _spans_array(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"f": f, "t": t} for f, t in s] for s in spans], pa.list_(pa.struct([("f", pa.int32()), ("t", pa.int32())])))


def _indexed(length: int):
    """Spans of contexts that come sorted by group; whole groups are indexed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory():
            yield from groups(batches)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if size >= INDEX_BYTES and row[0] != last:
                    yield made(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                last = row[0]
        if held:
            yield made(held)

    def made(held: list[tuple]) -> pa.RecordBatch:
        spans = repeated_parts([r[4] for r in held], length)
        d, t, lo = ([r[k] for r in held] for k in (1, 2, 3))
        return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(lo, pa.int32()), _spans_array(spans)], ["d", "t", "lo", "spans"])

    return run


def removed_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group_bytes: int = GROUP_BYTES, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(d, t, spans) for texts with repeated passages; d and t (id, hash of the text) tell rows apart, equal
    rows share one.  spans: bytes (f, t) that strings of `length` bytes cover which also start
    elsewhere, not merged.  An anchor of over half the length is halved until it fits."""
    while 2 * anchor > length and anchor > 1:
        anchor //= 2
    keyed_docs = _keyed(docs, text, id)

    def cut(b: pa.RecordBatch) -> pa.RecordBatch | None:
        d, t, texts = b.column(0).to_pylist(), b.column(1).to_pylist(), bytes_of(b.column(2))
        rows = [(h, xxhash.xxh3_64_intdigest(part), d[k], t[k], first, n, again) for k, h, first, n, again, part in contexts(texts, length, anchor)]
        if not rows:
            return None
        h, c, d, t, first, n, again = zip(*rows)
        return pa.RecordBatch.from_arrays([_signed(h), _signed(c), pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(again, pa.bool_())], ["h", "c", "d", "t", "lo", "n", "again"])

    # h and c together are 128 bits of a context.
    found = staged(arrow_map(keyed_docs, cut, "h long, c long, d long, t long, lo int, n int, again boolean"), "contexts")
    distinct = staged(found.groupBy("h", "c").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("d", "t", "lo", "n")).alias("one"), F.max("again").alias("again")), "distinct")
    groups = distinct.groupBy("h").agg((F.max("again") | (F.count(F.lit(1)) > 1)).alias("open"), F.sum(F.col("one.n") + (length - 1)).alias("size"))
    # Contexts that occur twice: all their places.
    twice = distinct.filter("times > 1").select("h", "c")
    whole = found.join(twice, ["h", "c"]).select("d", "t", "lo", F.array(F.struct(F.lit(0).alias("f"), (F.col("n") + (length - 1)).alias("t"))).cast(_SPANS).alias("spans"))
    # Contexts that can match in part: one place of each, with its bytes.
    mixed = distinct.join(groups.filter("open"), "h").select("one.d", "one.t", F.struct("h", "one.lo", "one.n", (F.col("size") > group_bytes).alias("large")).alias("c"))
    wanted = mixed.groupBy("d", "t").agg(F.collect_list("c").alias("cs"))

    def fetched(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(c["h"], d, t, c["lo"], x[c["lo"] : c["lo"] + c["n"] - 1 + length], c["large"]) for d, t, x, cs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bytes_of(b.column(2)), b.column(3).to_pylist()) for c in cs]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["h", "d", "t", "lo", "part", "large"])

    parts = arrow_map(keyed_docs.join(wanted, ["d", "t"]).select("d", "t", "text", "cs"), fetched, "h long, d long, t long, lo int, part binary, large boolean")
    parts = staged(parts, "parts").dropDuplicates(["h", "d", "t", "lo"])
    configure(docs.sparkSession)
    small = parts.filter("NOT large").select("h", "d", "t", "lo", "part")
    sure, split = _split(parts.filter("large").select("h", "d", "t", "lo", "part"), length, anchor, group_bytes)
    dealt = small.unionByName(split).repartition("h").sortWithinPartitions("h", "d", "t", "lo")
    indexed = dealt.mapInArrow(_indexed(length), f"d long, t long, lo int, spans {_SPANS}").filter("size(spans) > 0")
    return whole.unionByName(indexed).unionByName(sure).select("d", "t", F.transform("spans", lambda s: F.struct((s["f"] + F.col("lo")).alias("f"), (s["t"] + F.col("lo")).alias("t"))).alias("spans"))


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


_CORED = "h long, c long, d long, t long, lo int, part binary, core int, until int"


def _cored(rows: list[tuple]) -> pa.RecordBatch | None:
    """Rows (h, d, t, lo, part, core, until) with the hash c of the part and of where its core lies."""
    if not rows:
        return None
    h, d, t, lo, part, core, until = zip(*rows)
    c = [xxhash.xxh3_64_intdigest(p, core[k]) for k, p in enumerate(part)]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([_signed(h), _signed(c), *[pa.array(x, k) for x, k in zip((d, t, lo, part, core, until), kinds)]], ["h", "c", "d", "t", "lo", "part", "core", "until"])


def _split(parts: DataFrame, length: int, anchor: int, group_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Contexts of groups beyond the bound as (spans that are repeated as wholes, contexts of smaller groups)."""

    def cores(b: pa.RecordBatch) -> pa.RecordBatch | None:
        """The windows of each context by the first place of their smallest hash, which becomes the core."""
        rows = []
        for h, d, t, lo, part in zip(*(c.to_pylist() for c in b.columns)):
            each, _ = least_hashes(np.frombuffer(part, np.uint8), length, anchor)
            last, first = len(part) - length, 0
            for p in np.flatnonzero(each == np.uint64(h % (1 << 64))).tolist():
                to = min(p, last)
                if first <= to:
                    rows.append((h % (1 << 64), d, t, lo + first, part[first : to + length], p - first, p - first + anchor))
                first = p + 1
        return _cored(rows)

    def halves(b: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for h, d, t, lo, part, core, until in zip(*(b.column(k).to_pylist() for k in (0, 2, 3, 4, 5, 6, 7))):
            last, slack = len(part) - length, length - (until - core)
            right = (slack + 1) // 2
            left = slack - right + 1
            # Windows from `at` on reach `right` bytes beyond the core; those before it reach `left` bytes before it.
            at = max(0, until + right - length)
            if at <= last:
                key = xxhash.xxh3_64_intdigest(b"r" + part[until : until + right], h % (1 << 64))
                rows.append((key, d, t, lo + at, part[at:], core - at, until + right - at))
            if at > 0 and left <= core:
                end = min(at - 1, last)
                key = xxhash.xxh3_64_intdigest(b"l" + part[core - left : core], h % (1 << 64))
                rows.append((key, d, t, lo, part[: end + length], core - left, until))
        return _cored(rows)

    spark = parts.sparkSession
    sure = spark.createDataFrame([], f"d long, t long, lo int, spans {_SPANS}")
    small = spark.createDataFrame([], "h long, d long, t long, lo int, part binary")
    live = staged(arrow_map(parts, cores, _CORED), "cores")
    while live.limit(1).count():
        one = F.min(F.struct("d", "t", "lo", "part", "core", "until")).alias("one")
        reps = staged(live.groupBy("h", "c").agg(F.count(F.lit(1)).alias("times"), one), "reps")
        whole = F.array(F.struct(F.lit(0).alias("f"), F.octet_length("part").alias("t"))).cast(_SPANS).alias("spans")
        sure = sure.unionByName(live.join(reps.filter("times > 1").select("h", "c"), ["h", "c"]).select("d", "t", "lo", whole))
        sizes = reps.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("one.part")).alias("size")).filter("n > 1")
        open_ = reps.join(sizes, "h").select("h", "c", "one.*", (F.col("size") > group_bytes).alias("large"))
        small = small.unionByName(open_.filter("NOT large").select("h", "d", "t", "lo", "part"))
        live = staged(arrow_map(open_.filter("large").drop("large"), halves, _CORED), "halves")
    return sure, small


def _keyed(docs: DataFrame, text: str, id: str) -> DataFrame:
    return docs.select(F.coalesce(docs[id].cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64(docs[text]).alias("t"), docs[text].alias("text"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Spans that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for f, t in sorted((s["f"], s["t"]) for s in spans):
        if out and f <= out[-1][1]:
            out[-1] = (out[-1][0], max(t, out[-1][1]))
        else:
            out.append((f, t))
    return out


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *[t for _, t in spans]]
    return b"".join([data[s:e] for s, e in zip(ends, [*[f for f, _ in spans], len(data)])])


def whole_words(data: bytes, f: int, t: int) -> int:
    """Words of data[f:t], without those that go on outside."""
    cut_start = f > 0 and data[f - 1 : f + 1] == data[f - 1 : f + 1].strip()
    cut_end = t < len(data) and data[t - 1 : t + 1] == data[t - 1 : t + 1].strip()
    return max(0, len(data[f:t].split()) - cut_start - cut_end)


def with_spans(docs: DataFrame, spans: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """docs, each row with one more column, the last: the spans of its text, or null."""
    spans = staged(spans, "spans", result=True)
    each = spans.select("d", "t", F.explode("spans").alias("s")).groupBy("d", "t", "s").count()
    lists = each.groupBy("d", "t").agg(F.collect_list("s").alias("s"))
    own_d, own_t, own_s = (free_name(docs.columns, c) for c in ("d", "t", "spans"))
    d, t = F.coalesce(docs[id].cast("long"), F.lit(-(1 << 63))), F.xxhash64(docs[text])
    lists = lists.select(F.col("d").alias(own_d), F.col("t").alias(own_t), F.col("s").alias(own_s))
    return docs.withColumns({own_d: d, own_t: t}).join(lists, [own_d, own_t], "left").select(*docs.columns, own_s)


def removal_digests(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group_bytes: int = GROUP_BYTES, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for each row of docs.

    Null and empty texts have no bytes and nothing is removed; texts shorter than `length` stay; equal
    rows are elsewhere for each other; an empty table gives an empty result; other columns are not
    read."""
    own = docs.select(docs[id].alias("doc_id"), docs[text].alias("text"))
    with scratch(docs.sparkSession):
        rows = with_spans(own, removed_spans(own, length, anchor, group_bytes))

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        n, gone, runs, digest, out = [], [], [], [], []
        for data, spans in zip(bytes_of(b.column(1)), b.column(2).to_pylist()):
            m = merged(spans or [])
            n.append(len(data))
            gone.append(sum(t - f for f, t in m))
            runs.append(len(m))
            digest.append(hashlib.sha256(without(data, m)).hexdigest())
            out.append(m)
        return pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string()), _spans_array(out)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return arrow_map(rows, kernel, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans {_SPANS}")


def deduplicated(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, least_words: int = 0, text: str = "text", id: str = "doc_id", count: str | None = "n_chars") -> DataFrame:
    """docs with repeated passages taken out of their texts: runs of bytes that strings of `length` bytes
    cover which also start elsewhere, if they hold at least `least_words` whole words.
    Characters of which only a part is left go as well.  All columns stay; `count`, if there is such a
    column, gets the new number of characters.  A null text stays null."""
    columns = docs.columns
    at, counted = columns.index(text), columns.index(count) if count in columns else None
    with scratch(docs.sparkSession):
        rows = with_spans(docs, removed_spans(docs, length, anchor, text=text, id=id), text, id)

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        for x, data, spans in zip(b.column(at), bytes_of(b.column(at)), b.column(b.num_columns - 1).to_pylist()):
            gone = [(f, t) for f, t in merged(spans or []) if not least_words or whole_words(data, f, t) >= least_words]
            kept.append(None if not x.is_valid else without(data, gone).decode("utf-8", "ignore"))
        cols = list(b.columns[:-1])
        cols[at] = pa.array(kept, cols[at].type)
        if counted is not None:
            cols[counted] = pa.array([None if k is None else len(k) for k in kept], cols[counted].type)
        return pa.RecordBatch.from_arrays(cols, columns)

    return arrow_map(rows, kernel, docs.schema)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = removal_digests(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
