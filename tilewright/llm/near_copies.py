"""Near copies: operator 3 at a Jaccard similarity of five-word shingle sets instead of a radius.

Two sources of candidates, one test.  SimHash fingerprints of the sets, linked through deletion-variant
signatures (simhash.links), come first: they join exact copies and light edits.  At a similarity of 0.8
fingerprints differ in about 10 of 64 bits, which no radius with one wildcard reaches, so an exact way
finds the rest: two sets of similarity >= 0.8 share one of their first n - ceil(0.8 n) + 1 shingles,
whatever the order of shingles is, as long as all sets follow the same.  Sets are indexed by these
prefixes, equal shingles are brought together by one shuffle, and pairs that their sizes and places
allow are kept.  Shingles that are frequent in a sample come last in the order, so that common lines
seldom index anything; the sample bears on speed only.  It is a share of the documents, not a number of them: what
a number of documents has in common would else grow with the table, and with it the groups to be compared.  Before whole sets are read, bitmaps rule out
pairs: a bit that one set has and the other has not is a shingle of the one that the other lacks.  Every
link, of either source, is verified on the whole sets.

Sets that share a shingle with very many others are not paired with all of them: every such group is
compared with a few of its members, and what is linked already is left out.  Groups that stay apart are
dealt into blocks, and every two blocks are compared as whole sets.  Of the pairs of a family a few of each node are verified
first, then one for each two classes that are still apart, then the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import simhash
from tilewright.llm._common import arrow_map, bytes_of, configure, staged, task_memory
from tilewright.llm.components import components

#: Largest group that is paired at once, rows handled at once, members that a larger group is compared with in a round, and rounds.
GROUP_LIMIT, ROWS_AT_ONCE, HUBS, ROUNDS = 128, 200_000, 4, 4

#: Members of larger groups are compared with each other without further rounds if they have at most so many
#: partners on average; members of a block, and shingles that are counted at once.
PARTNERS, BLOCK, SHINGLES = 4096, 512, 4096

#: Pairs are verified at once if there are at least so many nodes for each.
SHARE = 4

#: Documents of the sample at least, and one of how many; how many of them make a shingle frequent; at most so
#: many shingles are sent out, those of most documents.
SAMPLE, SAMPLE_STEP, FREQUENT, FREQUENT_MOST = 4000, 16, 3, 2_000_000

#: Bits of a bitmap for each shingle and at least, and up to how many row keys are sent to all executors instead of dealing out texts.
BITS_EACH, LEAST_BITS, SENT = 4, 512, 50_000


def shingle_set(text: bytes, shingle: int = 5) -> np.ndarray:
    """Distinct XXH64 values of the shingles, sorted; a shorter text is one shingle, a blank one has none."""
    words = text.lower().split()  # of bytes: A-Z only, and exactly the ASCII white space
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        return np.array([digest(join(words))] if words else [], np.uint64)
    return np.unique(np.array([digest(join(w)) for w in zip(*(words[k:] for k in range(shingle)))], np.uint64))


def prefix_size(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1 if n else 0


def bitmap(s: np.ndarray) -> bytes:
    """At least BITS_EACH bits a shingle, a power of two; one of half the size is this one folded."""
    size = max(LEAST_BITS, 1 << (BITS_EACH * max(1, len(s)) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[s & np.uint64(size - 1)] = 1
    return np.packbits(bits).tobytes()


def most_common(n: int, x: bytes, m: int, y: bytes) -> int:
    """A bound of how many shingles sets of n and m with these bitmaps have in common."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(x) != len(y):
        half = max(len(x), len(y)) // 2
        x, y = ((z[:half] | z[half:]) if len(z) > half else z for z in (x, y))
    return min(n - int(np.bitwise_count(x & ~y).sum(dtype=np.int64)), m - int(np.bitwise_count(y & ~x).sum(dtype=np.int64)))


def row_keys(docs: DataFrame) -> list:
    """Two hashes of the whole row, as columns k1 and k2; nulls count."""
    whole = [x for c in docs.columns for x in (docs[c], docs[c].isNull())]
    return [F.xxhash64(F.lit(salt), *whole).alias(name) for salt, name in (("first", "k1"), ("second", "k2"))]


def _frequent(docs: DataFrame) -> np.ndarray:
    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t) for t in bytes_of(b.column(0))]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["s"])

    step = min(max(1, docs.count() // SAMPLE), SAMPLE_STEP)
    taken = docs.filter(F.pmod(F.xxhash64("text"), F.lit(step)) == 0).select("text").distinct()
    counts = arrow_map(taken, kernel, "s long").groupBy("s").agg(F.count(F.lit(1)).cast("int").alias("n")).filter(F.col("n") >= FREQUENT)
    counts = staged(counts, "frequent")
    least, rows = FREQUENT, 0
    sizes = counts.groupBy(F.least("n", F.lit(SAMPLE)).alias("n")).count().collect()
    for r in sorted(sizes, key=lambda r: -r["n"]):
        rows += r["count"]
        if rows > FREQUENT_MOST:
            least = r["n"] + 1
            break
    found = counts.filter(F.col("n") >= least).select("s").toArrow().column(0)
    return found.to_numpy().view(np.uint64)


def fingerprint(s: np.ndarray) -> int:
    """SimHash of a set: a bit is 1 if it is set in over half of the values; an empty set has zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(s), 65536):
        ones += np.unpackbits(s[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(s)).tobytes(), "little")


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, k1, k2, node, n, fp, prefix, bits) for each row: node identifies its shingle set of n shingles."""
    frequent = np.sort(_frequent(docs))

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        nodes, sizes, fps, prefixes, maps = [], [], [], [], []
        for t in bytes_of(b.column(3)):
            s = shingle_set(t)
            nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()))
            sizes.append(len(s))
            fps.append(fingerprint(s))
            maps.append(bitmap(s))
            if len(frequent) and len(s):
                late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                s = np.concatenate([s[~late], s[late]])
            prefixes.append(s[: prefix_size(len(s))].tobytes())
        signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
        made = [signed(nodes), pa.array(sizes, pa.int32()), signed(fps), pa.array(prefixes, pa.binary()), pa.array(maps, pa.binary())]
        return pa.RecordBatch.from_arrays([*b.columns[:3], *made], ["doc_id", "k1", "k2", "node", "n", "fp", "prefix", "bits"])

    keyed = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *row_keys(docs), docs["text"].alias("text"))
    return arrow_map(keyed, kernel, "doc_id long, k1 long, k2 long, node long, n int, fp long, prefix binary, bits binary")


def _light(nodes: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes of equal fingerprints or such that SimHash links within 3 bits."""
    firsts = staged(nodes.groupBy("fp").agg(F.min("node").alias("first")), "firsts")
    equal = nodes.select("node", F.col("fp").alias("own")).join(firsts, F.col("own") == firsts.fp).filter("node > first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    x, y = (firsts.select(F.col("fp").alias(c), F.col("first").alias(f"first_{c}")) for c in "ab")
    near = simhash.links(firsts.select("fp")).join(x, "a").join(y, "b")
    return equal.union(near.select(F.least("first_a", "first_b"), F.greatest("first_a", "first_b")))


def _entries(b: pa.RecordBatch) -> pa.RecordBatch:
    """(s, node, n, at): a row for each shingle of a prefix."""
    parts = [np.frombuffer(p, np.int64) for p in b.column(2).to_pylist()]
    sizes = np.array([len(p) for p in parts], np.int64)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    made = [np.concatenate(parts), np.repeat(b.column(0).to_numpy(), sizes), np.repeat(b.column(1).to_numpy(), sizes), at.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["s", "node", "n", "at"])


def possible(n, at, m, to):
    """Whether sets of n and m shingles whose first common one has the places at and to can be similar enough."""
    left = np.minimum(n - at, m - to)
    return (5 * np.minimum(n, m) >= 4 * np.maximum(n, m)) & (9 * left.astype(np.int64) >= 4 * (n.astype(np.int64) + m))


def _pairs(s, node, n, at) -> tuple[np.ndarray, np.ndarray]:
    """Possible pairs (smaller node first, each once) of equal s; rows are sorted by s."""
    a, b = [node[:0]], [node[:0]]
    k = np.flatnonzero(s[1:] == s[:-1])
    for d in range(1, len(s)):
        if not len(k):
            break
        good = k[possible(n[k], at[k], n[k + d], at[k + d])]
        a.append(np.minimum(node[good], node[good + d]))
        b.append(np.maximum(node[good], node[good + d]))
        k = k[k + d + 1 < len(s)]
        k = k[s[k + d + 1] == s[k]]
    found = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
    return found[:, 0], found[:, 1]


def _grouped(limit: int):
    """Of entries sorted by s, n and node: possible pairs (a, b) of groups of up to `limit` rows, pairs of the
    rows of larger groups with the first few (the smallest sets), and the rows of larger groups themselves.  At most a block
    and a small group are held."""
    names = ["a", "b", "s", "n", "at"]

    def hubbed(rows, hubs):
        """Pairs of the rows of one large group with its hubs, both (s, node, n, at)."""
        _, node, n, at = rows
        for _, hub, size, place in zip(*hubs):
            good = (node != hub) & possible(n, at, size, place)
            yield np.minimum(node[good], hub), np.maximum(node[good], hub)

    def block(s, node, n, at, hot):
        """hot: the first rows of the group that the last block ended with, if it was large."""
        starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        sizes = np.diff(np.append(starts, len(s)))
        large = np.repeat(sizes > limit, sizes)
        if hot is not None:
            large |= s == hot[0][0]
        found = [_pairs(*(x[~large] for x in (s, node, n, at)))]
        for k, size in zip(starts.tolist(), sizes.tolist()):
            if large[k]:
                group = tuple(x[k : k + size] for x in (s, node, n, at))
                found += hubbed(group, hot if hot is not None and group[0][0] == hot[0][0] else tuple(x[:HUBS] for x in group))
        a, b = (np.concatenate(x) for x in zip(*found))
        if len(found) > 1 and len(a):
            a, b = np.unique(np.stack([a, b], 1), axis=0).T
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int32())], names)
        if large.any():
            yield pa.RecordBatch.from_arrays([pa.array(node[large]), pa.nulls(int(large.sum()), pa.int64()), *(pa.array(x[large]) for x in (s, n, at))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory():
            yield from blocks(batches)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows, hot = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            rows += batch.num_rows
            if rows < ROWS_AT_ONCE:
                continue
            all_ = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(all_[0], all_[0][-1]))  # the last group may go on
            if len(all_[0]) - cut > limit:  # it is large already
                yield from block(*all_, hot)
                if hot is None or hot[0][0] != all_[0][-1]:
                    hot = tuple(x[cut : cut + HUBS].copy() for x in all_)
                held, rows = [], 0
                continue
            if cut:
                yield from block(*(c[:cut] for c in all_), hot)
            held, rows = [tuple(c[cut:] for c in all_)], len(all_[0]) - cut
        if rows:
            yield from block(*(np.concatenate(c) for c in zip(*held)), hot)

    return run


def _hopeful(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the bitmaps of their sets do not rule out."""

    def hopeful(b: pa.RecordBatch) -> pa.RecordBatch:
        good = [9 * most_common(n, x, m, y) >= 4 * (n + m) for n, m, x, y in zip(*(b.column(k).to_pylist() for k in (2, 3, 4, 5)))]
        return b.select([0, 1]).filter(pa.array(good, pa.bool_()))

    x, y = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab")
    return staged(arrow_map(pairs.join(x, "a").join(y, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b"), hopeful, "a long, b long"), "hopeful")


def _sets(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set) for the nodes of the pairs."""

    def sets(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t).tobytes() for t in bytes_of(b.column(1))], pa.binary())], ["node", "set"])

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    one = staged(nodes.join(ends, "node", "left_semi").select("node", F.col("k1").alias("one1"), F.col("k2").alias("one2")), "one")
    few = F.broadcast(one) if one.count() <= SENT else one
    texts = docs.select(*row_keys(docs), docs["text"].alias("text"))
    found = texts.join(few, (texts.k1 == one.one1) & (texts.k2 == one.one2)).select("node", "text")
    return staged(arrow_map(found, sets, "node long, set binary"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets have a Jaccard similarity of at least 0.8."""

    def similar(b: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(5 * both >= 4 * (len(x) + len(y) - both))
        return b.select([0, 1]).filter(pa.array(good, pa.bool_()))

    x, y = (sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    return staged(arrow_map(pairs.join(x, "a").join(y, "b").select("a", "b", "set_a", "set_b"), similar, "a long, b long"), "similar")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b, label_a, label_b) of the pairs whose ends are not connected yet."""
    x, y = (found.select(F.col("node").alias(c), F.col("component").alias(f"label_{c}")) for c in "ab")
    both = pairs.join(x, "a", "left").join(y, "b", "left").select("a", "b", F.coalesce("label_a", "a").alias("label_a"), F.coalesce("label_b", "b").alias("label_b"))
    return both.filter("label_a <> label_b")


class _Links:
    """Verified links and their components, growing."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, repeats: bool):
        self.docs, self.nodes, self.repeats = docs, nodes, repeats
        self.size = nodes.count()
        self.links: DataFrame | None = None
        self._found: DataFrame | None = None

    @property
    def found(self) -> DataFrame:
        """(node, component) of the nodes with links."""
        if self._found is None:
            self._found = components(self.links)
        return self._found

    def compare(self, rows: DataFrame, sizes: DataFrame) -> None:
        """Links among the rows (s, node, label) of each s, all with all; sizes: (s, rows)."""
        sets = _sets(rows.select(F.col("node").alias("a"), F.col("node").alias("b")), self.docs, self.nodes)
        if self.repeats:
            sets = staged(sets.dropDuplicates(["node"]), "sets")
        blocks = F.ceil(F.col("rows") / BLOCK).cast("int")
        dealt = rows.join(sizes.select("s", blocks.alias("blocks")), "s").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.select("s", "node", "label", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select("s", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "node", "label").join(sets, "node").select("s", "x", "y", "node", "label", "set")
        made = dealt.repartition("s", "x", "y").sortWithinPartitions("s", "x", "y").mapInArrow(_blocks, "a long, b long")
        self.links = staged(self.links.union(staged(made.distinct(), "similar")), "links")
        self._found = None

    def _verify(self, pairs: DataFrame, sets: DataFrame) -> None:
        made = _verified(pairs, sets)
        if self.links is None or made.limit(1).count():
            self.links = made if self.links is None else staged(self.links.union(made), "links")
            self._found = None

    def add(self, pairs: DataFrame) -> None:
        """Verifies as many of the pairs as it takes to connect what they connect: all of them if they are few
        beside the nodes; else of each node one pair (with its smallest partner) on either side, then one for
        each two classes that are apart, then what is left."""
        rest = _hopeful(pairs, self.nodes)
        sets = _sets(rest, self.docs, self.nodes)
        if self.repeats:
            sets = staged(sets.dropDuplicates(["node"]), "sets")
        for k in range(2):
            if SHARE * rest.count() <= self.size:
                break
            if k == 0:
                some = rest.groupBy("b").agg(F.min("a").alias("a")).select("a", "b").union(rest.groupBy("a").agg(F.min("b").alias("b"))).distinct()
            else:
                two = rest.groupBy(F.least("label_a", "label_b").alias("x"), F.greatest("label_a", "label_b").alias("y"))
                some = two.agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")
            self._verify(some, sets)
            rest = staged(_apart(rest.select("a", "b").join(some, ["a", "b"], "left_anti"), self.found), "rest")
        self._verify(rest.select("a", "b"), sets)


def similar_stars(nodes: np.ndarray, labels: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs of different labels with a similarity of at least 0.8 connect: shingles
    in common are counted for all pairs at once, by products of matrices of some shingles."""
    size = np.array([len(x) for x in sets], np.int64)
    _, which = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.repeat(np.arange(len(sets)), size)
    again = np.bincount(which)[which] > 1  # others are in one set only
    which, member = which[again], member[again]
    order = np.argsort(which, kind="stable")
    which, member = which[order], member[order]
    which = np.cumsum(np.append(0, which[1:] != which[:-1])) if len(which) else which
    both = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(which[-1]) + 1 if len(which) else 0, SHINGLES):
        a, b = np.searchsorted(which, [first, first + SHINGLES])
        part = np.zeros((len(sets), SHINGLES), np.float32)
        part[member[a:b], which[a:b] - first] = 1
        both += part @ part.T
    good = (9 * both.astype(np.int64) >= 4 * (size[:, None] + size)) & (labels[:, None] != labels)
    x, y = np.nonzero(np.triu(good, 1))
    if not len(x):
        return nodes[:0], nodes[:0]
    return simhash.stars(nodes[x], nodes[y])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (s, x, y, node, label, set) sorted by s, x and y: links inside each of their groups."""

    def made(held: list[tuple]) -> pa.RecordBatch:
        a, b = similar_stars(np.array([r[3] for r in held]), np.array([r[4] for r in held]), [np.frombuffer(r[5], np.uint64) for r in held])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    with task_memory():
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and row[:3] != held[-1][:3]:
                    yield made(held)
                    held = []
                held.append(row)
        if held:
            yield made(held)


def _possible(x: str, y: str) -> F.Column:
    n, m, left = f"{x}.n", f"{y}.n", f"LEAST({x}.n - {x}.at, {y}.n - {y}.at)"
    return F.expr(f"5 * LEAST({n}, {m}) >= 4 * GREATEST({n}, {m}) AND 9L * {left} >= 4L * ({n} + {m})")


def classes(docs: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """(doc_id, k1, k2, root) for each row of docs: rows of one root are connected by pairs of similarity
    >= 0.8.  Rows whose texts have no words are one class.  k1 and k2 are those of row_keys."""
    configure(docs.sparkSession)
    rows = staged(_rows(docs), "rows")
    repeats = rows.groupBy("k1", "k2").count().filter("count > 1").limit(1).count() > 0  # whole rows
    nodes = staged(rows.filter("n > 0").dropDuplicates(["node"]).drop("doc_id"), "nodes")
    entries = arrow_map(nodes.select("node", "n", "prefix"), _entries, "s long, node long, n int, at int")
    made = staged(entries.repartition("s").sortWithinPartitions("s", "n", "node").mapInArrow(_grouped(limit), "a long, b long, s long, n int, at int"), "possible")
    graph = _Links(docs, nodes, repeats)
    graph.add(staged(_light(nodes).union(made.filter("b IS NOT NULL").select("a", "b")).distinct(), "pairs"))
    large = made.filter("s IS NOT NULL").select("s", F.col("a").alias("node"), "n", "at")
    for k in range(ROUNDS + 1 if large.limit(1).count() else 0):
        labels = graph.found.select(F.col("node").alias("of"), "component")
        labelled = large.join(labels, large.node == labels.of, "left").select("s", "node", "n", "at", F.coalesce("component", "node").alias("label"))
        # The smallest set is the likeliest to be similar to others of the group; the rest are drawn.
        order = [F.xxhash64(F.lit(k * HUBS + i), "node") if i else F.col("n").cast("long") for i in range(HUBS)]
        hubs = [F.min(F.struct(order[i], "node", "n", "at", "label")).alias(f"hub{i}") for i in range(HUBS)]
        groups = staged(labelled.groupBy("s").agg(*hubs, F.count(F.lit(1)).alias("rows"), (F.min("label") < F.max("label")).alias("open")).filter("open"), "groups")
        each = groups.agg(F.sum(F.col("rows").cast("double") * F.col("rows")).alias("pairs"), F.sum("rows").alias("rows")).first()
        if not each["rows"]:
            break
        last = k == ROUNDS or each["pairs"] <= PARTNERS * each["rows"]
        large = staged(labelled.join(groups.select("s"), "s", "left_semi"), "open")
        if last:
            graph.compare(large.select("s", "node", "label"), groups.select("s", "rows"))
            break
        own = groups.select("s", F.explode(F.array(*[F.col(f"hub{i}").dropFields("col1") for i in range(HUBS)])).alias("hub")).select("s", "hub.node", "hub.n", "hub.at", "hub.label").distinct()
        x, y = large.alias("x"), own.alias("y")
        pairs = x.join(y, F.expr("x.s = y.s AND x.label <> y.label") & _possible("x", "y")).select(F.expr("LEAST(x.node, y.node)").alias("a"), F.expr("GREATEST(x.node, y.node)").alias("b")).distinct()
        graph.add(staged(pairs, "pairs"))
        large = large.drop("label")
    labels = graph.found.select(F.col("node").alias("of"), "component")
    return rows.join(labels, rows.node == labels.of, "left").select("doc_id", "k1", "k2", F.coalesce("component", "node").alias("root"))
