"""BPE encoding and decoding by a pair occurrence index.

The distinct pieces that a batch needs are laid out in one symbol sequence.  An index maps each
mergeable pair to all its positions there; a heap holds the ranks of pairs that occur.  Ranks are
applied in ascending order, each to all its positions from left to right, and the lists of the pairs
beside the merged places are extended.  A merge makes only pairs of higher rank (a vocabulary in which a
merge could come before the one that makes its part is refused), so every rank is applied once.  Many pieces go through the same index in NumPy arrays, few through Python lists."""

from __future__ import annotations

import array
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tilewright.llm._common import AT_TASK_END, arrow_map, bytes_of, table, texts_of
from tilewright.llm.vocab import Vocabulary, pieces_of, public_path, vocabulary

#: Entries of a worker's memory of encoded pieces and their mean length at most (it is emptied when full).
MEMO_ENTRIES, MEMO_CHARS = 250_000, 48

#: Bytes of text that share a pair index.
GATHER = 8 << 20


def check_order(v: Vocabulary) -> None:
    made = {new: rank for rank, new in v.merges.values()}
    for (a, b), (rank, _) in v.merges.items():
        if made.get(a, -1) >= rank or made.get(b, -1) >= rank:
            raise ValueError("a merge comes before one that makes its part")


def encode_pieces(v: Vocabulary, pieces: list[bytes]) -> list[list[int]]:
    """ids of each piece."""
    symbols: list[int] = []
    starts = []
    for p in pieces:
        starts.append(len(symbols))
        symbols += map(v.single.__getitem__, p)
        symbols.append(-1)  # between pieces
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    index: dict[tuple[int, int], list[int]] = {}
    merges, active = v.merges, []
    for i, pair in enumerate(zip(symbols, symbols[1:])):
        if pair in index:
            index[pair].append(i)
        elif pair in merges:
            index[pair] = [i]
            active.append((merges[pair][0], pair))
    heapq.heapify(active)
    while active:
        _, pair = heapq.heappop(active)
        a, b = pair
        new = merges[pair][1]
        places = index.pop(pair)
        places.sort()
        for i in places:
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # an earlier merge took a part of it
            symbols[i], symbols[j] = new, -2  # -2: taken
            k = after[j]
            after[i] = k
            if k < n:
                before[k] = i
                if (p := (new, symbols[k])) in merges:
                    if p in index:
                        index[p].append(i)
                    else:
                        index[p] = [i]
                        heapq.heappush(active, (merges[p][0], p))
            h = before[i]
            if h >= 0 and (p := (symbols[h], new)) in merges:
                if p in index:
                    index[p].append(h)
                else:
                    index[p] = [h]
                    heapq.heappush(active, (merges[p][0], p))
    out = []
    for s in starts:
        ids, i = [], s
        while symbols[i] != -1:
            ids.append(symbols[i])
            i = after[i]
        out.append(ids)
    return out


class _Ranks:
    """Merges as arrays: rank of a pair of ids, and what each rank joins and makes."""

    def __init__(self, v: Vocabulary):
        by_rank = sorted((rank, a, b, new) for (a, b), (rank, new) in v.merges.items())
        self.size = v.size
        self.left, self.right, self.made = (np.array([m[k] for m in by_rank], np.int64) for k in (1, 2, 3))
        keys = self.left * v.size + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.single = np.array(v.single, np.int64)

    def of(self, a, b) -> np.ndarray:
        """Place in rank order of the pair, or -1; negative ids are no symbols."""
        key = np.where((a >= 0) & (b >= 0), a * self.size + b, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)


def encode_batch(v: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """Packed ids of each piece; what encode_pieces does, with lists of positions as arrays."""
    if len(pieces) < 500:
        return list(map(packed, encode_pieces(v, pieces)))
    ranks = v.__dict__.setdefault("ranks", None) or v.__dict__.__setitem__("ranks", _Ranks(v)) or v.ranks
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(lengths + 1)  # places of the separators; place 0 is one as well
    symbols = np.full(int(ends[-1]) + 1, -1, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[0] = False
    inside[ends] = False
    symbols[inside] = ranks.single[np.frombuffer(b"".join(pieces), np.uint8)]
    after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)
    found = ranks.of(symbols[:-1], symbols[1:])
    places = np.flatnonzero(found >= 0)
    places = places[np.argsort(found[places], kind="stable")]
    first, at = np.unique(found[places], return_index=True)
    index: dict[int, list[np.ndarray]] = {r: [p] for r, p in zip(first.tolist(), np.split(places, at[1:]))} if len(places) else {}
    active = sorted(index)
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        i = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        a, b, new = int(ranks.left[r]), int(ranks.right[r]), int(ranks.made[r])
        j = after[i]
        ok = (symbols[i] == a) & (symbols[j] == b)
        i, j = i[ok], j[ok]
        if a == b and len(i) > 1:  # in a run of equal symbols every second place, from its start
            starts = np.append(True, i[1:] != j[:-1])
            n = np.arange(len(i))
            even = (n - np.maximum.accumulate(np.where(starts, n, 0))) % 2 == 0
            i, j = i[even], j[even]
        if not len(i):
            continue
        symbols[i], symbols[j] = new, -2
        k = after[j]
        after[i] = k
        before[k] = i
        h = before[i]
        at = np.concatenate([h, i])
        got = ranks.of(symbols[at], np.concatenate([np.full(len(h), new), symbols[k]]))
        hit = np.flatnonzero(got >= 0)
        if not len(hit):
            continue
        at, got = at[hit], got[hit]
        if len(hit) > 1:
            by = np.argsort(got, kind="stable")
            at, got = at[by], got[by]
            cuts = np.flatnonzero(got[1:] != got[:-1]) + 1
            groups = zip(got[np.append(0, cuts)].tolist(), np.split(at, cuts))
        else:
            groups = [(int(got[0]), at)]
        for q, more in groups:
            if q in index:
                index[q].append(more)
            else:
                index[q] = [np.unique(more)]
                heapq.heappush(active, q)
    left = symbols != -2
    flat = symbols[left]
    marks = np.flatnonzero(flat == -1)
    whole = flat.astype(np.uint32).tobytes()
    return [whole[4 * s + 4 : 4 * e] for s, e in zip(marks[:-1].tolist(), marks[1:].tolist())]


def packed(ids) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return array.array("I", ids).tobytes()


class Encoder:
    """Encodes whole texts into packed ids.  Pieces met before are taken from a bounded memory; all
    new pieces of a batch go through one pair index.  Until then a text is held as the numbers of its
    pieces, four bytes each."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        check_order(self.v)
        self.most = MEMO_ENTRIES
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.chars = 0

    def encode_new(self, pieces: list[str]) -> list[bytes]:
        return encode_batch(self.v, [p.encode() for p in pieces])

    def __call__(self, texts: list[str]) -> list[bytes]:
        number, new, cut = self.number, [], []
        for t in texts:
            segments: list = []
            for k, s in enumerate(self.v.segments(t)):
                if k % 2:
                    segments.append(s)
                    continue
                pieces = pieces_of(s)
                fresh = list(set(pieces).difference(number))
                number.update(zip(fresh, range(len(number), len(number) + len(fresh))))
                new += fresh
                segments.append(array.array("I", map(number.__getitem__, pieces)))
            cut.append(segments)
        if new:
            self.ids += self.encode_new(new)
            self.chars += sum(map(len, new))
        ids = self.ids.__getitem__
        out = []
        for segments in cut:
            parts = [packed([self.v.specials[s]]) if k % 2 else b"".join(map(ids, s)) for k, s in enumerate(segments)]
            out.append(parts[0] if len(parts) == 1 else b"".join(parts))
        if len(number) > self.most or self.chars > self.most * MEMO_CHARS:
            self.clear()
        return out


def decode_bytes(v: Vocabulary, ids: bytes) -> bytes:
    """The bytes that packed ids stand for, special tokens included."""
    return b"".join(map(v.bytes_of.__getitem__, memoryview(ids).cast("I")))


def decode(v: Vocabulary, ids: bytes) -> str:
    """As the library: bytes that are no UTF-8 become replacement characters."""
    return decode_bytes(v, ids).decode("utf-8", "replace")


_encoders: dict[tuple[type, str], Encoder] = {}


def encoder(path: str, kind: type[Encoder] = Encoder) -> Encoder:
    """One for each worker process, so that its memory serves all batches of a task."""
    if (kind, path) not in _encoders:
        _encoders[kind, path] = kind(path)
    return _encoders[kind, path]


AT_TASK_END.append(lambda: [e.clear() for e in _encoders.values() if type(e) is Encoder] and None)


def encode(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, ids binary, n_tokens) of each row of docs; ids are packed little-endian unsigned 32-bit.
    Null texts count as empty; an empty text has no ids; repeated rows are each encoded; columns other
    than the two named are not read."""

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        ids = encoder(path)(texts_of(b.column(1)))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())], ["id", "ids", "n_tokens"])

    return arrow_map(docs.select(docs[id].cast("long").alias("id"), docs[text].alias("text")), kernel, "id long, ids binary, n_tokens long", GATHER).withColumnRenamed("id", id)


def decoded(rows: DataFrame, path: str, ids: str = "ids", id: str = "doc_id") -> DataFrame:
    """(id, text) from packed ids; null ids: empty text."""

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(path)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(v, x) for x in bytes_of(b.column(1))], pa.string())], ["id", "text"])

    return arrow_map(rows.select(rows[id].alias("id"), rows[ids].alias("ids")), kernel, "id long, text string").withColumnRenamed("id", id)


def digests(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, round_trip) of each row: encodes, hashes, decodes the
    ids and hashes what comes back, one row per input row.  round_trip: the decoded text is the text."""

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        enc, texts = encoder(path), texts_of(b.column(1))
        n, one, two, same = [], [], [], []
        for t, ids in zip(texts, enc(texts)):
            back = decode(enc.v, ids)
            n.append(len(ids) // 4)
            one.append(hashlib.sha256(ids).hexdigest())
            two.append(hashlib.sha256(back.encode()).hexdigest())
            same.append(back == t)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(one), pa.array(two), pa.array(same)], ["id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return arrow_map(docs.select(docs[id].cast("long").alias("id"), docs[text].alias("text")), kernel, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean", GATHER).withColumnRenamed("id", id)


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_path())
