"""Exact token counts of every prefix of a text.

For a piece, dynamic programming over its byte positions finds the last token of the encoding of
every prefix: a token sequence is the encoding of its bytes if and only if every two neighbours in it
encode to themselves, so the last token at position i is the one token t that ends there for which
(last token at i - len(t), t) encodes to itself.  count[i] = count[i - len(t)] + 1.

A text's table holds, for each byte, by how much the count changes there (one signed byte each).
Its running sum answers how many tokens any prefix has and where a token budget is used up, without
encoding again.  At places inside of a character the table counts the bytes of the piece so far."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tilewright.llm._common import arrow_map, table, texts_of
from tilewright.llm.bpe import GATHER, MEMO_CHARS, check_order, encode_pieces
from tilewright.llm.vocab import WHITE_RUN, Vocabulary, pieces_of, public_path, units_of, vocabulary

#: Entries of a worker's memories of neighbouring tokens and of units; they are emptied when full.
PAIR_ENTRIES, UNIT_ENTRIES = 500_000, 800_000

#: Contractions of three characters: their first two characters alone are two pieces.
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter:
    def __init__(self, path: str):
        self.v: Vocabulary = vocabulary(path)
        check_order(self.v)
        #: whether two tokens, as first * size + second, are the encoding of their bytes
        self.fits: dict[int, bool] = {}
        #: lengths over one of the tokens that end in given two or three bytes, longest first
        lengths: dict[bytes, set[int]] = {}
        for t in self.v.ids:
            if len(t) > 2:
                lengths.setdefault(t[-3:], {2} if t[-2:] in self.v.ids else set()).add(len(t))
        self.lengths = {k: tuple(sorted(x, reverse=True)) for k, x in lengths.items()} | {t: (2,) for t in self.v.ids if len(t) == 2}
        self.units: dict[str, bytes] = {}

    def pair_fits(self, a: int, b: int) -> bool:
        """Whether the tokens a, b are the encoding of their bytes (a < 0: b alone)."""
        if len(self.fits) > PAIR_ENTRIES:
            self.fits.clear()
        ids = [b] if a < 0 else [a, b]
        found = self.fits[a * self.v.size + b] = encode_pieces(self.v, [b"".join([self.v.bytes_of[i] for i in ids])])[0] == ids
        return found

    def piece(self, text: str) -> list[int]:
        """counts[j]: tokens of the first j + 1 bytes of one piece."""
        last, count = [-1], [0]
        self._extend(text.encode(), last, count)
        return count[1:]

    def _extend(self, data: bytes, last: list[int], count: list[int]) -> None:
        """Goes on with the last tokens and counts of prefixes that are known up to some place."""
        token, single, size = self.v.ids.get, self.v.single, self.v.size
        fits, lengths = self.fits.get, self.lengths.get
        for i in range(len(last), len(data) + 1):
            for n in lengths(data[i - 3 : i]) or lengths(data[i - 2 : i], ()) if i > 2 else lengths(data[:i], ()):
                if n <= i and (t := token(data[i - n : i])) is not None:
                    at = last[i - n] * size + t
                    if fits(at) or at not in self.fits and self.pair_fits(last[i - n], t):
                        last.append(t)
                        count.append(count[i - n] + 1)
                        break
            else:
                last.append(single[data[i - 1]])
                count.append(count[i - 1] + 1)

    def learn(self, units: set[str]) -> None:
        """Adds units to the memory.  Pieces are taken in order, and each goes on from the prefix that it
        shares with the one before it."""
        plain = []
        for u in units:
            if len(u) > 1 and u[:2].isspace() or u in LONG_CONTRACTIONS:
                self.units[u] = _changes([0, *self.unit_counts(u)])
            else:
                plain.append((u.encode(), u))
        plain.sort()
        before, last, count = b"", [-1], [0]
        for data, u in plain:
            k, most = 0, min(len(before), len(data))
            while k < most and before[k] == data[k]:
                k += 1
            del last[k + 1 :], count[k + 1 :]
            self._extend(data, last, count)
            self.units[u] = _changes(count)
            before = data

    def unit_counts(self, unit: str) -> list[int]:
        """counts[j]: tokens of the first j + 1 bytes of a unit as a text of its own."""
        white = WHITE_RUN.match(unit).group()
        counts = list(self.piece(white)) if white else []  # a prefix that ends in white space: the whole run is a piece
        base = at = 0
        for p in pieces_of(unit):
            of = self.piece(p)
            if p in LONG_CONTRACTIONS:
                of = [of[0], self.piece(p[0])[-1] + self.piece(p[1])[-1], of[2]]
            counts += [base + c for c in of[max(0, len(counts) - at) :]]
            base, at = base + of[-1], at + len(of)
        return counts

    def total(self, text: str) -> int:
        return sum(self.piece(p)[-1] for p in pieces_of(text))

    def tables(self, texts: list[str]) -> list[bytes]:
        """Changes of the count at all bytes of each text."""
        cut = [[units_of(s) if k % 2 == 0 else s for k, s in enumerate(self.v.segments(t))] for t in texts]
        new: set[str] = set()
        for segments in cut:
            for units in segments[::2]:
                new.update(units)
        new.difference_update(self.units)
        if len(self.units) + len(new) > UNIT_ENTRIES:
            self.units.clear()
            new = {u for segments in cut for units in segments[::2] for u in units}
        self.learn(new)
        known = self.units.__getitem__
        out = [b"".join(map(known, s[0])) if len(s) == 1 else self._with_specials(s) for s in cut]
        for u in new:
            if len(u) > MEMO_CHARS:
                del self.units[u]
        return out

    def table(self, text: str) -> bytes:
        return self.tables([text])[0]

    def _with_specials(self, segments: list) -> bytes:
        out, tail = [], ""
        for k, s in enumerate(segments):
            if k % 2 == 0:
                out += map(self.units.__getitem__, s)
                tail = s[-1] if s else ""
            else:  # a special token: its proper prefixes are ordinary text that continues the last unit
                base = self.total(tail)
                counts = [base]
                for n in range(1, len(s)):
                    counts += [self.total(tail + s[:n])] * len(s[n - 1].encode())
                counts += [base + 1] * len(s[-1].encode())
                out.append(_changes(counts))
                tail = ""
        return b"".join(out)


def _changes(counts: list[int]) -> bytes:
    return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])


def count_at(changes: bytes, n_bytes: int) -> int:
    """Tokens of the first n_bytes bytes."""
    return int(np.frombuffer(changes, np.int8, n_bytes).sum(dtype=np.int64))


def budget_prefix(data: bytes, changes: bytes, budget: int) -> int:
    """Bytes of the longest prefix of whole characters with at most `budget` tokens."""
    counts = np.cumsum(np.frombuffer(changes, np.int8), dtype=np.int64)
    if not len(counts) or counts[-1] <= budget:
        return len(data)
    after = np.frombuffer(data, np.uint8)[1:]
    whole = np.append((after & 0xC0) != 0x80, True)  # the next byte starts a character
    found = np.flatnonzero((counts <= budget) & whole)
    return int(found[-1]) + 1 if len(found) else 0


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def prefix_tables(docs: DataFrame, path: str, budget: int = 512, text: str = "text", id: str = "doc_id", changes: bool = True) -> DataFrame:
    """(id, n_bytes, n_tokens, budget_bytes, changes binary) of each row: whole UTF-8 length and tokens,
    bytes of the longest prefix within the budget, and the prefix table (left out if not changes).
    Null and empty texts: 0, 0, 0, empty table; repeated rows are each counted; other columns are not
    read.  Special strings inside texts count as the library's default does: as their one token."""

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        c = counter(path)
        n_bytes, n_tokens, fit, tables = [], [], [], []
        texts = texts_of(b.column(1))
        for t, made in zip(texts, c.tables(texts)):
            data = t.encode()
            n = count_at(made, len(data))
            n_bytes.append(len(data))
            n_tokens.append(n)
            fit.append(len(data) if n <= budget else budget_prefix(data, made, budget))
            if changes:
                tables.append(made)
        cols = [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(fit, pa.int64())]
        names = ["id", "n_bytes", "n_tokens", "budget_bytes"]
        return pa.RecordBatch.from_arrays(cols + [pa.array(tables, pa.binary())] * changes, names + ["changes"] * changes)

    schema = "id long, n_bytes long, n_tokens long, budget_bytes long" + ", changes binary" * changes
    return arrow_map(docs.select(docs[id].cast("long").alias("id"), docs[text].alias("text")), kernel, schema, GATHER).withColumnRenamed("id", id)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = prefix_tables(table(spark, sf_dir, "documents"), public_path(), 512, changes=False)
    return made.select("doc_id", "n_bytes", "n_tokens", (made.n_tokens > 512).alias("over_limit"), "budget_bytes")
