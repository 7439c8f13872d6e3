"""Encoding with the tokenizers library, which sees a piece once until the memory of them is full."""

from __future__ import annotations

import itertools
import os

import numpy as np

from tilewright.llm.bpe import MEMO_CHARS, Encoder
from tilewright.llm.pretokenize import cut, distinct, keys_of, names

#: Pieces that are handed to the library as one text, and texts at once (its results are large).
RUN, TEXTS = 200, 50

#: Entries of a worker's memory: in arrays, of about 50 bytes each, and as Python's objects.
ENTRIES, OBJECTS = 1_500_000, 400_000


class Memory:
    """Ids of pieces met before, in arrays: entries in order of arrival, and their hashes sorted."""

    def __init__(self, narrow: bool):
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.named = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint8)]
        self.ends = np.zeros(1, np.int64)  # of each entry's ids, after a zero
        self.ids = np.zeros(0, np.uint16 if narrow else np.uint32)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray, named: list[np.ndarray]) -> np.ndarray:
        """The entry of each piece, or -1.  Of several entries with one hash only the first is found."""
        out = np.full(len(keys), -1, np.int64)
        if len(self.keys):
            order = np.argsort(keys)
            at = np.minimum(np.searchsorted(self.keys, keys[order]), len(self.keys) - 1)
            hit = self.keys[at] == keys[order]
            place, entry = order[hit], self.entry[at[hit]]
            same = np.logical_and.reduce([own[entry] == x[place] for own, x in zip(self.named, named)])
            out[place[same]] = entry[same]
        return out

    def add(self, keys: np.ndarray, named: list[np.ndarray], ids: np.ndarray, counts: np.ndarray) -> None:
        n, order = len(self.keys), np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.entry = np.insert(self.entry, at, order + n)
        self.named = [np.append(own, x) for own, x in zip(self.named, named)]
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(counts))
        self.ids = np.append(self.ids, ids.astype(self.ids.dtype))

    def joined(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these entries in a row, and where each one's end."""
        start = self.ends[entries]
        counts = self.ends[entries + 1] - start
        ends = np.cumsum(counts)
        places = np.repeat(start - (ends - counts), counts)
        places += np.arange(len(places))
        return self.ids[places].astype(np.uint32), ends


class LibraryEncoder(Encoder):
    """As Encoder, with the library's own encode_batch_fast for pieces that are new.  Pieces that begin with a
    space before a letter are what the library cuts them into again when they stand in a row, so they
    are joined into longer texts; the ids' bytes tell which of them belong to which piece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the machine already
        from tokenizers import Tokenizer

        super().__init__(path)
        self.most = OBJECTS
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = np.fromiter(map(len, self.v.bytes_of), np.int64, self.v.size)

    def clear(self) -> None:
        super().clear()
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.memory = Memory(self.v.size <= 1 << 16)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """As Encoder, with the pieces of all texts cut and told apart in arrays.  Texts with special strings
        go the other way, which knows them."""
        special = [any(x in t for x in self.v.special_texts) for t in texts]
        out = self.plain([t for t, s in zip(texts, special) if not s])
        if any(special):
            others, plain = iter(super().__call__([t for t, s in zip(texts, special) if s])), iter(out)
            out = [next(others) if s else next(plain) for s in special]
        if len(self.memory) > ENTRIES or len(self.long) > self.most or self.long_bytes > self.most * MEMO_CHARS:
            self.clear()
        return out

    def plain(self, texts: list[str]) -> list[bytes]:
        p, before = cut(texts), len(self.long)
        named = names(p, self.long)
        self.long_bytes += sum(map(len, itertools.islice(self.long, before, None)))
        keys = keys_of(*named)
        first, which = distinct(keys, *named)
        keys, named = keys[first], [x[first] for x in named]
        entries = self.memory.find(keys, named)
        fresh = np.flatnonzero(entries < 0)
        if len(fresh):
            entries[fresh] = np.arange(len(fresh)) + len(self.memory)
            self.memory.add(keys[fresh], [x[fresh] for x in named], *self.encoded([x.decode() for x in p.of(first[fresh])]))
        ids, ends = self.memory.joined(entries[which])
        data = ids.tobytes()
        stops = (4 * np.append(0, ends)[p.cuts]).tolist()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each one has."""
        words = [k for k, x in enumerate(pieces) if len(x) > 1 and x[0] == " " and x[1].isalpha()]
        order, made, counts = [], [], []
        rest = np.ones(len(pieces), bool)
        for at in range(0, len(words), RUN * TEXTS):
            some = words[at : at + RUN * TEXTS]
            own = [pieces[k] for k in some]
            ids = self.of_library(["".join(own[k : k + RUN]) for k in range(0, len(own), RUN)])[0]
            ends, wanted = np.cumsum(self.width[ids]), np.cumsum([len(x.encode()) for x in own])
            last = np.searchsorted(ends, wanted)
            if not len(ends) or ends[-1] != wanted[-1] or (ends[last] != wanted).any():
                continue  # the library cuts them otherwise: one by one
            order.append(some)
            made.append(ids)
            counts.append(np.diff(last, prepend=-1))
            rest[some] = False
        rest = np.flatnonzero(rest).tolist()
        for at in range(0, len(rest), RUN * TEXTS):
            some = rest[at : at + RUN * TEXTS]
            ids, n = self.of_library([pieces[k] for k in some])
            order.append(some)
            made.append(ids)
            counts.append(n)
        ids, n, order = np.concatenate(made), np.concatenate(counts), np.concatenate(order)
        back = np.argsort(order)
        start, n = (np.cumsum(n) - n)[back], n[back]
        places = np.repeat(start - (np.cumsum(n) - n), n)
        return ids[places + np.arange(len(places))], n

    def of_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(itertools.chain.from_iterable(each), np.uint32, int(n.sum())), n

    def encode_new(self, pieces: list[str]) -> list[bytes]:
        ids, n = self.encoded(pieces)
        data, ends = ids.tobytes(), (4 * np.cumsum(n)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]
