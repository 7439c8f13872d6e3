"""Byte-level BPE vocabularies in the tokenizers library's JSON form, and the cutting of texts into
units that are tokenized independently of each other."""

from __future__ import annotations

import functools
import json
import re

import regex

#: The library's byte-level pre-tokenizer, and Unicode's White_Space characters.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"

WHITE_RUN = re.compile(f"[{WHITE}]*")
pieces_of = regex.compile(PIECE).findall

#: Pieces, but white space of two or more characters together with the piece after it: of such a run
#: the last character belongs to the next piece once that has begun, so prefixes that end in the run
#: are cut differently.  (With a space before it, an apostrophe begins no contraction.)
_AFTER = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+"
units_of = regex.compile(rf"\s+ (?:{_AFTER})|\s\s+\Z|\s+[^\S ](?:'s|'t|'re|'ve|'m|'ll|'d|{_AFTER})|{PIECE}").findall


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, n = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(n)
            n += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """ids: bytes -> id.  bytes_of[id].  merges: (id, id) -> (rank, id).  specials: text -> id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, of = made["model"], {c: b for b, c in enumerate(byte_letters())}
        if model["type"] != "BPE" or (made.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or made.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        if made["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("a vocabulary that adds a space is not supported")
        self.ids = {bytes(of[c] for c in t): i for t, i in model["vocab"].items()}
        self.specials = {a["content"]: a["id"] for a in made.get("added_tokens", [])}
        size = max([*self.ids.values(), *self.specials.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in self.ids.items():
            self.bytes_of[i] = t
        for t, i in self.specials.items():
            self.bytes_of[i] = t.encode()
        self.size = size
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (bytes(of[c] for c in t) for t in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merges.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        self.longest = max(map(len, self.ids))
        found = sorted(self.specials, key=len, reverse=True)
        self.special_split = re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None
        #: the first characters of the special strings, for a cheap test whether any can occur
        self.special_texts = found

    def segments(self, text: str) -> list[str]:
        """The text, cut at special strings; odd places hold these."""
        if self.special_split and any(s in text for s in self.special_texts):
            return self.special_split.split(text)
        return [text]


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
