import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import documents, empty, table
from tilewright.llm import bpe, prefix_tokens, store
from tilewright.llm.library import LibraryEncoder
from tilewright.llm.pretokenize import distinct_pieces
from tilewright.llm.vocab import pieces_of, public_path

PATH = public_path()
ODD = ["a", "b", "'", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u3000", "é", "日本", "1", "2", "!", "<|endoftext|>", "<|end", "re", "'re", "'ll", "s", "😀", "\u200b", "\u0300", "\x00", "ß", "the", " the"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", [bpe.Encoder, LibraryEncoder])
def test_encoders_agree_with_the_library(library, kind):
    texts = odd_texts(400) + ["ab3x" * 3000, ""]
    made = kind(PATH)(texts)
    assert [list(memoryview(x).cast("I")) for x in made] == [ids(library, t) for t in texts]
    v = bpe.encoder(PATH).v
    assert [bpe.decode(v, x) for x in made] == [library.decode(ids(library, t), skip_special_tokens=False) for t in texts]


def test_cutting_in_arrays_is_the_pattern():
    texts = [*odd_texts(1500, 7), "", "a" * 200 + " " + "b" * 65, "it's we're  I'll 'd\n'twas ''s 'ss", " ", "x  ", "\n\n y"]
    pieces, which, cuts = distinct_pieces(texts)
    at = 0
    for t, end in zip(texts, cuts):
        assert [pieces[k] for k in which[at:end]] == pieces_of(t), repr(t)
        at = end
    assert distinct_pieces([])[0] == [] and distinct_pieces(["", ""])[2].tolist() == [0, 0]


class Counted:
    """A tokenizer that counts the bytes it is given."""

    def __init__(self, library):
        self.library, self.bytes = library, 0

    def __getattr__(self, name):
        def call(texts, **options):
            self.bytes += sum(len(t.encode()) for t in texts)
            return getattr(self.library, name)(texts, **options)

        return call


def test_library_sees_a_piece_once():
    """Also when there are more pieces than a memory of Python's objects would hold."""
    encoder, letters = LibraryEncoder(PATH), "abcdefghijklmnopqrstuvwxyz"
    text = "".join(" " + "".join(x) for x in itertools.islice(itertools.product(letters, repeat=4), 420_000))
    encoder.library = counted = Counted(encoder.library)
    first = encoder([text])
    assert counted.bytes == len(text)
    assert encoder([text, "", text[:50]]) == [first[0], b"", encoder([text[:50]])[0]] and counted.bytes == len(text)


def test_memory_that_is_emptied(library, monkeypatch):
    monkeypatch.setattr("tilewright.llm.library.ENTRIES", 300)
    encoder = LibraryEncoder(PATH)
    for seed in range(12):
        texts = odd_texts(60, seed) + ["x" * 17 + " " + "y" * 40 + "\0", "x" * 16 + "\0 \0\0", "\0" * 9, "\0" * 8, "<|endoftext|> a"]
        assert [list(memoryview(x).cast("I")) for x in encoder(texts)] == [ids(library, t) for t in texts]
        assert len(encoder.memory) <= 300


def test_pieces_of_one_hash(library, monkeypatch):
    """All pieces share four hashes: they are still told apart, in a batch and between batches."""
    monkeypatch.setattr("tilewright.llm.library.keys_of", lambda one, two, size: one & np.uint64(3))
    encoder = LibraryEncoder(PATH)
    for seed in (1, 2, 1):
        texts = odd_texts(100, seed) + ["x" * 17 + " " + "x" * 18]
        assert [list(memoryview(x).cast("I")) for x in encoder(texts)] == [ids(library, t) for t in texts]


def test_array_index_is_the_list_index():
    rng = random.Random(1)
    v = bpe.encoder(PATH).v
    pieces = list({"".join(rng.choice("aaabtheinor ") for _ in range(rng.randint(1, 20))).encode() for _ in range(3000)})
    assert bpe.encode_batch(v, pieces) == list(map(bpe.packed, bpe.encode_pieces(v, pieces)))


def test_counts_of_all_prefixes(library):
    counter = prefix_tokens.counter(PATH)
    for t in odd_texts(250, 2):
        table_, at = counter.table(t), 0
        for k, c in enumerate(t):
            at += len(c.encode())
            assert prefix_tokens.count_at(table_, at) == len(ids(library, t[: k + 1])), repr(t[: k + 1])


def test_budget_prefix(library):
    counter = prefix_tokens.counter(PATH)
    for t in odd_texts(60, 3):
        data, made = t.encode(), counter.table(t)
        n = prefix_tokens.budget_prefix(data, made, 3)
        fit = [k for k in range(len(t) + 1) if len(ids(library, t[:k])) <= 3]
        assert n == len(t[: max(fit)].encode())


def test_prefix_tables_of_a_table(spark, library):
    rows = documents(spark)
    got = prefix_tokens.prefix_tables(table(spark), PATH, 20).collect()
    want = sorted((-1 if d is None else d, len((t or "").encode()), len(ids(library, t))) for d, t, *_ in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(np.frombuffer(bytes(r.changes), np.int8).sum(dtype=int) == r.n_tokens and r.budget_bytes <= r.n_bytes for r in got)
    assert prefix_tokens.prefix_tables(empty(spark), PATH).count() == 0


def test_digests_and_decoding(spark, library):
    def key(d, t):
        i = ids(library, t)
        return (-1 if d is None else d, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(i, skip_special_tokens=False).encode()).hexdigest())

    got = bpe.digests(table(spark), PATH).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(key(d, t) for d, t, *_ in documents(spark))
    assert all(r.round_trip for r in got)
    back = bpe.decoded(bpe.encode(table(spark), PATH), PATH)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t, *_ in documents(spark))
    assert bpe.digests(empty(spark), PATH).count() == 0


def test_crc_of_joined_parts():
    a, b = b"some bytes", b"and others" * 999
    assert store.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert store.crc32_joined(0, zlib.crc32(a), len(a)) == zlib.crc32(a)


def test_cuts_follow_content():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 50000, 40000).astype(np.uint32)
    two = np.concatenate([rng.integers(0, 50000, 777).astype(np.uint32), one])
    parts = [{x[s:e].tobytes() for s, e in zip([0, *store.cuts(x)], store.cuts(x))} for x in (one, two)]
    assert len(parts[0] & parts[1]) > 0.8 * len(parts[0])
    assert all(store.cuts(x)[-1] == len(x) for x in (one, two, one[:5])) and store.cuts(one[:0]) == []
    flat = np.zeros(50000, np.uint32)
    assert max(np.diff([0, *store.cuts(flat)])) <= store.LONGEST


def stored(spark, tmp_path, df):
    path = f"file://{tmp_path}/store"
    store.write(df, path, PATH, 2)
    return path


def test_store_gives_back_every_id(spark, library, tmp_path):
    path = stored(spark, tmp_path, table(spark))
    rows = sorted(documents(spark), key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = [], 0
    for d, t, *_ in rows:
        i = ids(library, t) + [2]
        want.append((d, at, len(i), zlib.crc32(np.array(i, "<u4").tobytes())))
        at += len(i)
    got = [tuple(r) for r in store.read_checksums(spark, path).collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got.sort(key=order)
    assert [g for g in got if g[0] is not None] == [w for w in want if w[0] is not None]
    # Rows without an id come first, in the order of their content's hash.
    assert sorted((g[2], g[3]) for g in got if g[0] is None) == sorted((w[2], w[3]) for w in want if w[0] is None)
    back = {(r.doc_id, r.start): list(r.ids) for r in store.restore(spark, path).collect()}
    assert all(len(back[g[0], g[1]]) == g[2] and zlib.crc32(np.array(back[g[0], g[1]], "<u4").tobytes()) == g[3] for g in got)
    assert len(store.verify_manifest(spark, path)) == 64
    digests = [bytes(r.digest) for r in spark.read.parquet(f"{path}/chunks").collect()]
    assert len(digests) == len(set(digests))


def test_damage_is_noticed(spark, tmp_path):
    path = stored(spark, tmp_path, table(spark))
    chunks = spark.read.parquet(f"{path}/chunks").toPandas()
    chunks.loc[0, "payload"], chunks.loc[1, "payload"] = chunks.loc[1, "payload"], chunks.loc[0, "payload"]
    spark.createDataFrame(chunks, "digest binary, n int, width int, payload binary").write.mode("overwrite").parquet(f"{path}/chunks")
    with pytest.raises(Exception, match="damaged"):
        store.read_checksums(spark, path).collect()


def test_empty_store(spark, tmp_path):
    path = stored(spark, tmp_path, empty(spark))
    assert store.read_checksums(spark, path).count() == 0 and store.restore(spark, path).count() == 0
