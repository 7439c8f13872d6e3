import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.fixtures import documents, empty, table
from tilewright.llm import simhash, suffix_dedup
from tilewright.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, ids, bits=3):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if bin(values[a] ^ values[b]).count("1") <= bits:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    smallest = {}
    for k, i in enumerate(ids):
        if i is not None:
            smallest[find(k)] = min(smallest.get(find(k), i), i)
    return [smallest.get(find(k)) for k in range(len(values))]


@pytest.mark.parametrize("limit", [512, 2])
def test_near_duplicates_against_brute_force(spark, limit):
    rows = documents(spark)
    fps = [plain_fingerprint(r[1]) for r in rows]
    want = Counter((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, classes(fps, [r[0] for r in rows])))
    got = Counter(tuple(r) for r in simhash.near_duplicates(table(spark), limit=limit).collect())
    assert got == want


@pytest.mark.parametrize("limit", [512, 3])
def test_links_of_close_families(spark, limit):
    rng = random.Random(limit)
    centre, values = rng.getrandbits(64), {rng.getrandbits(64) for _ in range(40)}
    for _ in range(150):  # many near one centre: their groups are large
        v = centre
        for _ in range(rng.randint(0, 5)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), 3, limit)
    roots = {r.node: r.component for r in components(links).collect()}
    want = classes(values, range(len(values)))
    got = [roots.get(s[0], s[0]) for s in signed]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))
    assert links.count() <= 64 * len(values)


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 40)] + [(1, 1), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 141)} == {100} and {got[k] for k in range(7, 40)} == {7} and 1 not in got


def test_no_documents(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert suffix_dedup.removal_digests(empty(spark)).count() == 0


def removed(texts, length):
    n = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if n[t[i : i + length]] > 1:
                mark[i] += 1
                mark[i + length] -= 1
        out.append(np.cumsum(mark)[:-1] > 0)
    return out


def test_index_against_brute_force():
    rng = random.Random(5)
    for k in range(60):
        letters = b"ab" if k % 2 else b"abcdef\x00\xff"
        base = bytes(rng.choice(letters) for _ in range(60))
        texts = {bytes(rng.choice(letters) for _ in range(rng.randint(1, 20))) + base[rng.randint(0, 40) :] * rng.randint(1, 2) for _ in range(rng.randint(1, 6))}
        texts = sorted(texts)
        for t, spans, want in zip(texts, suffix_dedup.repeated_parts(texts, 12), removed(texts, 12)):
            got = np.zeros(len(t), bool)
            for f, e in spans:
                got[f:e] = True
            assert (got == want).all()


def test_runs_are_fewer_than_places_in_repetitive_text():
    passage = bytes(random.Random(0).choice(b"abcdefgh") for _ in range(300))
    index = suffix_dedup.RunIndex([passage + bytes([k]) for k in range(20)])
    assert len(index.run_starts) < len(index.text) / 4


@pytest.mark.parametrize("length,anchor,group", [(400, 128, 1 << 20), (60, 16, 1 << 20), (60, 16, 500), (20, 8, 200)])
def test_removal_against_brute_force(spark, length, anchor, group):
    rows = documents(spark)
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for r, t, m in zip(rows, texts, removed(texts, length)):
        runs = int(m[0]) + int((m[1:] & ~m[:-1]).sum()) if len(m) else 0
        want[r[0], len(t), int(m.sum()), runs, hashlib.sha256(bytes(b for b, x in zip(t, m) if not x)).hexdigest()] += 1
    got = suffix_dedup.removal_digests(table(spark), length, anchor, group).drop("spans")
    assert Counter(tuple(r) for r in got.collect()) == want
    assert any(k[2] for k in want)


def test_texts_without_their_repeats(spark):
    rows = documents(spark)
    out = suffix_dedup.deduplicated(table(spark), 60)
    assert out.columns == table(spark).columns and out.count() == len(rows)
    for r in out.collect():
        assert r.text is None or r.n_chars == len(r.text)
    assert out.filter("text IS NULL").count() == 2


@pytest.mark.parametrize("group", [1 << 20, 3000, 400])
def test_a_passage_in_many_surroundings(spark, group):
    rng = random.Random(group)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [letters(35), letters(58), letters(90)]
    rows = [(k, letters(rng.randint(0, 30)) + passages[k % 3][rng.randint(0, 8) :] + letters(rng.randint(0, 30)) + (passages[1] if k % 7 == 0 else ""), "en", "src0", 0) for k in range(90)]
    texts = [r[1].encode() for r in rows]
    want = {r[0]: m for r, m in zip(rows, removed(texts, 40))}
    got = {r.doc_id: r.spans for r in suffix_dedup.removal_digests(table(spark, rows), 40, 8, group).collect()}
    assert len(got) == len(want) and sum(m.sum() for m in want.values()) > 1000
    for k, m in want.items():
        have = np.zeros(len(m), bool)
        for s in got[k]:
            have[s["f"] : s["t"]] = True
        assert (have == m).all()
