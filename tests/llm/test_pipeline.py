import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.fixtures import SCHEMA, words
from tests.llm.test_dedup import classes, plain_fingerprint, removed
from tests.llm.test_others import plain_measures
from tilewright.llm import near_copies
from tilewright.llm.queries import QUERIES
from tilewright.llm.vocab import public_path


def corpus(spark, tmp_path):
    rng = random.Random(11)
    passage = words(rng, 140)
    rows = [(i, words(rng, rng.randint(60, 160)), "en", f"src{i % 3}", 0) for i in range(80)]
    rows += [(100 + i, rows[i][1], "en", "src1", 0) for i in range(10)]  # copies
    rows += [(200 + i, words(rng, 30) + " " + passage + " " + words(rng, 30), "en", "src2", 0) for i in range(5)]
    rows += [(300 + i, " ".join(w + "###" for w in words(rng, 80).split()), "en", "src0", 0) for i in range(20)]
    rows += [(400, None, "en", None, None), (401, "short", "en", "src0", 5)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], int(not 300 <= r[0] < 320)) for r in rows if r[0] < 60 or 300 <= r[0] < 315]
    spark.createDataFrame(labels, "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(f"{tmp_path}/labels.parquet")
    return rows, str(tmp_path)


def without_passages(t, mark):
    """The text without the marked runs that hold 51 whole words."""
    spans = [m.span() for m in re.finditer(rb"[^ \t-\r]+", t)]
    mark, at = mark.copy(), np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]])))
    for f, e in zip(at[::2], at[1::2]):
        if sum(f <= a and b <= e for a, b in spans) < 51:
            mark[f:e] = False
    return bytes(b for b, x in zip(t, mark) if not x).decode("utf-8", "ignore")


def test_passages_of_over_fifty_words(spark):
    rng = random.Random(21)
    say = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(n))
    passages = [say(n) for n in range(51, 71)] + [say(45), say(40)]
    rows = [(k, f"{say(60)} {passages[k % 22]} {say(rng.randint(0, 60))}", "en", "src0", 0) for k in range(66)]
    rows += [(100, None, None, None, None), (100, "", "en", None, 0), (None, say(90), "en", "src0", 0), (None, say(90), "en", "src0", 0)]
    fifty = say(50)  # with parts of the words beside it, which do not count
    rows += [(200 + k, f"{say(30)}zz {fifty} zz{say(20)}", "en", "src0", 0) for k in range(3)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("__spans", F.lit(1)).withColumn("D", F.lit(2)).repartition(3)
    out = corpus_pipeline.repeated_passages(spark, docs, "")
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    data = [(r[1] or "").encode() for r in rows]
    want = Counter((r[0], None if r[1] is None else without_passages(t, m)) for r, t, m in zip(rows, data, removed(data, 192)))
    assert got == want
    kept = [t for _, t in got if t]
    assert not any(p in t for t in kept for p in passages[:20]) and sum(p in t for t in kept for p in passages[20:]) == 6
    assert sum(fifty in t for t in kept) == 3


def test_stages_without_loss_on_awkward_tables(spark, tmp_path):
    rng = random.Random(2)
    t = [words(rng, 90) for _ in range(11)]
    rows = [((50, 50, None, None, None)[k] if k < 5 else k, x, "en", "src0", 0) for k, x in enumerate(t)]
    for docs in (spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, t[0], "en", "src0", 0)] * 10, SCHEMA)):
        docs = docs.withColumn("id", F.lit(1)).withColumn("copies", F.lit(2)).withColumn("k1", F.lit(3)).withColumn("root", F.lit(4))
        kept = corpus_pipeline.near_duplicates(spark, docs, "")
        assert kept.columns == docs.columns and sorted(r.text for r in kept.collect()) == sorted(r.text for r in docs.distinct().collect())
        mixed = corpus_pipeline.mix(spark, docs, "")
        n = Counter(r.text for r in mixed.collect())
        assert mixed.columns == docs.columns and max(n.values()) <= 2 * docs.count()
        assert abs(sum(n.values()) - 1.5 * docs.count()) <= 1
    none = spark.createDataFrame([], SCHEMA)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, str(tmp_path))
        assert none.count() == 0


def test_stages_one_by_one(spark, tmp_path):
    rows, d = corpus(spark, tmp_path)
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        docs.write.parquet(f"{d}/out-{name}")
        docs = spark.read.parquet(f"{d}/out-{name}")
        seen.append(docs.toPandas())
    assert all(list(s.columns) == ["doc_id", "text", "lang", "source", "n_chars"] for s in seen[:-1])
    good = {r[0] for r in rows if not plain_measures(r[1])[5] and not 300 <= r[0] < 320}
    assert set(seen[0].doc_id) == good
    text = {r[0]: r[1] for r in rows}
    ids = sorted(good)
    firsts = {c for c in classes([plain_fingerprint(text[i]) for i in ids], ids)}
    assert sorted(seen[1].doc_id) == sorted(firsts) and not any(100 <= i < 110 for i in firsts)
    ids = sorted(firsts)
    data = [text[i].encode() for i in ids]
    want = {i: without_passages(t, m) for i, t, m in zip(ids, data, removed(data, 192))}
    assert dict(zip(seen[2].doc_id, seen[2].text)) == want and any(len(want[i]) < len(text[i]) for i in ids)
    copies = Counter(seen[3].doc_id)
    assert set(copies) <= set(want) and max(copies.values()) <= 2
    assert all(t == want[i] for i, t in zip(seen[3].doc_id, seen[3].text))
    size = {i: len(t.encode().split()) for i, t in want.items()}
    assert abs(sum(size[i] * n for i, n in copies.items()) - 1.5 * sum(size.values())) < 0.05 * sum(size.values())
    library = Tokenizer.from_file(public_path())
    for r in seen[4].itertuples():
        i = library.encode(want[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(i) and r.ids_sha256 == hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest() and r.round_trip
    assert Counter(seen[4].doc_id) == copies
    whole = corpus_pipeline.run(spark, d)
    assert Counter(tuple(r) for r in whole.collect()) == Counter(tuple(r) for r in docs.collect())


def test_each_operator_has_its_query():
    assert [q.split("_")[0] for q in sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 11)]


def edited(rng, text, every):
    """The text with about one word in `every` changed."""
    return " ".join(w if rng.randrange(every) else w + "x" for w in text.split())


def plain_set(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("limit", [256, 3])
def test_edited_copies_by_their_exact_similarity(spark, limit, monkeypatch):
    monkeypatch.setattr(near_copies.classes, "__defaults__", (limit,))
    rng, texts = random.Random(3), []
    for k in range(30):
        texts.append(words(rng, rng.randint(20, 200)))
        texts += [edited(rng, texts[-1], rng.choice([25, 50, 100])) for _ in range(rng.randint(0, 3) if k else 25)]
    line = words(rng, 12)
    texts += [line + " " + words(rng, 20) for _ in range(20)] + ["", "a b", "A  b"]
    sets = [plain_set(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    docs = spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root)) and len(set(root)) < len(texts) - 30
    fps = [plain_fingerprint(t) for t in texts]
    assert len(set(classes(fps, range(len(texts))))) > len(set(root))  # what SimHash within 3 bits leaves


def test_one_row_of_each_class_with_null_and_reused_ids(spark):
    rng = random.Random(8)
    t = [words(rng, 80) for _ in range(6)]
    rows = [(None, t[0], "en", "src0", 0), (None, t[1], "en", "src0", 0), (None, t[2], "en", None, 0), (None, t[2], "en", None, 0)]  # the last two are one row twice
    rows += [(7, t[3], "en", "src0", 0), (7, t[4], "en", "src0", 0), (7, t[4], None, "src1", 0), (9, t[5], "en", "src0", 0), (None, t[5], "en", "src0", 0), (8, t[5], "en", "src0", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = [sorted(map(repr, corpus_pipeline.near_duplicates(spark, docs.repartition(n), "").collect())) for n in (1, 4)]
    assert got[0] == got[1]
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(None, t[0]), (None, t[1]), (None, t[2]), (7, t[3]), (7, t[4]), (8, t[5])], key=repr)
    rows = [(None, t[0], "en", "src0", 0), (None, t[1], "en", "src0", 0), (7, t[2], "en", "src0", 0), (7, t[3], "en", "src0", 0), (7, t[3], "en", "src0", 0)]
    mixed = corpus_pipeline.mix(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    n = Counter((r.doc_id, r.text) for r in mixed)
    assert 6 <= len(mixed) <= 9 and all(k <= 2 * sum(r[:2] == x for r in rows) for x, k in n.items())


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_copies.classes, "__defaults__", (5,))
    monkeypatch.setattr(near_copies, "BLOCK", 8)
    rng = random.Random(17)
    core = words(rng, 60)
    texts = [f"{words(rng, rng.randint(0, 8))} {core} {words(rng, rng.randint(0, 8))}" for _ in range(60)] + [words(rng, 60) for _ in range(20)]
    sets = [plain_set(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and root[a] != root[b]:
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    docs = spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root)) and 22 < len(set(root)) < 75


def test_shingles_of_many_documents_are_found_in_large_tables(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "SAMPLE", 20)
    rng = random.Random(29)
    line = words(rng, 12)
    docs = spark.createDataFrame([(i, words(rng, 20) + (" " + line if i < 200 else "")) for i in range(2000)], "doc_id long, text string")
    found = set(near_copies._frequent(docs).tolist())
    assert found == set(near_copies.shingle_set(line.encode()).tolist())  # of 12 in 100 documents, however many there are
    monkeypatch.setattr(near_copies, "FREQUENT_MOST", 3)
    assert len(near_copies._frequent(docs)) <= 3
