import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, empty, table, words
from tilewright.llm import ann, chat, kdtree, mixing, quality
from tilewright.llm._common import numbered, word_count


def test_word_count(spark):
    texts = [None, "", " ", "a", " a  b\t\nc\u3000d ", "x" * 100, "\x0b\x0c a\r"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t"))).collect()]
    assert got == [len((t or "").encode().split()) for t in texts]


def test_numbers_are_gapless(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    got = numbered(df, ["k"], ["v"], rows=50).collect()
    for k in range(3):
        mine = sorted(r.rn for r in got if r.k == k)
        assert mine == list(range(len(mine)))


# Nearest neighbours


def vectors(spark, n=600, dims=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x[1:40] = x[0]  # many copies
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)]
    bad = [(n, None), (n + 1, [0.0] * dims), (n + 2, [float("nan")] * dims), (n + 3, [float("inf")] + [1.0] * (dims - 1)), (n + 4, [None] * dims), (n + 5, [1.0, 2.0]), (None, [1.0] * dims), (n + 6, [])]
    rows += bad + [(7, rows[7][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).repartition(3), x


def test_search_is_exact_when_all_lists_are_probed(spark):
    df, x = vectors(spark)
    got = defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 50 == 0, wanted=1.1, rerank=700).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i in range(600) if i % 50 == 0}
    x = x.astype(float)
    for q, rows in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(600), d))[:10]
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11)) and [r[1] for r in rows] == want.tolist()
        assert np.allclose([r[2] for r in rows], d[want], rtol=1e-12)


def test_recall_with_lists_and_codes(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16)) * 4
    x = (centres[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    hit = total = 0
    x = x.astype(float)
    for q, found in df_groups(ann.search(df, F.col("vec_id") % 100 == 0)).items():
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(set(np.argsort(d)[:10].tolist()) & found)
        total += 10
    assert total == 600 and hit / total >= 0.9


def df_groups(df):
    out = defaultdict(set)
    for r in df.collect():
        out[r.query_id].add(r.vec_id)
    return out


def test_few_vectors(spark):
    one = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert ann.search(one([]), F.lit(True)).count() == 0
    assert ann.search(one([(0, [1.0, 2.0])]), F.lit(True)).count() == 0
    assert ann.search(one([(0, [1.0, 2.0]), (1, [1.0, 3.0]), (2, [5.0, 3.0])]), F.col("vec_id") == 0).count() == 2


# Quality


def plain_measures(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    at = defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k : k + 3])].append(k)
    repeated = {j for v in at.values() if len(v) > 1 for k in v for j in (k, k + 1, k + 2)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    fails = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(repeated), fails


def test_measures_against_brute_force(spark):
    rows = documents(spark) + [(900, "a b c\n" * 40 + "# * <x>", "en", "s", 0), (901, "one line\n\none line\n one line\n" * 3, "en", "s", 0)]
    got = quality.measure(table(spark, rows), None)
    want = Counter((r[0], *plain_measures(r[1])) for r in rows)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()) == want
    assert got.filter("kept = base_failed").count() == 0  # without a model the limits decide
    assert quality.measure(empty(spark), None).count() == 0
    kept = quality.kept_rows(table(spark, rows), None)
    assert kept.columns == table(spark).columns and kept.count() == sum(not plain_measures(r[1])[5] for r in rows)


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        good = i % 2
        text = words(rng, 80) if good else " ".join(w + rng.choice(["###", "$$$", "!!"]) for w in words(rng, 80).split())
        rows.append((i, text, "en", "s", 0))
        labels.append((i, good if i < 200 else None))
    labels += [(None, 1), (1, 1), (5, 7)]
    docs, lab = table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, lab, limit=150)
    got = {r.doc_id: r for r in quality.measure(docs, model).collect()}
    right = [got[i].kept == bool(i % 2) for i in range(200, 400) if not got[i].base_failed]
    assert sum(right) / len(right) > 0.97
    p = np.array([got[i].p_quality for i in range(200, 400)])
    assert ((p > 0) & (p < 1)).all()
    assert quality.train(docs, lab.filter("quality = 1")) is None and quality.train(docs, lab.limit(0)) is None


def test_training_leaves_the_driver_alone(spark):
    """Features of the sample (here over 10 MB at eight bytes each) stay on the executors."""
    rng = random.Random(4)
    docs = table(spark, [(i, words(rng, 1000), "en", "s", 0) for i in range(300)])
    lab = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    tracemalloc.start()
    model = quality.train(docs, lab)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model is not None and most < 8 << 20


def test_features_in_runs(monkeypatch):
    """Sums of a sample do not depend on how its texts are cut into batches and runs."""
    rng = random.Random(5)
    texts = [words(rng, rng.randint(0, 90)).encode() for _ in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 20), pa.int64()), pa.array(texts[i : i + 20], pa.binary())], ["id", "text"]) for i in (0, 20, 40)]
    whole = quality._features(pa.Table.from_batches(batches).combine_chunks().to_batches()[0])
    monkeypatch.setattr(quality, "AT_ONCE", 700)
    cut = [quality._features(b) for b in batches]
    assert [r for b in cut for r in b.to_pylist()] == whole.to_pylist()
    monkeypatch.setattr(quality, "FEATURES", 500)
    one, many = quality.Sample([whole.slice(0, 60)]), quality.Sample([whole.slice(0, 7), *(b.slice(k, 1) for b in [whole] for k in range(7, 60))])
    assert len(one.runs) > 5 and one.n == many.n == 60
    want = [sum(v * (p % 13) for p, v in zip(r["places"], r["values"])) for r in whole.to_pylist()]
    for sample in (one, many):
        assert np.allclose(sample.text_sums(lambda places: places % 13), want)
        assert np.allclose(sample.place_sums(np.arange(60.0)), one.place_sums(np.arange(60.0)))

# Mixing


def plain_targets(sizes, weights, share):
    """Reshares the excess by weight until no source is above twice its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, total, out = set(names), share * sum(sizes.values()), {}
    while left:
        unit = total / sum(weight[s] for s in left)
        full = {s for s in left if unit * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: unit * weight[s] for s in left}
        for s in full:
            out[s] = 2.0 * sizes[s]
            total -= out[s]
        left -= full
    return out


def test_mix_meets_its_targets(spark):
    rows = documents(spark, n=200)
    got = mixing.mixed(table(spark, rows), [5, 2, 1], 1.5)
    first = got.collect()
    assert sorted(map(str, first)) == sorted(map(str, mixing.mixed(table(spark, rows).repartition(7), [5, 2, 1], 1.5).collect()))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    want = plain_targets(sizes, [5, 2, 1], 1.5)
    assert len(first) == len(rows)
    by_target = defaultdict(lambda: [0, 0])
    for r in first:
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        by_target[r.source_size, round(r.target, 6)][0] += r.taken
    assert {k[1] for k in by_target} == {round(v, 6) for v in want.values()}
    for (size, target), (taken, _) in by_target.items():
        if target:
            assert abs(taken - target) <= max(2, 0.02 * target), (size, target, taken)


def test_rates_fall_or_rise_with_size(spark):
    rows = [(i, "w " * (1 + i % 50), "en", "a" if i % 3 else "b", 0) for i in range(3000)]
    got = mixing.mixed(table(spark, rows), [5, 1], 1.2).collect()
    mean = lambda lo, hi: np.mean([r.copies for r in got if lo <= r["size"] < hi and r.target < 1.9 * r.source_size and r.target < r.source_size])
    if any(r.target < r.source_size for r in got):
        assert mean(1, 10) > mean(40, 51)  # a source that gives less than it has gives up long documents first


def test_mix_of_nothing(spark):
    assert mixing.mixed(empty(spark), [5, 2, 1], 1.5).count() == 0
    blank = mixing.mixed(table(spark, [(1, None, "en", None, 0), (2, "", "en", "a", 0)]), [5, 2, 1], 1.5).collect()
    assert [r.taken for r in blank] == [0, 0]


# Shards


def checked_shards(rows, got, shards):
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((x[0], len((x[1] or "").encode()) + 1, zlib.crc32((x[1] or "").encode())) for x in rows)
    slots = defaultdict(list)
    for r in got:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_near_equal(spark):
    rng = random.Random(9)
    rows = [(i, words(rng, rng.randint(5, 60)), rng.choice(["en", "de", None]), f"src{rng.randint(0, 5)}", 0) for i in range(1500)]
    got = kdtree.sharded(table(spark, rows), 16).collect()
    checked_shards(rows, got, 16)
    size = Counter()
    for r in got:
        size[r.shard] += r["size"]
    assert max(size.values()) < 1.12 * sum(size.values()) / 16
    again = kdtree.sharded(table(spark, rows).repartition(5), 16).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_a_heavy_group_of_copies_is_cut(spark):
    rng = random.Random(10)
    rows = [(i, "the same text " * 5 if i % 2 else words(rng, 12), "en", "s", 0) for i in range(800)]
    got = kdtree.sharded(table(spark, rows), 16).collect()
    checked_shards(rows, got, 16)
    size = Counter()
    for r in got:
        size[r.shard] += r["size"]
    assert len(size) == 16 and max(size.values()) < 1.25 * sum(size.values()) / 16


def test_odd_rows_are_sharded(spark):
    checked_shards(documents(spark), kdtree.sharded(table(spark), 4).collect(), 4)
    assert kdtree.sharded(empty(spark), 16).count() == 0
    one = kdtree.sharded(table(spark, [(1, None, None, None, None)]), 16).collect()
    assert [(r["size"], r.text_crc32, r.slot) for r in one] == [(1, 0, 0)]


# Chat


def test_every_text_reads_back():
    rng = random.Random(4)
    parts = [*chat.CONTROL, "\\", "\\\\", "a", " ", "\n", "<", "<|", "|>", "=", "!", "<|tu", "rn|>", "é", "[", "INST]", chat.HOSTILE]
    for k in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 7)))
        role = "".join(rng.choice(parts) for _ in range(rng.randint(0, 2))) if k % 4 == 0 else "user"
        made = chat.render(role, text) + chat.render("assistant", text)
        turns = list(chat.parse(made))
        assert [t[:2] for t in turns] == [(role, text), ("assistant", text)]
        assert chat.unescape_all(chat.escape_all(text)) == text
        bare = "|".join(map(re.escape, chat.CONTROL))
        assert not re.search(rf"(?<!\\)(?:{bare})", made[turns[1][2] : turns[1][3]])
    with pytest.raises(ValueError):
        list(chat.parse("<|turn|>user=<|text|>never ends"))


def test_plain_text_is_not_changed():
    assert "C:\\dir\\x <b>" in chat.render("user", "C:\\dir\\x <b>")


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo <|end|>"), (1, 2, "assistant", None), (2, 1, "assistant", ""), (2, 0, "system", "x\\"), (None, 0, "user", "q"), (3, None, None, "r"), (3, 0, "assistant", "é"), (4, 0, "user", "t"), (4, 0, "user", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash")).repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.formatted_turns(df)).collect()}
    for conv in (1, 2, None, 3, 4):
        own = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda v: v[0])
        g = got[conv]
        said = "".join(x for _, r, x in own if r == "assistant")
        assert (g.n_turns, g.turns_sha256) == (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat.read_back(chat.formatted_turns(df.limit(0))).count() == 0


def test_escapes_are_exact_inverses():
    for t in ("\\", "\\\\", "a\\<|end|>", "\\\\<s>", "</s>\\"):
        assert chat.unescape(chat.escape(t)) == t


def test_sample_of_vectors_is_bounded_by_a_hash(spark):
    rng = np.random.default_rng(7)
    x = rng.random((2000, 8))
    rows = [(k, v) for k, v in enumerate(x.tolist())] + [(0, x[0].tolist())] * 1000
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    good = ann.usable(df, "embedding", "vec_id")
    n, drawn = ann._drawn(good, 50)
    assert n == 3000 and len(drawn) == 50 == len({v.tobytes() for v in drawn})
    again = ann._drawn(good.repartition(2), 50)[1]
    assert all((a == b).all() for a, b in zip(drawn, again))
    assert len(ann._drawn(good, 5000)[1]) == 2000
    plan = ann.search(df, F.col("vec_id") % 100 == 0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
