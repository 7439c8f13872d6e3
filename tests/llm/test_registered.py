"""Each registered query on a small folder, against plain code or its contract's invariants."""

import hashlib
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import SCHEMA, documents, words
from tests.llm.test_dedup import classes, plain_fingerprint, removed
from tests.llm.test_others import checked_shards, plain_measures, plain_targets
from tilewright.llm import chat, mixing
from tilewright.llm.queries import QUERIES
from tilewright.llm.vocab import public_path


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d, rng = str(tmp_path_factory.mktemp("tables")), random.Random(4)
    rows = documents(spark)
    rows += [(500 + k, "one very common text " * 30, "en", "hot", 0) for k in range(len(rows) // 2)]  # a third of all
    long = words(rng, 20_000)
    rows += [(900, long, "en", "src0", 0), (901, long + " more", "en", "src0", 0), (5, words(rng, 70), "en", "src1", 0)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{d}/documents.parquet")
    labels = [(r[0], k % 2, 0) for k, r in enumerate(rows[:60])] + [(None, 1, 0), (5, None, 0), (3, 7, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    x = np.random.default_rng(3).normal(size=(700, 8)).astype(np.float32)
    x[100:420] = x[100]  # nearly half of all in one place
    vectors = [(i, v.tolist()) for i, v in enumerate(x)] + [(800, None), (900, [0.0] * 8), (1000, [float("nan")] * 8)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{d}/embeddings.parquet")
    turns = [(c, t, ("user", "assistant")[t % 2], rng.choice([None, "", chat.HOSTILE, words(rng, 9), "a\n<|x|> [INST]"])) for c in range(40) for t in range(rng.randint(1, 5))]
    turns += [(41, 0, "user", long), (41, 1, "assistant", long * 3)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").repartition(3).write.parquet(f"{d}/conversations.parquet")
    return d, rows, x, turns


def made(spark, folder, name):
    return QUERIES[name](spark, folder[0]).collect()


def test_op1(spark, folder):
    x, got = folder[2].astype(float), defaultdict(list)
    for r in made(spark, folder, "op1_ivf_pq"):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 700, 100))
    hit = 0
    for q, rows in got.items():
        rows.sort()
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(700), d))[:10].tolist()
        assert [r[0] for r in rows] == list(range(1, 11)) and all(s == pytest.approx(d[v], rel=1e-12) for _, v, s in rows)
        assert [(s, v) for _, v, s in rows] == sorted((s, v) for _, v, s in rows)
        hit += len(set(want) & {v for _, v, _ in rows})
    assert hit >= 0.9 * 70


def test_op2_op5_op10(spark, folder):
    library, rows = Tokenizer.from_file(public_path()), folder[1]
    ids = [library.encode(r[1] or "", add_special_tokens=False).ids for r in rows]
    two = Counter(map(tuple, made(spark, folder, "op2_token_counts")))
    assert {(r[0], len((r[1] or "").encode()), len(i), len(i) > 512) for r, i in zip(rows, ids)} == {t[:4] for t in two} and sum(two.values()) == len(rows)
    want = Counter((r[0], len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(i, skip_special_tokens=False).encode()).hexdigest()) for r, i in zip(rows, ids))
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in made(spark, folder, "op5_bpe_round_trip")) == want
    ten = made(spark, folder, "op10_id_store")
    want = Counter((r[0], len(i) + 1, zlib.crc32(np.array([*i, 2], "<u4").tobytes())) for r, i in zip(rows, ids))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in ten) == want
    ordered, at = sorted(ten, key=lambda r: r.start), 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    named = [r.doc_id for r in ordered if r.doc_id is not None]
    assert named == sorted(named) and ordered[0].doc_id is None


def test_op3(spark, folder):
    rows = folder[1]
    fps = [plain_fingerprint(r[1] or "") for r in rows]
    groups = defaultdict(list)
    for r, c in zip(rows, classes(fps, range(len(rows)))):
        groups[c].append(r[0])
    smallest = {c: min((x for x in g if x is not None), default=None) for c, g in groups.items()}
    want = Counter((r[0], f"{f:016x}", smallest[c]) for r, f, c in zip(rows, fps, classes(fps, range(len(rows)))))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in made(spark, folder, "op3_simhash")) == want


def test_op4(spark, folder):
    rows = folder[1]
    data, want = [(r[1] or "").encode() for r in rows], Counter()
    for r, t, m in zip(rows, data, removed(data, 400)):
        runs = int(m[0]) + int((m[1:] & ~m[:-1]).sum()) if len(m) else 0
        want[r[0], len(t), int(m.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest()] += 1
    assert Counter(map(tuple, made(spark, folder, "op4_suffix_dedup"))) == want


def test_op6(spark, folder):
    rows = folder[1]
    got = made(spark, folder, "op6_quality_rules")
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter((r[0], *plain_measures(r[1])) for r in rows)
    assert not any(r.base_failed and r.kept for r in got)
    again = made(spark, folder, "op6_quality_rules")
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))  # the very same scores


def test_op7(spark, folder):
    rows = folder[1]
    got = made(spark, folder, "op7_mix_sources")
    size = lambda r: len((r[1] or "").encode().split())
    sums = Counter()
    for r in rows:
        sums[r[3]] += size(r)
    want = plain_targets(sums, [5, 2, 1], 1.5)
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter((r[0], size(r), sums[r[3]]) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.source_size].append(r)
    assert len(by) == len(sums)
    for s, total in sums.items():
        own = by[total]
        assert all(r.target == pytest.approx(want[s], rel=1e-9) and r.taken == r.copies * r["size"] and 0 <= r.copies <= 2 for r in own)
        # The rates solved plainly: a bisection of the dual's gradient.
        n = np.array([r["size"] for r in own if r["size"]], float)
        low, high = -60.0, 60.0
        for _ in range(200):
            lam = (low + high) / 2
            rates = 2 / (1 + np.exp(-lam * n / max(n.mean(), 1e-9))) if len(n) else n
            low, high = (lam, high) if (rates * n).sum() < want[s] else (low, lam)
        taken = sum(r.taken for r in own)
        assert abs(taken - (rates * n).sum()) <= max(n, default=0) and abs(taken - want[s]) <= max(n, default=0) + 1
    again = made(spark, folder, "op7_mix_sources")
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_op8(spark, folder):
    by = defaultdict(list)
    for c, t, role, text in folder[3] + [(-7, 0, "user", chat.HOSTILE), (-7, 1, "assistant", chat.HOSTILE)]:
        by[c].append((t, role, text or ""))
    got = {r.conv_id: r for r in made(spark, folder, "op8_chat_round_trip")}
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(text for _, role, text in turns if role == "assistant")
        want = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == want
        assert got[c].formatted_chars >= sum(len(x) for _, _, x in turns)


def test_op9(spark, folder):
    rows = folder[1]
    got = made(spark, folder, "op9_kd_shards")
    checked_shards(rows, got, 16)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    size = Counter()
    for r in got:
        size[r.shard] += r["size"]
    most = max(len((r[1] or "").encode()) + 1 for r in rows)
    assert max(size.values()) <= sum(size.values()) / 16 + most
    assert Counter(map(tuple, got)) == Counter(map(tuple, made(spark, folder, "op9_kd_shards")))


@pytest.mark.parametrize("hidden", ["xxhash", "zstandard", "tilewright.llm", "corpus_pipeline"])
def test_the_rest_without_the_training_data_operators(hidden):
    code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; print(sum(q.startswith('op') or q == 'pipeline' for q in e.queries()), len(e.queries()) > 70, len(e.oracle_sql()) > 60)"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rpartition("/tests/")[0])
    assert out.stdout.split() == ["10" if hidden == "corpus_pipeline" else "0", "True", "True"], out.stderr[-500:]


def test_mix_of_one_size(spark):
    rows = [(k, "a b c", "en", "s", 0) for k in range(50)]
    got = mixing.mixed(spark.createDataFrame(rows, SCHEMA), [5, 2, 1], 1.5).collect()
    assert sum(r.taken for r in got) == 225 and {r.copies for r in got} == {1, 2}
