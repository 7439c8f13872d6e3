"""Quality rules: exact counts with fixed limits, then a trained verdict.

The verdict comes from a logistic regression on hashed n-grams (bytes of the text two and four at a
time, words, word pairs; each kind as shares of its total), trained on a bounded sample of labelled
rows and calibrated on rows that training has not seen (Platt scaling).  One task of an executor trains
it; the driver gets the weights only, as its memory is the smaller one.  Texts are scored in Arrow batches: the
score of a text is a sum of means of table entries, so whole batches are handled as one byte array."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm._common import arrow_map, bytes_of, configure, staged, table, task_memory

#: Labelled ids that are used at most (those with the smallest hashes), bytes of their texts at most, the
#: share of them that calibrates, and bits of each kind's table.
LABELLED, LABELLED_BYTES, HELD_OUT, BITS = 2000, 16 << 20, 0.25, 15

#: Fixed limits: fewest words, most repeated words in per cent, least calibrated probability to be kept.
LEAST_WORDS, MOST_REPEATED, KEEP_FROM = 50, 50, 0.4

#: Bytes of text handled at once (arrays take about 60 times that).
AT_ONCE = 1 << 20

#: Features handled at once in training (arrays take about 40 bytes for each).
FEATURES = 1 << 20

KINDS = 4
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
#: Odd multipliers for hashing.
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64), dtype=np.uint64)


class Batch:
    """Texts of a batch as one byte array, with the places of their words."""

    def __init__(self, texts: list[bytes]):
        # A white byte after each text keeps words and lines apart.
        self.texts, self.n = texts, len(texts)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, self.n))
        self.starts = np.append(0, self.ends[:-1])
        white = _WHITE[self.data]
        before = np.append(True, white[:-1])
        self.white = white
        self.word_at = np.flatnonzero(~white & before)
        self.word_end = np.flatnonzero(white & ~before)
        self.word_text = np.searchsorted(self.ends, self.word_at, side="right")
        self.n_words = np.bincount(self.word_text, minlength=self.n)

    def counted(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have the flag."""
        total = np.append(0, np.cumsum(flags, dtype=np.int64))
        return total[self.ends - 1] - total[self.starts]

    def word_hashes(self) -> np.ndarray:
        if not len(self.word_at):
            return np.zeros(0, np.uint64)
        length = self.word_end - self.word_at
        place = np.arange(len(self.data)) - np.repeat(self.word_at, np.diff(np.append(self.word_at, len(self.data)))) if self.word_at[0] == 0 else None
        if place is None:
            place = np.arange(len(self.data))
            place[self.word_at[0] :] -= np.repeat(self.word_at, np.diff(np.append(self.word_at, len(self.data))))
        part = (self.data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 63]
        part[self.white] = 0
        sums = np.add.reduceat(part, self.word_at)
        return (sums ^ (sums >> np.uint64(29)) ^ length.astype(np.uint64)) * _A

    def grams(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(text, table place) of each n-gram, for each kind."""
        shift, out = np.uint64(64 - BITS), []
        pair = self.data[:-1].astype(np.uint64) | self.data[1:].astype(np.uint64) << np.uint64(8)
        four = pair[:-2] | pair[2:] << np.uint64(16)
        text_of = np.repeat(np.arange(self.n), self.ends - self.starts)
        for key, n in ((pair, 2), (four, 4)):
            inside = text_of[: len(key)] == text_of[n - 1 :][: len(key)]
            out.append((text_of[: len(key)][inside], (key[inside] * _A >> shift).astype(np.int64)))
        h = self.word_hashes()
        out.append((self.word_text, ((h * _B) >> shift).astype(np.int64)))
        same = self.word_text[:-1] == self.word_text[1:]
        out.append((self.word_text[:-1][same], ((h[:-1] * _A + h[1:] * _B)[same] * _B >> shift).astype(np.int64)))
        return out

    def repeated_words(self) -> list[int]:
        """Words of each text that stand in three-word windows which it holds twice or more."""
        h, t = self.word_hashes(), self.word_text
        out = [0] * self.n
        if len(h) < 4:
            return out
        key = (h[:-2] * _A + h[1:-1]) * _B + h[2:]
        inside = t[:-2] == t[2:]
        key = (key ^ (key >> np.uint64(31)) ^ t[:-2].astype(np.uint64)) * _A
        at = np.flatnonzero(inside)
        ordered = at[np.argsort(key[at], kind="stable")]
        again = key[ordered[1:]] == key[ordered[:-1]]
        for k in np.unique(t[ordered[1:][again]]).tolist():  # candidates: hashes may agree by chance
            out[k] = repeated_words(self.texts[k].split())
        return out


def repeated_words(words: list[bytes]) -> int:
    first: dict[tuple, int] = {}
    marked = bytearray(len(words))
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        j = first.setdefault(w, i)
        if j != i:
            marked[i : i + 3] = b"\1\1\1"
            marked[j : j + 3] = b"\1\1\1"
    return sum(marked)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier one."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


@dataclass
class Model:
    """weights: kinds x table places.  Calibrated probability: sigmoid(slope * score + offset)."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probabilities(self, batch: Batch) -> np.ndarray:
        score = np.full(batch.n, self.bias)
        for kind, (text, place) in enumerate(batch.grams()):
            n = np.bincount(text, minlength=batch.n)
            score += np.bincount(text, self.weights[kind][place], batch.n) / np.maximum(n, 1)
        return _sigmoid(self.slope * score + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _runs(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in runs of a bounded number of bytes; one empty run if there are none."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > AT_ONCE:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    yield run


def _features(b: pa.RecordBatch) -> pa.RecordBatch:
    """Hashed shares of each text as (place, value) lists; places of all kinds in one range."""
    places: list[np.ndarray] = []
    values: list[np.ndarray] = []
    for batch in map(Batch, _runs(bytes_of(b.column(1)))):
        own = [([], []) for _ in range(batch.n)]
        for kind, (text, place) in enumerate(batch.grams()):
            cut = np.searchsorted(text, np.arange(batch.n + 1))
            for k in range(batch.n):
                at, n = np.unique(place[cut[k] : cut[k + 1]], return_counts=True)
                own[k][0].append((at + (kind << BITS)).astype(np.int32))
                own[k][1].append((n / max(1, n.sum())).astype(np.float32))
        places += [np.concatenate(x) for x, _ in own]
        values += [np.concatenate(x) for _, x in own]
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], ["id", "places", "values"])


class Sample:
    """Features of texts as they came from Spark, eight bytes each, read in runs of whole texts."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.n, self.runs = 0, []
        for b in batches:
            lists = b.column("places")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            places, values = lists.flatten().to_numpy(), b.column("values").flatten().to_numpy()
            cuts = [*np.flatnonzero(np.diff(offsets[:-1] // FEATURES, prepend=-1)).tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                part = slice(offsets[s], offsets[e])
                self.runs.append((self.n + s, np.diff(offsets[s : e + 1]), places[part], values[part]))
            self.n += b.num_rows

    def text_sums(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """For each text the sum of its values times `of` their places."""
        out = np.zeros(self.n)
        for first, lengths, places, values in self.runs:
            rows = np.repeat(np.arange(len(lengths)), lengths)
            out[first : first + len(lengths)] = np.bincount(rows, of(places) * values, len(lengths))
        return out

    def place_sums(self, of_text: np.ndarray) -> np.ndarray:
        """For each place the sum of its values times what `of_text` has for their texts."""
        out = np.zeros(KINDS << BITS)
        for first, lengths, places, values in self.runs:
            out += np.bincount(places, np.repeat(of_text[first : first + len(lengths)], lengths) * values, len(out))
        return out


def regression(sample: Sample, label: np.ndarray, used: np.ndarray, rounds: int = 150, rate: float = 2.0, ridge: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on the texts that are used, by Adam on all of them."""
    size = KINDS << BITS
    w, m, v, bias = np.zeros(size), np.zeros(size), np.zeros(size), 0.0
    balance = np.where(label == 1, 0.5 / max(1, (label[used] == 1).sum()), 0.5 / max(1, (label[used] == 0).sum())) * used
    for k in range(1, rounds + 1):
        p = _sigmoid(sample.text_sums(lambda places: w[places]) + bias)
        gap = (p - label) * balance
        g = sample.place_sums(gap) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)
        bias -= 2.0 * gap.sum()
    return w, bias


def platt(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset for calibrated probabilities: Newton's method, with Platt's softened targets."""
    pos, neg = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, ab = np.stack([score, np.ones_like(score)], 1), np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ ab)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        ab -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(ab[0]), float(ab[1])


def train(docs: DataFrame, labels: DataFrame, limit: int = LABELLED, text: str = "text", id: str = "doc_id", label: str = "quality") -> Model | None:
    """A model from at most `limit` labelled rows, one for each id, with at most LABELLED_BYTES of text (in the
    order of a hash of their ids, texts that do not fit being left out); None where they do not show both
    classes.  Rows with a null id or a label other than 0 and 1 are not used; repeated labels of an id take
    the largest, repeated documents of an id the shortest text, null counting as empty."""
    drawn = labels.filter(labels[id].isNotNull() & labels[label].isin(0, 1)).groupBy(labels[id].cast("long").alias("id")).agg(F.max(label).alias("label"))
    drawn = staged(drawn.orderBy(F.xxhash64("id"), "id").limit(limit), "drawn")
    texts = docs.select(docs[id].cast("long").alias("id"), F.coalesce(docs[text], F.lit("")).alias("text")).join(F.broadcast(drawn.select("id")), "id")
    texts = staged(texts.groupBy("id").agg(F.min(F.struct(F.octet_length("text").alias("size"), "text")).alias("own")).select("id", "own.*"), "texts")
    room, taken = LABELLED_BYTES, []
    for r in texts.select("id", "size").orderBy(F.xxhash64("id"), "id").collect():  # at most `limit` rows
        if r["size"] <= room:
            room -= r["size"]
            taken.append(r["id"])
    labelled = {r["id"]: r["label"] for r in drawn.collect()}
    found = arrow_map(texts.filter(F.col("id").isin(taken)).select("id", "text"), _features, "id long, places array<int>, values array<float>")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_memory():
            model = fitted([b for b in batches if b.num_rows], labelled)
            if model:
                numbers = {"bias": model.bias, "slope": model.slope, "offset": model.offset}
                yield pa.RecordBatch.from_pylist([{"weights": model.weights.tobytes()} | numbers])

    # The order of rows that come is not fixed.
    one = found.repartition(1).sortWithinPartitions("id").mapInArrow(fit, "weights binary, bias double, slope double, offset double").collect()
    return Model(np.frombuffer(one[0]["weights"], np.float32).reshape(KINDS, -1), *one[0][1:]) if one else None


def fitted(batches: list[pa.RecordBatch], labelled: dict[int, int]) -> Model | None:
    """A model from the features (id, places, values) of labelled texts; None if they do not show both classes."""
    label = np.array([labelled[x] for b in batches for x in b.column("id").to_pylist()], np.int64)
    if len(set(label.tolist())) < 2:
        return None
    sample = Sample(batches)
    sums = sample.text_sums(lambda places: places % 9973)
    rank = np.argsort(np.argsort(sums, kind="stable"), kind="stable")
    held = rank % round(1 / HELD_OUT) == 0
    if len(set(label[held].tolist())) < 2 or len(set(label[~held].tolist())) < 2:
        held = np.zeros(len(label), bool)
    w, bias = regression(sample, label, ~held)
    score = sample.text_sums(lambda places: w[places]) + bias
    own = held if held.any() else ~held
    slope, offset = platt(score[own], label[own])
    return Model(w.reshape(KINDS, -1).astype(np.float32), float(bias), slope, offset)


def _measured(texts: list[bytes], model: Model | None, keep_from: float) -> dict[str, np.ndarray]:
    """Columns of the result, made for runs of texts of a bounded number of bytes."""
    made = [_measured_run(Batch(run), model, keep_from) for run in _runs(texts)]
    return {c: np.concatenate([m[c] for m in made]) for c in made[0]}


def _measured_run(batch: Batch, model: Model | None, keep_from: float) -> dict[str, np.ndarray]:
    first_bytes = (batch.data & 0xC0) != 0x80
    out = {
        "n_words": batch.n_words,
        "word_chars": batch.counted(first_bytes & ~batch.white),
        "n_symbols": batch.counted(_SYMBOL[batch.data]),
        "n_dup_lines": np.array([repeated_lines(t) for t in batch.texts], np.int64),
        "n_repeat_words": np.array(batch.repeated_words(), np.int64),
    }
    out["base_failed"] = (out["n_words"] < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED * out["n_words"])
    out["p_quality"] = model.probabilities(batch) if model else np.ones(batch.n)
    out["kept"] = ~out["base_failed"] & (out["p_quality"] >= keep_from)
    return out


def measure(docs: DataFrame, model: Model | None, text: str = "text", id: str = "doc_id", keep_from: float = KEEP_FROM) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, p_quality, kept)
    for each row of docs.  Null and empty texts have no words and fail; repeated rows are each
    measured; without a model (no labels of both classes) the limits alone decide; other columns are
    not read."""

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        made = _measured(bytes_of(b.column(1)), model, keep_from)
        return pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, made.values())], ["doc_id", *made])

    counts = ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    return arrow_map(docs.select(docs[id].cast("long").alias("doc_id"), docs[text].alias("text")), kernel, f"doc_id long, {counts}, base_failed boolean, p_quality double, kept boolean")


def kept_rows(docs: DataFrame, model: Model | None, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of docs, all columns as they are, whose text the rules keep."""
    at = docs.columns.index(text)

    def kernel(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.filter(pa.array(_measured(bytes_of(b.column(at)), model, keep_from)["kept"]))

    configure(docs.sparkSession)
    return arrow_map(docs, kernel, docs.schema)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return measure(docs, train(docs, table(spark, sf_dir, "labels")))
