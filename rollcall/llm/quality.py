"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned
filters over ``WIDTH`` bytes (a table row for each byte value and place in the
window) run over a chunk; the largest response of each filter is its feature. The
features of all chunks are averaged and one logistic unit gives the probability of
label 1.

Learning takes at most ``PER_CLASS`` distinct labelled texts of each class outside
the held-out fold, in hash order, and at most ``TRAIN_CHUNKS`` chunks of each, spread
over the whole text; the classes are weighted back to their shares among all labelled
texts. A short cut of each text is learned as well, with less weight, as texts may be
short. That bounded sample is trained on in one task. Scoring reads every byte.

Nulls and odd input: a missing or empty text is one empty chunk; repeated rows get
equal scores; a missing id is kept as it is and counts as not held out; labels of one
class only give that class, no labels 0.5; an empty table gives an empty result.
Columns other than doc_id and text (labels: doc_id and the label) are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship
from rollcall.llm.labelled import training_ids, training_texts

WIDTH, FILTERS = 7, 16
CHUNK, STRIDE = 512, 448
PAD = 256  # a value of its own for places behind the end
PER_CLASS, TRAIN_CHUNKS = 3000, 8
EPOCHS, BATCH, RATE = 12, 64, 0.01
SHORT, SHORT_WEIGHT = (20, 200), 0.3
AT_ONCE = 256


def chunks(text: str | None) -> np.ndarray:
    """All chunks of the text's bytes as rows, the last one padded."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.int16)
    count = max(1, -(-(len(data) - (CHUNK - STRIDE)) // STRIDE))
    padded = np.full((count - 1) * STRIDE + CHUNK, PAD, dtype=np.int16)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STRIDE]


class Network:
    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.1, (WIDTH, PAD + 1, FILTERS)).astype(np.float32)
        self.table[:, PAD] = 0
        self.bias = np.zeros(FILTERS, np.float32)
        self.weight = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.offset = np.zeros(1, np.float32)

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """Response of every filter at every place of every chunk."""
        places = CHUNK - WIDTH + 1
        out = self.table[0][rows[:, :places]]
        for j in range(1, WIDTH):
            out += self.table[j][rows[:, j : j + places]]
        return out

    def features(self, rows: np.ndarray) -> np.ndarray:
        """Sum over the chunks of the largest responses."""
        total = np.zeros(FILTERS)
        for at in range(0, len(rows), AT_ONCE):
            best = self.responses(rows[at : at + AT_ONCE]).max(axis=1)
            total += np.maximum(best + self.bias, 0).sum(axis=0, dtype=np.float64)
        return total

    def score(self, text: str | None) -> float:
        rows = chunks(text)
        z = float((self.features(rows) / len(rows) * self.weight).sum() + self.offset[0])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.bias, self.weight, self.offset]

    def gradients(self, rows: np.ndarray, owner: np.ndarray, label: np.ndarray, scale: np.ndarray):
        """Of the weighted log-loss; only the places of the largest responses have any."""
        found = self.responses(rows)
        place = found.argmax(axis=1)
        best = np.take_along_axis(found, place[:, None], axis=1)[:, 0]
        hidden = np.maximum(best + self.bias, 0)
        n = np.bincount(owner, minlength=len(label)).astype(np.float32)[:, None]
        mean = np.zeros((len(label), FILTERS), np.float32)
        np.add.at(mean, owner, hidden)
        mean /= n
        z = (mean * self.weight).sum(axis=1) + self.offset[0]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * scale
        back = (error[:, None] * self.weight / n)[owner] * (hidden > 0)
        table = np.zeros_like(self.table)
        filters = np.broadcast_to(np.arange(FILTERS), place.shape)
        line = np.arange(len(rows))[:, None]
        for j in range(WIDTH):
            np.add.at(table[j], (rows[line, place + j], filters), back)
        table[:, PAD] = 0
        return [table, back.sum(axis=0), (error[:, None] * mean).sum(axis=0), error.sum(keepdims=True)]


def shortened(samples: list[tuple[np.ndarray, float, float]], seed: int) -> list[tuple[np.ndarray, float, float]]:
    """One chunk of each sample, cut to a random short length."""
    rng, made = np.random.default_rng(seed), []
    for rows, label, weight in samples:
        row = rows[rng.integers(len(rows))].copy()
        row[rng.integers(*SHORT) :] = PAD
        made.append((row[None], label, weight * SHORT_WEIGHT))
    return made


def train(samples: list[tuple[np.ndarray, float, float]], seed: int = 1) -> Network:
    """A network from (chunks, label, weight) of each document, by Adam."""
    net, rng = Network(seed), np.random.default_rng(seed)
    samples = samples + shortened(samples, seed)
    total = sum(w for _, _, w in samples)
    share = min(max(sum(y * w for _, y, w in samples) / total, 1e-4), 1 - 1e-4)
    net.offset[0] = np.log(share / (1 - share))
    first = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    steps, done = EPOCHS * -(-len(samples) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(samples))
        for at in range(0, len(order), BATCH):
            some = [samples[i] for i in order[at : at + BATCH]]
            rows = np.concatenate([s[0] for s in some])
            owner = np.repeat(np.arange(len(some)), [len(s[0]) for s in some])
            label = np.array([s[1] for s in some], np.float32)
            scale = np.array([s[2] for s in some], np.float32) * (len(samples) / total / len(some))
            done += 1
            rate = RATE * (1 - done / (steps + 1))
            for p, g, m, v in zip(net.parts(), net.gradients(rows, owner, label, scale), first, second, strict=True):
                g = g + 1e-5 * p
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.999**done)) + 1e-8)
    return net


def _saved(net: Network) -> bytes:
    out = io.BytesIO()
    np.savez(out, *net.parts())
    return out.getvalue()


def loaded(data: bytes) -> Network:
    net = Network()
    with np.load(io.BytesIO(data)) as parts:
        net.table, net.bias, net.weight, net.offset = (parts[f"arr_{i}"] for i in range(4))
    return net


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> bytes | None:
    """The trained network as bytes; None without labelled texts."""
    ship(docs.sparkSession)
    chosen = training_ids(docs, labels, label).withColumn("_class", (F.col("_label") >= 0.5).cast("int"))
    counts = {r["_class"]: r["count"] for r in chosen.groupBy("_class").count().collect()}
    if not counts:
        return None
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = [chosen.filter(F.col("_class") == c).orderBy(*order).limit(PER_CLASS) for c in sorted(counts)]
    sample = picked[0] if len(picked) == 1 else picked[0].unionByName(picked[1])
    texts = training_texts(docs, sample)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text in batch.column(0):
                rows = chunks(text.as_py())
                at = np.unique(np.linspace(0, len(rows) - 1, TRAIN_CHUNKS).astype(int))
                kept.append(rows[at].astype("<i2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), batch.column(1)], names=["rows", "label"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [
            (r, y) for batch in batches
            for r, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        ]
        samples = []
        for rows, y in sorted(read):  # the same order whatever the partitions
            weight = counts[int(y >= 0.5)] / min(counts[int(y >= 0.5)], PER_CLASS)
            samples.append((np.frombuffer(rows, "<i2").reshape(-1, CHUNK), y, weight))
        if samples:
            yield pa.RecordBatch.from_arrays([pa.array([_saved(train(samples))], pa.binary())], names=["model"])

    made = texts.mapInArrow(spread, "rows binary, label double").repartition(1)  # the bounded sample
    return made.mapInArrow(fit, "model binary").first()["model"]


def score(docs: DataFrame, model: bytes | None) -> DataFrame:
    """doc_id and the probability of label 1 of every whole text."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = loaded(held.value) if held.value else None
        for batch in batches:
            scores = [net.score(t.as_py()) if net else 0.5 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: bytes | None, least: float = 0.3) -> DataFrame:
    """The documents, all columns, whose score is at least ``least``."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = loaded(held.value) if held.value else None
        for batch in batches:
            kept = pa.array([net is None or net.score(t.as_py()) >= least for t in batch.column(at)], pa.bool_())
            yield batch.filter(kept)

    return docs.mapInArrow(run, docs.schema)
