"""Toxic passages by maximum-scoring segments.

Words get log-odds between toxic and clean documents under an informative Dirichlet
prior (the prior's counts follow the word's share of all labelled texts), each moved
towards zero by its confidence bound. Stems, the first letters of longer words, are
counted beside the words: a word has the surest score, the one furthest from zero, of
itself and its stems, and without any a small fixed penalty. A linear scan finds every maximal-scoring segment of a text (Ruzzo and
Tompa). Scores of segments of clean text follow an extreme-value law: with lambda
from the background distribution of word scores, a segment of score S in a text of n
words is expected n * exp(-lambda * S) times by chance. Segments expected less than
``EVALUE`` times are significant passages. A document's evidence is the sum of
-log(expected) over its passages, and a logistic curve fitted to all labelled
documents turns it into a probability.

Word counts and the curve cover all labelled rows outside the held-out fold; only the
model, at most ``VOCABULARY`` words, passes through the driver.

Nulls and odd input: a missing or empty text has no passage and the score of no
evidence; repeated rows get equal scores; a missing id is kept as it is and counts as
not held out; without usable labels every score is 0.5; an empty table gives an empty result. Columns other than doc_id and text
(labels: doc_id and the label) are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship
from rollcall.llm.labelled import training_ids, training_texts
from rollcall.session import materialize

WORDS = re.compile(r"[^\W\d_]+")
VOCABULARY = 50_000
PRIOR = 0.01  # size of the Dirichlet prior, as a part of all counts
Z = 1.96
LEAST = 1.0  # log-odds below this, however sure, are no evidence: a repeated word would add them up
PENALTY = 0.1
EVALUE = 0.01
STEMS = (5, 4)
MEMO_WORDS = 500_000
EVIDENCE_STEPS = 200  # evidence is counted in steps of a quarter, up to 50


def tokens(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def stems(word: str) -> list[str]:
    """Longest first; a star keeps them apart from words."""
    return [word[:n] + "*" for n in STEMS if len(word) > n]


def word_counts(texts: DataFrame) -> DataFrame:
    """word (or stem), toxic, clean: weight of the documents of each kind that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()

        def out():
            words = list(toxic.keys() | clean.keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([float(toxic[w]) for w in words], pa.float64()),
                 pa.array([float(clean[w]) for w in words], pa.float64())],
                names=["word", "toxic", "clean"],
            )

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = set(tokens(text.as_py()))
                words.update(s for w in tuple(words) for s in stems(w))
                for counter, weight in ((toxic, label), (clean, 1 - label)):
                    if weight:
                        for w in words:
                            counter[w] += weight
            if len(toxic) + len(clean) > 200_000:
                yield out()
                toxic.clear()
                clean.clear()
        yield out()

    return (
        texts.select("text", "label").mapInArrow(run, "word string, toxic double, clean double")
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def word_scores(counts: DataFrame) -> DataFrame:
    """The significant words: word, score, z, and the counts.

    ``score`` is the log-odds moved towards zero by ``Z`` standard errors; words with
    less than ``LEAST`` left are no evidence.
    """
    total = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    t, c = float(total["t"] or 0), float(total["c"] or 0)
    size = PRIOR * (t + c)
    prior = (F.col("toxic") + F.col("clean")) * PRIOR

    def logit(n, whole):
        return F.log((n + prior) / (F.lit(whole + size) - n - prior))

    odds = logit(F.col("toxic"), t) - logit(F.col("clean"), c)
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    made = counts.select("word", "toxic", "clean", odds.alias("odds"), error.alias("error"))
    score = F.signum("odds") * (F.abs("odds") - Z * F.col("error"))
    return made.filter(F.abs("odds") - Z * F.col("error") > LEAST).select(
        "word", "toxic", "clean", score.alias("score"), (F.abs("odds") / F.col("error")).alias("z")
    )


def decay(scores: np.ndarray, chance: np.ndarray) -> float:
    """The lambda of the extreme-value law: the positive root of sum(chance * exp(lambda * score)) = 1."""
    low, high = 0.0, 1.0
    value = lambda x: float((chance * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return (low + high) / 2


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments as (first, end, score), in one pass.

    Each candidate points to the last one before it with a smaller sum on its
    left, so the search jumps over candidates that can't be extended.
    """
    sums = np.cumsum(scores)
    stack: list[list] = []  # first, end, sum before, sum at the end, link
    for i in np.nonzero(scores > 0)[0]:
        k = [int(i), int(i) + 1, float(sums[i] - scores[i]), float(sums[i]), -1]
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= k[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= k[3]:
                k[4] = j
                stack.append(k)
                break
            k[0], k[2] = stack[j][0], stack[j][2]
            link = stack[j][4]
            del stack[j:]
            j = link
    return [(s[0], s[1], s[3] - s[2]) for s in stack]


class Scores(dict):
    """Word scores of a model, kept for the words met so far."""

    def __init__(self, table: dict[str, float]):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> float:
        if len(self) > MEMO_WORDS:
            self.clear()
        found = max((self.table[k] for k in (word, *stems(word)) if k in self.table), key=abs, default=-PENALTY)
        self[word] = found
        return found


class Scorer:
    """Passages and evidence of a text under a model."""

    def __init__(self, table: dict[str, float], decay_rate: float):
        self.scores, self.rate = Scores(table), decay_rate

    def passages(self, text: str | None) -> list[tuple[int, int, float, float]]:
        """start, end (code points), score and expected number of every significant passage."""
        words, known = tokens(text), self.scores
        scores = np.array([known[w] for w in words])
        if not len(words) or scores.max() <= 0:
            return []
        found = []
        places = None
        for first, end, score in segments(scores):
            expected = len(words) * math.exp(-min(self.rate * score, 700))
            if expected < EVALUE:
                if places is None:
                    places = [m.span() for m in WORDS.finditer(text.lower())]
                found.append((places[first][0], places[end - 1][1], score, expected))
        return found

    @staticmethod
    def evidence(passages: list[tuple[int, int, float, float]]) -> float:
        return sum(-math.log(max(p[3], 1e-300)) for p in passages)


def fit_curve(evidence: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of the logistic curve for weighted counts at each evidence."""
    a, b = 0.0, 0.0
    x, n = evidence, positive + negative
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = np.maximum(n * p * (1 - p), 1e-9)
        ga, gb = (positive - n * p).sum() - 1e-3 * a, ((positive - n * p) * x).sum() - 1e-3 * b
        haa, hab, hbb = w.sum() + 1e-3, (w * x).sum(), (w * x * x).sum() + 1e-3
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db) * 10, 1e-9))
        a, b = a + step * da, b + step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict:
    """The model: word scores, lambda, and the curve from evidence to probability."""
    spark = docs.sparkSession
    ship(spark)
    texts = training_texts(docs, training_ids(docs, labels, label))
    counts = materialize(word_counts(texts), "toxic-words")
    scored = materialize(word_scores(counts), "toxic-scores")
    rows = scored.orderBy(F.col("z").desc(), "word").limit(VOCABULARY).collect()
    table = {r["word"]: r["score"] for r in rows}
    clean = counts.agg(F.sum("clean")).first()[0] or 0.0
    known = sum(r["clean"] for r in rows)
    # the background: significant words with half a count each for the unseen, then all others
    values = np.array([r["score"] for r in rows] + [-PENALTY])
    weights = np.array([r["clean"] + 0.5 * (r["score"] > 0) / max(1, len(rows)) for r in rows] + [max(clean - known, 1.0)])
    rate = decay(values, weights / weights.sum()) if len(rows) else 1.0
    held = spark.sparkContext.broadcast((table, rate))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*held.value)
        top = EVIDENCE_STEPS / 4
        for batch in batches:
            found = [min(top, scorer.evidence(scorer.passages(t.as_py()))) for t in batch.column(0)]
            steps = pa.array([round(4 * e) for e in found], pa.int32())
            yield pa.RecordBatch.from_arrays([steps, batch.column(1)], names=["step", "label"])

    levels = (
        texts.mapInArrow(run, "step int, label double").groupBy("step")
        .agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n")).collect()
    )
    curve = fit_curve(*[np.array([r[c] * k for r in levels], dtype=float) for c, k in (("step", 0.25), ("p", 1), ("n", 1))])
    return {"table": table, "rate": rate, "curve": curve}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score and the significant passages (start, end, score, expected) of every text."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        scorer, (a, b) = Scorer(m["table"], m["rate"]), m["curve"]
        top = EVIDENCE_STEPS / 4
        for batch in batches:
            spans = [scorer.passages(t.as_py()) for t in batch.column(1)]
            scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * min(top, scorer.evidence(s)))))) for s in spans]
            keyed = [[dict(zip(("start", "end", "score", "expected"), p, strict=True)) for p in s] for s in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(keyed, kind)],
                names=["doc_id", "score", "passages"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, score double, passages array<struct<start:int,end:int,score:double,expected:double>>"
    )
