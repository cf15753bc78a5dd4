"""Personal data by weak supervision.

Strict patterns find the base spans (email, ip, card, phone), which always stay. They
and looser patterns propose candidates. Five labelers vote on each candidate, yes, no
or nothing: the strict format, a gazetteer (top-level domains, country codes, forms of
address), words before it, words around it that speak against it, and the way
it is set off from its neighbours. Expectation-maximisation over the counts of all
vote patterns in the whole corpus estimates how reliable each labeler is, and its
posteriors train a logistic classifier of spans. A loose candidate with a probability
of a half or more is added where it doesn't overlap a base span.

All patterns take time in proportion to the text. Only the counts of vote patterns,
a number fixed by kinds, labelers and length classes, reach the driver.

Nulls and odd input: a missing or empty text has no spans; repeated rows get equal
spans; a missing id is kept as it is; a corpus without candidates leaves the
classifier at the labelers' starting reliabilities; an empty table gives an empty
result. Columns other than doc_id and text are not read. Positions are code points,
the end exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import ship

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "name", "secret")
LABELERS = 5
NOTHING, YES, NO = 0, 1, 2
LENGTHS = (10, 16, 24)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

SPELLED_AT = re.compile(r"[\[(] ?at ?[\])]")  # in every spelled-out address
SPELLED_EMAIL = re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]++)++")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{2,4}\)|[0-9]{2,5})[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])")
TITLED = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\.? [A-ZÀ-Þ][a-zß-ÿ]++(?: [A-ZÀ-Þ][a-zß-ÿ]++)?")
SECRET = re.compile(r"\b(?:token|password|passwd|secret|api[_-]?key)\b[ ]{0,3}[=:][ ]{0,3}[\"']?([^\s\"']{8,}+)", re.I)

DOMAINS = frozenset("com org net edu gov info io de fr es uk eu it nl ch at be ca us".split())
COUNTRIES = ("1", "33", "34", "39", "41", "43", "44", "49", "31", "32", "351", "352", "353", "45", "46", "47", "48")
FOR = re.compile(r"mail|contact|call|tel|phone|fax|mobile|card|visa|iban|addr|host|server|login|token|pass|secret|key|name|dear", re.I)
AGAINST = re.compile(r"version|page|isbn|issn|figure|table|chapter|section|serial|article|rev\b|no\.", re.I)
BEFORE = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, past = text.find("@"), 0
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            past = domain.end()
            yield start, past
        at = text.find("@", max(at + 1, past))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Valid matches of the strict patterns, and matches that fail their check: kind, start, end."""
    good, failed = [], []
    if "@" in text:
        good += [(0, s, e) for s, e in emails(text)]
    for m in DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            end = start + sum(map(len, parts[i : i + 4])) + 3
            fine = all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in parts[i : i + 4])
            (good if fine else failed).append((1, start, end))
            start = end + 1
    for m in DIGITS.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19:
            (good if luhn(digits) else failed).append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            count = sum(c.isdigit() for c in m.group())
            (good if 9 <= count <= 15 else failed).append((3, *m.span()))
    return good, failed


def loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    if SPELLED_AT.search(text):
        yield from ((0, *m.span()) for m in SPELLED_EMAIL.finditer(text))
    yield from ((3, *m.span()) for m in LOCAL_PHONE.finditer(text))
    yield from ((4, *m.span()) for m in TITLED.finditer(text))
    if "=" in text or ":" in text:
        yield from ((5, *m.span(1)) for m in SECRET.finditer(text))


def _gazetteer(kind: int, found: str) -> int:
    if kind == 0:
        return YES if re.split(r"[.\]) ]+", found.rstrip("])"))[-1].lower() in DOMAINS else NO
    if kind == 3:
        return (YES if found[1:].startswith(COUNTRIES) else NO) if found[0] == "+" else NOTHING
    if kind == 2:
        return NOTHING if found[0] in "3456" else NO
    if kind == 5:
        return YES if any(c.isdigit() for c in found) and any(c.isalpha() for c in found) else NO
    return YES if kind == 4 else NOTHING


def votes(text: str, kind: int, start: int, end: int, strict: int) -> int:
    """Kind, the labelers' votes and the length class as one number."""
    before, after = text[max(0, start - BEFORE) : start], text[end : end + 1]
    glued = before[-1:].isalnum() or after.isalnum()
    cast = (
        strict,
        _gazetteer(kind, text[start:end]),
        YES if FOR.search(before) else NOTHING,
        NO if AGAINST.search(before) else NOTHING,
        NO if glued else YES,
    )
    code = kind
    for v in cast:
        code = code * 3 + v
    return code * (len(LENGTHS) + 1) + sum(end - start > n for n in LENGTHS)


def candidates(text: str) -> tuple[list, list]:
    """Base spans and the other candidates, each (kind, start, end, code)."""
    good, failed = base_spans(text)
    base = [(*s, votes(text, *s, YES)) for s in good]
    taken = sorted((s, e) for _, s, e in good)
    others = []
    for strict, spans in ((NO, failed), (NOTHING, loose_spans(text))):
        for kind, start, end in spans:
            others.append((kind, start, end, votes(text, kind, start, end, strict)))
    others.sort(key=lambda c: (c[1], -c[2], c[0]))
    free, past, i = [], -1, 0
    for c in others:  # one sweep over both sorted lists
        while i < len(taken) and taken[i][1] <= c[1]:
            i += 1
        clash = i < len(taken) and taken[i][0] < c[2]
        if not clash and c[1] >= past:
            free.append(c)
            past = c[2]
    return base, free


def _decoded(code: int) -> tuple[int, list[int], int]:
    code, length = divmod(code, len(LENGTHS) + 1)
    cast = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        cast.append(v)
    return code, cast[::-1], length


def _features(codes: list[int]) -> np.ndarray:
    x = np.zeros((len(codes), 1 + len(KINDS) + 2 * LABELERS + len(LENGTHS) + 1))
    for i, code in enumerate(codes):
        kind, cast, length = _decoded(code)
        x[i, 0] = x[i, 1 + kind] = 1
        for j, v in enumerate(cast):
            if v:
                x[i, 1 + len(KINDS) + 2 * j + v - 1] = 1
        x[i, 1 + len(KINDS) + 2 * LABELERS + length] = 1
    return x


def reliabilities(cast: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: P(vote | personal or not) of every labeler, and each pattern's posterior."""
    chance = np.tile(np.array([[0.3, 0.1, 0.6], [0.3, 0.6, 0.1]])[:, None, :], (1, LABELERS, 1))
    chance[1, 0] = [0.3, 0.68, 0.02]  # what fails the check of its own format is hardly ever personal
    share, posterior = 0.5, np.full(len(counts), 0.5)
    for _ in range(rounds):
        log = np.log([1 - share, share])[:, None] + sum(np.log(chance[:, j, cast[:, j]]) for j in range(LABELERS))
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        for z, weight in ((0, counts * (1 - posterior)), (1, counts * posterior)):
            for j in range(LABELERS):
                seen = np.bincount(cast[:, j], weight, minlength=3) + 0.01 * counts.sum() + 1
                chance[z, j] = seen / seen.sum()
        share = float(np.clip((counts * posterior).sum() / counts.sum(), 0.05, 0.95))
    return chance, posterior


def train(x: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int = 500) -> np.ndarray:
    """Weights of a logistic classifier with soft targets."""
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip((x * w).sum(axis=1), -30, 30)))
        w += 2.0 * ((x * ((target - p) * weight)[:, None]).sum(axis=0) - 1e-4 * w)
    return w


def learn(docs: DataFrame) -> dict:
    """The classifier, as the probability of every possible code; and the reliabilities."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            for text in batch.column(0):
                for group in candidates(text.as_py() or ""):
                    seen.update(c[3] for c in group)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["code", "n"]
        )

    rows = docs.select("text").mapInArrow(run, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    codes = sorted(r["code"] for r in rows) or [0]
    by_code = {r["code"]: float(r["n"]) for r in rows}
    counts = np.array([by_code.get(c, 1e-6) for c in codes])
    cast = np.array([_decoded(c)[1] for c in codes])
    chance, posterior = reliabilities(cast, counts)
    weights = train(_features(codes), posterior, counts)
    return {"weights": weights, "reliabilities": chance}


def probability(model: dict, code: int) -> float:
    z = float((_features([code])[0] * model["weights"]).sum())
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Finder:
    """All spans of a text under a model; each code is judged once."""

    def __init__(self, model: dict):
        self.model, self.judged = model, {}

    def spans(self, text: str | None) -> list[tuple[int, int, int, bool]]:
        """kind number, start, end, whether a base span; by start, then kind."""
        base, others = candidates(text or "")
        found = [(k, s, e, True) for k, s, e, _ in base]
        for kind, start, end, code in others:
            if code not in self.judged:
                self.judged[code] = probability(self.model, code) >= 0.5
            if self.judged[code]:
                found.append((kind, start, end, False))
        return sorted(found, key=lambda f: (f[1], f[0]))


def find(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and spans (kind, start, end, base) of every text."""
    ship(docs.sparkSession)
    names = ("kind", "start", "end", "base")
    kind = pa.list_(pa.struct(list(zip(names, (pa.string(), pa.int64(), pa.int64(), pa.bool_()), strict=True))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in finder.spans(t.as_py())]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
    )


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str | None, spans: list[tuple[int, int, int, bool]]) -> str | None:
    """The text with every span, or run of overlapping spans, replaced by its kind."""
    if not spans:
        return text
    out, past, end = [], 0, -1
    for kind, start, stop, _ in spans:
        if start >= end:
            out += [text[past:start], f"<{KINDS[kind].upper()}>"]
        past = end = max(end, stop)
    return "".join([*out, text[past:]])


def mask_documents(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """The documents, all columns, with personal data in ``text`` masked."""
    ship(docs.sparkSession)
    model = model or learn(docs)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(at)]
            made = pa.array([masked(t, finder.spans(t)) for t in texts], pa.string())
            columns = [made if i == at else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
