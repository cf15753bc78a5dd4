"""WARC archives, lexical search, divergence of sources."""

import gzip
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.llm import divergence, lexical, queries, warc
from rollcall.session import scratch_path

SF = "/root/testdata/sf0.001"
NEEDS_TABLES = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
PAGE_SCHEMA = "page_id bigint, url string, html string, archive int, path string, _first string"


def page(page_id, html, url="http://example.org/a b?ü\r\nX-Page-Id: 9"):
    return (page_id, url, html, 1, "p", "f")


LONG = "<p>" + "lorem ipsum " * 200
PAGES = [
    page(1, LONG), page(5, LONG), page(3, LONG), page(5, LONG), page(None, LONG),
    page(6, "short"), page(7, "short"), page(8, None), page(9, ""), page(9, None, None),
    page(10, "a\r\n\r\nb" * 400), page(11, "WARC/1.0\r\n\r\n" * 100), page(12, "ä" * 500), page(13, "ä" * 500),
    page(14, "x" * 999), page(15, "x" * 999), page(None, "no id " * 300), page(None, "no id " * 300),
    page(16, "big " * 1_000_000), page(16, "big " * 1_000_000),
]


def pages_by_hand(rows):
    groups = {}
    for page_id, _, html, *_ in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    made = []
    for payload, ids in groups.items():
        ids.sort(key=lambda x: -1 if x is None else x, reverse=True)
        for i, page_id in enumerate(ids):
            again = i > 0 and len(payload) >= 1000
            made.append((
                page_id, len(payload), hashlib.sha1(payload).hexdigest(),
                "revisit" if again else "response", ids[0] if again else None,
            ))
    return sorted(made, key=str)


@pytest.fixture(scope="module")
def stored(spark):
    """Odd pages, written to several archives each task, decided and rewritten."""
    folder = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame(PAGES, PAGE_SCHEMA).repartition(2)
    listed = warc.write_archives(pages, f"{folder}/crawled", archive_bytes=20_000)
    return listed, warc.normalise(warc.find_revisits(listed), f"{folder}/normalised")


def test_archives_give_back_every_page(spark, stored):
    listed, files = stored
    assert listed.select("archive").distinct().count() > 2
    got = [tuple(r)[:5] for r in warc.read_records(files).collect()]
    assert sorted(got, key=str) == pages_by_hand(PAGES)


def test_crawled_archives_are_one_stream_and_normalised_ones_a_member_each(stored):
    listed, files = stored
    for (path,) in listed.select("path").distinct().collect():
        data, zipper = open(path.replace("file:", ""), "rb").read(), zlib.decompressobj(31)
        zipper.decompress(data)
        assert zipper.eof and not zipper.unused_data
    for path, count in files.collect():
        data = open(path.replace("file:", ""), "rb").read()
        assert [r.raw() for r in warc.Inflated(pa.BufferReader(gzip.decompress(data))).records()] == [
            r.raw() for r in warc.members(path)
        ]
        last = list(warc.members(path, [count - 1]))  # by its offset, without the others
        assert len(last) == 1 and last[0].raw() == list(warc.members(path))[-1].raw()


def test_revisits_name_the_record_of_their_response(stored):
    _, files = stored
    records = [r for (path, _) in files.collect() for r in warc.members(path)]
    named = {r.get("WARC-Record-ID"): r for r in records}
    assert len(named) == len(records)
    for r in records:
        if r.get("WARC-Type") == "revisit":
            response = named[r.get("WARC-Refers-To")]
            assert response.get("WARC-Type") == "response"
            assert response.get("WARC-Payload-Digest") == r.get("WARC-Payload-Digest")
            assert r.parts()[0] == response.parts()[0] and not r.parts()[1]


def test_archives_are_listed_as_they_were_written(spark, stored):
    listed, files = stored
    again = warc.list_records(listed.select("archive", "path").distinct())
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, listed.collect()))


def test_inflating_takes_pieces_members_and_plain_files(monkeypatch):
    records = [warc.page_record(i, "u", os.urandom(50) * i, "00" * 20, "<x>") for i in range(40)]
    raw = b"".join(r.raw() for r in records)
    files = [
        raw, gzip.compress(raw), b"".join(gzip.compress(r.raw()) for r in records),
        gzip.compress(raw[:1000]) + gzip.compress(raw[1000:]),
    ]
    for piece in (1, 7, 1 << 20):
        monkeypatch.setattr(warc, "PIECE", piece)
        for data in files:
            assert [r.raw() for r in warc.Inflated(pa.BufferReader(data)).records()] == [r.raw() for r in records]
    for data in (raw[:-30], gzip.compress(raw)[:-30], gzip.compress(raw[:-30])):
        with pytest.raises(EOFError):
            list(warc.Inflated(pa.BufferReader(data)).records())


def test_a_payload_unlike_its_digest_is_an_error():
    record = warc.page_record(1, "u", b"changed", hashlib.sha1(b"written").hexdigest(), "<x>")
    with pytest.raises(ValueError):
        warc._read_row(record, "p")


def test_archives_of_no_pages(spark):
    pages = spark.createDataFrame([], PAGE_SCHEMA)
    assert warc.store_pages(pages).count() == 0


# --- lexical search ---


def terms_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def search_by_hand(docs, items, k):
    counted = [(d, Counter(terms_by_hand(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(terms_by_hand(text))
    rows = []
    for item, terms in asked.items():
        scored = []
        for d, c in counted:
            m = 75 + (25 * sum(c.values()) * n) // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms if t in c
            )
            if score > 0:
                scored.append((-score, math.inf if d is None else d))
        for rank, (score, d) in enumerate(sorted(scored)[:k], 1):
            rows.append((item, rank, None if d == math.inf else d, -score))
    return sorted(rows, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEM_SCHEMA = "item_id bigint, text string, doc_id bigint, item string, _id string"


def test_search_equals_scoring_everything(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["ÉTÉ", "Straße", "x9"]
    weigh = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weigh, k=n))
    docs = [(i, text(rng.choice([1, 3, 10, 40]))) for i in range(400)]
    docs += [(400 + i, docs[i % 5][1]) for i in range(100)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w50 w51"), (900, ""), (901, None)]
    items = [(i, text(rng.choice([1, 5, 30]))) for i in range(25)]
    items += [(3, "w59 w59 w58"), (None, "w50"), (50, "nothing here"), (51, None), (52, ""), (53, "W1, w1; w2-w2")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame([(*x, 1, "i", "d") for x in items], ITEM_SCHEMA)
    for k, block, segment in ((20, 250_000, 2_000_000), (5, 90, 300), (1, 250_000, 1)):
        got = found(lexical.search(df, asked, k, block, segment))
        assert got == search_by_hand(docs, items, k)


def test_intervals_leave_lists_unread():
    """One document is far above the others: the long list of a frequent term is not read to its end."""
    size = 5000
    segment = (
        np.concatenate([[17], np.arange(size)]), np.concatenate([[900_000], np.arange(size, 0, -1)]), np.array([0, 1, 1 + size]),
    )
    lists = lexical.Lists(segment, [(0, 1000), (1, 1)])
    docs, scores = lexical.nra(lists, size, 1)
    assert docs.tolist() == [17] and scores.tolist() == [900_000_000 + size - 17]
    assert lists.at[1] < size


def test_search_over_odd_rows(spark, odd, none):
    asked = spark.createDataFrame(
        [(1, "one word été", 1, "i", "d"), (2, None, 1, "i", "d"), (None, "no id here", 1, "i", "d")], ITEM_SCHEMA
    )
    got = found(lexical.search(odd, asked))
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert got == search_by_hand(docs, [(1, "one word été"), (2, None), (None, "no id here")], 20)
    assert lexical.search(none, asked).count() == 0
    assert lexical.search(odd, asked.limit(0)).count() == 0


# --- divergence ---


def letters_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def divergence_by_hand(docs, least, top):
    counts, with_term = {}, {}
    for lang, source, text in docs:
        words = Counter(letters_by_hand(text))
        counts.setdefault((lang or "", source or ""), Counter()).update(words)
        with_term.setdefault(lang or "", Counter()).update(words.keys())
    rows = []
    for lang in with_term:
        kept = [t for t, n in with_term[lang].items() if n >= least]
        total = Counter()
        for (at, _), c in counts.items():
            if at == lang:
                total.update(c)

        def share(c):
            n = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + (1000000000 * (c[t] + 5)) // n for t in kept}

        q = share(total)
        own = {s: share(c) for (at, s), c in counts.items() if at == lang}
        for s, p in own.items():
            pairs = [(-sum(abs(p[t] - o[t]) for t in kept), x.encode(), x) for x, o in own.items() if x != s]
            terms = [(q[t] - p[t], t.encode(), t) for t in kept if counts[lang, s][t] and p[t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                rows += [(lang, s, part, x, -v, i) for i, (v, _, x) in enumerate(items, 1)]
    return sorted(rows)


def diverged(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def some_docs():
    rng = random.Random(8)
    words = [f"{a}{b}é" if a == "k" else a + b for a in "bcdfgk" for b in "aeiou"] + ["Z", "ß", "漢字"]
    weigh = [1 / (i + 1) for i in range(len(words))]
    langs, sources = ["en", "fr", None], ["s1", "s2", "s3", "", None, "é", "z"]
    docs = [
        (rng.choice(langs), rng.choice(sources), " ".join(rng.choices(words, weigh, k=rng.choice([0, 1, 5, 30]))))
        for _ in range(300)
    ]
    return docs + [("de", "only", "ein wort"), ("it", "a", None), ("it", "b", "x1y2z"), *[("en", "s1", "copy copy")] * 9]


def test_divergence_equals_plain_sums(spark, monkeypatch):
    docs = some_docs()
    df = spark.createDataFrame([(*d, "g", 1) for d in docs], "lang string, source string, text string, g string, n int").repartition(3)
    for least, top, cells in ((4, 50, 1 << 18), (9, 2, 64), (10_000, 50, 64)):
        monkeypatch.setattr(divergence, "CELLS", cells)
        assert diverged(divergence.divergence(df, least, top)) == divergence_by_hand(docs, least, top)


def test_equal_subtrees_are_one_node_and_priced_once():
    rng = np.random.default_rng(3)
    counts = np.tile(rng.integers(0, 2, (1, 64)), (5, 16))  # five equal groups of a pattern said 16 times
    forest = divergence.Forest(counts)
    assert forest.nodes[:4] == [1, 1, 1, 1] and len(set(forest.roots)) == 1
    counts = rng.integers(0, 3, (6, 256))
    totals = counts.sum(axis=1) + 5 * 256
    p = np.stack([1 + divergence.SCALE * (c + 5) // t for c, t in zip(counts, totals)])
    forest = divergence.Forest(counts)
    for g in range(5):
        others = np.arange(g + 1, 6)
        assert forest.prices(g, others, totals).tolist() == np.abs(p[others] - p[g]).sum(axis=1).tolist()


def test_shares_beyond_64_bits():
    counts, totals = np.array([3, 10**12]), np.array([7 * 10**12] * 2)
    assert divergence.shares(counts, totals).tolist() == [1 + 10**9 * (int(c) + 5) // (7 * 10**12) for c in counts]


def test_divergence_of_odd_rows(spark, odd, none):
    docs = [(r["lang"], r["source"], r["text"]) for r in odd.select("lang", "source", "text").collect()]
    assert diverged(divergence.divergence(odd, 2)) == divergence_by_hand(docs, 2, 50)
    assert divergence.divergence(none).count() == 0


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    docs = some_docs()
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(1)
    whole = sorted(map(tuple, divergence.group_terms(df).collect()))
    monkeypatch.setattr(divergence, "HELD", 10)
    assert sorted(map(tuple, divergence.group_terms(df).collect())) == whole


# --- plans ---


@NEEDS_TABLES
def test_no_nested_loops(spark):
    for name in ("op11_warc_archives", "op12_lexical_nra", "op13_source_divergence"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
