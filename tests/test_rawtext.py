import pytest

from rollcall.operators import rawtext as R
from rollcall.operators.match import _hold, _rarest, _word_runs, contained_names, passages_in_texts
from pyspark.sql import functions as F


def files(spark, *texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file string, text string")


def dicts(df, *drop):
    return [r.asDict() for r in df.drop("file", *drop).orderBy("line").collect()]


def test_rank_blocks(spark):
    text = "\n".join([
        "Rank\tModel", "1", " Acme ", "M 1", "Acme", "1400\t1300\t\t55%", "x", "y Open Source", "z",
        # the data line is a bare number and opens no block of its own
        "2", "Beta", "M 2", "Beta", "77", "Proprietary", "3", "Cut",
    ])
    got = dicts(R.parse_rank_blocks(files(spark, text), "seven"))
    assert [(g["rank"], g["company"], g["model"], g["license"]) for g in got] == [
        (1, "Acme", "M 1", "y Open Source"), (2, "Beta", "M 2", "Proprietary"), (3, "Cut", "", ""),
    ]
    # an empty cell stays empty, a missing one gets a dash
    assert (got[0]["gpqa"], got[0]["swe_bench"], got[0]["context"]) == ("", "55%", "—")
    assert (got[1]["code_arena"], got[1]["chat_arena"]) == ("77", "—")
    assert (got[2]["code_arena"], got[2]["chat_arena"]) == ("", "—")


@pytest.mark.parametrize("layout", list(R.RANK_LAYOUTS))
def test_rank_layouts_round_trip(spark, layout):
    fields = R.RANK_LAYOUTS[layout]
    want = [
        {"rank": i, "model": f"M{i}", "company": f"C{i}", "license": "Proprietary", **{f: f"{f}{i}" for f in fields}}
        for i in range(1, 40)
    ]
    text = "\n".join(
        "\n".join([str(w["rank"]), w["company"], w["model"], w["company"], "\t".join(w[f] for f in fields), w["license"]])
        for w in want
    )
    got = dicts(R.parse_rank_blocks(files(spark, text), layout))
    assert [{k: v for k, v in g.items() if k != "line"} for g in got] == want


def test_logo_blocks(spark):
    text = "\n".join([
        "Model", "Organization", "Acme logo", "Model", "Acme logo", "M 1",
        "🇺🇸\tOpen\t200k\t1500", "$1.5\t$2\t90 tok/s", "1%\t2%\t3%\t4%\t5%\t70.5", "Mar. 2025", "Acme", "late 9%",
        "Beta logo", "M 2", "🇨🇳\tClosed", "-120\t32", "no data here",
        "Gamma logo", "M 3", "Open", "Jan. 2024", "A company name that is longer than thirty", "Gamma",
        "Last logo",
    ])
    got = dicts(R.parse_logo_blocks(files(spark, text)))
    assert [g["model"] for g in got] == ["M 1", "M 2", "M 3"]
    first, second, third = got
    assert {k: first[k] for k in ("country", "license", "context", "input_price", "output_price", "speed")} == {
        "country": "美国", "license": "Open", "context": "200k", "input_price": "$1.5", "output_price": "$2", "speed": "90 tok/s",
    }
    # the fourth percent column is skipped; the size is not the arena score
    assert [first[k] for k in ("code_arena", "gpqa", "aime", "swe_bench", "mmmlu", "params")] == ["1500", "1%", "2%", "3%", "5%", "70.5"]
    assert (first["released"], first["company"]) == ("Mar. 2025", "Acme")
    # without a release line there is no company either
    assert (second["country"], second["code_arena"], second["params"], second["released"], second["company"]) == ("中国", "-120", "32", "", "")
    assert (third["released"], third["company"]) == ("Jan. 2024", "Gamma")


def test_timeline(spark):
    block = lambda c, m, t, l, *more: [c, m, t, l, c, "•", "2w ago", *more]
    text = "\n".join([
        "MetaMeta", "Meta", "Model X", "Release", "Version Timeline",
        "Apr 7, 2026", "· 2 releases", *block("Meta", "M1", "Release", "Proprietary"),
        *block("Pro Labs", "Pro", "Preview", "Open Source", "GPQA: 0.91"), *block("Meta", "M3", "Sequel", "Proprietary"),
        "Mar 30, 2026", "· 1 release", *block("Qwen", "M4", "Mini", "Custom", "GPQA: 88"),
    ])
    got = dicts(R.parse_timeline(files(spark, text)))
    assert [tuple(g[k] for k in ("date", "company", "model", "release_type", "license", "gpqa")) for g in got] == [
        ("Apr 7, 2026", "Meta", "M1", "Release", "Proprietary", ""),
        ("Apr 7, 2026", "Pro Labs", "Pro", "Preview", "Open Source", "0.91"),
        ("Mar 30, 2026", "Qwen", "M4", "Mini", "", "88"),
    ]


def test_parsers_take_any_file(spark):
    odd = files(spark, "", None, "\n\n", "no blocks\nat all", "logo", "1", "Jan 1, 2024")
    assert R.parse_timeline(odd).count() == 0
    assert R.parse_logo_blocks(odd).count() == 0
    assert [r["rank"] for r in R.parse_rank_blocks(odd, "two").collect()] == [1]


def test_classes(spark):
    texts = {
        "Code Arena\nChat Arena\n1": "code_chat",
        "Code Arena\nChat Arena\nVersion Timeline": "timeline",
        "Image Gen Image Edit\n 7 ": "image",
        "Rank Model TTS\n1\nCartesia": "tts",
        "Rank Model TTS\n1": "video",
        "Rank Model STT\n1": "stt",
        "Rank Model\nSTT\n1": None,
        "Version Timeline logo": None,
        "logo Released": "logo",
        "logo": None,
        " \n": None,
    }
    got = R.classify_raw(files(spark, *texts)).orderBy(F.substring("file", 2, 9).cast("int")).collect()
    assert [r["kind"] for r in got] == list(texts.values())


def test_mined_names(spark):
    lines = ["ab", "abc", "x" * 49, "x" * 50, "42", "a logo", "http://x", "![i]", "1%2%3%", "1%2%", "Model", "Google", "-dash", "a\tb\tc\td\te"]
    many = "\n".join(f"name {i}" for i in range(40))
    got = {r["file"]: r for r in R.mine_names(files(spark, "\n".join(lines), many, "42")).collect()}
    assert got["f0"]["names"] == ["abc", "x" * 49, "1%2%"] and got["f0"]["total"] == 3
    assert len(got["f1"]["names"]) == 30 and got["f1"]["total"] == 40
    assert "f2" not in got


def test_shared_openings_make_no_pairs(spark):
    """A third and more of the entries open alike; candidates stay linear in the texts."""
    opening = "please answer the following question about"
    entries = [(i, f"{opening} thing number{i} now ok") for i in range(200)] + [(500 + i, f"other entry {i} a{i} b{i} c") for i in range(100)]
    texts = [(i, f"{opening} thing number{i} now ok and more") for i in range(200, 260)] + [(i, f"{entries[i][1]} tail") for i in range(50)]
    t = spark.createDataFrame(texts, "id int, text string")
    e = spark.createDataFrame(entries, "item int, text string")
    anchors = _rarest(_word_runs(e, "item", "text", 3, inner=True), "item")
    assert _hold(_word_runs(t, "id", "text", 3), anchors, "id", "item").count() <= 2 * len(texts)
    got = {tuple(r) for r in passages_in_texts(t, e, "id", "item").collect()}
    assert got == {(i, j) for i, a in texts for j, b in entries if b in a}


def test_hot_prefix_names(spark):
    shorts = [f"common-prefix-{i:03d}" for i in range(150)] + ["common"]
    longs = [f"xx common-prefix-{i:03d} yy" for i in range(0, 300, 2)]
    pairs = contained_names(
        spark.createDataFrame([(x,) for x in longs], "long string"), spark.createDataFrame([(x,) for x in shorts], "short string")
    )
    assert {tuple(r) for r in pairs.collect()} == {(a, b) for a in longs for b in shorts if b in a}
