"""Records out of raw leaderboard text copied from a screen.

A file is one row with its whole text. Its lines become one array and are cut
into blocks with array functions, so parsing needs no shuffle and any number of
files runs in parallel.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall import schema as S
from rollcall.functions.labels import flag_country
from rollcall.functions.text import any_contains, strip
from rollcall.operators.rows import inline_rows, running
from rollcall.session import materialize, shuffled

# fixed values: month and date forms, licence words and the columns of the layouts
_MONTHS = "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_DATE_LINE = rf"^{_MONTHS}\s+\d{{1,2}},\s+\d{{4}}$"
_RELEASED = rf"^{_MONTHS}\.\s*\d{{4}}"
_LICENSE_WORDS = ["Proprietary", "Open Source"]

RANK_LAYOUTS = {
    "seven": ["code_arena", "chat_arena", "gpqa", "swe_bench", "context", "input_price", "output_price"],
    "three": ["image_gen", "image_edit", "price"],
    "two": ["score", "price"],
}


def _lines(text: Column | str) -> Column:
    return F.transform(F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n"), strip)


def _indexes(lines: Column, test) -> Column:
    """0-based indexes of the lines that pass the test."""
    marked = F.transform(lines, lambda line, i: F.when(test(line), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _at(lines: Column, i: Column) -> Column:
    """Line at a 0-based index, empty past the end."""
    return F.coalesce(F.get(lines, i), F.lit(""))


def _spaced(indexes: Column, gap: int) -> Column:
    """Greedy choice from left to right: the next index is at least ``gap`` further on."""
    kept = running(indexes, F.lit(-gap), lambda last, i: F.when(i >= last + gap, i).otherwise(last), "int")
    return F.array_distinct(kept)


def _rank_starts(lines: Column) -> Column:
    # a number alone on a line opens a block of six lines; numbers inside it do not
    return _spaced(_indexes(lines, lambda line: line.rlike(r"^\d+$")), 6)


def parse_rank_blocks(files: DataFrame, layout: str, file: str = "file", text: str = "text") -> DataFrame:
    """Blocks of rank, company, name, company, tab-separated data, licence."""
    fields = RANK_LAYOUTS[layout]
    cut = files.select(file, _lines(text).alias("_l")).withColumn("_s", _rank_starts(F.col("_l")))
    lines = F.col("_l")

    def block(i: Column) -> Column:
        data = F.split(_at(lines, i + 4), "\t")
        licenses = F.filter(
            F.slice(lines, i + 6, F.lit(3)), lambda line: any_contains(line, _LICENSE_WORDS)
        )
        return F.struct(
            i.alias("line"),
            _at(lines, i).try_cast("bigint").alias("rank"),
            _at(lines, i + 2).alias("model"),
            _at(lines, i + 1).alias("company"),
            *[F.coalesce(F.get(data, F.lit(n)), F.lit(S.DASH)).alias(f) for n, f in enumerate(fields)],
            F.coalesce(F.get(licenses, F.lit(0)), F.lit("")).alias("license"),
        )

    return inline_rows(cut.select(file, F.transform("_s", block).alias("_b")), "_b", "line")


def parse_logo_blocks(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """Blocks opened by a ``… logo`` line with typed tokens in free order.

    A block ends at the next logo line or after its company line, however long it is.
    """
    cut = files.select(file, _lines(text).alias("_l")).withColumn(
        "_s", _indexes(F.col("_l"), lambda line: line.endswith("logo"))
    )
    lines = F.col("_l")
    ends = F.concat(F.slice("_s", F.lit(2), F.greatest(F.size("_s") - 1, F.lit(0))), F.array(F.size("_l")))
    spans = F.transform(
        F.arrays_zip(F.col("_s").alias("a"), ends.alias("b")),
        lambda s: F.struct(
            s["a"].alias("line"),
            F.slice(lines, s["a"] + 1, s["b"] - s["a"]).alias("block"),
        ),
    )
    blocks = inline_rows(cut.select(file, F.when(F.size("_s") > 0, spans).alias("_b")), "_b", "line")
    tail = F.slice("block", F.lit(4), F.size("block"))
    is_month = lambda line: line.rlike(_RELEASED)
    b = (
        blocks.withColumn("model", _at(F.col("block"), F.lit(1)))
        .filter(~F.col("model").isin("", "Model", "Country", "License"))
        .withColumn("flag", _at(F.col("block"), F.lit(2)))
        .withColumn("tail", tail)
        .withColumn("month_at", F.get(_indexes(F.col("tail"), is_month), F.lit(0)))
    )

    def is_company(line: Column) -> Column:
        short = (line != "") & (F.length(line) < 30) & ~line.rlike("[%$\t]")
        return short & ~line.isin("Open", "Closed") & (line != F.col("model"))

    company_at = F.filter(
        F.transform(
            "tail",
            lambda line, i: F.when((i > F.col("month_at")) & ~is_month(line) & is_company(line), i),
        ),
        lambda i: i.isNotNull(),
    )
    b = b.withColumn("company_at", F.get(company_at, F.lit(0))).withColumn(
        "body", F.when(F.col("company_at").isNull(), F.col("tail")).otherwise(F.slice("tail", F.lit(1), F.col("company_at")))
    )
    cells = lambda line: F.filter(F.transform(F.split(line, "\t"), strip), lambda p: p != "")
    from_flag = F.filter(
        cells(F.col("flag")), lambda p: ~p.isin("Open", "Closed") & ~p.rlike(f"[{S.FLAG_LETTERS}]")
    )
    data_lines = F.filter("body", lambda line: ~is_month(line) & line.rlike("[\t%$]"))
    b = b.withColumn("data", F.concat(from_flag, F.flatten(F.transform(data_lines, cells))))

    first = lambda test: F.coalesce(F.get(F.filter("data", test), F.lit(0)), F.lit(""))
    pct = F.filter("data", lambda d: d.contains("%"))
    money = F.filter("data", lambda d: d.startswith("$"))
    nth = lambda arr, n: F.coalesce(F.get(arr, F.lit(n)), F.lit(""))
    b = b.withColumn(
        "code_arena",
        first(lambda d: d.rlike(r"^-?\d{2,4}$") & F.coalesce(d.try_cast("int").between(-2000, 3000), F.lit(False))),
    )
    size = F.filter(
        F.reverse("data"),
        lambda d: (d != F.col("code_arena"))
        & d.rlike(r"^\d+\.?\d*$")
        & F.coalesce(d.try_cast("double").between(0.1, 2000), F.lit(False)),
    )
    months = F.filter("body", is_month)
    return b.select(
        file,
        "line",
        "model",
        flag_country("flag").alias("country"),
        F.when(F.col("flag").contains("Open"), "Open").when(F.col("flag").contains("Closed"), "Closed").otherwise("").alias("license"),
        first(lambda d: d.rlike(r"^\d+\.?\d*[kKmM]$")).alias("context"),
        nth(money, 0).alias("input_price"),
        nth(money, 1).alias("output_price"),
        first(lambda d: any_contains(d, ["c/s", "tok/s"])).alias("speed"),
        "code_arena",
        # the fourth percent column is not kept
        nth(pct, 0).alias("gpqa"),
        nth(pct, 1).alias("aime"),
        nth(pct, 2).alias("swe_bench"),
        nth(pct, 4).alias("mmmlu"),
        nth(size, 0).alias("params"),
        F.coalesce(F.try_element_at(months, F.lit(-1)), F.lit("")).alias("released"),
        F.coalesce(F.get("tail", F.col("company_at")), F.lit("")).alias("company"),
    )


def parse_timeline(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """Release blocks under date lines; a date holds until the next one.

    A block is company, name, release type, licence and three more lines, with
    an optional score behind them, and ends where the next block or date starts.
    """
    lines = F.col("_l")
    is_date = lambda line: line.rlike(_DATE_LINE)
    cut = files.select(file, _lines(text).alias("_l")).withColumn("_d", _indexes(lines, is_date))

    opens = F.filter(
        F.transform(
            lines,
            lambda line, i: F.when(
                # the release type two lines on decides for nearly all lines, so it comes first
                _at(lines, i + 2).isin(S.RELEASE_TYPES)
                & (_at(lines, i + 1) != "")
                & (i > F.get(F.col("_d"), F.lit(0)))
                & (line != "")
                & ~line.rlike("^[·•]")
                & ~line.contains("GPQA:")
                & ~is_date(line),
                i,
            ),
        ),
        lambda i: i.isNotNull(),
    )
    # company, model, type, licence, company again, dot and age: no block is shorter
    cut = cut.withColumn("_s", F.when(F.size("_d") > 0, _spaced(opens, 7)))
    ends = F.concat(F.slice("_s", F.lit(2), F.greatest(F.size("_s") - 1, F.lit(0))), F.array(F.size("_l")))
    # the date line before every start and the one after it, from dates and starts alone, in their order
    event = lambda date: lambda i: F.struct(i.alias("at"), F.lit(date).alias("date"))
    cut = cut.withColumn("_e", F.array_sort(F.concat(F.transform("_d", event(True)), F.transform("_s", event(False)))))
    last = lambda at, e: F.when(e["date"], e["at"]).otherwise(at)
    cut = cut.withColumns({
        "_before": running(F.col("_e"), F.lit(-1), last, "int"),
        "_after": F.reverse(running(F.reverse("_e"), F.size("_l"), last, "int")),
    })
    around = F.arrays_zip(F.col("_e").alias("e"), F.col("_before").alias("before"), F.col("_after").alias("after"))
    cut = cut.withColumn("_w", F.filter(around, lambda w: ~w["e"]["date"]))

    def block(s: Column) -> Column:
        i, end = s["a"], s["b"]
        rest = F.slice(lines, i + 5, F.least(F.least(end, s["w"]["after"]) - i - 4, F.lit(5)))
        scores = F.filter(rest, lambda line: line.contains("GPQA:"))
        lic = _at(lines, i + 3)
        return F.struct(
            i.alias("line"),
            _at(lines, s["w"]["before"]).alias("date"),
            _at(lines, i + 1).alias("model"),
            _at(lines, i).alias("company"),
            _at(lines, i + 2).alias("release_type"),
            F.when(lic.isin(_LICENSE_WORDS), lic).otherwise("").alias("license"),
            F.coalesce(
                F.regexp_extract(F.get(scores, F.lit(0)), r"GPQA:\s*([\d.]+)", 1), F.lit("")
            ).alias("gpqa"),
        )

    spans = F.arrays_zip(F.col("_s").alias("a"), ends.alias("b"), F.col("_w").alias("w"))
    found = cut.select(file, F.when(F.size("_s") > 0, F.transform(spans, block)).alias("_b"))
    return inline_rows(found, "_b", "line")


def classify_raw(files: DataFrame, text: str = "text") -> DataFrame:
    """Layout of every file by its content; first rule wins, null when none holds.

    A rank layout without a single block falls through to the last two rules.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(body, "\n")
    header = F.coalesce(
        F.get(F.filter(lines, lambda line: line.contains("Rank") & line.contains("Model")), F.lit(0)),
        F.lit(""),
    )
    has = lambda *words: [body.contains(w) for w in words]
    both = lambda a, b: has(a)[0] & has(b)[0]
    ranked = F.exists(F.transform(lines, strip), lambda line: line.rlike(r"^\d+$"))
    speech = any_contains(F.lower(body), S.TTS_VENDORS)
    is_code, is_image = both("Code Arena", "Chat Arena"), both("Image Gen", "Image Edit")
    is_tts, is_stt = header.contains("TTS"), header.contains("STT")
    rank_kind = (
        F.when(is_code, "code_chat")
        .when(is_image, "image")
        .when(is_tts & speech, "tts")
        .when(is_tts, "video")
        .when(is_stt, "stt")
    )
    kind = (
        F.when(rank_kind.isNotNull() & ranked, rank_kind)
        .when(body.contains("Version Timeline") & ~body.contains("logo"), "timeline")
        .when(body.contains("logo") & (body.contains("Organization") | body.contains("Released")), "logo")
    )
    return files.withColumn("kind", F.when(strip(body) != "", kind))


RAW_FIELDS = [
    "rank", "model", "company", "date", "release_type", "license", "country", "context", "input_price", "output_price",
    "price", "score", "speed", "code_arena", "chat_arena", "image_gen", "image_edit", "gpqa", "aime", "swe_bench",
    "mmmlu", "params", "released",
]
LAYOUT_OF = {"code_chat": "seven", "image": "three", "video": "two", "tts": "two", "stt": "two"}


def parse_raw(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """Every file read by the parser of its class; the rest is mined for names.

    One tidy table: file, kind, line, the fields of all classes as text (null where
    a class lacks one), and ``mined`` names. A file without a class, or whose class
    finds no block, gives one row of kind ``mined`` with no line.
    """
    classed = materialize(classify_raw(files.select(file, text), text), "raw-files")
    of = lambda *kinds: classed.filter(F.col("kind").isin(*kinds))
    kinds = lambda layout: [k for k, v in LAYOUT_OF.items() if v == layout]
    parsed = [(parse_rank_blocks(of(*kinds(layout)), layout, file, text)) for layout in RANK_LAYOUTS]
    parsed += [parse_logo_blocks(of("logo"), file, text), parse_timeline(of("timeline"), file, text)]

    def tidy(df: DataFrame) -> DataFrame:
        field = lambda f: F.col(f).cast("string") if f in df.columns else F.lit(None).cast("string")
        return df.select(file, F.col("line").cast("bigint").alias("line"), *[field(f).alias(f) for f in RAW_FIELDS])

    blocks = materialize(reduce(DataFrame.unionByName, map(tidy, parsed)), "raw-blocks")
    # as many names as there are files, which no node can hold
    named = shuffled(classed.filter(F.col("kind").isNotNull()).select(file, "kind"))
    found = blocks.join(named, file)
    held = shuffled(blocks.select(file).distinct())
    empty = classed.filter(F.col("kind").isNotNull()).join(held, file, "left_anti")
    rest = classed.filter(F.col("kind").isNull()).unionByName(empty.select(*classed.columns))
    mined = mine_names(rest, file, text).select(
        file, F.lit("mined").alias("kind"), F.lit(None).cast("bigint").alias("line"),
        *[F.lit(None).cast("string").alias(f) for f in RAW_FIELDS], F.array_join("names", "\n").alias("mined"),
    )
    return found.withColumn("mined", F.lit(None).cast("string")).unionByName(mined)


def mine_names(files: DataFrame, file: str = "file", text: str = "text", keep: int = 30) -> DataFrame:
    """Lines that may be entity names: the first few, and how many there are."""
    count = lambda line, ch: F.length(line) - F.length(F.replace(line, F.lit(ch), F.lit("")))

    def is_name(line: Column) -> Column:
        return (
            (F.length(line) > 2)
            & (F.length(line) < 50)
            & ~line.rlike(r"^\d+$")
            & ~any_contains(line, ["logo", "![", "http"])
            & ~any_contains(line, ["Rank", "Model", "Organization"])
            & (count(line, "%") <= 2)
            & (count(line, "$") <= 2)
            & (count(line, "\t") <= 3)
            & ~line.isin(S.COMPANY_LINES)
            & ~line.startswith("-")
        )

    names = files.select(file, F.filter(_lines(text), is_name).alias("_n"))
    return names.filter(F.size("_n") > 0).select(
        file, F.slice("_n", 1, keep).alias("names"), F.size("_n").cast("bigint").alias("total")
    )
