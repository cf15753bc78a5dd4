"""Small tables with the odd rows every operator has to take."""

import pytest

DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size int, key string, score double, _row string, _id string, _gone string, component_id string"
)
EXTRA = (7, "k", 0.5, "r", "i", "g", "c")  # columns whose names operators use inside

PHRASE = "one two three four five six seven eight nine ten eleven twelve"


def doc(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text), *EXTRA)


ODD = [
    doc(0, "The quick brown fox jumps over the lazy dog. " * 3),
    doc(1, None, None),
    doc(2, ""),
    doc(3, " \t\n ", "b"),
    doc(4, PHRASE, "b"),
    doc(5, PHRASE, "b"),
    doc(6, PHRASE.upper(), "c"),
    doc(7, "word " * 60_000, "c"),
    doc(8, "straße été niño — “quoted” 漢字 emoji 😀 tail", "d"),
    doc(9, "one", None),
    doc(9, "one", None),
    doc(10, "a\x00b \\ <|im_end|> <|endoftext|> x", "d"),
    doc(None, "no id here at all", "d"),
    doc(11, "mail joe.doe@example.com or +1 (658) 555-4270 at 10.0.0.255", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, (i + 1) % 2, "x") for i in range(12)] + [(None, 1, 1, "x"), (3, None, None, "x"), (4, 1, 0, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, text string")
