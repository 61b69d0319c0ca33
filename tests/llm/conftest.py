import pytest
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
# Each case an operator must survive; rows 20 and 21 are the same text, 30 comes twice.
AWKWARD = [
    (1, None, "en", "web"),
    (2, "", "en", "web"),
    (3, " \t\n\x0b\x0c\r ", "en", None),
    (4, "one", None, "web"),
    (5, "one two three", "en", "books"),
    (6, LONG, "en", "books"),
    (7, LONG + " more", "en", "web"),
    (8, "1234 !!! ***", "fr", "web"),
    (9, "Ωμέγα και άλφα 漢字 \U0001f600 é", "el", "web"),
    (10, "a b c ▁ x", "en", "web"),
    (20, "the same words stand here twice for a test of copies " * 3, "en", "web"),
    (21, "the same words stand here twice for a test of copies " * 3, "en", "web"),
    (22, "THE same words stand here twice for a test of copies " * 3, "en", "web"),
    (30, "a repeated row of some words that is there twice, really twice", "en", "web"),
    (30, "a repeated row of some words that is there twice, really twice", "en", "web"),
    (None, "a row without an id has some words too and there are enough of them", "en", "web"),
]


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every awkward case, and columns named as operators name theirs."""
    schema = T.StructType.fromDDL(
        "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, row int, "
        "score string, kept string, size string, component_id string, ids string, label string, value int"
    )
    rows = [
        (i, text, lang, source, None if text is None else len(text), "x", 1, "s", "k", "z", "c", "i", "l", 0)
        for i, text, lang, source in AWKWARD
    ]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
