import pytest

WORDS = "the of and with from this that have been into over some time data more like when what page word".split()

#: Null and empty texts, blanks only, repeated rows, ties, a null id, one very long text.
EDGES = [
    (1, "Alpha beta gamma. Delta  epsilon\tzeta eta theta."),
    (2, "Alpha beta gamma. Delta epsilon zeta eta theta."),
    (2, "Alpha beta gamma. Delta epsilon zeta eta theta."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (None, "no id at all"),
    (6, "ünïcödé ΣΑΣ 日本 😀 <|endoftext|> ▁x"),
    (7, " ".join(WORDS[i * i % 19] + str(i) for i in range(30000))),
    (8, "one"),
    (9, "one"),
]


@pytest.fixture
def edges(spark):
    """Documents with odd rows, and columns whose names clash with results."""
    rows = [(i, t, "x", 7, True, "y", 1.0, "z") for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_words int, kept boolean, verdict string, score double, name string")


@pytest.fixture
def nothing(edges):
    return edges.limit(0)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")
