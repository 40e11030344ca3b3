import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves, for columns of the input.
CLASHING = {"score": "double", "label": "string", "node": "long", "fp": "long", "votes": "string", "slot": "string",
            "ids": "string", "n_words": "string", "group": "int", "bin": "int", "kept": "string", "size": "string",
            "held_out": "string", "component_id": "string", "sequence_id": "string", "hash": "string", "row": "string",
            "a.b": "string", "doc_id.text": "string", "back`tick": "string"}

LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
TEXTS = [None, "", " \t\n", "a", "One two Three", "one two three", "the quick brown fox jumps over the dog " * 9,
         "the quick brown fox jumps over the dog " * 9, "***\n***\n###", "Ünïcödé ßtraße ñandú “quoted” — dash", LONG]


@pytest.fixture
def docs(spark):
    """Build documents from texts, or from (doc_id, text[, lang[, source]])."""
    def build(rows):
        rows = [(i, r) if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        full = [(*r, *(["en", "web"][len(r) - 2:])) for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCUMENTS)
    return build


@pytest.fixture
def odd(docs):
    """NULL, empty and very long texts, ties, NULLs in every column and repeated rows."""
    rows = [(i, t, "en", "web") for i, t in enumerate(TEXTS)]
    return docs([*rows, rows[4], rows[4], (None, "no id here", None, None), (99, None, None, None)])


@pytest.fixture
def clashing(odd):
    """``odd`` with extra columns that have the names of results and of inner columns."""
    from pyspark.sql import functions as F

    return odd.withColumns({n: F.lit("1").cast(t) for n, t in CLASHING.items()}).withColumn(
        "tags", F.create_map(F.lit("k"), F.col("source")))


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
