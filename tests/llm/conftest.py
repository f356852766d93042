import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang, source])."""

    def build(rows):
        full = [(r[0], r[1], *(list(r[2:]) + ["en", "src0"][len(r) - 2:]), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return build


@pytest.fixture
def odd(documents):
    """Nulls everywhere, empty, long and repeated texts, and columns with names the operators use."""
    words = " ".join(f"word{i % 911}x{i % 17}" for i in range(60_000))
    table = documents([
        (1, None), (2, ""), (3, " \t\n\x0b \n"), (None, "alone without an id but with a dozen words to be read here"),
        (4, "the same text twice in this table, long enough to pass all of the rules"),
        (4, "the same text twice in this table, long enough to pass all of the rules"),
        (5, "the same text twice in this table, long enough to pass all of the rules", None, None),
        (6, words, None, "src1"), (7, "x"), (8, "Été \U0001f600 中文 \u0000 nul", "fr", None),
        (9, "!!! ### $$$ ... 123 456"), (None, None, None, None),
    ])
    for name in ("row", "raw", "point", "kept", "spans", "size", "cell", "beside", "id", "features", "_id", "shard",
                 "doc", "score", "items", "component_id", "taken", "lang_pred", "a b", "n_words"):
        table = table.withColumn(name, F.lit("extra"))
    return table
