"""The corpus pipeline: each stage applies one operator to what the stage before it kept.

Quality rules drop documents; line dedup and decontamination cut words out of texts (``n_chars``
follows) and drop documents without a word left; SimHash keeps one document of each group;
the mix says how many words of each document it takes and keeps those of which it takes any, texts
included.  Extra columns of the documents go along unchanged, whatever their names, but for four that the
mix makes.  Null texts have no words: the quality rules drop them, as they drop empty and very short ones.
Repeated rows and ties: the first of repeated lines and near-duplicates stays, by id, then by text.  An
empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from midyear.llm.decontamination import contaminated_spans, remove_spans
from midyear.llm.lines import without_near_lines
from midyear.llm.mixing import mix_sources
from midyear.llm.quality import quality_rules
from midyear.llm.simhash import first_of_each
from midyear.llm.texts import WORD
from midyear.sources.shared import cut_lineage


def _wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(F.struct("*").alias("doc"), *columns)


def _with_text(rows: DataFrame, text: str) -> DataFrame:
    """The documents in ``doc`` with a new text; those that lost their last word go."""
    doc = F.col("doc").withField("text", F.col(text))
    if "n_chars" in rows.schema["doc"].dataType.names:
        doc = doc.withField("n_chars", F.length(text).cast(rows.schema["doc"].dataType["n_chars"].dataType))
    left = F.col(text).rlike(WORD) | ~F.coalesce(F.col("doc.text"), F.lit("")).rlike(WORD)
    return rows.filter(left).select(doc.alias("doc")).select("doc.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality_rules(_wrapped(docs, "text", "lang", "source"), ("doc",))
    return judged.filter("kept").select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = without_near_lines(_wrapped(docs, "doc_id", "text"), ("doc",))
    return _with_text(left.withColumn("kept", F.when(F.col("doc.text").isNotNull(), F.col("kept"))), "kept")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_each(docs, shingle=3, reach=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated_spans(_wrapped(docs, "text"), benchmark, ("doc", "text"))
    return _with_text(remove_spans(found, ("doc",)), "cleaned")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which the mix takes any words, with its figures in place of columns of their names."""
    mixed = mix_sources(_wrapped(docs, "doc_id", "source", "text"), carry=("doc",)).filter("taken > 0")
    made = ("size", "source_size", "target", "taken")
    kept = [F.col("doc").getField(name).alias(name) for name in docs.columns if name not in made]
    return mixed.select(*kept, *made)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
]

#: Robust distances and XXH64 fingerprints are beyond DuckDB's SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
