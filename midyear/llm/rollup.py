"""Token totals by source, language and tokenizer version, kept up to date by signed batches.

A batch of changes becomes signed rows, +1 for a document's counts that come and -1 for counts
that go; its rows are appended to a log and their sums to the totals.  Totals are additive, so that
the present ones are the sums over all committed batches, and the present state of a document is
what its signed rows add up to.  A batch counts once its sums are written whole; committing a
batch again, after a failure or by mistake, changes nothing.  Batches are committed one after another.

Changes are rows ``kind, doc_id, text, source, lang``: ``insert`` adds a document, ``delete`` takes all
documents with that id away, ``revise`` does both; deletes and revisions see the state before
their batch.  Null texts have 0 tokens; null sources, languages and ids are values like others;
repeated inserts and repeated revisions in one batch count each.  A delete of an unknown id changes
nothing; any other kind of change, or none, fails its batch.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from midyear.llm.texts import map_texts

# Fixed value: how the rank files' tokenizers split a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZERS = "/opt/tokenizers"
STATE = ["doc_id", "source", "lang", "tokenizer", "n_tokens"]
GROUP = ["source", "lang", "tokenizer"]


def word_counter() -> Callable[[str], int]:
    return lambda text: len(text.encode("utf-8", "surrogatepass").split())


def rank_counter(name: str, folder: str = TOKENIZERS) -> Callable[[], Callable[[str], int]]:
    """A counter for the byte-pair ranks in ``folder``, loaded where it is used."""

    def load() -> Callable[[str], int]:
        import tiktoken

        with open(f"{folder}/{name}.tiktoken", "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        encoding = tiktoken.Encoding(name, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return lambda text: len(encoding.encode_ordinary(text))

    return load


def token_counts(docs: DataFrame, versions: dict[str, Callable], carry: tuple[str, ...]) -> DataFrame:
    """Columns ``carry``, ``tokenizer`` and ``n_tokens``: a row per document and tokenizer version."""

    def work(batches):
        counters = {name: load() for name, load in versions.items()}
        for texts in batches:
            strings = ["" if raw is None else raw.decode("utf-8", "replace") for raw in texts]
            yield {"counts": [[{"tokenizer": name, "n_tokens": count(text)} for name, count in counters.items()]
                              for text in strings]}

    made = map_texts(docs, work, "counts array<struct<tokenizer:string,n_tokens:bigint>>", carry)
    return made.select(*carry, F.inline("counts"))


class TokenRollup:
    """Totals kept in ``folder``; ``versions`` names the tokenizer versions that are counted."""

    def __init__(self, spark: SparkSession, folder: str, versions: dict[str, Callable]):
        self.spark, self.folder, self.versions = spark, folder.rstrip("/"), versions

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        where, files = self._files(f"{self.folder}/totals")
        if not files.exists(where):
            return []
        names = [status.getPath().getName() for status in files.listStatus(where)]
        return sorted(name for name in names if self.is_committed(name))

    def is_committed(self, batch: str) -> bool:
        where, files = self._files(f"{self.folder}/totals/{batch}/_SUCCESS")
        return files.exists(where)

    def _read(self, part: str) -> DataFrame | None:
        names = self.batches()
        return self.spark.read.parquet(*[f"{self.folder}/{part}/{name}" for name in names]) if names else None

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Count ``changes`` in, once; False if ``batch`` is already in."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", batch):
            raise ValueError(f"not a batch id: {batch!r}")
        if self.is_committed(batch):
            return False
        known = F.col("kind").isin("insert", "delete", "revise")
        failed = F.raise_error(F.concat(F.lit("no such kind of change: "), F.coalesce("kind", F.lit("NULL")))).cast("string")
        changes = changes.withColumn("kind", F.when(known, F.col("kind")).otherwise(failed))
        come = token_counts(
            changes.filter(F.col("kind").isin("insert", "revise")), self.versions, ("doc_id", "source", "lang"))
        signed = come.select(*STATE, F.lit(1).cast("long").alias("sign"))
        log = self._read("log")
        if log is not None:
            gone = changes.filter(F.col("kind").isin("delete", "revise")).select(
                F.col("doc_id").alias("_id")).distinct()
            touched = log.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
            now = touched.groupBy(*STATE).agg(F.sum("sign").alias("sign")).filter("sign <> 0")
            signed = signed.union(now.select(*STATE, -F.col("sign")))
        path = f"{self.folder}/log/{batch}"
        signed.write.mode("overwrite").parquet(path)
        sums = self.spark.read.schema(signed.schema).parquet(path).groupBy(*GROUP).agg(
            F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
        sums.write.mode("overwrite").parquet(f"{self.folder}/totals/{batch}")
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` of the documents there now."""
        sums = self._read("totals")
        if sums is None:
            return self.spark.createDataFrame(
                [], "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint")
        return sums.groupBy(*GROUP).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0")
