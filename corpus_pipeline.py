"""Corpus pipeline: from ``documents`` to clean, distinct, redacted, tokenised texts.

Each stage works on the rows that the one before kept, is written as Parquet to the shared
folder and read again, so a lost executor costs no finished stage.

A null or empty text and one without a letter has no language and goes in the first stage.  Repeated
rows (one id) are kept or dropped together.  Very long texts are handled piece by piece.  An
empty table gives an empty one.  Other columns pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.llm import bpe, decontam, langid, neardup, pii
from tablelearn.llm.common import setup, table, written
from tablelearn.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of 0.5 or more."""
    return langid.keep_known(docs, langid.fit(docs), 0.5)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near copies (5-word shingles, 80 %)."""
    return neardup.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by its kind; ``n_chars`` follows the new text."""
    setup(spark)
    out, names = pii.redact(docs), docs.columns
    if "n_chars" not in names:
        return out
    at, kind = names.index("n_chars"), docs.schema[names.index("n_chars")].dataType
    cols = [f"c{i}" for i in range(len(names))]  # by position: other columns may have names that clash
    length = F.coalesce(F.length(f"c{names.index('text')}").cast(kind), F.col(f"c{at}"))
    return out.toDF(*cols).select(*[length if i == at else F.col(c) for i, c in enumerate(cols)]).toDF(*names)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text, and the digest of the text decoded from them."""
    out = bpe.encode(docs, vocabulary(), decoded=True)
    return out.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("language", language), ("distinct", distinct), ("decontaminated", decontaminated), ("redacted", redacted), ("tokens", tokens)]

#: SQL cannot express the learned stages; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    setup(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
