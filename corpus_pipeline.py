"""The corpus pipeline: five stages from raw documents to training pieces.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet before the next stage reads it.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm import decontaminate, language, minhash, pieces, pii
from cartwheel.llm.common import table
from cartwheel.session import prepare, staged

#: Mean certainty below which a text counts as none of the known languages.
LANGUAGE_FLOOR = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language: NULL, empty or letterless texts,
    and texts the network is unsure about.

    Rows are judged by their text, so repeated rows share their fate.
    """
    net = language.fit(docs)
    return language.keep_known(docs, net, LANGUAGE_FLOOR)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near copies.

    Rows that repeat id and text count as one document and leave one row.
    Documents without an id stay unless an equal text with an id stays.
    """
    # A document dropped here is one of a group, so few ids are dropped and
    # the texts need no shuffle where Spark can send those ids along.
    groups = staged(minhash.near_duplicates(docs), "groups")
    dropped = groups.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    known = docs.where("doc_id IS NOT NULL").join(dropped, "doc_id", "left_anti")
    repeated = groups.where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    if not repeated.isEmpty():
        known = known.join(repeated, "doc_id", "left_anti").unionByName(
            known.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        )
    nameless = docs.where("doc_id IS NULL")
    if not nameless.isEmpty():
        others = docs.where("doc_id IS NOT NULL").select("text").distinct()
        known = known.unionByName(nameless.dropDuplicates(["text"]).join(others, "text", "left_anti"))
    return known.select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; those without an id stay."""
    hits = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti").select(*docs.columns)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates in every text.

    ``n_chars`` is counted anew where the table has it.
    """
    changed = pii.replace_pii(docs)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled SentencePiece pieces of every document."""
    return pieces.encode_texts(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", replace_pii),
    ("sentencepiece", encode_pieces),
]

#: Trained, hashed and sampled stages have no SQL form; the tests compare each
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
