"""The corpus pipeline: language ID, near-duplicates, repeated passages, benchmark leaks, encoding.

Every stage takes documents(doc_id, text, lang and any other columns) and judges each row by itself: rows with null doc_id,
or that share one, are different documents.  Other columns pass unchanged, whatever their names, but for n_chars, which
follows the text; columns of the last stage's results are replaced.  A null or empty text is a document without content.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import new_path, remove
from gridspark.llm.decontamination import without_leaks
from gridspark.llm.language_id import fit, identify
from gridspark.llm.minhash import near_duplicates
from gridspark.llm.sentencepiece_bpe import encode_decode
from gridspark.llm.suffix_dedup import numbered, remove_repeats


def shielded(docs: DataFrame, own: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """stage(docs) with the columns of docs; those not in own have names of ours meanwhile, which no operator's columns have."""
    names = {c: c if c in own else f"__kept_{i}" for i, c in enumerate(docs.columns)}
    out = stage(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())))
    return out.select(*(F.col(n).alias(c) for c, n in names.items()))


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language stay; those without letters (null and empty texts too) or beyond the calibrated limit go.

    Without any labelled row no language is known, and all go.
    """
    return shielded(docs, ("doc_id", "text", "lang"), lambda d: identify(d, fit(d)).where("not rejected"))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays: that of the smallest doc_id (null first), of equal ones that of the smallest hash of the text, and of equal rows any.

    Texts without words are in no group and stay.
    """

    def stage(d: DataFrame) -> DataFrame:
        rows = numbered(d, "__row")
        gone = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text")).where("not kept").select(F.col("doc_id").alias("__row"))
        return rows.join(gone, "__row", "left_anti")

    return shielded(docs, ("doc_id", "text"), stage)


def stage_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start earlier (ties as for near-duplicates); a null text becomes empty; no row goes."""
    out = shielded(docs, ("doc_id", "text"), lambda d: remove_repeats(d).drop("text").withColumnRenamed("kept_text", "text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def stage_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds or paraphrases a benchmark item go; an empty benchmark lets all stay."""
    return shielded(docs, ("doc_id", "text"), lambda d: without_leaks(d, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def stage_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and what they decode to; a null text has none and decodes to nothing."""
    import public_tokenizers

    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", stage_language),
    ("minhash", stage_near_duplicates),
    ("suffix_dedup", stage_repeats),
    ("decontamination", stage_benchmark),
    ("sentencepiece", stage_encode),
]

#: SQL expresses neither the language models nor the subword merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet to the shared folder and read again by the next."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
