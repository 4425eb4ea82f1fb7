"""The corpus pipeline: documents in, a mixed, clean corpus out.

Stages, each over all rows its predecessor kept; between stages the rows are
written as Parquet to the shared checkpoint folder and read again:

1. language ID: documents without a letter, or whose main language has less
   than half of their letters, go.
2. line dedup: duplicate lines leave the texts, n_chars follows; no row goes.
3. SimHash near-dedup: of each component the document with the smallest doc_id stays.
4. benchmark decontamination: documents that hold a benchmark item go.
5. mixing: each document gets its number of copies; those with none go.

The last stage and ``run`` leave one row per document with its number of
``copies``, a weighted list; ``corpus``, the registered query, emits each row
that many times.

Columns are those of documents until the last stage, which adds what the
mixing decided; ``corpus`` adds ``copy``, from 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldvein.llm import edit_decontam, entropy_mix, fuzzy_lines, mixed_langid, simhash_gray
from goldvein.llm.common import saved, table

MIN_SHARE = 0.5  # of a document's letters that its main language has


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = mixed_langid.train(mixed_langid.training_rows(docs))
    if model is None:  # nothing to learn from: only texts without a letter are rejected
        return docs.where(F.col("text").rlike("\\p{L}"))
    named = docs.toDF(*[f"in_{c}" for c in docs.columns])  # the input may have columns named like the prediction
    judged = mixed_langid.predict(named, model, text_col="in_text", spans=False)
    kept = judged.where((F.col("lang_pred") != mixed_langid.UNKNOWN) & (F.col("score") >= MIN_SHARE))
    return kept.select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fuzzy_lines.without_duplicate_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_gray.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return edit_decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return entropy_mix.mix(docs).where("copies > 0")


def copied(docs: DataFrame) -> DataFrame:
    """Each row ``copies`` times, numbered from 1 in ``copy``, which replaces a column of that name."""
    return docs.drop("copy").where("copies > 0").select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long"))).alias("copy"))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

#: Language models, SimHash and edit matching have no SQL form; tests/llm/test_corpus_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copied(run(spark, sf_dir))
