"""A corpus pipeline of five stages; every stage reads what the one before it has written.

Every stage takes any table with the columns of ``documents``; further columns, whatever their names, are left out. An
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflux.llm import bpe, minhash, mixing, pii, quality
from urbanflux.llm.common import read
from urbanflux.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the bands of their language or script.

    Null, empty and very short texts fail; a null id, language or source does not matter, and repeated
    rows share one verdict. Texts of any length are judged whole.
    """
    return quality.judge_quality(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near-duplicates: the one with the smallest id, null last.

    Of repeated rows one stays; of several texts with that id the one with the smallest digest. Texts without
    words, null included, are copies of nothing and all stay.
    """
    return minhash.keep_one(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text.

    A null text stays null.
    """
    docs = docs.select(*COLUMNS)
    found = pii.find_personal_data(docs, pii.train(docs))
    clean = found.withColumn("text", pii.redact(F.col("text"), F.col("spans")))
    size = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", size).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats a document once for every pass in which the mix takes words of it; the rest go.

    Documents without words, which no mix can take, go too.
    """
    mixed = mixing.mix(docs.select(*COLUMNS), tie=F.xxhash64("text", "lang", "n_chars"))
    passes = F.ceil(F.col("taken") / F.col("size")).cast("int")
    repeated = mixed.where("taken > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), passes)))
    return repeated.select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``ids``, the tokens of the text, ``decoded``, the text they decode to, and ``n_tokens``.

    Null and empty texts have no tokens and decode to the empty text; every row stays.
    """
    coded = bpe.encode_and_decode(docs.select(*COLUMNS))
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("mix_sources", mix_sources),
    ("bpe", encode_texts),
]

#: The tokenizer, the trained redactor and the signatures have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
