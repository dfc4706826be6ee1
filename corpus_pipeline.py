"""Training-corpus pipeline over ``documents``: five stages, each a whole job.

quality rules -> SimHash near-duplicates -> benchmark decontamination ->
PII surrogates -> byte-level BPE.  A stage reads what its predecessor wrote
and returns the columns of ``documents`` (the last adds token ids).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import bpe, decontaminate, pii, quality, simhash, store
from shelfline.llm.queries import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels keep."""
    docs = docs.select(*COLUMNS)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, model, prefix="__q_").filter("__q_kept").select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id."""
    return simhash.keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.scan(docs.select(*COLUMNS), bench, prefix="__b_").filter("NOT __b_contaminated").select(*COLUMNS)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, entities replaced; n_chars follows the new text."""
    out = pii.replace(docs.select(*COLUMNS), report=None)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and number of tokens."""
    import public_tokenizers

    coded = bpe.encode(docs.select(*COLUMNS), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-duplicates", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("pii surrogates", pii_surrogates),
    ("byte-level bpe", bpe_tokens),
]

#: A trained line labeller, SimHash components, surrogates and BPE are not SQL;
#: tests/llm compares run() with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store.materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
