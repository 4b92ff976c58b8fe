"""From raw documents to packed training sequences, in five stages; each is written as Parquet and read again.

1. toxicity: documents that score 0.5 or more go.
2. near_duplicates: of rows whose sets of five-word shingles are linked at a similarity of 0.8 or more, the one with the
   least id stays, of several with that id the one with the least MD5 of its text. Rows are told apart by id and text, so rows
   of one id with unlike texts are judged one by one, and rows that repeat both are one. A row without an id stays only where
   no row with an id is linked to it; without id and words it stays in any case.
3. decontamination: documents that hold a benchmark item, up to its edit budget, go.
4. pii: personal data are replaced by their kind in angle brackets; ``n_chars`` follows the text.
5. packing: what is left is cut into sequences of 2048 tokens.

Every stage works on all rows its predecessor kept, and all but the last return the columns of ``documents``. A null
text is kept by the filters, and packed as an empty one. A table without rows gives one without rows, texts of any length are
used whole, and further columns, whatever their names, are kept up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm import decontaminate, jaccard_join, packing, pii, toxicity
from cellspark.llm.common import BLANKS, documents, fold, ship, stored

LABELLED_ROWS = 20_000
SIMILARITY = jaccard_join.Similarity(words=5, num=80, den=100)

# SQL has no counterpart for learned scores, banded alignment and byte-pair merges.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(toxicity.labelled_sample(docs, labels, fold("doc_id", 5) != 0, LABELLED_ROWS))
    name = _free_name(docs, "toxic_score")
    return toxicity.score(docs, model, name).where(F.col(name) < 0.5).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    key = _free_name(docs, "row_key")
    blank = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(f"[^{BLANKS}]"), F.lit(False))
    keyed = docs.where(~blank).withColumn(key, F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.md5("text").alias("digest")))
    found = jaccard_join.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), SIMILARITY)
    stay = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(key)).distinct()
    kept = keyed.join(stay, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
    return kept.unionByName(docs.where(blank))


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    redacted = pii.redact(docs, pii.fit(docs))
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaked),
    ("pii", redact_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def _free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name
