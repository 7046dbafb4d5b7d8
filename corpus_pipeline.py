"""From raw documents to shards of a training mix: five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspan.llm import decontam, mixing, quality, sharding, simhash
from quillspan.llm.common import discard, materialise, row_key


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier.

    A null or empty text has no words and goes; rows that are equal, or tie, get one verdict; an empty table stays empty;
    other columns are kept as they are, whatever their names.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    whole = docs.select(F.struct(*docs.columns).alias("r"), "text")
    return quality.judge(whole, model).where("quality_rules.kept").select("r.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words a shingle, similarity 0.8 or more.

    Null and empty texts are one group; of repeated rows one stays; ties go by the smallest id, then by the row's hash; an empty table
    stays empty; other columns are kept as they are.
    """
    return simhash.representatives(docs, shingle=5, similarity=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage like a benchmark item.

    Null and empty texts hold none and stay; repeated rows go or stay together, a similarity of just 0.8 goes; an empty table, and an
    empty benchmark, change nothing; other columns are kept as they are.
    """
    key = F.concat_ws(":", *row_key(docs)).alias("row")
    found = decontam.contaminated(docs.select(key, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row")
    bad = materialise(found.select(F.col("doc_id").alias("row")).distinct(), "contaminated")
    return docs.select(F.struct(*docs.columns).alias("r"), key).join(bad, "row", "left_anti").select("r.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null and empty texts have size 0 and are no part of the targets; a null source is one of its own; repeated rows share
    their copies; ties in rounding go by the row's hash, so reruns agree; an empty table stays empty; other columns are kept.
    """
    k1, k2 = row_key(docs)
    key = ["k1", "k2"]
    _, copies = mixing.mix(docs)
    times = materialise(copies.groupBy(*key).agg(F.sum("copies").alias("times"), F.count(F.lit(1)).alias("rows")).where("times > 0"), "times")
    found = docs.select(F.struct(*docs.columns).alias("r"), k1.alias("k1"), k2.alias("k2")).join(times, key)
    if not times.where("rows > 1").isEmpty():  # rows that are equal in all columns share their copies
        found = found.where("rows = 1").unionByName(found.where("rows > 1").dropDuplicates(key))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("r.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: 16 shards of near-equal bytes.

    A null text counts as size 1; every row has a place of its own, repeated ones and null ids too; an empty table has none.
    """
    return sharding.shards(docs, 16)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifier, SimHash and entropy balancing can't be written in SQL; tests/llm/test_pipeline.py checks run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name)
        discard(before)  # the table of the stage before; the input itself is none
    return docs
