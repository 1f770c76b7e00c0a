"""From raw documents to token files: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import Tables, new_path, shuffles_freed
from parlance.llm.decontaminate import contaminations
from parlance.llm.mixing import copies, label_domains, mixed
from parlance.llm.signature_tree import near_duplicates
from parlance.llm.tokens import op2_token_ids
from parlance.llm.toxicity import held_out, scored, train

#: Rows to leave out that are broadcast, at most: 16 bytes each; more are joined by a shuffle.
MAX_SENT = 1_000_000


def without(docs: DataFrame, gone: DataFrame, on) -> DataFrame:
    return docs.join(F.broadcast(gone) if gone.count() <= MAX_SENT else gone, on, "left_anti")


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.5, by their text alone. Null and empty texts score as no words do; repeated rows go or stay together."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return scored(docs, model, keep=docs.columns).where("score < 0.5").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row, that of the least doc_id (null last). Each row is a document of its own, also where a doc_id is null or repeats; rows without words all stay."""
    tables, key = Tables(spark), fresh(docs, "row_key")
    keyed = tables.write(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    classes = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias("k"), "component_id")
    of = tables.write(keyed.select(F.col(key).alias("k"), F.col("doc_id").alias("id")).join(classes, "k"), "classes")
    first = of.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k")).alias("first")).select("first.k")
    gone = tables.write(of.join(first, "k", "left_anti").select(F.col("k").alias(fresh(docs, "gone"))), "gone")
    return without(keyed, gone, F.col(key) == gone[gone.columns[0]]).drop(key)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, by their text alone: a doc_id may be null or repeat. Null and empty texts stay."""
    found = contaminations(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("text_hash").distinct()
    gone = Tables(spark).write(found.select(F.col("text_hash").alias(fresh(docs, "gone"))), "gone")
    return without(docs, gone, F.xxhash64(F.col("text").cast("string")) == gone[gone.columns[0]])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each row as its rate stands for; rows of one doc_id are rounded alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated = mixed(docs, label_domains(docs, labels), keep=docs.columns)
    return rated.select("row", F.explode(F.array_repeat(F.lit(1), copies(F.col("rate"), F.col("doc_id"))))).select("row.*")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents, as read back: nulls, repeats and empty texts as in the operator."""
    return op2_token_ids(spark, sf_dir, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token ids", write_token_files),
]
#: SQL can express neither the models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = new_path(spark, "stage")
        stage_docs = stage(spark, docs, sf_dir)
        with shuffles_freed(spark):
            stage_docs.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
