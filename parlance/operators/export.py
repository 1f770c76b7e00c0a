"""Labelling requests: one representative a repeat group, in order, in numbered batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import text as T
from parlance.plans.tables import sent, written


def eligible(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("is_low_info") & (F.col("analysis_priority") != "low"))


def representatives(rows: DataFrame) -> DataFrame:
    """Of each canonical group the most liked, then longest, then earliest row, and all rows of no group; ``group_ordinal`` is the group's first ordinal.

    A group is reduced to one ordinal by partial aggregates of a few numbers under the key of its canonical text, so a group of any size stays out of a
    single task and no text is moved; chosen ordinals are then joined back.
    """
    slim = rows.select("ordinal", "like_count", "char_len", T.key_of(rows, "canonical_template_group").alias("key"))
    best = F.max(F.struct("like_count", "char_len", (-F.col("ordinal")).alias("last"))).alias("best")
    grouped = slim.where("key is not null").groupBy("key").agg(best, F.min("ordinal").alias("group_ordinal")).select((-F.col("best.last")).alias("chosen"), "group_ordinal")
    chosen = written(grouped.union(slim.where("key is null").select("ordinal", "ordinal")))
    return rows.join(sent(chosen), F.col("ordinal") == F.col("chosen")).drop("chosen")


def alone(rows: DataFrame) -> Column:
    """Whether a row is of no group."""
    return T.key_of(rows, "canonical_template_group").isNull()


def in_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(alone(rows), "group_ordinal", "ordinal")


def requests(rows: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """Request rows; a reader who needs no texts names them in ``without``, and ``rows`` need not have them."""
    flags = F.struct("is_template_text", "is_mobilization", "rule_topic_tags", "rule_risk_tags", "analysis_priority").alias("rule_flags")
    names = ("comment_id", "comment_text_clean", "parent_comment_id", "is_root", "like_count", "reply_count", "char_len", "template_group")
    return rows.select(*[c for c in names if c not in without], flags)


def numbered(rows: DataFrame, *order) -> DataFrame:
    """Adds ``rn``, 1-based over the whole order: a range sort, then offsets of its partitions, so no task sees all rows. Rows are written first, as a range sort reads them twice."""
    sorted_ = written(rows).orderBy(*order).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    sorted_ = written(sorted_)
    sizes = sorted_.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", "low", before.alias("before"))  # one row a partition
    out = sorted_.join(F.broadcast(offsets), "part")
    return out.withColumn("rn", F.col("before") + F.col("at") - F.col("low") + 1).drop("part", "at", "low", "before")


def batched(rows: DataFrame, size: int, run_id: str, *order) -> DataFrame:
    """Adds run_id, batch_id (at least four digits) and request_id (at least six)."""
    if size <= 0:
        raise ValueError("batch_size must be greater than 0")
    out = numbered(rows, *order)
    number = F.floor((F.col("rn") - 1) / size) + 1
    return out.withColumns({"run_id": F.lit(run_id), "batch_id": F.format_string(f"{run_id}-batch-%04d", number), "request_id": F.format_string(f"{run_id}-%06d", F.col("rn"))}).drop("rn")
