"""Reply depth over parent pointers, with dangling parents and cycles.

Pointer doubling: in turn t each unresolved comment knows its 2^t-th ancestor, so a depth d needs log2(d) joins. A turn
that resolves nothing leaves only comments on or behind a cycle: a comment at depth above 2^(t+1) would have an ancestor
that this turn resolves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.plans.tables import written


def steps_to_end(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``links``: id, parent (null: the id is an end). Rows (id, end, steps) that reach an end, and the ids that never do."""
    done = written(links.where("parent is null").select("id", F.col("id").alias("end"), F.lit(0).cast("bigint").alias("steps")))
    open_ = written(links.where("parent is not null").select("id", F.col("parent").alias("far"), F.lit(1).cast("bigint").alias("jump")))
    parts = [done]
    while not open_.isEmpty():
        ends = done
        for p in parts[1:]:
            ends = ends.unionByName(p)
        at = ends.select(F.col("id").alias("far"), "end", "steps")
        reached = written(open_.join(at, "far").select("id", "end", (F.col("jump") + F.col("steps")).alias("steps")))
        rest = open_.join(reached.select("id"), "id", "left_anti")
        if reached.isEmpty():
            return ends, written(rest.select("id"))
        parts.append(reached)
        rest = written(rest)
        ahead = open_.select(F.col("id").alias("far"), F.col("far").alias("further"), F.col("jump").alias("more"))
        open_ = written(rest.join(ahead, "far").select("id", F.col("further").alias("far"), (F.col("jump") + F.col("more")).alias("jump")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, links.select("id").where("false")


def cycles(links: DataFrame) -> DataFrame:
    """``links``: id, parent, none of which reaches an end. Rows (id, size) of the ids on cycles."""
    jump = written(links.select("id", F.col("parent").alias("far")))
    image = written(jump.select(F.col("far").alias("id")).distinct())
    size = image.count()
    while True:
        ahead = jump.select(F.col("id").alias("far"), F.col("far").alias("further"))
        jump = written(jump.join(ahead, "far").select("id", F.col("further").alias("far")))
        image = written(jump.select(F.col("far").alias("id")).distinct())
        now = image.count()
        if now == size:
            break
        size = now
    ring = written(links.join(image, "id", "left_semi").select("id", F.col("parent").alias("far"), F.least("id", "parent").alias("least")))
    while True:  # the least id of a cycle, over windows that double
        ahead = ring.select(F.col("id").alias("far"), F.col("far").alias("further"), F.col("least").alias("other"))
        after = written(ring.join(ahead, "far").select("id", F.col("further").alias("far"), F.least("least", "other").alias("least"), (F.col("other") < F.col("least")).alias("changed")))
        changed = not after.where("changed").isEmpty()
        ring = after.drop("changed")
        if not changed:
            break
    sizes = ring.groupBy("least").agg(F.count("*").alias("size"))
    return written(ring.join(sizes, "least").select("id", "size"))


def reply_depth(comments: DataFrame) -> DataFrame:
    """(comment_id, reply_depth): how many distinct ids the parent chain meets, up to the first root or absent id.

    ``comments``: unique comment_id, parent_comment_id ('' or null: root). A dangling parent counts 1, a parent of itself 1,
    two comments that are each other's parent 2 each.
    """
    links = comments.select(F.col("comment_id").alias("id"), F.nullif(F.coalesce("parent_comment_id", F.lit("")), F.lit("")).alias("parent"))
    absent = links.select(F.col("parent").alias("id")).where("id is not null").distinct().join(links.select("id"), "id", "left_anti")
    every = written(links.unionByName(absent.select("id", F.lit(None).cast("string").alias("parent"))))
    depth, caught = steps_to_end(every)
    out = depth.select(F.col("id").alias("comment_id"), F.col("steps").alias("reply_depth"))
    if not caught.isEmpty():
        loose = written(every.join(caught, "id", "left_semi"))
        rings = cycles(loose)
        opened = loose.join(rings.select("id", F.lit(True).alias("on")), "id", "left").select("id", F.when(F.col("on").isNull(), F.col("parent")).alias("parent"))
        entry, _ = steps_to_end(opened)
        tail = entry.join(rings.select(F.col("id").alias("end"), "size"), "end").select(F.col("id").alias("comment_id"), F.when(F.col("steps") == 0, F.col("size")).otherwise(F.col("steps") + F.col("size") - 1).alias("reply_depth"))
        out = out.unionByName(tail)
    return comments.select("comment_id").join(out, "comment_id").select("comment_id", F.col("reply_depth").cast("int").alias("reply_depth"))


def with_reply_metadata(comments: DataFrame) -> DataFrame:
    """Adds is_root, reply_depth and is_direct_reply_to_root."""
    roots = comments.where("parent_comment_id = ''").select(F.col("comment_id").alias("root_id"))
    out = comments.drop("is_root", "reply_depth", "is_direct_reply_to_root").join(reply_depth(comments), "comment_id", "left").join(roots, F.col("parent_comment_id") == F.col("root_id"), "left")
    return out.withColumn("is_root", F.col("parent_comment_id") == "").withColumn("is_direct_reply_to_root", F.col("root_id").isNotNull()).drop("root_id")
