"""Benchmark decontamination by SimHash windows (operator 1). DataFrame functions only.

A window is as many words of a document as a benchmark item has, at any start. A window can only reach the similarity to an item where shingles of
items of its length that it holds weigh at least that share of the lightest such item; all others are ruled out without loss,
wherever in the window the shared shingles lie and in whatever order. Each window left gets a fingerprint, the 64-bit SimHash of its weighted
shingles. Items are indexed by four blocks of sixteen bits, each with all values within four bits: by the pigeonhole principle every
item fingerprint within ``RADIUS`` = 4 * 5 - 1 bits of a window's is found. The exact weighted Jaccard similarity of the
shingle sets then decides. At a similarity of 0.8 fingerprints differ in 9.7 bits on average, with a deviation of about 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import WORD_BREAK, Tables

K, SIMILARITY = 5, 0.8
BLOCKS, WIDTH, NEAR = 4, 16, 4
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Rows of a small table that are broadcast, at most, of up to 64 bytes each; more are joined by a shuffle.
MAX_SENT = 500_000
EPSILON = 1e-9
RESULT = "doc_id bigint, item_id bigint, start_word int, n_words int, hamming int, similarity double, text_hash bigint"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != "")


def shingles_of(words: Column, k: int) -> Column:
    """Hashes of the ``k``-word shingles, in order."""
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - (k - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda would compute what it captures again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash and whole weight of each group of (keys, hash, weight)."""
    sums = [F.sum(F.when(F.col("hash").bitwiseAND(F.lit(1 << b if b < 63 else -(1 << 63))) != 0, F.col("weight")).otherwise(-F.col("weight"))).alias(f"s{b}") for b in range(64)]
    bits = F.lit(0).cast("bigint")
    for b in range(64):
        bits = bits.bitwiseOR(F.when(F.col(f"s{b}") > 0, F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0).cast("bigint")))
    return rows.groupBy(*keys).agg(F.sum("weight").alias("whole"), *sums).select(*keys, "whole", bits.alias("print"))


def block_key(value: Column) -> Column:
    """One number for (n, k, j, value of block j)."""
    return ((F.col("n").cast("bigint") * 8 + F.col("k")) * BLOCKS + F.col("j")) * (1 << WIDTH) + value


def block() -> Column:
    return F.expr(f"shiftrightunsigned(print, {WIDTH} * j) & {(1 << WIDTH) - 1}")


def window_starts(hits: Column, n: Column, k: Column, length: Column, least: Column) -> Column:
    """Starts of windows whose hits weigh ``least`` or more. ``hits``: (pos, weight) by pos; ``length``: words of the document.

    A start belongs to the first hit that its window holds, so none comes twice, and a window holds at most n - k + 1 positions of hits.
    """
    reach = n - k

    def of_hit(all_hits: Column, h: Column, i: Column) -> Column:
        low = F.greatest(h["pos"] - reach, F.when(i > 0, F.get(all_hits, i - 1)["pos"] + 1).otherwise(0), F.lit(0))
        high = F.least(h["pos"], F.greatest(length - n, F.lit(0)))
        held = lambda near, s: F.aggregate(near, F.lit(0.0), lambda a, x: a + F.when(x["pos"] <= s + reach, x["weight"]).otherwise(0.0))
        none = F.array().cast("array<int>")
        heavy = lambda near: F.when((low <= high) & (held(near, h["pos"]) >= least), F.filter(F.sequence(low, F.greatest(low, high)), lambda s: held(near, s) >= least)).otherwise(none)
        return let(F.slice(all_hits, i + 1, F.greatest(reach, F.lit(0)) + 1), heavy)

    return let(hits, lambda all_hits: F.flatten(F.transform(all_hits, lambda h, i: of_hit(all_hits, h, i))))


def contaminations(docs: DataFrame, benchmark: DataFrame, k: int = K, similarity: float = SIMILARITY) -> DataFrame:
    """One row (doc_id, item_id, start_word, n_words, hamming, similarity, text_hash) for each row of ``docs`` and item that its best window matches.

    A shingle weighs ln(1 + items / items that have it), one of no item as much as one of a single item. An item of fewer
    than ``k`` words is one shingle. Defined results: null, empty and blank texts and items match nothing; rows of ``docs`` that repeat, or have a null
    doc_id, are each judged by their text (``text_hash`` tells which); items that share an item_id are items of their own, of which the best match is given; a null
    item_id is left out; of windows that are equally similar the first counts; time grows as the length of a text; an empty table gives no rows;
    further columns are ignored.
    """
    spark = docs.sparkSession
    tables = Tables(spark)
    sent = lambda df: F.broadcast(df) if df.count() <= MAX_SENT else df
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null").withColumn("row", F.xxhash64("text"))
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), words_of(F.col("text").cast("string")).alias("words")).where("item_id is not null and size(words) > 0").distinct()
    items = tables.write(items.select("item_id", F.monotonically_increasing_id().alias("item"), "words", F.size("words").alias("n"), F.least(F.size("words"), F.lit(k)).alias("k")), "items")
    sizes = [r["k"] for r in items.select("k").distinct().collect()]
    if not sizes:
        return spark.createDataFrame([], RESULT)
    parts = None
    for size in sizes:
        one = items.where(F.col("k") == size).select("item", "n", "k", F.explode(F.array_distinct(shingles_of(F.col("words"), size))).alias("hash"))
        parts = one if parts is None else parts.union(one)
    parts = tables.write(parts, "item-shingles")
    total = items.count()
    rarest = F.log(F.lit(1.0 + total))
    weights = tables.write(parts.groupBy("hash").agg(F.log(1 + F.lit(total) / F.count_distinct("item")).alias("weight")), "weights")
    parts = tables.write(parts.join(weights, "hash"), "item-weights")
    prints = tables.write(fingerprints(parts, ["item", "n", "k"]), "item-prints")
    least = prints.groupBy("k", "n").agg((similarity * F.min("whole") - EPSILON).alias("least"))

    windows = None
    for size in sizes:
        places = parts.where(F.col("k") == size).groupBy("hash").agg(F.collect_set("n").alias("lengths"), F.first("weight").alias("weight"))
        words = rows.select("row", words_of(F.col("text")).alias("words"))
        each = words.select("row", F.size("words").alias("length"), F.posexplode(shingles_of(F.col("words"), size)).alias("pos", "hash"))
        hit = each.join(sent(places), "hash").select("row", F.lit(size).alias("k"), "length", "pos", "weight", F.explode("lengths").alias("n")).distinct()
        windows = hit if windows is None else windows.union(hit)
    hits = windows.groupBy("row", "k", "n").agg(F.first("length").alias("length"), F.sort_array(F.collect_list(F.struct("pos", "weight"))).alias("hits"))
    starts = window_starts(F.col("hits"), F.col("n"), F.col("k"), F.col("length"), F.col("least"))
    windows = hits.join(F.broadcast(least), ["k", "n"]).select("row", "k", "n", starts.alias("starts")).where(F.size("starts") > 0)  # at most a row a length
    windows = tables.write(windows, "windows")
    of_text = tables.write(windows.groupBy("row").agg(F.collect_list(F.struct("k", "n", "starts")).alias("windows")), "texts")
    texts = rows.join(sent(of_text.select("row")), "row", "left_semi").dropDuplicates(["row"]).select("row", words_of(F.col("text")).alias("words"))
    texts = tables.write(texts.join(of_text, "row"), "documents")
    inside = None
    for size in sizes:
        cut = lambda every, w: F.transform(w["starts"], lambda s: F.struct(w["n"].alias("n"), s.alias("start"), F.array_distinct(F.slice(every, s + 1, F.greatest(w["n"] - (size - 1), F.lit(1)))).alias("hashes")))  # noqa: B023, E731
        each = let(shingles_of(F.col("words"), size), lambda every: F.flatten(F.transform(F.filter("windows", lambda w: w["k"] == size), lambda w: cut(every, w))))  # noqa: B023
        each = texts.select("row", F.explode(each).alias("w")).select("row", F.lit(size).alias("k"), "w.n", "w.start", F.explode("w.hashes").alias("hash"))
        inside = each if inside is None else inside.union(each)
    key = ["row", "k", "n", "start"]
    inside = tables.write(inside.join(sent(weights), "hash", "left").select(*key, "hash", F.coalesce("weight", rarest).alias("weight")), "window-shingles")

    j = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("j")
    masks = F.expr(f"filter(sequence(0, {(1 << WIDTH) - 1}), m -> bit_count(m) <= {NEAR})")
    index = prints.select("item", "n", "k", "print", j).select("item", "n", "k", "j", block().alias("value"), F.explode(masks).alias("mask"))
    index = index.select("item", block_key(F.col("value").bitwiseXOR(F.col("mask"))).alias("key"))
    of_windows = tables.write(fingerprints(inside, key), "prints")
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))).cast("int").alias("hamming")
    near = of_windows.select(*key, j, "print").select(*key, block_key(block()).alias("key")).join(index.hint("merge"), "key").select(*key, "item").distinct()
    of_items = prints.select("item", F.col("whole").alias("item_whole"), F.col("print").alias("item_print"))
    found = near.join(sent(of_items), "item").join(of_windows, key).select(*key, "item", "whole", "item_whole", apart).where(F.col("hamming") <= RADIUS)
    found = tables.write(found, "candidates")
    common = found.join(inside.select(*key, "hash"), key).join(sent(parts.select("item", "hash", "weight")), ["item", "hash"]).groupBy(*key, "item", "whole", "item_whole", "hamming").agg(F.sum("weight").alias("common"))
    reached = common.withColumn("similarity", F.col("common") / (F.col("whole") + F.col("item_whole") - F.col("common"))).where(F.col("similarity") >= similarity - EPSILON)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("first"), "n", "hamming")).alias("best")
    of_text = tables.write(reached.join(sent(items.select("item", "item_id")), "item").groupBy("row", "item_id").agg(best), "matches")
    out = rows.select("doc_id", "row").join(sent(of_text), "row")
    return out.select("doc_id", "item_id", (-F.col("best.first")).alias("start_word"), F.col("best.n").alias("n_words"), F.col("best.hamming").alias("hamming"), F.col("best.similarity").alias("similarity"), F.col("row").alias("text_hash"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the whole benchmark."""
    return contaminations(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
