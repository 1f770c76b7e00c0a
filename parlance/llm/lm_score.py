"""Cross-entropy difference of two n-gram models (operator 7).

The target model counts the documents that are labelled good, the background model counts all documents. Both share one
vocabulary (all words of the corpus), one order (interpolated bigrams over unigrams) and one smoothing. Words and bigrams are
counted exactly, by 64-bit hashes, in tables that grow with the corpus; no model is gathered in one place. Documents are
kept in blocks of about a million tokens. A block's distinct words and bigrams, with their counts in the block, go to cells, which are ranges of the
hashes, as arrays in one row a cell; a cell adds up what all blocks sent and returns to each block what the others have. A document's score is the
mean over its tokens of background loss minus target loss, in nats: higher is more like the target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import _GOLDEN, Tables, WordHashes, bounded_batches, column_bytes, mix64, spread, tidy, word_hashes

#: Weight of the bigram estimate; count added to each word.
MIX, ADD = 0.7, 0.1
#: Tokens and documents of a block, about; tokens of the corpus for each cell.
HOLD, HOLD_DOCS, CELL = 1_000_000, 100_000, 1_000_000
#: Target ids that are broadcast, at most: 16 bytes each; more are joined by a shuffle.
MAX_SENT = 1 << 20
#: Rows of a batch of blocks or cells for Python: each row may have some megabytes.
FEW_ROWS = 16
#: Fixed value: the hash of the start of a document.
START = 0xD6E8FEB86659FD93
SCORES = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double"
BLOCK = "block bigint, ids array<bigint>, sizes binary, target binary, vocabulary binary, words binary, totals array<bigint>"
CELLS = "cell int, block bigint, grams binary, word binary, n binary, t binary"
COUNTS = "block bigint, cell int, n binary, t binary, vocabulary bigint"


def names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def packed(x: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed: most planes of small numbers are zeros."""
    planes = np.ascontiguousarray(x.reshape(-1, 1).view(np.uint8).T)
    return len(x).to_bytes(8, "little") + bytes([x.itemsize]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    size, width = int.from_bytes(raw[:8], "little"), raw[8]
    planes = np.frombuffer(pa.decompress(raw[9:], decompressed_size=size * width, codec="zstd", asbytes=True), np.uint8).reshape(width, size)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def small(x: np.ndarray) -> np.ndarray:
    """Counts in four bytes where they fit."""
    return x.astype(np.uint32 if not len(x) or x.max() < 1 << 32 else np.uint64)


def counts_of(raw: bytes) -> np.ndarray:
    return unpacked(raw, np.uint32 if raw[8] == 4 else np.uint64).astype(np.int64)


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of sorted hashes: about as many high bits fewer as there are hashes."""
    return np.diff(x, prepend=np.uint64(0))


def document_hashes(raws: list[bytes | None], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of documents one after another, and how many each has."""
    words = [raw.lower().split() if raw else [] for raw in raws]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.concatenate([word_hashes(w, cache) for w in words]) if len(words) else np.empty(0, np.uint64), sizes


@tidy
def block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (doc_id, text, good) to blocks: words are places in the block's sorted vocabulary of hashes."""
    cache, place = WordHashes(), TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    made = size = docs = 0

    def block() -> pa.RecordBatch:
        ids = pa.concat_arrays([h[0] for h in held])
        good, hashes, sizes = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
        vocabulary, words = np.unique(hashes, return_inverse=True)
        totals = [sizes.sum(), sizes[good].sum(), (sizes > 0).sum(), (sizes[good] > 0).sum()]
        raw = [packed(x) for x in (sizes.astype(np.int64), good, steps(vocabulary), words.astype(np.int32))]
        lists = [pa.ListArray.from_arrays([0, len(ids)], ids), *(pa.array([x], pa.binary()) for x in raw), pa.array([totals], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array([place + made], pa.int64()), *lists], names(BLOCK))

    for batch in batches:
        raws, good = column_bytes(batch.column(1)), np.array(batch.column(2).to_pylist(), bool)
        for lo in range(0, len(raws), 500):
            held.append((batch.column(0)[lo : lo + 500], good[lo : lo + 500], *document_hashes(raws[lo : lo + 500], cache)))
            size, docs = size + len(held[-1][2]), docs + len(held[-1][3])
            if size >= HOLD or docs >= HOLD_DOCS:
                yield block()
                held, made, size, docs = [], made + 1, 0, 0
    if held:
        yield block()


class Block:
    """A block's tokens, its words and bigrams ("grams"), first words, then bigrams, and their counts in all its documents and in target documents."""

    def __init__(self, row: dict):
        self.block, self.ids = row["block"], row["ids"]
        self.sizes, good, self.words = unpacked(row["sizes"], np.int64), unpacked(row["target"], bool), unpacked(row["words"], np.int32)
        vocabulary = np.cumsum(unpacked(row["vocabulary"], np.uint64))
        self.v, ids = len(vocabulary), self.words.astype(np.int64)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = self.v
        codes, self.pair = np.unique(before * (self.v + 1) + ids, return_inverse=True)
        self.left, self.right = codes // (self.v + 1), codes % (self.v + 1)
        of_target = np.repeat(good, self.sizes)
        self.counts = [np.concatenate([np.bincount(ids[of], minlength=self.v), np.bincount(self.pair[of], minlength=len(codes))]) for of in (slice(None), of_target)]
        hashes = np.append(vocabulary, np.uint64(START))
        grams = np.concatenate([mix64(vocabulary), mix64(hashes[self.left] * np.uint64(_GOLDEN) + hashes[self.right])])
        #: Places of the grams in the order of their hashes, in which cells get them and return their counts.
        self.order = np.argsort(grams, kind="stable")
        self.grams = grams[self.order]


@tidy
def cell_batches(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    edges = np.array([-(-(c << 64) // cells) for c in range(1, cells)], np.uint64)
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row)
            cut = [0, *np.searchsorted(block.grams, edges).tolist(), len(block.grams)]
            n, t = (c[block.order] for c in block.counts)
            word = block.order < block.v
            chosen = [c for c in range(cells) if cut[c] < cut[c + 1]]
            for lo in range(0, len(chosen), 64):
                out = [(c, block.block, packed(steps(block.grams[at])), np.packbits(word[at]).tobytes(), packed(small(n[at])), packed(small(t[at]))) for c in chosen[lo : lo + 64] for at in [slice(cut[c], cut[c + 1])]]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), *[pa.binary()] * 4), strict=True)], names(CELLS))


@tidy
def sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of CELLS, sorted by cell, to what each block's counts lack to the sums of all blocks; a cell's first row has its number of words."""

    def summed(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        grams = [np.cumsum(unpacked(r["grams"], np.uint64)) for r in rows]
        sizes = [len(g) for g in grams]
        word = np.concatenate([np.unpackbits(np.frombuffer(r["word"], np.uint8), count=size).view(bool) for r, size in zip(rows, sizes, strict=True)])
        known, at = np.unique(np.concatenate(grams), return_inverse=True)
        words = np.zeros(len(known), bool)
        words[at[word]] = True
        lacking = []
        for name in ("n", "t"):
            own = np.concatenate([counts_of(r[name]) for r in rows])
            total = np.zeros(len(known), np.int64)
            np.add.at(total, at, own)
            lacking.append(total[at] - own)
        ends = np.cumsum(sizes)
        for i, (row, lo, hi) in enumerate(zip(rows, ends - sizes, ends, strict=True)):
            values = [row["block"], row["cell"], *(packed(small(x[lo:hi])) for x in lacking), int(words.sum()) if not i else 0]
            yield pa.RecordBatch.from_arrays([pa.array([x], y) for x, y in zip(values, (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()), strict=True)], names(COUNTS))

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["cell"] != row["cell"]:
                yield from summed(held)
                held = []
            held.append(row)
    if held:
        yield from summed(held)


@tidy
def score_batches(batches: Iterator[pa.RecordBatch], vocabulary: int, totals: list[int]) -> Iterator[pa.RecordBatch]:
    """Scores of the documents of blocks, each of which comes after its counts. ``totals``: tokens, target tokens, documents with tokens, target documents with tokens."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["words"] is None:
                held.append(row)
                continue
            block = Block(row)
            sizes, v = block.sizes, block.v
            of = np.repeat(np.arange(len(sizes)), sizes)
            means = []
            for name, counts, tokens, starts in (("t", block.counts[1], totals[1], totals[3]), ("n", block.counts[0], totals[0], totals[2])):
                if held:
                    counts[block.order] += np.concatenate([counts_of(h[name]) for h in held])
                single = (counts[:v] + ADD) / (tokens + ADD * max(1, vocabulary))
                context = np.append(counts[:v], starts)[block.left]
                losses = -np.log(MIX * counts[v:] / np.maximum(context, 1) + (1 - MIX * (context > 0)) * single[block.right])
                means.append(np.bincount(of, losses[block.pair], len(sizes)) / np.maximum(sizes, 1))
            held = []
            yield pa.RecordBatch.from_arrays([pa.array(block.ids, pa.int64()), pa.array(sizes), *map(pa.array, means), pa.array(means[1] - means[0])], names(SCORES))


def cross_entropy_difference(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """SCORES of each row of ``docs`` (doc_id, text); ``targets`` has the doc_id of target documents.

    Defined results: null, empty and blank texts have no tokens, losses and a score of 0; with no target document the target
    model is uniform; rows that repeat count and are scored each; a null doc_id is no target; a text of any length is in one block; an empty
    table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    tables = Tables(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    good = tables.write(targets.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct(), "targets").withColumn("good", F.lit(True))
    good = F.broadcast(good) if good.count() <= MAX_SENT else good.hint("merge")
    labelled = rows.join(good, "doc_id", "left").select("doc_id", "text", F.coalesce("good", F.lit(False)).alias("good"))
    bounded_batches(spark)
    blocks = tables.write(labelled.mapInArrow(block_batches, BLOCK), "blocks")
    bounded_batches(spark, FEW_ROWS)
    totals = list(blocks.agg(*[F.coalesce(F.sum(F.col("totals")[i]), F.lit(0)) for i in range(4)]).first())
    cells = max(1, -(-totals[0] // CELL))
    sent = blocks.mapInArrow(lambda it: cell_batches(it, cells), CELLS).repartition(max(spread(spark), cells), "cell").sortWithinPartitions("cell")
    counts = tables.write(sent.mapInArrow(sum_batches, COUNTS), "counts")
    vocabulary = counts.agg(F.coalesce(F.sum("vocabulary"), F.lit(0))).first()[0]
    both = counts.select("block", "cell", "n", "t").unionByName(blocks.select("block", F.lit(cells).alias("cell"), "ids", "sizes", "target", "vocabulary", "words"), allowMissingColumns=True)
    dealt = both.repartition(max(spread(spark), cells), "block").sortWithinPartitions("block", "cell")
    scores = tables.write(dealt.mapInArrow(lambda it: score_batches(it, vocabulary, totals), SCORES), "scores")
    bounded_batches(spark)
    tables.drop(blocks, counts)
    return scores


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; the target is what is labelled as of good quality."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return cross_entropy_difference(docs, labels.where("quality = 1"))
