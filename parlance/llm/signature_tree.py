"""N-gram Jaccard join by signature trees (operator 10).

The tree's upper levels are dealt over the cluster, its lower levels live in one task at a time:

* top: a node for each token and band of set sizes. Under one global order of tokens two sets with Jaccard of at least t share a
  token among their first ``n - ceil(t n) + 1``, and their sizes lie in the same or in neighbouring bands, so all node pairs
  that share no such node have a maximum overlap below the threshold. Tokens of very many documents go last in that order, so a
  passage that many documents share opens no large node unless a document has little else.
* a node's head is its member of least hash. Nodes of one head and band are one node: tokens of one passage or of one
  group of copies have about the same members, hence mostly the same head, and their members meet once and not once a token.
* below: blocks of bounded size; pairs of blocks of one node are visited in tasks of their own.
* in a task: leaves and inner nodes with OR-combined token bitmaps, size ranges and ranges of components; a dual traversal drops
  node pairs whose sizes are too far apart, whose common bits allow too little overlap or that are of one component. Bitmaps have
  at least two bits a token, so long documents are told apart as well as short ones; neighbours in a tree are alike in content.

What is left is compared exactly, on whole sets. Members of one component need no further comparison (classes are what
is asked for), so a first round compares each member with its head, a second one a few pairs that cover each large node, and the
last one all pairs left between components; no link between different components is lost. Pairs compared grow with the documents that are
alike but below the threshold, not with the square of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import Tables, WordHashes, bounded_batches, column_bytes, components, shingles, tidy

#: Bits of the smallest bitmap; a larger set has the next power of two of twice its size.
BITS = 1024
#: Token counts from which a token goes last in the order, and how many such tokens may: 8 bytes each are broadcast.
HOT_COUNT, HOT_TOKENS = 64, 1 << 17
#: Members of a block; children of a node.
BLOCK, FAN = 2048, 8
#: Members from which a node is first covered by a few pairs.
COVERED = 32
#: Rows, and bytes of them, whose trees a task visits at once; pairs that a step of a traversal makes.
ROWS, BYTES, PAIRS = 4096, 1 << 25, 1 << 18
#: Classes whose texts are looked up by a broadcast: 64 bytes each at most; more by a shuffle.
MAX_SENT = 1 << 18
FEATURES = "doc_id bigint, n bigint, p int, set_hash binary, tokens array<bigint>, bits binary"


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def ordered(sets: np.ndarray, hot: np.ndarray | None) -> np.ndarray:
    """The set in the global order: by hash, hot tokens last."""
    if hot is None or not len(hot):
        return sets
    at = np.searchsorted(hot, sets)
    is_hot = hot[np.minimum(at, len(hot) - 1)] == sets
    return np.concatenate([sets[~is_hot], sets[is_hot]])


def bitmap(s: np.ndarray) -> bytes:
    """The set's bitmap, packed: of the low bits of its hashes, so that halves can be folded onto each other."""
    size = max(BITS, 1 << (2 * len(s) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(s & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


@tidy
def feature_batches(batches: Iterator[pa.RecordBatch], k: int, percent: int, hot=None) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    hot = hot.value if hot is not None else None
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), column_bytes(batch.column(1))
        for lo in range(0, len(ids), 1000):
            rows: list[list] = [[], [], [], [], [], []]
            for doc_id, raw in zip(ids[lo : lo + 1000], texts[lo : lo + 1000], strict=True):
                s = shingles(raw, k, cache)
                n = len(s)
                p = prefix_length(n, percent) if n else 0
                kept = ordered(s, hot)[: p if hot is not None else p + p // 4 + 16]
                for column, value in zip(rows, (doc_id, n, p, xxhash.xxh3_128_digest(s.tobytes()) if n else None, kept.view(np.int64), bitmap(s) if n else None), strict=True):
                    column.append(value)
            lengths = np.cumsum([0, *(len(x) for x in rows[4])])
            tokens = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(rows[4]) if rows[4] else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.binary()), tokens, pa.array(rows[5], pa.binary())], ["doc_id", "n", "p", "set_hash", "tokens", "bits"])


@tidy
def reordered(batches: Iterator[pa.RecordBatch], hot) -> Iterator[pa.RecordBatch]:
    """(id, n, p, tokens) to the first p tokens of the order with hot tokens last; null where the tokens kept do not tell."""
    for batch in batches:
        out = []
        for n, p, tokens in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            kept = np.array(tokens.values, np.int64).view(np.uint64)
            now = ordered(kept, hot.value)
            at = np.minimum(np.searchsorted(hot.value, kept), len(hot.value) - 1)
            cool = len(kept) - int((hot.value[at] == kept).sum())
            out.append(now[:p].view(np.int64) if cool >= p or len(kept) >= n else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], ["id", "n", "tokens"])


def prefix_batches(batches: Iterator[pa.RecordBatch], percent: int, hot) -> Iterator[pa.RecordBatch]:
    """(id, set) to the first tokens of the order with hot tokens last."""
    for batch in batches:
        sets = [np.asarray(s.values, np.int64).view(np.uint64) for s in batch.column(1)]
        out = [ordered(s, hot.value)[: prefix_length(len(s), percent)].view(np.int64) for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["id", "n", "tokens"])


@tidy
def set_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(id, set_hash, text) to the whole sets (id, set) of the texts that have that hash: rows that repeat a doc_id may have others."""
    cache = WordHashes()
    for batch in batches:
        ids, hashes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), column_bytes(batch.column(2))
        for lo in range(0, len(ids), 1000):
            sets = [shingles(raw, k, cache) for raw in texts[lo : lo + 1000]]
            right = [i for i, s in enumerate(sets) if xxhash.xxh3_128_digest(s.tobytes()) == hashes[lo + i]]
            values = np.concatenate([sets[i] for i in right] or [np.empty(0, np.uint64)]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(sets[i]) for i in right)]), pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([pa.array([ids[lo + i] for i in right], pa.int64()), lists], ["id", "set"])


def needed(sizes, percent: int):
    """Least overlap of two sets whose sizes sum up to ``sizes``."""
    return -(-percent * sizes // (100 + percent))


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Rows of 64-bit words of wider bitmaps as bitmaps of ``size`` bits."""
    return np.bitwise_or.reduce(bits.reshape(len(bits), -1, size // 64), axis=1)


class Forest:
    """Trees over members that are sorted by ``tree``. levels[0] are the members; each level above combines up to ``FAN`` nodes of one tree, until each tree is one node.

    A level is (low, high: sizes; bits; spare: tokens beyond one a bit, at most; first, last: components; start, count: children).
    """

    def __init__(self, tree: np.ndarray, n: np.ndarray, bits: np.ndarray, component: np.ndarray):
        none = np.zeros(len(n), np.int64)
        self.levels = [(n, n, bits, n - np.bitwise_count(bits).sum(1, dtype=np.int64), component, component, none, none)]
        while True:
            starts = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
            sizes = np.diff(np.r_[starts, len(tree)])
            if sizes.max() == 1:
                self.roots = dict(zip(tree.tolist(), range(len(tree)), strict=True))
                return
            within = np.arange(len(tree)) - np.repeat(starts, sizes)
            cut = np.flatnonzero(within % FAN == 0)
            low, high, b, spare, first, last, _, _ = self.levels[-1]
            at = lambda how, x: how.reduceat(x, cut, 0)  # noqa: B023, E731
            self.levels.append((at(np.minimum, low), at(np.maximum, high), at(np.bitwise_or, b), at(np.maximum, spare), at(np.minimum, first), at(np.maximum, last), cut, np.diff(np.r_[cut, len(tree)])))
            tree = tree[cut]


@tidy
def sieve(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n_a, n_b, bits_a, bits_b) that their bitmaps do not rule out."""
    for batch in batches:
        n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        bits = [batch.column(c).to_pylist() for c in ("bits_a", "bits_b")]
        widths = np.array([[len(x) // 8 for x in side] for side in bits], np.int64).reshape(2, -1)
        fits = np.zeros(len(n_a), bool)
        for one, other in np.unique(widths, axis=1).T.tolist():
            at = np.flatnonzero((widths[0] == one) & (widths[1] == other))
            x, y = (folded(np.frombuffer(b"".join([side[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1), 64 * min(one, other)) for side in bits)
            only_x, only_y = (np.bitwise_count(z).sum(1, dtype=np.int64) for z in (x & ~y, y & ~x))
            fits[at] = np.minimum(n_a[at] - only_x, n_b[at] - only_y) >= needed(n_a[at] + n_b[at], percent)
        yield batch.select(["a", "b"]).filter(pa.array(fits))


def traverse(one: Forest, other: Forest, x: np.ndarray, y: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of members below the pairs of roots (x, y) that components, sizes and bitmaps do not rule out. Both forests are walked down together."""
    same = one is other
    todo = [(max(len(one.levels), len(other.levels)) - 1, x, y)]
    while todo:
        level, x, y = todo.pop()
        a, b = (f.levels[min(level, len(f.levels) - 1)] for f in (one, other))
        fits = (100 * a[1][x] >= percent * b[0][y]) & (100 * b[1][y] >= percent * a[0][x])
        fits &= (a[4][x] != b[5][y]) | (a[5][x] != b[4][y])  # not all of one component
        if same:
            fits &= (x <= y) if level else (x < y)
        x, y = x[fits], y[fits]
        common = np.bitwise_count(a[2][x] & b[2][y]).sum(1, dtype=np.int64)
        most = np.minimum(common + np.minimum(a[3][x], b[3][y]), np.minimum(a[1][x], b[1][y]))
        fits = most >= needed(a[0][x] + b[0][y], percent)
        x, y = x[fits], y[fits]
        if not level:
            if len(x):
                yield x, y
            continue
        spans = [(f.levels[level][6][z], f.levels[level][7][z]) if level < len(f.levels) else (z, np.ones_like(z)) for f, z in ((one, x), (other, y))]
        (start_x, count_x), (start_y, count_y) = spans
        count = count_x * count_y
        step = max(1, PAIRS // FAN**2)
        for lo in range(0, len(x), step):
            at = slice(lo, lo + step)
            c, width = count[at], np.repeat(count_y[at], count[at])
            k = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            todo.append((level - 1, np.repeat(start_x[at], c) + k // np.maximum(width, 1), np.repeat(start_y[at], c) + k % np.maximum(width, 1)))


def covering(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs a few that reach all their members: each hub with its partners that no earlier hub has, and with one that some has."""
    x, y = np.concatenate([x, y]), np.concatenate([y, x])
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    size = int(x.max()) + 1 if len(x) else 0
    degree = np.bincount(x, minlength=size)
    start = np.cumsum(degree) - degree
    covered, out = np.zeros(size, bool), []
    for hub in np.argsort(-degree, kind="stable"):
        if covered[hub] or not degree[hub]:
            continue
        partners = y[start[hub] : start[hub] + degree[hub]]
        old = covered[partners]
        chosen = np.concatenate([partners[~old], partners[old][:1]])
        out.append(np.stack([np.full(len(chosen), hub), chosen]))
        covered[hub] = covered[partners] = True
    return tuple(np.concatenate(out, 1)) if out else (x, y)


@tidy
def candidate_batches(batches: Iterator[pa.RecordBatch], percent: int, few: bool) -> Iterator[pa.RecordBatch]:
    """Sorted rows (head, band, i, j, block, own, id, component, n, bits) to pairs (a, b) of two components that no node rules out; of a node's pairs all, or a few that cover its members."""

    def pairs(t: pa.Table) -> pa.RecordBatch:
        block, own, ids, component, n, i, j = (t.column(c).to_numpy() for c in ("block", "own", "id", "component", "n", "i", "j"))
        keys = np.stack([t.column(c).to_numpy() for c in ("head", "band", "i", "j")], 1)
        group = np.cumsum(np.r_[False, (keys[1:] != keys[:-1]).any(1)])
        tree = 2 * group + (block != i)
        packed = t.column("bits").to_pylist()
        width = np.array([len(b) // 8 for b in packed])
        rows = {}
        for words in np.unique(width).tolist():
            at = np.flatnonzero(width == words)
            bits = np.frombuffer(b"".join([packed[r] for r in at.tolist()]), np.uint64).reshape(len(at), words)
            many, place, size = np.unique(np.stack([tree[at], component[at]], 1), axis=0, return_inverse=True, return_counts=True)
            joint = np.where(size[place] >= FAN, component[at], -1)
            order = np.lexsort((bits[:, 1].byteswap(), bits[:, 0].byteswap(), joint, tree[at]))  # like contents are neighbours
            rows[words] = (at[order], bits[order])
        found = [[], []]

        def visit(one: Forest, other: Forest, split: bool, row_x: np.ndarray, row_y: np.ndarray) -> None:
            if split:  # two blocks: a tree of one with the tree of the other
                start = [(r, other.roots[g ^ 1]) for g, r in one.roots.items() if g ^ 1 in other.roots and (one is not other or not g & 1)]
            else:
                start = [(r, other.roots[g]) for g, r in one.roots.items() if g in other.roots]
            if not start:
                return
            x, y = np.array(start).T
            for a, b in traverse(one, other, x, y, percent):
                a, b = row_x[a], row_y[b]
                keep = (component[a] != component[b]) & (own[a] | own[b])
                found[0].append(a[keep])
                found[1].append(b[keep])

        two = i != j
        for words, (at, bits) in rows.items():
            for split in (False, True):
                mine = two[at] == split
                if not mine.any():
                    continue
                one = Forest(tree[at[mine]], n[at[mine]], bits[mine], component[at[mine]])
                visit(one, one, split, at[mine], at[mine])
                most = n[at[mine]].max()
                for wider in (w for w in rows if w > words):  # the part of wider bitmaps whose sizes are near enough
                    far, wide = rows[wider]
                    fit = (two[far] == split) & (percent * n[far] <= 100 * most)
                    if fit.any():
                        visit(one, Forest(tree[far[fit]], n[far[fit]], folded(wide[fit], 64 * words), component[far[fit]]), split, at[mine], far[fit])
        a, b = (np.concatenate(f) if f else np.empty(0, np.int64) for f in found)
        if few:
            a, b = covering(a, b)
        a, b = ids[a], ids[b]
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < ROWS and sum(b.nbytes for b in held) < BYTES:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        keys = np.stack([t.column(c).to_numpy() for c in ("head", "band", "i", "j")], 1)
        last = int(np.flatnonzero((keys != keys[-1]).any(1)).max(initial=-1)) + 1  # the last node may go on
        if last:
            yield pairs(t.slice(0, last))
        held = t.slice(last).to_batches()
    if held and sum(b.num_rows for b in held):
        yield pairs(pa.Table.from_batches(held).combine_chunks())


class JaccardJoin:
    """Classes of documents under links of Jaccard similarity of at least ``percent`` / 100 of their sets of ``k``-word shingles.

    Defined results: null, empty or blank texts have an empty set and link with nothing (component_id is their own doc_id); a
    text of fewer than ``k`` words is one shingle; texts of any length count whole; a similarity of exactly the threshold links; rows that
    repeat a doc_id are documents of their own; a row with a null doc_id is one too, and only a component without any other doc_id
    has a null component_id; an empty table gives no rows; further columns are ignored.
    """

    def __init__(self, k: int = 5, similarity: str = "0.8", hot_count: int = HOT_COUNT, block: int = BLOCK, covered: int = COVERED):
        percent = Fraction(similarity) * 100
        if percent.denominator != 1 or not 0 < percent <= 100:
            raise ValueError("similarity must be a whole percentage above 0")
        self.k, self.percent, self.hot_count, self.block, self.covered = k, int(percent), hot_count, block, covered
        #: Bands of sizes, in logarithms: a little wider than the similarity allows sizes to differ.
        self.band = max(math.log(100 / self.percent) * (1 + 1e-9), 1e-9)

    def run(self, docs: DataFrame) -> DataFrame:
        spark, k, percent = docs.sparkSession, self.k, self.percent
        tables = Tables(spark)
        bounded_batches(spark)
        texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        features = texts.mapInArrow(lambda it: feature_batches(it, k, percent), FEATURES).withColumn("row", F.monotonically_increasing_id())
        features = tables.write(features, "features")
        size = tables.write(features.select("doc_id", "n", "set_hash"), "sizes")
        # A class of equal sets is one document below; its id is the row of its least doc_id.
        least = features.where("n > 0").groupBy("set_hash").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"))
        classes = tables.write(least.select(F.col("least.row").alias("id"), "least.doc_id", "set_hash"), "classes")
        # One join plan at all sizes: classes grow with the documents.
        first = features.withColumnRenamed("row", "id").join(classes.select("id").hint("merge"), "id").select("id", "n", "p", "tokens", "bits")
        first = tables.write(first, "firsts")
        tables.drop(features)
        label = self.labels(first, classes, texts, tables)
        of_class = classes.join(label, "id", "left").select("set_hash", "doc_id", F.coalesce("component", "id").alias("component"))
        of_class = tables.write(of_class, "components")
        least = of_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        out = size.join(of_class.join(least, "component").select("set_hash", "component_id"), "set_hash", "left")
        tables.drop(classes, label)
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))

    def labels(self, first: DataFrame, classes: DataFrame, texts: DataFrame, tables: Tables) -> DataFrame:
        """(id, component) of the classes that link with another."""
        nodes = tables.write(first.select("id", "n", "bits"), "nodes")
        shared = self.shared(first, classes, texts, tables)
        heads = tables.write(self.heads(shared), "heads")
        tables.drop(shared)
        # Two sets have no more in common than what is left of either from their first common token on.
        sizes = F.col("n") + F.col("head_n")
        near = (100 * F.least("n", "head_n") >= self.percent * F.greatest("n", "head_n")) & ((100 + self.percent) * F.least(F.col("n") - F.col("at"), F.col("head_n") - F.col("head_at")) >= self.percent * sizes)
        pairs = heads.where(near).select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()
        groups = tables.write(heads.where("members > 2").select("head", "band", "id", "own").distinct(), "groups")
        compared = tables.write(self.sieved(pairs, nodes), "compared")
        tables.drop(heads)
        links = self.verified(compared, classes, texts, tables)
        label = components(links, tables)
        for few in (True, False):  # a few pairs of large nodes first: what they link needs no more comparison
            found = self.between(groups, nodes, label, tables, few)
            new = tables.write(found.join(compared, ["a", "b"], "left_anti"), "candidates")
            tables.drop(found, links)
            links = self.verified(new, classes, texts, tables)
            before, label = label, tables.write(self.relabelled(label, links, tables), "labels")
            tables.drop(before)
            compared = compared.union(new)
        tables.drop(nodes, groups, links)
        return label

    def texts_of(self, wanted: DataFrame, texts: DataFrame) -> DataFrame:
        """(id, set_hash, text) of the classes ``wanted`` (id, doc_id, set_hash), of all rows that have their doc_id."""
        wanted = wanted.withColumnRenamed("doc_id", "of")
        wanted = F.broadcast(wanted) if wanted.count() <= MAX_SENT else wanted
        return texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("of"))).select("id", "set_hash", "text")

    def shared(self, first: DataFrame, classes: DataFrame, texts: DataFrame, tables: Tables) -> DataFrame:
        """(token, id, n, at) of the tokens at the beginning of the order that some other class has there too."""
        spark, k, percent = first.sparkSession, self.k, self.percent
        schema = "id bigint, n bigint, tokens array<bigint>"
        prefix = first.select("id", "n", F.slice("tokens", F.lit(1), F.col("p")).alias("tokens"))
        hot = prefix.select(F.explode("tokens").alias("token")).groupBy("token").count().where(F.col("count") >= self.hot_count).orderBy(F.desc("count"), "token").limit(HOT_TOKENS)
        hot = np.sort(np.array([r[0] for r in hot.select("token").collect()], np.int64).view(np.uint64))
        if len(hot):
            sent = spark.sparkContext.broadcast(hot)
            again = tables.write(first.select("id", "n", "p", "tokens").mapInArrow(lambda it: reordered(it, sent), schema), "prefixes")
            tables.drop(first)
            wanted = tables.write(again.where("tokens is null").select("id").join(classes, "id"), "wanted")
            whole = self.texts_of(wanted, texts).mapInArrow(lambda it: prefix_batches(set_batches(it, k), percent, sent), schema).dropDuplicates(["id"])
            first, prefix = again, again.where("tokens is not null").union(whole)
        tokens = tables.write(prefix.select("id", "n", F.posexplode("tokens").alias("at", "token")), "tokens")
        tables.drop(first)
        often = tokens.groupBy("token").agg(F.count("*").alias("members")).where("members > 1").select("token")
        out = tables.write(tokens.join(often, "token", "left_semi"), "shared")
        tables.drop(tokens)
        return out

    def heads(self, shared: DataFrame) -> DataFrame:
        """Rows (head, head_n, head_at, band, id, n, at, own, members): the members of each node (token, band) with its head. A member is in the node of its own band and in the next one."""
        band = F.floor(F.log("n") / self.band)
        keyed = shared.withColumn("of", band).withColumn("band", F.explode(F.array(F.col("of"), F.col("of") + 1))).withColumn("own", F.col("of") == F.col("band"))
        least = F.min(F.when(F.col("own"), F.struct(F.xxhash64("id").alias("hash"), "id", "n", "at"))).alias("least")
        cells = keyed.groupBy("token", "band").agg(F.count("*").alias("members"), least).where("members > 1 and least is not null")
        cells = cells.select("token", "band", "members", F.col("least.id").alias("head"), F.col("least.n").alias("head_n"), F.col("least.at").alias("head_at"))
        return keyed.join(cells, ["token", "band"]).where("id <> head").select("head", "head_n", "head_at", "band", "id", "n", "at", "own", "members")

    def sieved(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        percent = self.percent
        side = lambda s: nodes.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(lambda it: sieve(it, percent), "a bigint, b bigint")

    def verified(self, pairs: DataFrame, classes: DataFrame, texts: DataFrame, tables: Tables) -> DataFrame:
        """The pairs whose whole sets reach the similarity."""
        wanted = tables.write(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(classes, "id"), "wanted")
        k = self.k
        sets = tables.write(self.texts_of(wanted, texts).mapInArrow(lambda it: set_batches(it, k), "id bigint, set array<bigint>"), "sets")
        side = lambda s: sets.select(F.col("id").alias(s), F.col("set").alias(f"set_{s}"))
        both = F.size(F.array_intersect("set_a", "set_b"))
        out = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * both >= self.percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b")
        out = tables.write(out, "verified")
        tables.drop(sets, wanted)
        return out

    def relabelled(self, label: DataFrame, links: DataFrame, tables: Tables) -> DataFrame:
        """Labels after more links: only the old components that they touch are visited."""
        at = lambda c: label.select(F.col("id").alias(c), F.col("component").alias(f"{c}_of"))
        edges = links.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
        more = components(edges, tables)
        moved = label.join(more.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        return moved.union(more.join(label, "id", "left_anti").select("id", "component"))

    def between(self, groups: DataFrame, nodes: DataFrame, label: DataFrame, tables: Tables, few: bool) -> DataFrame:
        """Pairs of different components in a node that the trees do not rule out; or a few of each large node."""
        percent = self.percent
        now = tables.write(groups.join(label, "id", "left").select("head", "band", "id", "own", F.coalesce("component", "id").alias("component")), "members")
        mixed = now.groupBy("head", "band").agg(F.count("*").alias("members"), F.min("component").alias("c0"), F.max("component").alias("c1"))
        mixed = mixed.where("c0 <> c1").where(F.col("members") > (self.covered if few else 1)).select("head", "band", "members")
        blocks = F.ceil(F.col("members") / self.block).cast("int")
        at = now.join(mixed, ["head", "band"]).join(nodes, "id").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("blocks", blocks)
        each = at.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        each = each.select("head", "band", F.least("block", "to").alias("i"), F.greatest("block", "to").alias("j"), "block", "own", "id", "component", "n", "bits")
        dealt = each.repartition("head", "band", "i", "j").sortWithinPartitions("head", "band", "i", "j", "id")
        out = tables.write(dealt.mapInArrow(lambda it: candidate_batches(it, percent, few), "a bigint, b bigint").distinct(), "between")
        tables.drop(now)
        return out


def near_duplicates(docs: DataFrame, k: int = 5, similarity: str = "0.8") -> DataFrame:
    """doc_id, n_shingles, component_id of each document; see JaccardJoin."""
    return JaccardJoin(k, similarity).run(docs)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity of 0.9 or more, over all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, "0.9")


OP10_SQL = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, list_distinct(case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
n as (select doc_id, len(s) as n from s),
e as (select doc_id, unnest(s) as x from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as common from e a join e b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2),
l as (select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b where 100 * common >= 90 * (x.n + y.n - common)),
r as (select doc_id, doc_id as seen from n union select r.doc_id, l.b from r join l on l.a = r.seen)
select n.doc_id, cast(n.n as bigint) as n_shingles, min(r.seen) as component_id from n join r using (doc_id) group by 1, 2
"""
