"""Mixing documents to target weights by soft membership (operator 5).

A classifier, fitted on a labelled table, gives each document's posterior over domains. A document's rate is how often it is
to be taken; rates are nonnegative and their expected token totals by domain are to match the targets. They are fitted by
accelerated projected gradient from rates of 1: least squares of the totals' errors, weighted by the inverse of the domains' matrix of
joint totals, in the metric of token counts, where all curvatures are about 1 and a step of 1 is right. A
rate's path depends on its own posterior and on the few residual vectors so far, so a turn is one pass that returns one total
a domain, and no rates are stored or gathered. Turns go on until the totals are within ``TOLERANCE`` of the targets or come no nearer;
what is left is reported with the rates as ``residual``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import Tables, bounded_batches, tidy

#: Labelled rows that the classifier is fitted on, at most, in the order of a hash of doc_id; its hashed words, so its weights are of one size.
MAX_ROWS, WORDS = 4000, 4096
#: Largest miss of a domain's total, as a share of all tokens, that counts as met; turns without a miss smaller by a hundredth that end the fit.
TOLERANCE, PATIENCE = 1e-3, 12
#: Domains of the labelled table and the shares of tokens that the query asks for.
TARGETS = {"en": 0.50, "de": 0.20, "fr": 0.15, "es": 0.10, "poor": 0.05}
STATS = 8


class Buckets(dict):
    """Words to hashed features."""

    def __missing__(self, word: str) -> int:
        b = STATS + xxhash.xxh3_64_intdigest(word) % WORDS
        if len(self) < 100_000:
            self[word] = b
        return b


def features(text: str, buckets: Buckets) -> tuple[np.ndarray, np.ndarray, int]:
    """Columns and values of a document, and its tokens (words between white space)."""
    words = text.lower().split()
    n = len(words)
    at = np.unique(np.fromiter(map(buckets.__getitem__, words), np.int64, n)) if n else np.empty(0, np.int64)
    chars = max(1, len(text))
    distinct = len(set(words)) / max(1, n)
    signs = len(text.encode("ascii", "ignore").translate(None, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 \n")) / chars
    upper = len(text.encode("ascii", "ignore").translate(None, bytes(set(range(256)) - set(range(65, 91))))) / chars
    digits = len(text.encode("ascii", "ignore").translate(None, bytes(set(range(256)) - set(range(48, 58))))) / chars
    lines = text.split("\n")
    stats = [1.0, np.log1p(n) / 8, distinct * 3, min(signs, 0.3) * 10, min(upper, 0.5) * 6, min(digits, 0.3) * 10, 3 * len(set(lines)) / len(lines), chars / max(1, n) / 8]
    return np.concatenate([np.arange(STATS), at]), np.concatenate([stats, np.full(len(at), 1 / np.sqrt(max(1, len(at))))]), n


def fit_softmax(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, steps: int = 250, shrink: float = 1e-4) -> np.ndarray:
    """Weights (features, classes) by accelerated gradient steps, on a dense matrix: rows and features are bounded."""
    x = np.zeros((len(rows), STATS + WORDS), np.float32)
    for of, (at, value) in enumerate(rows):
        x[of, at] = value
    truth = np.eye(classes, dtype=np.float32)[y]
    w = v = np.zeros((x.shape[1], classes), np.float32)
    rate = np.float32(2.0 / max((r[1] ** 2).sum() for r in rows))
    for t in range(1, steps + 1):
        z = x @ v
        z = np.exp(z - z.max(1, keepdims=True))
        grad = x.T @ (z / z.sum(1, keepdims=True) - truth) / len(rows) + shrink * v
        new = (v - rate * grad).astype(np.float32)
        v = new + np.float32((t - 1) / (t + 2)) * (new - w)
        w = new
    return w.astype(np.float64)


def train(docs: DataFrame, labelled: DataFrame, domains: list[str], max_rows: int = MAX_ROWS) -> np.ndarray:
    """``labelled``: doc_id, domain. Without a labelled row posteriors are uniform; of rows that repeat a doc_id the least domain and text count."""
    tables = Tables(docs.sparkSession)
    rows = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), "domain").where("doc_id is not null").where(F.col("domain").isin(domains))
    rows = rows.groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = tables.write(rows, "domain-rows")

    def sparse(batches):
        buckets = Buckets()
        for batch in batches:
            got = [features(t or "", buckets)[:2] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([g[0].astype(np.int32) for g in got], pa.list_(pa.int32())), pa.array([g[1].astype(np.float32) for g in got], pa.list_(pa.float32()))], ["domain", "at", "value"])

    bounded_batches(docs.sparkSession)
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(rows), "doc_id")  # at most max_rows
    text = text.groupBy("doc_id", "domain").agg(F.min("text").alias("text")).select("text", "domain")
    got = text.mapInArrow(sparse, "domain string, at array<int>, value array<float>").toPandas()
    if not len(got):
        return np.zeros((STATS + WORDS, len(domains)))
    return fit_softmax([(np.asarray(a, np.int64), np.asarray(v, np.float64)) for a, v in zip(got["at"], got["value"], strict=True)], np.array([domains.index(d) for d in got["domain"]]), len(domains))


@tidy
def member_batches(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    buckets = Buckets()
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            piece = batch.slice(lo, 1000)
            tokens, posterior = [], []
            for text in piece.column(2).to_pylist():
                at, value, n = features(text or "", buckets)
                z = value @ weights[at]
                z = np.exp(z - z.max())
                tokens.append(n)
                posterior.append(z / z.sum())
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(tokens, pa.int64()), pa.array(posterior, pa.list_(pa.float64()))], ["doc_id", "row", "n_tokens", "posterior"])


def rates(posterior: np.ndarray, steps: list[tuple[np.ndarray, float]], ahead: bool = False) -> np.ndarray:
    """Rates after the steps (gradient by domain, momentum); ``ahead``: at the point where the next gradient is taken."""
    r = y = np.ones(len(posterior))
    for gradient, momentum in steps:
        new = np.maximum(0.0, y - posterior @ gradient)
        y = new + momentum * (new - r)
        r = new
    return y if ahead else r


def posteriors(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = batch.column(name).flatten().to_numpy()
    return values.reshape(batch.num_rows, -1)


def fit_rates(members: DataFrame, shares: np.ndarray, tolerance: float = TOLERANCE, patience: int = PATIENCE) -> tuple[list[tuple[np.ndarray, float]], float]:
    """The steps that take all rates from 1 to their fitted values, and the residual that they leave."""
    k = len(shares)

    def summed(of_batch, size: int) -> np.ndarray:
        """The sum over all batches of an array of ``size`` numbers."""

        def add(batches):
            out = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    out += of_batch(posteriors(batch, "posterior"), batch.column("n_tokens").to_numpy().astype(float)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], ["total"])

        found = members.select("n_tokens", "posterior").mapInArrow(add, "total array<double>")  # a row a task
        return np.array([x or 0.0 for x in found.agg(*[F.sum(F.col("total")[i]) for i in range(size)]).first()])

    def totals(steps):
        return summed(lambda p, t: np.stack([(t * rates(p, steps, ahead)) @ p for ahead in (False, True)]), 2 * k).reshape(2, k)

    steps: list[tuple[np.ndarray, float]] = []
    start = totals(steps)[0]
    whole = start.sum()
    if not whole:
        return steps, 0.0
    goal = shares / shares.sum() * whole
    metric = np.linalg.inv(summed(lambda p, t: (p.T * t) @ p, k * k).reshape(k, k) + 1e-3 * whole * np.eye(k))
    best, best_turn, least, turn = 0, 0, np.inf, 0
    while True:
        turn += 1
        now, ahead = totals(steps)
        residual = float(np.abs(now - goal).max() / whole)
        if residual < 0.99 * least:
            best, best_turn, least = len(steps), turn, residual
        if least <= tolerance or turn - best_turn >= patience:
            return steps[:best], least
        steps.append((metric @ (ahead - goal), (turn - 1) / (turn + 2)))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, keep: list[str] = ()) -> DataFrame:
    """doc_id, n_tokens, posterior (in the order of sorted domains), rate and residual of each row; ``keep`` names columns to hold on to in ``row``.

    ``residual``, the same in all rows, is the largest miss of a domain's expected total as a share of all tokens. Defined results: null and empty
    texts have no tokens, hence no weight, but a posterior and a rate; texts of any length count whole; a domain that no document
    belongs to stays short of its target, which the residual tells; equal texts have equal rates; rows that repeat are rows of their own; a null doc_id is kept; an
    empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    domains = sorted(targets)
    weights = spark.sparkContext.broadcast(train(docs, labelled, domains))
    row = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(0)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row.alias("row"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    members = rows.mapInArrow(lambda it: member_batches(it, weights.value), f"doc_id bigint, row {kind}, n_tokens bigint, posterior array<double>")
    members = Tables(spark).write(members, "members")
    steps, residual = fit_rates(members, np.array([targets[d] for d in domains]))

    def rated(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates(posteriors(batch, "posterior"), steps))], [*batch.schema.names, "rate"])

    return members.mapInArrow(rated, f"doc_id bigint, row {kind}, n_tokens bigint, posterior array<double>, rate double").withColumn("residual", F.lit(residual))


def copies(rate, doc_id):
    """Column: whole copies that a rate stands for, rounded by a hash of doc_id, so that they are right in expectation."""
    part = F.pmod(F.xxhash64(doc_id, F.lit("copies")), F.lit(1 << 20)) / (1 << 20)
    return (F.floor(rate) + (part < rate - F.floor(rate)).cast("bigint")).cast("int")


def label_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled table of domains: the language of a labelled document of good quality, ``poor`` for one of poor quality."""
    of = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").where("quality in (0, 1)")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang").join(of, "doc_id").select("doc_id", F.when(F.col("quality") == 1, F.col("lang")).otherwise("poor").alias("domain"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; domains are languages and poor quality."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = mixed(docs, label_domains(docs, labels))
    return out.select("doc_id", "n_tokens", *[F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(sorted(TARGETS))], "rate", "residual")
