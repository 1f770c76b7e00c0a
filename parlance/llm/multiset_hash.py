"""Homomorphic multiset hashes of documents (operator 3).

A paragraph (a line) hashes to a wide vector; a document's fingerprint is the sum of its paragraphs' vectors modulo
2^16 a lane. So the order of paragraphs does not matter, and a paragraph is inserted or deleted by adding or
subtracting its vector. The vector has two parts:

* ``EXACT`` lanes from a cryptographic hash of the whole paragraph: equal multisets of paragraphs have equal sums, and
  others differ with overwhelming likelihood;
* ``SKETCH`` lanes, a signed count sketch of the paragraph's three-word shingles: the squared length of a difference of
  two sums estimates how many shingles they do not share, hence a likeness.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import WordHashes, bounded_batches, fold, mix64, spread, tidy, word_hashes

EXACT, SKETCH, K = 32, 256, 3
RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def sketch(paragraphs: list[bytes], cache: WordHashes) -> np.ndarray:
    words = [p.split() for p in paragraphs]
    hashes = word_hashes([w for p in words for w in p], cache)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    found = []
    if len(hashes) >= K:
        of = np.repeat(np.arange(len(words)), sizes)
        found.append(fold(hashes, K)[of[: len(of) - K + 1] == of[K - 1 :]])
    ends = np.cumsum(sizes)
    for short in range(1, K):  # a paragraph of fewer words is one shingle
        at = np.flatnonzero(sizes == short)
        if len(at):
            runs = np.stack([hashes[ends[at] - short + i] for i in range(short)])
            out = runs[0]
            for i in range(1, short):
                out = mix64(out) + runs[i]
            found.append(mix64(out + np.uint64(short)))
    if not found:
        return np.zeros(SKETCH, np.uint16)
    h = np.concatenate(found)
    at = np.bincount((h & np.uint64(2 * SKETCH - 1)).astype(np.int64), minlength=2 * SKETCH)
    return (at[:SKETCH] - at[SKETCH:]).astype(np.uint16)


def fingerprint(text: str, cache: WordHashes | None = None) -> np.ndarray:
    """The sum of the vectors of a text's paragraphs; an empty text has none, so its sum is zero."""
    cache = WordHashes() if cache is None else cache
    paragraphs = text.encode().split(b"\n") if text else []
    digests = b"".join(hashlib.blake2b(p, digest_size=2 * EXACT).digest() for p in paragraphs)
    exact = np.frombuffer(digests, "<u2").reshape(-1, EXACT).sum(0, dtype=np.uint16)
    return np.concatenate([exact, sketch(paragraphs, cache)])


def inserted(of: np.ndarray, paragraph: str) -> np.ndarray:
    return of + paragraph_vector(paragraph)


def deleted(of: np.ndarray, paragraph: str) -> np.ndarray:
    return of - paragraph_vector(paragraph)


def paragraph_vector(paragraph: str) -> np.ndarray:
    raw = paragraph.encode()
    exact = np.frombuffer(hashlib.blake2b(raw, digest_size=2 * EXACT).digest(), "<u2")
    return np.concatenate([exact, sketch([raw], WordHashes())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """About the share of shingles, counted in both, that a and b have in common: 1 for equal sums, near 0 for unrelated ones."""
    if (a == b).all():
        return 1.0
    x, y = (v[EXACT:].view(np.int16).astype(np.float64) for v in (a, b))
    d = (a[EXACT:] - b[EXACT:]).view(np.int16).astype(np.float64)
    whole = x @ x + y @ y
    return float(min(1.0, max(0.0, 1 - (d @ d) / whole))) if whole else 0.0


def encoded(of: np.ndarray) -> str:
    return base64.b64encode(of.astype("<u2").tobytes()).decode()


def decoded(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u2")


@tidy
def neighbour_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (part, copy, doc_id, text) in order, each ending in a copy of the document that follows, to RESULT."""
    cache = WordHashes()
    held, rows = None, []
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            piece = batch.slice(lo, 500)
            for part, copy, doc_id, text in zip(*(piece.column(c).to_pylist() for c in ("part", "copy", "doc_id", "text")), strict=True):
                if held is None and copy:
                    continue  # further copies of the following document
                now = (part, doc_id, text, fingerprint(text, cache))
                if held is not None:
                    rows.append(result(held, now, cache))
                held = None if copy else now
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)], [x.split()[0] for x in RESULT.split(", ")])
                rows = []


def result(one: tuple, after: tuple, cache: WordHashes) -> tuple:
    _, doc_id, text, own = one
    cut = len(text) // 3
    edited = text[: len(text) - cut] + after[2][:cut]
    changed = fingerprint(edited, cache)
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), encoded(own), encoded(changed), likeness(own, changed), likeness(own, after[3])


def fingerprints_with_edits(docs: DataFrame) -> DataFrame:
    """RESULT for each document; the next document is the one of the next lower doc_id, after the last the first.

    Documents are dealt by ranges of doc_id, and the first document of each range goes to the range before it too, so
    texts are shuffled once and each task sees every pair of neighbours that it needs.

    Defined results: null texts are empty, and an empty text's fingerprint is the sum of none; texts of any length count whole; a null doc_id
    comes after all others; rows that repeat a doc_id follow one another in order of the lengths of their texts, then of the texts; equal texts have equal fingerprints;
    the only document of a table is its own neighbour; an empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    parts = spread(spark, 2)
    edges = rows.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("at")).first()["at"] or []
    edges = np.unique(np.array(edges, np.int64))

    @F.pandas_udf("int")
    def part_of(key):
        import pandas as pd

        return pd.Series(np.searchsorted(edges, key.to_numpy(), side="right").astype(np.int32))

    heads = sorted(tuple(r) for r in rows.select("key", part_of("key").alias("part")).groupBy("part").agg(F.max("key").alias("head")).collect())
    before = {head: heads[(i + 1) % len(heads)][0] for i, (_, head) in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def parts_of(key):
        import pandas as pd

        own = np.searchsorted(edges, key.to_numpy(), side="right")
        return pd.Series([[int(p), before[k]] if k in before else [int(p)] for p, k in zip(own, key.tolist(), strict=True)])

    dealt = rows.select("doc_id", "text", "key", F.posexplode(parts_of("key")).alias("copy", "part"))
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "copy", F.desc("key"), F.length("text"), "text")
    return dealt.select("part", "copy", "doc_id", "text").mapInArrow(neighbour_batches, RESULT)


def op3_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and their edited texts."""
    return fingerprints_with_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
