"""Toxicity with noisy-channel deobfuscation (operator 8).

Writers hide words: leetspeak, letters spaced out, letters repeated. Each such piece of a text becomes a lattice of the
letters that it may stand for, where a space between single letters may end a word or mean nothing; a Viterbi search finds the reading of
least cost under a character trigram model and the channel's costs. A piece without any sign or repetition has a single path, so
only the others are searched, whatever their length. The restored words are then scored by a logistic model over words and word beginnings.

The character model counts all documents. The logistic model is fitted on labelled rows, at most ``MAX_ROWS`` of them, in an order that
a hash of doc_id gives, with at most ``MAX_FEATURES`` features.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import Tables, bounded_batches, release, tidy

MAX_ROWS, MAX_FEATURES = 6000, 2000
#: Word beginnings that are features.
BEGINNINGS = (4, 5, 6, 7)
#: The letters that signs are used for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou"}
#: Costs in nats: a sign for a letter, a letter repeated, a sign that means nothing.
SIGN, REPEAT, NOTHING = 1.0, 2.0, 8.0
#: Cost of a space between spaced letters that ends a word.
BOUNDARY = 1.0
#: Costs of a sign at a word's edge that means nothing: any, and an exclamation mark or the like at the end.
EDGE_NOTHING, MARK = 4.0, 0.5
#: Cost of a digit of a piece without a letter that is meant as it is written; another sign costs ``NOTHING``.
DIGIT = 2.5
#: A trigram below this share of all counts as unseen: the model has 1 / LEAST_SHARE trigrams at most.
LEAST_SHARE = 2e-6
#: Words that a task counts before it passes trigrams on.
HELD_WORDS = 200_000
_SPACED = re.compile(r"(?<![^\s.,;:!?\"'])[^\W_](?:[ ._*-]{1,2}[\w@$!|+]){2,}(?![\w@$!|+])")
_REPEAT = re.compile(r"([^\W\d_])\1")
_RUN = re.compile(r"(.)\1+")
_SIGN = re.compile(r"[0-9@$!|+(€£*]")
_EDGE = ".,;:?\"'()[]{}<>#%&*-_=/\\~`^«»„“”…"
_JOIN = re.compile(r"[ ._*-]+")


def decode(piece: str, model: dict[str, float]) -> tuple[str, float]:
    """The reading of least cost, and that cost. ``model``: costs of trigrams, and of the others under an empty key. A space in the piece is the end of a word or nothing."""
    lattice: list[list[tuple[str, float]]] = []
    letter, left = "", len(piece)
    inside = [i for i, c in enumerate(piece) if c.isalpha()]
    for c, run in groupby(piece):
        size = len(list(run))
        start = len(piece) - left
        left -= size
        if c == " ":
            lattice.append([("", 0.0), (" ", BOUNDARY)])
            continue
        if c.isalpha():
            options = [(c * size, 0.0)]
            if size > 1:
                options.append((c, REPEAT))
            if size > 2:
                options.append((c * 2, REPEAT))
            if c == letter:  # the same letter before a space
                options.append(("", REPEAT))
        else:
            edge = bool(inside) and not inside[0] < start < inside[-1]
            none = NOTHING if not edge else MARK if c in "!|+" and start > inside[-1] else EDGE_NOTHING
            options = [("", none)] + [(x * k, SIGN * k + REPEAT * (k != size)) for x in LEET.get(c, "") for k in {1, min(size, 2)}]
        letter = c
        lattice.append(options)
    other = model[""]
    # A state's reading is a chain of (before, letters), so that a step does not copy it.
    best: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
    for options in [*lattice, [(" ", 0.0)]]:
        now: dict[str, tuple[float, tuple | None]] = {}
        for state, (cost, text) in best.items():
            for letters, price in options:
                s, total = state, cost + price
                for x in letters:
                    total += model.get(s + x, other)
                    s = "  " if x == " " else s[1] + x
                if s not in now or total < now[s][0]:
                    now[s] = (total, (text, letters) if letters else text)
        best = now
    cost, text = min(best.values(), key=lambda v: v[0])
    out = []
    while text:
        text, letters = text
        out.append(letters)
    return "".join(reversed(out)).strip(), cost


class Restorer(dict):
    """Words as written to words as meant; keeps those it meets, up to a number."""

    def __init__(self, model: dict[str, float], room: int = 200_000):
        super().__init__()
        self.model, self.room = model, room

    def __missing__(self, word: str) -> str:
        w = word.lower().strip(_EDGE)
        if not w.isdigit() and (_SIGN.search(w) or _REPEAT.search(w)):
            read, cost = decode(w, self.model)
            # Without a letter it may be a number or a sign.
            if any(map(str.isalpha, w)) or cost < sum(DIGIT if c.isdigit() else NOTHING for c in w):
                w = read
        if len(self) < self.room:
            self[word] = w
        return w

    def words(self, text: str) -> list[str]:
        out = [self[w] for w in text.split()]
        for m in _SPACED.finditer(text):
            out.append(self[_JOIN.sub("", m[0])])
            out += [self[w] for w in decode(_JOIN.sub(" ", m[0].lower()), self.model)[0].split()]
        return out


def features(words: list[str]) -> set[str]:
    distinct = set(words)
    distinct.discard("")
    return {f"={w}" for w in distinct} | {f"{w[:k]}" for w in distinct for k in BEGINNINGS if len(w) > k}


def trigram_costs(counts: dict[str, int]) -> dict[str, float]:
    before: Counter = Counter()
    for t, n in counts.items():
        before[t[:2]] += n
    letters = len({t[2] for t in counts}) + 1
    out = {t: -math.log((n + 0.05) / (before[t[:2]] + 0.05 * letters)) for t, n in counts.items()}
    out[""] = -math.log(0.05 / (0.05 * letters + 20))
    return out


class Model:
    """Character costs, and weights of features."""

    def __init__(self, costs: dict[str, float], weights: dict[str, float], bias: float):
        self.costs, self.weights, self.bias = costs, weights, bias


def trigrams_of(words: list[tuple[str, int]]) -> pa.RecordBatch:
    """Counts of the trigrams of words with counts. All words one after another are code points, each word with its boundaries; three of them make a number."""
    sizes = np.fromiter((len(w) + 3 for w, _ in words), np.int64, len(words))
    c = np.frombuffer("".join([f"  {w} " for w, _ in words]).encode("utf-32-le"), np.uint32).astype(np.int64)
    starts = np.flatnonzero(np.arange(len(c)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < np.repeat(sizes - 2, sizes))
    codes, at = np.unique((c[starts] << 42) | (c[starts + 1] << 21) | c[starts + 2], return_inverse=True)
    counts = np.bincount(at, np.repeat([n for _, n in words], sizes - 2), len(codes)).astype(np.int64)
    found = ["".join(map(chr, (x >> 42, x >> 21 & 0x1FFFFF, x & 0x1FFFFF))) for x in codes.tolist()]
    return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(counts, pa.int64())], ["t", "n"])


@tidy
def trigram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the trigrams of all words that are letters alone; a word counts once a document, so that no document outweighs the others."""
    words: dict[str, int] = defaultdict(int)

    def flush() -> Iterator[pa.RecordBatch]:
        kept = [(x, n) for w, n in words.items() if (x := w.lower().strip(_EDGE)).isalpha()]
        words.clear()
        for lo in range(0, len(kept), 40_000):
            yield trigrams_of(kept[lo : lo + 40_000])

    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            split = pc.utf8_split_whitespace(batch.column(0).slice(lo, 500).fill_null(""))
            found = split.flatten().dictionary_encode()
            if not len(found.dictionary):
                continue
            of = np.repeat(np.arange(len(split)), np.diff(np.asarray(split.offsets)))
            each = np.unique(of * len(found.dictionary) + found.indices.to_numpy()) % len(found.dictionary)
            distinct = pc.binary_join(pa.ListArray.from_arrays([0, len(found.dictionary)], found.dictionary), " ")[0].as_py().split(" ")
            for w, n in zip(distinct, np.bincount(each, minlength=len(found.dictionary)).tolist(), strict=True):
                words[w] += n
            if len(words) > HELD_WORDS:
                yield from flush()
        release()
    yield from flush()


def trigrams(docs: DataFrame) -> dict[str, int]:
    """Trigrams of all documents with at least ``LEAST_SHARE`` of the counts."""
    tables = Tables(docs.sparkSession)
    counts = tables.write(docs.select(F.col("text").cast("string").alias("text")).mapInArrow(trigram_batches, "t string, n bigint").groupBy("t").agg(F.sum("n").alias("n")), "trigrams")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = {r["t"]: r["n"] for r in counts.where(F.col("n") >= LEAST_SHARE * total).collect()}
    tables.drop(counts)
    return out


@tidy
def feature_counts(batches: Iterator[pa.RecordBatch], costs: dict[str, float]) -> Iterator[pa.RecordBatch]:
    restorer = Restorer(costs)
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        names = list(counts[0] | counts[1])
        columns = [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in counts)]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, ["feature", "n0", "n1"])

    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[y].update(features(restorer.words(text)))
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield flush()
    yield flush()


@tidy
def chosen_batches(batches: Iterator[pa.RecordBatch], costs: dict[str, float], names: dict[str, int]) -> Iterator[pa.RecordBatch]:
    restorer = Restorer(costs)
    for batch in batches:
        out = [[names[f] for f in features(restorer.words(t)) if f in names] for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["y", "at"])


def fit_logistic(rows: list[list[int]], y: np.ndarray, size: int, steps: int = 400, shrink: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps."""
    at = np.fromiter((x for r in rows for x in r), np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w = v = np.zeros(size + 1)
    u, norm = np.ones(size + 1), 1.0
    for _ in range(12):  # the largest curvature, by power iteration
        z = u[-1] + np.bincount(of, u[at], len(rows))
        u = np.append(np.bincount(at, z[of], size), z.sum())
        norm = np.linalg.norm(u) or 1.0
        u /= norm
    rate = 3.6 * max(1, len(rows)) / norm
    for t in range(1, steps + 1):
        z = v[-1] + np.bincount(of, v[at], len(rows))
        g = 1 / (1 + np.exp(-z)) - y
        grad = np.append(np.bincount(at, g[of], size), g.sum()) / max(1, len(rows)) + shrink * np.append(v[:-1], 0)
        new = v - rate * grad
        v = new + (t - 1) / (t + 2) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labelled: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """``labelled``: doc_id, toxic. Rows with a null in either are left out; of rows that repeat a doc_id the largest label holds, and the least text. Without rows of both kinds the score is their share."""
    spark = docs.sparkSession
    bounded_batches(spark)
    tables = Tables(spark)
    rows = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = tables.write(rows, "toxic-rows")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    sample = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).join(F.broadcast(rows), "doc_id")  # at most max_rows
    sample = tables.write(sample.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y").repartition(12), "toxic-sample")
    costs = trigram_costs(trigrams(docs))
    total = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    clean, toxic = total.get(0, 0), total.get(1, 0)
    if not clean or not toxic:
        return Model(costs, {}, math.log((toxic + 0.5) / (clean + 0.5)) if clean + toxic else -2.0)
    found = sample.mapInArrow(lambda it: feature_counts(it, costs), "feature string, n0 bigint, n1 bigint").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    share1, share0 = (F.col("n1") + 0.1) / (toxic + 0.2), (F.col("n0") + 0.1) / (clean + 0.2)
    gain = F.col("n1") * F.log(share1 / share0)
    found = found.where(f"n1 >= {max(2, toxic // 100)}").where(share1 > 5 * share0).orderBy(F.desc(gain), "feature").limit(MAX_FEATURES)
    names = {r["feature"]: i for i, r in enumerate(found.collect())}
    rows = sample.mapInArrow(lambda it: chosen_batches(it, costs, names), "y int, at array<int>").collect()
    weights, bias = fit_logistic([r["at"] for r in rows], np.array([r["y"] for r in rows], float), len(names))
    tables.drop(sample)
    return Model(costs, {f: float(weights[i]) for f, i in names.items()}, bias)


@tidy
def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    weights, bias = model.weights, model.bias
    # All readings of a word of letters alone have its letters, repetitions aside, so most words can have no feature in any reading.
    whole = {_RUN.sub(r"\1", f[1:]) for f in weights if f[0] == "="}
    begun = {_RUN.sub(r"\1", f) for f in weights if f[0] != "="}
    sizes = sorted({len(x) for x in begun})

    class Found(Restorer):
        """Words to the features that have a weight."""

        def __missing__(self, word: str) -> tuple:
            w = word.lower().strip(_EDGE)
            if w.isalpha() and (c := _RUN.sub(r"\1", w)) not in whole and not any(c[:k] in begun for k in sizes):
                if len(self) < self.room:
                    self[word] = ()
                return ()
            w = restorer.__missing__(word)
            found = tuple(f for f in ("=" + w, *(w[:k] for k in BEGINNINGS if len(w) > k)) if f in weights)
            if len(self) < self.room:
                self[word] = found
            return found

    restorer = Restorer(model.costs, 0)
    found = Found(model.costs)
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            piece = batch.slice(lo, 1000)
            scores = []
            for text in piece.column("text").to_pylist():
                seen = {f for fs in set(found.words(text)) for f in fs}
                scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, bias + sum(weights[f] for f in seen))))))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("row"), pa.array(scores, pa.float64())], ["doc_id", "row", "score"])


def scored(docs: DataFrame, model: Model, keep: list[str] = ()) -> DataFrame:
    """Each row's doc_id and score, from its whole text alone; ``keep`` names columns of docs to hold on to.

    Defined results: a null text is empty, and an empty text has the score of no word; texts of any length count whole, in time that grows
    with the length; rows that repeat or have a null doc_id are each scored, equal texts alike; an empty table gives no rows; further columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(0)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row.alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(lambda it: score_batches(it, sent.value), f"doc_id bigint, row {kind}, score double")


def held_out(doc_id):
    """Column: the row's labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by what rows outside the held-out fifth teach."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    out = scored(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
