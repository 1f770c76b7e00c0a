"""Secret scans (operator 4). DataFrame functions only.

Base patterns give spans; two first-order Markov models over single characters, of random strings and of ordinary identifiers, judge the
other long runs of key characters by their log-likelihood ratio a transition, over all transitions. The models are trained from labelled
samples (token, secret).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import Tables

#: Kind, pattern, group whose length counts, least length; in the order of kinds.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Runs that the models judge, their least length; ordinary words and identifiers in samples.
RUN, LEAST, NAME = r"[A-Za-z0-9+/_=-]{20,}", 20, r"[A-Za-z_][A-Za-z_/=+-]{7,}|[A-Za-z_][A-Za-z0-9_]{7,}"
#: Characters of the models, each a state of its own.
CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/=_-."
#: Weight of the characters' own shares in a state's transitions, and of equal shares in those; share of ordinary transitions that repeat a character.
BACK_OFF, EQUAL, REPEAT = 20.0, 68.0, 0.2
#: Documents that samples are drawn from where none are given, at most; generated random strings of each alphabet; nats a transition.
MAX_DOCS, GENERATED, LEAST_RATIO = 5000, 2000, 1.5
#: Elements of an array that are summed up, or passed over, at once.
GROUP_BITS = 8
GROUP = 1 << GROUP_BITS


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda would compute what it captures again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def located(text: Column, pattern: str, group: int) -> Column:
    """All leftmost non-overlapping matches as structs (start, end, part) in code points, part being the group's text.

    The texts between matches and the matches themselves add up to the places. Lengths are summed by groups of matches first, so that a
    text of very many matches takes no step for each pair of them.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    total = lambda lengths: F.aggregate(lengths, F.lit(0), lambda a, x: a + x)

    def placed(s: Column) -> Column:
        grouped = F.transform(groups(F.size(s["lengths"])), lambda g: total(F.slice(s["lengths"], g * GROUP + 1, F.lit(GROUP))))
        before = lambda sums, i: total(F.slice(sums, F.lit(1), F.shiftright(i, GROUP_BITS))) + total(F.slice(s["lengths"], i - i.bitwiseAND(GROUP - 1) + 1, i.bitwiseAND(GROUP - 1)))
        starts = let(grouped, lambda sums: F.transform(s["between"], lambda x, i: before(sums, i) + F.length(x)))
        return let(starts, lambda at: F.transform(s["found"], lambda m, i: F.struct(F.get(at, i).alias("start"), (F.get(at, i) + F.length(m)).alias("end"), F.get(s["part"], i).alias("part"))))

    lengths = lambda s: F.zip_with(s["found"], F.slice(s["between"], F.lit(1), F.size(s["found"])), lambda m, x: F.length(m) + F.length(x))
    whole = let(F.struct(found.alias("found"), between.alias("between"), part.alias("part")), lambda s: F.struct(s["found"].alias("found"), s["between"].alias("between"), s["part"].alias("part"), lengths(s).alias("lengths")))
    return let(whole, placed)


def groups(size: Column) -> Column:
    """Numbers of the groups of ``GROUP`` that ``size`` elements make; one for none."""
    return F.sequence(F.lit(0), F.shiftright(size, GROUP_BITS))


def spans(text: Column, kind: str, number: int, pattern: str, group: int, least: int) -> Column:
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string,part:string>>")
    kept = F.filter(located(text, pattern, group), lambda m: F.length(m["part"]) >= least)
    full = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("number"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["part"].alias("part")))
    return F.when(F.rlike(text, F.lit(pattern)), full).otherwise(none)


def pairs_of(word: Column) -> Column:
    """All pairs of neighbours, those at even places first."""
    every_other = lambda w: F.regexp_extract_all(w, F.lit("(?s).."), F.lit(0))
    return F.concat(every_other(word), every_other(F.substr(word, F.lit(2))))


def counted(samples: DataFrame) -> DataFrame:
    """Counts of the pairs of neighbours of (token, secret)."""
    pair = F.explode(pairs_of(F.col("token")))
    return samples.where(F.length("token") > 1).select("secret", pair.alias("pair")).groupBy("secret", "pair").count()


def ratios(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of all transitions, random strings over identifiers: a table of one size, whatever the samples."""
    known = F.translate("pair", CHARS, "") == ""
    counts = {(bool(r["secret"]), r["pair"]): r["count"] for r in counted(samples.where("secret is not null")).where(known & (F.length("pair") == 2)).collect()}

    def chain(secret: bool) -> dict[str, float]:
        of = {a + b: counts.get((secret, a + b), 0) for a in CHARS for b in CHARS}
        total, ends = sum(of.values()), {b: sum(of[a + b] for a in CHARS) for b in CHARS}
        share = {b: (ends[b] + EQUAL / len(CHARS)) / (total + EQUAL) for b in CHARS}
        return {a + b: (of[a + b] + BACK_OFF * share[b]) / (sum(of[a + x] for x in CHARS) + BACK_OFF) for a in CHARS for b in CHARS}

    random, ordinary = chain(True), chain(False)
    return [math.log(random[a + b] / ((1 - REPEAT) * ordinary[a + b] + REPEAT * (a == b))) for a in CHARS for b in CHARS]


def ratio(token: Column, table: list[float]) -> Column:
    """The token's log-likelihood ratio a transition; all its characters must be in ``CHARS``."""
    known = F.array(*map(F.lit, table))
    at = lambda pair, i: F.position(F.substr(pair, F.lit(i), F.lit(1)), F.lit(CHARS))
    value = lambda p: F.get(known, (at(p, 1) - 1) * len(CHARS) + at(p, 2) - 1)
    return F.aggregate(pairs_of(token), F.lit(0.0), lambda a, p: a + value(p)) / F.greatest(F.length(token) - 1, F.lit(1))


def untouched(found: Column, base: Column) -> Column:
    """What base spans leave of the spans ``found``: their parts of ``LEAST`` characters and more. Base spans are in order, so most groups of them are passed over whole."""
    group = lambda part: F.struct(F.array_min(F.transform(part, lambda s: s["start"])).alias("start"), F.array_max(F.transform(part, lambda s: s["end"])).alias("end"), part.alias("spans"))
    meet = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    touching = lambda of, m: F.flatten(F.transform(F.filter(of, lambda g: meet(g, m)), lambda g: F.filter(g["spans"], lambda b: meet(b, m))))

    def parts(m: Column, spans: Column) -> Column:
        piece = lambda low, high: F.struct(low.alias("start"), m["number"].alias("number"), high.alias("end"), m["kind"].alias("kind"), F.substr(m["part"], low - m["start"] + 1, high - low).alias("part"))
        low = lambda i: F.greatest(m["start"], F.coalesce(F.array_max(F.transform(F.slice(spans, F.lit(1), i), lambda s: s["end"])), F.lit(0)))
        high = lambda i: F.coalesce(F.get(spans, i)["start"], m["end"])
        cuts = F.filter(F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.struct(low(i).alias("low"), high(i).alias("high"))), lambda c: c["high"] - c["low"] >= LEAST)
        return F.when(F.size(spans) == 0, F.array(m)).otherwise(F.transform(cuts, lambda c: piece(c["low"], c["high"])))

    grouped = F.transform(groups(F.size(base)), lambda g: let(F.slice(base, g * GROUP + 1, F.lit(GROUP)), group))
    return let(grouped, lambda of: F.flatten(F.transform(found, lambda m: let(touching(of, m), lambda spans: parts(m, spans)))))


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(*[spans(text, kind, i, pattern, group, least) for i, (kind, pattern, group, least) in enumerate(BASE)]))


def generated(spark: SparkSession, rows: int = GENERATED) -> DataFrame:
    """Random strings (token, secret) of three alphabets: base64, hexadecimal digits, upper-case letters and digits."""
    ids = spark.range(rows)
    digest = lambda salt: F.sha2(F.concat(F.col("id").cast("string"), F.lit(salt)), 256)
    mixed = F.base64(F.unhex(digest("mixed")))
    upper = F.upper(F.regexp_replace(F.base64(F.unhex(digest("upper"))), r"[^A-Za-z0-9]", ""))
    return ids.select(F.explode(F.array(F.substr(mixed, F.lit(1), F.lit(40)), F.substr(digest("hex"), F.lit(1), F.lit(40)), upper)).alias("token"), F.lit(True).alias("secret"))


def samples_from(docs: DataFrame, tables: Tables, max_docs: int = MAX_DOCS) -> DataFrame:
    """Labelled samples (token, secret) where none are given: generated random strings, and ordinary words and identifiers of at most ``max_docs`` documents without a base span."""
    ids = tables.write(docs.select("doc_id").where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs), "sample-ids")
    # Written, as a filter on what explode() gets would be moved below the join and scan every document.
    some = tables.write(docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text").limit(max_docs), "sample-texts").withColumn("base", base_spans(F.col("text")))
    plain = F.regexp_extract_all(F.regexp_replace("text", RUN, " "), F.lit(NAME), F.lit(0))
    return generated(docs.sparkSession).union(some.where(F.size("base") == 0).select(F.explode(plain).alias("token"), F.lit(False).alias("secret")))


def scan(docs: DataFrame, samples: DataFrame | None = None, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """doc_id and spans, an array of (start, number, end, kind, part) in order, of each row of ``docs`` (doc_id, text).

    Base spans all stay; a run of key characters, or what base spans leave of it, is a ``random`` span where the models' log-likelihood
    ratio a transition reaches ``least_ratio``. ``samples``: labelled (token, secret); rows with a null in either are left out. Defined results: null texts
    are empty and have no spans; texts of any length are scanned whole; rows that repeat or have a null doc_id are each scanned; spans of one start are in the order of
    kinds; an empty table gives no rows; further columns are ignored.
    """
    tables = Tables(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    table = ratios(samples_from(rows, tables) if samples is None else samples)
    text, base = F.col("text"), F.col("base")
    free = F.filter(untouched(spans(text, "random", len(BASE), RUN, 0, LEAST), base), lambda m: ratio(m["part"], table) >= least_ratio)
    return rows.withColumn("base", base_spans(text)).select("doc_id", "base", F.array_sort(F.concat("base", free)).alias("spans"))


def listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(kind) for kind, *_ in BASE], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
