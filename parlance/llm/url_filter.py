"""URL filters with propagation over the link graph (operator 9). DataFrame functions only.

Rules decide the urls that they fit. For the others, trust flows along links from trusted hosts, as personalised PageRank over
weighted edges between hosts, and distrust flows against them from blocked hosts: a host's distrust is what a random walk from it
contributes to blocked hosts, so it counts the share of the host's own links and not how many others link to a blocked host. A seed has a
score of 1, a host all of whose links go to a blocked one a distrust of ``DAMPING``. A host is blocked where its distrust reaches
``threshold`` and exceeds its trust.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm.common import Tables

#: (verdict, host, path); the contract's rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Scores are exact to ``TOLERANCE``: what still moves falls by ``DAMPING`` a turn.
DAMPING, THRESHOLD, TOLERANCE = 0.85, 0.4, 1e-4
#: Blocked hosts that are broadcast, at most: 300 bytes each; more are joined by a shuffle.
MAX_SENT = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST, PATH = r"://([^/?#]*)", r"://[^/?#]*([^?#]*)"
LINK = r"""[Hh][Rr][Ee][Ff]\s*=\s*["']?(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#"'\s<>]+)"""


def parts(url):
    """Columns: host and path."""
    take = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return F.translate(take(HOST), UPPER, LOWER), take(PATH)


def fits(host, rule_host: str):
    return (host == rule_host) | host.endswith("." + rule_host)


def by_rule(host, path, rules):
    """Columns: the longest fitting rule and its verdict, else null."""
    rule = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fit = fits(host, h) & path.startswith(p)
        rule = F.when(fit, h + p) if rule is None else rule.when(fit, h + p)
        verdict = F.when(fit, kind) if verdict is None else verdict.when(fit, kind)
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def seeds(host, rules):
    """Column: block for hosts that a rule blocks whole, allow for other hosts of which a rule allows some, else null."""
    blocked = allowed = F.lit(False)
    for kind, h, p in rules:
        if kind == "block" and p == "/":
            blocked = blocked | fits(host, h)
        if kind == "allow":
            allowed = allowed | fits(host, h)
    return F.when(blocked, "block").when(allowed, "allow")


def turns(damping: float) -> int:
    """Turns after which no more than ``TOLERANCE`` of a seed's score can still move."""
    return math.ceil(math.log(TOLERANCE) / math.log(damping))


def propagate(edges: DataFrame, hosts: DataFrame, tables: Tables, damping: float = DAMPING) -> DataFrame:
    """Scores (host, trust, distrust). ``edges``: source, target, weight; ``hosts``: host, seed.

    Each turn moves what the turn before it added, until nothing above the tolerance is left; a score is the sum of its additions.
    """
    total = edges.groupBy("source").agg(F.sum("weight").alias("total"))
    share = edges.join(total, "source").select("source", "target", (F.col("weight") / F.col("total") * damping).alias("share"))
    way = share.select(F.lit("allow").alias("kind"), F.col("source").alias("u"), F.col("target").alias("v"), "share")
    way = way.unionByName(share.select(F.lit("block").alias("kind"), F.col("target").alias("u"), F.col("source").alias("v"), "share"))
    start = hosts.where("seed is not null").select(F.col("seed").alias("kind"), F.col("host").alias("u"), F.lit(1.0).alias("rank"))
    every = start
    if not edges.isEmpty():
        way, now = tables.write(way, "links"), tables.write(start, "seeds")
        every = now
        for _ in range(turns(damping)):
            moved = now.join(way, ["kind", "u"]).groupBy("kind", F.col("v").alias("u")).agg(F.sum(F.col("rank") * F.col("share")).alias("rank"))
            now = tables.write(moved, "ranks")
            if (now.agg(F.max("rank")).first()[0] or 0.0) < TOLERANCE * (1 - damping):
                break
            every = every.unionByName(now)
    score = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))
    return every.groupBy(F.col("u").alias("host")).agg(score("allow").alias("trust"), score("block").alias("distrust"))


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts, counted: pages must have host and html."""
    link = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link")
    links = pages.where("host <> ''").select(F.col("host").alias("source"), link)
    return links.select("source", F.translate("link", UPPER, LOWER).alias("target")).where("source <> target").groupBy("source", "target").agg(F.count("*").cast("double").alias("weight"))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, damping: float = DAMPING) -> DataFrame:
    """page_id, host, path, rule and verdict of each row of ``pages`` (page_id, url, html).

    Defined results: a url that is null or has no ``://`` has an empty host and path, fits no rule and is allowed; a null or empty
    html has no links, one of any length counts whole; rows that repeat or have a null page_id are each judged, and their links count each; of rules of
    one length the first holds; an empty table gives no rows; further columns are ignored.
    """
    tables = Tables(pages.sparkSession)
    host, path = parts(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("html").cast("string").alias("html"))
    edges = tables.write(host_edges(rows), "edges")
    hosts = rows.select("host").union(edges.select("target")).distinct().where("host <> ''").select("host", seeds(F.col("host"), rules).alias("seed"))
    scores = propagate(edges, hosts, tables, damping)
    blocked = scores.where((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))).select(F.col("host").alias("of"), F.lit("block").alias("spread"))
    blocked = tables.write(blocked, "blocked")
    blocked = F.broadcast(blocked) if blocked.count() <= MAX_SENT else blocked
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    out = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule")).join(blocked, F.col("host") == F.col("of"), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "spread", F.lit("allow")).alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages under the contract's rules."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def sql_text(rules=RULES) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    fit = lambda h: f"(host = {quote(h)} or ends_with(host, {quote('.' + h)}))"
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"when {fit(h)} and starts_with(path, {quote(p)}) then {quote(h + p)}" for _, h, p in ranked)
    verdict = " ".join(f"when {fit(h)} and starts_with(path, {quote(p)}) then {quote(k)}" for k, h, p in ranked)
    blocked = " or ".join(fit(h) for k, h, p in rules if k == "block" and p == "/")
    allowed = " or ".join(fit(h) for k, h, _ in rules if k == "allow")
    steps = "".join(f", r{i} as (select kind, u, sum(rank) as rank from (select w.kind, w.v as u, r.rank * w.share as rank from r{i - 1} r join way w on r.kind = w.kind and r.u = w.u union all select * from r0) group by 1, 2)" for i in range(1, turns(DAMPING) + 1))
    return f"""
with p as (select page_id, translate(coalesce(regexp_extract(url, {quote(HOST)}, 1), ''), '{UPPER}', '{LOWER}') as host, coalesce(regexp_extract(url, {quote(PATH)}, 1), '') as path, html from pages),
l as (select host as source, translate(unnest(regexp_extract_all(html, {quote(LINK)}, 1)), '{UPPER}', '{LOWER}') as target from p where host <> ''),
e as (select source, target, count(*) as weight from l where source <> target group by 1, 2),
s as (select source, target, {DAMPING} * weight / sum(weight) over (partition by source) as share from e),
way as (select 'allow' as kind, source as u, target as v, share from s union all select 'block', target, source, share from s),
h as (select distinct host from (select host from p union all select target from e) where host <> ''),
r0 as (select case when {blocked} then 'block' else 'allow' end as kind, host as u, cast(1 as double) as rank from h where {blocked} or {allowed}){steps},
t as (select u as host, sum(case when kind = 'allow' then rank else 0 end) as trust, sum(case when kind = 'block' then rank else 0 end) as distrust from r{turns(DAMPING)} group by 1)
select p.page_id, p.host, p.path, case {rule} end as rule, coalesce(case {verdict} end, case when t.distrust >= {THRESHOLD} and t.distrust > t.trust then 'block' end, 'allow') as verdict
from (select * from p) p left join t using (host)
"""


OP9_SQL = sql_text()
