"""Named queries over the driver's tables, each with the SQL that must give the same rows.

The tables are not comments, so each query reads a view of them as such: documents and conversations as comments, labels as
model labels, events and lineitem as facts to sum up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import labels as V
from parlance.functions import lexicons as L
from parlance.functions import text as T
from parlance.operators import aggregate as A
from parlance.operators import export as E
from parlance.operators import labeller
from parlance.operators.merge import PAYLOAD, merge_labels, typed_labels
from parlance.operators.reply_tree import reply_depth, with_reply_metadata
from parlance.operators.rules import Rules, apply_rules, features, first_by_id
from parlance.plans.tables import folder
from parlance.sources import comments as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Lexicons in the documents' languages.
RULES = Rules(
    low_info=("That it.", "In."), mobilization=("scum", "clown"),
    topics=(("legal", "License"), ("legal", "licensed"), ("abuse", "idiot"), ("abuse", "pathet"), ("short", "That it"), ("credentials", "token"), ("table", " | ")),
    risks=(("insult", "moron"), ("insult", "idiot"), ("insult", "loser"), ("waste", "trash"), ("shouting", "!!")),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def doc_comments(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(
        F.col("doc_id").alias("ordinal"), F.col("doc_id").cast("string").alias("comment_id"), F.lit("").alias("parent_comment_id"), F.col("source").alias("user_id"), T.clean_text(T.text_of("text")).alias("comment_text_clean"),
        F.pmod("n_chars", F.lit(120)).alias("like_count"), F.pmod("doc_id", F.lit(13)).alias("reply_count"), F.lit(True).alias("is_root"),
    )


def thread_comments(spark: SparkSession, sf: str) -> DataFrame:
    name = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    parent = F.when(F.col("turn") == 0, "").otherwise(name(F.col("turn") - 1))
    return table(spark, sf, "conversations").select(name(F.col("turn")).alias("comment_id"), parent.alias("parent_comment_id"), F.col("role").alias("user_id"), F.length("text").cast("bigint").alias("like_count"))


def doc_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Typed labels: by id for some documents, by the text of others; ordinals make later lines win."""
    by_id, by_text = F.pmod("ordinal", F.lit(3)) == 0, F.pmod("ordinal", F.lit(3)) == 1
    group = F.when(by_text, F.col("comment_text_clean")).otherwise(F.when(by_id, "").otherwise(T.canonical("comment_text_clean")))
    # Keys are made before the join, so that no text is moved by it.
    docs = doc_comments(spark, sf).select("ordinal", "comment_id", "user_id", group.alias("template_group"))
    docs = docs.withColumn("form", T.canonical("template_group")).withColumns({f"key_{c}": F.when(F.col(c) != "", T.key(c)) for c in ("template_group", "form")})
    l = table(spark, sf, "labels").join(docs, F.col("doc_id") == F.col("ordinal"))  # noqa: E741
    return l.select(
        "ordinal", F.when(by_id, F.col("comment_id")).otherwise("").alias("comment_id"), "template_group", "key_template_group", "key_form",
        F.when(F.col("quality") == 1, "正面").otherwise("负面").alias("sentiment"), F.concat(F.lit("s"), F.pmod("doc_id", F.lit(5)).cast("string")).alias("stance"), F.lit("低").alias("emotion_intensity"), F.col("comment_id").alias("summary_reason"),
        F.array(F.lit("t"), F.col("user_id")).alias("topic_tags"), F.when(F.col("toxic") == 1, F.array(F.lit("辱骂攻击"))).otherwise(F.array().cast("array<string>")).alias("risk_tags"), (F.col("quality") == 0).alias("is_low_info_confirmed"), F.lit(None).cast("boolean").alias("is_mobilization_confirmed"),
    )


def unlabeled(rows: DataFrame) -> DataFrame:
    none = {"topic_tags": F.array().cast("array<string>"), "risk_tags": F.array().cast("array<string>"), "is_low_info_confirmed": F.lit(None).cast("boolean"), "is_mobilization_confirmed": F.lit(None).cast("boolean")}
    return rows.withColumns({c: none.get(c, F.lit("old")) for c in PAYLOAD})


def ruled(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return apply_rules(doc_comments(spark, sf), RULES, columns)


#: JSON text with a fault by doc_id, the same expression in both engines.
_JSON = """concat('{"comment_id":"', cast(doc_id as STR), '","template_group":"g","sentiment":', case when doc_id % 11 = 0 then '"angry"' when doc_id % 7 = 0 then '" Negative "' when toxic = 1 then '"愤怒"' else '"正面"' end,
 ',"stance":', case when doc_id % 17 = 0 then 'null' when doc_id % 5 = 0 then '"support"' when doc_id % 5 = 1 then '"支持"' else '"观望"' end, ',"topic_tags":', case when doc_id % 19 = 0 then '"other"' when doc_id % 4 = 0 then '["其他"," other ","处理方案"]' else '[]' end,
 ',"emotion_intensity":', case when doc_id % 23 = 0 then '11' when doc_id % 6 = 0 then '0.5' when doc_id % 6 = 1 then '2' when doc_id % 6 = 2 then '"high"' when doc_id % 6 = 3 then '7' else '"低"' end, ',"risk_tags":["煽动情绪","质疑官方"],"is_low_info_confirmed":', case when doc_id % 29 = 0 then '"yes"' else 'false' end,
 ',"is_mobilization_confirmed":', case when doc_id % 2 = 0 then 'true' else 'false' end, case when doc_id % 31 = 0 then '' else concat(',"confidence":', case when doc_id % 37 = 0 then '1.5' when doc_id % 3 = 0 then '"high"' when doc_id % 3 = 1 then '0.25' else '"0.75"' end) end, ',"summary_reason":" r "}')"""
_TEXT = f"case when doc_id % 41 = 0 then 'not json' else {_JSON} end"


def raw_results(spark: SparkSession, sf: str) -> DataFrame:
    text = F.expr(_TEXT.replace("STR", "string"))
    failed = F.pmod("doc_id", F.lit(13)) == 5
    number = F.format_string("run-%06d", "doc_id")
    return table(spark, sf, "labels").select(number.alias("request_id"), F.lit("run").alias("run_id"), F.lit("run-batch-0001").alias("batch_id"), F.col("doc_id").cast("string").alias("comment_id"), F.lit("g").alias("template_group"), (~failed).alias("ok"), F.when(failed, "").otherwise(text).alias("response_text"), F.when(failed & (F.pmod("doc_id", F.lit(2)) == 0), "HTTP 500: x").otherwise("").alias("error"), F.lit("m").alias("model"))


# --- SQL of the views -------------------------------------------------------------------------------------------------


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, {q(f'^{L.WS}+|{L.WS}+$')}, '', 'g')"


def sql_clean(c: str) -> str:
    return sql_strip(f"regexp_replace({c}, {q(L.WS + '+')}, ' ', 'g')")


#: What the canonical form lacks, written out for the SQL on its own: tags in brackets, emoji, marks, white space.
SQL_REMOVED = (
    r"\[[^\[\]]{1,10}\]",
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}\x{2600}-\x{26FF}\x{FE00}-\x{FE0F}\x{200D}\x{2B50}\x{23CF}\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}]+",
    r"[，。！？、；：'【】《》（）()\[\]{}<>/@#$%^&*_+=|~`…·\x{200B}\x{200C}\x{200D}\x{FEFF}-]",
    r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+",
)


def sql_canonical(c: str) -> str:
    for pattern in SQL_REMOVED:
        c = f"regexp_replace({c}, {q(pattern)}, '', 'g')"
    return c


def sql_tags(c: str, lexicon) -> str:
    names = list(dict.fromkeys(t for t, _ in lexicon))
    some = lambda t: " or ".join(f"contains({c}, {q(k)})" for n, k in lexicon if n == t)
    return "list_filter([" + ", ".join(f"case when {some(t)} then {q(t)} end" for t in names) + "], lambda x: x is not null)"


DOCS = f"c as (select doc_id as ordinal, cast(doc_id as varchar) as comment_id, source as user_id, {sql_clean('coalesce(text, chr(32))')} as clean, n_chars % 120 as like_count, doc_id % 13 as reply_count from documents)"
FEATURES = f""", f as (select *, length(clean) as char_len, len(list_filter(string_split_regex(clean, {q(L.WS + '+')}), lambda x: x <> '')) as token_len, clean <> '' and regexp_matches(clean, {q(L.SYMBOLS_ONLY)}) as only_symbols,
 {" or ".join(f"contains(clean, {q(k)})" for k in RULES.mobilization)} as mobilization, {sql_tags('clean', RULES.topics)} as topics, {sql_tags('clean', RULES.risks)} as risks, {sql_canonical('clean')} as canonical from c),
 g as (select *, clean = '' or clean in ({", ".join(map(q, RULES.low_info))}) or only_symbols or (char_len <= 2 and len(topics) = 0) as low_info, clean <> '' and count(*) over (partition by clean) > 1 as exact, canonical <> '' and count(*) over (partition by canonical) > 1 as near from f),
 r as (select *, case when low_info then 'low' when like_count >= 50 or reply_count >= 10 or exact or char_len >= 12 or len(topics) > 0 then 'high' else 'medium' end as priority, exact or near as is_template, case when near then canonical when exact then clean else '' end as template_group from g)"""
RULED = f"with {DOCS}{FEATURES}"
SUMS = "count(*) as comment_count, count(distinct coalesce(user_id, '')) as unique_user_count, cast(coalesce(sum(like_count), 0) as bigint) as like_count_sum"


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- text and rules ---------------------------------------------------------------------------------------------------


@query(f"with {DOCS} select comment_id, md5(clean) as clean_md5, cast(length(clean) as bigint) as clean_length from c")
def clean_text(spark, sf):
    return doc_comments(spark, sf).select("comment_id", F.md5("comment_text_clean").alias("clean_md5"), F.length("comment_text_clean").cast("bigint").alias("clean_length"))


@query(f"{RULED} select comment_id, cast(char_len as bigint) as char_len, cast(token_len as bigint) as token_len, clean = '' as is_empty_text, char_len <= 4 as is_short_text, md5(canonical) as canonical_md5 from r")
def text_features(spark, sf):
    return features(doc_comments(spark, sf), RULES).select("comment_id", F.col("char_len").cast("bigint").alias("char_len"), F.col("token_len").cast("bigint").alias("token_len"), "is_empty_text", "is_short_text", F.md5("canonical_template_group").alias("canonical_md5"))


@query(f"{RULED} select comment_id, only_symbols as is_only_emoji_or_punct from r")
def only_punct_flag(spark, sf):
    return features(doc_comments(spark, sf), RULES).select("comment_id", "is_only_emoji_or_punct")


@query(f"{RULED} select comment_id, array_to_string(topics, ',') as topics, array_to_string(risks, ',') as risks from r")
def rule_tags(spark, sf):
    return features(doc_comments(spark, sf), RULES).select("comment_id", F.array_join("rule_topic_tags", ",").alias("topics"), F.array_join("rule_risk_tags", ",").alias("risks"))


@query(f"{RULED} select comment_id, mobilization as is_mobilization from r")
def mobilization_flag(spark, sf):
    return features(doc_comments(spark, sf), RULES).select("comment_id", "is_mobilization")


@query(f"{RULED} select comment_id, low_info as is_low_info from r")
def low_info_flag(spark, sf):
    return features(doc_comments(spark, sf), RULES).select("comment_id", "is_low_info")


@query(f"{RULED} select comment_id, priority as analysis_priority from r")
def analysis_priority(spark, sf):
    return ruled(spark, sf, "comment_id", "analysis_priority")


@query(f"with {DOCS} select md5(clean) as template_md5, count(*) as n from c where clean <> '' group by clean having count(*) > 1")
def template_exact(spark, sf):
    return doc_comments(spark, sf).where("comment_text_clean <> ''").groupBy("comment_text_clean").agg(F.count("*").alias("n")).where("n > 1").select(F.md5("comment_text_clean").alias("template_md5"), "n")


@query(f"{RULED} select comment_id, is_template as is_template_text, md5(template_group) as template_md5 from r")
def template_canonical(spark, sf):
    return ruled(spark, sf, "comment_id", "is_template_text", "template_group").select("comment_id", "is_template_text", F.md5("template_group").alias("template_md5"))


@query(f"with {DOCS}, k as (select *, md5(clean) as id, row_number() over (partition by clean order by ordinal) as rn from c where clean <> '') select id as comment_id, ordinal, like_count from k where rn = 1")
def dedup_first(spark, sf):
    rows = doc_comments(spark, sf).withColumn("comment_id", F.when(F.col("comment_text_clean") != "", F.md5("comment_text_clean")).otherwise(""))
    return first_by_id(rows).select("comment_id", "ordinal", "like_count")


# --- reply tree -------------------------------------------------------------------------------------------------------

THREADS = "t as (select concat_ws('-', conv_id, turn) as comment_id, case when turn = 0 then '' else concat_ws('-', conv_id, turn - 1) end as parent_comment_id, role as user_id, cast(length(text) as bigint) as like_count from conversations)"


@query(f"with recursive {THREADS}, w as (select comment_id, parent_comment_id as cur, 0 as reply_depth from t union all select w.comment_id, coalesce(t.parent_comment_id, ''), w.reply_depth + 1 from w left join t on t.comment_id = w.cur where w.cur <> '') select comment_id, max(reply_depth) as reply_depth from w group by 1")
def reply_depths(spark, sf):
    return reply_depth(thread_comments(spark, sf))


@query(f"with {THREADS} select comment_id, parent_comment_id = '' as is_root, parent_comment_id in (select comment_id from t where parent_comment_id = '') as is_direct_reply_to_root from t")
def direct_reply_flag(spark, sf):
    return with_reply_metadata(thread_comments(spark, sf)).select("comment_id", "is_root", "is_direct_reply_to_root")


# --- export -----------------------------------------------------------------------------------------------------------

CHOSEN = f"{RULED}, e as (select * from r where not low_info and priority <> 'low'), b as (select *, min(ordinal) over (partition by canonical) as first, row_number() over (partition by canonical order by like_count desc, char_len desc, ordinal) as rn from e), x as (select *, case when canonical = '' then ordinal else first end as group_ordinal from b where rn = 1 or canonical = '')"


@query(f"{CHOSEN} select comment_id, like_count, cast(char_len as bigint) as char_len, md5(template_group) as template_md5 from x")
def export_representatives(spark, sf):
    return E.representatives(E.eligible(ruled(spark, sf))).select("comment_id", "like_count", F.col("char_len").cast("bigint").alias("char_len"), F.md5("template_group").alias("template_md5"))


@query(f"{CHOSEN} select comment_id, row_number() over (order by canonical = '', group_ordinal, ordinal) as rn from x")
def export_order(spark, sf):
    rows = E.representatives(E.eligible(ruled(spark, sf)))
    return E.numbered(rows.select("comment_id", "group_ordinal", "ordinal", E.alone(rows).alias("alone")), "alone", "group_ordinal", "ordinal").select("comment_id", F.col("rn").cast("bigint").alias("rn"))


@query("select o_orderkey, 'run-batch-' || lpad(cast((rn - 1) // 5000 + 1 as varchar), 4, '0') as batch_id, 'run-' || lpad(cast(rn as varchar), cast(greatest(6, length(cast(rn as varchar))) as int), '0') as request_id from (select o_orderkey, row_number() over (order by o_orderkey) as rn from orders)")
def batch_assign(spark, sf):
    return E.batched(table(spark, sf, "orders").select("o_orderkey"), 5000, "run", "o_orderkey").select("o_orderkey", "batch_id", "request_id")


# --- label validation -------------------------------------------------------------------------------------------------

CHECKED = f"""with raw as (select *, 'run-' || lpad(cast(doc_id as varchar), cast(greatest(6, length(cast(doc_id as varchar))) as int), '0') as request_id, doc_id % 13 <> 5 as ok, case when doc_id % 13 = 5 then '' else {_TEXT.replace("STR", "varchar")} end as body, case when doc_id % 13 = 5 and doc_id % 2 = 0 then 'HTTP 500: x' else '' end as error from labels),
 p as (select *, case when json_valid(body) then cast(body as json) end as j from raw),
 v as (select *, j ->> '$.sentiment' as s0, j ->> '$.stance' as st0, json_type(j, '$.emotion_intensity') as ik, j ->> '$.emotion_intensity' as i0, j ->> '$.confidence' as c0 from p),
 n as (select *, case lower(trim(s0)) when 'negative' then '负面' when '愤怒' then '负面' else trim(s0) end as sentiment,
  case when st0 = 'support' then '支持官方处理' when st0 = '支持' then case when (j ->> '$.is_mobilization_confirmed') = 'true' then '跟随主评动员' else '无法判断' end else st0 end as stance,
  case when ik in ('UBIGINT', 'BIGINT', 'DOUBLE') then case when cast(i0 as double) > 10 then null when cast(i0 as double) <= 0.33 then '低' when cast(i0 as double) <= 0.66 then '中' when cast(i0 as double) <= 1 then '高' when cast(i0 as double) <= 3 then '低' when cast(i0 as double) <= 6 then '中' else '高' end when i0 = 'high' then '高' else i0 end as intensity,
  case when json_type(j, '$.topic_tags') = 'ARRAY' then case when json_array_length(j, '$.topic_tags') = 0 then '' else '无明确主题,处理方案' end end as topics,
  case when c0 = 'high' then 0.9 else try_cast(c0 as double) end as sure from v),
 d as (select *, coalesce(case when not ok then coalesce(nullif(error, ''), 'Raw request failed') end, case when j is null then 'invalid_json: ' || substr(body, 1, 80) end, case when not json_exists(j, '$.confidence') then 'Missing required fields: confidence' end,
  case when sentiment not in ('正面', '中性', '负面', '混合', '无法判断') then 'Invalid sentiment: ' || sentiment end, case when stance is null then 'Invalid stance: None' end, case when intensity is null then 'Invalid emotion_intensity: out of range' end,
  case when topics is null then 'topic_tags must be a list' end, case when sure > 1 then 'confidence must be between 0 and 1' end, case when json_type(j, '$.is_low_info_confirmed') <> 'BOOLEAN' then 'is_low_info_confirmed must be a bool' end) as failure from n)"""


@query(f"{CHECKED} select request_id, cast(doc_id as varchar) as comment_id, sentiment, stance, topics as topic_tags, intensity as emotion_intensity, '煽动动员' as risk_tags, cast(sure as double) as confidence, 'r' as summary_reason, (j ->> '$.is_mobilization_confirmed') = 'true' as is_mobilization_confirmed from d where failure is null")
def validate_valid(spark, sf):
    valid, _ = V.split(raw_results(spark, sf))
    return valid.select("request_id", "comment_id", "sentiment", "stance", F.array_join("topic_tags", ",").alias("topic_tags"), "emotion_intensity", F.array_join("risk_tags", ",").alias("risk_tags"), "confidence", "summary_reason", "is_mobilization_confirmed")


@query(f"{CHECKED} select request_id, cast(doc_id as varchar) as comment_id, failure as error from d where failure is not null")
def validate_failures(spark, sf):
    _, failed = V.split(raw_results(spark, sf))
    return failed.select("request_id", "comment_id", "error")


@query(f"{CHECKED} select count(*) filter (failure is null) as valid_count, count(*) filter (failure is not null) as failure_count from d")
def validate_summary(spark, sf):
    return V.validated(raw_results(spark, sf)).agg(F.count_if(F.col("failure").isNull()).alias("valid_count"), F.count_if(F.col("failure").isNotNull()).alias("failure_count"))


# --- merging labels ---------------------------------------------------------------------------------------------------

MERGED = f"""{RULED}, l as (select ordinal, case when doc_id % 3 = 0 then comment_id else '' end as lid, case when doc_id % 3 = 1 then clean when doc_id % 3 = 0 then '' else {sql_canonical('clean')} end as lgroup, case when quality = 1 then '正面' else '负面' end as sentiment, 's' || cast(doc_id % 5 as varchar) as stance, comment_id as reason, 't,' || user_id as topics, case when toxic = 1 then '辱骂攻击' else '' end as risks, quality = 0 as low from labels join c on doc_id = ordinal),
 k as (select 1 as tier, lid as key, * from l union all select 2, lgroup, * from l union all select 3, {sql_canonical('lgroup')}, * from l), u as (select tier, key, max_by(struct_pack(sentiment := sentiment, stance := stance, reason := reason, topics := topics, risks := risks, low := low), ordinal) as p from k where key <> '' group by 1, 2),
 m as (select r.comment_id, r.user_id, r.like_count, coalesce(u1.p, u2.p, u3.p) as p, u1.p as p1 from r left join u u1 on u1.tier = 1 and u1.key = r.comment_id left join u u2 on u2.tier = 2 and u2.key = r.template_group left join u u3 on u3.tier = 3 and u3.key = r.canonical)"""


@query(f"{MERGED} select comment_id, p1.stance as stance from m where p1 is not null")
def merge_by_id(spark, sf):
    labels = doc_labels(spark, sf).where("comment_id <> ''").drop("key_template_group", "key_form").withColumn("template_group", F.lit(""))
    return merge_labels(unlabeled(ruled(spark, sf)), labels).where("stance <> 'old'").select("comment_id", "stance")


@query(f"{MERGED} select comment_id, coalesce(p.sentiment, 'old') as sentiment, coalesce(p.stance, 'old') as stance, coalesce(p.reason, 'old') as summary_reason, coalesce(p.topics, '') as topic_tags, coalesce(p.risks, '') as risk_tags, p.low as is_low_info_confirmed from m")
def merge_three_tier(spark, sf):
    out = merge_labels(unlabeled(ruled(spark, sf)), doc_labels(spark, sf))
    return out.select("comment_id", "sentiment", "stance", "summary_reason", F.array_join("topic_tags", ",").alias("topic_tags"), F.array_join("risk_tags", ",").alias("risk_tags"), "is_low_info_confirmed")


# --- summaries --------------------------------------------------------------------------------------------------------


@query("select event_type as value, count(*) as comment_count, count(distinct coalesce(cast(user_id as varchar), '')) as unique_user_count, cast(sum(cast(floor(value) as bigint)) as bigint) as like_count_sum from events where coalesce(event_type, '') <> '' group by 1")
def agg_by_field(spark, sf):
    rows = table(spark, sf, "events").select("event_type", F.col("user_id").cast("string").alias("user_id"), F.floor("value").cast("bigint").alias("like_count"))
    return A.ordered(A.by_field(rows, "event_type"))


@query(f"{RULED} select value, {SUMS} from (select unnest(topics) as value, user_id, like_count from r) group by 1")
def agg_multi_value(spark, sf):
    return A.ordered(A.by_items(features(doc_comments(spark, sf), RULES), "rule_topic_tags"))


@query(f"{RULED} select 'True' as value, {SUMS} from r where mobilization")
def agg_bool_field(spark, sf):
    return A.by_field(features(doc_comments(spark, sf), RULES), "is_mobilization")


@query("select l_returnflag as value, count(*) as comment_count, count(distinct l_suppkey) as unique_user_count, cast(sum(cast(l_quantity as bigint)) as bigint) as like_count_sum from lineitem group by 1")
def agg_lineitem(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_suppkey").cast("string").alias("user_id"), F.col("l_quantity").cast("bigint").alias("like_count"))
    return A.ordered(A.by_field(rows, "l_returnflag"))


@query(f"{RULED} select count(*) as total, count(*) filter (low_info) as n_is_low_info, count(*) filter (is_template) as n_is_template_text, count(*) filter (mobilization) as n_is_mobilization, count(*) filter (char_len <= 4) as n_is_short_text, count(*) filter (only_symbols) as n_is_only_emoji_or_punct from r")
def profile_flags(spark, sf):
    return A.profile_flags(ruled(spark, sf, *A.FLAGS))


@query(f"{RULED} select priority as value, count(*) as n, min(ordinal) as first_ordinal from r group by 1")
def profile_priority(spark, sf):
    return A.histogram(ruled(spark, sf, "ordinal", "analysis_priority"), F.col("analysis_priority"))


@query(f"{RULED} select 'topic' as kind, value, count(*) as n from (select unnest(topics) as value from r) group by 2 union all select 'risk', value, count(*) from (select unnest(risks) as value from r) group by 2")
def profile_tags(spark, sf):
    rows = features(doc_comments(spark, sf), RULES)
    one = lambda kind, c: A.histogram(rows, F.explode(c)).select(F.lit(kind).alias("kind"), "value", "n")
    return one("topic", "rule_topic_tags").union(one("risk", "rule_risk_tags"))


@query(f"{CHOSEN}, a as (select (select count(*) from r) as total, count(*) as requests, count(distinct nullif(template_group, '')) as groups from x) select total, requests, groups, printf('%.1f', floor(total / greatest(requests, 1) * 10 + 0.5) / 10) as ratio from a")
def compression_ratio(spark, sf):
    rows = ruled(spark, sf)
    return A.compression(rows, E.representatives(E.eligible(rows)))


# --- codecs and files ---------------------------------------------------------------------------------------------------

_COUNT = "case when o_orderkey % 4 = 0 then '' when o_orderkey % 4 = 1 then concat(' ', cast(o_orderkey as STR), ' ') else concat(cast(o_orderkey as STR), ',012') end"


@query(f"select o_orderkey, cast(nullif(replace(trim(s), ',', ''), '') as bigint) as n, case when o_orderkey % 4 < 2 then cast(nullif(trim(s), '') as bigint) end as plain from (select o_orderkey, {_COUNT.replace('STR', 'varchar')} as s from orders)")
def codec_counts(spark, sf):
    s = F.expr(_COUNT.replace("STR", "string"))
    return table(spark, sf, "orders").select("o_orderkey", T.parse_count(s).alias("n"), T.parse_plain_int(F.when(F.col("o_orderkey") % 4 < 2, s)).alias("plain"))


@query("select o_orderkey, case when o_orderkey % 9 = 0 then null else strftime(o_orderdate, '%Y-%m-%d') || ' 01:02:03' end as t from orders")
def codec_times(spark, sf):
    s = F.when(F.col("o_orderkey") % 9 == 0, " ").otherwise(F.concat(F.date_format("o_orderdate", "y-M-d"), F.when(F.col("o_orderkey") % 2 == 0, " 1:2:3").otherwise(" 01:02:03")))
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(T.parse_time(s), "yyyy-MM-dd HH:mm:ss").alias("t"))


_FLAG = "case o_orderkey % 7 when 0 then '是' when 1 then ' 否' when 2 then 'True ' when 3 then 'FALSE' when 4 then '' when 5 then 'x' end"


@query(f"select o_orderkey, case trim(s) when '是' then true when '否' then false end as yes_no, coalesce(lower(trim(s)) = 'true', false) as flag, case lower(trim(s)) when 'true' then true when 'false' then false end as optional from (select o_orderkey, {_FLAG} as s from orders)")
def codec_flags(spark, sf):
    s = F.expr(_FLAG)
    return table(spark, sf, "orders").select("o_orderkey", T.parse_yes_no(s).alias("yes_no"), T.parse_bool(s).alias("flag"), T.parse_optional_bool(s).alias("optional"))


_LIST = """case doc_id % 4 when 0 then '' when 1 then concat('["a","b ', cast(doc_id as STR), '"]') when 2 then '"one"' else '[]' end"""


@query("select doc_id, case doc_id % 4 when 1 then 'a|b ' || cast(doc_id as varchar) when 2 then 'one' else '' end as items, case doc_id % 4 when 1 then 2 when 2 then 1 else 0 end as n from documents")
def codec_lists(spark, sf):
    items = T.parse_list(F.expr(_LIST.replace("STR", "string")))
    return table(spark, sf, "documents").select("doc_id", F.array_join(items, "|").alias("items"), F.size(items).cast("int").alias("n"))


_ANSWER = """case doc_id % 6 when 0 then '{}' when 1 then '{"choices":[{"message":1}]}' when 2 then concat('{"choices":[{"message":{"content":"c', cast(doc_id as STR), '"}}]}') when 3 then '{"choices":[{"message":{"content":[{"type":"text","text":" a"},{"type":"x","text":"y"},{"type":"text","text":"b"}]}}]}' when 4 then '{"choices":[{"message":{"content":[]}}]}' else '{"choices":[]}' end"""


@query("select doc_id, case doc_id % 6 when 2 then 'c' || cast(doc_id as varchar) when 3 then 'ab' end as text, case doc_id % 6 when 0 then 'Missing choices in response payload' when 5 then 'Missing choices in response payload' when 1 then 'Missing message in response payload' when 4 then 'Missing textual content in response payload' end as error from labels")
def answer_content(spark, sf):
    text, error = labeller.read_answer(F.expr(_ANSWER.replace("STR", "string")))
    return table(spark, sf, "labels").select("doc_id", text.alias("text"), error.alias("error"))


def raw_export(spark, sf):
    """The threads as a raw export: text with its headers, some missing, some blank."""
    c = table(spark, sf, "conversations")
    name = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    return c.select(
        name(F.col("turn")).alias("评论ID"), F.when(F.col("turn") == 0, "").otherwise(name(F.col("turn") - 1)).alias("上级评论ID"), F.col("role").alias("用户ID"), F.concat(F.lit(" "), "role").alias("用户名"), F.concat(F.lit("第"), F.col("turn").cast("string"), F.lit("楼\r\n \"x\", ok")).alias("评论内容"),
        F.lit("2026-5-2 0:00:02").alias("评论时间"), F.when(F.col("turn") % 2 == 0, "").otherwise("1,234").alias("点赞数"), F.when(F.col("turn") % 3 == 0, "是").otherwise("").alias("是否为大会员"),
    )


EXPORTED = f"with recursive {{}}, w as (select comment_id, parent_comment_id as cur, 0 as d from t union all select w.comment_id, coalesce(t.parent_comment_id, ''), w.d + 1 from w left join t on t.comment_id = w.cur where w.cur <> ''), e as (select comment_id, max(d) as depth from w group by 1)"


@query(EXPORTED.format(THREADS) + """, x as (select *, cast(string_split(comment_id, '-')[2] as int) as turn from e join t using (comment_id))
 select comment_id, parent_comment_id, user_id, '第' || cast(turn as varchar) || '楼 "x", ok' as clean, '第' || cast(turn as varchar) || '楼' || chr(10) || ' "x", ok' as raw, depth as reply_depth, case when turn % 2 = 0 then 0 else 1234 end as like_count, case when turn % 3 = 0 then true end as vip_flag, '2026-05-02 00:00:02' as t, parent_comment_id = '' as is_root from x""")
def normalized_export(spark, sf):
    path = folder(spark, "export")
    raw_export(spark, sf).write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    out = S.normalized(spark, path)
    return out.select("comment_id", "parent_comment_id", F.col("username").alias("user_id"), F.col("comment_text_clean").alias("clean"), F.col("comment_text_raw").alias("raw"), "reply_depth", "like_count", "vip_flag", F.date_format("comment_time", "yyyy-MM-dd HH:mm:ss").alias("t"), "is_root")


@query(f"{RULED} select comment_id, clean <> '' as has_text, cast(char_len as varchar) as char_len, case when only_symbols then 'true' else 'false' end as only_symbols, to_json(topics) as topics, cast(like_count as varchar) as likes, '' as no_time, 'true' as is_root from r")
def fact_text(spark, sf):
    rest = {c: v for c, v in (S.defaults() | {c: F.lit(None).cast(t) for c, t in (("comment_time", "timestamp_ntz"), ("user_level", "bigint"))}).items()}
    rows = ruled(spark, sf)
    rows = rows.withColumns({c: v for c, v in rest.items() if c not in rows.columns})
    return S.encoded(rows).select("comment_id", (F.col("comment_text_clean") != "").alias("has_text"), "char_len", F.col("is_only_emoji_or_punct").alias("only_symbols"), F.col("rule_topic_tags").alias("topics"), F.col("like_count").alias("likes"), F.col("comment_time").alias("no_time"), "is_root")


@query(EXPORTED.format(THREADS) + " select comment_id, depth as reply_depth, case when string_split(comment_id, '-')[2] in ('1', '3', '5', '7', '9') then 1234 else 0 end as like_count, '' as rule_topic_tags from e")
def fact_csv_round_trip(spark, sf):
    path, raw = folder(spark, "fact"), folder(spark, "export")
    raw_export(spark, sf).where("length(`评论ID`) > 0").write.option("header", True).option("escape", '"').option("emptyValue", "").csv(raw)
    S.write_fact_csv(S.normalized(spark, raw).withColumn("like_count", F.when(F.col("comment_id").rlike("-[13579]$"), 1234).otherwise(0)), path, single=False)
    return S.read_fact_csv(spark, path).select("comment_id", "reply_depth", "like_count", F.array_join("rule_topic_tags", ",").alias("rule_topic_tags"))


@query(f"{CHECKED} select request_id, ok, md5(body) as body_md5, error from d")
def raw_results_lines(spark, sf):
    path = folder(spark, "raw")
    S.write_json(raw_results(spark, sf), path)
    return S.read_json(spark, path, labeller.RAW).select("request_id", "ok", F.md5("response_text").alias("body_md5"), "error")


@query(f"{RULED} select comment_id, cast(is_template as varchar) || ',' || cast(mobilization as varchar) || ',' || array_to_string(topics, '|') || ',' || array_to_string(risks, '|') || ',' || priority as flags, comment_id || ',' || cast(char_len as varchar) || ',' || cast(like_count as varchar) as numbers from r")
def request_rows(spark, sf):
    f = lambda c: F.col(f"rule_flags.{c}")
    flags = F.concat_ws(",", f("is_template_text").cast("string"), f("is_mobilization").cast("string"), F.array_join(f("rule_topic_tags"), "|"), F.array_join(f("rule_risk_tags"), "|"), f("analysis_priority"))
    columns = ("comment_id", "parent_comment_id", "is_root", "like_count", "reply_count", "char_len", "is_template_text", "is_mobilization", "rule_topic_tags", "rule_risk_tags", "analysis_priority")
    return E.requests(ruled(spark, sf, *columns), without=("comment_text_clean", "template_group")).select("comment_id", flags.alias("flags"), F.concat_ws(",", "comment_id", F.col("char_len").cast("string"), F.col("like_count").cast("string")).alias("numbers"))


@query("select doc_id, case doc_id % 5 when 0 then 'a,b' when 1 then 'one' when 2 then '' when 3 then '' else '7' end as items, case doc_id % 6 when 0 then true when 1 then false when 2 then true when 3 then false end as flag, case doc_id % 3 when 0 then '' when 1 then 'g' else '5' end as template_group from labels")
def label_lines(spark, sf):
    tags = "case doc_id % 5 when 0 then '[\"a\",\"b\"]' when 1 then '\"one\"' when 2 then 'null' when 3 then '[]' else '7' end"
    flag = "case doc_id % 6 when 0 then 'true' when 1 then '\" No \"' when 2 then '1' when 3 then '0' when 4 then '\"?\"' else 'null' end"
    group = "case doc_id % 3 when 0 then 'false' when 1 then '\"g\"' else '5' end"
    line = F.expr(f"""concat('{{"comment_id":"', cast(doc_id as string), '","topic_tags":', {tags}, ',"is_low_info_confirmed":', {flag}, ',"template_group":', {group}, '}}')""")
    out = typed_labels(table(spark, sf, "labels").select(line.alias("value"), F.col("doc_id").alias("ordinal")))
    return out.select(F.col("ordinal").alias("doc_id"), F.array_join("topic_tags", ",").alias("items"), F.col("is_low_info_confirmed").alias("flag"), "template_group")


# --- tables that the design asks for beyond the code ------------------------------------------------------------------

LABELED = f"{MERGED}, z as (select comment_id, user_id, like_count, coalesce(p.sentiment, 'old') as sentiment, coalesce(p.stance, 'old') as stance, string_split(coalesce(p.topics, ''), ',') as topics, coalesce(p.risks, '') as risks from m)"
BUCKET = "case when like_count < 10 then '0-9' when like_count < 50 then '10-49' else '50+' end"


def labeled(spark, sf):
    return merge_labels(unlabeled(ruled(spark, sf)), doc_labels(spark, sf))


@query(f"{LABELED} select stance as left_value, {BUCKET} as right_value, {SUMS} from z group by 1, 2")
def crosstab_stance_likes(spark, sf):
    return A.crosstab(labeled(spark, sf), F.col("stance"), F.expr(BUCKET))


@query(f"{LABELED} select sentiment as left_value, user_id as right_value, {SUMS} from z group by 1, 2")
def crosstab_sentiment_user(spark, sf):
    return A.crosstab(labeled(spark, sf), F.col("sentiment"), F.col("user_id"))


@query("select event_type as left_value, strftime(date_trunc('day', ts), '%Y-%m-%d') as right_value, count(*) as comment_count, count(distinct cast(user_id as varchar)) as unique_user_count, cast(sum(cast(floor(value) as bigint)) as bigint) as like_count_sum from events group by 1, 2")
def crosstab_event_day(spark, sf):
    rows = table(spark, sf, "events").select("event_type", "ts", F.col("user_id").cast("string").alias("user_id"), F.floor("value").cast("bigint").alias("like_count"))
    return A.crosstab(rows, F.col("event_type"), F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd"))


@query(f"{RULED} select priority as value, count(distinct coalesce(nullif(template_group, ''), comment_id)) as template_deduplicated_count, cast(sum(like_count) as bigint) as like_weighted_count from r group by 1")
def deduplicated_counts(spark, sf):
    rows = ruled(spark, sf)
    return rows.groupBy(F.col("analysis_priority").alias("value")).agg(A.deduplicated_count(rows), F.sum("like_count").alias("like_weighted_count"))


@query(f"{RULED} select md5(template_group) as template_md5, {SUMS} from r where template_group <> '' group by template_group order by comment_count desc, template_group limit 20")
def template_top(spark, sf):
    return A.top_templates(ruled(spark, sf, "ordinal", "user_id", "like_count", "template_group", "key_template_group"), 20).select(F.md5("template_group").alias("template_md5"), *A.COUNTS)


@query(f"{RULED} select comment_id, array_to_string(risks, ',') as risks, like_count from r where list_has_any(risks, ['insult', 'waste'])")
def risk_samples(spark, sf):
    return features(doc_comments(spark, sf), RULES).where(F.arrays_overlap("rule_risk_tags", F.array(F.lit("insult"), F.lit("waste")))).select("comment_id", F.array_join("rule_risk_tags", ",").alias("risks"), "like_count")


@query(f"{RULED} select case when low_info then 'D' when like_count >= 50 or reply_count >= 10 then 'A' when len(topics) > 0 or char_len >= 12 then 'B' else 'C' end as tier, count(*) as n from r group by 1")
def value_tiers(spark, sf):
    return ruled(spark, sf).groupBy(A.tier().alias("tier")).agg(F.count("*").alias("n"))


DAYS = f"{RULED}, y as (select *, cast(ordinal % 28 + 1 as varchar) as day, case when reply_count % 2 = 0 then 'true' else 'false' end as vip from r)"


def by_day(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"day": (F.pmod("ordinal", F.lit(28)) + 1).cast("string"), "vip": F.when(F.col("reply_count") % 2 == 0, "true").otherwise("false")})


@query(f"{DAYS} select value as left_value, user_id as right_value, {SUMS} from (select unnest(topics) as value, * from y) group by 1, 2")
def crosstab_topic_user(spark, sf):
    return A.crosstab(features(doc_comments(spark, sf), RULES), F.explode("rule_topic_tags"), F.col("user_id"))


@query(f"{DAYS} select value as left_value, vip as right_value, {SUMS} from (select unnest(risks) as value, * from y) group by 1, 2")
def crosstab_risk_flag(spark, sf):
    return A.crosstab(by_day(features(doc_comments(spark, sf), RULES)), F.explode("rule_risk_tags"), F.col("vip"))


@query(f"{DAYS} select value as left_value, day as right_value, {SUMS} from (select unnest(topics) as value, * from y) group by 1, 2")
def crosstab_topic_day(spark, sf):
    return A.crosstab(by_day(features(doc_comments(spark, sf), RULES)), F.explode("rule_topic_tags"), F.col("day"))


@query(f"{DAYS} select cast(mobilization as varchar) as left_value, user_id as right_value, {SUMS} from y group by 1, 2")
def crosstab_mobilization_user(spark, sf):
    return A.crosstab(features(doc_comments(spark, sf), RULES), F.col("is_mobilization").cast("string"), F.col("user_id"))


@query(f"{LABELED} select stance as left_value, case when cast(comment_id as bigint) % 13 % 2 = 0 then 'true' else 'false' end as right_value, {SUMS} from z group by 1, 2")
def crosstab_stance_flag(spark, sf):
    return A.crosstab(by_day(labeled(spark, sf)), F.col("stance"), F.col("vip"))


@query(f"{RULED}, v as (select value, comment_id, like_count, row_number() over (partition by value order by like_count desc, ordinal) as place from (select unnest(topics) as value, * from r where priority = 'high')) select * from v where place <= 5")
def value_samples(spark, sf):
    return A.samples(ruled(spark, sf), "rule_topic_tags", 5).select("value", "comment_id", "like_count", "place")
