"""Rule features, tags, repeat groups and priority."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import lexicons as L
from parlance.functions import text as T
from parlance.plans.tables import sent, written


@dataclass(frozen=True)
class Rules:
    """Lexicons and thresholds; the defaults are the pipeline's own."""

    low_info: tuple = L.LOW_INFO
    mobilization: tuple = L.MOBILIZATION
    topics: tuple = L.TOPICS
    risks: tuple = L.RISKS


def first_by_id(rows: DataFrame) -> DataFrame:
    """Rows with an id, the one of least ordinal for each."""
    return rows.where("comment_id <> ''").withColumn("rn", F.row_number().over(Window.partitionBy("comment_id").orderBy("ordinal"))).where("rn = 1").drop("rn")


#: Columns of the text alone that no rule reads.
LATE = ("token_len", "is_mobilization", "rule_risk_tags", "canonical_template_group")
#: Columns that need the text itself, those that need near-verbatim groups, and those that the priority reads.
TEXTS = ("comment_text_clean", "template_group", "canonical_template_group")
NEAR = ("is_template_text", "template_group", "key_template_group", "key_canonical_template_group")
READ = ("ordinal", "is_low_info", "like_count", "reply_count", "char_len", "rule_topic_tags")


def of_text(rules: Rules, *names: str) -> dict[str, Column]:
    """The columns, or those named, that are made of the clean text."""
    c = F.col("comment_text_clean")
    every = {"char_len": T.char_len(c), "token_len": T.token_len(c), "is_empty_text": c == "", "is_only_emoji_or_punct": T.only_symbols(c), "is_mobilization": T.contains_any(c, rules.mobilization), "rule_topic_tags": T.tags(c, rules.topics), "rule_risk_tags": T.tags(c, rules.risks), "canonical_template_group": T.canonical(c)}
    return {k: v for k, v in every.items() if k in names or not names}


def features(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:  # noqa: B008
    """Adds what depends on a row's clean text alone."""
    c = F.col("comment_text_clean")
    out = rows.withColumns(of_text(rules))
    low = (c == "") | c.isin(*rules.low_info) | F.col("is_only_emoji_or_punct") | ((F.col("char_len") <= L.LOW_INFO_LENGTH) & (F.size("rule_topic_tags") == 0))
    return out.withColumns({"is_short_text": F.col("char_len") <= L.SHORT, "is_low_info": low})


def flagged(slim: DataFrame, key: str, name: str) -> DataFrame:
    """Adds whether a key that is not null occurs more than once. Counts are added up before the shuffle and only repeated keys are joined back."""
    often = slim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.col(key).alias("often"))
    # Written, as only a join of two plain shuffles can be dealt anew where a group is large.
    return slim.join(sent(written(often)), F.col(key) == F.col("often"), "left").withColumn(name, F.col("often").isNotNull()).drop("often")


def marks(repeats: DataFrame, *names: str) -> DataFrame:
    """A row for each 64 ordinals of which some have a flag: ``word`` and the bits of each flag, so that up to 64 times as many rows can be marked by a broadcast."""
    bit = F.expr("shiftleft(1L, cast(ordinal & 63 as int))")
    return repeats.groupBy(F.shiftright(F.col("ordinal").cast("bigint"), 6).alias("word")).agg(*[F.bit_or(F.when(F.col(c), bit).otherwise(F.lit(0).cast("bigint"))).alias(c) for c in names])


def marked(rows: DataFrame, words: DataFrame, *names: str) -> DataFrame:
    """Adds the flags of ``marks`` to all rows."""
    out = rows.join(words, F.shiftright(F.col("ordinal").cast("bigint"), 6) == F.col("word"), "left").drop("word")
    return out.withColumns({c: F.coalesce(F.getbit(c, F.col("ordinal").bitwiseAND(63).cast("int")) == 1, F.lit(False)) for c in names})


def apply_rules(rows: DataFrame, rules: Rules = Rules(), columns: tuple[str, ...] = ()) -> DataFrame:  # noqa: B008
    """All rule columns, or those named, and the keys of the group columns; ``ordinal`` tells rows apart. The priority sees verbatim repeats only; near-verbatim groups then
    override the repeat columns.

    What the rules read is computed once and written, with one text a row; repeats are counted on rows of an ordinal and two keys, never on texts. What no
    rule reads is left to the reader who selects it, a group's text is made for repeats alone. If columns are named, what none of them needs is not made: no
    text is written where they have none, and no canonical form is made where they have no group.
    """
    texts, grouped = (not columns or bool(set(names) & set(columns)) for names in (TEXTS, NEAR))
    made = features(rows, rules)
    late = of_text(rules, *LATE) if texts else {}
    keys = {f"key_{c}": F.when(F.col(c) != "", T.key(c)) for c in (TEXTS[0], TEXTS[2]) if grouped or c == TEXTS[0]}
    held = [c for c in made.columns if c not in (LATE if texts else TEXTS) and (not columns or c in (*columns, *READ) or c == TEXTS[0])]
    base = written(made.withColumns(keys).select(*held, *keys))
    slim = flagged(base.select("ordinal", *keys), "key_comment_text_clean", "exact")
    slim = flagged(slim, "key_canonical_template_group", "near") if grouped else slim.withColumn("near", F.lit(False))
    out = marked(base, sent(written(marks(slim.where("exact or near"), "exact", "near"))), "exact", "near")
    if not grouped:
        out = out.withColumn("key_canonical_template_group", F.lit(None).cast("binary"))
    high = (F.col("like_count") >= L.HIGH_LIKES) | (F.col("reply_count") >= L.HIGH_REPLIES) | F.col("exact") | (F.col("char_len") >= L.LONG) | (F.size("rule_topic_tags") > 0)
    group = lambda near, exact, none: F.when(F.col("near"), near).when(F.col("exact"), exact).otherwise(none)
    out = out.withColumns(late | {
        "analysis_priority": F.when(F.col("is_low_info"), "low").when(high, "high").otherwise("medium"),
        "is_template_text": F.col("exact") | F.col("near"),
        **({"template_group": group(late["canonical_template_group"], F.col("comment_text_clean"), F.lit(""))} if texts else {}),
        "key_template_group": group(F.col("key_canonical_template_group"), F.col("key_comment_text_clean"), F.lit(None)),
    })
    names = dict.fromkeys([*made.columns, "analysis_priority", "is_template_text", "template_group", "key_template_group", "key_canonical_template_group"])
    return out.select(*(columns or names))
