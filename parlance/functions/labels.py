"""Validation of model labels held as JSON text, by the dynamic types of a variant. The first failing check is the error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions import lexicons as L
from parlance.functions.text import strip

FIELDS = ("comment_id", "template_group", "sentiment", "stance", "topic_tags", "emotion_intensity", "risk_tags", "is_low_info_confirmed", "is_mobilization_confirmed", "confidence", "summary_reason")
#: Fields that count as present, with a null value, where they are absent.
FILLED = ("stance", "topic_tags", "risk_tags")


def mapped(c: Column, aliases: dict) -> Column:
    """The name that has ``c`` among its aliases, else null."""
    out = None
    for name, words in aliases.items():
        out = F.when(c.isin(*words), F.lit(name)) if out is None else out.when(c.isin(*words), F.lit(name))
    return out


def field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def kind(v: Column, name: str) -> Column:
    """STRING, BIGINT, DECIMAL(..), DOUBLE, BOOLEAN, ARRAY<..>, OBJECT<..>, VOID (JSON null) or null where absent."""
    return F.schema_of_variant(field(v, name))


def shown(v: Column, name: str) -> Column:
    """The value as text; JSON null and booleans as ``None``, ``True`` and ``False``."""
    k, s = kind(v, name), F.try_variant_get(v, f"$.{name}", "string")
    return F.when(k.isNull() | (k == "VOID"), "None").when(k == "BOOLEAN", F.initcap(s)).otherwise(s)


def is_number(k: Column) -> Column:
    return k.isin("BIGINT", "DOUBLE", "FLOAT") | k.startswith("DECIMAL")


def choice(v: Column, name: str, aliases: dict) -> Column:
    s = strip(shown(v, name))
    return F.coalesce(mapped(F.lower(s), aliases), mapped(s, aliases), s)


def intensity_bucket(x: Column) -> Column:
    return F.when((x < 0) | (x > 10), None).when(x <= 0.33, "低").when(x <= 0.66, "中").when(x <= 1, "高").when(x <= 3, "低").when(x <= 6, "中").otherwise("高")


def stance(v: Column) -> Column:
    s = strip(shown(v, "stance"))
    is_text = kind(v, "stance") == "STRING"
    flag = kind(v, "is_mobilization_confirmed")
    number = F.try_variant_get(v, "$.is_mobilization_confirmed", "string")
    truthy = F.coalesce((flag != "VOID") & ~number.isin("false", "0", "0.0", "", "[]", "{}"), F.lit(False))
    return F.when(is_text, F.coalesce(mapped(F.lower(s), L.STANCE_ALIASES), mapped(s, L.STANCE_ALIASES), F.when(s.isin(*L.BARE_SUPPORT), F.when(truthy, "跟随主评动员").otherwise("无法判断")), s)).otherwise(s)


def tag_list(v: Column, name: str, aliases: dict, dropped=()) -> Column:
    texts = F.transform(F.try_variant_get(v, f"$.{name}", "array<variant>"), lambda x: strip(F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("None"))))
    named = F.transform(F.filter(texts, lambda s: s != ""), lambda s: F.coalesce(mapped(F.lower(s), aliases), mapped(s, aliases), s))
    return F.array_distinct(F.filter(named, lambda s: ~s.isin(*dropped)) if dropped else named)


def confidence(v: Column) -> Column:
    k, s = kind(v, "confidence"), F.try_variant_get(v, "$.confidence", "string")
    number = F.when(k == "BOOLEAN", (s == "true").cast("double")).when(is_number(k) | (k == "STRING"), strip(s).try_cast("double"))
    return F.coalesce(F.when(k == "STRING", mapped(F.lower(strip(s)), L.CONFIDENCE_WORDS)), number)


def once(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once a row: projections would be merged with the next ones, and what these use often computed as often."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in values.items()]))))


def validated(raw: DataFrame) -> DataFrame:
    """Raw results with typed label columns in a struct ``label`` and ``failure``, null for valid rows.

    A payload that is no JSON object fails as ``invalid_json: ...``; a confidence that is not a number in [0, 1] fails, NaN included.
    """
    v = F.col("v")
    missing = F.array_compact(F.array(*[F.when(field(v, f).isNull(), F.lit(f)) for f in FIELDS if f not in FILLED]))
    kinds = ("stance", "emotion_intensity", "topic_tags", "risk_tags", "confidence", "is_low_info_confirmed", "is_mobilization_confirmed")
    out = once(raw, {"v": F.try_parse_json("response_text")})
    out = once(out, {"root": F.schema_of_variant(v), "missing": missing, **{f"k_{f}": kind(v, f) for f in kinds}})
    k = F.col("k_emotion_intensity")
    score = F.when(k == "BOOLEAN", (F.try_variant_get(v, "$.emotion_intensity", "string") == "true").cast("double")).when(is_number(k), F.try_variant_get(v, "$.emotion_intensity", "double"))
    out = once(out, {"v_sentiment": choice(v, "sentiment", L.SENTIMENT_ALIASES), "v_stance": stance(v), "v_score": score, "v_sure": confidence(v), "v_topics": tag_list(v, "topic_tags", L.TOPIC_ALIASES), "v_risks": tag_list(v, "risk_tags", L.RISK_ALIASES, L.DROPPED_RISKS), "v_choice": choice(v, "emotion_intensity", L.INTENSITY_ALIASES)})
    sentiment, place, score, sure, topics, risks = (F.col(f"v_{c}") for c in ("sentiment", "stance", "score", "sure", "topics", "risks"))
    strength, root, missing = F.when(score.isNotNull(), intensity_bucket(score)).otherwise(F.col("v_choice")), F.col("root"), F.col("missing")

    def one_of(name: str, value: Column, allowed) -> Column:
        return F.when(~F.coalesce(value.isin(*allowed), F.lit(False)), F.concat(F.lit(f"Invalid {name}: "), F.coalesce(value, F.lit("None"))))

    def listed(name: str, value: Column, allowed) -> Column:
        is_list = F.coalesce(F.col(f"k_{name}").startswith("ARRAY"), F.lit(False))
        bad = F.get(F.filter(value, lambda x: ~x.isin(*allowed)), F.lit(0))
        return F.when(~is_list, f"{name} must be a list").when(bad.isNotNull(), F.concat(F.lit(f"Invalid {name} value: "), bad))

    flag = lambda name: F.when(F.coalesce(F.col(f"k_{name}") != "BOOLEAN", F.lit(True)), f"{name} must be a bool")
    failure = F.coalesce(
        F.when(~F.coalesce(F.col("ok"), F.lit(False)), F.coalesce(F.nullif(F.col("error"), F.lit("")), F.lit("Raw request failed"))),
        F.when(root.isNull() | ~root.startswith("OBJECT"), F.concat(F.lit("invalid_json: "), F.coalesce(F.substring("response_text", 1, 80), F.lit("null")))),
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(missing, ", "))),
        one_of("sentiment", sentiment, L.SENTIMENTS),
        one_of("stance", place, L.STANCES),
        F.when(score.isNotNull() & ((score < 0) | (score > 10)), "Invalid emotion_intensity: out of range"),
        one_of("emotion_intensity", strength, L.INTENSITIES),
        listed("topic_tags", topics, L.TOPIC_TAGS),
        listed("risk_tags", risks, L.RISK_TAGS),
        F.when(sure.isNull(), "confidence must be numeric").when((sure < 0) | (sure > 1) | F.isnan(sure), "confidence must be between 0 and 1"),
        flag("is_low_info_confirmed"),
        flag("is_mobilization_confirmed"),
    )
    boolean = lambda name: F.try_variant_get(v, f"$.{name}", "boolean").alias(name)
    label = F.struct(
        shown(v, "comment_id").alias("comment_id"), shown(v, "template_group").alias("template_group"), sentiment.alias("sentiment"), place.alias("stance"), topics.alias("topic_tags"), strength.alias("emotion_intensity"), risks.alias("risk_tags"),
        boolean("is_low_info_confirmed"), boolean("is_mobilization_confirmed"), sure.alias("confidence"), strip(shown(v, "summary_reason")).alias("summary_reason"),
    )
    return once(out, {"failure": failure}).withColumn("label", F.when(F.col("failure").isNull(), label)).select(*raw.columns, "failure", "label")


def split(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and failed rows: disjoint and complete."""
    tagged = validated(raw)
    valid = tagged.where("failure is null").select("label.*", "request_id", "run_id", "batch_id", "model")
    failed = tagged.where("failure is not null").select("request_id", "run_id", "batch_id", "comment_id", "template_group", F.col("failure").alias("error"), "response_text", "model")
    return valid, failed
