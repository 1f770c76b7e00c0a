"""Labels back onto comments: by id, else by repeat group, else by canonical group; the whole payload of the first hit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions import text as T
from parlance.plans.tables import written

TEXTS, LISTS, FLAGS = ("sentiment", "stance", "emotion_intensity", "summary_reason"), ("topic_tags", "risk_tags"), ("is_low_info_confirmed", "is_mobilization_confirmed")
PAYLOAD = TEXTS + LISTS + FLAGS


def optional_bool(v):
    """Column: a boolean or its usual spellings; else null."""
    s = F.lower(T.strip(F.try_variant_get(v, "$", "string")))
    return F.when(s.isin("true", "1", "yes"), True).when(s.isin("false", "0", "no"), False)


def string_list(v):
    """Column: a list's items, a scalar as the only item, nothing for null."""
    items = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string"))
    scalar = F.try_variant_get(v, "$", "string")
    return F.coalesce(items, F.when(scalar.isNotNull(), F.array(scalar)), F.array().cast("array<string>"))


def typed_labels(lines: DataFrame) -> DataFrame:
    """``lines``: value (JSON text), ordinal. Key columns and the payload as typed columns; a line that is no JSON fails the query."""
    v = F.parse_json("value")
    at = lambda name: F.try_variant_get(v, f"$.{name}", "variant")
    text = lambda name: F.coalesce(F.when(F.try_variant_get(v, f"$.{name}", "string").isin("false", "0"), "").otherwise(F.try_variant_get(v, f"$.{name}", "string")), F.lit("")).alias(name)
    return lines.select("ordinal", text("comment_id"), text("template_group"), *[text(c) for c in TEXTS], *[string_list(at(c)).alias(c) for c in LISTS], *[optional_bool(at(c)).alias(c) for c in FLAGS])


def lookup(labels: DataFrame, name: str) -> DataFrame:
    """One payload for each key in column ``name`` that is not null: the last line's."""
    return labels.where(F.col(name).isNotNull()).groupBy(name).agg(F.max_by(F.struct(*PAYLOAD), "ordinal").alias(f"payload_{name}"))


def merge_labels(records: DataFrame, labels: DataFrame) -> DataFrame:
    """``records`` need ordinal, which tells rows apart, comment_id, template_group, canonical_template_group and the payload columns; ``labels`` typed, with ordinal.

    Lookups run on rows of an ordinal and keys of 32 bytes, of the records and of the labels; records and their texts are joined once, with the payload that was found.
    """
    of = {"by_id": ("comment_id", "comment_id"), "by_group": ("template_group", "template_group"), "by_form": ("canonical_template_group", "form")}
    keyed = labels if "key_form" in labels.columns else labels.withColumn("form", T.canonical("template_group"))
    labels = written(keyed.select("ordinal", *PAYLOAD, *[T.key_of(keyed, right).alias(name) for name, (_, right) in of.items()]))
    slim = written(records.select(F.col("ordinal").alias("of"), *[T.key_of(records, left).alias(f"key_{name}") for name, (left, _) in of.items()]))
    for name in of:
        # Written, as only a join of two plain shuffles can be dealt anew where a group is large.
        slim = slim.join(written(lookup(labels, name)), F.col(f"key_{name}") == F.col(name), "left").drop(name)
    hits = written(slim.select("of", F.coalesce("payload_by_id", "payload_by_group", "payload_by_form").alias("hit")).where("hit is not null"))
    out = records.join(hits, F.col("ordinal") == F.col("of"), "left")
    return out.withColumns({c: F.when(F.col("hit").isNotNull(), F.col("hit")[c]).otherwise(F.col(c)) for c in PAYLOAD}).drop("hit", "of")
