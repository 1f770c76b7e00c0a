import re

import pytest
from pyspark.sql import functions as F

from parlance.functions import lexicons as L
from parlance.functions import text as T
from parlance.operators import aggregate as A
from parlance.operators import export, merge, rules
from parlance.plans import catalogue as C
from parlance.plans.tables import written

SF = "/root/testdata/sf0.001"
TEXTS = {"comment_text_clean", "template_group", "canonical_template_group", "text"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_canonical_form_looks_signs_up_and_is_that_of_the_expressions(spark):
    every = spark.range(0x10FFFF + 1).where("id < 55296 or id > 57343")
    hexed = F.when(F.col("id") < 0x80, F.hex("id")).otherwise(F.hex(F.encode(F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex("id"), 8, "0"))), "UTF-32"), "UTF-8")))
    rows = every.select(F.concat(F.lit("a"), F.unhex(F.when(F.length(hexed) % 2 == 1, F.concat(F.lit("0"), hexed)).otherwise(hexed)).cast("string"), F.lit("[ab]b")).alias("t"))
    old = F.col("t")
    for pattern in C.SQL_REMOVED:
        old = F.regexp_replace(old, pattern, "")
    assert rows.where(F.length("t") != 7).count() == 0
    assert rows.where(T.canonical("t") != old).count() == 0
    assert rows.where(T.canonical("t") == "ab").count() == len(L.REMOVED)
    assert plan(rows.select(T.canonical("t").alias("x"))).count("regexp_replace(") == 1


@pytest.mark.parametrize("name", ["merge_three_tier", "merge_by_id", "export_order", "compression_ratio", "value_tiers"])
def test_one_text_a_row_is_written(spark, monkeypatch, name):
    held = []
    for module in (rules, export, merge):
        monkeypatch.setattr(module, "written", lambda df: held.append(TEXTS & set(df.columns)) or written(df))
    C.QUERIES[name](spark, SF)
    assert [x for x in held if x] == [{"comment_text_clean"}]


@pytest.mark.parametrize("name", ["deduplicated_counts", "compression_ratio", "export_order"])
def test_groups_are_counted_by_keys(spark, name):
    assert not re.search(r"\b(comment_text_clean|template_group|canonical_template_group)#", plan(C.QUERIES[name](spark, SF)))


def test_keys_of_groups_are_those_of_their_texts(spark):
    rows = C.ruled(spark, SF)
    of = lambda c: F.when(F.col(c) != "", T.key(c))
    assert rows.where("template_group <> ''").count() > 10
    assert rows.where(~F.col("key_template_group").eqNullSafe(of("template_group")) | ~F.col("key_canonical_template_group").eqNullSafe(of("canonical_template_group"))).count() == 0


def test_labels_are_joined_to_keys_and_not_to_texts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(C.doc_labels(spark, SF).select("ordinal", "key_template_group", "key_form"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"\b(comment_text_clean|template_group)#", shown[: shown.index("Exchange")])


@pytest.mark.parametrize("name", ["request_rows", "profile_flags", "analysis_priority", "profile_priority"])
def test_no_text_is_written_where_none_is_asked_for(spark, monkeypatch, name):
    held = []
    for module in (rules, export, merge):
        monkeypatch.setattr(module, "written", lambda df: held.append(TEXTS & set(df.columns)) or written(df))
    shown = plan(C.QUERIES[name](spark, SF))
    assert held and not any(held)
    assert not re.search(r"\b(comment_text_clean|template_group|canonical_template_group)#", shown)


def test_priority_makes_no_canonical_form(spark, monkeypatch):
    held = []
    monkeypatch.setattr(rules, "written", lambda df: held.append(plan(df)) or written(df))
    C.QUERIES["analysis_priority"](spark, SF)
    assert held and not any(L.REMOVED_CLASS in x for x in held)


def test_repeats_are_marked_by_words_of_64_rows(spark):
    """Rows whose repeats are many more than the words that mark them; ordinals may be negative, far apart or missing."""
    rows = spark.range(-3000, 3000).selectExpr("id as ordinal", "pmod(id, 7) = 2 as exact", "pmod(id, 5) = 1 as near").union(spark.sql("select 9000000000000063L, true, true"))
    words = rules.marks(rows.where("exact or near"), "exact", "near")
    assert words.count() == 95
    got = rules.marked(rows.select("ordinal").union(spark.sql("select cast(null as bigint)")), words, "exact", "near")
    want = rows.union(spark.sql("select cast(null as bigint), false, false"))
    assert got.count() == 6002 and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("name", ["template_canonical", "template_top"])
def test_texts_are_not_shuffled_to_mark_repeats(spark, monkeypatch, name):
    """With fewer broadcast rows allowed than there are repeats, as at size."""
    from parlance.plans import tables

    repeats = C.ruled(spark, SF).where("is_template_text").count()
    monkeypatch.setattr(tables, "MAX_SENT", 20)
    assert repeats > 20
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(C.QUERIES[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for part in re.findall(r"Exchange hashpartitioning\((.*?)\)", shown):
        assert "ordinal" not in part and "template_group" not in part


def test_top_templates_breaks_ties_by_text(spark):
    rows = spark.createDataFrame([(i, "u", 1, t) for i, t in enumerate(["b", "a", "c", "c", "a", "b", "", "", "", "d", "e", "e", "e"])], "ordinal bigint, user_id string, like_count bigint, template_group string")
    assert [(r["template_group"], r["comment_count"], r["unique_user_count"], r["like_count_sum"]) for r in A.top_templates(rows, 3).collect()] == [("e", 3, 1, 3), ("a", 2, 1, 2), ("b", 2, 1, 2)]


def test_clean_text_is_that_of_the_expression_for_every_sign(spark):
    every = spark.range(0x10FFFF + 1).where("id < 55296 or id > 57343")
    hexed = F.when(F.col("id") < 0x80, F.hex("id")).otherwise(F.hex(F.encode(F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex("id"), 8, "0"))), "UTF-32"), "UTF-8")))
    sign = F.unhex(F.when(F.length(hexed) % 2 == 1, F.concat(F.lit("0"), hexed)).otherwise(hexed)).cast("string")
    rows = every.select(F.explode(F.array(F.concat(sign, F.lit("a"), sign, F.lit("b"), sign), F.concat(sign, F.lit(" a\n"), sign, F.lit("b "), sign, sign))).alias("t"))
    old = T.strip(F.regexp_replace("t", f"{L.WS}+", " "))
    assert rows.where(~T.clean_text("t").eqNullSafe(old)).count() == 0
