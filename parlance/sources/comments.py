"""Comment files: raw exports, the typed fact table, JSON lines and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import text as T

#: The fact table's columns in order. Fixed values.
COLUMNS = {
    "comment_id": "string", "parent_comment_id": "string", "user_id": "string", "username": "string", "user_level": "bigint", "gender": "string", "comment_text_raw": "string", "comment_text_clean": "string", "comment_time": "timestamp_ntz", "reply_count": "bigint", "like_count": "bigint",
    "signature": "string", "ip_location": "string", "vip_flag": "boolean?", "avatar_url": "string", "source_file": "string", "is_root": "boolean", "reply_depth": "int", "is_direct_reply_to_root": "boolean", "char_len": "int", "token_len": "int", "is_empty_text": "boolean", "is_short_text": "boolean",
    "is_only_emoji_or_punct": "boolean", "is_template_text": "boolean", "template_group": "string", "canonical_template_group": "string", "is_low_info": "boolean", "is_mobilization": "boolean", "rule_topic_tags": "array<string>", "rule_risk_tags": "array<string>", "analysis_priority": "string", "sentiment": "string",
    "stance": "string", "topic_tags": "array<string>", "emotion_intensity": "string", "risk_tags": "array<string>", "is_low_info_confirmed": "boolean?", "is_mobilization_confirmed": "boolean?", "summary_reason": "string",
}
RAW_HEADERS = {"comment_id": "评论ID", "parent_comment_id": "上级评论ID", "user_id": "用户ID", "username": "用户名", "user_level": "用户等级", "gender": "性别", "text": "评论内容", "time": "评论时间", "replies": "回复数", "likes": "点赞数", "signature": "个性签名", "ip_location": "IP属地", "avatar_url": "头像"}
VIP_HEADERS = ("是否是大会员", "是否为大会员")


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as strings, in file order under ``ordinal``: a file with line feeds inside quotes is one partition; one without can be split."""
    rows = spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"').csv(path)
    return rows.withColumns({"ordinal": F.monotonically_increasing_id(), "source_file": F.element_at(F.split(F.input_file_name(), "/"), -1) if "source_file" not in rows.columns else F.col("source_file")})


def named(rows: DataFrame, name: str):
    """Column: the header's text, '' where the file has no such header."""
    return T.text_of(F.col(f"`{name}`")) if name in rows.columns else F.lit("")


def defaults() -> dict:
    values = {"string": F.lit(""), "boolean": F.lit(False), "boolean?": F.lit(None).cast("boolean"), "int": F.lit(0), "array<string>": F.array().cast("array<string>")}
    return {c: values[t] for c, t in COLUMNS.items() if t in values} | {"analysis_priority": F.lit("medium")}


def normalized(spark: SparkSession, path: str) -> DataFrame:
    """The raw export as fact rows: typed, cleaned, with unique ids (first wins) and the rule and label columns at their defaults."""
    from parlance.operators.reply_tree import with_reply_metadata
    from parlance.operators.rules import first_by_id
    from parlance.plans.tables import written

    raw = read_csv(spark, path)
    at = {k: named(raw, h) for k, h in RAW_HEADERS.items()}
    strip = T.strip
    vip = F.coalesce(F.nullif(named(raw, VIP_HEADERS[0]), F.lit("")), named(raw, VIP_HEADERS[1]))
    rows = raw.select(
        "ordinal", *[strip(at[c]).alias(c) for c in ("comment_id", "parent_comment_id", "user_id", "username", "gender", "signature", "ip_location", "avatar_url")], T.parse_count(at["user_level"]).alias("user_level"), T.raw_text(at["text"]).alias("comment_text_raw"), T.clean_text(at["text"]).alias("comment_text_clean"),
        T.parse_time(at["time"]).alias("comment_time"), F.coalesce(T.parse_count(at["replies"]), F.lit(0)).alias("reply_count"), F.coalesce(T.parse_count(at["likes"]), F.lit(0)).alias("like_count"), T.parse_yes_no(vip).alias("vip_flag"), "source_file",
    )
    rows = with_reply_metadata(written(first_by_id(rows)))
    rest = {c: v for c, v in defaults().items() if c not in rows.columns}
    return rows.withColumns(rest).select("ordinal", *COLUMNS)


def encoded(rows: DataFrame) -> DataFrame:
    """Fact rows as text: true/false, '' for null, times to the second, lists as JSON."""
    out = []
    for c, t in COLUMNS.items():
        v = F.col(c)
        v = F.to_json(v) if t == "array<string>" else F.date_format(v, "yyyy-MM-dd HH:mm:ss") if t == "timestamp_ntz" else v.cast("string")
        out.append(F.coalesce(v, F.lit("")).alias(c))
    return rows.select("ordinal", *out)


def in_files(rows: DataFrame, single: bool, *order) -> DataFrame:
    """Rows in order, in one file or in as many as the sort makes, in the order of their names."""
    return rows.coalesce(1).sortWithinPartitions(*order) if single else rows.orderBy(*order)


def write_fact_csv(rows: DataFrame, path: str, single: bool = True) -> None:
    out = in_files(encoded(rows), single, "ordinal").drop("ordinal")
    out.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path)


def read_fact_csv(spark: SparkSession, path: str) -> DataFrame:
    rows = read_csv(spark, path)
    decode = {"string": lambda c: c, "bigint": T.parse_plain_int, "int": lambda c: F.coalesce(T.parse_plain_int(c), F.lit(0)).cast("int"), "timestamp_ntz": T.parse_time, "boolean": T.parse_bool, "boolean?": T.parse_optional_bool, "array<string>": T.parse_list}
    out = {c: decode[t](named(rows, c)) for c, t in COLUMNS.items()}
    out |= {c: F.coalesce(out[c], F.lit(0)) for c in ("reply_count", "like_count")} | {"analysis_priority": F.coalesce(F.nullif(out["analysis_priority"], F.lit("")), F.lit("medium"))}
    return rows.select("ordinal", *[v.alias(c) for c, v in out.items()])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, ordinal) of a text's lines that are not blank, in file order."""
    rows = spark.read.text(path).withColumn("ordinal", F.monotonically_increasing_id())
    return rows.where(T.strip("value") != "")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines under a schema; blank lines are skipped, a broken one fails the query."""
    return read_lines(spark, path).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"), "ordinal").select("r.*", "ordinal")


def write_json(rows: DataFrame, path: str, *by: str) -> None:
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*by) if by else writer).json(path)


def write_named(rows: DataFrame, path: str, by: str, ending: str) -> None:
    """JSON lines, one file for each value of ``by`` and named after it. A value's rows must fit into a task; files are renamed one by one."""
    spark = rows.sparkSession
    write_json(rows.repartition(by).sortWithinPartitions(by, "ordinal").drop("ordinal"), path, by)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(at(path)):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith(f"{by}="):
            parts = [x.getPath() for x in fs.listStatus(folder.getPath()) if x.getPath().getName().startswith("part-")]
            fs.rename(parts[0], at(path, name.removeprefix(f"{by}=") + ending))
            fs.delete(folder.getPath(), True)


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """One file: a row a value."""
    out = in_files(summary.select("value", "comment_count", "unique_user_count", "like_count_sum"), True, F.desc("comment_count"), F.desc("like_count_sum"), "value")
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
