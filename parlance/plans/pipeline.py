"""The comment pipeline's stages and its command line."""

from __future__ import annotations

import argparse
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions import labels as V
from parlance.operators import aggregate as A
from parlance.operators import export as E
from parlance.operators import labeller
from parlance.operators.merge import merge_labels, typed_labels
from parlance.operators.rules import apply_rules
from parlance.sources import comments as S
from parlance.sources.settings import get_settings

REQUEST = "comment_id string, comment_text_clean string, parent_comment_id string, is_root boolean, like_count bigint, reply_count bigint, char_len int, template_group string, rule_flags struct<is_template_text:boolean,is_mobilization:boolean,rule_topic_tags:array<string>,rule_risk_tags:array<string>,analysis_priority:string>"
REPORTS = (("stance", A.by_field), ("sentiment", A.by_field), ("topic_tags", A.by_items))


def model_inputs(ruled: DataFrame) -> DataFrame:
    return E.requests(E.in_order(E.representatives(E.eligible(ruled))))


def one_file(rows: DataFrame, single: bool) -> DataFrame:
    return rows.coalesce(1) if single else rows


def reports(rows: DataFrame, path: str) -> None:
    for field, how in REPORTS:
        S.write_summary_csv(how(rows, field), f"{path}/{field}_summary.csv")


def profile_text(rows: DataFrame, requests: DataFrame) -> str:
    """A run's counters as text; the collected rows are one a counter or tag."""
    flags, sizes = A.profile_flags(rows).first().asDict(), A.compression(rows, requests).first().asDict()
    lines = [f"{k}: {v}" for k, v in (flags | {k: v for k, v in sizes.items() if k != "total"}).items()]
    for name, value in (("priority", F.col("analysis_priority")), ("topic", F.explode("rule_topic_tags")), ("risk", F.explode("rule_risk_tags"))):
        lines += [f"{name} {r['value']}: {r['n']}" for r in A.histogram(rows, value).collect()]
    return "\n".join(lines)


def profile(spark: SparkSession, source: str, out: str) -> str:
    """Prints and writes the counters of a fact table by the rules."""
    ruled = apply_rules(S.read_fact_csv(spark, source))
    text = profile_text(ruled, E.representatives(E.eligible(ruled)))
    spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(out)
    print(text)
    return text


def run_batch(spark: SparkSession, source: str, out: str, chat, model: str, tasks: int = 1, done: str | None = None) -> dict:
    """Labels a batch, or what ``done``, the raw rows of an earlier run, lacks of it; returns and prints its counters. The batch's id is the file's name without its ending."""
    rows = S.read_json(spark, source, f"{REQUEST}, run_id string, batch_id string, request_id string").drop("ordinal")
    S.write_json(labeller.label(rows, chat, model, tasks, S.read_json(spark, done, labeller.RAW) if done else None), out)
    raw = S.read_json(spark, out, labeller.RAW)
    counts = raw.agg(F.count("*").alias("request_count"), F.count_if("ok").alias("success_count"), F.count_if(~F.col("ok")).alias("failure_count")).first().asDict()
    counts = {"batch_id": PurePath(source.rstrip("/")).name.partition(".")[0].removeprefix("batch=")} | counts
    print(counts)
    return counts


def run_pipeline(spark: SparkSession, source: str, out: str, label_file: str | None = None, single: bool = True) -> None:
    """Raw file to normalized, ruled and requests, and with labels to labelled rows and reports; Parquet between stages."""
    S.normalized(spark, source).write.mode("overwrite").parquet(f"{out}/normalized")
    apply_rules(spark.read.parquet(f"{out}/normalized")).write.mode("overwrite").parquet(f"{out}/ruled")
    ruled = spark.read.parquet(f"{out}/ruled")
    S.write_json(one_file(model_inputs(ruled), single), f"{out}/model_input")
    if label_file:
        merge_labels(ruled, typed_labels(S.read_lines(spark, label_file))).write.mode("overwrite").parquet(f"{out}/labeled")
        reports(spark.read.parquet(f"{out}/labeled"), f"{out}/reports")


def validate(spark: SparkSession, source: str, out: str, failures: str) -> dict[str, int]:
    tagged = V.validated(S.read_json(spark, source, labeller.RAW)).cache()
    valid, failed = (tagged.where(f"failure is {x}null") for x in ("", "not "))
    S.write_json(valid.select("label.*", "request_id", "run_id", "batch_id", "model"), out)
    S.write_json(failed.select("request_id", "run_id", "batch_id", "comment_id", "template_group", F.col("failure").alias("error"), "response_text", "model"), failures)
    counts = tagged.agg(F.count_if(F.col("failure").isNull()).alias("valid"), F.count_if(F.col("failure").isNotNull()).alias("failed")).first().asDict()
    tagged.unpersist()
    return counts


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="parlance", description="Comment pipeline on Spark")
    commands = p.add_subparsers(dest="command")

    def add(name: str, needed: tuple, optional: tuple = ()) -> None:
        c = commands.add_parser(name)
        for option in needed:
            c.add_argument(f"--{option}", required=True, type=int if option == "batch-size" else str)
        for option in optional:
            if option == "part-files":
                c.add_argument("--part-files", action="store_true", help="many files, in order, and not one")
            else:
                c.add_argument(f"--{option}", type={"timeout-seconds": float, "tasks": int, "attempts": int}.get(option, str))

    add("normalize", ("input", "output"), ("part-files",))
    add("prepare-model", ("input", "records-output", "jsonl-output"), ("part-files",))
    add("merge-labels", ("input", "labels", "output"), ("part-files",))
    add("profile", ("input", "output"))
    add("aggregate", ("input", "output-dir"))
    add("build-batches", ("input", "output-dir", "batch-size", "run-id"), ("part-files",))
    add("run-batch-label", ("input", "output"), ("base-url", "model", "timeout-seconds", "tasks", "attempts", "done"))
    add("validate-labels", ("input", "output", "failures-output"))
    add("run-pipeline", ("input", "output-dir"), ("labels", "part-files"))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command is None:
        return 0
    spark = spark or SparkSession.builder.appName("parlance").getOrCreate()
    if a.command == "normalize":
        S.write_fact_csv(S.normalized(spark, a.input), a.output, not a.part_files)
    elif a.command == "prepare-model":
        ruled = apply_rules(S.read_fact_csv(spark, a.input))
        S.write_fact_csv(ruled, a.records_output, not a.part_files)
        S.write_json(one_file(model_inputs(ruled), not a.part_files), a.jsonl_output)
    elif a.command == "merge-labels":
        S.write_fact_csv(merge_labels(S.read_fact_csv(spark, a.input), typed_labels(S.read_lines(spark, a.labels))), a.output, not a.part_files)
    elif a.command == "profile":
        profile(spark, a.input, a.output)
    elif a.command == "aggregate":
        reports(S.read_fact_csv(spark, a.input), a.output_dir)
    elif a.command == "build-batches":
        rows = E.batched(S.read_json(spark, a.input, REQUEST), a.batch_size, a.run_id, "ordinal").withColumn("batch", F.col("batch_id"))
        if a.part_files:
            S.write_json(rows.drop("ordinal"), a.output_dir, "batch")
        else:
            S.write_named(rows, a.output_dir, "batch", ".jsonl")
    elif a.command == "run-batch-label":
        s = get_settings(base_url=a.base_url, model=a.model, timeout_seconds=a.timeout_seconds)
        run_batch(spark, a.input, a.output, labeller.Chat(s.base_url, s.api_key, s.timeout_seconds, a.attempts or 1), s.model, a.tasks or 1, a.done)
    elif a.command == "validate-labels":
        print(validate(spark, a.input, a.output, a.failures_output))
    elif a.command == "run-pipeline":
        run_pipeline(spark, a.input, a.output_dir, a.labels, not a.part_files)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
