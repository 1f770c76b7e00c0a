import json

import pytest
from pyspark.sql import functions as F

from parlance.functions import labels as V
from parlance.functions import text as T
from parlance.operators import aggregate as A
from parlance.operators import export as E
from parlance.operators import labeller
from parlance.operators.merge import merge_labels, typed_labels
from parlance.operators.reply_tree import reply_depth
from parlance.operators.rules import apply_rules
from parlance.plans.pipeline import main, run_batch
from parlance.sources import comments as S
from parlance.sources.settings import env_lines, get_settings

RAW = '''﻿序号,上级评论ID,评论ID,用户ID,用户名,用户等级,性别,评论内容,评论时间,回复数,点赞数,个性签名,IP属地,是否是大会员,头像
1,,c1,u1,用户甲,5,男,"第一行
第二行",2026-05-22 00:00:01,3,"1,234",,浙江,否,https://example.com/a.jpg
2,c1,c2,u2,用户乙,6,保密,顶,2026-5-2 0:00:02,0,5,签名,江苏,是,https://example.com/b.jpg
3,c1,c2,u2,用户乙,6,保密,重复评论,2026-05-22 00:00:03,0,6,签名,江苏,是,https://example.com/b.jpg
'''


def comments(spark, rows):
    return spark.createDataFrame([(i, f"c{i}", "", t, likes, replies, True) for i, (t, likes, replies) in enumerate(rows)], "ordinal bigint, comment_id string, parent_comment_id string, comment_text_clean string, like_count bigint, reply_count bigint, is_root boolean")


def test_raw_export_and_csv_round_trip(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(RAW, "utf-8")
    rows = S.normalized(spark, str(tmp_path / "raw.csv"))
    c1, c2 = (r.asDict() for r in rows.orderBy("ordinal").collect())
    assert (c1["comment_text_raw"], c1["comment_text_clean"], c1["is_root"], c1["like_count"]) == ("第一行\n第二行", "第一行 第二行", True, 1234)
    assert (c2["is_root"], c2["is_direct_reply_to_root"], c2["reply_depth"], c2["like_count"], c2["vip_flag"]) == (False, True, 1, 5, True)
    ruled = apply_rules(rows)
    S.write_fact_csv(ruled, str(tmp_path / "fact"))
    back = S.read_fact_csv(spark, str(tmp_path / "fact"))
    key = lambda df: sorted(map(str, df.select(*S.COLUMNS).collect()))
    assert key(back) == key(ruled)


@pytest.mark.parametrize(("given", "form"), [("认错态度不端正，处理方案难服众！", "认错态度不端正处理方案难服众"), ("冲[打call]", "冲"), ("冲冲冲😡😡", "冲冲冲"), ("", ""), ("顶", "顶"), ("冲!", "冲!"), ('他说"好"', '他说"好"'), ("a\\b", "a\\b"), ("'a' [b] @c", "ac"), ("❤️ a\u3000b\u200b👨\u200d👩", "ab"), ("[一二三四五六七八九十]x[]", "x"), ("[一二三四五六七八九十甲]x", "一二三四五六七八九十甲x")])
def test_canonical(spark, given, form):
    assert spark.createDataFrame([(given,)], "t string").select(T.canonical("t")).first()[0] == form


def test_text_functions(spark):
    df = spark.createDataFrame([("　a \t b \u0085", "😡", "❤️", "1,234", "[\"x\",1]", "y")], "t string, e string, h string, n string, l string, s string")
    row = df.select(T.clean_text("t"), T.only_symbols("e"), T.only_symbols("h"), T.parse_count("n"), T.parse_list("l"), T.token_len(T.clean_text("t")), T.parse_list("s")).first()
    assert tuple(row)[:6] == ("a b", True, False, 1234, ["x", "1"], 2)


def test_rules(spark):
    rows = [("顶", 0, 0), ("不接受这样的处理", 0, 0), ("认错态度不端正，处理方案难服众！", 100, 0), ("认错态度不端正，处理方案难服众！", 5, 0), ("今天天气真好！", 0, 0), ("今天天气真好。", 0, 0), ("", 0, 0), ("今天风很大", 49, 9), ("今天雨很大", 50, 0), ("今天雪很大", 0, 10), ("一二三四五六七八九十甲", 0, 0), ("一二三四五六七八九十甲乙", 0, 0)]
    r = [x.asDict() for x in apply_rules(comments(spark, rows)).orderBy("ordinal").collect()]
    assert (r[0]["is_low_info"], r[0]["is_mobilization"], r[0]["analysis_priority"]) == (True, True, "low")
    assert r[1]["rule_topic_tags"] == ["处理方案"] and not r[1]["is_low_info"]
    assert r[2]["is_template_text"] and r[2]["template_group"] == r[3]["template_group"] and r[2]["analysis_priority"] == "high"
    assert r[4]["is_template_text"] and r[4]["template_group"] == r[5]["template_group"] == "今天天气真好" and r[4]["analysis_priority"] == "medium"
    assert (r[6]["is_empty_text"], r[6]["is_short_text"], r[6]["token_len"], r[6]["analysis_priority"]) == (True, True, 0, "low")
    assert [x["analysis_priority"] for x in r[7:]] == ["medium", "high", "high", "medium", "high"]


def depths(spark, parents):
    return {r[0]: r[1] for r in reply_depth(spark.createDataFrame(list(parents.items()), "comment_id string, parent_comment_id string")).collect()}


def test_reply_depth(spark):
    parents = {"r": "", "a": "r", "b": "a", "dangling": "gone", "self": "self", "x": "y", "y": "x", "tail": "x", "tail2": "tail", "p": "q", "q": "s", "s": "p"}

    def expected(i):
        seen, now = [], parents[i]
        while now and now not in seen:
            seen.append(now)
            now = parents.get(now, "")
        return len(seen)

    assert depths(spark, parents) == {i: expected(i) for i in parents}
    chain = {"n0": ""} | {f"n{i}": f"n{i - 1}" for i in range(1, 150)}
    assert depths(spark, chain) == {f"n{i}": i for i in range(150)}


def test_representatives_order_and_batches(spark):
    rows = [("这是一条评论呀！", 1, 20), ("另一条不同的评论", 0, 20), ("这是一条评论呀", 9, 20), ("[打call]", 60, 0), ("[打call]", 60, 0), ("另一条不同的评论", 0, 20)]
    ruled = apply_rules(comments(spark, rows)).withColumn("is_low_info", F.lit(False)).withColumn("analysis_priority", F.lit("high"))
    chosen = E.in_order(E.representatives(E.eligible(ruled)))
    assert [r.comment_id for r in chosen.collect()] == ["c2", "c1", "c3", "c4"]
    got = E.batched(E.representatives(ruled).select("comment_id", "ordinal"), 3, "run", "ordinal").orderBy("ordinal").collect()
    assert [(r.comment_id, r.batch_id, r.request_id) for r in got][-1] == ("c4", "run-batch-0002", "run-000004")
    with pytest.raises(ValueError, match="batch_size"):
        E.batched(ruled, 0, "run", "ordinal")


BASE = {"comment_id": "c", "template_group": "", "sentiment": "负面", "stance": "观望", "topic_tags": [], "emotion_intensity": "高", "risk_tags": [], "is_low_info_confirmed": False, "is_mobilization_confirmed": True, "confidence": 0.91, "summary_reason": " r "}
CASES = [
    ({}, None, {}), ({"sentiment": "很生气"}, "Invalid sentiment: 很生气", {}), ({"sentiment": "negative", "stance": "against", "emotion_intensity": 8}, None, {"sentiment": "负面", "stance": "反对官方处理", "emotion_intensity": "高"}),
    ({"sentiment": "积极", "stance": "支持", "topic_tags": ["其他"], "emotion_intensity": 0.8, "risk_tags": ["煽动性言论", "质疑官方"], "confidence": "高"}, None, {"sentiment": "正面", "stance": "跟随主评动员", "topic_tags": ["无明确主题"], "risk_tags": ["煽动动员"], "confidence": 0.9}),
    ({"stance": None}, "Invalid stance: None", {}), ({"stance": ...}, "Invalid stance: None", {}), ({"confidence": ...}, "Missing required fields: confidence", {}), ({"topic_tags": "x"}, "topic_tags must be a list", {}), ({"topic_tags": ["x"]}, "Invalid topic_tags value: x", {}),
    ({"is_low_info_confirmed": 1}, "is_low_info_confirmed must be a bool", {}), ({"confidence": 2}, "confidence must be between 0 and 1", {}), ({"confidence": "a"}, "confidence must be numeric", {}), ({"emotion_intensity": True}, None, {"emotion_intensity": "高"}), ({"emotion_intensity": "8"}, "Invalid emotion_intensity: 8", {}),
    *[({"emotion_intensity": x}, None, {"emotion_intensity": y}) for x, y in zip((0, 0.33, 0.34, 0.66, 0.67, 1, 2, 3, 3.1, 6, 6.1, 10), "低低中中高高低低中中高高", strict=True)],
    *[({"emotion_intensity": x}, "Invalid emotion_intensity: out of range", {}) for x in (-1, 10.1)],
]


def test_label_validation(spark):
    rows = [(f"r{i}", "run", "b", f"c{i}", "g", True, json.dumps({k: v for k, v in (BASE | change).items() if v is not ...}, ensure_ascii=False), "", "m") for i, (change, _, _) in enumerate(CASES)]
    rows += [("f1", "run", "b", "c", "g", False, "", "", "m"), ("f2", "run", "b", "c", "g", True, "[]", "", "m"), ("f3", "run", "b", "c", "g", True, "nope", "", "m")]
    raw = spark.createDataFrame(rows, labeller.RAW)
    got = {r.request_id: r for r in V.validated(raw).collect()}
    for i, (change, error, values) in enumerate(CASES):
        r = got[f"r{i}"]
        assert r.failure == error, (change, r.failure)
        for k, v in values.items():
            assert r.label[k] == v, (change, k)
    assert got["f1"].failure == "Raw request failed" and got["f2"].failure.startswith("invalid_json") and got["f3"].failure.startswith("invalid_json")
    valid, failed = V.split(raw)
    assert valid.count() + failed.count() == len(rows)


def test_merge(spark):
    ruled = apply_rules(comments(spark, [("甲乙丙丁戊", 0, 0), ("甲乙丙丁戊！", 0, 0), ("独一无二的评论", 0, 0), ("没有标签的评论", 0, 0)]))
    none = {"topic_tags": F.array(F.lit("旧")), "risk_tags": F.array().cast("array<string>"), "is_low_info_confirmed": F.lit(None).cast("boolean"), "is_mobilization_confirmed": F.lit(None).cast("boolean")}
    records = ruled.withColumns({c: none.get(c, F.lit("old")) for c in ("sentiment", "stance", "emotion_intensity", "summary_reason", "topic_tags", "risk_tags", "is_low_info_confirmed", "is_mobilization_confirmed")})
    lines = [{"comment_id": "c0", "stance": ""}, {"comment_id": "x", "template_group": "甲乙丙丁戊", "stance": "组"}, {"comment_id": "c2", "stance": "一"}, {"comment_id": "c2", "stance": "二", "topic_tags": "单", "is_low_info_confirmed": "Yes"}]
    labels = typed_labels(spark.createDataFrame([(json.dumps(x, ensure_ascii=False), i) for i, x in enumerate(lines)], "value string, ordinal bigint"))
    got = {r.comment_id: r for r in merge_labels(records, labels).collect()}
    assert (got["c0"].stance, got["c1"].stance, got["c2"].stance, got["c3"].stance) == ("", "组", "二", "old")
    assert got["c2"].topic_tags == ["单"] and got["c2"].is_low_info_confirmed is True and got["c3"].topic_tags == ["旧"]


def test_aggregates(spark):
    rows = spark.createDataFrame([("u1", "a", ["t", "t"], 10, True), ("u1", "a", ["t", ""], 5, False), (None, "", [], 2, True)], "user_id string, stance string, topic_tags array<string>, like_count bigint, flag boolean")
    assert [tuple(r) for r in A.ordered(A.by_field(rows, "stance")).collect()] == [("a", 2, 1, 15)]
    assert [tuple(r) for r in A.ordered(A.by_items(rows, "topic_tags")).collect()] == [("t", 3, 1, 25), ("", 1, 1, 5)]
    assert [tuple(r) for r in A.by_field(rows, "flag").collect()] == [("True", 2, 2, 12)]


def test_labeller(spark):
    requests = spark.createDataFrame([(f"c{i}", "", "run", "b", f"r{i}") for i in range(9)], "comment_id string, template_group string, run_id string, batch_id string, request_id string")
    answer = lambda content: (200, json.dumps({"choices": [{"message": {"content": content}}]}, ensure_ascii=False))
    answers = {
        "c0": answer("{}"), "c1": (500, "x"), "c2": (0, "refused"), "c3": (200, "{}"), "c4": (200, '{"choices":[{"message":7}]}'), "c5": answer([{"type": "text", "text": " a"}, {"type": "image"}, {"type": "text", "text": "b "}]),
        "c6": answer([{"type": "text", "text": " "}]), "c7": answer(None), "c8": answer(""),
    }

    def chat(body):
        sent = json.loads(body)
        system, user = sent["messages"]
        assert (sent["model"], sent["temperature"], sent["response_format"], system["role"]) == ("m", 0.0, {"type": "json_object"}, "system")
        return answers[json.loads(user["content"].partition("评论：")[2])["comment_id"]]

    got = {r.comment_id: (r.ok, r.response_text, r.error, r.request_id) for r in labeller.label(requests, chat, "m", tasks=2).collect()}
    assert got == {
        "c0": (True, "{}", "", "r0"), "c1": (False, "", "HTTP 500: x", "r1"), "c2": (False, "", "Request failed: refused", "r2"), "c3": (False, "", labeller.NO_CHOICES, "r3"), "c4": (False, "", labeller.NO_MESSAGE, "r4"),
        "c5": (True, "ab", "", "r5"), "c6": (False, "", labeller.NO_TEXT, "r6"), "c7": (False, "", labeller.NO_TEXT, "r7"), "c8": (True, "", "", "r8"),
    }
    done = spark.createDataFrame([("r0",), ("r8",)], "request_id string")
    assert labeller.label(requests, chat, "m", done=done).count() == 7
    assert all(w in labeller.SYSTEM + labeller.USER for w in ("JSON", "公关质疑", "要求进一步处理", "父评论", "emotion_intensity", "冲就完了", "其他人是没手吗", "五字", "打call", "以“战”开头", "懦弱", *V.FIELDS))


def test_chat_and_batch_command(spark, tmp_path):
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from threading import Thread

    seen = []

    class Handler(BaseHTTPRequestHandler):
        protocol_version = "HTTP/1.1"

        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"])).decode()
            seen.append((self.path, self.headers["Authorization"]))
            fails = "坏" in body or "忙" in body and len(seen) < 4
            out = b"no" if fails else '{"choices":[{"message":{"content":"好"}}]}'.encode()
            self.send_response(400 if "坏" in body else 503 if fails else 200)
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            self.wfile.write(out)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    Thread(target=server.serve_forever, daemon=True).start()
    chat = labeller.Chat(f"http://127.0.0.1:{server.server_port}/v1/", "key", 5.0, attempts=3)
    assert chat("坏") == (400, "no") and chat("好")[0] == 200 and set(seen) == {("/v1/chat/completions", "Bearer key")}
    rows = [{"comment_id": f"c{i}", "comment_text_clean": t, "run_id": "run", "batch_id": "run-batch-0001", "request_id": f"r{i}", "template_group": ""} for i, t in enumerate(["忙", "坏", "好"])]
    (tmp_path / "run-batch-0001.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), "utf-8")
    count = lambda n, ok: {"batch_id": "run-batch-0001", "request_count": n, "success_count": ok, "failure_count": n - ok}
    assert run_batch(spark, str(tmp_path / "run-batch-0001.jsonl"), str(tmp_path / "raw"), chat, "m") == count(3, 2)
    assert run_batch(spark, str(tmp_path / "run-batch-0001.jsonl"), str(tmp_path / "again"), chat, "m", 2, str(tmp_path / "raw")) == count(0, 0)
    server.shutdown()
    server.server_close()
    assert labeller.Chat(f"http://127.0.0.1:{server.server_port}", "key", 5.0)("好")[0] == 0


def test_settings(monkeypatch, tmp_path):
    assert env_lines("# c\nA = 'b=c'\nno line\n") == {"A": "b=c"}
    (tmp_path / "env").write_text("OPENAI_BASE_URL=http://x\nOPENAI_API_KEY=k\nOPENAI_TIMEOUT_SECONDS=45\n")
    for name in ("OPENAI_BASE_URL", "OPENAI_API_KEY", "OPENAI_TIMEOUT_SECONDS", "OPENAI_MODEL"):
        monkeypatch.setenv(name, "gone")
        monkeypatch.delenv(name)
    monkeypatch.setenv("PARLANCE_ENV_FILE", str(tmp_path / "env"))
    s = get_settings(model="m")
    assert (s.base_url, s.timeout_seconds) == ("http://x", 45.0) and "k" not in repr(s).replace("model", "").split("base_url")[0]


def test_commands(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(RAW, "utf-8")
    label = json.dumps({"comment_id": "c1", "stance": "观望", "sentiment": "中性", "topic_tags": ["处理方案"]}, ensure_ascii=False)
    (tmp_path / "labels.jsonl").write_text(label + "\n", "utf-8")
    assert main(["run-pipeline", "--input", str(tmp_path / "raw.csv"), "--output-dir", str(tmp_path / "out"), "--labels", str(tmp_path / "labels.jsonl")], spark) == 0
    report = spark.read.option("header", True).csv(str(tmp_path / "out/reports/stance_summary.csv")).collect()
    assert [(r.value, r.comment_count) for r in report] == [("观望", "1")]
    t = lambda x: str(tmp_path / x)
    main(["normalize", "--input", t("raw.csv"), "--output", t("n")], spark)
    main(["prepare-model", "--input", t("n"), "--records-output", t("r"), "--jsonl-output", t("j")], spark)
    fused = spark.read.parquet(t("out/ruled"))
    staged = S.read_fact_csv(spark, t("r"))
    key = lambda df: sorted(map(str, df.select(*S.COLUMNS).collect()))
    assert key(fused) == key(staged)
    main(["profile", "--input", t("r"), "--output", t("p")], spark)
    lines = [r.value for r in spark.read.text(t("p")).collect()]
    assert lines[:2] == ["total: 2", "n_is_low_info: 1"] and "ratio: 2.0" in lines and "priority low: 1" in lines
    main(["normalize", "--input", t("raw.csv"), "--output", t("n2"), "--part-files"], spark)
    assert key(S.read_fact_csv(spark, t("n2"))) == key(S.read_fact_csv(spark, t("n")))
    many = fused.where("analysis_priority <> 'low'").count()
    main(["build-batches", "--input", t("j"), "--output-dir", t("b"), "--batch-size", "1", "--run-id", "run-1"], spark)
    assert {p.name for p in (tmp_path / "b").glob("*.jsonl")} == {f"run-1-batch-{i:04d}.jsonl" for i in range(1, many + 1)}
    assert {r.request_id for r in spark.read.json(t("b")).collect()} == {f"run-1-{i:06d}" for i in range(1, many + 1)}
    main(["build-batches", "--input", t("j"), "--output-dir", t("b2"), "--batch-size", "2", "--run-id", "run-1", "--part-files"], spark)
    assert {r.request_id for r in spark.read.json(t("b2")).collect()} == {f"run-1-{i:06d}" for i in range(1, many + 1)}
    assert main([], spark) == 0
