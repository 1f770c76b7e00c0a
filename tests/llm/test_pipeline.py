"""The pipeline's stages on a small table with planted cases, each against what plain Python expects of its own input."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import shingle_set, words


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng, root = random.Random(7), tmp_path_factory.mktemp("sf")
    items = [(i, words(rng, 40)) for i in range(5)]
    rows = [(i, words(rng, 60) + (" idiot " if i % 5 == 0 else " ") + words(rng, 20), "en") for i in range(200)]
    rows += [(300 + i, rows[i][1], "en") for i in range(10)] + [(400 + i, f"{words(rng, 30)} {items[i % 5][1]}", "de") for i in range(10)] + [(500, None, "en"), (501, "", "en")]
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(root / "benchmark.parquet"))
    spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(200)], "doc_id bigint, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    return str(root)


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        path = corpus_pipeline.new_path(spark, "test-stage")
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name != "token ids":
            assert out.columns == docs.columns
        seen[name] = (docs, out)
        docs = out
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    assert all((" idiot " in (t or "")) == (i not in texts(seen["toxicity"][1])) for i, t in texts(seen["toxicity"][0]).items())
    before, after = map(texts, seen["near duplicates"])
    first = {}
    for i in sorted(before):
        first.setdefault(shingle_set(before[i], 5) or i, i)
    assert set(after) == set(first.values())
    before, after = map(texts, seen["decontamination"])
    assert set(after) == {i for i, t in before.items() if not any(x in (t or "") for x in items)}
    assert seen["token ids"][1].count() == seen["mixing"][1].count()
    assert corpus_pipeline.run(spark, sf).agg(F.sum("n_tokens")).first()[0] == seen["token ids"][1].agg(F.sum("n_tokens")).first()[0]


CLASHING = ("gone", "row", "row_key", "score", "k", "n", "rate", "component_id", "text_hash", "start")


def stage_input(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return df.withColumns({c: F.lit(f"kept {c}") for c in CLASHING})


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages_with_nulls_repeats_empties_and_clashing_columns(spark, sf):
    """Each stage on rows whose doc_ids are null or repeat, with further columns of the names that operators use."""
    rng = random.Random(8)
    stages = dict(corpus_pipeline.STAGES)
    a, b, c = (words(rng, 50) for _ in range(3))
    near = a.split()
    near[10] = "changed"
    rows = [(1, a), (1, b), (2, " ".join(near)), (None, a), (None, a), (None, c), (5, ""), (5, None), (None, None), (9, b), (9, b)]
    out = stages["near duplicates"](spark, stage_input(spark, rows), sf)
    assert kept(out) == sorted([(1, a), (1, b), (None, c), (5, ""), (5, None), (None, None)], key=repr)
    assert out.columns == stage_input(spark, []).columns and {r[x] for r in out.collect() for x in CLASHING} == {f"kept {x}" for x in CLASHING}

    item = spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    rows = [(1, f"{a} {item}"), (1, b), (None, item), (None, c), (2, item), (2, item), (3, None), (4, "")]
    out = stages["decontamination"](spark, stage_input(spark, rows), sf)
    assert kept(out) == sorted([(1, b), (None, c), (3, None), (4, "")], key=repr) and out.columns == stage_input(spark, []).columns

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = stage_input(spark, [(None, f"{a} idiot"), (1007, f"{b} 1d10t"), (1007, c), (1008, c), (1008, c), (None, None), (10_000, " ".join([c] * 400))])
    both = more.unionByName(docs.withColumns({x: F.lit(f"kept {x}") for x in CLASHING}))
    out = stages["toxicity"](spark, both, sf)
    assert out.columns == both.columns
    ids = [(r.doc_id, r.text) for r in out.collect()]
    assert [t for _, t in ids if t and (" idiot" in t or "1d10t" in t)] == [] and ids.count((1008, c)) == 2 and (1007, c) in ids and (None, None) in ids and any(i == 10_000 for i, _ in ids)

    out = stages["mixing"](spark, both, sf)
    assert out.columns == both.columns and set(map(tuple, out.select("doc_id", "text").collect())) <= set(map(tuple, both.select("doc_id", "text").collect()))
    assert stages["token ids"](spark, both, sf).count() == both.count()


def test_stages_of_an_empty_table(spark, sf):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, stage_input(spark, []), sf)
        assert out.count() == 0, name
        assert name == "token ids" or out.columns == stage_input(spark, []).columns
