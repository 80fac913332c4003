"""The corpus pipeline: each stage's decisions, odd rows and the whole run."""

import re

import pytest

import corpus_pipeline as pipeline
from quaystat.llm import common

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return common.table(spark, SF, "documents").cache()


def test_stages_and_columns(spark, docs):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "passages", "benchmark", "packing"]
    now, counts = docs, []
    for name, stage in pipeline.STAGES[:-1]:
        now = common.cut(stage(spark, now, SF), name)
        assert now.columns == docs.columns
        counts.append(now.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * docs.count()
    # Nothing repeated over 200 bytes, and no benchmark window, is left.
    texts = [r["text"].encode() for r in now.collect()]
    seen = set()
    for t in texts:
        own = {t[a : a + 200] for a in range(len(t) - 199)}
        assert not own & seen
        seen |= own
    packed = pipeline.pack(spark, now, SF)
    assert packed.select("doc_id").distinct().count() == now.count()


def test_near_duplicates_keep_one(spark):
    text = "some words that make a text with enough shingles to matter here"
    rows = [(5, text, "a"), (3, text, "b"), (3, text, "b"), (None, text, "c"), (None, None, "d"), (None, None, "d"), (9, "", "e"), (8, "quite another thing altogether said in other words", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    kept = sorted((r["doc_id"] or 0, r["component"]) for r in pipeline.drop_near_duplicates(spark, docs, SF).collect())
    assert kept == [(3, "b"), (8, "f"), (9, "e")]


def test_benchmark_words_go(spark, tmp_path):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"Before, {item.title()}! after", 3), (2, item, 3), (3, "clean alpha beta", 3), (4, None, 3), (4, f"é {item} ü", 3), (4, f"é {item} ü", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = sorted((r["doc_id"], r["text"] or "", r["n_chars"]) for r in pipeline.drop_benchmark(spark, docs, str(tmp_path)).collect())
    assert got == [(1, "Before, ! after", 15), (3, "clean alpha beta", 3), (4, "", 3), (4, "é  ü", 4), (4, "é  ü", 4)]


def test_passages_are_cut_at_whole_characters(spark):
    shared = "é" * 130
    docs = spark.createDataFrame([(1, "a" + shared + " tail one"), (2, "bb" + shared + " other tail"), (3, None), (4, "short")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pipeline.cut_passages(spark, docs, SF).collect()}
    assert got[3] is None and got[4] == "short" and got[1].startswith("a") and "é" not in got[1] and got[2].endswith("other tail")


def test_copies_of_a_passage_go(spark):
    same, shared = "".join(f"w{k} " for k in range(130)), "".join(f"s{k} " for k in range(80))
    rows = [(1, same + shared), (2, same + shared), (3, "own words " + shared), (4, "x"), (4, "x")]
    got = [(r["doc_id"], r["text"]) for r in pipeline.cut_passages(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()]
    assert sorted(got) == [(3, "own words"), (4, "x"), (4, "x")]  # the blank before the passage is alike as well


def test_names_the_stages_use_come_back_as_they_were(spark, tmp_path):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["__key", "__Kept", "__id", "__hash", "__hash_of", "__copy", "__quality", "__digest", "__left", "starts", "kept", "key"]
    text = "some words that make a text with enough shingles to matter here "
    rows = [(k, t, *[f"{n}{k}" for n in names]) for k, t in ((3, text), (1, text), (5, f"other {item} words"), (7, "y" * 250), (8, "z" + "y" * 250))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for stage in (pipeline.drop_near_duplicates, pipeline.cut_passages, pipeline.drop_benchmark):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count()
        assert all(r[n] == f"{n}{r['doc_id']}" for r in out.collect() for n in names)


def test_repeated_rows_keep_the_same_one(spark):
    rows = [(1, "a text of words", f"n{k}") for k in range(20)]
    kept = {pipeline.drop_near_duplicates(spark, spark.createDataFrame(part, "doc_id long, text string, note string").repartition(3), SF).first()["note"] for part in (rows, rows[::-1])}
    assert len(kept) == 1


def test_empty_documents(spark, docs):
    now = docs.limit(0)
    for name, stage in pipeline.STAGES:
        now = common.cut(stage(spark, now, SF), name)
        assert now.count() == 0


def test_registered(spark):
    import __spark_entry__ as entry

    numbers = [int(m[1]) for n in entry.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
