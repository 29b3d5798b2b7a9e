"""The pipeline on the smallest tables: columns, decisions and what stays."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from contrail.llm import decontaminate, simhash
from contrail.llm.common import table
from contrail.session import staged_paths, staging_path

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        if name == "mixing":
            assert after.columns[:len(columns)] == columns
            assert after.select("doc_id").distinct().count() == docs.count()
            break
        assert after.columns == columns
        assert 0 < after.count() <= docs.count()
        if name == "near-duplicates":
            groups = simhash.simhash_groups(docs).select("root").distinct().count()
            assert after.count() == groups
        if name == "decontamination":
            again = decontaminate.contamination(after, table(spark, SF, "benchmark"))
            assert again.filter("n_hit > 0").count() == 0
        docs = after


def test_run(spark):
    with staged_paths() as paths:
        out = corpus_pipeline.run(spark, SF)
    fs = lambda p: os.path.exists(p.removeprefix("file:"))
    stages = [p for p in paths if "contrail-stage" in p]
    assert [fs(p) for p in stages] == [False, False, False, True]
    assert not any(fs(p) for p in paths if "contrail-postings" in p)
    assert out.columns[-3:] == ["mix_epoch", "mix_block", "mix_order"] and out.count() > 0


EDGES = ("doc_id bigint, text string, lang string, source string, n_chars bigint, root string, "
         "score double, row int, mix_block string, lines int")


def edge_rows():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    texts = [None, "", "one", words, words, words + " pi", "x " * 30_000, "\n\n", "né\nné"]
    rows = [(i, t, "en", ["a", None][i % 2], None if t is None else len(t), "r", 0.5, i, "b", 1)
            for i, t in enumerate(texts)]
    rows += [(None, "a null id here", "en", None, 14, "r", 0.5, 90, "b", 1),
             (None, None, None, None, None, None, None, None, None, None)]
    rows += rows[:4] + [(3, words, "de", "other", 1, "q", 0.1, 77, "c", 2)]  # repeats, and one unlike
    return rows


@pytest.fixture(scope="module")
def edge_dir(spark):
    path = staging_path(spark, "edges")
    spark.createDataFrame(edge_rows(), EDGES).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, None, int(i == 8) if i else None) for i in range(9)],
                          "doc_id bigint, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame([("b1", None), (None, "zeta eta theta"), ("b2", ""), ("b3", "one")],
                          "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_edge_rows_in_every_stage(spark, edge_dir):
    docs = spark.createDataFrame(edge_rows(), EDGES)
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, edge_dir)
        assert after.columns == names, name
        rows, before = after.collect(), docs.collect()
        if name == "near-duplicates":
            keys = [(r["doc_id"], r["text"]) for r in rows]
            assert len(keys) == len(set(keys)) and len(rows) < len(before)
            assert sum(r["text"] is None or not r["text"].split() for r in rows) == 1
            ids = {r["doc_id"] for r in rows}
            assert 3 in ids and 4 not in ids
            assert [r["row"] for r in rows if r["doc_id"] == 3] in ([3], [77])
        elif name == "line dedup":
            assert len(rows) == len(before)
            assert sum(r["text"] is None for r in rows) == sum(r["text"] is None for r in before)
        elif name == "decontamination":
            assert {r["text"] for r in before} - {r["text"] for r in rows} == {
                r["text"] for r in before if r["text"] == "one" or (
                    r["text"] or "").startswith("alpha")}
        assert set(map(str, rows)) <= set(map(str, before)) or name == "line dedup"
        docs = stage(spark, docs, edge_dir) if name in ("line dedup",) else docs
    out = corpus_pipeline.run(spark, edge_dir)
    assert out.columns[:len(names) - 1] == [c for c in names if c != "mix_block"]
    assert out.count() > 0


def test_empty_tables(spark, edge_dir):
    path = staging_path(spark, "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{edge_dir}/{name}.parquet").limit(0).write.parquet(
            f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_no_text_is_shuffled_to_drop_copies(spark):
    docs = table(spark, SF, "documents")
    plan = simhash.keep_one_of_each(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
