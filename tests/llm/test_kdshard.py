"""K-d sharding against a recursion over sorted lists."""

from __future__ import annotations

import random
import zlib

import pytest

from contrail.llm import kdshard
from contrail.llm.common import table
from tests.conftest import SF_SMALL

DOC = ("doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, "
       "size double")


def corpus(seed, n=700):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = rnd.choice(["", None, "é" * rnd.randint(1, 80), "same text", "w " * rnd.randint(1, 99)])
        source = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", None])
        rows.append((rnd.choice([i, i, None, 5]), text, rnd.choice(["en", "de"]), source,
                     None if text is None else len(text), "clash", 0.5))
    return rows + rows[:50] + [rows[3]] * 200


def cut(rows, leaves, first, out):
    """rows: (places, tie, uid, size); fills out[uid] = shard."""
    if leaves == 1 or not rows:
        out.update({r[2]: first for r in rows})
        return
    spans = [max(r[0][d] for r in rows) - min(r[0][d] for r in rows) for d in range(len(rows[0][0]))]
    dim = spans.index(max(spans))
    rows = sorted(rows, key=lambda r: (r[0][dim], r[1], r[2]))
    left = leaves // 2
    goal, upto = sum(r[3] for r in rows) * left / leaves, 0
    for k, r in enumerate(rows):
        upto += r[3]
        if upto >= goal:
            at = k + 1 if upto - goal <= goal - upto + r[3] else k
            break
    cut(rows[:at], left, first, out)
    cut(rows[at:], leaves - left, first + left, out)


@pytest.mark.parametrize("shards,last", [(8, 10_000), (8, 20), (5, 3), (1, 10_000)])
def test_equals_the_recursion(spark, monkeypatch, shards, last):
    monkeypatch.setattr(kdshard, "LAST_ROWS", last)
    monkeypatch.setattr(kdshard, "LEVELS_A_COPY", 2)
    seen = []
    real = kdshard.metadata
    monkeypatch.setattr(kdshard, "metadata", lambda *a: seen.append(real(*a)) or seen[-1])
    docs = spark.createDataFrame(corpus(2), DOC)
    placed = kdshard.kd_shards(docs, shards, keep=["doc_id", "text"]).collect()
    meta = [(tuple(r["places"]), r["tie"], r["uid"], r["size"]) for r in seen[0].collect()]
    want = {}
    cut(meta, shards, 0, want)
    sums = [(sum(m[3] for m in meta if want[m[2]] == s), sum(want[m[2]] == s for m in meta))
            for s in range(shards)]
    assert [(sum(r["size"] for r in placed if r["shard"] == s),
             sum(r["shard"] == s for r in placed)) for s in range(shards)] == sums
    sizes = [s for s, _ in sums]
    assert max(sizes) - min(sizes) <= 3 * max(m[3] for m in meta)
    for s in range(shards):
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(sums[s][1]))
    for r in placed:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_every_row_of_a_table(spark):
    got = kdshard.shard_report(table(spark, SF_SMALL, "documents")).collect()
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in table(
        spark, SF_SMALL, "documents").select("doc_id", "text").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    assert all((r["size"], r["text_crc32"]) == (len(docs[r["doc_id"]]) + 1, zlib.crc32(
        docs[r["doc_id"]])) for r in got)
    sizes = [sum(r["size"] for r in got if r["shard"] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 3 * max(r["size"] for r in got)


def test_target_bytes_small_and_empty_tables(spark):
    docs = spark.createDataFrame(corpus(3), DOC)
    placed = kdshard.kd_shards(docs, target_bytes=4_000).collect()
    total = sum(r["size"] for r in placed)
    assert {r["shard"] for r in placed} == set(range(-(-total // 4_000)))
    few = kdshard.kd_shards(docs.limit(3), 8).collect()
    assert len(few) == 3
    assert kdshard.shard_report(docs.limit(0)).count() == 0
    bare = kdshard.kd_shards(docs, 4, dimensions=["absent"]).collect()
    assert len({r["shard"] for r in bare}) == 4
    with pytest.raises(ValueError):
        kdshard.kd_shards(docs)
