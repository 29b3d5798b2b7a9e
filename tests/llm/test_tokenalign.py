"""Tokenizer alignment against decoded bytes alone, and pieces against whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from contrail.llm import tokenalign as ta

CHARS = list("abz é日😀龘 \n\t  ▁\x00\x1c\x85​<s>|'s!.9ﬁ̀᠎ѣЖ,.  \n")
DOC = "doc_id bigint, text string, n_a string, pairs int"


@pytest.fixture(scope="module")
def aligner():
    return ta.Aligner(ta.A_PATH, ta.B_PATH)


def by_bytes(aligner, text):
    """(ids of A, ids of B, links, groups) from decoded lengths, None without tokens."""
    if not text:
        return None
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    whole = (" " + text).encode()
    if b"".join(aligner.a_bytes[i] for i in a) != whole or b"".join(
            aligner.b_bytes[i] for i in b) != whole:
        return None

    def spans(ids, table):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(table[i]), i))
            at = out[-1][1]
        return out

    left, right = spans(a, aligner.a_bytes), spans(b, aligner.b_bytes)
    links = [(i, j) for s, e, i in left for s2, e2, j in right if s < e2 and s2 < e]
    groups, low = [], 0
    for end in sorted({x[1] for x in left} & {x[1] for x in right}):
        groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= end)
                               for side in (left, right)))
        low = end
    return a, b, links, ";".join(groups)


def texts(seed, n=150):
    rnd = random.Random(seed)
    out = ["".join(rnd.choice(CHARS) for _ in range(rnd.randint(1, 40))) for _ in range(n)]
    return [*out, "it's  3.5 km, isn't it?\n\nYes <|endoftext|> </s>", "", None, "word", "word", " "]


def test_pieces_equal_whole_texts(aligner):
    assert aligner.cutter.cuts
    for text in texts(1, 3000):
        want = by_bytes(aligner, text)
        found = aligner.pieces(text)
        if want is None:
            assert found == []
            continue
        assert ";".join(p[1] for p in found) == want[3], text


def test_spans_equal_decoded_bytes(aligner):
    for text in texts(2, 1000):
        if by_bytes(aligner, text) is None:
            continue
        for ends, table in ((aligner.a_ends, aligner.a_bytes), (aligner.b_ends, aligner.b_bytes)):
            at = 0
            for i, end in zip(*ends(" " + text), strict=True):
                at += len(table[i])
                assert end == at


def test_forgetting_changes_nothing(aligner, monkeypatch):
    monkeypatch.setattr(ta, "REMEMBERED", 5)
    monkeypatch.setattr(ta, "LEARNED", 3)
    small = ta.Aligner(ta.A_PATH, ta.B_PATH)
    for text in texts(3, 300):
        assert small.pieces(text) == aligner.pieces(text)


@pytest.mark.parametrize("bound", [ta.BROADCAST_PAIRS, 0])
def test_counts_over_all_rows(spark, aligner, bound):
    rows = [(None if i == 4 else i, t, "clash", 1) for i, t in enumerate(texts(4))]
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    want = [by_bytes(aligner, t) for _, t, *_ in rows]
    total = Counter(x for w in want if w for x in w[2])
    most = {}
    for (_, b), n in total.items():
        most[b] = max(most.get(b, 0), n)
    found = ta.alignment_report(docs, broadcast_pairs=bound)
    groups = {w[3] for w in want if w} | {""}
    aligned = ta.align(docs, broadcast_pairs=bound)
    assert aligned.columns == ["doc_id", "text", *ta.MADE]
    assert {r["groups"] for r in aligned.collect()} == groups
    got = Counter(tuple(r) for r in found.collect())
    assert got == Counter(
        (r[0], 0, 0, 0, 0, 0, 0, "") if w is None else
        (r[0], len(w[0]), len(w[1]), w[3].count(";") + 1, len(w[2]),
         sum(total[x] == most[x[1]] for x in w[2]), sum(total[x] for x in w[2]),
         hashlib.sha256(w[3].encode()).hexdigest()) for r, w in zip(rows, want, strict=True))


def test_empty_and_long(spark, aligner):
    docs = spark.createDataFrame([], DOC)
    assert ta.align(docs).count() == 0
    long = "lorem " * 100_000 + "x" * 100_000
    got = ta.align(spark.createDataFrame([(1, long, "", 0)], DOC)).first()
    want = aligner.align([" " + long])[0]
    assert (got["n_a"], got["groups"]) == (want[0] & ta.B_MASK, want[1])
