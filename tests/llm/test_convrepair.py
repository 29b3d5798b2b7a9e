"""Conversation repair against an exhaustive search, an automaton and its own long path."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from contrail.llm import convrepair as cr

ROWS = "conv_id bigint, turn bigint, role string, text string, spans string"


def searched(initials, faults):
    """(cost, audit): Dijkstra over (turns read, state) with the least audit, no matrices."""
    best = {(0, "S"): (0, "")}
    for i in range(len(initials) + 1):
        layer = sorted((v, k[1]) for k, v in best.items() if k[0] == i)
        while layer:  # inserts stay on the layer
            (cost, audit), state = layer.pop(0)
            if best[i, state] != (cost, audit):
                continue
            wanted = "a" if state == "A" else "u"
            after = "U" if wanted == "a" else "A"
            moves = [(i, after, 2, "I")]
            if i < len(initials):
                moves.append((i + 1, state, 3, "D"))
                if faults[i] in (0, 3):
                    late = int(faults[i] == 3)
                    if initials[i] == wanted:
                        moves.append((i + 1, after, late, "K"))
                    else:
                        moves.append((i + 1, after, 2 + late, "R"))
                    if state == "S" and initials[i] == "s":
                        moves.append((i + 1, "T", late, "K"))
            for j, to, c, edit in moves:
                new = cost + c, audit + edit
                if new < best.get((j, to), (1 << 30, "")) and len(audit) < 60:
                    best[j, to] = new
                    if j == i:
                        layer = sorted([*layer, (new, to)])
    n = len(initials)
    return min(best[n, q] for q in "SU" if (n, q) in best)


def exhaustive(initials, faults):
    """Every edit sequence with at most three inserts."""
    out = []

    def go(i, audit, cost, shape, inserts):
        if i == len(initials) and re.fullmatch("(s?(ua)+)?", shape):
            out.append((cost, audit))
        if inserts < 3:
            for c in "ua":
                go(i, audit + "I", cost + 2, shape + c, inserts + 1)
        if i < len(initials):
            go(i + 1, audit + "D", cost + 3, shape, inserts)
            if faults[i] in (0, 3):
                late = int(faults[i] == 3)
                go(i + 1, audit + "K", cost + late, shape + (initials[i] or "?"), inserts)
                for c in "ua":
                    go(i + 1, audit + "R", cost + 2 + late, shape + c, inserts)

    go(0, "", 0, "", 0)
    return min(out)


def test_small_runs_are_the_cheapest_and_least():
    rnd = random.Random(3)
    for _ in range(150):
        n = rnd.randint(0, 4)
        initials = [rnd.choice("suaux"[:5]) if rnd.random() < 0.95 else "" for _ in range(n)]
        faults = [rnd.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)]
        assert cr.best_repair(initials, faults) == exhaustive(initials, faults), (initials, faults)


def test_longer_runs_agree_with_the_automaton():
    rnd = random.Random(4)
    for _ in range(400):
        n = rnd.randint(0, 14)
        initials = [rnd.choice("ssuuaat") for _ in range(n)]
        faults = [rnd.choice((0, 0, 0, 0, 1, 2, 3)) for _ in range(n)]
        assert cr.best_repair(initials, faults) == searched(initials, faults), (initials, faults)


def test_blocks_compose_to_the_whole():
    rnd = random.Random(5)
    for _ in range(60):
        n = rnd.randint(2, 16)
        initials = [rnd.choice("ssuuaat") for _ in range(n)]
        faults = [rnd.choice((0, 0, 0, 0, 1, 2, 3)) for _ in range(n)]
        at, paths = 0, {"S": (0, "")}
        while at < n:
            size = rnd.randint(1, 4)
            found = cr.block_repairs(initials[at:at + size], faults[at:at + size], "STUA")
            new = {}
            for (p, q), (cost, audit) in found.items():
                if p in paths:
                    way = paths[p][0] + cost, paths[p][1] + audit
                    new[q] = min(new.get(q, way), way)
            paths, at = new, at + size
        whole = min((c + cr.TAIL[q][0], a + cr.TAIL[q][1]) for q, (c, a) in paths.items())
        assert whole == cr.best_repair(initials, faults)


def expected(rows):
    """The report of one conversation's rows after damage, from its definition."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = re.sub("[ \t-\r]+$", "", text)
        fault = (1 if not bare else 2 if (role, text) in seen
                 else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
        faults.append(fault)
    initials = [r[1][:1] for r in rows]
    cost, audit = searched(initials, faults)
    turns = [r[0] for r in rows if r[0] is not None]
    out, at, state = [], 0, "S"
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = ("user" if state in "STU" else "assistant"), ""
        if edit != "I":
            text = rows[at][2]
            role = rows[at][1] if edit == "K" else role
            at += 1
        out.append(f"{role}:{text}")
        state = "T" if state == "S" and role[:1] == "s" else "A" if role[:1] == "u" else "U"
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in (1, 2, 3)),
            sum(a + b not in ("su", "ua", "au")
                for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def damaged(rows):
    """conv_id -> rows after damage."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        here = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(turn, "user" if kind == 4 else role, text)] * (
            0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def sample(seed, conversations=60):
    rnd, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "and then", "", " \t", "a\nb?", None, "Ünï.", "x" * 50_000 + "."]
    for conv in [None, *range(conversations)]:
        for turn in range(rnd.randint(1, 9)):
            rows.append((conv, rnd.choice([turn, turn, turn, None, turn - 1]),
                         rnd.choice(["user", "assistant", "system", "tool", "", None]),
                         rnd.choice(texts), "clash"))
    return rows


def got(df):
    return {r["conv_id"]: tuple(r[c] for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")) for r in df.collect()}


@pytest.mark.parametrize("settings", [{}, {"long_rows": 0}, {"long_rows": 4}])
def test_report_with_edge_cases(spark, settings):
    rows = sample(1)
    rows += rows[:7]  # repeated rows
    df = spark.createDataFrame(rows, ROWS)
    report = got(cr.repair_report(cr.damage(df), **settings))
    assert report == {c: expected(r) for c, r in damaged(rows).items()}


def test_one_long_conversation(spark):
    rnd = random.Random(8)
    rows = [(7, t, ["user", "assistant"][t % 2] if rnd.random() < 0.9 else "system",
             f"turn {t if rnd.random() < 0.7 else 0}.", "x") for t in range(1500)]
    df = spark.createDataFrame(rows, ROWS)
    report = got(cr.repair_report(cr.damage(df), long_rows=100))
    whole = got(cr.repair_report(cr.damage(df)))
    assert report == whole
    gaps, blank, *_ = expected_counts = report[7]
    assert blank > 20 and gaps > 20 and expected_counts[5] > 200


def test_empty_table(spark):
    empty = spark.createDataFrame([], ROWS)
    assert cr.repair_report(cr.damage(empty)).count() == 0
    kept = spark.createDataFrame([(1, 0, "user", "a.", 0)], ROWS.replace("spans string",
                                                                          "times bigint"))
    short, _, _ = cr.repair(kept)
    assert [(r["conv_id"], r["audit"], r["turns"]) for r in short.collect()] == [(1, "", [])]


def test_damage_keeps_the_kinds(spark):
    rows = [(c, t, "assistant", "Well! Yes.", "") for c in range(10) for t in range(10)]
    for r in cr.damage(spark.createDataFrame(rows, ROWS)).select(
            "*", (F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"),
                                      F.col("turn").cast("string"))) % 20).alias("k")).collect():
        want = {0: ("assistant", "Well! Yes.", 0), 1: ("assistant", "", 1),
                2: ("assistant", "Well Yes", 1), 3: ("assistant", "Well! Yes.", 2),
                4: ("user", "Well! Yes.", 1)}.get(r["k"], ("assistant", "Well! Yes.", 1))
        assert (r["role"], r["text"], r["times"]) == want
