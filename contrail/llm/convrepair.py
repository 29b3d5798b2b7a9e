"""Conversation structure repair by aligning turns to the alternating grammar.

A repaired conversation has the role initials ``(s?(ua)+)?``. Its turns are aligned
by Wagner and Fischer's edit distance to the grammar's string of every feasible
length: Keep costs 0, Rerole to user or assistant 2, Delete 3 (the only edit of blank
and duplicate turns), Insert an empty user or assistant turn 2, and truncated turns
that stay add 1. All strings of one last letter are suffixes of one another, so one
matrix over (turn, letters left) holds all lengths; it is kept within Ukkonen's band:
no alignment as cheap as the incumbent, a greedy repair, inserts more than half its
cost or deletes more than a third. Every length on the least cost is traced back, and
the audits (the edits' initials in order) are compared: the ASCII-least wins.

Conversations of up to ``long_rows`` rows and ``long_bytes`` bytes are sorted and
aligned within one task each. Longer ones, which may hold any share of the table, are
ordered by ranges of the whole key and cut into blocks: each block is aligned from
every state of the grammar to every state it can end in (inserts stand before
a turn, so two audits of a block never begin one another), the blocks' costs are
composed along the conversation, and only the chosen audits are applied. Equal rows are
counted before they are dealt, and first occurrences come from partial minima, so
neither copies nor one busy conversation meet in one task. What one task still sees of a
conversation is a short row a block, and the blocks passing by, in order, when the
audit and the hash of the result, both sequential by nature, are written.

Defined results: turns are ordered by turn (NULLs first), then role, then text; NULL
role or text is one space; a role's initial is its first character, and an empty role
has none, fits no letter and is rerolled or deleted; NULL conversations are one
conversation; a conversation of which ``times`` 0 leaves no row has zeros and an
empty audit; gaps ignore NULL turns; empty tables give empty results; other columns are
not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import by_value, salted_join
from contrail.session import materialize

LONG_ROWS, LONG_BYTES = 1_000, 32 << 20
BLOCK_ROWS, BLOCK_BYTES = 256, 8 << 20
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
FAR = 1 << 29
#: What the grammar still needs at the end, by the state there: nothing written (S), after the
#: system turn (T), after an assistant's (U) or a user's (A).
TAIL = {"S": (0, ""), "T": (4, "II"), "U": (0, ""), "A": (2, "I")}
SPACES = " \t\n\x0b\x0c\r"
COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
TURNS = "turns array<struct<role: string, text: string>>"
RESULT = f"conv_id {{id}}, {COUNTS}, cost bigint, audit string, {TURNS}"


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` with its test damage by crc32 of conv_id:turn (NULLs: a space), modulo
    20. ``times`` is how often the row stands there (0: it was dropped)."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(
            text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("times"))


# --- alignment of a run of turns -----------------------------------------------------------


def faults_of(texts: list[str]) -> list[int]:
    """0: none, 1: blank, 3: truncated."""
    out = []
    for text in texts:
        last = text.rstrip(SPACES)[-1:]
        out.append(1 if not last else 0 if last in ".!?" else 3)
    return out


def greedy_cost(initials: list[str], faults: list[int]) -> int:
    """The cost of keeping or reroling every turn that need not go: an alignment that there is."""
    cost, state = 0, "S"
    for c, fault in zip(initials, faults, strict=True):
        if fault in (1, 2):
            cost += DELETE
            continue
        cost += TRUNCATED * (fault == 3)
        if state == "S" and c == "s":
            state = "T"
            continue
        wanted = "a" if state == "A" else "u"
        cost += REROLE * (c != wanted)
        state = "U" if wanted == "a" else "A"
    return cost + TAIL[state][0]


class Band:
    """The matrices of a run of turns: ``end[e][i]`` is the least cost of aligning the turns from
    i on to each number of letters left that alternate and end in e; ``lead[e]`` the same
    with the system turn before them. Columns stand for letters left minus turns left."""

    def __init__(self, initials: list[str], faults: list[int], most: int):
        import numpy as np

        self.n, self.initials, self.faults = len(initials), initials, faults
        # One more below: the system turn is no letter of the columns.
        n, self.down, up = self.n, most // DELETE + 1, most // INSERT
        width = self.down + up + 1
        gone = [f in (1, 2) for f in faults]
        late = [TRUNCATED * (f == 3) for f in faults]
        self.cost = {c: [FAR if g else x + (0 if i == c else FAR if c == "s" else REROLE)
                         for i, g, x in zip(initials, gone, late, strict=True)] for c in "sua"}
        column, slope = np.arange(width), INSERT * np.arange(width)
        self.end, self.lead = {}, {}
        for e, other in (("a", "u"), ("u", "a")):
            grid = np.full((n + 1, width + 1), FAR, np.int32)  # the last column stays far
            lead = np.full((n + 1, width + 1), FAR, np.int32)
            grid[n, self.down] = 0
            for i in range(n - 1, -1, -1):
                left = column + (n - i - self.down)
                match = np.where(left % 2 == 1, self.cost[e][i], self.cost[other][i])
                match[left < 1] = FAR
                row = np.minimum(grid[i + 1, 1:] + DELETE, grid[i + 1, :-1] + match)
                row[left < 0] = FAR
                row = np.minimum.accumulate(row - slope) + slope
                grid[i, :-1] = np.minimum(row, FAR)
                lead[i, :-1] = np.minimum(FAR, np.minimum(
                    lead[i + 1, 1:] + DELETE, grid[i + 1, 1:] + self.cost["s"][i]))
            self.end[e], self.lead[e] = grid, lead

    def costs(self, entry: str) -> dict[str, tuple[int, list]]:
        """For each state at the end the least cost, and the strings on it: (e, letters, led)."""
        out: dict[str, tuple[int, list]] = {}
        for e in "au":
            exit_ = "U" if e == "a" else "A"
            first = 1 if entry == "A" else 0
            odd = (e == "u") != (first == 1)
            for led, grid in ((False, self.end[e]), (True, self.lead[e])):
                if led and entry != "S":
                    continue
                for c in range(grid.shape[1] - 1):
                    left, cost = c + self.n - self.down, int(grid[0, c])
                    if cost >= FAR or left < 0 or left % 2 != odd:
                        continue
                    state = exit_ if left else "T" if led else entry
                    best = out.get(state, (FAR, []))
                    if cost < best[0]:
                        out[state] = cost, [(e, left, led)]
                    elif cost == best[0]:
                        best[1].append((e, left, led))
        return out

    def audit(self, e: str, left: int, led: bool) -> str:
        """The ASCII-least of the cheapest edits to that string."""
        grid, lead, n, down = self.end[e], self.lead[e], self.n, self.down
        other, i, out = {"a": "u", "u": "a"}[e], 0, []
        while i < n:
            c = left - (n - i) + down
            if led:
                if int(lead[i, c]) == int(lead[i + 1, c + 1]) + DELETE:
                    out.append("D")
                else:
                    out.append("K")
                    led = False
                i += 1
                continue
            value, letter = int(grid[i, c]), e if left % 2 else other
            if value == int(grid[i + 1, c + 1]) + DELETE:
                out.append("D")
                i += 1
            elif c and left and value == int(grid[i, c - 1]) + INSERT:
                out.append("I")
                left -= 1
            else:
                out.append("K" if self.initials[i] == letter else "R")
                i, left = i + 1, left - 1
        return "".join(out)


def best_repair(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    if not initials:
        return 0, ""
    band = Band(initials, faults, greedy_cost(initials, faults))
    found = band.costs("S")
    cost = min(cost + TAIL[q][0] for q, (cost, _) in found.items())
    return cost, min(band.audit(*string) + TAIL[q][1] for q, (c, strings) in found.items()
                     if c + TAIL[q][0] == cost for string in strings)


def block_repairs(initials: list[str], faults: list[int], entries: str) -> dict:
    """(entry, exit) -> (cost, audit) for each state that a block can begin and end in."""
    most = greedy_cost(initials, faults) + 8
    while True:
        band = Band(initials, faults, most)
        found = {p: band.costs(p) for p in entries}
        highest = 0
        for p, ends in found.items():
            keeps = p == "S" and any(i == "s" and f not in (1, 2)
                                     for i, f in zip(initials, faults, strict=True))
            reach = {p, "U", "A", *("T" if keeps else "")}
            highest = max(highest, *(ends.get(q, (FAR, []))[0] for q in reach))
        if highest <= most:
            return {(p, q): (cost, min(band.audit(*s) for s in strings))
                    for p, ends in found.items() for q, (cost, strings) in ends.items()}
        most = min(2 * most, max(DELETE * len(initials) + 2 * INSERT, most + 1))


def apply_audit(audit: str, roles: list[str], texts: list[str], entry: str = "S") -> list[dict]:
    """The repaired turns; ``audit`` may end in the inserts of the tail."""
    out, at, state = [], 0, entry
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        wanted = "assistant" if state == "A" else "user"
        if edit == "I":
            out.append({"role": wanted, "text": ""})
        else:
            out.append({"role": roles[at] if edit == "K" else wanted, "text": texts[at]})
            at += 1
        if state == "S" and edit == "K" and out[-1]["role"][:1] == "s":
            state = "T"
        else:
            state = "U" if wanted == "assistant" else "A"
    return out


def _summary(turns: list, roles: list[str], faults: list[int]) -> dict:
    """Counts of a run of turns, with what its neighbours need."""
    known = [t for t in turns if t is not None]
    initials = [r[:1] for r in roles]
    return {"blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3),
            "illegal": sum(a + b not in ("su", "ua", "au")
                           for a, b in zip(initials, initials[1:], strict=False)),
            "distinct": len(set(known)), "low": min(known, default=None),
            "high": max(known, default=None), "first": initials[0] if roles else None,
            "last": initials[-1] if roles else None}


# --- conversations within a task -------------------------------------------------------------


def _rows_of(batches):
    """The columns' values, row by row, a bounded number at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            yield from zip(*(part.column(i).to_pylist() for i in range(part.num_columns)),
                           strict=True)


def _short_batches(id_type):
    def conversations(batches):
        import pyarrow as pa

        none, size = object(), 0
        now, rows, out = none, [], []

        def done():
            turns, roles, texts = [], [], []
            for turn, role, text, times in rows:
                for _ in range(times):
                    turns.append(turn)
                    roles.append(role)
                    texts.append(text)
            faults, seen = faults_of(texts), set()
            for i, pair in enumerate(zip(roles, texts, strict=True)):
                if pair in seen and faults[i] != 1:
                    faults[i] = 2
                seen.add(pair)
            s = _summary(turns, roles, faults)
            gaps = 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["distinct"]
            cost, audit = best_repair([r[:1] for r in roles], faults)
            return {"conv_id": now, "gaps": gaps, "blank": s["blank"],
                    "duplicate": s["duplicate"], "truncated": s["truncated"],
                    "illegal": s["illegal"], "cost": cost, "audit": audit,
                    "turns": apply_audit(audit, roles, texts)}

        schema = pa.schema([
            ("conv_id", id_type), *((c, pa.int64()) for c in (
                "gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
            ("audit", pa.string()),
            ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])
        for conv, *row in _rows_of(batches):
            if now is not none and conv != now:
                out.append(done())
                rows = []
                if size > 4 << 20 or len(out) >= 2_000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            now = conv
            rows.append(row)
            size += len(row[2])
        if now is not none:
            out.append(done())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return conversations


def _short(rows: DataFrame) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    ordered = rows.select("conv_id", "turn", "role", "text", "times").repartition(
        "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_short_batches(to_arrow_type(kind)),
                              RESULT.format(id=kind.simpleString()))


# --- long conversations, in blocks ----------------------------------------------------------

BLOCK = ("key string, part int, no bigint, blank bigint, duplicate bigint, truncated bigint, "
         "illegal bigint, distinct bigint, low bigint, high bigint, first string, last string, "
         "ways array<struct<entry: string, exit: string, cost: bigint, rank: int, "
         f"audit: string>>, {TURNS}")


def _block_batches(batches):
    """Rows of key, turn, role, text, times, first (the earliest turn of role and text), sorted."""
    import pyarrow as pa
    from pyspark import TaskContext

    part, no, started = TaskContext.get().partitionId(), 0, False
    now, size, begins = None, 0, False
    turns, roles, texts, faults = [], [], [], []
    schema = pa.schema([
        ("key", pa.string()), ("part", pa.int32()), ("no", pa.int64()),
        *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "distinct",
                                    "low", "high")),
        ("first", pa.string()), ("last", pa.string()),
        ("ways", pa.list_(pa.struct([("entry", pa.string()), ("exit", pa.string()),
                                     ("cost", pa.int64()), ("rank", pa.int32()),
                                     ("audit", pa.string())]))),
        ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])

    def block():
        found = block_repairs([r[:1] for r in roles], faults, "S" if begins else "STUA")
        audits = sorted({audit for _, audit in found.values()})
        return pa.RecordBatch.from_pylist([{
            "key": now, "part": part, "no": no, **_summary(turns, roles, faults),
            "ways": [{"entry": p, "exit": q, "cost": cost, "rank": audits.index(audit),
                      "audit": audit} for (p, q), (cost, audit) in found.items()],
            "turns": [{"role": r, "text": t} for r, t in zip(roles, texts, strict=True)]}],
            schema=schema)

    for key, turn, role, text, times, first in _rows_of(batches):
        fault = faults_of([text])[0]
        for copy in range(times):
            if roles and (key != now or len(roles) >= BLOCK_ROWS or size > BLOCK_BYTES):
                yield block()
                turns, roles, texts, faults, size = [], [], [], [], 0
                no += 1
            if not roles:
                # Only the first conversation of a task may have begun in an earlier one.
                begins = started and key != now
            now, started = key, True
            again = fault != 1 and (copy > 0 or not first)
            turns.append(turn)
            roles.append(role)
            # What must go leaves no text behind.
            texts.append("" if again or fault == 1 else text)
            faults.append(2 if again else fault)
            size += len(text)
    if roles:
        yield block()


def _compose(blocks):
    """The chosen entry and exit of each block of one conversation, and its counts."""
    import pandas as pd

    blocks = blocks.sort_values(["part", "no"], kind="stable").reset_index(drop=True)
    n = len(blocks)
    togo = [dict() for _ in range(n)] + [{q: cost for q, (cost, _) in TAIL.items()}]
    for k in range(n - 1, -1, -1):
        for w in blocks["ways"][k]:
            cost = w["cost"] + togo[k + 1].get(w["exit"], FAR)
            togo[k][w["entry"]] = min(togo[k].get(w["entry"], FAR), cost)
    state, entries, exits = "S", [], []
    for k in range(n):
        w = min((w for w in blocks["ways"][k] if w["entry"] == state and w["cost"] + togo[
            k + 1].get(w["exit"], FAR) == togo[k][state]), key=lambda w: w["rank"])
        entries.append(state)
        state = w["exit"]
        exits.append(state)
    seams = zip(blocks["last"][:-1], blocks["first"][1:], strict=True)
    met = zip(blocks["high"][:-1], blocks["low"][1:], strict=True)
    low, high = blocks["low"].min(), blocks["high"].max()
    distinct = blocks["distinct"].sum() - sum(a == b for a, b in met)
    sums = {c: int(blocks[c].sum()) for c in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += sum(a + b not in ("su", "ua", "au") for a, b in seams)
    return pd.DataFrame({
        "key": blocks["key"], "part": blocks["part"], "no": blocks["no"], "entry": entries,
        "exit": exits, "ends": [False] * (n - 1) + [True],
        "gaps": 0 if pd.isna(low) else int(high - low + 1 - distinct),
        **sums, "cost": togo[0]["S"]})


def _applied(batches):
    """The blocks' turns after their chosen edits."""
    import pyarrow as pa

    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            audit = row["audit"] + (TAIL[row["exit"]][1] if row["ends"] else "")
            turns = apply_audit(audit, [t["role"] for t in row["turns"]],
                                [t["text"] for t in row["turns"]], row["entry"])
            yield pa.RecordBatch.from_pylist([{
                "key": row["key"], "part": row["part"], "no": row["no"], "audit": audit,
                "turns": turns}], schema=pa.schema([
                    ("key", pa.string()), ("part", pa.int32()), ("no", pa.int64()),
                    ("audit", pa.string()), ("turns", pa.list_(pa.struct([
                        ("role", pa.string()), ("text", pa.string())])))]))


def long_repairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, counts and cost: one row a conversation; key, part, no, audit, turns: its blocks in
    the order of part and no), staged, of rows with a ``key``."""
    counted = rows.filter("times > 0").groupBy("key", "turn", "role", "text").agg(
        F.sum("times").alias("times")).withColumn("same", F.sha2(F.concat(
            F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    counted = materialize(counted, "long-turns")
    order = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = counted.groupBy("key", "same").agg(F.min(order).alias("earliest"))
    marked = salted_join(counted, firsts, ["key", "same"], ["turn"]).withColumn(
        "first", F.col("turn").eqNullSafe(F.col("earliest.turn")))
    ordered = marked.select("key", "turn", "role", "text", "times", "first").repartitionByRange(
        "key", "turn", "role", "text").sortWithinPartitions("key", "turn", "role", "text")
    blocks = materialize(ordered.mapInArrow(_block_batches, BLOCK), "long-blocks")
    ways = F.transform("ways", lambda w: w.dropFields("audit"))
    chosen = materialize(blocks.drop("turns").withColumn("ways", ways).groupBy("key").applyInPandas(
        _compose, "key string, part int, no bigint, entry string, exit string, ends boolean, "
                  f"{COUNTS}, cost bigint"), "long-ways")
    way = F.filter("ways", lambda w: (w["entry"] == F.col("entry")) & (
        w["exit"] == F.col("exit")))[0]["audit"]
    met = blocks.select("key", "part", "no", "ways", "turns").join(
        chosen.select("key", "part", "no", "entry", "exit", "ends"), ["key", "part", "no"])
    done = materialize(met.withColumn("audit", way).drop("ways").mapInArrow(
        _applied, f"key string, part int, no bigint, audit string, {TURNS}"), "long-repaired")
    counts = chosen.filter("ends").select("key", *(c.split()[0] for c in COUNTS.split(", ")),
                                          "cost")
    return counts, done


def _joined_batches(batches):
    """audit and hash of each key's blocks, which come in order."""
    import hashlib

    import pyarrow as pa

    now, audit, hashed, some = None, [], None, False
    names = ["key", "audit", "repaired_sha256"]

    def row():
        return pa.RecordBatch.from_pydict({"key": [now], "audit": ["".join(audit)],
                                           "repaired_sha256": [hashed.hexdigest()]})

    for batch in batches:
        for at in range(batch.num_rows):
            r = batch.slice(at, 1).to_pylist()[0]
            if hashed is not None and r["key"] != now:
                yield row().select(names)
                audit, hashed, some = [], None, False
            now, hashed = r["key"], hashed or hashlib.sha256()
            audit.append(r["audit"])
            for turn in r["turns"]:
                hashed.update((("\n" if some else "") + f"{turn['role']}:{turn['text']}").encode())
                some = True
    if hashed is not None:
        yield row().select(names)


# --- the operator ---------------------------------------------------------------------------


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", F.to_json(F.struct(F.col("conv_id").cast("string").alias("c"))))


def repair(rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES
           ) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(repaired conversations with conv_id, counts, cost, audit and turns; and of long ones the
    counts and the blocks of ``long_repairs``, None where no conversation is long).

    ``rows``: conv_id, turn, role, text and, where it is given, times."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    times = F.col("times") if "times" in rows.columns else F.lit(1).cast("bigint")
    rows = _keyed(rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role, text,
                              times.alias("times")))
    sizes = rows.groupBy("key").agg(
        F.sum("times").alias("n"), F.sum(F.when(F.col("times") > 0, F.octet_length("text"))).alias("bytes"),
        F.first("conv_id").alias("conv_id"))
    long = materialize(sizes.filter((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)),
                       "long")
    if not long.limit(1).count():
        return _short(rows), None, None
    marked = salted_join(rows, long.select("key", F.lit(True).alias("long")), ["key"],
                         ["turn", "role", "text"], "left")
    counts, blocks = long_repairs(marked.filter(F.col("long")))
    return (_short(marked.filter(F.col("long").isNull())),
            counts.join(long.select("key", "conv_id"), "key"), blocks)


def repair_report(rows: DataFrame, **settings) -> DataFrame:
    """One row a conversation: counts, cost, audit, repaired_sha256 of ``role:text`` by line."""
    short, counts, blocks = repair(rows, **settings)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit(":"), t["text"])), "\n")
    report = short.withColumn("repaired_sha256", F.sha2(lines, 256)).drop("turns")
    if counts is None:
        return report
    joined = blocks.repartition("key").sortWithinPartitions("key", "part", "no").mapInArrow(
        _joined_batches, "key string, audit string, repaired_sha256 string")
    return report.unionByName(counts.join(joined, "key").select(report.columns))


by_value(__name__)
