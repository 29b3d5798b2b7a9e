"""Line dedup with a sharded minimal perfect hash.

A line's key is the line without white space at its ends, A-Z lower-cased; its
hash has 128 bits (two longs). Spark counts, for each hash, the documents that
hold it. The hashes of ``min_documents`` or more are dealt into shards; each shard
is built in one task into a minimal perfect hash (levels of bit arrays; a key's
rank among the set bits is its slot, below the number of keys) over the first
long, with two arrays by slot: the second long as fingerprint, and the count.
Documents then probe the arrays: a line goes if the fingerprint in its slot is
its own. Lines are never joined, and a line that is not indexed is told
apart by 64 bits of fingerprint.

Shards have a bounded number of keys. Groups of them up to ``group_bytes`` are
broadcast; a larger index takes several passes over the documents, one a group,
staged between, so memory stays bounded and no line is left out.

Defined results: a NULL or empty text is one empty line; keys shorter than one
character are never dropped; a line counts once a row of the table, so repeated
rows count each; lines end at \\n only; ties cannot occur; empty tables give
empty results; other columns stay as they are.
"""

from __future__ import annotations

import pickle

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from contrail.llm.common import by_value, cells
from contrail.session import materialize

SPACE = b" \t\n\r\x0b\x0c"
LEVELS = 24
RESULT = "text string, n_lines bigint, n_dropped bigint"


def line_hashes(lines: list[bytes]) -> list[bytes | None]:
    """The 16-byte hash of each line's key, None for an empty key."""
    from xxhash import xxh3_128_digest

    keys = [x.strip(SPACE).lower() for x in lines]
    return [xxh3_128_digest(k) if k else None for k in keys]


def _mixed(keys, level: int):
    """splitmix64 of uint64 ``keys``, another function for each level."""
    import numpy as np

    z = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & ((1 << 64) - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _place(keys, level: int, size: int):
    import numpy as np

    return ((_mixed(keys, level) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(
        np.int64)


class Shard:
    """A minimal perfect hash with its fingerprint and count arrays."""

    def __init__(self, first, second, counts):
        """first, second: uint64 arrays, pairs distinct; counts: integers."""
        import numpy as np

        left, words, self.sizes = np.arange(len(first)), [], []
        slots = np.full(len(first), -1, dtype=np.int64)
        base = 0
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, -(-2 * len(left) // 64) * 64)
            at = _place(first[left], level, size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            mine = alone[at]
            slots[left[mine]] = base + np.cumsum(alone)[at[mine]] - 1
            base += int(mine.sum())
            self.sizes.append(size)
            left = left[~mine]
        self.words = np.concatenate(words) if words else np.zeros(0, dtype="<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.uint32)
        # Keys that no level tells apart (equal first longs) stand in a sorted list at the end.
        left = left[np.lexsort((second[left], first[left]))]
        slots[left] = base + np.arange(len(left))
        self.rest = {(int(a), int(b)): base + i for i, (a, b) in enumerate(zip(
            first[left], second[left], strict=True))}
        self.prints, self.counts = np.empty(len(first), "<u8"), np.empty(len(first), np.uint32)
        self.prints[slots], self.counts[slots] = second, np.minimum(counts, (1 << 32) - 1)

    @classmethod
    def of(cls, state: dict) -> Shard:
        """The shard whose ``vars`` were stored."""
        shard = cls.__new__(cls)
        vars(shard).update(state)
        return shard

    def lookup(self, first, second):
        """The count of each key, 0 for keys that are not in the shard."""
        import numpy as np

        slot = np.full(len(first), -1, dtype=np.int64)
        left, offset = np.arange(len(first)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = _place(first[left], level, size) + offset
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            slot[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below).astype(np.int64)
            left, offset = left[~hit], offset + size
        if self.rest:
            for i in left:
                slot[i] = self.rest.get((int(first[i]), int(second[i])), -1)
        found = np.flatnonzero(slot >= 0)
        found = found[self.prints[slot[found]] == second[found]]
        out = np.zeros(len(first), dtype=np.int64)
        out[found] = self.counts[slot[found]]
        if self.rest:  # a first long of the list may also sit on another key's bit
            for i in np.flatnonzero(out == 0):
                s = self.rest.get((int(first[i]), int(second[i])))
                out[i] = 0 if s is None else self.counts[s]
        return out


def _hash_batches(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 1_000):
            found: list[bytes] = []
            for raw in cells(batch.column(0).slice(at, 1_000)):
                if raw:
                    keys = set(line_hashes(raw.split(b"\n")))
                    keys.discard(None)
                    found += keys
            pairs = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                             names=["h1", "h2"])


def line_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """h1, h2, n: for each line hash the number of rows that hold it."""
    return (docs.select(F.col(text_col)).mapInArrow(_hash_batches, "h1 bigint, h2 bigint")
            .groupBy("h1", "h2").agg(F.count("*").alias("n")))


def _build(table):
    import numpy as np
    import pyarrow as pa

    first, second = (np.asarray(table[c]).astype(np.int64).view(np.uint64) for c in ("h1", "h2"))
    blob = pickle.dumps(vars(Shard(first, second, np.asarray(table["n"]))), protocol=5)
    return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int32()),
                     "size": pa.array([len(blob)], pa.int64()),
                     "blob": pa.array([blob], pa.large_binary() if len(blob) >> 31
                                      else pa.binary())})


def build_index(counts: DataFrame, min_documents: int = 10,
                shard_keys: int = 200_000) -> tuple[DataFrame, int]:
    """(shard, size, blob: one row a shard, staged; the number of shards)."""
    often = materialize(counts.filter(F.col("n") >= min_documents), "lines")
    shards = max(1, -(-often.count() // shard_keys))
    dealt = often.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    return materialize(dealt.groupBy("shard").applyInArrow(
        _build, "shard int, size bigint, blob binary"), "index"), shards


def _probe_udf(shared, shards: int):
    def batch(texts):
        import numpy as np
        import pyarrow as pa

        index = {s: Shard.of(pickle.loads(b)) for s, b in shared.value.items()}
        out = {"text": [], "n_lines": [], "n_dropped": []}

        def flush(part: list) -> None:
            hashes = [line_hashes(lines) for _, lines in part]
            known = [h for hs in hashes for h in hs if h]
            pairs = np.frombuffer(b"".join(known), dtype="<i8").reshape(-1, 2)
            first, second = (np.ascontiguousarray(pairs[:, i]).view(np.uint64) for i in (0, 1))
            drop, home = np.zeros(len(pairs), dtype=bool), np.mod(pairs[:, 0], shards)
            for s, shard in index.items():
                mine = np.flatnonzero(home == s)
                drop[mine] = shard.lookup(first[mine], second[mine]) > 0
            flags = iter(drop.tolist())
            for (raw, lines), hs in zip(part, hashes, strict=True):
                gone = [next(flags) if h else False for h in hs]
                n = sum(gone)
                kept = raw if not n else b"\n".join(
                    x for x, g in zip(lines, gone, strict=True) if not g)
                out["text"].append(kept)
                out["n_lines"].append(len(lines))
                out["n_dropped"].append(n)

        part, size = [], 0
        for raw in cells(texts):
            part.append((raw, (raw or b"").split(b"\n")))
            size += len(raw or b"")
            if size > 1 << 22:
                flush(part)
                part, size = [], 0
        flush(part)
        text = pa.array(out["text"], pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays(
            [text, pa.array(out["n_lines"], pa.int64()), pa.array(out["n_dropped"], pa.int64())],
            ["text", "n_lines", "n_dropped"])

    return arrow_udf(batch, RESULT)


def drop_repeated_lines(docs: DataFrame, min_documents: int = 10, text_col: str = "text",
                        shard_keys: int = 200_000, group_bytes: int = 64 << 20,
                        result_col: str = "lines") -> DataFrame:
    """``docs`` with a struct column: the text that stays, n_lines before, n_dropped."""
    spark = docs.sparkSession
    index, shards = build_index(line_counts(docs, text_col), min_documents, shard_keys)
    groups, size = [[]], 0
    for row in index.select("shard", "size").orderBy("shard").toLocalIterator():
        if groups[-1] and size + row["size"] > group_bytes:
            groups.append([])
            size = 0
        groups[-1].append(row["shard"])
        size += row["size"]
    out = docs
    for i, group in enumerate(groups):
        held = index.filter(F.col("shard").isin(group)).select("shard", "blob").collect()
        shared = spark.sparkContext.broadcast({r["shard"]: bytes(r["blob"]) for r in held})
        probe = _probe_udf(shared, shards)
        if not i:
            out = out.withColumn(result_col, probe(F.col(text_col)))
            continue
        again = materialize(out, "line-pass").withColumn(
            "__again", probe(F.col(result_col)["text"]))
        now, new = F.col(result_col), F.col("__again")
        out = again.withColumn(result_col, F.struct(
            new["text"].alias("text"), now["n_lines"].alias("n_lines"),
            (now["n_dropped"] + new["n_dropped"]).alias("n_dropped"))).drop("__again")
    return out


def line_report(docs: DataFrame, min_documents: int = 10) -> DataFrame:
    found = drop_repeated_lines(docs.select("doc_id", "text"), min_documents)
    return found.select(
        "doc_id", F.col("lines.n_lines").alias("n_lines"),
        F.col("lines.n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("lines.text", F.lit("")), 256).alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame, min_documents: int = 10, text_col: str = "text",
                           size_col: str = "n_chars") -> DataFrame:
    """``docs`` with its texts shortened; ``size_col``, where there is one, is the new length
    in characters. A NULL text stays NULL. Columns and rows are as before."""
    name = "__lines"
    found = drop_repeated_lines(docs, min_documents, text_col, result_col=name)
    text = F.col(name)["text"]
    changed = F.col(name)["n_dropped"] > 0
    new = {text_col: text}
    if size_col in docs.columns:
        new[size_col] = F.when(changed, F.char_length(text).cast(
            docs.schema[size_col].dataType)).otherwise(F.col(size_col))
    return found.withColumns(new).select(*docs.columns)


by_value(__name__)
