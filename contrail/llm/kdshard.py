"""Sharding by a k-d tree over the documents' metadata.

A node of the tree holds documents and a number of leaves. It is split at the
weighted median (by bytes) of its widest metadata dimension, until each node is one
leaf of the target bytes; with an odd number of leaves the cut stands at the smaller
half's share. Dimensions are put on one scale: numbers by the table's minimum and
maximum, texts by their hash (equal values share a place; their order means
nothing), NULLs and NaNs before all others. A node's width is what its documents span
of that scale; the first of equally wide dimensions is taken.

Documents are ordered by place, then a hash of id and text, then their row in the
staged metadata, so a place that any number of documents share is cut as well. The
median is exact and found for all nodes of a level at once: sums over ``BUCKETS``
ranges, then again inside the range that holds the median, until ``LAST_ROWS``
documents are left in it, which one window orders. Only these sums and rows are
shuffled; the state of the nodes stays in staged tables, and texts are read once.

Slots within a shard are numbered over hashed chunks of about ``LAST_ROWS`` rows:
counts of the chunks give their offsets.

Defined results: size is the UTF-8 bytes of the text (NULL: none) plus 1, so each
document weighs something; repeated rows are documents of their own; documents fewer
than shards leave shards empty; an empty table gives an empty result; dimensions that
the table lacks are left out, and without any the hash decides; the columns of
``keep`` stay, those named like the results are overwritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from contrail.llm.common import checked_join
from contrail.session import materialize

DIMENSIONS = ("source", "lang", "n_chars", "doc_id")
BUCKETS = 1024
LAST_ROWS = 10_000
#: Levels of the tree between two copies of the metadata.
LEVELS_A_COPY = 4
SCALE = 1 << 52
TOP = (1 << 62) - 1


def _places(docs: DataFrame, dimensions: list[str]) -> list[Column]:
    """Each dimension on the scale from 1 to SCALE + 1; 0 for NULL."""
    numbers = [d for d in dimensions if isinstance(docs.schema[d].dataType, NumericType)]
    value = {d: F.nanvl(F.col(f"`{d}`").cast("double"), F.lit(None)) for d in numbers}
    ends = docs.agg(F.count(F.lit(1)), *(f(value[d]) for d in numbers for f in (F.min, F.max))
                    ).first()[1:]
    out = []
    for d in dimensions:
        if d not in numbers:
            place = F.shiftrightunsigned(F.xxhash64(F.col(f"`{d}`").cast("string")), 12) + 1
            out.append(F.when(F.col(f"`{d}`").isNull(), F.lit(0)).otherwise(place))
            continue
        low, high = ends[2 * numbers.index(d)], ends[2 * numbers.index(d) + 1]
        span = (high - low) if low is not None and high > low else 1.0
        place = ((value[d] - F.lit(low if low is not None else 0.0)) / F.lit(span) * F.lit(
            float(SCALE))).cast("bigint") + 1
        out.append(F.coalesce(place, F.lit(0)))
    return [c.cast("bigint") for c in out]


def metadata(docs: DataFrame, keep: list[str], text_col: str = "text",
             dimensions: list[str] | None = None, id_col: str = "doc_id") -> DataFrame:
    """One staged row a document: the kept columns, size, text_crc32, places, tie, uid."""
    wanted = DIMENSIONS if dimensions is None else dimensions
    used = [d for d in wanted if d in docs.columns and isinstance(
        docs.schema[d].dataType, (NumericType, StringType))]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    places = _places(docs, used) or [F.lit(0).cast("bigint")]
    return materialize(docs.select(
        *(F.col(f"`{c}`") for c in keep),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.array(*places).alias("places"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).bitwiseAND(F.lit(TOP)).alias(
            "tie"),
        F.monotonically_increasing_id().alias("uid")), "kd-rows")


def _nodes(rows: DataFrame) -> DataFrame:
    """The nodes with several leaves: their goal (bytes left of the cut), widest dimension, and
    the whole range to search."""
    ranges = rows.filter("leaves > 1").select("shard", "leaves", "size", F.posexplode("places"))
    spans = ranges.groupBy("shard", "leaves", "pos").agg(
        F.sum("size").alias("bytes"), F.min("col").alias("lo"), F.max("col").alias("hi"),
        F.count(F.lit(1)).alias("n"))
    width = F.col("hi") - F.col("lo")
    node = spans.groupBy("shard", "leaves").agg(
        F.first("bytes").alias("bytes"), F.first("n").alias("n"),
        F.max_by(F.struct("pos", "lo", "hi"), F.struct(width, -F.col("pos"))).alias("w"))
    left = F.floor(F.col("leaves") / 2).cast("int")
    return node.select(
        "shard", left.alias("left"), (F.col("bytes") * left / F.col("leaves")).alias("goal"),
        F.col("w.pos").alias("dim"), F.lit(0).alias("step"), F.col("w.lo").alias("lo"),
        F.col("w.hi").alias("hi"), F.lit(0).cast("bigint").alias("before"),
        F.lit(0).cast("bigint").alias("at_place"), F.lit(0).cast("bigint").alias("at_tie"), "n")


def _inside(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The rows in their node's range, with ``place`` and the value searched, ``v``."""
    met = checked_join(rows.select("shard", "size", "places", "tie", "uid"), state, ["shard"],
                       ["uid"])
    met = met.withColumn("place", F.get("places", F.col("dim")))
    v = F.when(F.col("step") == 0, F.col("place")).when(F.col("step") == 1, F.col("tie")
                                                        ).otherwise(F.col("uid"))
    same = ((F.col("step") == 0) | (F.col("place") == F.col("at_place"))) & (
        (F.col("step") < 2) | (F.col("tie") == F.col("at_tie")))
    return met.withColumn("v", v).filter(same & F.col("v").between(F.col("lo"), F.col("hi")))


def _narrow(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with each range cut to the bucket that holds the node's goal; a range of one
    value goes on with the next of place, tie, row."""
    width = F.expr("(hi - lo) div " + str(BUCKETS) + " + 1")
    kept = [c for c in state.columns if c not in ("lo", "hi", "before", "n")]
    sums = _inside(rows, state).withColumn("width", width).groupBy(
        *kept, "before", F.expr("(v - lo) div width").alias("bucket")).agg(
        F.sum("size").alias("w"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.count(F.lit(1)).alias("n"))
    upto = F.col("before") + F.sum("w").over(Window.partitionBy("shard").orderBy("bucket"))
    held = sums.withColumn("upto", upto).filter(
        (F.col("upto") >= F.col("goal")) & (F.col("upto") - F.col("w") < F.col("goal")))
    done, step = (F.col("lo") == F.col("hi")) & (F.col("step") < 2), F.col("step")
    return held.select(
        "shard", "left", "goal", "dim", F.when(done, step + 1).otherwise(step).alias("step"),
        F.when(done, F.lit(0)).otherwise(F.col("lo")).alias("lo"),
        F.when(done, F.lit(TOP)).otherwise(F.col("hi")).alias("hi"),
        (F.col("upto") - F.col("w")).alias("before"),
        F.when(step == 0, F.col("lo")).otherwise(F.col("at_place")).alias("at_place"),
        F.when(step == 1, F.col("lo")).otherwise(F.col("at_tie")).alias("at_tie"), "n")


def _cuts(rows: DataFrame) -> DataFrame:
    """shard, left, dim and the last document left of each node's cut (staged)."""
    state = materialize(_nodes(rows), "kd-nodes")
    while state.filter(F.col("n") > LAST_ROWS).limit(1).count():
        state = materialize(_narrow(rows, state), "kd-nodes")
    along = Window.partitionBy("shard").orderBy("place", "tie", "uid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    last = _inside(rows, state).withColumn("upto", F.col("before") + F.sum("size").over(along))
    held = last.filter((F.col("upto") >= F.col("goal")) & (
        F.col("upto") - F.col("size") < F.col("goal")))
    over, short = F.col("upto") - F.col("goal"), F.col("goal") - F.col("upto") + F.col("size")
    return materialize(held.select(
        "shard", "left", "dim", F.col("place").alias("cut_place"), F.col("tie").alias("cut_tie"),
        # The document on the goal goes to the side that it brings nearer.
        F.when(over <= short, F.col("uid")).otherwise(F.col("uid") - 1).alias("cut_uid")),
        "kd-cuts")


def _descend(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` one level down."""
    met = checked_join(rows, cuts, ["shard"], ["uid"], "left")
    place = F.get("places", F.col("dim"))
    left = F.col("left")  # NULL in a leaf, which has no cut
    right = left.isNotNull() & (F.struct(place, "tie", "uid") > F.struct(
        "cut_place", "cut_tie", "cut_uid"))
    return met.withColumns({
        "leaves": F.when(left.isNull(), F.col("leaves")).when(
            right, F.col("leaves") - left).otherwise(left),
        "shard": F.when(right, F.col("shard") + left).otherwise(F.col("shard")),
    }).drop(*(c for c in cuts.columns if c != "shard"))


def number_slots(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slot``, gapless from 0 in each shard."""
    most = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    chunk = F.pmod(F.xxhash64("uid"), F.lit(max(1, -(-most // LAST_ROWS))))
    dealt = rows.withColumn("chunk", chunk)
    counts = dealt.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")
    offsets = materialize(counts.select("shard", "chunk", before.alias("offset")), "kd-offsets")
    place = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("tie", "uid"))
    placed = dealt.withColumn("slot", place.cast("bigint") - 1)
    return checked_join(placed, offsets, ["shard", "chunk"], ["uid"]).withColumn(
        "slot", F.col("slot") + F.col("offset")).drop("chunk", "offset")


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              keep: list[str] | None = None, text_col: str = "text", id_col: str = "doc_id",
              dimensions: list[str] | None = None) -> DataFrame:
    """The kept columns (all but the text) with size, text_crc32, shard and slot. Give the number
    of shards, or the bytes that a shard shall hold."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give either shards or target_bytes")
    made = ("size", "text_crc32", "shard", "slot")
    inner = ("places", "tie", "uid", "leaves", "left", "dim", "cut_place", "cut_tie", "cut_uid",
             "chunk", "offset")
    own = [c for c in (keep if keep is not None else docs.columns)
           if c not in made and (keep is not None or c != text_col)]
    # Kept columns travel under names of ours, so that none of theirs can clash.
    held = [f"__keep{i}" for i in range(len(own))]
    given = docs.withColumns({h: F.col(f"`{c}`") for h, c in zip(held, own, strict=True)})
    meta = metadata(given, held, text_col, dimensions, id_col)
    if shards is None:
        shards = max(1, -(-(meta.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    rows = meta.select(*held, "size", "text_crc32", *inner[:3], F.lit(0).alias("shard"),
                       F.lit(shards).alias("leaves"))
    for level in range((shards - 1).bit_length()):
        rows = _descend(rows, _cuts(rows))
        if level % LEVELS_A_COPY == LEVELS_A_COPY - 1:
            rows = materialize(rows, "kd-rows")
    done = number_slots(rows)
    return done.select(*(F.col(h).alias(c) for h, c in zip(held, own, strict=True)), *made)


def shard_report(docs: DataFrame, shards: int = 8) -> DataFrame:
    placed = kd_shards(docs, shards, keep=["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))
