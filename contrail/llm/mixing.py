"""Mixing sources by temperature.

A source's share of all tokens is raised to an exponent between 0 (all sources
alike) and 1 (as they come) and normalised. The exponent is found by bisection
(a round probes 15 points in one job, four halvings): the largest that
reaches ``target_entropy`` (a share of the logarithm of the number of sources), or
the smallest whose most repeated source stays within ``max_repetition`` epochs.

The weights are realised as budgeted block permutations. Each epoch of a source
orders its documents anew by a hash; blocks are ranges of that order. Whole epochs
take every document; the last one takes blocks, and in the last block
documents, while the budget lasts. Only sums per block and the last block's rows
are sorted, so a source with a third of all rows is never in one task, and the
texts are not shuffled: a document's copies follow from its hash and its
source's row.

Without ``budget_tokens``, the budget is the smallest that shows every document
at least once.

Defined results: tokens are runs of characters that are not white space; a
NULL or empty text has none and is taken in whole epochs; a NULL source is a
source; documents that tie in the hash (repeated rows) enter the last epoch
together or not at all; a source without tokens is shown once; one source gets
exponent 1; an empty table gives an empty result. Columns of the input stay;
clashing names are overwritten by the operator's (``mix_epoch``, ``mix_block``,
``mix_order``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import salted_join
from contrail.session import materialize

PROBES = 15
ROUNDS = 8
MAX_BLOCKS = 65_536
SMALL_SOURCES = 20_000


@dataclass
class Mixture:
    """The exponent, and one row a source: key, source, tokens, documents, weight,
    repetition, budget, epochs (whole), rest, blocks, cut_block, cut_order."""

    exponent: float
    sources: DataFrame
    n_sources: int


def count_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]++")).cast("bigint")


def source_key(source: Column) -> Column:
    """Text that is equal for equal sources, NULL included."""
    return F.to_json(F.struct(source.cast("string").alias("s")))


def _order(key: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed), epoch.cast("bigint")).bitwiseAND(F.lit((1 << 63) - 1))


def _block(order: Column, blocks: Column) -> Column:
    return F.least((order / F.lit(float(1 << 63)) * blocks).cast("bigint"), blocks - 1)


def probe(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(entropy, sum of share**a, share**(a - 1) of the smallest source) for each exponent a."""
    a, p = F.col("a"), F.col("share")
    rows = sources.select("share", F.posexplode(F.array(*map(F.lit, exponents))).alias("no", "a"))
    got = rows.groupBy("no", "a").agg(F.sum(F.pow(p, a)).alias("z"),
                                      F.sum(F.pow(p, a) * F.log(p)).alias("s"),
                                      F.max(F.pow(p, a - 1)).alias("most")).orderBy("no").collect()
    return [(math.log(r["z"]) - r["a"] * r["s"] / r["z"], r["z"], r["most"]) for r in got]


def solve_exponent(sources: DataFrame, n: int, top_share: float, budget_share: float | None,
                   target_entropy: float | None, max_repetition: float | None) -> float:
    """Bisects [0, 1]. Entropy falls and repetition falls as the exponent grows."""
    if n < 2:
        return 1.0

    def holds(a: float, entropy: float, z: float, most: float) -> bool:
        """True left of the wanted exponent."""
        if target_entropy is not None:
            return entropy >= target_entropy * math.log(n) - 1e-12
        scale = budget_share / z if budget_share is not None else top_share ** (1 - a)
        return most * scale > max_repetition + 1e-12

    low, high = 0.0, 1.0
    ends = probe(sources, [low, high])
    if not holds(low, *ends[0]):
        return low
    if holds(high, *ends[1]):
        return high
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / (PROBES + 1) for i in range(1, PROBES + 1)]
        true = [holds(a, *x) for a, x in zip(points, probe(sources, points), strict=True)]
        first = true.index(False) if False in true else PROBES
        low, high = ([low, *points][first], [*points, high][first])
    return low if target_entropy is not None else high


def mixture(docs: DataFrame, target_entropy: float | None = None,
            max_repetition: float | None = 2.0, budget_tokens: int | None = None,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            block_documents: int = 1_000, seed: int = 17) -> tuple[Mixture, DataFrame]:
    """The mixture, and the documents' rows (doc_id, source, key, hash, tokens), staged."""
    if (target_entropy is None) == (max_repetition is None):
        raise ValueError("give either target_entropy or max_repetition")
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        source_key(F.col(source_col)).alias("key"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"),
        count_tokens(F.col(text_col)).alias("tokens")), "mix-rows")
    sums = materialize(rows.groupBy("key").agg(
        F.first("source").alias("source"), F.sum("tokens").alias("tokens"),
        F.count("*").alias("documents")), "mix-sources")
    n_all, n, total, top = sums.agg(F.count("*"), F.count_if(F.col("tokens") > 0),
                                    F.sum("tokens"), F.max("tokens")).first()
    total, top = total or 0, top or 0
    shares = sums.filter("tokens > 0").select((F.col("tokens") / F.lit(max(total, 1))).alias(
        "share"))
    budget_share = budget_tokens / total if budget_tokens is not None and total else None
    a = solve_exponent(shares, n, top / max(total, 1), budget_share, target_entropy,
                       max_repetition)
    z = probe(shares, [a])[0][1] if n else 1.0
    share = F.col("tokens") / F.lit(max(total, 1))
    if budget_share is None:
        repetition = F.pow(F.col("tokens") / F.lit(max(top, 1)), F.lit(a - 1))
    else:
        repetition = F.pow(share, F.lit(a - 1)) * (budget_share / z)
    some = F.col("tokens") > 0
    plan = sums.select(
        "*", F.when(some, F.pow(share, F.lit(a)) / z).otherwise(0.0).alias("weight"),
        F.when(some, repetition).otherwise(1.0).alias("repetition")).withColumn(
        "budget", F.floor(F.col("tokens") * F.col("repetition"))).withColumn(
        "epochs", F.when(some, F.floor(F.col("budget") / F.greatest("tokens", F.lit(1))))
        .otherwise(1)).withColumn(
        "rest", F.col("budget") - F.when(some, F.col("epochs") * F.col("tokens")).otherwise(0)
    ).withColumn("blocks", F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(
        F.col("documents") / block_documents))))
    plan = materialize(plan, "mix-plan")
    return Mixture(a, _cuts(rows, plan, n_all, seed), n_all), rows


def _with_plan(rows: DataFrame, plan: DataFrame, n: int) -> DataFrame:
    """Each row with its source's row: broadcast within a bound, else salted."""
    if n <= SMALL_SOURCES:
        return rows.join(F.broadcast(plan), "key")
    return salted_join(rows, plan, ["key"], ["hash"])


def _cuts(rows: DataFrame, plan: DataFrame, n: int, seed: int) -> DataFrame:
    """``plan`` with the place where each source's last epoch ends."""
    need = plan.filter("rest > 0").select("key", "epochs", "rest", "blocks")
    order = _order(F.col("hash"), F.col("epochs"), seed)
    placed = _with_plan(rows.select("key", "hash", "tokens"), need, n).withColumn(
        "order", order).withColumn("block", _block(F.col("order"), F.col("blocks")))
    sums = placed.groupBy("key", "rest", "block").agg(F.sum("tokens").alias("t"))
    along = Window.partitionBy("key").orderBy("block")
    cut = materialize(sums.withColumn("upto", F.sum("t").over(along)).filter(
        F.col("upto") > F.col("rest")).groupBy("key").agg(
        F.min("block").alias("cut_block"), F.min_by(F.col("upto") - F.col("t"), "block")
        .alias("before")), "mix-cuts")
    inside = _with_plan(placed, cut, n).filter("block = cut_block")
    running = F.sum("tokens").over(Window.partitionBy("key").orderBy("order").rangeBetween(
        Window.unboundedPreceding, Window.currentRow))
    ends = (inside.withColumn("upto", F.col("before") + running).filter("upto <= rest")
            .groupBy("key").agg(F.max("order").alias("cut_order")))
    return materialize(plan.join(cut.drop("before"), "key", "left").join(ends, "key", "left"),
                       "mix-plan")


def realise(rows: DataFrame, mix: Mixture, seed: int = 17) -> DataFrame:
    """``rows`` (with key and hash) once for each epoch that shows them: mix_epoch,
    mix_block (in the epoch's order) and mix_order."""
    plan = mix.sources.select("key", *(F.col(c).alias(f"__{c}") for c in (
        "epochs", "rest", "blocks", "cut_block", "cut_order")))
    met = _with_plan(rows, plan, mix.n_sources)
    order = _order(F.col("hash"), F.col("__epochs"), seed)
    block = _block(order, F.col("__blocks"))
    last = F.coalesce((F.col("__rest") > 0) & (
        F.col("__cut_block").isNull() | (block < F.col("__cut_block")) | (
            (block == F.col("__cut_block")) & (order <= F.coalesce("__cut_order", F.lit(-1))))),
        F.lit(False))
    copies = F.col("__epochs") + last.cast("bigint")
    shown = met.withColumn("__copies", copies).filter("__copies > 0").withColumn(
        "mix_epoch", F.explode(F.sequence(F.lit(0), (F.col("__copies") - 1).cast("int"))))
    shown = shown.withColumn("mix_order", _order(F.col("hash"), F.col("mix_epoch"), seed))
    shown = shown.withColumn("mix_block", _block(F.col("mix_order"), F.col("__blocks")))
    return shown.drop("__copies", *(c for c in plan.columns if c != "key"))


def mixing_report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, source, tokens, mix_epoch, mix_block, mix_order of all that is shown."""
    mix, rows = mixture(docs, **settings)
    return realise(rows, mix).select("doc_id", "source", "tokens", "mix_epoch", "mix_block",
                                     "mix_order")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", **settings) -> DataFrame:
    """``docs`` as the mixture shows them, with mix_epoch, mix_block and mix_order."""
    mix, _ = mixture(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    own = [c for c in docs.columns if c not in ("mix_epoch", "mix_block", "mix_order")]
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("__row"),
                         source_key(F.col(source_col)).alias("key"),
                         F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"))
    return realise(packed, mix).select("__row.*", "mix_epoch", "mix_block", "mix_order")
