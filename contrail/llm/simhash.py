"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

A fingerprint's bit is 1 where over half of the hashes of the text's word
shingles (repeats included) have it. Every distinct fingerprint emits all
variants within half of the distance; two fingerprints within the distance
share a variant. A variant's bucket holds at most as many distinct
fingerprints as a ball has members, whatever the data, since copies are
collapsed before. Each bucket links its members to its smallest one; the
links are verified by their bit distance and deduplicated. Groups are the
connected components of the links.

Defined results: a NULL or empty text, or one without words, has fingerprint
zero, which links like any other; fewer words than a shingle give one shingle
of all words; repeated rows share a group; the component id is the smallest id
of the group, NULL where no member has an id; an empty table gives an empty
result; extra columns are ignored. Whole texts are read, in chunks.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from contrail.llm.common import by_value, cells, checked, salted_join, text_hash
from contrail.llm.components import connected_components
from contrail.session import materialize

CHUNK = 65_536
VARIANTS_IN_TASK = 2_000_000


def fingerprint(raw: bytes | None, words_in_shingle: int, seed: int) -> int:
    """The signed 64-bit fingerprint of a text's UTF-8 bytes."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = raw.lower().split() if raw else []  # ASCII: A-Z, and white space 9-13 and 32
    if not words:
        return 0
    if len(words) < words_in_shingle:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        parts = [itertools.islice(words, i, None) for i in range(words_in_shingle)]
        shingles, n = map(b" ".join, zip(*parts, strict=False)), len(words) - words_in_shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    hashes = map(xxh64_intdigest, shingles, itertools.repeat(seed))
    for at in range(0, n, CHUNK):
        h = np.fromiter(itertools.islice(hashes, CHUNK), dtype="<u8", count=min(CHUNK, n - at))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint_udf(words_in_shingle: int = 3, seed: int = 42):
    def batch(texts):
        import pyarrow as pa

        return pa.array([fingerprint(raw, words_in_shingle, seed) for raw in cells(texts)],
                        type=pa.int64())

    return arrow_udf(batch, "bigint")


def ball(fp, radius: int):
    """All values within ``radius`` bits of ``fp``, as an array column."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1)
             for bits in itertools.combinations(range(64), r)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.transform(F.array(*map(F.lit, signed)), lambda m: m.bitwiseXOR(fp))


def ball_links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """u, v: links between the distinct fingerprints ``fp`` of ``prints``, enough of
    them that everything within ``max_bits`` (an even number) is connected."""
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0, 2 or 4: a bucket's members are then all linked")
    size = sum(math.comb(64, r) for r in range(max_bits // 2 + 1))
    parts = max(1, -(-prints.count() * size // VARIANTS_IN_TASK))
    buckets = (prints.repartition(parts, "fp").select("fp", F.explode(ball(F.col("fp"), max_bits // 2)).alias("variant"))
               .groupBy("variant").agg(F.collect_list("fp").alias("fps"))
               .filter(F.size("fps") > 1))
    links = buckets.select(F.array_min("fps").alias("v"), F.explode("fps").alias("u"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    return links.filter((F.col("u") != F.col("v")) & near).distinct()


def simhash_groups(docs: DataFrame, words_in_shingle: int = 3, max_bits: int = 2,
                   id_col: str = "doc_id", text_col: str = "text", seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: the id, text_key (a hash of the text), fp (long),
    root (a fingerprint that names the group) and component_id (its smallest id)."""
    prints = materialize(docs.select(
        F.col(id_col).alias("doc_id"), text_hash(F.col(text_col)).alias("text_key"),
        fingerprint_udf(words_in_shingle, seed)(F.col(text_col)).alias("fp")), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    parts = connected_components(ball_links(distinct.select("fp"), max_bits))
    rooted = distinct.join(parts, distinct["fp"] == parts["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = salted_join(rooted.select("fp", "root"), ids, ["root"], ["fp"])
    # Copies share a fingerprint, so the rows of a hot one are dealt to several tasks.
    return salted_join(prints, named, ["fp"], ["doc_id", "text_key"]).select(
        F.col("doc_id").alias(id_col), "text_key", "fp", "root", "component_id")


def keep_one_of_each(docs: DataFrame, words_in_shingle: int = 3, max_bits: int = 2,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (NULL last), then of the
    smallest text hash; of rows equal in both, that of the smallest hash of all columns. Row
    columns are kept as they are. The rows to leave out are listed, not those to keep, so texts
    are not shuffled while that list is within the broadcast bound."""
    groups = simhash_groups(docs, words_in_shingle, max_bits, id_col, text_col)
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                     F.col("text_key").alias("key"))
    members = materialize(groups.groupBy("root", order.alias("m")).agg(
        F.count("*").alias("n")), "members")
    first = members.groupBy("root").agg(F.min("m").alias("first"), F.count("*").alias("texts"))
    met = salted_join(members, first.filter("texts > 1"), ["root"], ["m"], "left")
    named = [F.col("m.id").alias("__id"), F.col("m.key").alias("__key")]
    out = F.col("first").isNotNull() & (F.col("m") != F.col("first"))
    losers = materialize(met.filter(out).select(*named), "losers")
    several = materialize(met.filter(~F.coalesce(out, F.lit(False)) & (F.col("n") > 1)).select(
        *named), "several")
    match = lambda side: (docs[id_col].eqNullSafe(side["__id"])
                          & (text_hash(docs[text_col]) == side["__key"]))
    left = docs.join(checked(losers), match(losers), "left_anti")
    if several.isEmpty():
        return left
    whole = F.struct(*(docs[c] for c in docs.columns))
    one = (left.join(checked(several), match(several), "left_semi")
           .groupBy(docs[id_col].alias("__i"), text_hash(docs[text_col]).alias("__k"))
           .agg(F.min_by(whole, F.xxhash64(*(docs[c] for c in docs.columns))).alias("__row")))
    return left.join(checked(several), match(several), "left_anti").unionAll(
        one.select(*(F.col(f"__row.`{c}`").alias(c) for c in docs.columns)))


by_value(__name__)
