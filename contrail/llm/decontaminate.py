"""Benchmark decontamination over a positional inverted index.

The training texts' words that occur in the benchmark are stored as postings
(term, text, position), once. A benchmark window (``window`` consecutive words
of an item; a shorter item is one window) is sought from its rarest term: its
postings, moved by the term's place in the window, name the diagonals on
which the window may lie; the list of its second rarest term, moved likewise,
is intersected with them; on the diagonals left the lists of all the window's
terms are intersected, and runs of at least ``window`` consecutive places are
the exact phrase matches. Proximity matches take the window's two rarest terms that
any text holds, at up to ``slop`` words from where the phrase has them; they
are reported beside the exact ones and drop no text.

All of it is DataFrame and SQL functions. Only the benchmark's terms are
broadcast, and only while their number is within ``common.BROADCAST_ROWS``; beyond
it Spark joins by shuffles.

Defined results: words are runs of ASCII letters and digits and of non-ASCII
characters, A-Z lower-cased; a NULL or empty text has no words and no hits; an
item without words is nowhere found; repeated texts are matched each on their
own, repeated items count once by their item_id; a NULL item_id is matched but
not listed; empty tables give no hits; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import checked, checked_join, text_hash
from contrail.session import materialize

WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = 0  # the term number of a text's first posting, which stands for the text itself


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORDS), F.lit(0))


def lower_ascii(word: Column) -> Column:
    """A-Z only: lower() is that for ASCII words, and quicker."""
    ascii_only = F.octet_length(word) == F.char_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def benchmark_terms(items: DataFrame, id_col: str = "item_id",
                    text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(vocabulary: word, term), (terms: item, item_id, place, size, term), staged."""
    placed = materialize(items.select(
        F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"),
        words_of(F.col(text_col)).alias("words")).select(
        "item", "item_id", F.size("words").alias("size"),
        F.posexplode("words").alias("place", "word")).withColumn(
        "word", lower_ascii(F.col("word"))), "items")
    vocabulary = materialize(placed.select("word").distinct().select(
        "word", (F.monotonically_increasing_id() + MARK + 1).alias("term")).unionAll(
        items.sparkSession.sql(f"SELECT '' AS word, {MARK}L AS term")), "vocabulary")
    terms = materialize(placed.join(vocabulary, "word").drop("word"), "terms")
    return vocabulary, terms


def postings(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """row, doc_id, text_key, n_words, term, pos (from 1), staged. The posting of term
    ``MARK`` stands for the text."""
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        text_hash(F.col(text_col)).alias("text_key"), words_of(F.col(text_col)).alias("words"))
    places = texts.select(
        "row", "doc_id", "text_key", F.size("words").alias("n_words"),
        F.posexplode(F.concat(F.array(F.lit("")), F.col("words"))).alias("pos", "word")
    ).withColumn("word", lower_ascii(F.col("word")))
    # Beyond the bound a frequent word's places are dealt to many tasks by salts.
    return materialize(checked_join(places, vocabulary, ["word"], ["row", "pos"]).drop("word"),
                       "postings")


def anchors(index: DataFrame, terms: DataFrame, window: int = 10, whole: bool = True) -> DataFrame:
    """The windows' two rarest terms that texts hold: item, item_id, w, place1, term1, place2,
    term2 and the first and last window (its first place) that they stand for, staged. Left out
    are windows with a term that no text holds, or (not ``whole``) with but one that any holds."""
    often = index.filter(F.col("term") != MARK).groupBy("term").agg(F.count("*").alias("tf"))
    w = F.least(F.col("size"), F.lit(window))
    starts = F.sequence(F.greatest(F.lit(0), F.col("place") - w + 1),
                        F.least(F.col("place"), F.col("size") - w))
    windows = (terms.join(often, "term").select("item", "item_id", w.alias("w"), "place", "term",
                                                "tf", F.explode(starts).alias("start"))
               .groupBy("item", "item_id", "w", "start")
               .agg(F.array_sort(F.collect_list(F.struct("tf", "place", "term"))).alias("t"))
               .filter(F.size("t") >= (F.col("w") if whole else F.least("w", F.lit(2)))))
    second = F.when(F.col("w") > 1, F.col("t")[1])
    return materialize(windows.select(
        "item", "item_id", "w", "start", F.col("t")[0]["place"].alias("place1"),
        F.col("t")[0]["term"].alias("term1"), second["place"].alias("place2"),
        second["term"].alias("term2")).groupBy(
        "item", "item_id", "w", "place1", "term1", "place2", "term2").agg(
        F.min("start").alias("first"), F.max("start").alias("last")), "anchors")


def _near(index: DataFrame, anchor: DataFrame, slop: int) -> DataFrame:
    """Rows whose list of the rarest term meets that of the second rarest, off by up to ``slop``."""
    n = anchor.count()
    ones = checked_join(index.select("row", "pos", F.col("term").alias("term1")), anchor,
                        ["term1"], ["row", "pos"], rows=n).withColumn(
        "diagonal", F.col("pos") - F.col("place1"))
    seconds = anchor.filter("term2 is not null").select(F.col("term2").alias("term")).distinct()
    second = checked_join(index.select("row", "term", "pos"), seconds, ["term"], ["row", "pos"],
                          rows=n).select("row", F.col("term").alias("term2"),
                                         F.col("pos").alias("pos2"))
    shifts = F.sequence(F.lit(-slop), F.lit(slop)) if slop else F.array(F.lit(0))
    two = (ones.filter("term2 is not null").withColumn("off", F.explode(shifts))
           .withColumn("pos2", F.col("diagonal") + F.col("place2") + F.col("off"))
           .join(second, ["row", "term2", "pos2"]))
    one = ones.filter("term2 is null").withColumn("off", F.lit(0)).withColumn("pos2", F.col("pos"))
    return two.unionByName(one)


def phrase_matches(index: DataFrame, terms: DataFrame, window: int = 10) -> DataFrame:
    """row, item, item_id, start, end: word positions (from 1, end exclusive) of maximal
    runs that an item and a text share, of at least a window."""
    anchor = anchors(index, terms, window)
    where = materialize(_near(index, anchor, 0).select(
        "row", "item", "item_id", "w", "diagonal", F.explode(F.sequence(
            F.col("first"), F.col("last") + F.col("w") - 1)).alias("place")).distinct(), "sought")
    rows = materialize(where.select("row").distinct(), "rows")
    within = index.join(checked(rows), "row", "left_semi").select("row", "term", "pos")
    wanted = checked_join(where, terms.select("item", "place", "term"), ["item", "place"],
                          ["row", "diagonal"]).withColumn("pos", F.col("diagonal") + F.col("place"))
    met = wanted.join(within, ["row", "term", "pos"])
    line = ["row", "item", "item_id", "w", "diagonal"]
    run = F.col("place") - F.row_number().over(Window.partitionBy(line).orderBy("place"))
    return (met.withColumn("run", run).groupBy(*line, "run")
            .agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"))
            .filter(F.col("end") - F.col("start") >= F.col("w"))
            .select("row", "item", "item_id", "start", "end"))


def proximity_matches(index: DataFrame, terms: DataFrame, slop: int = 5,
                      window: int = 10) -> DataFrame:
    """row, item, item_id, pos1, pos2, off: the two rarest terms of a window that texts hold, the
    second up to ``slop`` words from where the phrase has it (off 0: exactly there)."""
    near = _near(index, anchors(index, terms, window, whole=False), slop)
    return near.filter(F.col("term2").isNull() | (F.col("pos") != F.col("pos2"))).select(
        "row", "item", "item_id", F.col("pos").alias("pos1"), "pos2", "off").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 10,
                  id_col: str = "doc_id", text_col: str = "text",
                  slop: int | None = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_hit, item_ids (sorted text), and
    near_ids, the items with a proximity match (not with ``slop`` None)."""
    vocabulary, terms = benchmark_terms(items)
    index = postings(docs, vocabulary, id_col, text_col)
    hits = phrase_matches(index, terms, window).select(
        "row", "item_id", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("pos"))
    by_text = (hits.groupBy("row", "pos").agg(F.collect_set(F.col("item_id").cast("string"))
                                              .alias("ids"))
               .groupBy("row").agg(F.count("*").alias("n_hit"), F.array_sort(F.array_distinct(
                   F.flatten(F.collect_set("ids")))).alias("item_ids")))
    texts = index.filter(F.col("term") == MARK).select("row", "doc_id", "text_key", "n_words")
    found, lists = texts.join(by_text, "row", "left"), ["item_ids"]
    if slop is not None:
        near = (proximity_matches(index, terms, slop, window).groupBy("row").agg(F.array_sort(
            F.collect_set(F.col("item_id").cast("string"))).alias("near_ids")))
        found, lists = found.join(near, "row", "left"), ["item_ids", "near_ids"]
    return found.select(
        F.col("doc_id").alias(id_col), "text_key", F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        *(F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in lists))


def contamination_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        F.col(id_col), "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.size("near_ids").cast("bigint").alias("n_near"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of an item; columns as they were."""
    bad = materialize(contamination(docs, items, window, id_col, text_col, slop=None).filter("n_hit > 0")
                      .select(F.col(id_col).alias("__id"), "text_key").distinct(), "contaminated")
    return docs.join(checked(bad), docs[id_col].eqNullSafe(bad["__id"])
                     & (text_hash(docs[text_col]) == bad["text_key"]), "left_anti")
