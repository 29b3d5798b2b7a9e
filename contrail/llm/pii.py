"""Personal data by patterns, extended by bootstrapped contextual extraction.

Base kinds come from patterns (``email``, ``ip``, ``card``, ``phone``). Their
matches are the seeds of a bipartite graph: a *pattern* is the last two words
before a span, however much white space stands there, an *instance* the span's
characters without separators. Every candidate of identifier shape, seed or not, gives an
edge. Rounds of scoring follow: a pattern's confidence in a kind is the sum of its
instances' scores over their number plus one, and counts only with ``min_seeds`` distinct
seeds; an instance that is no seed gets the noisy-or of its patterns' confidences. Instances
that reach ``threshold`` are seeds of the following rounds (with score 1), which go on until
no pattern and no instance is added. Candidates whose pattern and instance both reach
``threshold`` become spans of kind ``ctx_<kind>``, unless a base span overlaps them.

All of it is DataFrame and SQL functions. A text is read once: each pattern splits it at
its matches, and what is kept of the pieces between is their length and last two words. A
running sum of the lengths, a window over a text's matches, gives the places, so the time
grows with the matches. The graph is grouped with partial sums and joined with salts, so a
context or a number that a third of the rows hold goes to many tasks.

Defined results: a NULL or empty text has no spans; repeated rows each have
their own; a NULL id is kept; extra columns are ignored; an empty table gives
an empty result. Patterns cannot backtrack over long runs (possessive
quantifiers), so very long texts and words cost time in proportion. Scores only grow from
round to round and each round but the last adds something, so the rounds end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import checked_join, digest_of_spans
from contrail.session import materialize

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, *(f"ctx_{k}" for k in BASE_KINDS))

# A run of the class begins where no character of it stands before, or where the
# match before ended (\G): elsewhere in a run, no match can begin.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = dict(zip(BASE_KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
# Identifier shapes: a local part and host, seven or more digits with separators, letters
# followed by five or more characters with a digit first.
CANDIDATE = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
             r"|\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"
             r"|(?<![A-Za-z0-9_-])[A-Za-z_]{0,8}[0-9][A-Za-z0-9_-]{5,}+")
#: The last two words of a piece of text; words are runs without white space.
LAST_WORDS = r"(?<!\S)(?:\S++\s++)?\S++\s*+$"
TAIL = 200
#: The number of candidates that are no base kind.
FREE = len(BASE_KINDS)


def _pieces(found: Column, between: Column, no: int) -> Column:
    """array<struct<no, at, gap, size, value, tail, last>> of the matches of a pattern and what stands
    between them: how many code points since the match before it, their end (as a rule the last
    two words are in it, else all of them), and the match before."""

    def match(x: Column, i: Column) -> Column:
        gap, tail = x["gap"], F.right(x["gap"], F.lit(TAIL))
        whole = F.rlike(tail, F.lit(r"\s\S++\s++\S++\s*+$"))
        return F.struct(F.lit(no).alias("no"), i.alias("at"), F.char_length(gap).alias("gap"),
                        F.char_length(x["value"]).alias("size"), x["value"].alias("value"),
                        F.when(whole, tail).otherwise(gap).alias("tail"), x["last"].alias("last"))

    n = F.size(found)
    last = F.slice(F.concat(F.array(F.lit("")), found), F.lit(1), n)
    return F.transform(F.arrays_zip(F.slice(between, F.lit(1), n).alias("gap"),
                                    found.alias("value"), last.alias("last")), match)


def _before() -> Column:
    """The last two words before a match, with the match before it where the piece has but one."""
    words = F.regexp_extract("tail", LAST_WORDS, 0)
    two = F.rlike(words, F.lit(r"\S\s++\S"))
    return F.when(two | (F.col("at") == 0), words).otherwise(
        F.concat(F.regexp_extract("last", r"(?<!\S)\S++$", 0), F.col("tail")))


def _valid() -> Column:
    """Whether a match of ``no`` is one: candidates always are."""
    value, no = F.col("value"), F.col("no")
    digits = F.regexp_replace(value, r"[^0-9]", "")
    n = F.char_length(digits)
    ip = F.forall(F.split(value, r"\."),
                  lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    return (F.when(no == BASE_KINDS.index("ip"), ip)
            .when(no == BASE_KINDS.index("card"),
                  n.between(12, 19) & F.call_function("luhn_check", digits))
            .when(no == BASE_KINDS.index("phone"), n.between(9, 15)).otherwise(True))


def read_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
               ) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id; row, start, end, no, seed, p, i, bare), both staged: the rows, and their base
    spans (seed = no) and the candidates that no base span overlaps (seed NULL)."""
    patterns = [*PATTERNS.values(), CANDIDATE]
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Projections of their own: each pattern runs over a text once, and again to split it only
    # where it was found.
    none = F.array().cast("array<string>")
    found = texts.select("*", *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"found{no}")
                                for no, p in enumerate(patterns)))
    parts = found.select("row", "doc_id", *(f"found{no}" for no in range(len(patterns))), *(
        F.when(F.size(f"found{no}") > 0, F.split("text", p, -1)).otherwise(none).alias(
            f"between{no}") for no, p in enumerate(patterns)))
    read = materialize(parts.select("row", "doc_id", F.concat(*(
        _pieces(F.col(f"found{no}"), F.col(f"between{no}"), no)
        for no in range(len(patterns)))).alias("m")), "pii")
    along = Window.partitionBy("row", "no").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(along)
    placed = read.select("row", F.inline("m")).withColumn("end", end.cast("int")).withColumn(
        "start", F.col("end") - F.col("size")).filter(_valid())
    # A candidate is free where the base spans that begin before its end also end before it begins.
    free, text = F.col("no") == FREE, Window.partitionBy("row").orderBy("start", "no")
    reach = F.max(F.when(~free, F.col("end"))).over(text.rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    behind = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("no"))
    following = F.min(F.when(~free, F.col("start"))).over(behind.rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    spans = placed.withColumns({"reach": reach, "following": following}).filter(
        ~free | ((F.coalesce("reach", F.lit(0)) <= F.col("start"))
                 & (F.coalesce("following", F.col("end")) >= F.col("end"))))
    lexical = F.trim(F.regexp_replace(F.regexp_replace(F.lower(_before()), r"[0-9]+", "0"),
                                      r"\s+", " "))
    instance = F.regexp_replace(F.lower("value"), r"[\x20()+-]", "")
    edges = spans.select(
        "row", "start", "end", "no", F.when(~free, F.col("no")).alias("seed"),
        F.xxhash64(lexical).alias("p"), F.xxhash64(instance).alias("i"),
        (lexical == "").alias("bare"))
    return read.select("row", "doc_id"), materialize(edges, "pii-edges")


def score_graph(edges: DataFrame, min_seeds: int = 3, threshold: float = 0.6,
                rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """edges: p, i, seed (kind number or NULL). Returns the patterns' confidences and the
    instances' scores: p or i, and c0 ... one column a kind. ``rounds`` limits the rounds (for
    tests); without it they go on until nothing is added."""
    n = len(BASE_KINDS)
    kinds = [f"c{k}" for k in range(n)]
    graph = materialize(edges.groupBy("p", "i").agg(F.max("seed").alias("seed")), "graph")
    scores = materialize(graph.groupBy("i").agg(F.max("seed").alias("seed")).select(
        "i", "seed", *(F.coalesce((F.col("seed") == k).cast("double"), F.lit(0.0)).alias(f"c{k}")
                       for k in range(n))), "instances")
    pairs, reached, last, done = graph.select("p", "i"), F.greatest(*kinds) >= threshold, None, 0
    while rounds is None or done < rounds:
        sure = lambda k: F.col(f"c{k}") >= threshold
        met = checked_join(pairs, scores, ["i"], ["p"])
        patterns = materialize(met.groupBy("p").agg(
            F.count("*").alias("n"), *(F.count_if(sure(k)).alias(f"n{k}") for k in range(n)),
            *(F.sum(F.when(sure(k), 1.0).otherwise(F.col(c))).alias(f"s{k}")
              for k, c in enumerate(kinds))).select(
            "p", *(F.when(F.col(f"n{k}") >= min_seeds, F.col(f"s{k}") / (F.col("n") + 1))
                   .otherwise(0.0).alias(f"c{k}") for k in range(n))), "patterns")
        useful = reduce(lambda a, b: a | b, (F.col(c) > 0 for c in kinds))
        met = checked_join(pairs, patterns.filter(useful), ["p"], ["i"])
        now = met.groupBy("i").agg(*(
            (1 - F.exp(F.sum(F.log(1 - F.least(F.col(c), F.lit(0.999)))))).alias(f"r{k}")
            for k, c in enumerate(kinds)))
        # A score never falls, so a round's additions stay.
        scores = materialize(scores.join(now, "i", "left").select("i", "seed", *(
            F.when(F.col("seed").isNotNull(), F.col(c))
            .otherwise(F.greatest(c, F.coalesce(f"r{k}", F.lit(0.0)))).alias(c)
            for k, c in enumerate(kinds))), "instances")
        done += 1
        added = (patterns.filter(reached).count(), scores.filter(reached).count())
        if added == last:
            break
        last = added
    return patterns, scores


def _sure(df: DataFrame, key: str, out: str, threshold: float) -> DataFrame:
    """``key`` and the kind number of its highest column, where that reaches ``threshold``."""
    best = F.greatest(*(F.col(f"c{k}") for k in range(len(BASE_KINDS))))
    kind = reduce(lambda w, k: w.when(F.col(f"c{k}") == best, k), range(1, len(BASE_KINDS)),
                  F.when(F.col("c0") == best, 0))
    return df.filter(best >= threshold).select(key, kind.alias(out))


def context_spans(edges: DataFrame, min_seeds: int = 3, threshold: float = 0.6) -> DataFrame:
    """The edges without a seed whose pattern and instance are both sure of one kind, with it."""
    graph = edges.filter(~F.col("bare"))
    patterns, scores = score_graph(graph, min_seeds, threshold)
    free = graph.filter("seed is null")
    free = checked_join(free, _sure(patterns, "p", "kind", threshold), ["p"], ["row"])
    free = checked_join(free, _sure(scores, "i", "kind_i", threshold), ["i"], ["row"])
    return free.filter("kind = kind_i").drop("kind_i")


def masked_recall(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  one_in: int = 5, **scoring) -> DataFrame:
    """How well contexts rediscover known identifiers: instances of one in ``one_in`` hashes lose
    their seeds. ``(kind, n_masked, n_found, n_right)``: masked spans with a context, those that
    come back, and those of the right kind."""
    _, edges = read_spans(docs, id_col, text_col)
    hidden = F.col("seed").isNotNull() & (F.pmod(F.xxhash64("i", F.lit(3)), F.lit(one_in)) == 0)
    edges = materialize(edges.withColumn("truth", F.when(hidden, F.col("seed"))).withColumn(
        "seed", F.when(~hidden, F.col("seed"))), "pii-masked")
    found = context_spans(edges, **scoring).filter("truth is not null").select(
        "row", "start", "no", "kind")
    masked = edges.filter("truth is not null and not bare").join(found, ["row", "start", "no"], "left")
    names = F.array(*(F.lit(k) for k in BASE_KINDS))
    return masked.groupBy(F.get(names, F.col("truth")).alias("kind")).agg(
        F.count("*").alias("n_masked"), F.count("kind").alias("n_found"),
        F.count_if(F.col("kind") == F.col("truth")).alias("n_right"))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_seeds: int = 3, threshold: float = 0.6) -> DataFrame:
    """One row per row of ``docs``: id and ``spans``, an array of (start, no, end, kind),
    by start, then kind as in ``KINDS``."""
    rows, edges = read_spans(docs, id_col, text_col)
    names = F.array(*(F.lit(k) for k in KINDS))
    no = F.col("kind") + len(BASE_KINDS)
    found = context_spans(edges, min_seeds, threshold).select("row", "start", no.alias("no"), "end")
    spans = edges.filter("seed is not null").select("row", "start", "no", "end").unionByName(found)
    listed = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", "no", "end", F.get(names, F.col("no")).alias("kind")))).alias("spans"))
    empty = F.array().cast("array<struct<start:int,no:int,end:int,kind:string>>")
    return rows.join(listed, "row", "left").select(
        F.col("doc_id").alias(id_col), F.coalesce("spans", empty).alias("spans"))


def personal_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and hashes of the spans, as the op6 query returns them."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter(
        "spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col(id_col), *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(digest_of_spans(base), 256).alias("base_sha256"),
        digest_of_spans(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"].startswith("ctx_"))).cast("bigint")
        .alias("n_context"))
