"""Toxicity by a factorization machine over hashed terms.

A text's terms are the hash buckets of its distinct words and their beginnings. The machine scores
bias + the terms' weights + the inner products of the factor vectors of all
pairs of terms, in time linear in the terms, so that a pair (an insult with a
mention of a group) can count for more than its two words alone.

The model is fitted on a bounded sample of labelled rows (``max_train_rows``,
by a hash of the id, so it is repeatable), which reaches the driver as bucket
numbers. Only buckets whose labels differ from chance get parameters: those whose
share of toxic texts is further from the prior than chance explains (root of the
deviance above ``strict``), the partners of which the same holds beside one of them
after the linear fit, and both terms of any pair whose texts differ from the linear fit,
whether or not the terms matter by themselves (``strict`` is raised for the number of
pairs, so that chance passes as few pairs as single terms). All others stay at zero, so a long clean text
gathers no noise; copies and near copies in the sample vote once. Weights and factors
are then fitted together by full-batch Adam with L2.

What is broadcast holds one row a fitted bucket; none that passes is left out, and the
sample bounds their number. Every text is scored whole on executors.

Defined results: a NULL or empty text scores the bias alone; words are runs of
ASCII letters, digits and non-ASCII characters, A-Z lower-cased; repeated
documents score alike; a document labelled twice counts as toxic if either
label says so; NULL labels and ids are not learned from; without labels of
both classes, every score is the share of toxic labels (0 without any). Labels that no
single words explain leave very many pairs to search: beyond ``max_pair_entries`` the
fit ends with an error that gives the figures.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from contrail.llm.common import by_value, cells, checked, hash_below, held_out, learnable
from contrail.session import materialize

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BEGINNINGS = (4, 5, 6, 7)  # bytes
THRESHOLD = 0.3
MAX_TRAIN_ROWS = 8_000
CACHE = 500_000
#: Terms of texts that the search for pairs may look at before it gives up with an error.
MAX_PAIR_ENTRIES = 1_000_000_000


@dataclass
class Machine:
    """bias; rows: bucket -> row of weights (m) and factors (m x k), numpy arrays."""

    bits: int
    bias: float
    rows: dict
    weights: object
    factors: object


def words_of(raw: bytes | None) -> set[bytes]:
    return set(WORD.findall(raw.lower())) if raw else set()


def bucket(word: bytes, bits: int) -> int:
    from xxhash import xxh32_intdigest

    return xxh32_intdigest(word) & ((1 << bits) - 1)


def terms_of(word: bytes, bits: int) -> list[int]:
    """The buckets of a word and of its beginnings, which inflected forms share."""
    return [bucket(word, bits), *(bucket(word[:n] + b"*", bits) for n in BEGINNINGS
                                  if n < len(word))]


def bucket_udf(bits: int):
    def batch(texts):
        import pyarrow as pa

        return pa.array([sorted({b for w in words_of(raw) for b in terms_of(w, bits)})
                         for raw in cells(texts)],
                        type=pa.list_(pa.int32()))

    return arrow_udf(batch, "array<int>")


def logit(bias: float, weights, factors) -> float:
    """The score of one text, given its terms' weights and factors."""
    total = factors.sum(axis=0)
    return float(bias + weights.sum() + 0.5 * (total @ total - (factors ** 2).sum()))


def _adam(row, at, m: int, y, k: int, l2: float, rounds: int, rate: float, seed: int,
          bias: float):
    """(bias, weights, factors) of a machine over the m terms ``at`` of the texts ``row``, an
    entry a term and text; k = 0: linear."""
    import numpy as np

    n = len(y)
    by_text = lambda v: np.bincount(row, v[at], n)
    by_term = lambda v: np.bincount(at, v[row], m)
    each = lambda f, v: np.column_stack([f(v[:, j]) for j in range(k)])
    rng = np.random.default_rng(seed)
    params = np.concatenate([[bias], np.zeros(m), rng.normal(0, 0.05, m * k)])
    mean, spread = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, rounds + 1):
        w, v = params[1:m + 1], params[m + 1:].reshape(m, k)
        sums = each(by_text, v) if k else np.zeros((n, 0))
        z = params[0] + by_text(w - 0.5 * (v ** 2).sum(axis=1)) + 0.5 * (sums ** 2).sum(axis=1)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad_w = by_term(error)
        grad_v = each(by_term, error[:, None] * sums) if k else v
        grad = np.concatenate([[error.sum()], grad_w + l2 * w,
                               (grad_v - grad_w[:, None] * v + 4 * l2 * v).ravel()])
        mean, spread = 0.9 * mean + 0.1 * grad, 0.999 * spread + 0.001 * grad ** 2
        params -= rate * (mean / (1 - 0.9 ** t)) / (np.sqrt(spread / (1 - 0.999 ** t)) + 1e-9)
    return float(params[0]), params[1:m + 1], params[m + 1:].reshape(m, k)


def one_of_each(rows: list, labels, bands: int = 4, width: int = 6, seed: int = 5):
    """(rows, labels) with one of each set of near copies (equal in a band of min-hashes),
    labelled as most of them are. The sample is bounded, and so is this."""
    import numpy as np

    rng = np.random.default_rng(seed)
    odd = (rng.integers(1, 1 << 62, bands * width, dtype=np.uint64) << np.uint64(1)) + np.uint64(1)
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    first: dict = {}
    for i, r in enumerate(rows):
        least = ((np.asarray(r, dtype=np.uint64)[:, None] + np.uint64(1)) * odd).min(axis=0) \
            if len(r) else np.zeros(bands * width, dtype=np.uint64)
        for b in range(bands):
            key = (b, least[b * width:(b + 1) * width].tobytes())
            parent[root(i)] = root(first.setdefault(key, i))
    votes: dict = {}
    for i, y in enumerate(labels):
        votes.setdefault(root(i), []).append(y)
    kept = sorted(votes)
    return [rows[i] for i in kept], [float(np.mean(votes[i]) >= 0.5) for i in kept]


def _entries(at, starts, texts):
    """(terms, texts) of the entries of ``texts``; those of text i are at[starts[i]:starts[i + 1]]."""
    import numpy as np

    sizes = starts[texts + 1] - starts[texts]
    shift = starts[texts] - np.cumsum(sizes) + sizes
    return at[np.arange(sizes.sum()) + np.repeat(shift, sizes)], np.repeat(texts, sizes)


def fit(rows: list, labels, bits: int, k: int = 4, strict: float = 4.5, min_documents: int = 5,
        l2: float = 0.02, rounds: int = 300, rate: float = 0.05, seed: int = 11,
        max_pair_entries: int = MAX_PAIR_ENTRIES) -> Machine:
    import numpy as np

    y = np.asarray(labels, dtype=np.float64)
    prior = float(y.mean()) if len(y) else 0.0
    none = np.zeros(0), np.zeros((0, k))
    if not 0 < prior < 1:
        return Machine(bits, float("inf") if prior else float("-inf"), {}, *none)
    bias = float(np.log(prior / (1 - prior)))
    entries = np.concatenate([np.asarray(r, dtype=np.int32) for r in rows])
    terms, n = np.unique(entries, return_counts=True)
    terms = terms[n >= min_documents]
    if not len(terms):
        return Machine(bits, bias, {}, *none)
    at = np.searchsorted(terms, entries).astype(np.int32)
    at[at == len(terms)] = 0
    use = terms[at] == entries
    row = np.repeat(np.arange(len(rows), dtype=np.int32), list(map(len, rows)))[use]
    at = at[use]
    del entries, use

    starts = np.searchsorted(row, np.arange(len(rows) + 1))
    of_term = np.argsort(at, kind="stable")
    places = np.searchsorted(at[of_term], np.arange(len(terms) + 1))
    texts_of = lambda t: row[of_term[places[t]:places[t + 1]]]

    def unlike_chance(expected, among=None) -> object:
        """The root of the deviance of each term's toxic texts from ``expected``, over
        the texts ``among`` (or all): about the size of a standard normal where a term does
        not matter."""
        t, of = (at, row) if among is None else _entries(at, starts, among)
        n = np.bincount(t, minlength=len(terms))
        seen, due = (np.bincount(t, v[of], len(terms)) for v in (y, expected))
        with np.errstate(divide="ignore", invalid="ignore"):
            part = lambda o, d: np.where(o > 0, o * np.log(o / d), 0)
            z = np.sqrt(2 * np.maximum(part(seen, due) + part(n - seen, n - due), 0))
        return np.where(n >= min_documents, z, 0)

    def machine(kept, k: int):
        place = np.full(len(terms), -1)
        place[kept] = np.arange(len(kept))
        use = place[at] >= 0
        found = row[use].astype(np.intp), place[at[use]]
        return found, _adam(*found, len(kept), y, k, l2, rounds, rate, seed, bias)

    def in_pairs(expected) -> object:
        """The terms of pairs whose texts differ from ``expected`` by more than chance among so
        many pairs explains. Terms with the same texts count as one. A pair is first sought in
        its toxic (then its clean) texts alone, whose summed surprise its deviance cannot exceed."""
        marks = np.random.default_rng(seed).integers(0, 1 << 62, len(y), dtype=np.int64)
        same = np.add.reduceat(marks[row[of_term]], places[:-1])
        _, one, group = np.unique(same, return_index=True, return_inverse=True)
        found, looked = np.zeros(len(one), dtype=bool), 0
        for side, chance in ((y > 0, expected), (y == 0, 1 - expected)):
            cost = np.where(side, -np.log(chance), 0)
            most = 2 * np.bincount(at, cost[row], len(terms))[one]
            able = max(1.0, (np.count_nonzero(most > strict ** 2) - 1) / 2)
            bound = strict ** 2 + 2 * np.log(able)  # of all these pairs as few as of the terms
            sought = np.flatnonzero(most > bound)
            place = np.full(len(terms), -1)
            place[one[sought]] = np.arange(len(sought))
            use = (place[at] >= 0) & side[row]
            near, near_row = place[at[use]], row[use]
            begin = np.searchsorted(near_row, np.arange(len(rows) + 1))
            for a, g in enumerate(sought):
                texts = texts_of(one[g])
                b, of = _entries(near, begin, texts[side[texts]])
                looked += len(b)
                if looked > max_pair_entries:
                    raise ValueError(
                        f"the labels are not explained by single words: {len(sought)} terms could "
                        f"matter in pairs, and {a} of them took {looked} entries of texts; learn "
                        "from fewer rows or raise max_pair_entries")
                mates = np.flatnonzero(2 * np.bincount(b, cost[of], len(sought)) > bound)
                mates = sought[mates[mates > a]]
                if len(mates):
                    mates = mates[unlike_chance(expected, texts)[one[mates]] > bound ** 0.5]
                    found[mates] = True
                    found[g] |= len(mates) > 0
        return found[group]

    own = np.flatnonzero(unlike_chance(np.full(len(y), prior)) > strict)
    (texts, t), (b0, w0, _) = machine(own, 0)
    z0 = b0 + np.bincount(texts, w0[t], len(y))
    expected = 1 / (1 + np.exp(-np.clip(z0, -30, 30)))
    beside = np.zeros(len(terms), dtype=bool)
    for j in own:
        beside |= unlike_chance(expected, texts_of(j)) > strict
    beside[own] = True
    kept = np.flatnonzero(beside | in_pairs(expected))
    if not len(kept):
        return Machine(bits, bias, {}, *none)
    fitted = machine(kept, k)[1]
    return Machine(bits, fitted[0], {int(t): i for i, t in enumerate(terms[kept])}, *fitted[1:])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", bits: int = 30, max_train_rows: int = MAX_TRAIN_ROWS,
          **fitting) -> Machine:
    """Fit on the labelled, not held-out rows of ``docs``, at most about
    ``max_train_rows`` of them."""
    import numpy as np

    known = (labels.filter(F.col(label_col).isNotNull() & learnable(F.col(id_col)))
             .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col)).alias("__y")))
    # Labels of ids that docs lacks take no places of the sample.
    there = docs.select(docs[id_col].alias("__id")).distinct()
    known = materialize(known.join(there, "__id", "left_semi"), "labelled")
    sample = materialize(known.filter(hash_below(max_train_rows, known.count(), F.col("__id"))),
                         "sample")
    # The sample is bounded and counted, so no text is shuffled to meet it. An id that many documents
    # share must not bring them all: beyond twice the bound they are drawn as well.
    met = docs.join(checked(sample), docs[id_col] == sample["__id"])
    n = met.select("__id").count()
    rows = (met.filter(hash_below(2 * max_train_rows, n, docs[id_col], docs[text_col]))
            .select("__id", "__y", bucket_udf(bits)(docs[text_col]).alias("b"))
            .groupBy("__id", "__y", "b").count().orderBy("__id", "b")
            .select("b", F.col("__y").cast("double").alias("y")).toArrow())
    lists = rows["b"].combine_chunks()
    found = np.split(lists.flatten().to_numpy(), lists.offsets.to_numpy()[1:-1])[:len(lists)]
    return fit(*one_of_each(found, rows["y"].to_pylist()), bits, **fitting)


def score_udf(spark: SparkSession, machine: Machine):
    """text -> probability; the machine (one row a fitted bucket) is broadcast."""
    shared = spark.sparkContext.broadcast(machine)

    def batch(texts):
        import numpy as np
        import pyarrow as pa

        model, known, z = shared.value, {}, []
        for raw in cells(texts):
            if len(known) > CACHE:
                known.clear()
            met = set()
            for word in words_of(raw):
                hit = known.get(word)
                if hit is None:
                    hit = known[word] = [model.rows[b] for b in terms_of(word, model.bits)
                                         if b in model.rows]
                met.update(hit)
            got = sorted(met)
            z.append(logit(model.bias, model.weights[got], model.factors[got]) if got
                     else model.bias)
        with np.errstate(over="ignore"):
            return pa.array(1 / (1 + np.exp(-np.asarray(z, dtype=float))), type=pa.float64())

    return arrow_udf(batch, "double")


def score_toxicity(docs: DataFrame, machine: Machine, text_col: str = "text",
                   score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col``."""
    return docs.withColumn(score_col, score_udf(docs.sparkSession, machine)(F.col(text_col)))


def toxicity_report(docs: DataFrame, labels: DataFrame, **training) -> DataFrame:
    machine = train(docs, labels, **training)
    return score_toxicity(docs.select("doc_id", "text"), machine).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                 **training) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns as they were."""
    score = score_udf(docs.sparkSession, train(docs, labels, **training))
    return docs.filter(score(F.col("text")) < threshold)


by_value(__name__)
