"""Language identification, words first, with back-off to character n-grams.

A word that training has seen is scored by its log frequency in each language.
An unseen word falls back to its character n-grams (with word boundaries),
the longest order of which any is known, then shorter ones down to single
letters. A text's language has the highest mean over its words; its score is
the softmax of those means at ``sharpness``.

Learning takes, for each language, a bounded sample of its documents (about
``per_language``, by a hash of id and text, repeatable); counts are summed on
executors, and the table that reaches the driver and is broadcast holds every word and n-gram
of the sample, whose size bounds it.

Defined results: ``und`` with score 0 for a NULL text, one without letters, or
when nothing could be learned; ties go to the language first in order; NULL
languages are not learned from; repeated rows are predicted alike; a NULL id
is not held out and not learned from.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from contrail.llm.common import by_value, cells, checked_join, held_out, learnable
from contrail.session import materialize

WORD = re.compile(r"[^\W\d_]+")
ORDERS = (4, 3, 2, 1)
PER_LANGUAGE = 1_500
CACHE = 200_000
COUNTS = "lang string, size int, token string, n bigint"


@dataclass
class Backoff:
    """languages; tokens[size][token] is a row of table[size] (size 0: words)."""

    languages: list
    tokens: dict
    table: dict


def grams(word: str, size: int) -> list[str]:
    edged = f"<{word}>" if size > 1 else word
    return [edged[i:i + size] for i in range(len(edged) - size + 1)]


def _count_batches(batches):
    import pyarrow as pa

    for batch in batches:
        seen: dict = {}
        for lang, raw in zip(batch.column(0).to_pylist(), cells(batch.column(1)), strict=True):
            words = WORD.findall(raw.decode("utf-8", "replace").lower()) if raw else ()
            seen.setdefault(lang, Counter()).update(words)
        for lang, words in seen.items():
            tables = {0: words, **{size: Counter() for size in ORDERS}}
            for word, n in words.items():
                for size in ORDERS:
                    for g in grams(word, size):
                        tables[size][g] += n
            for size, counts in tables.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()),
                     pa.array([size] * len(counts), pa.int32()),
                     pa.array(list(counts), pa.string()),
                     pa.array(list(counts.values()), pa.int64())],
                    names=["lang", "size", "token", "n"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Backoff:
    import numpy as np

    rows = docs.filter(learnable(F.col(id_col)) & F.col(lang_col).isNotNull())
    # Languages are joined, not listed: a table may name any number of them.
    rows = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                       F.col(text_col).alias("text"))
    sizes = materialize(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    part = F.xxhash64(F.lit(7), "id", "text").bitwiseAND(F.lit((1 << 63) - 1)) / float(1 << 63)
    picked = checked_join(rows, sizes, ["lang"], ["id"]).filter(
        (F.col("n") <= per_language) | (part < F.lit(float(per_language)) / F.col("n")))
    kept = (picked.select("lang", "text").mapInArrow(_count_batches, COUNTS)
            .groupBy("lang", "size", "token").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(set(kept["lang"].to_pylist()))
    tokens, table = {}, {}
    lang_no = {x: i for i, x in enumerate(languages)}
    sizes_, names, ns = (kept[c].to_pylist() for c in ("size", "token", "n"))
    langs = [lang_no[x] for x in kept["lang"].to_pylist()]
    for size in (0, *ORDERS):
        rows_ = [i for i, s in enumerate(sizes_) if s == size]
        index = {t: i for i, t in enumerate(sorted({names[i] for i in rows_}))}
        found = np.zeros((len(index), max(1, len(languages))))
        for i in rows_:
            found[index[names[i]], langs[i]] = ns[i]
        smooth = 0.1
        found = np.log((found + smooth) / (found.sum(axis=0) + smooth * (len(index) + 1)))
        tokens[size], table[size] = index, found.astype(np.float32)
    return Backoff(languages, tokens, table)


def backoff_row(model: Backoff, word: str):
    """An unseen word's score in each language: the mean over the known n-grams
    of the longest order that has any; None if not even a letter is known."""
    for size in ORDERS:
        known = [r for g in grams(word, size) if (r := model.tokens[size].get(g)) is not None]
        if known:
            return model.table[size][known].mean(axis=0)
    return None


def predict_udf(spark: SparkSession, model: Backoff, sharpness: float = 4.0):
    """text -> (lang, score)."""
    shared = spark.sparkContext.broadcast(model)

    def batch(texts):
        import numpy as np
        import pyarrow as pa

        m = shared.value
        lookup = m.tokens[0].get
        rest: dict = {}
        langs, scores = [], []
        for raw in cells(texts):
            words = WORD.findall(raw.decode("utf-8", "replace").lower()) if raw else ()
            if not m.languages or not any(c.isalpha() for w in words for c in w):
                langs.append("und")
                scores.append(0.0)
                continue
            rows = list(map(lookup, words))
            known = [r for r in rows if r is not None]
            total = m.table[0][known].sum(axis=0, dtype=np.float64)
            n = len(known)
            if n < len(words):
                if len(rest) > CACHE:
                    rest.clear()
                for word, row in zip(words, rows, strict=True):
                    if row is None:
                        if word not in rest:
                            rest[word] = backoff_row(m, word)
                        if (got := rest[word]) is not None:
                            total += got
                            n += 1
            mean = total / max(n, 1)
            share = np.exp(sharpness * (mean - mean.max()))
            best = int(mean.argmax())
            langs.append(m.languages[best])
            scores.append(float(share[best] / share.sum()))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()),
                                           pa.array(scores, pa.float64())], ["lang", "score"])

    return arrow_udf(batch, "lang string, score double")


def predict_language(docs: DataFrame, model: Backoff, text_col: str = "text",
                     out_col: str = "prediction") -> DataFrame:
    """``docs`` with a struct column (lang, score)."""
    return docs.withColumn(out_col, predict_udf(docs.sparkSession, model)(F.col(text_col)))


def language_report(docs: DataFrame, **learning) -> DataFrame:
    model = learn(docs, **learning)
    return predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.col("prediction.lang").alias("lang_pred"), F.col("prediction.score").alias("score"))


by_value(__name__)
