"""The corpus pipeline: five stages over ``documents``.

Toxic documents go, repeated lines go, one document of each SimHash group stays,
documents with benchmark windows go, and the rest is mixed to source weights.
Each stage works on all that the one before kept and returns the columns of
documents; the last adds where each document stands in the mixture.

Defined results, stage by stage, for ``documents`` with NULLs, repeats or no rows:

* toxicity: a NULL or empty text scores what a text without known words scores; a NULL id is kept
  or dropped by its text like any other; NULL labels and labels of absent ids count for nothing;
  without labels of both kinds the score is the share of toxic labels.
* line dedup: a NULL text stays NULL; a repeated row counts once a row; a text may become empty.
* near-duplicates: rows without a word are one group; of a group the smallest id stays (NULL last,
  then the smallest hash of the text, then of the row); fully repeated rows leave one.
* decontamination: NULL and empty texts stay; without a benchmark all rows stay.
* mixing: NULL is a source; rows without words are shown in whole epochs; repeated rows enter the
  last epoch together.

Columns that the stages do not know are carried along, whatever their names; only ``mix_epoch``,
``mix_block`` and ``mix_order`` are overwritten by the last stage. Empty tables give empty results.

``run`` removes what a stage staged once the next one has been written, so that not more than two
copies of the corpus lie in the shared folder; what the last stage reads stays for the caller
(``staged_paths``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import decontaminate, linededup, mixing, simhash, toxicity
from contrail.llm.common import table
from contrail.session import materialize_at, remove_staged, staged_paths


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines),
          ("near-duplicates", drop_near_copies), ("decontamination", drop_contaminated),
          ("mixing", mix)]

#: A fitted model and 64-bit text hashes decide on rows: SQL cannot state them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with staged_paths() as paths:
            docs, path = materialize_at(stage(spark, docs, sf_dir),
                                        f"stage-{name.replace(' ', '-')}")
        remove_staged(spark, *last, *(p for p in paths if p != path))
        last = [path]
    return STAGES[-1][1](spark, docs, sf_dir)
