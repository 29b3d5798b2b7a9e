"""The registered queries of the numbered operators, and their SQL where SQL can say it."""

from __future__ import annotations

from contrail.llm import (
    convrepair,
    decontaminate,
    kdshard,
    langid,
    linededup,
    mixing,
    pii,
    secrets,
    simhash,
    tokenalign,
    topk,
    toxicity,
    warc,
)
from contrail.llm.common import table
from contrail.llm.oracle import ORACLES as ORACLES
from pyspark.sql import functions as F


def op1_secret_scan(spark, sf_dir):
    return secrets.secret_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op2_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op3_simhash_dedup(spark, sf_dir):
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         "component_id")


def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"))


def op5_language_id(spark, sf_dir):
    return langid.language_report(table(spark, sf_dir, "documents"))


def op6_personal_data(spark, sf_dir):
    return pii.personal_digest(pii.find_personal(table(spark, sf_dir, "documents")))


def op7_decontamination(spark, sf_dir):
    return decontaminate.contamination_digest(decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op8_source_mixing(spark, sf_dir):
    return mixing.mixing_report(table(spark, sf_dir, "documents"))


def op9_warc_round_trip(spark, sf_dir):
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark, sf_dir):
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark, sf_dir):
    return convrepair.repair_report(convrepair.damage(table(spark, sf_dir, "conversations")))


def op12_kd_sharding(spark, sf_dir):
    return kdshard.shard_report(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark, sf_dir):
    return tokenalign.alignment_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_exact_topk, op3_simhash_dedup, op4_toxicity, op5_language_id,
    op6_personal_data, op7_decontamination, op8_source_mixing, op9_warc_round_trip,
    op10_line_dedup, op11_conversation_repair, op12_kd_sharding, op13_tokenizer_alignment)}
