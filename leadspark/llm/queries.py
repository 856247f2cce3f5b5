"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from leadspark.llm import (
    ann,
    chat,
    html_text,
    line_dedup,
    mixing,
    packing,
    pii,
    quality_rules,
    repair,
    simhash,
    spelling,
    token_counts,
    toxicity,
)
from leadspark.llm.shared import table

# Workers get these functions by value: the package need not be installed there.
for module in (ann, html_text, packing, repair, simhash, spelling, token_counts, toxicity):
    cloudpickle.register_pickle_by_value(module)

RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    base = F.sha2(pii.listed("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii.listed("spans").alias("spans"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_counts(table(spark, sf_dir, "documents"), PIECES)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = html_text.with_text(pages, html_text.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), RANKS)
    cut = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(cut)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_labels(docs, labels)
    found = toxicity.with_severity(docs.select("doc_id", "text"), model)
    return found.select("doc_id", "severity", (F.col("severity") >= toxicity.REJECT).alias("toxic"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "rule", "kept")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


#: A conversation of control strings that op11 adds to those of the table.
PLANTED = [(-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    made = chat.formatted(rows.unionByName(planted))
    made = made.withColumn("turns", chat.turns_of(F.col("text")))
    made = made.withColumn("trained", chat.trained_text(F.col("segments")))
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
        "valid",
        "fault",
    )


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.reported(conversations, repair.damaged(conversations))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_pii": op2_pii,
    "op3_token_counts": op3_token_counts,
    "op4_html_text": op4_html_text,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_ann": op9_ann,
    "op10_mixing": op10_mixing,
    "op11_chat": op11_chat,
    "op12_repair": op12_repair,
    "op13_spelling": op13_spelling,
    "pipeline": corpus_pipeline.run,
}

#: The sizes, the hash and the distribution of op10, stated anew.
MIXING_SQL = f"""
WITH sizes AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {mixing.POWER}) AS weight
               FROM documents GROUP BY source),
rates AS (SELECT source, weight / sum(weight) OVER () * sum(n) OVER () * {mixing.SHARE} / n AS rate FROM sizes),
counts AS (SELECT source, rate, unnest(range(0, ceil(rate + 10 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM rates),
upto AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1)))
                OVER (PARTITION BY source ORDER BY k) AS p FROM counts),
drawn AS (SELECT *, ('0x' || substr(md5('{mixing.SEED}:' || doc_id || ':' || coalesce(md5(text), '')), 1, 13))::BIGINT
                 / 4503599627370496.0 AS u FROM documents),
copied AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(p.k)::INTEGER AS copies
           FROM drawn d JOIN upto p ON p.source IS NOT DISTINCT FROM d.source AND p.p <= d.u
           GROUP BY ALL),
each AS (SELECT *, unnest(range(0, copies))::INTEGER AS copy_no FROM copied)
SELECT *, md5('{mixing.SEED}:' || doc_id || ':' || md5(text) || ':' || copy_no) AS shuffle_key FROM each
"""

ORACLES = {"op10_mixing": MIXING_SQL}
