"""The registered queries of the training-text operators.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds
the DuckDB text of those that SQL can express on whole tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from quarry.llm import (ball_search, bpe_codec, chat, decontaminate, jaccard_join, langid, merkle, personal_data, quality_rank,
                        quality_rules, substring, token_count, token_store)
from quarry.llm.common import fresh_path, table

QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_token_counts(spark, d):
    return token_count.token_counts(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op2_jaccard_join(spark, d):
    return jaccard_join.near_duplicates(table(spark, d, "documents"), width=4, percent=85)


SQL["op2_jaccard_join"] = jaccard_join.REPORT_SQL


@query
def op3_substring_dedup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).withColumn("n_removed", F.size("removed"))


@query
def op4_language_id(spark, d):
    return langid.detect_language(table(spark, d, "documents"))


@query
def op5_quality_rules(spark, d):
    return quality_rules.rule_report(table(spark, d, "documents"))


SQL["op5_quality_rules"] = quality_rules.REPORT_SQL


@query
def op6_quality_rank(spark, d):
    return quality_rank.quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op7_chat_format(spark, d):
    return chat.repair_chats(table(spark, d, "conversations"))


@query
def op8_decontamination(spark, d):
    return decontaminate.find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op9_byte_bpe(spark, d):
    return bpe_codec.encoded_digests(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                     public_tokenizers.PATTERN)


@query
def op10_token_store(spark, d):
    path = fresh_path(spark, "token-store")
    token_store.write_token_store(table(spark, d, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 1)
    return token_store.read_token_store(spark, path, tokens=False).withColumnRenamed("id", "doc_id")


@query
def op11_personal_data(spark, d):
    return personal_data.report(personal_data.find_personal_data(table(spark, d, "documents")))


@query
def op12_merkle_manifest(spark, d):
    return merkle.tamper_report(table(spark, d, "documents"))


SQL["op12_merkle_manifest"] = merkle.REPORT_SQL


@query
def op13_ranked_search(spark, d):
    return ball_search.ranked_search(table(spark, d, "documents"), table(spark, d, "benchmark"))


SQL["op13_ranked_search"] = ball_search.REPORT_SQL
