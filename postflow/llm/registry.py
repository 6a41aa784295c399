"""The operators' queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from postflow.llm import (
    bpe, chat, conversation_repair, exact_dedup, html_text, merkle, packing, quality_model,
    quality_rules, shards, simhash, substring_dedup, url_rules)
from postflow.llm.common import table
from postflow.session import new_folder


def op1_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op2_best_two_fit(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


def op4_bpe(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode_texts(table(spark, sf, "documents"), path)
    return bpe.digests(bpe.decode_ids(encoded, path))


def op5_url_rules(spark, sf):
    return url_rules.url_filter(table(spark, sf, "pages"), table(spark, sf, "labels"))


def op6_quality_model(spark, sf):
    docs = table(spark, sf, "documents")
    return quality_model.quality_scores(
        docs, quality_model.trained(docs, table(spark, sf, "labels")))


def op7_chat(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_chats(rows.unionByName(chat.probe_turns(rows))))


def op8_quality_rules(spark, sf):
    return quality_rules.quality_rules(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op9_html_text(spark, sf):
    pages = table(spark, sf, "pages")
    model = html_text.fitted(html_text.sample(pages, table(spark, sf, "documents")))
    return html_text.extracted(pages, model)


def op10_shards(spark, sf):
    return shards.materialise(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        new_folder(spark, "shards"), stored=True)


def op11_conversation_repair(spark, sf):
    rows = table(spark, sf, "conversations")
    return conversation_repair.repair_report(conversation_repair.damaged(rows))


def op12_merkle(spark, sf):
    return merkle.manifest(table(spark, sf, "documents"), merkle.contract_tampering())


def op13_substring_dedup(spark, sf):
    return substring_dedup.digests(substring_dedup.without_repeats(table(spark, sf, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_best_two_fit, op3_exact_dedup, op4_bpe, op5_url_rules, op6_quality_model,
    op7_chat, op8_quality_rules, op9_html_text, op10_shards,
    op11_conversation_repair, op12_merkle, op13_substring_dedup)}

ORACLE = {
    "op3_exact_dedup": exact_dedup.QUERY_SQL,
    "op7_chat": chat.QUERY_SQL,
    "op8_quality_rules": quality_rules.query_sql(),
    "op12_merkle": merkle.QUERY_SQL,
    "op13_substring_dedup": substring_dedup.QUERY_SQL,
}
