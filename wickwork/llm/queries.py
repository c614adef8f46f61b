"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from wickwork.llm import chat, chroma, dom, licences, mixing, packing, quality, simhash, suffix, warc
from wickwork.llm.common import table


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_array_dedup(spark, sf_dir):
    return suffix.dedup(table(spark, sf_dir, "documents"))


def op2_licence_scan(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark, sf_dir):
    return mixing.Mix(table(spark, sf_dir, "documents")).result()


def op4_chat_formatting(spark, sf_dir):
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op5_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_chroma_fingerprints(spark, sf_dir):
    recordings = chroma.recordings(table(spark, sf_dir, "embeddings"))
    return chroma.search(chroma.fingerprints(recordings, "vec_id", "audio"), "vec_id")


def op7_html_extraction(spark, sf_dir):
    return dom.main_text(table(spark, sf_dir, "pages"))


def op8_warc_round_trip(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


def quality_rules_with_menus(spark, sf_dir):
    """The quality rules on documents that were given menu lines, so that lines go and documents are depleted on any size of table."""
    return quality.judge(quality.with_menus(table(spark, sf_dir, "documents")))


def op10_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup, op2_licence_scan, op3_source_mixing, op4_chat_formatting, op5_simhash_near_duplicates,
        op6_chroma_fingerprints, op7_html_extraction, op8_warc_round_trip, op9_quality_rules, op10_best_fit_packing,
        quality_rules_with_menus,
    )
}
ORACLE = {
    "op2_licence_scan": licences.SQL,
    "op4_chat_formatting": chat.SQL,
    "op8_warc_round_trip": warc.SQL,
    "op9_quality_rules": quality.SQL,
    "quality_rules_with_menus": quality.SQL_MENUS,
}
