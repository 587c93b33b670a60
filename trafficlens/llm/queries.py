"""Registered queries of the operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficlens.sources.bindings import table

from . import oracle
from .alignment import align_digests
from .contamination import find_contamination
from .disclosure import find_pii
from .packing import pack
from .pieces import encode_digests, read_model
from .quality import quality_model, score_quality
from .repetition import repetition_rules
from .secret_scan import scan_secrets
from .simhash import near_duplicates
from .style_tree import main_text
from .toxicity import score_toxicity, toxicity_model
from .unit_dedup import remove_repeats
from .whitening import whiten

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
WORD_TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


def op1_pii(spark, sf_dir):
    return find_pii(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def op3_line_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), min_run=30)


def op4_simhash(spark, sf_dir):
    got = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_secrets(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents")).drop("added")


def op6_decontamination(spark, sf_dir):
    got = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                             window=13, min_share=0.05)
    return got.drop("items", "spans", "longest_match")


def op7_html(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


def op8_sentencepiece(spark, sf_dir, model=MODEL):
    return encode_digests(table(spark, sf_dir, "documents"), read_model(model))


def op9_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, quality_model(docs, table(spark, sf_dir, "labels")))


def op10_repetition(spark, sf_dir):
    got = repetition_rules(table(spark, sf_dir, "documents"), min_words=8, max_covered=0.3,
                           max_repeat=100)
    return got.drop("covered_fraction", "longest_repeat")


def op11_alignment(spark, sf_dir, tokenizer=BYTE_TOKENIZER, model=MODEL):
    return align_digests(table(spark, sf_dir, "documents"), read_model(tokenizer).decode(), read_model(model))


def op12_packing(spark, sf_dir, tokenizer=WORD_TOKENIZER):
    return pack(table(spark, sf_dir, "documents"), read_model(tokenizer).decode(), capacity=2048, separator=0)


def op13_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), k=8)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_simhash": op4_simhash,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_html": op7_html,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality": op9_quality,
    "op10_repetition": op10_repetition,
    "op11_alignment": op11_alignment,
    "op12_packing": op12_packing,
    "op13_whitening": op13_whitening,
}
ORACLE = {
    "op3_line_dedup": oracle.LINE_DEDUP,
    "op6_decontamination": oracle.CONTAMINATION,
    "op10_repetition": oracle.REPETITION,
}
