"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm import bpe, licences, mixing, ogg, quality, simhash, syncmers, token_counts, toxicity, urls
from tessera.llm.common import read


def op1_token_counts(spark, sf_dir):
    return token_counts.token_counts(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_mixing(spark, sf_dir):
    return mixing.mixed(read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))


def op3_quality(spark, sf_dir):
    labels = read(spark, sf_dir, "labels", "doc_id", "quality")
    return quality.quality(read(spark, sf_dir, "documents", "doc_id", "text"), labels)


def op4_ogg(spark, sf_dir):
    return ogg.stored_media(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_licences(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    return licences.licences(docs.withColumn("path", licences.corpus_path()))


def op6_simhash(spark, sf_dir):
    return simhash.simhash_components(read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_toxicity(spark, sf_dir):
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.toxicity(read(spark, sf_dir, "documents", "doc_id", "text"), labels)


def op8_url_filters(spark, sf_dir):
    return urls.url_verdicts(read(spark, sf_dir, "pages", "page_id", "url"))


def op9_bpe(spark, sf_dir):
    return bpe.encode_decode(read(spark, sf_dir, "documents", "doc_id", "text"))


def op10_syncmers(spark, sf_dir):
    return syncmers.fingerprints(read(spark, sf_dir, "documents", "doc_id", "text"))


def pipeline(spark, sf_dir):
    import corpus_pipeline  # here, as it imports this subpackage

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_ogg": op4_ogg,
    "op5_licences": op5_licences,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_url_filters": op8_url_filters,
    "op9_bpe": op9_bpe,
    "op10_syncmers": op10_syncmers,
    "pipeline": pipeline,
}

ORACLES = {
    "op2_mixing": mixing.oracle(),
    "op8_url_filters": urls.oracle(),
}
