"""One query per operator over the whole tables of a data folder, and their SQL twins."""

import public_tokenizers
from pyspark.sql import functions as F

from shelfcast.llm import oracles
from shelfcast.llm.alignment import align_digest
from shelfcast.llm.bpe_codec import round_trip
from shelfcast.llm.collocations import collocations
from shelfcast.llm.common import documents, table
from shelfcast.llm.fingerprints import compare_with_edits
from shelfcast.llm.labelled import fold
from shelfcast.llm.near_dup import NearDupParams, near_duplicates
from shelfcast.llm.licenses import PHRASES, scan_licenses
from shelfcast.llm.mixing import mix_sources
from shelfcast.llm.nearest import nearest
from shelfcast.llm.quality import fit_quality, score_quality
from shelfcast.llm.repeats import repeat_digest
from shelfcast.llm.secret_scan import fit_secrets, scan_secrets
from shelfcast.llm.token_counts import count_tokens
from shelfcast.llm.toxicity import fit_toxicity, score_toxicity

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 512


def op1_minhash_near_dup(spark, sf_dir):
    """Near-duplicate groups of all documents by shingles of four words."""
    return near_duplicates(documents(spark, sf_dir), NearDupParams(words=4))


def op2_bpe_codec(spark, sf_dir):
    """Token ids of every document and back: counts and digests."""
    return round_trip(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op6_document_fingerprints(spark, sf_dir):
    """I-Match fingerprints of all documents and of their edited texts."""
    return compare_with_edits(documents(spark, sf_dir))


def op7_token_counts(spark, sf_dir):
    """Bytes and tokens of every document."""
    counts = count_tokens(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_source_mixing(spark, sf_dir):
    """Weight of every document's source and copies of the document in the mixture."""
    mixed = mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "mix_tokens", "mix_weight", "mix_copies")


def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document; the fold crc32(doc_id) % 4 = 2 is never learned from."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    learned = fold("doc_id", 4) != 2
    model = fit_toxicity(docs.where(learned), labels.where(learned))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= model.params.threshold).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).cast("int").alias("predicted_by_language"),
    )


def op5_quality(spark, sf_dir):
    """Quality score of every document; the fold crc32(doc_id) % 3 = 1 is never learned from."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    scored = score_quality(docs, fit_quality(docs, labels.where(fold("doc_id", 3) != 1)))
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_nearest_neighbours(spark, sf_dir):
    """The ten nearest vectors found for every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, F.col("id") % 100 == 0)


def op9_license_scans(spark, sf_dir):
    """License phrases and notices of all documents."""
    return scan_licenses(documents(spark, sf_dir)).drop("n_templates")


def op10_suffix_array_dedup(spark, sf_dir):
    """What is left of every document without 50-byte passages of documents with smaller ids."""
    return repeat_digest(documents(spark, sf_dir))


def op11_collocations(spark, sf_dir):
    """The first 2000 phrases of every language by the strength of their weakest cut."""
    return collocations(documents(spark, sf_dir, "lang", "text"))


def op12_secret_scans(spark, sf_dir):
    """Secrets of all documents: those of the patterns and those the random field adds."""
    docs = documents(spark, sf_dir)
    return scan_secrets(docs, fit_secrets(docs))


def op13_tokenizer_alignment(spark, sf_dir):
    """How the tokens of two tokenizers meet in every document, with corpus-wide pair counts."""
    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES)
    return align_digest(documents(spark, sf_dir), *paths)


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dup,
        op2_bpe_codec,
        op3_source_mixing,
        op4_toxicity,
        op5_quality,
        op6_document_fingerprints,
        op7_token_counts,
        op8_nearest_neighbours,
        op9_license_scans,
        op10_suffix_array_dedup,
        op11_collocations,
        op12_secret_scans,
        op13_tokenizer_alignment,
    )
}

ORACLES = {
    "op1_minhash_near_dup": oracles.NEAR_DUPLICATES,
    "op9_license_scans": oracles.license_sql(PHRASES),
    "op10_suffix_array_dedup": oracles.SUFFIX_ARRAY,
    "op11_collocations": oracles.COLLOCATIONS,
}
