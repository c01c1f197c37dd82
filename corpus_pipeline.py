"""From raw documents to token ids: a pipeline of five operators, each over all it receives.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's documents. All but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import functions as F

from shelfcast.llm.bpe_codec import round_trip
from shelfcast.llm.common import keep, table
from shelfcast.llm.labelled import fold
from shelfcast.llm.mixing import MixParams, mixture
from shelfcast.llm.near_dup import NearDupParams, drop_near_duplicates
from shelfcast.llm.repeats import RepeatParams, drop_repeats
from shelfcast.llm.toxicity import fit_toxicity, score_toxicity

NEAR_DUP = NearDupParams(words=5, percent=80)
# Shorter repeats, such as license lines, are left alone.
REPEATS = RepeatParams(length=150)
MIX = MixParams(entropy=0.95, repeats=2.0)
TOKENIZER = "byte_bpe_50k.json"


def toxicity(spark, docs, sf_dir):
    """Documents whose score is below the threshold of their language, unchanged.

    The model learns from labelled documents outside of the fold crc32(doc_id) % 4 = 2.
    """
    learned = fold("doc_id", 4) != 2
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(learned)
    scored = score_toxicity(docs, fit_toxicity(docs.where(learned), labels))
    return scored.where(F.col("score") < F.col("threshold")).select(*docs.columns)


def minhash_near_dup(spark, docs, sf_dir):
    """One document of each group of near-duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs, NEAR_DUP)


def suffix_array_dedup(spark, docs, sf_dir):
    """All documents without the long passages that documents with smaller ids have, too."""
    return drop_repeats(docs, REPEATS)


def source_mixing(spark, docs, sf_dir):
    """Every document once or more, as often as its source's weight asks for."""
    return mixture(docs, MIX)


def bpe_codec(spark, docs, sf_dir):
    """Token counts and digests of the ids and of the decoded text of every row."""
    return round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dup", minhash_near_dup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mixing", source_mixing),
    ("bpe_codec", bpe_codec),
]

# Trained weights and tokenizer merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, one after the other, from the documents of a data folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {}
