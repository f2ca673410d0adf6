"""From raw documents to packed training sequences, as stages that each read the former's rows.

Every stage takes (spark, docs, sf_dir) and works on all of `docs`; all but the last return the
columns of documents. Defined results: null columns and empty texts pass as the operators state;
texts without a letter leave in the first stage; an empty table gives an empty result.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from alarmloom.llm import common, exactdedup, langid, mixing, nearjoin, packing
from alarmloom.session import scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labelled rows of `docs`; rows without an identifiable language leave."""
    model = langid.fit(docs)
    named = langid.identify(docs, model)
    found = F.col(common.free_name(docs, "lang_pred"))
    return named.filter(found != langid.UNKNOWN).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z the largest doc_id stays."""
    return exactdedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 the smallest doc_id stays."""
    return nearjoin.one_of_each(docs, words=5, percent=80)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target; a document appears as often as its copies, up to twice."""
    return mixing.mixed(docs)


def packing_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens; repeated documents are packed once per copy.

    The stage reports each piece's place and the digest of its ids; the ids themselves are those of
    `packing.pack_documents`, and `packing.sequences` makes whole sequences of them.
    """
    return packing.digests(packing.pack_documents(docs, remember=False))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing_weights),
    ("packing", packing_bins),
]

# Tokenizer, classifier and similarity join are beyond SQL; test_whole_jobs.py compares each stage and run()
# with plain Python on sf0.001.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        # What an operator stages on the way goes once its rows are written.
        with scratch(spark) as stage:
            docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
