"""The corpus queries and the SQL of those that SQL can express."""

import corpus_pipeline
from alarmloom.llm import (
    divergence,
    exactdedup,
    importance,
    langid,
    linededup,
    mixing,
    nearjoin,
    packing,
    qualityrules,
    secretscan,
    sharding,
    topk,
    toxicity,
)


def queries():
    listed = [
        mixing.op1_mixing_to_target_weights,
        secretscan.op2_secret_scan,
        nearjoin.op3_ngram_jaccard_join,
        linededup.op4_line_dedup,
        topk.op5_exact_top_k,
        packing.op6_best_fit_packing,
        exactdedup.op7_exact_dedup,
        langid.op8_language_id,
        sharding.op9_hilbert_sharding,
        toxicity.op10_toxicity,
        qualityrules.op11_quality_compression_bands,
        divergence.op12_source_divergence_audit,
        importance.op13_importance_resampling,
    ]
    return {query.__name__: query for query in listed} | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    return {
        "op4_line_dedup": linededup.OP4_SQL,
        "op5_exact_top_k": topk.OP5_SQL,
        "op7_exact_dedup": exactdedup.OP7_SQL,
        "op12_source_divergence_audit": divergence.OP12_SQL,
        "op13_importance_resampling": importance.OP13_SQL,
    }
