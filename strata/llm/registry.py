"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

import corpus_pipeline
from strata.llm.bpe import op9_byte_bpe
from strata.llm.codes import ORACLE as CODES_ORACLE
from strata.llm.codes import op12_vector_codes
from strata.llm.mixing import op5_source_mix
from strata.llm.orchard import ORACLE as CLUSTER_ORACLE
from strata.llm.orchard import op13_centroid_clusters
from strata.llm.pieces import op11_sentencepiece
from strata.llm.quality import op7_quality_rules
from strata.llm.secrets import op8_secret_scan
from strata.llm.simhash import op6_simhash_near_dedup
from strata.llm.tokencount import op4_token_counts
from strata.llm.toxicity import op2_toxicity
from strata.llm.urls import ORACLE as URL_ORACLE
from strata.llm.urls import op1_url_filter
from strata.llm.vectors import op10_embedding_near_dedup
from strata.llm.warc import ORACLE as WARC_ORACLE
from strata.llm.warc import op3_warc


def queries() -> dict:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_toxicity": op2_toxicity,
        "op3_warc": op3_warc,
        "op4_token_counts": op4_token_counts,
        "op5_source_mix": op5_source_mix,
        "op6_simhash_near_dedup": op6_simhash_near_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_secret_scan": op8_secret_scan,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_embedding_near_dedup": op10_embedding_near_dedup,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_vector_codes": op12_vector_codes,
        "op13_centroid_clusters": op13_centroid_clusters,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": URL_ORACLE,
        "op3_warc": WARC_ORACLE,
        "op12_vector_codes": CODES_ORACLE,
        "op13_centroid_clusters": CLUSTER_ORACLE,
    }
