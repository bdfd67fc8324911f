"""The queries of this package by name, and SQL where SQL can express one."""

from __future__ import annotations

import corpus_pipeline

from .chat import chat_format
from .decontamination import benchmark_decontamination
from .embeddings import embedding_near_dedup
from .jaccard import ngram_jaccard
from .lines import line_dedup
from .merkle import MERKLE_SQL, merkle_manifest
from .packing import best_fit_packing
from .phrases import PHRASES_SQL, phrase_mining
from .quality import quality_classifier
from .secrets import secret_scan
from .substrings import substring_dedup
from .toxicity import toxicity
from .urls import url_filter

QUERIES = {
    "op1_ngram_jaccard": ngram_jaccard,
    "op2_substring_dedup": substring_dedup,
    "op3_chat_format": chat_format,
    "op4_toxicity": toxicity,
    "op5_secret_scan": secret_scan,
    "op6_benchmark_decontamination": benchmark_decontamination,
    "op7_best_fit_packing": best_fit_packing,
    "op8_embedding_near_dedup": embedding_near_dedup,
    "op9_line_dedup": line_dedup,
    "op10_url_filter": url_filter,
    "op11_quality_classifier": quality_classifier,
    "op12_phrase_collocation_mining": phrase_mining,
    "op13_merkle_manifest": merkle_manifest,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {"op12_phrase_collocation_mining": PHRASES_SQL, "op13_merkle_manifest": MERKLE_SQL}
