"""Queries of the training-data operators and their DuckDB texts."""

from __future__ import annotations

from tessera.llm import (best_position, decontaminate, exact_dedup, lm_score, mixing, near_dedup, piece_codec, quality,
                         secret_scan, suffix_dedup, token_store, toxicity, whitening)

MODULES = (exact_dedup, decontaminate, token_store, secret_scan, toxicity, quality, mixing, lm_score, suffix_dedup, near_dedup,
           best_position, whitening, piece_codec)

QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
