"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from skylattice.llm import bpe, dedup_exact, dedup_near, langid, lm, packing, pii, quality, secret_scan, token_store

QUERIES = {
    "op1_pii": pii.query,
    "op2_near_dedup": dedup_near.query,
    "op3_token_store": token_store.query,
    "op4_packing": packing.query,
    "op5_exact_dedup": dedup_exact.query,
    "op6_quality_ledger": quality.query,
    "op7_lm_score": lm.query,
    "op8_byte_bpe": bpe.query,
    "op9_language_id": langid.query,
    "op10_secret_scan": secret_scan.query,
    "pipeline": corpus_pipeline.run,
}
SQL = {
    "op5_exact_dedup": dedup_exact.SQL,
    "op6_quality_ledger": quality.SQL,
}
