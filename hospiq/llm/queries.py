"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import (
    chat_format,
    decontam,
    exact_dedup,
    langid,
    mixing,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    resample,
    secret_scan,
    suffix_dedup,
    token_count,
)
from .common import ship_package


def _shipped(fn):
    def run(spark, sf_dir):
        ship_package(spark)
        return fn(spark, sf_dir)
    return run


_OPERATORS = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_decontamination": decontam.query,
    "op3_chat_format": chat_format.query,
    "op4_language_id": langid.query,
    "op5_token_counts": token_count.query,
    "op6_secret_scan": secret_scan.query,
    "op7_quality": quality.query,
    "op8_suffix_dedup": suffix_dedup.query,
    "op9_near_dedup": near_dedup.query,
    "op10_mixing": mixing.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_resample": resample.query,
    "op13_packing": packing.query,
}

QUERIES = {name: _shipped(fn) for name, fn in _OPERATORS.items()}

SQL = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_decontamination": decontam.SQL,
    "op3_chat_format": chat_format.SQL,
    "op9_near_dedup": near_dedup.SQL,
    "op11_prefix_trie": prefix_trie.SQL,
    "op12_resample": resample.SQL,
}
