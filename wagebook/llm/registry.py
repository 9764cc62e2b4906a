"""Registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from wagebook.llm import bpe, exact, merkle, minhash, mixing, multiset, quality, secretscan, sharding, toxicity, urls, warc, whitening
from wagebook.llm.common import table


def queries() -> dict:
    return {
        "op1_quality": lambda s, d: quality.query(s, table(s, d, "documents"), table(s, d, "labels")),
        "op2_warc": lambda s, d: warc.query(s, table(s, d, "pages")),
        "op3_bpe": lambda s, d: bpe.query(s, table(s, d, "documents")),
        "op4_exact_dedup": lambda s, d: exact.query(s, table(s, d, "documents")),
        "op5_minhash": lambda s, d: minhash.query(s, table(s, d, "documents")),
        "op6_fingerprints": lambda s, d: multiset.query(s, table(s, d, "documents")),
        "op7_sharding": lambda s, d: sharding.query(s, table(s, d, "documents")),
        "op8_url_filter": lambda s, d: urls.query(s, table(s, d, "pages"), table(s, d, "labels")),
        "op9_mixing": lambda s, d: mixing.query(s, table(s, d, "documents")),
        "op10_toxicity": lambda s, d: toxicity.query(s, table(s, d, "documents"), table(s, d, "labels")),
        "op11_whitening": lambda s, d: whitening.query(s, table(s, d, "embeddings")),
        "op12_merkle": lambda s, d: merkle.query(s, table(s, d, "documents")),
        "op13_secrets": lambda s, d: secretscan.query(s, table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": exact.SQL, "op8_url_filter": urls.SQL, "op9_mixing": mixing.SQL, "op12_merkle": merkle.SQL, "op13_secrets": secretscan.SQL}
