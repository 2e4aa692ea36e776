"""The queries of this package and their SQL."""

from __future__ import annotations

from episodica.llm import (
    byte_bpe,
    chained_passages,
    compression_lang,
    fim_wavelet,
    host_consensus,
    imatch,
    minhash_tensor,
    minimax_shards,
    phrase_trie,
    pii_candidates,
    qgram_decontam,
    quality_gam,
    secret_ledger,
)

MODULES = (
    imatch,
    secret_ledger,
    host_consensus,
    pii_candidates,
    qgram_decontam,
    minimax_shards,
    byte_bpe,
    quality_gam,
    chained_passages,
    minhash_tensor,
    compression_lang,
    phrase_trie,
    fim_wavelet,
)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
