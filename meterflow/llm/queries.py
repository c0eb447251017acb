"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from meterflow.llm import (
    bayesjoin,
    bpe,
    bytecnn,
    consensus,
    decontam,
    divergence,
    mixing,
    secrets,
    structure,
    suffixes,
    urlrules,
    warc,
    whitening,
)

QUERIES = {
    "op1_warc_dictionary": warc.query,
    "op2_sparse_suffixes": suffixes.query,
    "op3_byte_cnn": bytecnn.query,
    "op4_url_rules": urlrules.query,
    "op5_bm25_decontamination": decontam.query,
    "op6_bayes_jaccard": bayesjoin.query,
    "op7_token_mixture": mixing.query,
    "op8_divergence_rules": divergence.query,
    "op9_consensus_text": consensus.query,
    "op10_secret_spans": secrets.query,
    "op11_whitened_embeddings": whitening.query,
    "op12_repaired_conversations": structure.query,
    "op13_bpe_automaton": bpe.query,
}

ORACLE_SQL = {
    "op1_warc_dictionary": warc.ORACLE_SQL,
    "op2_sparse_suffixes": suffixes.ORACLE_SQL,
    "op4_url_rules": urlrules.ORACLE_SQL,
    "op6_bayes_jaccard": bayesjoin.ORACLE_SQL,
    "op7_token_mixture": mixing.ORACLE_SQL,
    "op8_divergence_rules": divergence.ORACLE_SQL,
}
