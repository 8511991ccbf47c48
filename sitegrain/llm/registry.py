"""The queries of this subpackage and their SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

import corpus_pipeline

from . import fingerprint, huffman, language, language_model, mixing, neighbours, packing, pii, quantiles, separators, simhash, toxicity, trie

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_fingerprint": fingerprint.query,
    "op2_mixing": mixing.query,
    "op3_huffman": huffman.query,
    "op4_packing": packing.query,
    "op5_pii": pii.query,
    "op6_simhash": simhash.query,
    "op7_language": language.query,
    "op8_neighbours": neighbours.query,
    "op9_separators": separators.query,
    "op10_toxicity": toxicity.query,
    "op11_log_bilinear": language_model.query,
    "op12_quantiles": quantiles.query,
    "op13_trie": trie.query,
}

#: The others compute hashes, token ids or learned models that SQL has no function for; tests hold them against brute force.
ORACLES: dict[str, str] = {"op8_neighbours": neighbours.ORACLE, "op13_trie": trie.ORACLE}
