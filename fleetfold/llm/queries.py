"""The operators of this subpackage as named queries, and their SQL where SQL can express them."""

from __future__ import annotations

from fleetfold.llm import (
    bpe, decontam, fingerprints, langid, linededup, manifest, neighbours, phrases, pii, simhash, spans, tokenfiles, toxicity,
)

QUERIES = {
    "op1_line_dedup": linededup.op1_line_dedup,
    "op2_bpe": bpe.op2_bpe,
    "op3_fingerprints": fingerprints.op3_fingerprints,
    "op4_simhash": simhash.op4_simhash,
    "op5_token_files": tokenfiles.op5_token_files,
    "op6_pii": pii.op6_pii,
    "op7_substring_dedup": spans.op7_substring_dedup,
    "op8_language_id": langid.op8_language_id,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_decontamination": decontam.op10_decontamination,
    "op11_nearest_neighbours": neighbours.op11_nearest_neighbours,
    "op12_merkle_manifest": manifest.op12_merkle_manifest,
    "op13_collocations": phrases.op13_collocations,
}

ORACLES = {
    "op1_line_dedup": linededup.OP1_SQL,
    "op10_decontamination": decontam.OP10_SQL,
    "op11_nearest_neighbours": neighbours.OP11_SQL,
    "op12_merkle_manifest": manifest.OP12_SQL,
    "op13_collocations": phrases.OP13_SQL,
}
