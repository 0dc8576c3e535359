"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, embeddings, idfile, lines, manifest, mixing, personal, quality, rules, runs, secrets, simhash, warc

QUERIES = {
    "op1_bpe_roundtrip": bpe.op1,
    "op2_embedding_near_dedup": embeddings.op2,
    "op3_source_mix": mixing.op3,
    "op4_token_id_files": idfile.op4,
    "op5_simhash_near_dedup": simhash.op5,
    "op6_warc_fixity_audit": warc.op6,
    "op7_secret_scan": secrets.op7,
    "op8_line_dedup": lines.op8,
    "op9_quality_classifier": quality.op9,
    "op10_quality_rules": rules.op10,
    "op11_personal_data": personal.op11,
    "op12_periodic_runs": runs.op12,
    "op13_merkle_manifest": manifest.op13,
}

ORACLES: dict[str, str] = {
    "op2_embedding_near_dedup": embeddings.OP2_SQL,
    "op3_source_mix": mixing.OP3_SQL,
    "op6_warc_fixity_audit": warc.OP6_SQL,
    "op8_line_dedup": lines.OP8_SQL,
    "op13_merkle_manifest": manifest.OP13_SQL,
}
