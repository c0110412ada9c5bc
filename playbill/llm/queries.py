"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from playbill.llm import decontaminate, embeddings, filter_audit, licenses, line_dedup, mixing, packing, periodic_runs, quality, simhash, suffix_dedup, token_store, warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_simhash": simhash.op2_simhash,
    "op3_embeddings": embeddings.op3_embeddings,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_token_store": token_store.op5_token_store,
    "op6_quality": quality.op6_quality,
    "op7_packing": packing.op7_packing,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_warc": warc.op9_warc,
    "op10_licenses": licenses.op10_licenses,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_mixing": mixing.op13_mixing,
}
ORACLE_SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op9_warc": warc.OP9_SQL,
    "op11_periodic_runs": periodic_runs.OP11_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
    "op13_mixing": mixing.OP13_SQL,
}
