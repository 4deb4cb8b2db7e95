"""The queries of this subpackage and their DuckDB SQL, for the entry module."""

from __future__ import annotations

from . import ann_search, chat_format, exact_dedup, filter_audit, html_extract, language_id, lexical_search, line_dedup, minhash_dedup, mixing, packing, secrets, token_counts

QUERIES = {
    "op1_html_extract": html_extract.op1_html_extract,
    "op2_temperature_mixing": mixing.op2_temperature_mixing,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_chat_format": chat_format.op4_chat_format,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_ann_search": ann_search.op6_ann_search,
    "op7_length_buckets": packing.op7_length_buckets,
    "op8_language_id": language_id.op8_language_id,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_minhash_near_dedup": minhash_dedup.op10_minhash_near_dedup,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_token_counts": token_counts.op13_token_counts,
    "language_id_pages": language_id.language_id_pages,
}

ORACLE_SQL = {
    "op3_secret_scan": secrets.ORACLE,
    "op4_chat_format": chat_format.ORACLE,
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE,
    "op10_minhash_near_dedup": minhash_dedup.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_lexical_search": lexical_search.ORACLE,
}
