"""DuckDB SQL for the registered queries of this subpackage."""

from . import line_dedup, mixing, vector_codes

SQL = {
    "op3_line_dedup": line_dedup.oracle_sql(),
    "op8_mixing": mixing.oracle_sql("documents", "doc_id, domain, lang_in AS lang, source_in AS source, "
                                    "tokens::BIGINT AS n_tokens, epoch"),
    "op11_vector_codes": vector_codes.oracle_sql(),
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
}
