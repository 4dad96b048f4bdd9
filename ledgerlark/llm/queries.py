"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat_format, decontaminate, embedding_dedup, fill_middle, html_extract, lang_id, mixing, ngram_join, periodic_runs, quality, token_output, url_filter, voronoi_knn


def queries() -> dict:
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_language_id": lang_id.op1_language_id,
        "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
        "op3_ngram_join": ngram_join.op3_ngram_join,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_chat_format": chat_format.op5_chat_format,
        "op6_token_output": token_output.op6_token_output,
        "op7_quality": quality.op7_quality,
        "op8_decontamination": decontaminate.op8_decontamination,
        "op9_mixing": mixing.op9_mixing,
        "op10_html_extract": html_extract.op10_html_extract,
        "op11_periodic_runs": periodic_runs.op11_periodic_runs,
        "op12_fill_middle": fill_middle.op12_fill_middle,
        "op13_top_k": voronoi_knn.op13_top_k,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": embedding_dedup.ORACLE_SQL, "op5_chat_format": chat_format.ORACLE_SQL, "op8_decontamination": decontaminate.ORACLE_SQL, "op13_top_k": voronoi_knn.ORACLE_SQL}
