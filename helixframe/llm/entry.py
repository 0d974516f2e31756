"""Queries of this folder for the entry file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, html_text, language_id, line_dedup, line_quality, merkle, packing, quality_classifier, ranked_search, simhash, token_counts, token_matrix, warc


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_token_matrix": token_matrix.op4_token_matrix,
    "op5_line_quality": line_quality.op5_line_quality,
    "op6_packing": packing.op6_packing,
    "op7_warc": warc.op7_warc,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_html_text": html_text.op9_html_text,
    "op10_simhash": simhash.op10_simhash,
    "op11_quality_classifier": quality_classifier.op11_quality_classifier,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_merkle": merkle.op13_merkle,
    "pipeline": pipeline,
}

SQL = {"op2_decontaminate": decontaminate.SQL, "op8_line_dedup": line_dedup.SQL, "op12_ranked_search": ranked_search.SQL, "op13_merkle": merkle.SQL}
