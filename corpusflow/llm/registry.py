"""All queries of the subpackage, the pipeline included, with their SQL."""

from __future__ import annotations


def all_queries():
    import corpus_pipeline
    from corpusflow.llm.queries import QUERIES, SQL
    sql = dict(SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql
