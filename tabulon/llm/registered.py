"""What ``__spark_entry__`` adds: the operators' queries and the pipeline."""

import corpus_pipeline
from tabulon.llm import queries

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
ORACLES = dict(queries.ORACLES)
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["ORACLES", "QUERIES"]
