"""What ``__spark_entry__`` registers for this subpackage."""

from __future__ import annotations

import corpus_pipeline
from tallyhall.llm import oracle
from tallyhall.llm.queries import QUERIES


def queries() -> dict:
    return {**QUERIES, "pipeline": corpus_pipeline.run}


def sql() -> dict[str, str]:
    found = dict(oracle.SQL)
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
