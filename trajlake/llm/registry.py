"""All queries of the subpackage."""
from __future__ import annotations

import corpus_pipeline
from trajlake.llm.queries import QUERIES

REGISTERED = {**QUERIES, "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)}
