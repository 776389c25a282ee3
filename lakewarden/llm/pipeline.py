"""The corpus pipeline as a query; its stages are in corpus_pipeline.py at the top of the repository."""

from __future__ import annotations

import corpus_pipeline

QUERIES = {"pipeline": corpus_pipeline.run}
ORACLES = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
