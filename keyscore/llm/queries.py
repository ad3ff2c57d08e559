"""All queries of the subpackage, each with its SQL where there is one."""

from __future__ import annotations

import importlib

import corpus_pipeline

from keyscore.llm.common import QUERIES, SQL

for _module in ("pii", "bpe", "rules", "quality", "lattice", "toolcalls", "decontaminate", "lines", "substrings", "jaccard", "topk", "collocations", "spelling"):
    importlib.import_module(f"keyscore.llm.{_module}")

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["QUERIES", "SQL"]
