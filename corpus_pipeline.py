"""The corpus pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from rollcall.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
