"""The corpus pipeline: documents to packed training sequences. Its stages are in ``allocspark.llm.pipeline``."""

from allocspark.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
