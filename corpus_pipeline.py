"""From raw documents to token counts, in five stages; see quillgraph.llm.stages."""

from quillgraph.llm.stages import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
