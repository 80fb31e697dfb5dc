"""From raw documents to packed training sequences, one written table after the other.

The stages live with their operators in ``cohortal.llm.pipeline``.
"""

from cohortal.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
