"""All queries of the subpackage."""

from gaugeworks.llm import queries_audit, queries_chat, queries_documents, queries_web  # noqa: F401
from gaugeworks.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
