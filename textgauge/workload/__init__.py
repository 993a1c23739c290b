"""The registered queries, each over whole tables, with their SQL checks."""

from textgauge.workload import audit, classifier, configs, fairness, governance, prompts, runs  # noqa: F401
from textgauge.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
