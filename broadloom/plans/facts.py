"""Readable facts about the physical plan of a DataFrame."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame

_NODE = re.compile(r"^[\s:+\-*|]*(?:\(\d+\)\s*)?\*?(?:\(\d+\)\s*)?([A-Z][A-Za-z]+)", re.MULTILINE)


@dataclass(frozen=True)
class PlanFacts:
    """Node counts and scan details of one physical plan."""

    text: str
    nodes: dict

    def count(self, *names: str) -> int:
        return sum(self.nodes.get(name, 0) for name in names)

    @property
    def exchanges(self) -> int:
        """Shuffles, without the broadcast exchanges."""
        return self.count("Exchange")

    @property
    def has_dynamic_pruning(self) -> bool:
        return "dynamicpruning" in self.text

    def pushed_filters(self) -> list:
        return re.findall(r"PushedFilters: \[(.*?)\]", self.text)

    def partition_filters(self) -> list:
        return re.findall(r"PartitionFilters: \[(.*?)\]", self.text)

    def read_schemas(self) -> list:
        return re.findall(r"ReadSchema: struct<(.*?)>", self.text)


def plan_facts(df: DataFrame) -> PlanFacts:
    """Facts of the plan Spark would start with (before runtime re-planning)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return PlanFacts(text, dict(Counter(_NODE.findall(text))))
