"""Tables of a lake as a declared graph: what each is made of, and whether it is a table, a part or a view.

A *table* is written to the lake and read from there by what depends on it; a *part* is written once to the shared folder, for
several tables that read it; a *view* is computed by whoever reads it. The order follows from the declared inputs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from leaguelake.session import stored

TABLE, PART, VIEW = "table", "part", "view"


@dataclass(frozen=True)
class Node:
    """How a table is made from its inputs, which are passed in the order declared."""

    make: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    kind: str = TABLE


def order_of(nodes: Mapping[str, Node], sources: Mapping[str, object]) -> list[str]:
    """Names of the nodes, inputs first. A cycle, an unknown input or a name given twice is an error."""
    if both := nodes.keys() & sources.keys():
        raise ValueError(f"declared and given: {sorted(both)}")
    if unknown := {i for n in nodes.values() for i in n.inputs} - nodes.keys() - sources.keys():
        raise ValueError(f"unknown inputs: {sorted(unknown)}")
    return [n for n in TopologicalSorter({k: v.inputs for k, v in nodes.items()}).static_order() if n in nodes]


def materialised(spark: SparkSession, folder: str, nodes: Mapping[str, Node], sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Make all nodes in order. Tables are written below ``folder``, replacing those of an earlier run."""
    made: dict[str, DataFrame] = dict(sources)
    for name in order_of(nodes, sources):
        node = nodes[name]
        df = node.make(*(made[i] for i in node.inputs))
        if node.kind == TABLE:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            df = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        elif node.kind == PART:
            df = stored(df, name)
        made[name] = df
    return {n: made[n] for n in nodes}
