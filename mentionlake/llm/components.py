"""Connected components of a link table, by contraction, without leaving Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.stage import staged


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``); the root is the
    smallest node of its component.

    Every node points at its smallest neighbour or itself; pointers are halved until
    each ends at a root; links between different roots go to the next round. A hot node
    is only ever summed into a minimum, in each task before the shuffle.
    """
    edges = staged(links.select("a", "b").where("a <> b").distinct(), folder, "edges0")
    mapping: DataFrame | None = None
    step = 0
    while True:
        step += 1
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        parent = both.groupBy("node").agg(F.least("node", F.min("other")).alias("root"))
        parent = _to_roots(staged(parent, folder, f"parent{step}"), folder, f"{step}")
        if mapping is None:
            mapping = parent
        else:
            up = parent.toDF("root", "_up")
            mapping = staged(
                mapping.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root")),
                folder, f"mapping{step}",
            )
        edges = staged(
            edges.join(parent.toDF("a", "_a"), "a").join(parent.toDF("b", "_b"), "b")
            .where("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            folder, f"edges{step}",
        )
        if edges.isEmpty():
            return mapping


def _to_roots(parent: DataFrame, folder: str, label: str) -> DataFrame:
    step = 0
    while True:
        step += 1
        up = parent.toDF("root", "_up")
        jumped = staged(
            parent.join(up, "root", "left").select(
                "node", F.coalesce("_up", "root").alias("root"),
                (F.coalesce("_up", "root") != F.col("root")).alias("moved"),
            ),
            folder, f"jump{label}-{step}",
        )
        parent = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return parent
