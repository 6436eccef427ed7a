"""Connected components of links between numbers, by hooking and pointer jumping.

In every round each node that has a smaller neighbour hooks to its smallest one,
paths are halved until all point to their root, and links are moved to the roots.
Rounds and halvings are logarithmic.  All steps fold or join narrow rows and are
stored, so neither a long chain nor a node with a third of all links is gathered
anywhere, and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.staging import stored


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for links ``a``, ``b``.

    Nodes are numbers and not null.  Roots themselves and nodes without links are
    left out.
    """
    steps = iter(range(1 << 30))

    def keep(df: DataFrame) -> DataFrame:
        return stored(df, f"{folder}/step-{next(steps)}")

    ends = links.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    links = keep(ends.distinct())
    roots = None
    while links.limit(1).count():
        hooks = keep(links.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root")))
        while True:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            jumped = keep(
                hooks.join(above, "root", "left").select(
                    "node",
                    F.coalesce("higher", "root").alias("root"),
                    F.col("higher").isNotNull().alias("moved"),
                )
            )
            hooks = jumped.select("node", "root")
            if not jumped.where("moved").limit(1).count():
                break
        moved = links
        for end in ("low", "high"):
            to = hooks.select(F.col("node").alias(end), F.col("root").alias("to"))
            others = [c for c in ("low", "high") if c != end]
            moved = moved.join(to, end, "left").select(*others, F.coalesce("to", end).alias(end))
        ends = moved.where("low <> high").select(
            F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high")
        )
        links = keep(ends.distinct())
        if roots is not None:
            to = hooks.select(F.col("node").alias("root"), F.col("root").alias("to"))
            earlier = roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            hooks = earlier.unionByName(hooks)
        roots = keep(hooks)
    if roots is None:
        return links.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return roots
