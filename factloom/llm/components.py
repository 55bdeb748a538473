"""Connected components of a link table by label propagation with shortcuts, in joins of bounded width."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.shared import cut, drop_cut


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the least node reachable) of every node in links.

    Each round a node takes the least label around it, then its label's label, so
    that rounds grow with the logarithm of a chain's length. Labels meet links in
    joins and minima, never one component in one task. Null ends are left aside;
    self links and repeated links do no harm.
    """
    ends = links.select(F.col(a).alias("from"), F.col(b).alias("to")).where("from is not null and to is not null")
    both = cut(ends.union(ends.select(F.col("to"), F.col("from"))).distinct())
    labels = cut(both.groupBy(F.col("from").alias("node")).agg(F.least(F.min("to"), F.first("from")).alias("component")))
    while True:
        around = both.join(labels, both["from"] == labels["node"]).groupBy(F.col("to").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(around, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        lower = cut(lower)
        over = lower.select(F.col("node").alias("component"), F.col("component").alias("label"))
        jumped = cut(lower.join(over, "component").select("node", "was", F.col("label").alias("component")))
        changed = jumped.where("was <> component").limit(1).count()
        for old in (labels, lower):
            drop_cut(old)
        labels = jumped
        if not changed:
            drop_cut(both)
            found = labels.select("node", "component")
            found._factloom_path = labels._factloom_path  # drop_cut() takes the whole table
            return found
