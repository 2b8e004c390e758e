"""Connected components of an edge table: smallest reachable id of each node, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solidspark.skew import heavy_keys, join_heavy, shuffled
from solidspark.staging import stage, unstage


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b), undirected, ids of any ordered type.

    Each round takes the smallest label among a node and its neighbours (pre-aggregated) and then the
    label of that label; it ends when nothing changes. Neither a hub with its edges nor a large component
    with its nodes is one task: see :mod:`solidspark.skew`. The rounds needed grow with the logarithm
    of a component's width in the usual case. Labels are written to the shared folder each round;
    nothing goes to the driver but counts. An empty edge table gives an empty result; repeated edges
    and loops change nothing."""
    both = stage(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "cc-edges")
    n_edges = both.count()
    hubs = stage(heavy_keys(both.groupBy("b").agg(F.count("*").alias("n")), n_edges, "b"), "cc-hubs")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "cc-labels")
    n_nodes = labels.count()
    while True:
        near = join_heavy(both, labels.select(F.col("node").alias("b"), "component"), "b", hubs)
        near = near.groupBy(F.col("a").alias("near")).agg(F.min("component").alias("least"))
        hooked = labels.join(shuffled(near), labels["node"] == near["near"]).select("node", F.col("component").alias("was"), F.least("component", "least").alias("now"))
        hooked = stage(hooked, "cc-hooked")
        large = heavy_keys(hooked.groupBy("now").agg(F.count("*").alias("n")), n_nodes, "now")
        jumped = join_heavy(hooked, labels.select(F.col("node").alias("now"), F.col("component").alias("top")), "now", large)
        jumped = stage(jumped.select("node", "was", F.least("now", "top").alias("component")), "cc-labels")
        changed = jumped.where("was <> component").limit(1).count()
        unstage(labels)
        unstage(hooked)
        labels = jumped
        if not changed:
            unstage(both)
            unstage(hubs)
            return labels.select("node", "component")
