"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questmart.session import stage


def smallest_reachable(links: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label, root): the smallest label in each node's component, and the node that has it.

    ``links``: (a, b), any direction, repeats allowed. ``labels``: (node, label) with one row for every node; nodes without
    links keep their label. Of equal labels the one of the smallest node wins, so ``root`` names a component. Labels travel
    over the links and then jump along their roots, so long chains need few rounds. Each round is stored, which ends its
    lineage; nothing but one yes or no per round comes to the driver.
    """
    both = stage(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    linked = both.select(F.col("a").alias("node")).distinct()
    state = stage(labels.join(linked, "node").select("node", F.struct("label", F.col("node").alias("root")).alias("best")), "labels")
    while True:
        offers = both.join(state, F.col("a") == F.col("node")).groupBy("b").agg(F.min("best").alias("offer"))
        heard = stage(
            state.join(offers, F.col("node") == F.col("b"), "left").select(
                "node", F.col("best").alias("old"), F.least("best", F.coalesce("offer", "best")).alias("now")
            ),
            "heard",
        )
        roots = heard.select(F.col("node").alias("root_node"), F.col("now").alias("jump"))
        moved = heard.join(roots, F.col("now.root") == F.col("root_node")).select("node", "old", F.least("now", "jump").alias("best"))
        moved = stage(moved.select("node", "best", (F.col("best") < F.col("old")).alias("changed")), "labels")
        state = moved.drop("changed")
        if moved.where("changed").limit(1).count() == 0:
            break
    alone = labels.join(linked, "node", "left_anti").select("node", "label", F.col("node").alias("root"))
    return state.select("node", "best.label", "best.root").unionAll(alone)
