"""Connected components of a graph that is held in a DataFrame."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm._common import staged


#: Rows of a file of links or labels at least.
FILE_ROWS = 200_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node with a link; component is the smallest node reachable.

    Each round a node takes the smallest label among its own and its neighbours', then the label of
    its label.  The second step makes paths shrink, so rounds grow with the logarithm of a component's
    diameter.  Minima are aggregated before shuffling, so a node with very many links is no burden;
    labels are written to the shared folder each round, which keeps plans short and survives lost
    executors.  Only a count of changed labels reaches the driver."""
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = one.union(one.select("v", "u")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    files = max(1, math.ceil(2 * links.count() / FILE_ROWS))  # a small graph needs few tasks
    both = staged(both.coalesce(files), "links")
    labels = staged(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("label")).coalesce(files), "labels")
    while True:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("label").alias("m"))
        taken = labels.join(near, labels.node == near.u).select("node", "label", F.least("label", "m").alias("next"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("jump"))
        jumped = taken.join(target, taken.next == target.t).select("node", F.least("next", "jump").alias("label"), (F.least("next", "jump") < F.col("label")).alias("changed"))
        made = staged(jumped.coalesce(files), "labels")
        labels = made.select("node", "label")
        if not made.filter("changed").limit(1).count():
            return labels.select("node", F.col("label").alias("component"))
