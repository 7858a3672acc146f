"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """(key, label) of every end of a link (a, b): the smallest key reachable.

    Each round gives a vertex the smallest label among its neighbours' and its
    own, hooks the old label on the new one and jumps pointers, so long chains
    shrink fast. Minima are grouped with partial sums, so a vertex with very
    many links is no hot row. Rounds are written to the shared folder.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialise(both, "links")
    labels = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                         .select(F.col("a").alias("key"), "label"), "labels")
    while True:
        l, e = labels.alias("l"), both.alias("e")
        near = (e.join(l, F.col("e.b") == F.col("l.key")).groupBy("e.a").agg(F.min("l.label").alias("near")))
        # Hook the old label's vertex too: it takes the best that any of its vertices saw.
        seen = labels.join(near, labels.key == near.a).select("key", "label", F.least("label", "near").alias("best"))
        hooked = seen.groupBy("label").agg(F.min("best").alias("best")).select(F.col("label").alias("key"), "best")
        own = seen.select("key", "best").unionAll(hooked).groupBy("key").agg(F.min("best").alias("label"))
        # Jump: the label of the label.
        o, j = own.alias("o"), own.alias("j")
        new = materialise(o.join(j, F.col("o.label") == F.col("j.key"), "left")
                          .select("o.key", F.least("o.label", F.coalesce("j.label", "o.label")).alias("label")), "labels")
        changed = new.alias("n").join(labels.alias("p"), F.col("n.key") == F.col("p.key")).filter("n.label <> p.label")
        done = changed.isEmpty()
        labels = new
        if done:
            return labels
