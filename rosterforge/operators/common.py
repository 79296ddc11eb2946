"""Helpers of the operators: checkpoints, numbering, connected components."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder the cluster names in ``spark.checkpoint.dir``.

    Where none is set, a folder of our own serves a local session; a cluster is
    refused, as its machines would not see each other's blocks.
    """
    spark, sc = df.sparkSession, df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="rosterforge-ckpt-"))
    return df.checkpoint(eager=True)


#: Most rows that are broadcast, and the share of rows (one in so many) from which a key is hot; so at most HOT_SHARE keys are.
BROADCAST, HOT_SHARE = 200_000, 1000


def looked_up(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], broadcast: int = BROADCAST, hot_share: int = HOT_SHARE) -> DataFrame:
    """``rows`` left-joined with ``keyed``, which has one row a key; no task meets all rows of a hot key.

    A small ``keyed`` is broadcast. Of a larger one only what hot keys need is
    broadcast, and the other rows are shuffled. Rows with a NULL key never are.
    """
    keys = list(keys)
    keyed = checkpointed(keyed)
    if keyed.limit(broadcast + 1).count() <= broadcast:
        return rows.join(F.broadcast(keyed), keys, "left")
    blank = F.lit(False)
    for k in keys:
        blank = blank | F.col(k).isNull()
    given = [F.lit(None).cast(f.dataType).alias(f.name) for f in keyed.schema if f.name not in keys]
    counts = rows.where(~blank).groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = checkpointed(counts.where(F.col("_n") * F.lit(hot_share) > F.lit(rows.count())).drop("_n"))
    found = rows.join(F.broadcast(keyed.join(F.broadcast(hot), keys, "right")), keys)
    rest = rows.where(~blank).join(F.broadcast(hot), keys, "left_anti").join(keyed, keys, "left")
    unkeyed = rows.where(blank).select("*", *given)
    return found.unionByName(rest).unionByName(unkeyed)


def numbered(df: DataFrame, order: Sequence[str], name: str = "seq") -> DataFrame:
    """``df`` with 1..n in the given order, without drawing all rows into one task.

    Rows are range-partitioned and sorted; each partition's numbers begin
    behind the sizes of those before it. ``order`` should name a unique key
    last, else ties are numbered arbitrarily.
    """
    sorted_rows = checkpointed(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    )
    sizes = sorted_rows.groupBy("_part").count()
    offsets = sizes.withColumn(
        "_before", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("_part", "_before")
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return sorted_rows.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + at).drop("_part", "_before")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of rows that share keys, directly or over others; ``links`` holds ``id, key``.

    Every row is tied to the least row of its keys, so there are as many edges
    as links however large a key is. Then large and small stars alternate: each
    node's neighbours are tied to the least of them, first the greater ones,
    then the lesser ones, until only stars are left; that takes a number of
    rounds that grows with the logarithm of the longest chain. Least neighbours
    are aggregates with partial results, and a node of very many neighbours is
    looked up as a hot key. Every round is checkpointed, so lineage stays short.
    """
    links = checkpointed(links.select("id", "key").distinct())
    least = links.groupBy("key").agg(F.min("id").alias("v"))
    edges = looked_up(links, least, ["key"]).select(F.col("id").alias("u"), "v").where("u <> v").distinct()
    edges = checkpointed(edges)
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = looked_up(both.where("v > u"), around, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = checkpointed(large)
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = looked_up(large, below, ["u"])
        tied = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(tied.unionByName(below.select("u", F.col("m").alias("v"))).distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    nodes = links.select("id").distinct()
    return nodes.join(edges.select(F.col("u").alias("id"), "v"), "id", "left").select("id", F.coalesce("v", "id").alias("component"))
