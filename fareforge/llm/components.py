"""Connected components of a link table by alternating star contractions."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import last_layer, materialize, release


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node of links (u, v): the smallest node that can be reached.

    Large stars hang larger neighbours on the smallest one of a node, small stars do so for the smaller neighbours; both
    keep what is connected, and the table ends as stars in a number of rounds logarithmic in its size. Smallest neighbours
    are aggregated before they are joined back from a written table, so a node with very many links can be split. The
    tables of a round are released when it ends.
    """
    layers = []

    def written(table: DataFrame, label: str) -> DataFrame:
        out = materialize(table, label)
        layers.append(last_layer())
        return out

    def smallest(pairs: DataFrame, label: str) -> DataFrame:
        return written(pairs.groupBy("u").agg(F.min("v").alias("m")), label)

    edges = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    digest = _digest(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = smallest(both, "large").withColumn("m", F.least("u", "m"))
        large = written(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        low = smallest(large, "small")
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = written(hung.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        before, digest, edges = digest, _digest(small), small
        release(links.sparkSession, *layers[:-1])
        del layers[:-1]
        if digest == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _digest(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
