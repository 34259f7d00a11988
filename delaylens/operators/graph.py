"""Route graph and weighted PageRank."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.operators.joins import (
    BROADCAST_ROWS,
    cluster_width,
    copied,
    hot_keys,
    lookup,
    pieces_of,
    salted,
)
from delaylens.session import checkpointed, scratch_path


def edge_weights(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Trips per (origin, destination) as ``src, dst, w``."""
    return df.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(F.count(dst).alias("w"))


def page_rank(
    edges: DataFrame,
    src: str = "src",
    dst: str = "dst",
    w: str = "w",
    alpha: float = 0.15,
    max_iter: int = 15,
    dangling: str = "spread",
    checkpoint_every: int = 5,
    tol: float | None = None,
    names: tuple[str, str] = ("dep_iata", "dep_rank"),
) -> DataFrame:
    """Scores after ``max_iter`` rounds of ``alpha/n + (1 - alpha) * inflow``.

    ``dangling='spread'`` shares the score of sites without departures among all
    sites, and the scores sum to 1. ``dangling='drop'`` lets it vanish and starts
    from the sites with departures only.

    Sites that no link reaches receive nothing, so the scores of those that send are equal
    in every round, and so are those of the others: one score each. Their links are summed
    once by destination, and only links between the other sites are followed in the rounds.
    Each round is one join on the origin and one map-side combined sum on the
    destination. A weight-0 link from every reached site to itself keeps sites that
    receive nothing in the rounds, so scores appear once per round and plans grow linearly.
    The lost score of a round is a scalar inside its plan, so the driver waits for scores
    only at every ``checkpoint_every``-th round; there, with ``tol``, the rounds end once
    all scores together changed by no more. The result is checkpointed.
    Scores too many to broadcast meet links that were partitioned once by origin,
    hubs cut into pieces, so that only scores move.
    """
    if dangling not in ("spread", "drop"):
        raise ValueError("dangling is 'spread' or 'drop'")
    edges = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.col(w).cast("double").alias("w"))
    edges = _written(edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("w") > 0)), "edges")
    reached = checkpointed(edges.select(F.col("dst").alias("node")).distinct().withColumn("reached", F.lit(True)))
    out_weight = edges.groupBy("src").agg(F.sum("w").alias("total")).withColumnRenamed("src", "node")
    ends = out_weight.join(reached, "node", "full")
    nodes = checkpointed(ends.select("node", "total", F.coalesce("reached", F.lit(False)).alias("reached")))
    counted = nodes.agg(F.count("*").alias("n"), F.count("total").alias("senders"), F.count_if("reached").alias("reached")).first()
    n, senders, followed = counted["n"], counted["senders"], counted["reached"]
    senders_of = nodes.filter("total IS NOT NULL").select(F.col("node").alias("src"), "total", "reached")
    shares = lookup(edges, senders_of, ["src"]).select("src", "dst", (F.col("w") / F.col("total")).alias("share"), "reached")
    if followed < n:
        # links of the unreached are summed as they are read, so none of them moves again
        origin = F.when(F.col("reached"), F.col("src")).alias("src")
        summed = checkpointed(shares.groupBy(origin, "dst").agg(F.sum("share").alias("share")))
        shares, fixed = summed.filter("src IS NOT NULL"), summed.filter("src IS NULL").select("dst", F.col("share").alias("fixed"))
        stay = reached.select(F.col("node").alias("dst")).join(fixed, "dst", "left").na.fill(0.0, ["fixed"])
    else:
        stay = reached.select(F.col("node").alias("dst"), F.lit(0.0).alias("fixed"))
    links = shares.select("src", "dst", "share", F.lit(0.0).alias("fixed"))
    links = checkpointed(links.unionByName(stay.select(F.col("dst").alias("src"), "dst", F.lit(0.0).alias("share"), "fixed")))

    start = nodes.filter("reached").select(F.col("node").alias("src"), F.col("total").isNotNull().cast("int").alias("sends"))
    if dangling == "spread":
        scores, rest = start.select("src", F.lit(1.0 / max(n, 1)).alias("score")), F.lit(1.0 / max(n, 1))
    else:
        scores, rest = start.select("src", (F.col("sends") / max(senders, 1)).alias("score")), F.lit(1.0 / max(senders, 1))
    scores = scores.withColumn("rest", rest)
    leaks = dangling == "spread" and senders < n
    few = followed <= BROADCAST_ROWS
    if not few:
        width = cluster_width(links)
        pieces = pieces_of(["src"], hot_keys(links, ["src"], width), width)
        links = salted(links, pieces).repartition(width, "src", "_salt").sortWithinPartitions("src", "_salt")
        links = links.persist(StorageLevel.MEMORY_AND_DISK)

    def with_scores(scores: DataFrame) -> DataFrame:
        if few:
            return links.join(F.broadcast(scores), "src")
        return links.join(copied(scores, pieces), ["src", "_salt"])

    held: list[DataFrame] = []
    try:
        for i in range(1, max_iter + 1):
            before = scores
            received = F.sum(F.col("share") * F.col("score") + F.col("fixed") * F.col("rest")).alias("inflow")
            inflow = with_scores(scores).groupBy("dst").agg(received)
            lost = F.lit(0.0)
            if leaks:
                # read twice, so kept; the lost score is one number that Spark computes on the way
                inflow = inflow.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(inflow)
                lost = inflow.agg(1.0 - F.sum("inflow")).scalar()
            rest = F.lit(alpha / max(n, 1)) + (1 - alpha) * (lost / max(n, 1))
            new = F.lit(alpha / max(n, 1)) + (1 - alpha) * (F.col("inflow") + lost / max(n, 1))
            scores = inflow.select(F.col("dst").alias("src"), new.alias("score"), rest.alias("rest"))
            if i % checkpoint_every == 0 or i == max_iter:
                scores = checkpointed(scores)
                if tol is not None and residual(before, scores, n - followed) <= tol:
                    break
                while held:
                    held.pop().unpersist()
    finally:
        for old in held:
            old.unpersist()
        if not few:
            links.unpersist()
    last = scores.select("rest").first()
    others = nodes.filter(~F.col("reached")).select(F.col("node").alias("src"), F.lit(last["rest"] if last else 0.0).alias("score"))
    return scores.select("src", "score").unionByName(others).toDF(*names)


def _written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet, smaller than a checkpoint of its rows, and read it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def residual(before: DataFrame, after: DataFrame, others: int = 0) -> float:
    """Sum of the absolute changes of all scores (``src, score``), and of ``others`` that have the score ``rest``."""
    both = after.join(before.withColumnsRenamed({"score": "old", "rest": "old_rest"}), "src")
    changed = both.agg(F.coalesce(F.sum(F.abs(F.col("score") - F.col("old"))), F.lit(0.0))).first()[0]
    if not others:
        return changed
    return changed + others * both.select(F.abs(F.col("rest") - F.col("old_rest"))).first()[0]
