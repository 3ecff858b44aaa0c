"""PageRank by repeated joins."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .graph import Graph
from .skew import broadcast_if


def edge_weights(graph: Graph) -> DataFrame:
    """The sound edges with ``weight``, one over their source's out-degree.

    One aggregate of the routes and one join, whatever ranks there are.
    """
    small = graph.small_vertices
    weights = (
        graph.by_route.edges.groupBy("src")
        .agg(F.sum("flights").alias("__out"))
        .select("src", (1.0 / F.col("__out")).alias("weight"))
    )
    sound = graph.edges.join(
        graph.vertex_side(F.col("id").alias("src")), "src", "left_semi"
    ).join(graph.vertex_side(F.col("id").alias("dst")), "dst", "left_semi")
    weighted = sound.join(broadcast_if(weights, small), "src")
    return weighted.select(*graph.edges.columns, "weight")


def page_rank(
    graph: Graph,
    iterations: int = 10,
    reset: float = 0.15,
    settle_every: int = 5,
) -> Graph:
    """Rank vertices by a fixed number of steps.

    Every vertex starts at 1 and then repeatedly gets
    ``reset + (1 - reset) * sum(rank of source / out-degree of source)`` over the
    edges that reach it, parallel edges included.  The last ranks are scaled to sum to
    the number of vertices, which matters when some vertex has no way out.

    Returns the vertices with ``pagerank`` and the sound edges with ``weight``, one
    over the source's out-degree.

    The loop runs on routes, laid out once by source (a source with very many routes
    in several parts) and kept; a step moves only ranks and the partly summed
    contributions.  Small vertex tables are broadcast instead, and then routes do not
    move at all.
    """
    routes, small = graph.by_route.edges, graph.small_vertices
    out = routes.groupBy("src").agg(F.sum("flights").alias("out"))
    ids = graph.vertices.select("id")
    # Every vertex, with nothing received: united with what is sent, one aggregate then
    # serves vertices that receive nothing too, and no join is needed.
    silent = settle(
        ids.join(out, ids.id == out.src, "left").select("id", "out", F.lit(0.0).alias("got"))
    )

    if small:
        laid = routes.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        hot = graph.by_route.hot_sources
        laid = hot.lay_out(hot.divide(routes, F.col("src"), F.col("dst")), "src")

    try:
        ranks = silent.select("id", "out", F.lit(1.0).alias("pagerank"))
        for step in range(1, iterations + 1):
            given = ranks.filter(F.col("out").isNotNull()).select(
                F.col("id").alias("from"), (F.col("pagerank") / F.col("out")).alias("share")
            )
            to_source = F.col("src") == F.col("from")
            if small:
                met = laid.join(F.broadcast(given), to_source)
            else:
                met = laid.join(hot.copy(given, F.col("from")), hot.match(to_source))
            sent = met.select(
                F.col("dst").alias("id"),
                F.lit(None).cast("long").alias("out"),
                (F.col("share") * F.col("flights")).alias("got"),
            )
            ranks = (
                sent.unionByName(silent)
                .groupBy("id")
                .agg(
                    F.max("out").alias("out"),
                    (F.lit(reset) + (1 - reset) * F.sum("got")).alias("pagerank"),
                )
            )
            if step % settle_every == 0 or step == iterations:
                ranks = settle(ranks)
    finally:
        laid.unpersist()

    totals = ranks.agg(F.count(F.lit(1)).alias("n"), F.sum("pagerank").alias("mass")).first()
    scale = totals.n / totals.mass if totals.n else 1.0
    scaled = ranks.select(F.col("id"), (F.col("pagerank") * F.lit(scale)).alias("pagerank"))
    ranked = graph.vertices.join(scaled, "id")

    return Graph(ranked, edge_weights(graph))
