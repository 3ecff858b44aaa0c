"""Counting matches of patterns without forming them."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store
from .graph import Graph
from .skew import broadcast_if, fits_in_memory


def connection_counts(
    graph: Graph,
    where: str | Column = "arrdelay > 40",
    day: str = "fldate",
    arrives: str | Column = "crsdephour + arrdelay",
    leaves: str | Column = "crsdephour + depdelay",
    slot: float = 60.0,
    edge_key: str = "id",
) -> DataFrame:
    """How many same-day connections every edge has: ``edge_key`` and ``connections``.

    A connection of ab is an edge bc from its target on the same ``day`` whose ``leaves``
    exceeds ab's ``arrives``; both meet ``where`` and run between vertices of the graph.
    Every edge is returned, 0 included; keys that stand on several edges count for each.

    No pair is formed.  At each vertex and day the departures are counted by time, the
    times swept from the latest down: what an arrival finds is the sum of the later times
    in its ``slot`` and of the later slots.  So a task holds the distinct times of one slot
    of one vertex and day, however many edges share them.
    """
    as_column = lambda e: F.expr(e) if isinstance(e, str) else e
    kept = graph.sound_edges().filter(where)
    at_slot = F.floor(F.col("time") / F.lit(slot))
    outs = kept.select(F.col("src").alias("at"), F.col(day).alias("on"), as_column(leaves).alias("time"))
    outs = outs.dropna().groupBy("at", "on", "time").agg(F.count(F.lit(1)).alias("n")).withColumn("slot", at_slot)
    outs = store(outs, "departures")
    ins = kept.select(
        F.col(edge_key).alias("key"),
        F.col("dst").alias("at"),
        F.col(day).alias("on"),
        as_column(arrives).alias("time"),
    )
    times = ins.select("at", "on", "time").dropna().distinct().withColumn("slot", at_slot)
    # Arrivals ask (n = 0), departures answer; at equal times the question comes first.
    events = outs.select("at", "on", "slot", "time", "n").unionByName(times.withColumn("n", F.lit(0).cast("long")))
    slots = events.groupBy("at", "on", "slot").agg(F.sum("n").alias("n"))
    later = Window.partitionBy("at", "on").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("beyond", F.coalesce(F.sum("n").over(later), F.lit(0))).drop("n")
    sweep = Window.partitionBy("at", "on", "slot").orderBy(F.desc("time"), "n")
    swept = events.withColumn("within", F.sum("n").over(sweep.rowsBetween(Window.unboundedPreceding, 0)))
    found = swept.filter("n = 0").join(slots, ["at", "on", "slot"])
    found = store(found.select("at", "on", "time", (F.col("within") + F.col("beyond")).alias("connections")), "connections")
    answers = ins.join(broadcast_if(found, fits_in_memory(found)), ["at", "on", "time"])
    counted = answers.select(F.col("key").alias("__key"), "connections")
    return graph.edges.join(counted, F.col(edge_key) == F.col("__key"), "left").select(
        edge_key, F.coalesce("connections", F.lit(0)).cast("long").alias("connections")
    )


def _neighbours(pairs: DataFrame, name: str) -> DataFrame:
    """For each ``low`` the sorted ``high`` ends of ``pairs``."""
    return pairs.groupBy(F.col("low").alias("__of")).agg(F.sort_array(F.collect_list("high")).alias(name))


def closed_counts(graph: Graph) -> DataFrame:
    """Directed cycles of three different vertices through each vertex: ``id, cycles``.

    Every pair of joined vertices points from the end with fewer neighbours to the one with
    more.  A vertex then has at most as many higher neighbours as the square root of twice
    the number of pairs, so sets of them can be held in a row; a cycle is an element that
    two ends' sets have in common.  Vertices without a cycle are absent.  The rows formed are
    one per pair, and one per cycle for its third vertex, not one per pair of routes that
    meet.
    """
    routes = graph.by_route.edges.select("src", "dst").filter("src <> dst")
    # A cycle goes into each of its vertices and out again: ends where routes only start or
    # only arrive are on none.
    through = routes.select(F.col("src").alias("__id")).distinct()
    through = store(through.join(routes.select("dst"), F.col("__id") == F.col("dst"), "left_semi"), "through")
    side = broadcast_if(through, fits_in_memory(through))
    for end in ("src", "dst"):
        routes = routes.join(side, F.col(end) == F.col("__id"), "left_semi")
    a, b = F.least("src", "dst"), F.greatest("src", "dst")
    pairs = routes.groupBy(a.alias("a"), b.alias("b")).agg(
        F.bool_or(F.col("src") < F.col("dst")).alias("forth"), F.bool_or(F.col("src") > F.col("dst")).alias("back")
    )
    pairs = store(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    degrees = store(ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree")), "pair-degrees")
    degrees = broadcast_if(degrees, fits_in_memory(degrees))
    for end in ("a", "b"):
        pairs = pairs.join(degrees.toDF(end, f"degree_{end}"), end)
    up = (F.col("degree_a") < F.col("degree_b")) | (
        (F.col("degree_a") == F.col("degree_b")) & (F.col("a") < F.col("b"))
    )
    pairs = store(
        pairs.select(
            F.when(up, F.col("a")).otherwise(F.col("b")).alias("low"),
            F.when(up, F.col("b")).otherwise(F.col("a")).alias("high"),
            F.when(up, F.col("forth")).otherwise(F.col("back")).alias("to_high"),
            F.when(up, F.col("back")).otherwise(F.col("forth")).alias("to_low"),
        ),
        "oriented",
    )
    out = store(_neighbours(pairs.filter("to_high"), "out"), "out-neighbours")
    into = store(_neighbours(pairs.filter("to_low"), "into"), "into-neighbours")
    # low -> high -> third -> low, and high -> low -> third -> high: third is a higher neighbour
    # that ``near`` goes out to and that comes into ``from``.
    ways = [
        pairs.filter("to_high").select("low", "high", F.col("high").alias("near"), F.col("low").alias("from")),
        pairs.filter("to_low").select("low", "high", F.col("low").alias("near"), F.col("high").alias("from")),
    ]
    met = ways[0].unionByName(ways[1])
    # Only ways with both sets carry one: the names are asked first.
    for end, sets in (("near", out), ("from", into)):
        names = sets.select(F.col("__of").alias("__name"))
        met = met.join(broadcast_if(names, fits_in_memory(names)), F.col(end) == F.col("__name"), "left_semi")
    for end, sets in (("near", out), ("from", into)):
        met = met.join(broadcast_if(sets, fits_in_memory(sets)), F.col(end) == F.col("__of")).drop("__of")
    cycles = met.select("low", "high", F.array_intersect("out", "into").alias("thirds")).filter(F.size("thirds") > 0)
    cycles = store(cycles, "cycles")
    number = F.size("thirds").cast("long")
    credits = cycles.select(F.explode(F.array("low", "high")).alias("id"), number.alias("n"))
    credits = credits.unionByName(cycles.select(F.explode("thirds").alias("id"), F.lit(1).cast("long").alias("n")))
    return credits.groupBy("id").agg(F.sum("n").alias("cycles"))


def no_return_counts(graph: Graph) -> DataFrame:
    """Per vertex a the matches of a -> b -> c without c -> a, c other than a: ``id, matches``.

    Over distinct routes, as many as ``find`` would return for vertex a, but counted: all
    two-hops, less those that come back to a, less those that a third hop closes.  Vertices
    of the graph without a match have 0.
    """
    routes = graph.by_route.edges.select("src", "dst")
    outs = store(routes.groupBy("src").agg(F.count(F.lit(1)).alias("n")), "out-counts")
    outs = outs.select(F.col("src").alias("__at"), "n")
    hops = routes.join(broadcast_if(outs, fits_in_memory(outs)), F.col("dst") == F.col("__at"))
    total = hops.groupBy(F.col("src").alias("id")).agg(F.sum("n").alias("hops"))
    # Distinct routes, so both ways between two vertices are two rows of one unordered pair.
    unordered = routes.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    both = unordered.agg(F.count(F.lit(1)).alias("ways")).filter("a = b or ways = 2")
    both = store(both.select("a", "b"), "both-ways")
    loops = both.filter("a = b").select(F.col("a").alias("__loop"))
    loops = broadcast_if(loops, fits_in_memory(loops))
    ends = both.select(F.explode(F.expr("if(a = b, array(struct(a, b)), array(struct(a, b), struct(b as a, a as b)))")).alias("p"))
    ends = ends.select("p.a", "p.b")
    back = ends.groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("back"))
    # A loop at a or at the other end closes a two-hop of two vertices only:
    # a -> a -> c -> a and a -> c -> c -> a.
    apart = ends.filter("a <> b")
    at_start = apart.join(loops, F.col("a") == F.col("__loop")).groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("closed"))
    at_end = apart.join(loops, F.col("b") == F.col("__loop")).groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("closed"))
    closed = closed_counts(graph).withColumnRenamed("cycles", "closed").unionByName(at_start).unionByName(at_end)
    closed = closed.groupBy("id").agg(F.sum("closed").alias("closed"))
    counts = graph.vertices.select("id").join(total, "id", "left").join(back, "id", "left").join(closed, "id", "left")
    left = F.coalesce("hops", F.lit(0)) - F.coalesce("back", F.lit(0)) - F.coalesce("closed", F.lit(0))
    return counts.select("id", left.cast("long").alias("matches"))
