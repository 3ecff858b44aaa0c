"""Pattern matching: joins of edges that share vertices."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .graph import Graph
from .reports import first_per_group
from .skew import COPY, PART, broadcast_if, fits_in_memory


class Hop(NamedTuple):
    """One edge of a pattern: vertex names, and a name if the edge is wanted in the result."""

    src: str
    dst: str
    edge: str | None = None
    absent: bool = False


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def find(graph: Graph, pattern: Sequence[Hop], where: str | Column | None = None) -> DataFrame:
    """Every assignment of vertices and edges to the pattern's names.

    Named vertices and edges become struct columns.  Different names may stand for the
    same vertex.  Hops must connect; an absent hop must run between vertices named by
    the others and keeps the matches that have no such edge.  ``where`` is a condition
    on the structs; Catalyst carries its parts to the scan or into the joins.

    The result holds every match, so its size is the pattern's own: with parallel
    edges match on ``graph.by_route`` unless the edges themselves are wanted.
    """
    present = [hop for hop in pattern if not hop.absent]
    if not present:
        raise ValueError("a pattern needs at least one present hop")
    matches, bound = None, []
    for hop in present:
        matches = _extend(graph, matches, bound, hop)
        bound += [end for end in dict.fromkeys((hop.src, hop.dst)) if end not in bound]

    small = graph.small_vertices
    for name in bound:
        # Joined on a plain column, so that a condition on the vertex's id also reaches
        # the scan of the edges.
        at = f"__at_{name}"
        vertex = graph.vertices.select(F.col("id").alias(at), _row(graph.vertices).alias(name))
        matches = matches.join(broadcast_if(vertex, small), F.col(_id(name)) == F.col(at))
    if where is not None:
        matches = matches.filter(where)
    for hop in pattern:
        if not hop.absent:
            continue
        if hop.src not in bound or hop.dst not in bound:
            raise ValueError(f"absent hop {hop.src} to {hop.dst} must join named vertices")
        # The distinct routes say as much about an absent edge as the edges do.
        closing = graph.by_route.edges.select(F.col("src").alias("__s"), F.col("dst").alias("__d"))
        matches = matches.join(
            closing,
            (F.col(_id(hop.src)) == F.col("__s")) & (F.col(_id(hop.dst)) == F.col("__d")),
            "left_anti",
        )

    named = [name for hop in present for name in (hop.src, hop.edge, hop.dst) if name]
    return matches.select(*[F.col(f"`{name}`") for name in dict.fromkeys(named)])


def _id(name: str) -> str:
    return f"__id_{name}"


def _extend(graph: Graph, matches: DataFrame | None, bound: list[str], hop: Hop) -> DataFrame:
    """Join one more hop to the matches, on the ends already bound."""
    row = _row(graph.edges)
    edges = graph.edges.select(
        F.col("src").alias("__s"),
        F.col("dst").alias("__d"),
        *([row.alias(hop.edge)] if hop.edge else []),
    )
    if hop.src == hop.dst:
        edges = edges.filter(F.col("__s") == F.col("__d"))
    if matches is None:
        keep = edges.withColumn(_id(hop.src), F.col("__s"))
        return keep.withColumn(_id(hop.dst), F.col("__d")).drop("__s", "__d")

    shared = {"__s": hop.src, "__d": hop.dst}
    shared = {end: name for end, name in shared.items() if name in bound}
    if not shared:
        raise ValueError("each hop must share a vertex with the ones before it")
    condition = F.lit(True)
    for end, name in shared.items():
        condition = condition & (F.col(end) == F.col(_id(name)))
    if len(shared) == 1:
        # One shared vertex: its edges may be a large part of the table.
        [(end, name)] = shared.items()
        hot = graph.hot_sources if end == "__s" else graph.hot_targets
        other = "__d" if end == "__s" else "__s"
        spread = F.struct(other, hop.edge) if hop.edge else F.col(other)
        edges = hot.divide(edges, F.col(end), spread)
        matches = hot.copy(matches, F.col(_id(name)))
        condition = hot.match(condition)
    joined = matches.join(edges, condition).drop(PART, COPY)
    for end, name in (("__s", hop.src), ("__d", hop.dst)):
        if name not in bound:
            joined = joined.withColumn(_id(name), F.col(end))
    return joined.drop("__s", "__d")


def first_two_hops(
    graph: Graph,
    start: str | Column,
    end: str | Column,
    n: int,
    edge_key: str = "id",
) -> DataFrame:
    """The first ``n`` matches of a -ab-> b -bc-> c, ordered by the keys of ab and bc.

    ``start`` and ``end`` are conditions on the vertices a and c.  Only the first ``n``
    edges ab that have any bc can be in the result, each with the ``n`` smallest bc of its
    vertex; so at most n * n pairs are formed, and only edges that leave the targets of
    those ``n`` are looked at for bc.  Edges with equal keys are ordered by
    their ends, so the result is one and the same if key and ends identify an edge.
    """
    small = graph.small_vertices
    ids = lambda condition: broadcast_if(graph.vertices.filter(condition).select("id"), small)
    middles, starts, ends = graph.vertex_side("id"), ids(start), ids(end)
    edges = graph.edges
    into = edges.join(starts, edges.src == starts.id, "left_semi")
    into = into.join(middles, into.dst == middles.id, "left_semi")
    out_of = edges.join(ends, edges.dst == ends.id, "left_semi")

    order = [edge_key, "src", "dst"]
    # Which vertices lead on: one row each, however many edges leave them.
    onward = store(out_of.select(F.col("src").alias("__at")).distinct(), "onward")
    onward = broadcast_if(onward, fits_in_memory(onward))
    into = into.join(onward, into.dst == F.col("__at"), "left_semi").orderBy(*order).limit(n)
    into = store(into, "first-hops")
    ab = into.select(_row(edges).alias("ab"))
    reached = into.select(F.col("dst").alias("__from")).distinct()
    reached = broadcast_if(reached, fits_in_memory(reached))
    out_of = out_of.join(reached, out_of.src == F.col("__from"), "left_semi")
    bc = first_per_group(out_of, ["src"], order, n).select(_row(edges).alias("bc"))
    pairs = (
        ab.join(bc, F.col("ab.dst") == F.col("bc.src"))
        .orderBy(*[f"{e}.`{c}`" for e in ("ab", "bc") for c in order])
        .limit(n)
    )
    return _with_vertices(graph, pairs)


def first_connections(
    graph: Graph,
    n: int,
    where: str | Column = "arrdelay > 40",
    day: str = "fldate",
    arrives: str | Column = "crsdephour + arrdelay",
    leaves: str | Column = "crsdephour + depdelay",
    start: str | Column | None = None,
    via: str | Column | None = None,
    end: str | Column | None = None,
    edge_key: str = "id",
) -> DataFrame:
    """The first ``n`` same-day connections a -ab-> b -bc-> c, ordered by the keys of ab, bc.

    Both edges meet ``where`` and share ``day``; ``leaves`` of bc exceeds ``arrives`` of
    ab.  The defaults add minutes to hours, as the query this mirrors does.  ``start``,
    ``via`` and ``end`` are conditions on the vertices.

    An edge ab has a connection exactly when the latest bc of its vertex and day leaves
    after it arrives.  So the first ``n`` edges ab with a connection are found by one
    aggregate and one join, and only those ``n`` are paired.
    """
    as_column = lambda e: F.expr(e) if isinstance(e, str) else e
    edges = graph.edges.filter(where).select(
        _row(graph.edges).alias("edge"),
        "src",
        "dst",
        F.col(day).alias("day"),
        F.col(edge_key).alias("key"),
        as_column(arrives).alias("arrives"),
        as_column(leaves).alias("leaves"),
    )
    small = graph.small_vertices

    def touching(df: DataFrame, column: str, condition) -> DataFrame:
        vertices = graph.vertices if condition is None else graph.vertices.filter(condition)
        ids = broadcast_if(vertices.select(F.col("id").alias("__v")), small)
        return df.join(ids, F.col(column) == F.col("__v"), "left_semi")

    into = touching(touching(edges, "src", start), "dst", via)
    out_of = touching(touching(edges, "src", via), "dst", end)

    latest = store(
        out_of.groupBy(F.col("src").alias("at"), F.col("day").alias("on")).agg(
            F.max("leaves").alias("latest")
        ),
        "latest",
    )
    latest = broadcast_if(latest, fits_in_memory(latest))
    connected = (
        into.join(
            latest,
            (F.col("dst") == F.col("at"))
            & (F.col("day") == F.col("on"))
            & (F.col("latest") > F.col("arrives")),
        )
        .orderBy("key")
        .limit(n)
        .select(F.col("edge").alias("ab"), F.col("dst").alias("at"), F.col("day").alias("on"), "arrives")
    )
    # At most n rows, but n is the caller's: look before copying them everywhere.
    connected = store(connected, "connected")
    connected = broadcast_if(connected, fits_in_memory(connected))
    out_of = out_of.select(F.col("edge").alias("bc"), "src", "day", "leaves")
    pairs = (
        out_of.join(
            connected,
            (F.col("at") == F.col("src"))
            & (F.col("on") == F.col("day"))
            & (F.col("leaves") > F.col("arrives")),
        )
        .orderBy(f"ab.`{edge_key}`", f"bc.`{edge_key}`")
        .limit(n)
        .select("ab", "bc")
    )
    return _with_vertices(graph, pairs)


def _with_vertices(graph: Graph, pairs: DataFrame) -> DataFrame:
    """Add the vertex structs a, b, c to a handful of pairs ab, bc."""
    small = graph.small_vertices
    for name, at in (("a", "ab.src"), ("b", "ab.dst"), ("c", "bc.dst")):
        vertex = graph.vertices.select(_row(graph.vertices).alias(name))
        pairs = pairs.join(broadcast_if(vertex, small), F.col(at) == F.col(f"{name}.id"))
    return pairs.select("a", "ab", "b", "bc", "c")
