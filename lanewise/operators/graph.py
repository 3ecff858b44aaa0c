"""A property graph held as two tables, and the queries that need one pass over it."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .skew import HotKeys, broadcast_if, fits_in_memory, hot_keys, parts_for


@dataclass(frozen=True, eq=False)
class Graph:
    """Vertices with a unique ``id``; edges with ``src`` and ``dst``.

    Both may carry any other columns.  Parallel edges and self-loops are allowed.
    Edges to ids that are not vertices count in the degrees and are ignored by
    everything that follows edges.
    """

    vertices: DataFrame
    edges: DataFrame

    def __post_init__(self):
        if "id" not in self.vertices.columns:
            raise ValueError("vertices need a column id")
        if not {"src", "dst"} <= set(self.edges.columns):
            raise ValueError("edges need columns src and dst")

    # -- derived tables ------------------------------------------------------

    @cached_property
    def small_vertices(self) -> bool:
        """Whether the vertex table, attributes included, may be broadcast."""
        return fits_in_memory(self.vertices)

    def vertex_side(self, *columns: str | Column) -> DataFrame:
        """Vertices as the small side of a join, if they are in fact small."""
        picked = self.vertices.select(*columns) if columns else self.vertices
        return broadcast_if(picked, self.small_vertices)

    def sound_edges(self) -> DataFrame:
        """Edges both of whose ends are vertices."""
        ids = self.vertex_side("id")
        edges = self.edges
        edges = edges.join(ids, edges.src == ids.id, "left_semi")
        return edges.join(ids, edges.dst == ids.id, "left_semi")

    @cached_property
    def by_route(self) -> "Graph":
        """The same vertices with one edge per route, carrying its number of ``flights``.

        Written once, for the patterns and loops that read routes again and again.
        Counting comes before the vertex check, so the check sees routes, not edges.
        """
        counted = self.edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("flights"))
        sound = Graph(self.vertices, counted).sound_edges()
        with parts_for(sound.sparkSession, self.edges.count()):
            return Graph(self.vertices, store(sound, "routes"))

    @cached_property
    def hot_sources(self) -> HotKeys:
        return hot_keys(self.edges, "src")

    @cached_property
    def hot_targets(self) -> HotKeys:
        return hot_keys(self.edges, "dst")

    # -- degrees -------------------------------------------------------------

    def in_degrees(self) -> DataFrame:
        """Edges arriving at each vertex that has any."""
        return _count_ends(self.edges, F.col("dst"), "inDegree")

    def out_degrees(self) -> DataFrame:
        """Edges leaving each vertex that has any."""
        return _count_ends(self.edges, F.col("src"), "outDegree")

    def degrees(self) -> DataFrame:
        """Edges at each vertex that has any; a self-loop counts twice."""
        return _count_ends(self.edges, F.explode(F.array("src", "dst")), "degree")

    # -- messages ------------------------------------------------------------

    def triplets(self, last: str = "dst") -> DataFrame:
        """Each sound edge with its ends, as structs ``src, edge, dst``.

        Only the attributes a query goes on to use are read and moved.  The end named
        ``last`` is joined last: where vertices are shuffled, the rows then lie by it.
        """
        edges = self.edges.select(
            F.struct(*[F.col(f"`{c}`") for c in self.edges.columns]).alias("edge")
        )
        ends = [F.struct(*[F.col(f"`{c}`") for c in self.vertices.columns]).alias("end")]
        side = broadcast_if(self.vertices.select(*ends), self.small_vertices)
        src, dst = side.withColumnRenamed("end", "src"), side.withColumnRenamed("end", "dst")
        joins = [
            (src, F.col("edge.src") == F.col("src.id")),
            (dst, F.col("edge.dst") == F.col("dst.id")),
        ]
        for vertices, matches in joins if last == "dst" else reversed(joins):
            edges = edges.join(vertices, matches)
        return edges.select("src", "edge", "dst")

    def aggregate_messages(
        self,
        aggregates: Sequence[Column],
        to_src: Column | str | None = None,
        to_dst: Column | str | None = None,
    ) -> DataFrame:
        """Send a value along every edge to its source, target or both; aggregate per vertex.

        Messages are expressions over ``src.*``, ``edge.*`` and ``dst.*``; the
        aggregates read them as column ``msg``.  Vertices that get no message are
        absent.
        """
        if to_src is None and to_dst is None:
            raise ValueError("give a message to the source, the target or both")
        as_column = lambda m: F.expr(m) if isinstance(m, str) else m
        # The receiving end comes last, so that the aggregate finds its rows in place.
        triplets = self.triplets("src" if to_dst is None else "dst")
        mail = []
        if to_src is not None:
            mail.append((F.col("src.id"), as_column(to_src)))
        if to_dst is not None:
            mail.append((F.col("dst.id"), as_column(to_dst)))
        if len(mail) == 1:
            sent = triplets.select(mail[0][0].alias("id"), mail[0][1].alias("msg"))
        else:
            pairs = [F.struct(i.alias("id"), m.alias("msg")) for i, m in mail]
            sent = triplets.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")
        return sent.groupBy("id").agg(*aggregates)


def _count_ends(edges: DataFrame, end: Column, name: str) -> DataFrame:
    ends = edges.select(end.alias("id")).filter(F.col("id").isNotNull())
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias(name))
