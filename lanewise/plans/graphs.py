"""Graph queries over airports and flights, and over the larger party graph."""

from pyspark.sql import functions as F

from ..operators.counting import connection_counts, no_return_counts
from ..operators.motifs import Hop, find, first_connections, first_two_hops
from ..operators.paths import breadth_first, hop_counts, path_texts, shortest_paths
from ..operators.rank import edge_weights, page_rank
from .registry import register
from .standin import flight_graph, party_graph


def _on_graph(operator, graph=flight_graph):
    return lambda spark, sf: operator(graph(spark, sf))


def _ids(*names):
    return [F.col(f"{name}.id").alias(f"{name}_id") for name in names]


register("graph_edges", _on_graph(lambda g: g.edges), "SELECT * FROM flights")

# -- degrees -----------------------------------------------------------------

_ENDS = "(SELECT src AS id FROM {e} UNION ALL SELECT dst AS id FROM {e})"

register(
    "graph_in_degrees",
    _on_graph(lambda g: g.in_degrees().orderBy(F.desc("inDegree"), "id").limit(3)),
    """SELECT dst AS id, count(*) AS "inDegree" FROM flights GROUP BY dst
       ORDER BY 2 DESC, 1 LIMIT 3""",
)
register(
    "graph_out_degrees",
    _on_graph(lambda g: g.out_degrees().orderBy(F.desc("outDegree"), "id").limit(3)),
    """SELECT src AS id, count(*) AS "outDegree" FROM flights GROUP BY src
       ORDER BY 2 DESC, 1 LIMIT 3""",
)
register(
    "graph_degrees",
    _on_graph(lambda g: g.degrees().orderBy(F.desc("degree"), "id")),
    f"SELECT id, count(*) AS degree FROM {_ENDS.format(e='flights')} AS ends GROUP BY id",
)
register(
    "graph_degrees_parties",
    _on_graph(lambda g: g.degrees(), party_graph),
    f"SELECT id, count(*) AS degree FROM {_ENDS.format(e='party_edges')} AS ends GROUP BY id",
)

# -- rank --------------------------------------------------------------------


def _rank_sql(edges: str, vertices: str, steps: int = 10) -> str:
    """The rank recurrence, one CTE per step."""
    parts = [
        f""", routes AS (
             SELECT src, dst, count(*) AS m FROM {edges}
             WHERE src IN (SELECT id FROM {vertices}) AND dst IN (SELECT id FROM {vertices})
             GROUP BY src, dst),
           outs AS (SELECT src, sum(m) AS n FROM routes GROUP BY src),
           weights AS (SELECT src, dst, m / n AS w FROM routes JOIN outs USING (src)),
           r0 AS (SELECT id, 1.0::DOUBLE AS r FROM {vertices})"""
    ]
    for i in range(1, steps + 1):
        parts.append(
            f""", g{i} AS MATERIALIZED (
                 SELECT dst AS id, sum(r * w) AS got FROM weights JOIN r{i - 1} ON src = r{i - 1}.id
                 GROUP BY dst),
               r{i} AS MATERIALIZED (
                 SELECT v.id, 0.15 + 0.85 * coalesce(got, 0) AS r
                 FROM {vertices} v LEFT JOIN g{i} ON v.id = g{i}.id)"""
        )
    return "".join(parts) + (
        f" SELECT id, round(r * (SELECT count(*) / sum(r) FROM r{steps}), 6) AS pagerank FROM r{steps}"
    )


_ranked = lambda g: page_rank(g).vertices.select("id", F.round("pagerank", 6).alias("pagerank"))
register(
    "graph_pagerank",
    _on_graph(lambda g: _ranked(g).orderBy(F.desc("pagerank"), "id")),
    _rank_sql("flights", "airports"),
)
register(
    "graph_pagerank_parties", _on_graph(_ranked, party_graph), _rank_sql("party_edges", "parties")
)
register(
    "graph_pagerank_weights",
    _on_graph(lambda g: edge_weights(g).select("id", F.round("weight", 9).alias("weight"))),
    """SELECT id, round(1.0 / count(*) OVER (PARTITION BY src), 9)::DOUBLE AS weight
       FROM flights""",
)

# -- messages ----------------------------------------------------------------

register(
    "graph_agg_messages",
    _on_graph(
        lambda g: g.aggregate_messages([F.avg("msg").alias("avgdepdelay")], to_src="edge.depdelay")
        .orderBy(F.desc("avgdepdelay"), "id")
        .limit(5)
    ),
    """SELECT src AS id, avg(depdelay) AS avgdepdelay FROM flights
       JOIN airports a ON src = a.id JOIN airports b ON dst = b.id
       GROUP BY src ORDER BY 2 DESC, 1 LIMIT 5""",
)

# -- motifs ------------------------------------------------------------------

_NO_RETURN = [Hop("a", "b"), Hop("b", "c"), Hop("c", "a", absent=True)]
register(
    "graph_motif_no_return",
    _on_graph(
        lambda g: find(g.by_route, _NO_RETURN, where="c.id != a.id").select(
            *_ids("a", "b", "c")
        )
    ),
    """, r AS (SELECT DISTINCT src, dst FROM flights)
       SELECT x.src AS a_id, x.dst AS b_id, y.dst AS c_id FROM r x JOIN r y ON x.dst = y.src
       WHERE y.dst <> x.src
         AND NOT EXISTS (SELECT 1 FROM r z WHERE z.src = y.dst AND z.dst = x.src)""",
)
_NO_RETURN_COUNTS = """, r AS (SELECT DISTINCT src, dst FROM {edges}
                      WHERE src IN (SELECT id FROM {vertices}) AND dst IN (SELECT id FROM {vertices})),
      m AS (SELECT x.src AS id, count(*) AS n FROM r x JOIN r y ON x.dst = y.src
            WHERE y.dst <> x.src
              AND NOT EXISTS (SELECT 1 FROM r z WHERE z.src = y.dst AND z.dst = x.src)
            GROUP BY x.src)
      SELECT v.id, coalesce(n, 0)::BIGINT AS matches FROM {vertices} v LEFT JOIN m ON v.id = m.id"""
register(
    "graph_no_return_counts",
    _on_graph(no_return_counts),
    _NO_RETURN_COUNTS.format(edges="flights", vertices="airports"),
)
register(
    "graph_no_return_counts_parties",
    _on_graph(no_return_counts, party_graph),
    _NO_RETURN_COUNTS.format(edges="party_edges", vertices="parties"),
)
register(
    "graph_connection_counts",
    _on_graph(connection_counts),
    """, c AS (SELECT ab.id, count(*) AS n FROM flights ab
              JOIN flights bc ON ab.dst = bc.src AND ab.fldate = bc.fldate
              WHERE ab.arrdelay > 40 AND bc.arrdelay > 40
                AND bc.crsdephour + bc.depdelay > ab.crsdephour + ab.arrdelay
              GROUP BY ab.id)
       SELECT f.id, coalesce(n, 0)::BIGINT AS connections FROM flights f LEFT JOIN c ON f.id = c.id""",
)
register(
    "graph_motif_two_hop",
    _on_graph(
        lambda g: first_two_hops(g, "id = 'N0'", "id = 'N3'", 4).select(
            *_ids("a", "ab", "b", "bc", "c")
        )
    ),
    """SELECT ab.src AS a_id, ab.id AS ab_id, ab.dst AS b_id, bc.id AS bc_id, bc.dst AS c_id
       FROM flights ab JOIN flights bc ON ab.dst = bc.src
       WHERE ab.src = 'N0' AND bc.dst = 'N3' ORDER BY ab.id, bc.id LIMIT 4""",
)
register(
    "graph_delayed_connections",
    _on_graph(lambda g: first_connections(g, 20).select(*_ids("a", "ab", "b", "bc", "c"))),
    """SELECT ab.src AS a_id, ab.id AS ab_id, ab.dst AS b_id, bc.id AS bc_id, bc.dst AS c_id
       FROM flights ab JOIN flights bc ON ab.dst = bc.src AND ab.fldate = bc.fldate
       WHERE ab.arrdelay > 40 AND bc.arrdelay > 40
         AND bc.crsdephour + bc.depdelay > ab.crsdephour + ab.arrdelay
       ORDER BY ab.id, bc.id LIMIT 20""",
)

register(
    "graph_delayed_connections_between",
    _on_graph(
        lambda g: first_connections(
            g, 20, start="id = 'N0'", via="region >= 1", end="id <> 'N0'"
        ).select(*_ids("a", "ab", "b", "bc", "c"))
    ),
    """SELECT ab.src AS a_id, ab.id AS ab_id, ab.dst AS b_id, bc.id AS bc_id, bc.dst AS c_id
       FROM flights ab JOIN flights bc ON ab.dst = bc.src AND ab.fldate = bc.fldate
       JOIN airports b ON b.id = ab.dst AND b.region >= 1
       WHERE ab.arrdelay > 40 AND bc.arrdelay > 40 AND ab.src = 'N0' AND bc.dst <> 'N0'
         AND bc.crsdephour + bc.depdelay > ab.crsdephour + ab.arrdelay
       ORDER BY ab.id, bc.id LIMIT 20""",
)
register(
    "graph_vertices", _on_graph(lambda g: g.vertices), 'SELECT id, "City", region FROM airports'
)

# -- paths -------------------------------------------------------------------

register(
    "graph_bfs_1",
    _on_graph(lambda g: path_texts(breadth_first(g, "id = 'N0'", "id = 'N1'", max_length=1))),
    """SELECT 'N0,N1' AS path, id AS edges, 1 AS hops FROM flights
       WHERE src = 'N0' AND dst = 'N1'""",
)
register(
    "graph_bfs_2",
    _on_graph(
        lambda g: path_texts(breadth_first(g, "id = 'N0'", "id = 'N3'", max_length=2, first=4))
    ),
    """SELECT 'N0,' || ab.dst || ',N3' AS path, ab.id || ',' || bc.id AS edges, 2 AS hops
       FROM flights ab JOIN flights bc ON ab.dst = bc.src
       WHERE ab.src = 'N0' AND bc.dst = 'N3'
         AND NOT EXISTS (SELECT 1 FROM flights WHERE src = 'N0' AND dst = 'N3')
       ORDER BY ab.id, bc.id LIMIT 4""",
)


def _hops_sql(edges: str, vertices: str, landmarks: list[str], most: int) -> str:
    listed = ", ".join(f"'{x}'" for x in landmarks)
    return f""", routes AS (SELECT DISTINCT src, dst FROM {edges}
                            WHERE src IN (SELECT id FROM {vertices})),
      walk(id, landmark, hops) AS (
        SELECT id, id, 0 FROM {vertices} WHERE id IN ({listed})
        UNION
        SELECT src, landmark, hops + 1 FROM walk JOIN routes ON dst = id WHERE hops < {most})
      SELECT id, landmark, min(hops)::INTEGER AS hops FROM walk GROUP BY id, landmark"""


register(
    "graph_shortest_paths",
    _on_graph(
        lambda g: shortest_paths(g, ["N1", "N5"]).select(
            "id", F.explode("distances").alias("landmark", "hops")
        )
    ),
    _hops_sql("flights", "airports", ["N1", "N5"], 25),
    recursive=True,
)
register(
    "graph_hops_parties",
    _on_graph(lambda g: hop_counts(g, ["P1", "P50"]), party_graph),
    _hops_sql("party_edges", "parties", ["P1", "P50"], 16),
    recursive=True,
)
#: Every third party, five hundred of them: more than one word of bits a vertex.
_MANY = [f"P{3 * i + 1}" for i in range(500)]
register(
    "graph_hops_many",
    _on_graph(lambda g: hop_counts(g, _MANY), party_graph),
    _hops_sql("party_edges", "parties", _MANY, 8),
    recursive=True,
)
