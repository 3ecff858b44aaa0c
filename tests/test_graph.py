"""Graph queries on hand-made graphs, and against brute force on random ones."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from lanewise.operators.counting import closed_counts, connection_counts, no_return_counts
from lanewise.operators.graph import Graph
from lanewise.operators.motifs import Hop, find, first_connections, first_two_hops
from lanewise.operators import paths
from lanewise.operators.paths import breadth_first, hop_counts, path_texts, search_sizes, shortest_paths
from lanewise.operators.rank import page_rank
from lanewise.session import ROWS_PER_SPLIT

EDGE = "id string, src string, dst string"


def graph_of(spark, vertices, pairs):
    edges = [(f"e{i:03d}", s, d) for i, (s, d) in enumerate(pairs)]
    return Graph(
        spark.createDataFrame([(v, f"city {v}") for v in vertices], "id string, City string"),
        spark.createDataFrame(edges, EDGE),
    )


@pytest.fixture(scope="module")
def small(spark):
    """A self-loop, parallel edges, a sink D, an isolated I, a dangling edge, a cycle."""
    pairs = [("A", "A"), ("A", "B"), ("A", "B"), ("A", "B"), ("B", "C"), ("C", "A"), ("C", "D"), ("A", "X")]
    return graph_of(spark, "ABCDI", pairs)


def pairs_of(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_columns_are_checked(spark):
    with pytest.raises(ValueError):
        Graph(spark.range(1).toDF("v"), spark.range(1).toDF("src"))
    with pytest.raises(ValueError):
        Graph(spark.range(1), spark.range(1).toDF("src"))


class TestDegrees:
    def test_counts(self, small):
        assert pairs_of(small.in_degrees(), "id", "inDegree") == [("A", 2), ("B", 3), ("C", 1), ("D", 1), ("X", 1)]
        assert pairs_of(small.out_degrees(), "id", "outDegree") == [("A", 5), ("B", 1), ("C", 2)]
        degrees = dict(pairs_of(small.degrees(), "id", "degree"))
        assert degrees == {"A": 7, "B": 4, "C": 3, "D": 1, "X": 1}

    def test_sums(self, small):
        total = lambda df, c: df.agg(F.sum(c)).first()[0]
        edges = small.edges.count()
        assert total(small.in_degrees(), "inDegree") == total(small.out_degrees(), "outDegree") == edges
        assert total(small.degrees(), "degree") == 2 * edges


class TestMessages:
    def test_to_source_ignores_dangling_edges(self, small):
        got = small.aggregate_messages([F.count("msg").alias("n")], to_src="edge.id")
        assert pairs_of(got, "id", "n") == [("A", 4), ("B", 1), ("C", 2)]

    def test_both_ways_with_vertex_attributes(self, small):
        got = small.aggregate_messages(
            [F.collect_set("msg").alias("m")], to_src="dst.City", to_dst=F.col("src.City")
        )
        met = {r.id: set(r.m) for r in got.collect()}
        assert met["D"] == {"city C"} and met["B"] == {"city A", "city C"}

    def test_needs_a_message(self, small):
        with pytest.raises(ValueError):
            small.aggregate_messages([F.count("msg")])


def brute_rank(vertices, pairs, steps=10, reset=0.15):
    sound = [(s, d) for s, d in pairs if s in vertices and d in vertices]
    out = {v: sum(1 for s, _ in sound if s == v) for v in vertices}
    rank = {v: 1.0 for v in vertices}
    for _ in range(steps):
        got = {v: 0.0 for v in vertices}
        for s, d in sound:
            got[d] += rank[s] / out[s]
        rank = {v: reset + (1 - reset) * got[v] for v in vertices}
    scale = len(vertices) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


class TestRank:
    PAIRS = [("A", "A"), ("A", "B"), ("A", "B"), ("A", "B"), ("B", "C"), ("C", "A"), ("C", "D"), ("A", "X")]

    def check(self, graph, vertices, pairs, **options):
        ranked = page_rank(graph, **options)
        got = {r.id: r.pagerank for r in ranked.vertices.collect()}
        want = brute_rank(vertices, pairs, options.get("iterations", 10))
        assert got.keys() == want.keys()
        assert all(got[v] == pytest.approx(want[v], abs=1e-9) for v in want)
        assert sum(got.values()) == pytest.approx(len(vertices))
        return ranked

    def test_sink_isolated_parallel_dangling(self, small):
        ranked = self.check(small, "ABCDI", self.PAIRS)
        weights = {(r.src, r.dst): r.weight for r in ranked.edges.collect()}
        assert weights == {("A", "A"): 0.25, ("A", "B"): 0.25, ("B", "C"): 1.0, ("C", "A"): 0.5, ("C", "D"): 0.5}
        assert ranked.vertices.columns == ["id", "City", "pagerank"]
        assert ranked.edges.count() == 7

    @pytest.mark.parametrize("settle_every", [1, 3, 20])
    def test_settling_does_not_matter(self, small, settle_every):
        self.check(small, "ABCDI", self.PAIRS, iterations=4, settle_every=settle_every)

    def test_large_tables_and_hot_sources(self, spark, no_broadcast):
        pairs = random_pairs(5, 12, 80) + [("V0", f"V{i}") for i in range(12)] * 2
        vertices = [f"V{i}" for i in range(12)]
        self.check(graph_of(spark, vertices, pairs), vertices, pairs, iterations=5)


def random_pairs(seed, vertices, edges):
    rng = random.Random(seed)
    return [(f"V{rng.randrange(vertices)}", f"V{rng.randrange(vertices)}") for _ in range(edges)]


def brute_hops(vertices, pairs, target):
    sound = {(s, d) for s, d in pairs if s in vertices and d in vertices}
    hops, ring = {target: 0}, {target}
    while ring:
        ring = {s for s, d in sound if d in ring} - set(hops)
        hops.update({v: max(hops.values()) + 1 for v in ring})
    return hops


class TestHops:
    def test_unreachable_has_an_empty_map(self, small):
        got = {r.id: r.distances for r in shortest_paths(small, ["D"]).collect()}
        assert got == {"A": {"D": 3}, "B": {"D": 2}, "C": {"D": 1}, "D": {"D": 0}, "I": {}}

    def test_several_landmarks_follow_direction(self, small):
        got = {r.id: r.distances for r in shortest_paths(small, ["A", "D"]).collect()}
        assert got["D"] == {"D": 0} and got["C"] == {"A": 1, "D": 1}

    def test_long_chain(self, spark):
        vertices = [f"V{i}" for i in range(9)]
        graph = graph_of(spark, vertices, list(zip(vertices, vertices[1:])))
        got = {r.id: r.hops for r in hop_counts(graph, ["V8"]).collect()}
        assert got == {f"V{i}": 8 - i for i in range(9)}

    def check(self, spark, seed):
        pairs, vertices = random_pairs(seed, 25, 40), [f"V{i}" for i in range(25)]
        graph = graph_of(spark, vertices, pairs)
        got = {(r.id, r.landmark): r.hops for r in hop_counts(graph, ["V0", "V7"]).collect()}
        want = {(v, t): h for t in ("V0", "V7") for v, h in brute_hops(vertices, pairs, t).items()}
        assert got == want

    def test_random(self, spark):
        self.check(spark, 3)

    def test_random_large_tables(self, spark, no_broadcast):
        self.check(spark, 4)


class TestBreadthFirst:
    def test_diamond_has_two_paths(self, spark):
        graph = graph_of(spark, "ABCD", [("A", "B"), ("A", "C"), ("B", "D"), ("C", "D"), ("D", "A")])
        paths = breadth_first(graph, "id = 'A'", "id = 'D'")
        assert paths.columns == ["from", "e0", "v1", "e1", "to"]
        assert pairs_of(path_texts(paths), "path", "edges", "hops") == [("A,B,D", "e000,e002", 2), ("A,C,D", "e001,e003", 2)]
        assert paths.first()["from"].City == "city A"

    def test_start_meets_end(self, small):
        paths = breadth_first(small, "id in ('A', 'B')", "id in ('B', 'C')")
        assert paths.columns == ["from", "to"]
        assert pairs_of(path_texts(paths), "path", "hops") == [("B", 0)]

    def test_no_path(self, small):
        paths = breadth_first(small, "id = 'D'", "id = 'A'")
        assert paths.columns == ["from", "to"] and paths.isEmpty()
        assert breadth_first(small, "id = 'A'", "id = 'X'").isEmpty()
        assert breadth_first(small, "id = 'Z'", "id = 'A'").isEmpty()

    def test_length_bound(self, small):
        assert breadth_first(small, "id = 'A'", "id = 'D'", max_length=2).isEmpty()
        assert breadth_first(small, "id = 'A'", "id = 'D'", max_length=3).count() == 3

    def test_only_the_least_length(self, spark):
        graph = graph_of(spark, "ABC", [("A", "C"), ("A", "B"), ("B", "C"), ("A", "C")])
        assert pairs_of(path_texts(breadth_first(graph, "id = 'A'", "id = 'C'")), "edges") == [("e000",), ("e003",)]

    def test_chained_diamonds_stay_bounded(self, spark):
        """2^8 shortest paths, of which no step keeps more than a few per vertex."""
        pairs, names = [], [f"v{i}" for i in range(9)]
        for i in range(8):
            pairs += [(names[i], f"u{i}"), (names[i], f"w{i}"), (f"u{i}", names[i + 1]), (f"w{i}", names[i + 1])]
        vertices = names + [f"{k}{i}" for k in "uw" for i in range(8)]
        graph = graph_of(spark, vertices, pairs)
        paths = breadth_first(graph, "id = 'v0'", "id = 'v8'", max_length=16, first=1)
        text = paths._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("row_number") >= 30
        [row] = path_texts(paths).collect()
        assert row.path.split(",")[1::2] == [f"u{i}" for i in range(8)]

    @pytest.mark.parametrize("first", [1, 4, 1000])
    def test_first_is_a_prefix_of_all(self, spark, first):
        pairs = random_pairs(8, 6, 60)
        graph = graph_of(spark, [f"V{i}" for i in range(6)], [p for p in pairs if p != ("V0", "V5")])
        everything = pairs_of(path_texts(breadth_first(graph, "id = 'V0'", "id = 'V5'")), "edges")
        got = breadth_first(graph, "id = 'V0'", "id = 'V5'", first=first)
        assert len(everything) > 4
        assert pairs_of(path_texts(got), "edges") == everything[:first]

    def test_large_tables(self, spark, no_broadcast):
        pairs = [p for p in random_pairs(9, 8, 60) if p != ("V0", "V5")]
        graph = graph_of(spark, [f"V{i}" for i in range(8)], pairs)
        want = sorted(
            (f"e{i:03d},e{j:03d}",)
            for (i, (s, m)), (j, (n, d)) in product(enumerate(pairs), enumerate(pairs))
            if s == "V0" and m == n and d == "V5"
        )
        assert pairs_of(path_texts(breadth_first(graph, "id = 'V0'", "id = 'V5'")), "edges") == want


def brute_two_hops(pairs, vertices):
    edges = [(f"e{i:03d}", s, d) for i, (s, d) in enumerate(pairs) if s in vertices and d in vertices]
    return [(x, y) for x, y in product(edges, edges) if x[2] == y[1]]


class TestMotifs:
    CLOSED = [Hop("a", "b"), Hop("b", "c"), Hop("c", "a", absent=True)]

    def test_cycle_has_no_open_pair(self, spark):
        graph = graph_of(spark, "ABC", [("A", "B"), ("B", "C"), ("C", "A")])
        assert find(graph.by_route, self.CLOSED, where="c.id != a.id").isEmpty()

    def test_open_pairs(self, small):
        got = find(small.by_route, self.CLOSED, where="c.id != a.id")
        assert got.columns == ["a", "b", "c"]
        assert pairs_of(got, "a.id", "b.id", "c.id") == [
            ("A", "A", "B"), ("B", "C", "D"), ("C", "A", "A"),
        ]

    def test_vertices_may_repeat(self, small):
        got = find(small, [Hop("a", "b", "ab"), Hop("b", "c", "bc")], where="a.id = 'A' and b.id = 'A'")
        assert got.columns == ["a", "ab", "b", "bc", "c"] and got.count() == 4

    def test_self_loop_pattern(self, small):
        got = find(small, [Hop("a", "a", "loop")])
        assert got.columns == ["a", "loop"] and pairs_of(got, "a.id") == [("A",)]

    def test_closed_triangle(self, small):
        got = find(small, [Hop("a", "b", "x"), Hop("b", "c", "y"), Hop("c", "a", "z")], where="a.id = 'B'")
        assert got.count() == 3

    def test_bad_patterns(self, small):
        with pytest.raises(ValueError):
            find(small, [Hop("a", "b"), Hop("c", "d")])
        with pytest.raises(ValueError):
            find(small, [Hop("a", "b"), Hop("b", "z", absent=True)])
        with pytest.raises(ValueError):
            find(small, [Hop("a", "b", absent=True)])

    def check(self, spark, seed):
        pairs, vertices = random_pairs(seed, 7, 50), [f"V{i}" for i in range(6)]
        graph = graph_of(spark, vertices, pairs)
        got = find(graph, [Hop("a", "b", "ab"), Hop("b", "c", "bc")])
        want = sorted((x[0], y[0]) for x, y in brute_two_hops(pairs, vertices))
        assert pairs_of(got, "ab.id", "bc.id") == want
        backwards = find(graph, [Hop("b", "c", "bc"), Hop("a", "b", "ab")])
        assert pairs_of(backwards, "ab.id", "bc.id") == want

    def test_random(self, spark):
        self.check(spark, 1)

    def test_random_hot_vertices(self, spark, no_broadcast):
        self.check(spark, 2)


class TestFirstMatches:
    @pytest.mark.parametrize("n", [1, 3, 17, 1000])
    def test_two_hops_are_a_prefix(self, spark, n):
        pairs, vertices = random_pairs(11, 7, 90), [f"V{i}" for i in range(6)]
        graph = graph_of(spark, vertices, pairs)
        want = sorted(
            (x[0], y[0])
            for x, y in brute_two_hops(pairs, vertices)
            if x[1] in ("V0", "V1") and y[2] == "V3"
        )
        got = first_two_hops(graph, "id in ('V0', 'V1')", "id = 'V3'", n)
        assert pairs_of(got, "ab.id", "bc.id") == want[:n]
        assert got.columns == ["a", "ab", "b", "bc", "c"]

    def connections(self, spark, n, seed, **ends):
        rng = random.Random(seed)
        vertices = [f"V{i}" for i in range(5)]
        rows = [
            (f"e{i:03d}", f"V{rng.randrange(6)}", f"V{rng.randrange(6)}", f"day{rng.randrange(3)}",
             rng.randrange(24), float(rng.randrange(120)), rng.choice([None, *map(float, range(120))]))
            for i in range(120)
        ]
        schema = EDGE + ", fldate string, crsdephour int, depdelay double, arrdelay double"
        graph = Graph(
            spark.createDataFrame([(v,) for v in vertices], "id string"),
            spark.createDataFrame(rows, schema),
        )
        late = [r for r in rows if r[1] in vertices and r[2] in vertices and r[6] is not None and r[6] > 40]
        want = sorted(
            (x[0], y[0])
            for x, y in product(late, late)
            if x[2] == y[1] and x[3] == y[3] and y[4] + y[5] > x[4] + x[6]
            and ("start" not in ends or x[1] == "V1") and ("end" not in ends or y[2] == "V2")
        )
        assert len(want) > 5
        assert pairs_of(first_connections(graph, n, **ends), "ab.id", "bc.id") == want[:n]
        return graph, want

    @pytest.mark.parametrize("n", [1, 6, 5000])
    def test_connections_are_a_prefix(self, spark, n):
        self.connections(spark, n, 21)

    def test_connections_between_given_ends(self, spark):
        self.connections(spark, 3, 22, start="id = 'V1'", end="id = 'V2'")

    def test_connections_large_tables(self, spark, no_broadcast):
        self.connections(spark, 10, 23)

    def test_connections_agree_with_the_general_pattern(self, spark):
        graph, want = self.connections(spark, 7, 24)
        got = find(
            graph,
            [Hop("a", "b", "ab"), Hop("b", "c", "bc")],
            where="ab.arrdelay > 40 and bc.arrdelay > 40 and ab.fldate = bc.fldate"
            " and bc.crsdephour + bc.depdelay > ab.crsdephour + ab.arrdelay",
        )
        assert pairs_of(got, "ab.id", "bc.id") == want


class TestManyLandmarks:
    def brute(self, vertices, pairs, landmarks):
        sound = {(s, d) for s, d in pairs if s in vertices and d in vertices}
        out = {}
        for mark in set(landmarks) & set(vertices):
            ring, seen, hops = {mark}, {mark: 0}, 0
            while ring:
                hops += 1
                ring = {s for s, d in sound if d in ring} - set(seen)
                seen.update(dict.fromkeys(ring, hops))
            out.update({(v, mark): n for v, n in seen.items()})
        return out

    def check(self, spark, count):
        vertices = [f"V{i}" for i in range(90)]
        pairs = random_pairs(31, 95, 400)
        landmarks = [f"V{i}" for i in range(count)] + ["V3", "nowhere"]
        graph = graph_of(spark, vertices, pairs)
        got = {(r.id, r.landmark): r.hops for r in hop_counts(graph, landmarks).collect()}
        assert got == self.brute(vertices, pairs, landmarks)

    @pytest.mark.parametrize("count", [1, 63, 64, 90])
    def test_words_of_bits(self, spark, count):
        self.check(spark, count)

    def test_several_sweeps_of_large_tables(self, spark, monkeypatch, no_broadcast):
        monkeypatch.setattr(paths, "_SWEEP", 32)
        self.check(spark, 70)

    def test_no_landmarks(self, spark):
        assert hop_counts(graph_of(spark, "AB", [("A", "B")]), []).isEmpty()

    def test_the_state_stays_where_it_is(self, spark, monkeypatch):
        """The join of what arrives with what was seen moves only what arrives."""
        plans = []
        real = paths._marked

        def seen(state, ring, words):
            out = real(state, ring, words)
            plans.append(out._jdf.queryExecution().executedPlan().toString())
            return out

        monkeypatch.setattr(paths, "_marked", seen)
        self.check(spark, 64)
        assert len(plans) > 2
        for text in plans[1:]:
            head = text.split("InMemoryRelation")[0]
            assert "InMemoryTableScan" in head and "Exchange hashpartitioning" not in head


class TestSearchSizes:
    def test_the_smaller_side_grows(self, spark):
        """The hubs behind the start are not entered: the end's side stays smaller."""
        pairs = [("S", "H"), ("S", "G"), ("x7", "M"), ("M", "E")]
        pairs += [(hub, f"x{i}") for i in range(40) for hub in ("HG"[i % 2],)]
        vertices = ["S", "H", "G", "M", "E"] + [f"x{i}" for i in range(40)]
        graph = graph_of(spark, vertices, pairs)
        assert search_sizes(graph, "id = 'S'", "id = 'E'") == ([1, 2], [1, 1, 1, 1])
        found = path_texts(breadth_first(graph, "id = 'S'", "id = 'E'")).first()
        assert found.path == "S,G,x7,M,E" and found.hops == 4

    @pytest.mark.parametrize("seed", [41, 42, 43])
    def test_all_shortest_paths(self, spark, seed):
        vertices = [f"V{i}" for i in range(14)]
        pairs = random_pairs(seed, 15, 26)
        graph = graph_of(spark, vertices, pairs)
        sound = [(f"e{i:03d}", s, d) for i, (s, d) in enumerate(pairs) if s in vertices and d in vertices]
        walks, want = [((), "V0")], []
        for _ in range(6):
            want = sorted(",".join(es) for es, at in walks if at == "V9")
            if want:
                break
            walks = [((*es, e), d) for es, at in walks for e, s, d in sound if s == at]
        got = breadth_first(graph, "id = 'V0'", "id = 'V9'", max_length=5)
        assert sorted(r.edges for r in path_texts(got).collect()) == want


class TestCounts:
    def brute_matches(self, vertices, pairs):
        routes = {(s, d) for s, d in pairs if s in vertices and d in vertices}
        counts = dict.fromkeys(vertices, 0)
        cycles = dict.fromkeys(vertices, 0)
        for (a, b), (m, c) in product(routes, routes):
            if b == m and c != a and (c, a) not in routes:
                counts[a] += 1
            if b == m and (c, a) in routes and len({a, b, c}) == 3:
                cycles[a] += 1
        return counts, {v: n for v, n in cycles.items() if n}

    def check(self, spark, seed, size, edges):
        vertices = [f"V{i}" for i in range(size)]
        # Loops, both ways, parallel edges and edges to no vertex are all in there.
        pairs = random_pairs(seed, size + 1, edges) + [("V0", "V0"), ("V1", "V1"), ("V0", "V1"), ("V1", "V0")]
        graph = graph_of(spark, vertices, pairs)
        counts, cycles = self.brute_matches(vertices, pairs)
        assert dict(pairs_of(no_return_counts(graph), "id", "matches")) == counts
        assert dict(pairs_of(closed_counts(graph), "id", "cycles")) == cycles

    @pytest.mark.parametrize("seed", [1, 2])
    def test_random(self, spark, seed):
        self.check(spark, seed, 9, 40)

    def test_large_tables(self, spark, no_broadcast):
        self.check(spark, 3, 12, 70)

    def test_fewer_rows_than_pairs(self, spark):
        """A star of both ways: its hub has 60 x 60 pairs of routes, no set grows with them."""
        spokes = [f"V{i}" for i in range(60)]
        pairs = [(s, "H") for s in spokes] + [("H", s) for s in spokes]
        graph = graph_of(spark, ["H", *spokes], pairs)
        assert closed_counts(graph).isEmpty()
        got = dict(pairs_of(no_return_counts(graph), "id", "matches"))
        assert got["H"] == 0 and got["V5"] == 59

    @pytest.mark.parametrize("slot", [60.0, 7.0, 1e9])
    def test_connections(self, spark, slot):
        rng = random.Random(5)
        vertices = [f"V{i}" for i in range(4)]
        rows = [
            (f"e{i:03d}", f"V{rng.randrange(5)}", f"V{rng.randrange(5)}", rng.choice(["day1", "day2", None]),
             rng.randrange(24), float(rng.randrange(-5, 90)), rng.choice([None, *map(float, range(90))]))
            for i in range(150)
        ]
        schema = EDGE + ", fldate string, crsdephour int, depdelay double, arrdelay double"
        graph = Graph(spark.createDataFrame([(v,) for v in vertices], "id string"), spark.createDataFrame(rows, schema))
        late = [r for r in rows if r[1] in vertices and r[2] in vertices and r[6] is not None and r[6] > 40]
        want = {r[0]: 0 for r in rows}
        for x, y in product(late, late):
            if x[2] == y[1] and x[3] == y[3] and x[3] and y[4] + y[5] > x[4] + x[6]:
                want[x[0]] += 1
        got = dict(pairs_of(connection_counts(graph, slot=slot), "id", "connections"))
        assert got == want and max(want.values()) > 2


def test_cycles_leave_out_ends_and_starts(spark, monkeypatch):
    """Routes of vertices that only start or only arrive close nothing and are not laid side
    by side; cycles both ways round, and with a two-way route, are counted."""
    from lanewise.operators import counting

    stored, real = {}, counting.store

    def seen(df, name):
        stored[name] = real(df, name)
        return stored[name]

    monkeypatch.setattr(counting, "store", seen)
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "b"), ("b", "a"), ("b", "d"), ("d", "e"), ("e", "b")]
    edges += [(f"s{i}", x) for i in range(30) for x in "abc"] + [(x, f"t{i}") for i in range(30) for x in "abc"]
    ids = sorted({v for e in edges for v in e})
    graph = Graph(spark.createDataFrame([(v,) for v in ids], "id string"), spark.createDataFrame(edges, "src string, dst string"))
    got = {r.id: r.cycles for r in counting.closed_counts(graph).collect()}
    routes, want = set(edges), {}
    for x, y in routes:
        for z in ids:
            if (y, z) in routes and (z, x) in routes and len({x, y, z}) == 3:
                want[x] = want.get(x, 0) + 1
    assert got == want and stored["pairs"].count() == 6


def test_routes_are_counted_in_bounded_parts(spark):
    """The number of parts follows the rows, not the session's number of partitions."""
    pairs = sorted({(f"v{i % 40}", f"v{i * 7 % 61}") for i in range(1500)})
    before = {key: spark.conf.get(key, None) for key in (ROWS_PER_SPLIT, "spark.sql.shuffle.partitions")}
    graph = graph_of(spark, [f"v{i}" for i in range(70)], pairs)
    spark.conf.set(ROWS_PER_SPLIT, "20")
    try:
        routes = graph.by_route.edges
        assert spark.conf.get("spark.sql.shuffle.partitions") == before["spark.sql.shuffle.partitions"]
    finally:
        spark.conf.unset(ROWS_PER_SPLIT)
    sizes = routes.groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] <= 60 and sizes[1] == len(pairs) > 1000
