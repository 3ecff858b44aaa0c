"""What Spark makes of the queries."""

import pytest
from pyspark.sql import functions as F

from lanewise import plans
from lanewise.operators.motifs import Hop, find
from lanewise.operators.quality import confusion
from lanewise.plans.standin import flight_graph, flights, scored_flights
from lanewise.session import run_folder, scratch_root

SF = "/root/testdata/sf0.001"
QUERIES = plans.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("ml_", "stream_"))))
def test_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize(
    "name",
    ["filter_hour_eq", "longest_delays", "longest_delays_far", "longest_delays_sql",
     "top_delayed_dst", "top_routes", "graph_in_degrees", "graph_agg_messages"],
)
def test_top_k_is_fused(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_filter_and_columns_reach_the_scan(spark):
    text = formatted(QUERIES["top_delayed_dst"](spark, SF))
    assert "GreaterThan(depdelay,40.0)" in text
    assert "ReadSchema: struct<dst:string,depdelay:double>" in text


def test_confusion_reads_once(spark):
    assert plan(confusion(scored_flights(spark, SF))).count("FileScan") == 1


def test_counting_is_partial_first(spark):
    assert "partial_count" in plan(QUERIES["count_by_carrier"](spark, SF))


def test_first_matches_are_limited_before_the_shuffle(spark):
    text = plan(QUERIES["graph_motif_two_hop"](spark, SF))
    assert "Partial" in text and "WindowGroupLimit" in text
    # The first edges ab are limited and written before; here the pairs are.
    assert "TakeOrderedAndProject" in text


def test_flights_are_all_order_lines(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    derived = flights(spark, SF)
    assert derived.count() == derived.select("id").distinct().count() == lines
    assert derived.select("src", "dst").distinct().count() <= 100


def test_vertex_conditions_reach_the_edge_scan(spark):
    hops = [Hop("a", "b", "ab"), Hop("b", "c", "bc")]
    df = find(flight_graph(spark, SF), hops, where="a.id = 'N1' and c.id = 'N2' and ab.fldate = bc.fldate")
    text = formatted(df)
    assert "EqualTo(src,N1)" in text and "EqualTo(dst,N2)" in text


def test_messages_move_only_what_they_use(spark):
    text = formatted(QUERIES["graph_agg_messages"](spark, SF))
    assert "ReadSchema: struct<src:string,dst:string,depdelay:double>" in text


def test_flights_are_derived_once(spark):
    location = lambda: flights(spark, SF).inputFiles()
    assert location() == location()
    assert all(run_folder(spark) in f for f in location())


def test_scratch_folder_is_the_named_one(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        assert scratch_root(spark) == named.rstrip("/")


def test_loops_cut_their_lineage(spark):
    ranked = QUERIES["graph_pagerank"](spark, SF)
    assert plan(ranked).count("Join") <= 1
    hops = QUERIES["graph_hops_parties"](spark, SF)
    assert "Join" not in plan(hops.select(F.col("id")))
