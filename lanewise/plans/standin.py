"""Flights, airports and a larger graph, derived from the order tables.

A flight is an order line, every one of them.  It goes out from its supplier's nation; its
customer's nation picks one of four fixed steps to the nation it goes to (going to the
customer's nation itself would make the graph complete).  A
nation's airport is ``N<key>``.  The larger graph has a vertex per customer number and
an edge per order line, from the supplier's number to the customer's; its vertices
grow with the data, as the nations do not.
"""

from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import bucketize, route_name
from ..functions.buckets import LABEL_SPLITS
from ..operators.graph import Graph
from ..operators.skew import parts_for
from ..schemas import FLIGHTS
from ..session import new_folder, shuffles_let_go, store
from ..sources.folders import version_stamp

FLIGHT_TABLES = ("lineitem", "orders", "customer", "supplier", "part")

# The two engines differ in three expressions only.  The order lines are by far the
# largest table, and orders meet customers first.
_FLIGHTS_SQL = """
SELECT concat_ws('_', cast(l_orderkey AS {text}), cast(l_linenumber AS {text}),
                 cast(l_partkey AS {text}), cast(l_suppkey AS {text}),
                 cast(l_shipdate AS date)) AS id,
       {fldate} AS fldate,
       cast(month(l_shipdate) AS int) AS month,
       cast({weekday} AS int) AS dofW,
       p_brand AS carrier,
       concat('N', cast(sn AS {text})) AS src,
       concat('N', cast((sn + CASE cn % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 7 ELSE 11 END)
                        % 25 AS {text})) AS dst,
       cast(l_partkey % 24 AS int) AS crsdephour,
       cast((l_partkey % 24) * 100 + l_suppkey % 60 AS int) AS crsdeptime,
       cast(dep AS double) AS depdelay,
       cast(((l_partkey + 3) % 24) * 100 + l_suppkey % 60 AS int) AS crsarrtime,
       cast(greatest(0, dep + (cast(l_quantity AS int) % 21) - 10) AS double) AS arrdelay,
       cast(floor(di / 8) + 30 AS double) AS crselapsedtime,
       cast(di AS double) AS dist
FROM (
  SELECT *, greatest(0, ((dd % 90) + 90) % 90 - 30) AS dep, floor(l_extendedprice / 40) AS di
  FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           l_shipdate, p_brand, s_nationkey AS sn, c_nationkey AS cn, {days} AS dd
    FROM {lineitem}
         JOIN {supplier} ON l_suppkey = s_suppkey
         JOIN (SELECT o_orderkey, o_orderdate, c_nationkey
               FROM {orders} JOIN {customer} ON o_custkey = c_custkey) AS placed
           ON l_orderkey = o_orderkey
         JOIN {part} ON l_partkey = p_partkey
  ) AS lines
) AS delays
"""

_DUCKDB_FLIGHTS = _FLIGHTS_SQL.format(
    text="varchar",
    fldate="strftime(l_shipdate, '%Y-%m-%d')",
    weekday="isodow(l_shipdate)",
    days="date_diff('day', o_orderdate, l_shipdate)",
    **{t: t for t in FLIGHT_TABLES},
)

DUCKDB_PREFIX = f"""
flights AS ({_DUCKDB_FLIGHTS}),
scored AS (
  SELECT *, src || '_' || dst AS orig_dest,
         CASE WHEN depdelay >= 40 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
         CASE WHEN crsdephour >= 12 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM flights
),
airports AS (
  SELECT 'N' || n_nationkey::varchar AS id, n_name AS "City", n_regionkey AS region FROM nation
),
party_edges AS (
  SELECT 'P' || l_suppkey::varchar AS src, 'P' || o_custkey::varchar AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
parties AS (SELECT 'P' || c_custkey::varchar AS id FROM customer)
"""

_kept: dict[tuple, object] = {}
_lock = Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, tables, make):
    """``make()``, kept for this application as long as the tables stay as they are."""
    stamps = tuple(version_stamp(spark, f"{sf_dir}/{t}.parquet") for t in tables)
    key = (spark.sparkContext.applicationId, sf_dir, name, stamps)
    with _lock:
        found = _kept.get(key)
    if found is None:
        made = make()
        with _lock:
            found = _kept.setdefault(key, made)
    return found


def derive_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in flights as a plan over the order tables."""
    sql = _FLIGHTS_SQL.format(
        text="string",
        fldate="date_format(l_shipdate, 'yyyy-MM-dd')",
        weekday="weekday(l_shipdate) + 1",
        days="datediff(l_shipdate, o_orderdate)",
            **{t: "{" + t + "}" for t in FLIGHT_TABLES},
    )
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in FLIGHT_TABLES})


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights table: derived once per application, then read as parquet.

    Every report would otherwise repeat the five-table join.
    """

    def write() -> str:
        path = new_folder(spark, "flights")
        with shuffles_let_go(spark):
            derive_flights(spark, sf_dir).write.parquet(path)
        return path

    path = once(spark, sf_dir, "flights", FLIGHT_TABLES, write)
    return spark.read.schema(FLIGHTS).parquet(path)


def scored_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with a route, the delay label and a fixed-rule prediction."""
    return (
        flights(spark, sf_dir)
        .withColumn("orig_dest", route_name())
        .withColumn("label", bucketize("depdelay", LABEL_SPLITS))
        .withColumn("prediction", F.when(F.col("crsdephour") >= 12, 1.0).otherwise(0.0))
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("id"),
        F.col("n_name").alias("City"),
        F.col("n_regionkey").alias("region"),
    )


def flight_graph(spark: SparkSession, sf_dir: str) -> Graph:
    def build() -> Graph:
        return Graph(airports(spark, sf_dir), flights(spark, sf_dir))

    return once(spark, sf_dir, "flight graph", FLIGHT_TABLES + ("nation",), build)


def party_graph(spark: SparkSession, sf_dir: str) -> Graph:
    def build() -> Graph:
        party = lambda c: F.concat(F.lit("P"), F.col(c).cast("string"))
        lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        edges = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            party("l_suppkey").alias("src"), party("o_custkey").alias("dst")
        )
        vertices = table(spark, sf_dir, "customer").select(party("c_custkey").alias("id"))
        # Written once like the flights, so that no query repeats the join.
        with parts_for(spark, lines.count() + orders.count()):
            return Graph(vertices, store(edges, "party-edges"))

    return once(spark, sf_dir, "party graph", ("lineitem", "orders", "customer"), build)
