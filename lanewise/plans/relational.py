"""Reports, filters, top-k lists, buckets and confusion ratios over flights."""

from pyspark.sql import functions as F

from ..functions import as_message, bucketize, route_name
from ..functions.buckets import CLASS_SPLITS, DELAY_MINUTES, REPORT_SPLITS
from ..operators.heavy import top_groups
from ..operators.quality import area_under_roc, confusion
from ..operators.reports import count_report, group_report, rows_where, top_rows
from ..operators.sampling import (
    hash_split,
    random_split,
    random_stratified_sample,
    stratified_sample,
)
from ..schemas import FLIGHTS, SCORED_FLIGHTS
from ..session import new_folder, store
from ..sources import (
    KeyedTable,
    keep_in_memory,
    read_json,
    read_json_inferred,
    read_json_variant,
    register_views,
    variant_field,
    variant_schema,
)
from ..sources.keyed import parts_for_rows
from ..streaming import decode, publish_files
from .registry import register
from .standin import FLIGHT_TABLES, flights, once, scored_flights, table

ROWS_PER_FILE = 10_000
#: Messages are several times larger than the flights they come from: they are kept packed.
PACKED = "gzip"
ROWS_PER_DRIFT_FILE = 100_000
LATE = f"depdelay > {DELAY_MINUTES}"


def _on_flights(operator):
    return lambda spark, sf: operator(flights(spark, sf))


def _on_scored(operator):
    return lambda spark, sf: operator(scored_flights(spark, sf))


def _on_stored(operator):
    """Over the keyed table that holds the scored flights, as the reports on the sink run."""
    return lambda spark, sf: operator(_keyed_flights(spark, sf).read())


def _bucketed(df):
    return df.withColumn("delayed", bucketize("depdelay", REPORT_SPLITS))


def _sql(text):
    """Run SQL text over the registered views."""

    def run(spark, sf):
        register_views(flights=flights(spark, sf))
        return spark.sql(text)

    return run


# What a keyed table keeps of rows with one key and no version: the greatest row.
LATEST = "QUALIFY row_number() OVER (PARTITION BY id ORDER BY {}) = 1".format(
    ", ".join(f"{name} DESC NULLS LAST" for name in FLIGHTS.names)
)

# -- scans -------------------------------------------------------------------


def messages_folder(spark, sf):
    """The flights as JSON lines, written once per application."""

    def write():
        path, df = new_folder(spark, "messages"), flights(spark, sf)
        publish_files(df, path, ROWS_PER_FILE, PACKED)
        return path

    return once(spark, sf, "messages", FLIGHT_TABLES, write)


def _customers_json(spark, sf):
    def write():
        path = new_folder(spark, "customers")
        table(spark, sf, "customer").write.json(path)
        return path

    return once(spark, sf, "customers json", ("customer",), write)


def _keyed_flights(spark, sf):
    """A keyed table holding the scored flights, for readers."""

    def write():
        path = new_folder(spark, "keyed")
        KeyedTable(spark, path, SCORED_FLIGHTS).load(scored_flights(spark, sf))
        return path

    return KeyedTable(spark, once(spark, sf, "keyed", FLIGHT_TABLES, write), SCORED_FLIGHTS)


register(
    "scan_json_schema",
    lambda spark, sf: read_json(spark, messages_folder(spark, sf), FLIGHTS),
    "SELECT * FROM flights",
)
register(
    "scan_json_infer",
    lambda spark, sf: read_json_inferred(spark, _customers_json(spark, sf)),
    "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey::BIGINT AS c_nationkey"
    " FROM customer",
)
register(
    "keyed_table_scan",
    lambda spark, sf: _keyed_flights(spark, sf)
    .read()
    .select("id", "orig_dest", "depdelay", "label", "prediction"),
    f"SELECT id, orig_dest, depdelay, label, prediction FROM scored {LATEST}",
)


def _cached_view(spark, sf):
    """A view kept in memory for a series of reports: the flights late at each origin."""
    kept = keep_in_memory(flights(spark, sf).filter(LATE), "late_flights")
    try:
        counted = spark.sql("SELECT src, count(*) AS late, max(depdelay) AS most FROM late_flights GROUP BY src")
        return store(counted, "cached-view")
    finally:
        kept.unpersist()


register(
    "cached_view",
    _cached_view,
    "SELECT src, count(*) AS late, max(depdelay) AS most FROM flights WHERE depdelay > 40 GROUP BY src",
)
register(
    "sql_view",
    _sql("SELECT carrier, min(depdelay) AS least, max(depdelay) AS most FROM flights GROUP BY carrier"),
    "SELECT carrier, min(depdelay) AS least, max(depdelay) AS most FROM flights GROUP BY carrier",
)

# -- keyed writes and messages -----------------------------------------------


def _upserted(spark, sf):
    """Load all flights, then correct the late ones twice in one batch, and read back."""
    df = flights(spark, sf)
    versioned = df.withColumn("version", F.lit(0))
    path = new_folder(spark, "upsert")
    keyed = KeyedTable(spark, path, versioned.schema, parts=parts_for_rows(spark, df.count()))
    keyed.load(versioned, order_by=["version"])
    late = df.filter(LATE)
    first = late.withColumn("depdelay", F.col("depdelay") - 1).withColumn("version", F.lit(1))
    second = late.withColumn("depdelay", F.col("depdelay") - 2).withColumn("version", F.lit(2))
    keyed.upsert(second.unionByName(first), order_by=["version"])
    return keyed.read()


register(
    "keyed_upsert",
    _upserted,
    f"""SELECT * FROM (
          SELECT *, 0 AS version FROM flights
          UNION ALL
          SELECT * REPLACE (depdelay - 2 AS depdelay), 2 AS version FROM flights
          WHERE depdelay > 40
        ) AS writes
        {LATEST.replace("ORDER BY ", "ORDER BY version DESC, ")}""",
)
register(
    "to_json_messages",
    _on_flights(lambda df: df.select(as_message(df).alias("value"))),
    "SELECT to_json(flights)::VARCHAR AS value FROM flights",
)
register(
    "json_decode",
    _on_flights(lambda df: decode(df.select(as_message(df).alias("value")), FLIGHTS)),
    "SELECT * FROM flights",
)


def _drifting_folder(spark, sf):
    """Messages whose distance is a number, a text, or an object with a unit."""

    def write():
        path, df = new_folder(spark, "drifting"), flights(spark, sf)
        plain = df.drop("dist")
        shapes = [
            ("dofW <= 3", F.col("dist")),
            ("dofW in (4, 5)", F.col("dist").cast("string")),
            ("dofW > 5", F.struct(F.col("dist").alias("value"), F.lit("mi").alias("unit"))),
        ]
        parts = [
            df.filter(days).select(F.to_json(F.struct(*plain.columns, shape.alias("dist"))).alias("value"))
            for days, shape in shapes
        ]
        # A packed file is read by one task, so files are of bounded length.
        rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
        rows.write.option("maxRecordsPerFile", ROWS_PER_DRIFT_FILE).text(path, compression=PACKED)
        return path

    return once(spark, sf, "drifting messages", FLIGHT_TABLES, write)


def _drifting(spark, sf):
    messages = read_json_variant(spark, _drifting_folder(spark, sf))
    return messages.select(
        variant_field("message", "string", "$.id").alias("id"),
        variant_field("message", "double", "$.dist", "$.dist.value").alias("dist"),
        variant_field("message", "string", "$.dist.unit").alias("unit"),
    )


def _drifting_schema(spark, sf):
    """The type of every field over all messages: where the shapes differ it is VARIANT."""
    schema = variant_schema(read_json_variant(spark, _drifting_folder(spark, sf))).select(
        F.explode(F.expr("split(regexp_extract(schema, '^OBJECT<(.*)>$', 1), ', ')")).alias("field")
    )
    parts = F.split("field", ": ")
    number = parts[1].rlike("^(DECIMAL|BIGINT|DOUBLE)")
    return schema.select(parts[0].alias("name"), F.when(number, "NUMBER").otherwise(parts[1]).alias("kind"))


register(
    "scan_json_drift",
    _drifting,
    "SELECT id, dist, CASE WHEN dofW > 5 THEN 'mi' END AS unit FROM flights",
)
register(
    "scan_json_drift_schema",
    _drifting_schema,
    """SELECT name, CASE WHEN name = 'dist' THEN 'VARIANT' WHEN name IN ('id', 'fldate', 'carrier', 'src', 'dst')
                         THEN 'STRING' ELSE 'NUMBER' END AS kind
       FROM (SELECT unnest(['id', 'fldate', 'month', 'dofW', 'carrier', 'src', 'dst', 'crsdephour', 'crsdeptime',
                            'depdelay', 'crsarrtime', 'arrdelay', 'crselapsedtime', 'dist']) AS name)""",
)

# -- filters and projections -------------------------------------------------

register(
    "filter_hour_eq",
    _on_flights(lambda df: top_rows(df, ["id"], 3, where=F.col("crsdephour") == 10)),
    "SELECT * FROM flights WHERE crsdephour = 10 ORDER BY id LIMIT 3",
)
register(
    "filter_delay_gt",
    _on_flights(lambda df: rows_where(df, F.col("depdelay") > DELAY_MINUTES)),
    "SELECT * FROM flights WHERE depdelay > 40",
)
register(
    "filter_string_expr",
    _on_flights(lambda df: rows_where(df, "src = 'N0' and depdelay > 1")),
    "SELECT * FROM flights WHERE src = 'N0' AND depdelay > 1",
)
register(
    "sql_where",
    _sql("SELECT id, carrier, depdelay FROM flights WHERE depdelay > 40"),
    "SELECT id, carrier, depdelay FROM flights WHERE depdelay > 40",
)
register(
    "project_cols",
    _on_flights(lambda df: df.select("carrier", "src", "dst", "depdelay", "crsdephour")),
    "SELECT carrier, src, dst, depdelay, crsdephour FROM flights",
)
register(
    "concat_route",
    _on_flights(lambda df: df.select("id", "src", "dst", route_name().alias("orig_dest"))),
    "SELECT id, src, dst, orig_dest FROM scored",
)
register(
    "bucketize_delay",
    _on_flights(lambda df: _bucketed(df).select("id", "depdelay", "delayed")),
    "SELECT id, depdelay, label AS delayed FROM scored",
)

# -- counts and averages -----------------------------------------------------

register(
    "count_by_carrier",
    _on_flights(lambda df: count_report(df, ["carrier"])),
    "SELECT carrier, count(*) AS count FROM flights GROUP BY carrier",
)
register(
    "count_by_delayed",
    _on_flights(lambda df: count_report(_bucketed(df), ["delayed"])),
    "SELECT label AS delayed, count(*) AS count FROM scored GROUP BY label",
)
register(
    "count_by_route_label_pred",
    _on_scored(lambda df: count_report(df, ["orig_dest", "label", "prediction"])),
    """SELECT orig_dest, label, prediction, count(*) AS count FROM scored
       GROUP BY orig_dest, label, prediction""",
)
register(
    "count_by_prediction",
    _on_scored(lambda df: count_report(df, ["prediction"])),
    "SELECT prediction, count(*) AS count FROM scored GROUP BY prediction",
)
register(
    "avg_delay_by_carrier",
    _on_flights(lambda df: group_report(df, ["carrier"], {"avgdelay": F.avg("depdelay")})),
    "SELECT carrier, avg(depdelay) AS avgdelay FROM flights GROUP BY carrier",
)
register(
    "avg_delay_by_dow",
    _sql("SELECT dofW, avg(depdelay) AS avgdelay FROM flights GROUP BY dofW ORDER BY avgdelay DESC"),
    "SELECT dofW, avg(depdelay) AS avgdelay FROM flights GROUP BY dofW",
)
for name, key, n in (("top_delayed_dst", "dst", 3), ("top_delayed_carrier", "carrier", 5)):
    register(
        name,
        _on_flights(
            lambda df, key=key, n=n: count_report(
                df, [key], where=LATE, order_by=[F.desc("count"), F.asc(key)], limit=n
            )
        ),
        f"""SELECT {key}, count(*) AS count FROM flights WHERE depdelay > 40
            GROUP BY {key} ORDER BY count DESC, {key} LIMIT {n}""",
    )
for name, key in (("carrier", "carrier"), ("dow", "dofW"), ("hour", "crsdephour"), ("src", "src")):
    register(
        f"delayed_count_by_{name}",
        _on_flights(
            lambda df, key=key: count_report(
                df,
                [key],
                of="depdelay",
                where=LATE,
                order_by=[F.desc("count"), "src"] if key == "src" else [key],
            )
        ),
        f"SELECT {key}, count(depdelay) AS count FROM flights WHERE depdelay > 40 GROUP BY {key}",
    )
register(
    "bucket_count_by_src",
    _on_flights(
        lambda df: count_report(
            _bucketed(df), ["src", "delayed"], of="delayed", order_by=["src", "delayed"]
        )
    ),
    """SELECT src, label AS delayed, count(label) AS count FROM scored
       GROUP BY src, label""",
)
for name, keys in (
    ("dst", ["dst"]),
    ("route", ["src", "dst"]),
    ("dow", ["dofW"]),
    ("hour", ["crsdephour"]),
    ("carrier", ["carrier"]),
):
    listed = ", ".join(keys)
    register(
        f"bucket1_count_by_{name}",
        _on_flights(
            lambda df, keys=keys: count_report(
                _bucketed(df), keys + ["delayed"], of="delayed", where="delayed = 1", order_by=keys
            )
        ),
        f"""SELECT {listed}, label AS delayed, count(label) AS count FROM scored
            WHERE label = 1 GROUP BY {listed}, label""",
    )
    register(
        f"pred_count_by_{name}",
        _on_stored(
            lambda df, keys=keys: count_report(
                df, keys + ["prediction"], of="prediction", order_by=keys + ["prediction"]
            )
        ),
        f"""SELECT {listed}, prediction, count(prediction) AS count FROM scored
            GROUP BY {listed}, prediction""",
    )
register(
    "pred_count_by_src",
    _on_stored(
        lambda df: count_report(
            df, ["src", "prediction"], of="prediction", order_by=["src", "prediction"]
        )
    ),
    "SELECT src, prediction, count(prediction) AS count FROM scored GROUP BY src, prediction",
)
register(
    "pred_actual_by_src",
    _on_stored(
        lambda df: group_report(
            df,
            ["src", "prediction", "label"],
            {"predicted": F.count("prediction"), "actual": F.count("label")},
            order_by=["src", "label", "prediction"],
        )
    ),
    """SELECT src, prediction, label, count(prediction) AS predicted, count(label) AS actual
       FROM scored GROUP BY src, prediction, label""",
)
register(
    "total_count",
    _on_flights(lambda df: count_report(df, [], name="total")),
    "SELECT count(*) AS total FROM flights",
)

# -- routes ------------------------------------------------------------------

register(
    "longest_routes",
    _on_flights(
        lambda df: group_report(
            df,
            ["src", "dst"],
            {"max_dist": F.max("dist")},
            order_by=[F.desc("max_dist"), F.asc("src"), F.asc("dst")],
            limit=4,
        )
    ),
    """SELECT src, dst, max(dist) AS max_dist FROM flights GROUP BY src, dst
       ORDER BY max_dist DESC, src, dst LIMIT 4""",
)
register(
    "top_avg_delay_routes",
    _on_flights(
        lambda df: group_report(
            df,
            ["src", "dst"],
            {"avgdelay": F.avg("depdelay")},
            order_by=[F.desc("avgdelay"), F.asc("src"), F.asc("dst")],
            limit=5,
        )
    ),
    """SELECT src, dst, avg(depdelay) AS avgdelay FROM flights GROUP BY src, dst
       ORDER BY avgdelay DESC, src, dst LIMIT 5""",
)
register(
    "top_delayed_routes",
    _on_flights(
        lambda df: count_report(
            df,
            ["src", "dst"],
            of="depdelay",
            name="flightcount",
            where=LATE,
            order_by=[F.desc("flightcount"), F.asc("src"), F.asc("dst")],
            limit=5,
        )
    ),
    """SELECT src, dst, count(depdelay) AS flightcount FROM flights WHERE depdelay > 40
       GROUP BY src, dst ORDER BY flightcount DESC, src, dst LIMIT 5""",
)
# Weekday flights by route, the others each by itself: a group for every seventh flight.
_MANY_GROUPS = "CASE WHEN dofW <= 5 THEN concat(src, '-', dst) ELSE id END"
for name, kept in (("top_of_many_groups", "dofW <= 7"), ("top_of_single_groups", "dofW > 5")):
    register(
        name,
        _on_flights(
            lambda df, kept=kept: top_groups(
                df.select(F.expr(_MANY_GROUPS).alias("who"), "dofW"), ["who"], 7, where=kept, counters=1000
            )
        ),
        f"""SELECT who, count(*) AS count FROM (SELECT {_MANY_GROUPS} AS who, dofW FROM flights)
            WHERE {kept} GROUP BY who ORDER BY count DESC, who LIMIT 7""",
    )
register(
    "avg_delay_from_origin",
    _on_flights(
        lambda df: group_report(
            df,
            ["src", "dst"],
            {"avgdelay": F.avg("depdelay")},
            where="src = 'N3' and depdelay > 1",
            order_by=[F.desc("avgdelay"), F.asc("dst")],
        )
    ),
    """SELECT src, dst, avg(depdelay) AS avgdelay FROM flights
       WHERE src = 'N3' AND depdelay > 1 GROUP BY src, dst""",
)
register(
    "top_routes",
    _on_flights(
        lambda df: count_report(
            df,
            ["src", "dst"],
            order_by=[F.desc("count"), F.asc("src"), F.asc("dst")],
            limit=4,
        )
    ),
    """SELECT src, dst, count(*) AS count FROM flights GROUP BY src, dst
       ORDER BY count DESC, src, dst LIMIT 4""",
)

# -- top-k rows --------------------------------------------------------------

_LONGEST = ["carrier", "src", "dst", "depdelay", "crsdephour"]
register(
    "longest_delays",
    _on_flights(
        lambda df: top_rows(
            df, [F.desc("depdelay"), F.asc("id")], 5, where=LATE, columns=_LONGEST
        )
    ),
    """SELECT carrier, src, dst, depdelay, crsdephour FROM flights WHERE depdelay > 40
       ORDER BY depdelay DESC, id LIMIT 5""",
)
for name, n in (("longest_delays_far", 5), ("longest_delays_far_top3", 3)):
    register(
        name,
        _on_flights(
            lambda df, n=n: top_rows(df, [F.desc("depdelay"), F.asc("id")], n, where="dist > 1500")
        ),
        f"SELECT * FROM flights WHERE dist > 1500 ORDER BY depdelay DESC, id LIMIT {n}",
    )
register(
    "longest_delays_sql",
    _sql(
        "SELECT carrier, src, dst, depdelay, crsdephour, dist, dofW FROM flights"
        " WHERE depdelay > 40 ORDER BY depdelay DESC, id LIMIT 5"
    ),
    """SELECT carrier, src, dst, depdelay, crsdephour, dist, dofW FROM flights
       WHERE depdelay > 40 ORDER BY depdelay DESC, id LIMIT 5""",
)

# -- confusion and AUC -------------------------------------------------------

for by in ("prediction", "label"):
    register(
        f"confusion_by_{by}",
        (_on_stored if by == "prediction" else _on_scored)(lambda df, by=by: confusion(df, by=by)),
        """SELECT count(*) AS total,
                  count(*) FILTER (label = prediction) AS correct,
                  count(*) FILTER (label <> prediction) AS wrong,
                  count(*) FILTER (label = prediction) / count(*) AS ratio_correct,
                  count(*) FILTER (label <> prediction) / count(*) AS ratio_wrong,
                  count(*) FILTER (prediction = 1 AND label = 1) / count(*) AS true_positive,
                  count(*) FILTER (prediction = 0 AND label = 0) / count(*) AS true_negative,
                  count(*) FILTER (prediction = 1 AND label = 0) / count(*) AS false_positive,
                  count(*) FILTER (prediction = 0 AND label = 1) / count(*) AS false_negative
           FROM scored""",
    )
register(
    "auc_sql",
    _on_scored(
        lambda df: area_under_roc(df, score="arrdelay").select(
            "positives", "negatives", F.round("auc", 6).alias("auc")
        )
    ),
    """, ranked AS (
         SELECT label, rank() OVER (ORDER BY arrdelay) AS low,
                count(*) OVER (PARTITION BY arrdelay) AS tied
         FROM scored WHERE arrdelay IS NOT NULL AND label IS NOT NULL
       ), s AS (
         SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
                sum(low + (tied - 1) / 2.0) FILTER (label = 1) AS ranks
         FROM ranked
       )
       SELECT positives, negatives,
              round((ranks::DOUBLE - positives::DOUBLE * (positives + 1) / 2)
                    / (positives::DOUBLE * negatives), 6) AS auc
       FROM s""",
)

# -- sampling ----------------------------------------------------------------


def _split_sides(df):
    kept, held = hash_split(df, 0.7, "id", seed=5043)
    side = lambda part, name: part.select("id", F.lit(name).alias("part"))
    return side(kept, "train").unionByName(side(held, "test"))


def _classes(df):
    return df.withColumn("delayed", bucketize("depdelay", CLASS_SPLITS))


_FRACTIONS = {0.0: 0.13, 1.0: 1.0}
_CLASS = "CASE WHEN depdelay >= 41 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
_SAMPLED = f"""(SELECT id, depdelay, {_CLASS} AS delayed FROM flights
               WHERE depdelay >= 41 OR substr(md5('36' || id), 1, 8) < '2147ae14')"""

register(
    "hash_split",
    _on_flights(_split_sides),
    """SELECT id, CASE WHEN substr(md5('5043' || id), 1, 8) < 'b3333333'
                       THEN 'train' ELSE 'test' END AS part
       FROM flights""",
)


def _random_split_facts(df):
    """The two parts are the table, share no row, and are about as large as asked."""
    first, second = random_split(df.select("id"), 0.7, 5043)
    parts = first.withColumn("kept", F.lit(1)).unionByName(second.withColumn("kept", F.lit(0)))
    per_id = parts.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("kept").alias("kept"))
    return per_id.agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("n") > 1).alias("overlap"),
        F.avg("kept").between(0.66, 0.74).alias("share_as_asked"),
    )


register(
    "random_split",
    _on_flights(_random_split_facts),
    "SELECT count(*) AS rows, 0 AS overlap, true AS share_as_asked FROM flights",
)
register(
    "stratified_sample",
    _on_flights(
        lambda df: stratified_sample(_classes(df), "delayed", _FRACTIONS, seed=36).select(
            "id", "depdelay", "delayed"
        )
    ),
    f"SELECT * FROM {_SAMPLED} AS s",
)


def _random_sample_facts(df):
    """All of the class asked for whole, about the asked share of the other."""
    classes = _classes(df)
    sample = random_stratified_sample(classes, "delayed", _FRACTIONS, 36)
    before = classes.groupBy("delayed").agg(F.count(F.lit(1)).alias("before"))
    after = sample.groupBy("delayed").agg(F.count(F.lit(1)).alias("after"))
    asked = F.when(F.col("delayed") == 0.0, _FRACTIONS[0.0]).otherwise(_FRACTIONS[1.0])
    return before.join(after, "delayed").select(
        "delayed", "before", (F.abs(F.col("after") / F.col("before") - asked) < 0.02).alias("as_asked")
    )


register(
    "random_stratified_sample",
    _on_flights(_random_sample_facts),
    f"SELECT {_CLASS} AS delayed, count(*) AS before, true AS as_asked FROM flights GROUP BY 1",
)


def _balance(df):
    """Class counts before and after the sample."""
    classes = _classes(df)
    sample = stratified_sample(classes, "delayed", _FRACTIONS, seed=36)
    before = count_report(classes, ["delayed"]).withColumn("stage", F.lit("before"))
    after = count_report(sample, ["delayed"]).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


register(
    "class_balance",
    _on_flights(_balance),
    f"""SELECT {_CLASS} AS delayed, count(*) AS count, 'before' AS stage
        FROM flights GROUP BY 1
        UNION ALL
        SELECT delayed, count(*) AS count, 'after' AS stage FROM {_SAMPLED} AS s GROUP BY 1""",
)
