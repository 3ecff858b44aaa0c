"""The streaming job: messages in, decoded and scored, upserted by key.

The transformations work alike on batch and streaming frames.  The starters return a
running ``StreamingQuery``; pass ``available_now=True`` to process what is there and
stop, or wait on the query with a time-out for a bounded live run.
"""

import hashlib

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..functions import as_message, route_name
from ..operators.learning import score_rows
from ..sources import KeyedTable
from ..sources.messages import ARRIVAL

# -- transformations ---------------------------------------------------------


def decode(messages: DataFrame, schema: StructType, raw: str | None = None) -> DataFrame:
    """Parse JSON text in column ``value`` into the schema's columns.

    Text that is not JSON gives a row of nulls, a field of the wrong type a null
    field; unknown fields are ignored.  ``raw`` names a column that keeps the text.  The
    messages' ``arrival`` stays with them if they have one and ``raw`` is kept.
    """
    text = F.col("value").cast("string")
    order = [ARRIVAL] if raw and ARRIVAL in messages.columns else []
    parsed = messages.select(text.alias("__text"), F.from_json(text, schema).alias("data"), *order)
    kept = [F.col("__text").alias(raw)] if raw else []
    return parsed.select("data.*", *kept, *order)


def with_route(flights: DataFrame, name: str = "orig_dest") -> DataFrame:
    """Add the route column the classifier reads."""
    return flights.withColumn(name, route_name())


def score_stream(
    messages: DataFrame, schema: StructType, model: PipelineModel, raw: str | None = None
) -> DataFrame:
    """Decode, add the route, score, and drop what a table cannot store.

    A message that lacks something the model reads gets no prediction, and one without
    a usable delay no label; neither ends the stream.
    """
    return score_rows(model, with_route(decode(messages, schema, raw)))


# -- sinks -------------------------------------------------------------------


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_keyed_sink(
    rows: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    order_by: list[str] | None = None,
    rejects: str | None = None,
    raw: str | None = None,
    compact_every: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Upsert every micro-batch into an existing keyed table.

    A batch repeated after a failure changes nothing: the table remembers the batches
    of each writer, and the writer is this checkpoint folder.  Rows without a key
    (messages that did not parse) go to ``<rejects>/<batch>``; column ``raw`` is kept
    there only.  Without ``rejects`` a batch with such rows fails.  Of several messages
    with one key the last to arrive wins, unless ``order_by`` says otherwise.
    ``compact_every`` folds the table's deltas together after so many batches and keeps
    the newest two generations, so neither reads nor storage grow without end.
    """
    if not table.exists():
        raise ValueError(f"no keyed table at {table.path}")
    writer = "stream" + hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def apply(batch: DataFrame, epoch: int) -> None:
        arrival = (ARRIVAL, "__line") if ARRIVAL in batch.columns else ()
        if arrival:
            # Lines of one file part arrive together; their rows still stand in line order.
            batch = batch.withColumn("__line", F.monotonically_increasing_id())
        stored = batch.drop(raw) if raw else batch
        order = order_by or list(arrival)
        if rejects is None:
            if not table.without_key(stored).isEmpty():
                raise ValueError("rows without a key: name a folder for rejects")
            table.upsert(stored, order, writer, epoch, arrival)
        else:
            # Two writes read the batch; keep it so that it is scored once.  On disk, where a
            # large one takes nothing from the tasks that sort it.
            batch.persist(StorageLevel.DISK_ONLY)
            try:
                table.upsert(stored, order, writer, epoch, arrival)
                lost = table.without_key(batch)
                lost = lost.select(raw) if raw else lost
                lost.write.mode("overwrite").parquet(f"{rejects}/batch={epoch}")
            finally:
                batch.unpersist()
        if compact_every and (epoch + 1) % compact_every == 0:
            table.compact(remove_old=True, generations=2)

    return _start(rows.writeStream.foreachBatch(apply), checkpoint, available_now)


def start_tail(
    messages: DataFrame,
    checkpoint: str,
    path: str | None = None,
    available_now: bool = False,
    compression: str = "none",
) -> StreamingQuery:
    """Pass on the text of every message: to the console, or as lines of files in ``path``.

    ``compression`` is the codec of those files, by its Spark name.
    """
    values = messages.select(F.col("value").cast("string").alias("value"))
    if path is None:
        writer = values.writeStream.format("console").option("truncate", "false")
    else:
        writer = values.writeStream.format("text").option("path", path).option("compression", compression)
    return _start(writer.outputMode("append"), checkpoint, available_now)


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Let a stream run for at most so long, then stop it; True if it ended by itself."""
    ended = bool(query.awaitTermination(seconds))
    if not ended:
        query.stop()
    return ended


# -- publishing --------------------------------------------------------------


def publish_files(
    df: DataFrame, path: str, rows_per_file: int | None = None, compression: str = "none"
) -> None:
    """Write each row as one JSON message per line into text files.

    Files are what a file stream admits to a micro-batch, so ``rows_per_file`` bounds
    its steps.  Messages repeat their field names, so ``compression`` (by its Spark name)
    makes them several times smaller; such a file is read by one task.
    """
    writer = df.select(as_message(df).alias("value")).write.mode("overwrite").option("compression", compression)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", str(rows_per_file))
    writer.text(path)


def publish_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send each row as one JSON message without a key.  Needs Spark's Kafka package."""
    messages = df.select(as_message(df).alias("value"))
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()
