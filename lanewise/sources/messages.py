"""Streams of text messages: a topic, or a folder of text files."""

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Column that orders messages as they came.
ARRIVAL = "arrival"


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the topic source; ``max_per_trigger`` offsets a micro-batch, or no limit."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic as an unbounded table: the text ``value`` and its ``arrival``.

    ``arrival`` orders messages as they came (time, then partition and offset).  Needs
    Spark's Kafka package on the classpath.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options))
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.struct(
            F.col("timestamp").alias("time"),
            F.col("partition").cast("string").alias("part"),
            F.col("offset").alias("position"),
        ).alias(ARRIVAL),
    )


def file_messages(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A folder of text files, one message per line, in the same shape as a topic.

    Whole files are admitted to a micro-batch: so many files, or files of so many bytes.
    ``arrival`` orders messages by their file's time and name; the rows of a micro-batch
    keep the order of lines within a file.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    file = F.col("_metadata")
    return reader.load(path).select(
        "value",
        F.struct(
            file["file_modification_time"].alias("time"),
            file["file_path"].alias("part"),
            file["file_block_start"].alias("position"),
        ).alias(ARRIVAL),
    )
