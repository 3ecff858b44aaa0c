"""A parquet table addressed by a primary key, with insert-or-replace writes.

Layout under the table's folder::

    base-<seq>/                     the table as of write number <seq>
    delta-<seq>-<writer>-<epoch>/   rows inserted or replaced by one later write

``-p<n>`` at the end of a name says that the folder's files are ``n`` buckets of keys, as
Spark's ``bucketBy`` makes them: a read of such folders moves no rows.

A folder counts only once its job has committed (``_SUCCESS``), so readers never see
half a write and a failed write leaves nothing behind but an ignored folder.  A write
costs as much as its own rows, however large the table; ``compact`` folds the deltas
into a new base.  One writer at a time.
"""

import math
import re
import uuid
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import AtomicType, LongType, StructField, StructType

from ..operators.reports import first_per_group
from ..operators.skew import broadcast_if, fits_in_memory
from ..session import BROADCAST_ROWS, ROWS_PER_SPLIT, new_folder, set_inside, setting, shuffles_let_go
from .folders import child_folders, is_complete, remove_folder

_SEQ, _LAYER = "__seq", "__layer"
_BASE = re.compile(r"base-(\d+)(?:-p\d+)?$")
_DELTA = re.compile(r"delta-(\d+)-(\w+)-(\d+)(?:-p\d+)?$")
_PARTS = re.compile(r"-p(\d+)$")
#: Whether a committed job leaves its marker.
_MARKED = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


#: Buckets of keys that are counted to find where hot keys can be.
_BUCKETS = 1 << 16
#: Rows that a table in parts sorts by key at a time, in splits' worths: what is shuffled for
#: them is let go before the next ones.
_SPLITS_AT_ONCE = 64


def parts_for_rows(spark: SparkSession, rows: int) -> int:
    """Into how many parts a table of about so many rows is dealt: parts of bounded length,
    and of few rows only where there are not enough for all cores."""
    cores = min(spark.sparkContext.defaultParallelism, math.ceil(rows / 10_000))
    return max(math.ceil(2 * rows / setting(spark, ROWS_PER_SPLIT)), cores, 1)


def _key_buckets(df: DataFrame, key: str):
    """The bucket of a row's key, the counts of all buckets, and the number of rows."""
    bucket = F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(_BUCKETS))
    sizes = df.groupBy(bucket.alias("bucket")).count()
    total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    return bucket, sizes, total


def _order(df: DataFrame, order_by: list[str] | None):
    ties = [f.name for f in df.schema if isinstance(f.dataType, AtomicType)]
    return [F.col(f"`{c}`").desc_nulls_last() for c in [*(order_by or []), *ties]]


def latest_per_key(df: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by the row's own simple columns.

    Nulls are least.  Rows are dealt by their key into parts of bounded length, so sorting
    them needs no disk however large the table.  Where the counted buckets of keys are too
    large for that, a key may hold much of the table: there each task first reduces its own
    rows to one per key, so such a key costs no more than any other in the shuffle.
    """
    order = _order(df, order_by)
    per_part = setting(df.sparkSession, ROWS_PER_SPLIT)
    bucket, sizes, total = _key_buckets(df, key)
    if total <= per_part:
        return first_per_group(df, [key], order, 1)
    # At most one bucket for every so many rows.
    hot = [row.bucket for row in sizes.filter(F.col("count") > per_part).collect()]
    return _latest_in_parts(df, key, order, -(-2 * total // per_part), bucket, hot)


def _latest_in_parts(df: DataFrame, key: str, order, parts: int, bucket, hot) -> DataFrame:
    even = df.filter(~bucket.isin(hot)) if hot else df
    latest = first_per_group(even.repartition(parts, F.col(f"`{key}`")), [key], order, 1)
    return latest.unionByName(first_per_group(df.filter(bucket.isin(hot)), [key], order, 1)) if hot else latest


class KeyedTable:
    """Handle on a keyed table; ``schema`` is what readers see.

    With ``parts`` each write is dealt into so many buckets of keys (``parts_for_rows``
    says how many suit a number of rows), of bounded rows at a time; folders of one number
    of parts are merged by a read without a shuffle.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, key: str = "id", parts: int | None = None
    ):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.parts = parts

    # -- state ---------------------------------------------------------------

    def _folders(self):
        bases, deltas = [], []
        for name in child_folders(self.spark, self.path):
            if match := _BASE.match(name):
                bases.append((int(match[1]), name))
            elif match := _DELTA.match(name):
                deltas.append((int(match[1]), match[2], int(match[3]), name))
        return bases, deltas

    def _current(self):
        """The newest complete base and the complete deltas after it."""
        bases, deltas = self._folders()
        complete = [b for b in bases if is_complete(self.spark, f"{self.path}/{b[1]}")]
        if not complete:
            raise ValueError(f"no keyed table at {self.path}")
        base = max(complete)
        later = [
            d
            for d in sorted(deltas)
            if d[0] > base[0] and is_complete(self.spark, f"{self.path}/{d[3]}")
        ]
        return base, later

    def exists(self) -> bool:
        bases, _ = self._folders()
        return any(is_complete(self.spark, f"{self.path}/{name}") for _, name in bases)

    def _applied(self, writer: str, epoch: int) -> bool:
        """Epochs of a writer only grow, so a later complete one covers all before it."""
        return any(
            w == writer and e >= epoch and is_complete(self.spark, f"{self.path}/{name}")
            for _, w, e, name in self._folders()[1]
        )

    # -- operations ----------------------------------------------------------

    def create(self) -> "KeyedTable":
        """Make the table, empty, unless it is there."""
        if not self.exists():
            self._put(self.spark.createDataFrame([], self.schema), None, f"base-{0:012d}")
        return self

    def read(self, schema: StructType | None = None) -> DataFrame:
        """The rows as of now, under ``schema`` (absent columns are null).

        Without deltas this is a bare parquet scan.  Otherwise the base keeps the rows
        whose key no delta touches; it is shuffled only if the deltas' keys, measured,
        are too large to copy to every executor, and it is not in parts as the deltas are.
        """
        schema = schema or self.schema
        (_, base_name), deltas = self._current()
        keyed = schema
        if self.key not in schema.names:
            key_type = self.schema[self.key].dataType
            keyed = StructType(schema.fields + [StructField(self.key, key_type)])
        base = self.spark.read.schema(keyed).parquet(f"{self.path}/{base_name}")
        if not deltas:
            return base.select(*schema.names)

        changed = self.spark.read.schema(
            StructType(keyed.fields + [StructField(_SEQ, LongType())])
        ).parquet(*[f"{self.path}/{name}" for *_, name in deltas])
        parts = self._common_parts([base_name] + [name for *_, name in deltas])
        if parts and changed.count() > setting(self.spark, BROADCAST_ROWS):
            layers = [(-1, base_name)] + [(seq, name) for seq, *_, name in deltas]
            return self._merged(layers, keyed, parts).select(*schema.names)
        newest = latest_per_key(changed, self.key, [_SEQ]).drop(_SEQ)
        keys = changed.select(self.key).distinct()
        untouched = base.join(broadcast_if(keys, fits_in_memory(keys)), self.key, "left_anti")
        return untouched.unionByName(newest).select(*schema.names)

    def _common_parts(self, names):
        """The number of parts of all these folders, if they have one and it is the same."""
        found = {match[1] if (match := _PARTS.search(name)) else None for name in names}
        only = found.pop()
        return None if found or only is None else int(only)

    def _merged(self, layers, keyed, parts):
        """The row of the newest layer for each key, where all are in the same parts.

        The folders are partitions of one bucketed table, so one task reads a bucket of all of
        them and nothing is shuffled.  The table is a name in this application's catalog only.
        """
        name = f"lanewise_{uuid.uuid4().hex}"
        nowhere = new_folder(self.spark, "layers")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, {_LAYER} BIGINT) USING parquet PARTITIONED BY ({_LAYER})"
            f" CLUSTERED BY (`{self.key}`) INTO {parts} BUCKETS LOCATION '{nowhere}'"
        )
        where = " ".join(f"PARTITION ({_LAYER}={n}) LOCATION '{self.path}/{folder}'" for n, folder in layers)
        self.spark.sql(f"ALTER TABLE {name} ADD {where}")
        merged = first_per_group(self.spark.table(name), [self.key], [F.col(_LAYER).desc()], 1)
        return merged.drop(_LAYER)

    def _put(self, rows: DataFrame, order_by: list[str] | None, folder: str, transient=(), seq=None) -> str:
        """Write the latest row of each key into ``folder``; its whole name, once it is complete."""
        rows = rows.filter(F.col(f"`{self.key}`").isNotNull())

        def stored(latest):
            latest = latest.drop(*transient)
            return latest if seq is None else latest.withColumn(_SEQ, F.lit(seq).cast("long"))

        with shuffles_let_go(rows.sparkSession):
            if self.parts is None:
                latest = latest_per_key(rows, self.key, order_by)
                stored(latest).write.mode("overwrite").parquet(f"{self.path}/{folder}")
            else:
                folder = f"{folder}-p{self.parts}"
                self._put_in_parts(rows, _order(rows, order_by), f"{self.path}/{folder}", stored)
        self._require(folder)
        return folder

    def _put_in_parts(self, rows, order, path, stored):
        spark, key = rows.sparkSession, F.col(f"`{self.key}`")
        per_part = setting(spark, ROWS_PER_SPLIT)
        bucket, sizes, total = _key_buckets(rows, self.key)
        hot = [r.bucket for r in sizes.filter(F.col("count") > per_part).collect()] if total > per_part else []
        steps = max(1, math.ceil(total / (_SPLITS_AT_ONCE * per_part)))
        # What a write that failed left there counts for nothing.
        remove_folder(spark, path)
        name = f"lanewise_{uuid.uuid4().hex}"
        try:
            for step in range(steps):
                # The parts that Spark deals keys to by this hash, some of them at a time.
                now = rows if steps == 1 else rows.filter(F.pmod(F.hash(key), F.lit(self.parts)) % steps == step)
                latest = stored(_latest_in_parts(now, self.key, order, self.parts, bucket, hot))
                writer = latest.write.format("parquet").mode("append").bucketBy(self.parts, self.key)
                # The folder counts from its last step on.
                with set_inside(spark, _MARKED, "false") if step < steps - 1 else nullcontext():
                    writer.option("path", path).saveAsTable(name)
        finally:
            # The files stay: the table's folder was named.
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    def upsert(
        self,
        rows: DataFrame,
        order_by: list[str] | None = None,
        writer: str = "batch",
        epoch: int | None = None,
        transient: tuple[str, ...] = (),
    ) -> bool:
        """Insert ``rows``, replacing those with the same key.

        The table must exist.  Of several rows with one key the greatest by
        ``order_by`` wins; ``transient`` columns serve that order only and are not
        stored.  Rows without a key are not stored (see ``without_key``).
        A writer that numbers its batches may repeat one safely: the repeat does
        nothing and returns False.
        """
        if not self.exists():
            raise ValueError(f"no keyed table at {self.path}")
        if epoch is not None and self._applied(writer, epoch):
            return False
        bases, deltas = self._folders()
        seq = max(n for n, *_ in bases + deltas) + 1
        if epoch is None:
            epoch = max((e for _, w, e, _ in deltas if w == writer), default=-1) + 1
        self._put(rows, order_by, f"delta-{seq:012d}-{writer}-{epoch}", transient, seq)
        return True

    def load(self, rows: DataFrame, order_by: list[str] | None = None) -> "KeyedTable":
        """Make the table from ``rows`` at once: they are its first base, no delta.

        Of several rows with one key the greatest by ``order_by`` stays; rows without a
        key are left out (see ``without_key``).
        """
        if self.exists():
            raise ValueError(f"there is a keyed table at {self.path}")
        self._put(rows, order_by, f"base-{0:012d}")
        return self

    def _require(self, folder: str) -> None:
        """A write without its success marker would never be read: say so at once."""
        if not is_complete(self.spark, f"{self.path}/{folder}"):
            raise RuntimeError(
                f"{self.path}/{folder} has no _SUCCESS marker; the session's output committer"
                f" must write one ({_MARKED})"
            )

    def without_key(self, rows: DataFrame) -> DataFrame:
        """The rows ``upsert`` leaves out, for the caller to keep elsewhere."""
        return rows.filter(F.col(self.key).isNull())

    def compact(self, remove_old: bool = False, generations: int = 1) -> None:
        """Fold the deltas into a new base, keeping every column any write brought.

        With ``remove_old`` only the newest ``generations`` bases stay, with the deltas
        after the oldest of them, and each writer's newest delta, which remembers the
        batches already applied.  A reader that started before the last but
        ``generations`` - 1 compactions may then lose its files.
        """
        (_, base_name), deltas = self._current()
        if not deltas:
            return
        # One job wrote each folder, so any file of it has the folder's columns.
        columns = {}
        for name in [base_name] + [name for *_, name in deltas]:
            for field in self.spark.read.parquet(f"{self.path}/{name}").schema:
                columns.setdefault(field.name, field)
        columns.pop(_SEQ)
        full = StructType(list(columns.values()))
        seq = deltas[-1][0]
        if self.parts is None:
            with shuffles_let_go(self.spark):
                self.read(full).write.mode("overwrite").parquet(f"{self.path}/base-{seq:012d}")
            self._require(f"base-{seq:012d}")
        else:
            self._put(self.read(full), None, f"base-{seq:012d}")
        if remove_old:
            complete = sorted(
                s for s, name in self._folders()[0] if is_complete(self.spark, f"{self.path}/{name}")
            )
            seq = complete[-min(generations, len(complete))]
            newest = {writer: name for _, writer, _, name in sorted(self._folders()[1])}
            stale = [n for s, n in self._folders()[0] if s < seq]
            stale += [n for s, *_, n in self._folders()[1] if s <= seq and n not in newest.values()]
            for name in stale:
                remove_folder(self.spark, f"{self.path}/{name}")
