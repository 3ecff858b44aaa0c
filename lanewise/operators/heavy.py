"""The most frequent groups of very many."""

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .reports import count_report
from .skew import broadcast_if, fits_in_memory

#: Groups that a task's sketch keeps.
COUNTERS = 10_000


def _sketched(counters: int):
    """A task's counts in bounded memory (Misra and Gries): each kept count is at most
    ``missed`` below the true one, and a group that is not kept has at most ``missed`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        missed = 0
        for batch in batches:
            values = pc.value_counts(batch.column(0))
            for group, n in zip(values.field("values").to_pylist(), values.field("counts").to_pylist(), strict=True):
                kept[group] += n
            if len(kept) > counters:
                cut = sorted(kept.values(), reverse=True)[counters]
                missed += cut
                kept = Counter({group: n - cut for group, n in kept.items() if n > cut})
        groups = [*kept, None]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(groups, pa.string()),
                pa.array([*kept.values(), 0], pa.int64()),
                pa.array([0] * len(kept) + [missed], pa.int64()),
            ],
            ["group", "least", "missed"],
        )

    return run


def _group_text(keys: Sequence[str]) -> Column:
    """One text per group; nulls are left out of it, which no value can look like."""
    return F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]))


def top_groups(
    df: DataFrame,
    keys: Sequence[str],
    n: int,
    where: str | Column | None = None,
    name: str = "count",
    counters: int = COUNTERS,
) -> DataFrame:
    """The ``n`` groups of most rows, ordered by their count and then by their keys.

    The result of ``count_report`` with a limit, for tables with so many groups that their
    counts are not worth shuffling.  A first pass keeps ``counters`` groups a task and how far
    their counts can be off.  If the n-th of these is surely above every group that was not
    kept, only groups that can be among the first are counted, exactly, in a second pass.
    Where the sketches do not decide that, all groups are counted.
    """
    rows = df if where is None else df.filter(where)
    text = rows.select(_group_text(keys).alias("group"))
    found = store(text.mapInArrow(_sketched(counters), "group string, least long, missed long"), "sketches")
    missed = found.agg(F.sum("missed")).first()[0] or 0
    merged = found.filter("group is not null").groupBy("group").agg(F.sum("least").alias("least"))
    first = merged.orderBy(F.desc("least")).limit(n)
    floor, number = first.agg(F.min("least"), F.count(F.lit(1))).first()
    order = [F.desc(name), *[F.col(f"`{k}`") for k in keys]]
    if missed and (number < n or floor <= missed):
        return count_report(rows, list(keys), name=name, order_by=order, limit=n)
    # Sketches hold a fixed number of groups a task, so these are few.
    chosen = store(merged.filter(F.col("least") + missed >= (floor or 0)).select("group"), "candidates")
    marked = rows.withColumn("__group", _group_text(keys))
    marked = marked.join(broadcast_if(chosen, fits_in_memory(chosen)), F.col("__group") == F.col("group"), "semi")
    return count_report(marked, list(keys), name=name, order_by=order, limit=n)
