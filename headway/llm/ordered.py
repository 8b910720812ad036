"""Places of rows within groups of any size, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import stored


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of each run of one group; the group is the first column."""
    part = TaskContext.get().partitionId()
    last, count, leading = object(), 0, True
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(0)
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy(zero_copy_only=False)
        fresh = np.r_[True, (values[1:] != values[:-1]) | (nulls[1:] != nulls[:-1])]
        fresh[0] = (values[0], nulls[0]) != last
        rows = np.arange(batch.num_rows)
        start = np.maximum.accumulate(np.where(fresh, rows, -1))
        at = np.where(start < 0, count + rows + 1, rows - start + 1)
        starts = np.flatnonzero(fresh)
        changes = starts if last.__class__ is tuple else starts[1:]
        first = rows < (changes[0] if len(changes) else batch.num_rows) if leading else np.zeros(len(rows), bool)
        leading = leading and not len(changes)
        last, count = (values[-1], nulls[-1]), int(at[-1])
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.full(len(rows), part, np.int32)),
                pa.array(at.astype(np.int64)),
                pa.array(first),
            ],
            names=[*batch.schema.names, "_part", "_at", "_first"],
        )


def placed(rows: DataFrame, group: str, order: tuple[str, ...], label: str) -> DataFrame:
    """Narrow ``rows`` with ``pos``: 1, 2, … within each ``group`` (a long; null is one) by ``order``.

    Nulls come first.  Rows are sorted in ranges of (group, order), so a large group lies
    in several tasks; a group that goes on from one range to the next, at most one a range,
    starts there at the number of its rows before.  Rows alike in group and order have no
    order among each other.
    """
    kind = T.StructType(
        [rows.schema[group]]
        + [field for field in rows.schema.fields if field.name != group]
        + [
            T.StructField("_part", T.IntegerType()),
            T.StructField("_at", T.LongType()),
            T.StructField("_first", T.BooleanType()),
        ]
    )
    led = rows.select(group, *[name for name in rows.columns if name != group])
    ranged = led.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    found = stored(ranged.mapInArrow(_numbered, kind), label)
    # One row a range: the groups that may have begun before.
    leading = found.where("_first AND _at = 1").select(F.col(group).alias("_group")).distinct()
    same = F.col(group).eqNullSafe(F.col("_group"))
    counts = found.join(F.broadcast(leading), same).groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(
        counts.withColumn("_before", F.sum("n").over(before))
        .where("_before > 0")
        .select("_group", F.col("_part").alias("_in"), "_before"),
        f"{label}-offsets",
    )
    joined = found.join(F.broadcast(offsets), same & (F.col("_part") == F.col("_in")), "left")
    pos = F.col("_at") + F.coalesce("_before", F.lit(0))
    return joined.select(*rows.columns, pos.alias("pos"))
