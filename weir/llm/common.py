"""Helpers shared by the operators: staged tables, grouped Arrow maps,
distributed ranks and connected components.

Every lineage cut is a Parquet table below the shared folder that the cluster
names in ``spark.checkpoint.dir`` (``weir.session.run_dir``), so a lost
executor costs at most the tasks it was running.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weir.session import run_dir


def table(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


class Stage:
    """The staged tables of one operator run, below one folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = run_dir(spark, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a staged table that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished steps now: its
        cleaner only notices unreachable shuffles when the driver collects
        garbage, which it may put off for a long time. Twice, as the first
        round frees what holds the references of the second."""
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(1)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(ddl)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], ddl: str
) -> DataFrame:
    """``fn`` takes an Arrow batch and yields column dicts (arrays of equal length)."""
    schema = struct(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = arrow_schema(schema)
        for batch in batches:
            if batch.num_rows:
                for cols in fn(batch):
                    yield to_batch(cols, out)

    return df.mapInArrow(run, schema)


def to_batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        a = cols[field.name]
        if isinstance(a, pa.ChunkedArray):
            a = a.combine_chunks()
        arrays.append(a.cast(field.type) if isinstance(a, pa.Array) else pa.array(a, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def by_group(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[[tuple, pa.Table], Iterator[dict] | list[dict]],
    ddl: str,
    rows_out: int = 20_000,
    bytes_out: int = 16_000_000,
) -> DataFrame:
    """``fn`` once per key, over many small groups: one hash shuffle, one sort,
    and a streaming split of each task's Arrow batches at key changes. Spares
    the per-group pandas conversion of ``applyInPandas``. Keys are long
    columns without nulls; callers bound the size of a group. Results go on
    after ``rows_out`` rows or ``bytes_out`` bytes."""
    schema = struct(ddl)
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_schema = arrow_schema(schema)
        held: list[pa.RecordBatch] = []
        last: tuple | None = None
        out: list[pa.RecordBatch] = []
        n_out = size = 0

        def emit(key, parts):
            nonlocal n_out, size
            for c in fn(key, pa.Table.from_batches(parts)):
                out.append(to_batch(c, out_schema))
                n_out += out[-1].num_rows
                size += out[-1].nbytes
                if n_out >= rows_out or size >= bytes_out:
                    yield from flush()

        def flush():
            nonlocal out, n_out, size
            if out:
                t = pa.Table.from_batches(out, schema=out_schema).combine_chunks()
                out, n_out, size = [], 0, 0
                yield from t.to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows - 1, dtype=bool)
            for c in cols:
                change |= c[1:] != c[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                key = tuple(int(c[a]) for c in cols)
                if held and key != last:
                    yield from emit(last, held)
                    held = []
                last = key
                held.append(batch.slice(a, b - a))
        if held:
            yield from emit(last, held)
        yield from flush()

    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(run, schema)


def ranked(
    stage: Stage,
    df: DataFrame,
    order: Sequence[Column],
    name: str,
    group: Sequence[str] = (),
    weight: Column | None = None,
    out: str = "rank",
) -> DataFrame:
    """Running sum of ``weight`` (default 1) *before* each row, in ``order``,
    within ``group``, without putting a group in one task.

    Rows are range-partitioned by ``order`` (which must start with the group
    columns) and staged with their partition number. Sums inside a partition
    are windows over that partition; the offset of a (partition, group) is a
    running sum over at most one row per partition of the group.
    """
    weight = F.lit(1).cast("long") if weight is None else weight
    staged = stage.write(
        df.withColumn("_w", weight.cast("long"))
        .repartitionByRange(*order)
        .withColumn("_pid", F.spark_partition_id().cast("long")),
        name,
    )
    part = ["_pid", *group]
    # a task's rows: at most one range partition
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = staged.groupBy(*part).agg(F.sum("_w").alias("_t"))
    offsets = totals.select(
        *[F.col(c).alias(f"_o_{c}") for c in part], F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off")
    )
    cond = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in part]
    joined = staged.join(offsets, cond, "left")
    return joined.withColumn(out, F.col("_off") + F.sum("_w").over(inside) - F.col("_w")).drop(
        "_w", "_pid", "_off", *[f"_o_{c}" for c in part]
    )


def components(stage: Stage, edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) by alternating large-star
    and small-star steps: (node, component), component = smallest node.

    Each step is a grouped minimum (map-side combined) joined back to the
    edges; a hub node is a skewed join key, which AQE splits. Every round is
    staged in the shared folder. Nodes without an edge do not appear.
    """
    e = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    e = stage.write(e, f"{name}-0")
    mark = None
    for i in range(1, max_rounds + 1):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low2 = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low2, "hi")
        nxt = (
            small.select("hi", F.col("m").alias("lo"))
            .unionByName(small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
            .distinct()
        )
        e = stage.write(nxt, f"{name}-{i}")
        new = e.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.pmod(F.xxhash64("hi", "lo"), F.lit(1_000_000_007))).alias("h"),
        ).first()
        if i > 1:
            stage.drop(f"{name}-{i - 2}")
        if mark == (new.n, new.h):
            break
        mark = (new.n, new.h)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
