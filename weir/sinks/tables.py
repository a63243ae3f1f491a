"""Load strategies on Parquet (SNK-1..SNK-4, SNK-8, SNK-9).

* append: Spark's job commit adds the new files; a rerun duplicates (SNK-1).
* snapshot tables (replace, upsert): every load writes a complete new version
  directory, then publishes it by renaming a finished marker file to
  ``_commits/<n>``. Readers take the highest marker, so a failed or lost job
  never exposes a half-written table, and the version being read is never
  the one being overwritten (SNK-2, SNK-3). The marker also holds the ledger
  of stream loads, so that a batch is in the table exactly once.
* date-partitioned marts: one directory per date; a date is replaced by
  swapping in a finished directory, also when the new result is empty (SNK-4).

Contracts are held in the pass that writes a version (SNK-7): NULL and length
checks are metrics of the write, uniqueness comes out of the upsert's own
grouping. A breach deletes the new version; nothing is published.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.operators.contract import Contract, checks
from weir.session import run_dir

# ---- tiny Hadoop FileSystem helpers (markers only, never data) -------------


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _list_names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder; fails where ``new`` exists."""
    (source, _), (target, _) = _path(spark, old), _path(spark, new)
    sc = spark.sparkContext
    files = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), sc._jsc.hadoopConfiguration())
    files.rename(source, target, sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0))


def _create_marker(spark: SparkSession, path: str, text: str) -> None:
    """Write a marker aside and rename it: a marker is never seen half-written,
    and of two loads that publish the same version one fails."""
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    p, fs = _path(spark, aside)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        _rename(spark, aside, path)
    finally:
        _delete(spark, aside)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    p, fs = _path(spark, path)
    source = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def _read_marker(spark: SparkSession, path: str) -> str:
    text = read_text(spark, path)
    if not text:
        raise ValueError(f"empty marker {path}")
    return text


# ---- append ------------------------------------------------------------------


def append(df: DataFrame, path: str) -> None:
    """Add rows to a plain Parquet table (SNK-1)."""
    df.write.mode("append").parquet(path)


def append_held(df: DataFrame, path: str, contract: Contract) -> int:
    """Append rows that are held against ``contract`` while they are written
    aside; a breach appends nothing. Returns the rows appended."""
    spark = df.sparkSession
    path = path.rstrip("/")
    aside = f"{path}/_staging-{uuid.uuid4().hex}"
    rows, obs, names = held(df, contract)
    rows.write.parquet(aside)
    try:
        refuse(obs, names)
        attempt = uuid.uuid4().hex
        for name in _list_names(spark, aside):
            if not name.startswith(("_", ".")):
                _rename(spark, f"{aside}/{name}", f"{path}/{attempt}-{name}")
    finally:
        _delete(spark, aside)
    return int(obs.get["rows"])


# ---- snapshot tables ---------------------------------------------------------


class ContractError(ValueError):
    """Rows that breach the contract of their target."""


#: Number of source rows of a key, in the output of ``merge_grouped``.
SOURCES = "_sources"


def held(df: DataFrame, contract: Contract | None, keys: Sequence[str] = ()) -> tuple[DataFrame, Observation, list[str]]:
    """``df`` with metrics that fill in while it is written: ``rows`` and, per
    check of ``contract`` but uniqueness, the rows that breach it (SNK-7).
    With ``keys``, ``df`` is the outcome of an upsert: source rows without a
    key and keys with several source rows are counted as well."""
    found = [(f"{contract.table}: {rule}({col})", cond) for rule, col, cond in checks(contract)] if contract else []
    if keys:
        empty = F.lit(False)
        for k in keys:
            empty = empty | F.col(k).isNull()
        found.append(("upsert source: rows without a key", empty & (F.col(SOURCES) > 0)))
        found.append(("upsert source: keys more than once", ~empty & (F.col(SOURCES) > 1)))
    obs = Observation(f"held-{uuid.uuid4().hex}")
    counts = [F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(found)]
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *counts).drop(SOURCES), obs, [name for name, _ in found]


def refuse(obs: Observation, names: Sequence[str]) -> None:
    """Raise if a written frame breached one of its checks."""
    got = obs.get
    broken = [f"{name} {got[f'c{i}']}x" for i, name in enumerate(names) if got[f"c{i}"]]
    if broken:
        raise ContractError(", ".join(broken))


class Published:
    """A table whose versions are published by markers ``_commits/<n>``, each a
    JSON object with what belongs to the version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self) -> list[int]:
        return sorted(int(n) for n in _list_names(self.spark, f"{self.root}/_commits") if n.isdigit())

    def version(self) -> int | None:
        return max(self._versions(), default=None)

    def _state(self, version: int | None) -> dict:
        if version is None:
            return {}
        return json.loads(_read_marker(self.spark, f"{self.root}/_commits/{version:020d}"))

    def _publish(self, version: int, state: dict) -> None:
        _create_marker(self.spark, f"{self.root}/_commits/{version:020d}", json.dumps(state))

    def loaded(self, load: tuple[str, int]) -> bool:
        """Whether the batch ``(stream, epoch)`` is part of the table: epochs of
        a stream come in order, so the ledger is one number a stream."""
        name, epoch = load
        return self._state(self.version()).get("loads", {}).get(name, -1) >= epoch

    @staticmethod
    def _ledger(state: dict, load: tuple[str, int] | None) -> dict[str, int]:
        return state.get("loads", {}) | ({load[0]: load[1]} if load else {})


class SnapshotTable(Published):
    """A Parquet table replaced as a whole by each load.

    ``cluster_by`` names columns (typically the event time a daily mart
    filters on) by which every version is sorted inside each write task: no
    extra shuffle, but each file's row groups then cover narrow ranges of
    them, so Parquet min/max statistics let a one-day read skip the other
    row groups instead of scanning the whole table.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType | None = None,
        cluster_by: Sequence[str] = (),
    ):
        super().__init__(spark, root)
        self.schema = schema
        self.cluster_by = list(cluster_by)

    def read(self) -> DataFrame:
        v = self.version()
        if v is None:
            if self.schema is None:
                raise FileNotFoundError(f"no committed version under {self.root}")
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(f"{self.root}/{self._state(v)['folder']}")

    def commit(
        self,
        df: DataFrame,
        contract: Contract | None = None,
        load: tuple[str, int] | None = None,
        keys: Sequence[str] = (),
    ) -> int:
        """Write ``df`` as the next version and publish it. Every attempt has a
        folder of its own, which its marker names: of two loads that run at
        the same time one publishes, the other fails and changes nothing.
        Rows that breach ``contract`` (or, of an upsert, the ``keys``) fail the
        load before it is published; a ``load`` that the table has already is
        left out."""
        old = self.version()
        state = self._state(old)
        if load and self.loaded(load):
            return old
        v = (old or 0) + 1
        folder = f"v={v}-{uuid.uuid4().hex}"
        if self.cluster_by:
            df = df.sortWithinPartitions(*self.cluster_by)
        df, obs, names = held(df, contract, keys)
        df.write.mode("errorifexists").parquet(f"{self.root}/{folder}")
        try:
            refuse(obs, names)
        except ContractError:
            _delete(self.spark, f"{self.root}/{folder}")
            raise
        self._publish(v, {"folder": folder, "loads": self._ledger(state, load), "rows": int(obs.get["rows"])})
        return v

    def count(self) -> int:
        """Rows of the current version, as counted by the write."""
        return int(self._state(self.version()).get("rows", 0))

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete every version older than the newest ``keep`` published ones
        (each load writes a full copy, so without this storage grows with the
        number of loads). A reader still holding a deleted version loses it:
        keep at least the current version and the one a running load reads.
        Markers go first, so no marker ever names a missing version. Returns
        the versions removed."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        old = self._versions()[:-keep]
        for v in old:
            folder = self._state(v)["folder"]
            _delete(self.spark, f"{self.root}/_commits/{v:020d}")
            _delete(self.spark, f"{self.root}/{folder}")
        return old

    def replace(self, df: DataFrame, contract: Contract | None = None) -> int:
        """Truncate-and-load in one step (SNK-2)."""
        return self.commit(df, contract)

    def upsert(
        self,
        source: DataFrame,
        keys: Sequence[str],
        update_cols: Sequence[str] | None = None,
        insert_only: Mapping[str, Column] | None = None,
        stamps: Mapping[str, Column] | None = None,
        contract: Contract | None = None,
        load: tuple[str, int] | None = None,
    ) -> int:
        """Keyed upsert as a new version (SNK-3) by the rules of ``merge``.

        The source is evaluated once, in the job that writes the version:
        target and source rows are grouped by key, which also counts the
        source rows of a key. A NULL key or a key twice fails the load."""
        if load and self.loaded(load):
            return self.version()
        target = self.read() if self.version() is not None else None
        merged = merge_grouped(target, source, keys, update_cols, insert_only, stamps)
        return self.commit(merged, contract, load, keys)


def staged_source(spark: SparkSession, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` written once below the shared folder and held against its key:
    a key column that is NULL, or a key twice, fails the load before anything
    is stored."""
    path = run_dir(spark, "upsert-source")
    source.write.parquet(path)
    staged = spark.read.schema(source.schema).parquet(path)
    empty = F.lit(False)
    for k in keys:
        empty = empty | F.col(k).isNull()
    bad = (
        staged.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.sum(F.when(empty, F.col("n"))).alias("nulls"), F.count(F.when(~empty & (F.col("n") > 1), 1)).alias("twice"))
        .first()
    )
    if bad.nulls or bad.twice:
        raise ValueError(f"upsert source: {bad.nulls or 0} rows without a key, {bad.twice} keys more than once")
    return staged


def merge(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_only: Mapping[str, Column] | None = None,
    stamps: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``INSERT .. ON CONFLICT (keys) DO UPDATE SET update_cols`` as a full outer join.

    * keys present in ``source`` take the source values of ``update_cols``
      (default: every non-key source column); other target columns keep
      their values.
    * ``insert_only`` columns (e.g. ``created_at``) get their expression on
      insert and keep the stored value on update (SNK-8).
    * ``stamps`` columns (e.g. ``updated_at``) get their expression on insert
      and on update; untouched target rows keep theirs.

    ``source`` must hold one row per key (de-duplicate first). The join
    shuffles both sides on the key; keys are unique on both sides, so no key
    can be skewed.
    """
    insert_only = dict(insert_only or {})
    stamps = dict(stamps or {})
    data_cols = [c for c in source.columns if c not in keys]
    clash = sorted(set(data_cols) & (set(insert_only) | set(stamps)))
    if clash:
        raise ValueError(f"stamps would replace source columns: {', '.join(clash)}")
    update_cols = list(update_cols if update_cols is not None else data_cols)
    out_cols = list(keys) + data_cols + [c for c in insert_only if c not in data_cols] + [
        c for c in stamps if c not in data_cols and c not in insert_only
    ]
    src = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in data_cols], F.lit(True).alias("_s_hit"))
    if target is None:
        return src.select(
            *keys,
            *[F.col(f"_s_{c}").alias(c) for c in data_cols if c not in insert_only and c not in stamps],
            *[expr.alias(c) for c, expr in insert_only.items()],
            *[expr.alias(c) for c, expr in stamps.items() if c not in insert_only],
        ).select(*out_cols)
    extra = [c for c in target.columns if c not in out_cols]
    out_cols += extra
    tgt = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys], F.lit(True).alias("_t_hit"))
    j = tgt.join(src, list(keys), "full_outer")
    tcols = set(target.columns)
    return j.select(
        *_merged_columns(
            out_cols, keys, data_cols, update_cols, insert_only, stamps,
            t=lambda c: F.col(f"_t_{c}") if c in tcols else F.lit(None),
            s=lambda c: F.col(f"_s_{c}"),
            hit_t=F.col("_t_hit").isNotNull(),
            hit_s=F.col("_s_hit").isNotNull(),
        )
    )


def merge_grouped(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    insert_only: Mapping[str, Column] | None = None,
    stamps: Mapping[str, Column] | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``merge`` by grouping: each side is grouped by key (a source that comes
    from a window on the key is not shuffled again), and the target and source
    row of a key meet in a full outer join of the groups. ``_sources`` counts
    the source rows of the key, so that the caller can refuse a key that comes
    twice; ``extra`` columns may use ``_t`` and ``_s``, the two rows as structs
    (null where a side lacks the key)."""
    insert_only, stamps = dict(insert_only or {}), dict(stamps or {})
    keys = list(keys)
    data_cols = [c for c in source.columns if c not in keys]
    clash = sorted(set(data_cols) & (set(insert_only) | set(stamps)))
    if clash:
        raise ValueError(f"stamps would replace source columns: {', '.join(clash)}")
    update_cols = list(update_cols if update_cols is not None else data_cols)
    out_cols = keys + data_cols + [c for c in [*insert_only, *stamps] if c not in data_cols]
    out_cols = list(dict.fromkeys(out_cols))
    tcols = [c for c in target.columns if c not in keys] if target is not None else []
    out_cols += [c for c in tcols if c not in out_cols]
    # a struct column of its own keeps a side apart from its values, all of which may be null
    s_side = F.struct(F.lit(True).alias("_hit"), *data_cols)
    t_type = T.StructType([T.StructField("_hit", T.BooleanType()), *[target.schema[c] for c in tcols]] if target is not None else [])

    # shuffled before grouping: partial groups would only add a sort of the
    # unshuffled rows, as keys are unique on each side
    def grouped(rows: DataFrame, side: Column, name: str, *counts: Column) -> DataFrame:
        sides = rows.select(*keys, side.alias(name)).repartition(*[F.col(k) for k in keys])
        return sides.groupBy(*keys).agg(F.first(name).alias(name), *counts)

    pairs = grouped(source, s_side, "_s", F.count(F.lit(1)).alias(SOURCES))
    if target is None:
        pairs = pairs.withColumn("_t", F.lit(None).cast(t_type))
    else:
        t_side = F.struct(F.lit(True).alias("_hit"), *tcols)
        pairs = grouped(target, t_side, "_t").join(pairs, keys, "full_outer").fillna(0, [SOURCES])
    present = set(tcols)
    columns = _merged_columns(
        out_cols, keys, data_cols, update_cols, insert_only, stamps,
        t=lambda c: F.col("_t").getField(c) if c in present else F.lit(None),
        s=lambda c: F.col("_s").getField(c),
        hit_t=F.col("_t").isNotNull(),
        hit_s=F.col("_s").isNotNull(),
    )
    return pairs.select(*columns, SOURCES, *[c.alias(n) for n, c in (extra or {}).items()])


def _merged_columns(out_cols, keys, data_cols, update_cols, insert_only, stamps, t, s, hit_t, hit_s) -> list[Column]:
    """The upsert rule per output column, given accessors of the target
    (``t``) and source (``s``) value of a column and whether each side has
    the key."""
    exprs = []
    for c in out_cols:
        if c in keys:
            exprs.append(F.col(c))
        elif c in insert_only:
            exprs.append(F.when(hit_t, t(c)).otherwise(insert_only[c]).alias(c))
        elif c in stamps:
            exprs.append(F.when(hit_s, stamps[c]).otherwise(t(c)).alias(c))
        elif c in update_cols:
            exprs.append(F.when(hit_s, s(c)).otherwise(t(c)).alias(c))
        elif c in data_cols:
            # listed in the source but not updated: set on insert only
            exprs.append(F.when(hit_t, t(c)).otherwise(s(c)).alias(c))
        else:
            exprs.append(t(c).alias(c))
    return exprs


# ---- key-bucketed tables (upsert rewrites only touched buckets) ---------------

BUCKET = "_bucket"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key: ``pmod(xxhash64(keys), buckets)``."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


class KeyBucketedTable:
    """A keyed Parquet table stored as ``_bucket=<i>`` folders, ``i`` a hash
    of the key, for targets far larger than one load (SNK-3 at scale).

    An upsert costs what its source touches, not the table size:

    * the source's bucket ids (at most ``buckets`` integers, a bound fixed
      by the table, never by the data) become a partition filter of the
      target scan, so only touched buckets are read. They are fetched
      explicitly rather than left to dynamic partition pruning, which Spark
      skips when it cannot estimate the source's size — the load would then
      silently scan the whole target;
    * touched target rows and source rows are unioned, shuffled once on the
      bucket and grouped per key (one target and one source row at most),
      and the upsert rule of ``merge`` picks each column;
    * the result, still partitioned by bucket, is written with dynamic
      partition overwrite: exactly the touched buckets are replaced, one
      file each.

    Keys are unique in the table, so a bucket holds about 1/``buckets`` of
    the rows whatever the key distribution; choose ``buckets`` so a bucket is
    a few hundred MB, and keep it for the life of the table.

    Replacement is per bucket. A job lost before its commit changes nothing;
    one lost during the commit leaves every bucket either as it was or
    merged, and re-running the load (same run time) gives the same table.
    Unlike ``SnapshotTable``, a reader during a commit may see old and new
    buckets side by side.

    ``cluster_by`` sorts each bucket file by those columns (e.g. the event
    time a daily mart filters on), as in ``SnapshotTable``.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        buckets: int,
        schema: T.StructType | None = None,
        cluster_by: Sequence[str] = (),
    ):
        if buckets < 1:
            raise ValueError("buckets must be positive")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.buckets = buckets
        self.schema = schema
        self.cluster_by = list(cluster_by)

    def exists(self) -> bool:
        return any(n.startswith(f"{BUCKET}=") for n in _list_names(self.spark, self.root))

    def read(self) -> DataFrame:
        if not self.exists():
            if self.schema is None:
                raise FileNotFoundError(f"no data under {self.root}")
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(self.root).drop(BUCKET)

    def upsert(
        self,
        source: DataFrame,
        keys: Sequence[str] | None = None,
        update_cols: Sequence[str] | None = None,
        insert_only: Mapping[str, Column] | None = None,
        stamps: Mapping[str, Column] | None = None,
    ) -> None:
        """``INSERT .. ON CONFLICT (keys) DO UPDATE`` with the rules of
        ``merge``; ``source`` holds one row per key."""
        if keys is not None and list(keys) != self.keys:
            raise ValueError(f"table is keyed on {self.keys}, not {list(keys)}")
        keys = self.keys
        # written once: the bucket ids and the rows come from the same evaluation
        source = staged_source(self.spark, source, keys)
        src = source.withColumn(BUCKET, key_bucket(keys, self.buckets))
        if not self.exists():
            first = merge(None, src, [BUCKET, *keys], update_cols, insert_only, stamps)
            self._write(first.repartition(BUCKET))
            return
        insert_only = dict(insert_only or {})
        stamps = dict(stamps or {})
        data_cols = [c for c in source.columns if c not in keys]
        update_cols = list(update_cols if update_cols is not None else data_cols)
        touched = [r[0] for r in src.select(BUCKET).distinct().collect()]
        if len(touched) > self.buckets:
            raise AssertionError("more bucket ids than buckets")
        if not touched:
            return  # empty source: nothing to insert or update
        target = self.spark.read.parquet(self.root).filter(F.col(BUCKET).isin(touched))
        tcols = [c for c in target.columns if c not in keys and c != BUCKET]
        t_type = T.StructType([target.schema[c] for c in tcols])
        s_type = T.StructType([source.schema[c] for c in data_cols])
        rows = target.select(
            BUCKET, *keys, F.struct(*tcols).alias("_t"), F.lit(None).cast(s_type).alias("_s")
        ).unionByName(
            src.select(BUCKET, *keys, F.lit(None).cast(t_type).alias("_t"), F.struct(*data_cols).alias("_s"))
        )
        pairs = rows.repartition(BUCKET).groupBy(BUCKET, *keys).agg(
            F.first("_t", ignorenulls=True).alias("_t"), F.first("_s", ignorenulls=True).alias("_s")
        )
        out_cols = keys + data_cols + [c for c in insert_only if c not in data_cols] + [
            c for c in stamps if c not in data_cols and c not in insert_only
        ]
        out_cols += [c for c in tcols if c not in out_cols]
        present_t = set(tcols)
        merged = pairs.select(
            BUCKET,
            *_merged_columns(
                out_cols, keys, data_cols, update_cols, insert_only, stamps,
                t=lambda c: F.col("_t").getField(c) if c in present_t else F.lit(None),
                s=lambda c: F.col("_s").getField(c),
                hit_t=F.col("_t").isNotNull(),
                hit_s=F.col("_s").isNotNull(),
            ),
        )
        self._write(merged)

    def _write(self, df: DataFrame) -> None:
        if self.cluster_by:
            # the writer needs rows ordered by bucket; this order extends it
            df = df.sortWithinPartitions(BUCKET, *self.cluster_by)
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.root)
        )


# ---- date-partitioned tables -------------------------------------------------


def replace_date(
    df: DataFrame, root: str, date_col: str, ds: str | dt.date, contract: Contract | None = None
) -> None:
    """Delete the rows of day ``ds`` and insert ``df``'s rows of that day (SNK-4).

    The result is written to a hidden folder, the day's folder is renamed
    aside, the new one takes its place, and only then the old one is deleted.
    A job that fails leaves the day as it was; a driver lost between the two
    renames leaves the day missing, with its old rows in ``_old-*``, until the
    load is rerun. A reader that listed the day before the swap loses its
    files; ``weir.sinks.dated.DatedTable`` publishes days without that gap. An
    empty result leaves the day empty, and a rerun is idempotent.
    """
    spark = df.sparkSession
    day = ds if isinstance(ds, dt.date) else dt.date.fromisoformat(str(ds))
    root = root.rstrip("/")
    attempt = uuid.uuid4().hex
    staging, aside = f"{root}/_staging-{attempt}", f"{root}/_old-{attempt}"
    df, obs, names = held(df.filter(F.col(date_col) == F.lit(day)), contract)
    df.drop(date_col).write.parquet(staging)
    try:
        refuse(obs, names)
    except ContractError:
        _delete(spark, staging)
        raise
    target = f"{root}/{date_col}={day.isoformat()}"
    if f"{date_col}={day.isoformat()}" in _list_names(spark, root):
        _rename(spark, target, aside)
    _rename(spark, staging, target)
    _delete(spark, aside)


def replace_dates(df: DataFrame, root: str, date_col: str, spread_by: Sequence[str] = (), partitions: int | None = None) -> None:
    """Backfill: replace every day present in ``df``, leave the other days.

    Dynamic partition overwrite; a day absent from ``df`` is not cleared
    (use ``replace_date`` for that). Rows are range-partitioned on the day
    plus ``spread_by`` first: each task then writes a contiguous run of days
    (few files per day), and a hot day still splits across tasks because the
    range bounds also cut on ``spread_by``.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(parts, date_col, *spread_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(root)
    )


def read_partitioned(spark: SparkSession, root: str, date_col: str) -> DataFrame:
    """Read a date-partitioned table; the partition column comes back as DATE."""
    df = spark.read.option("basePath", root).parquet(root)
    return df.withColumn(date_col, F.col(date_col).cast("date"))
