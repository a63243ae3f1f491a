"""Keyed facts in one folder per event date (SRC-5, FIL-6, SNK-3, SNK-4).

A daily mart reads the folders of its day; a keyed upsert reads and rewrites
the days its keys have and get, nothing else. Two small things make that
possible:

* a key index, (key, date) of every key as of each load: an upsert looks up
  the dates its keys have now, so that a key whose date moves leaves its old
  day. A load adds the entries it changes; the latest entry of a key counts.
* a marker per version (``weir.sinks.tables.Published``) that names the folder
  of every day. New days are written aside, in one job, and appear together
  when the marker is renamed into place: a lost job changes nothing, a reader
  sees one version, an emptied day is gone.

The marker is as long as the table has days.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.operators.contract import Contract
from weir.sinks.tables import ContractError, Published, _delete, _list_names, held, merge_grouped, refuse

_LOAD = "load_id"
#: Loads whose index entries are read side by side before they are rewritten as one.
INDEX_LOADS = 16
#: Rows of a day in one file, about.
ROWS_PER_FILE = 2_000_000


@dataclass
class Changes:
    """What a load did: the days that have other rows than before, and the
    keys inserted, changed (moved ones included) and found equal."""

    days: list[dt.date] = field(default_factory=list)
    inserted: int = 0
    changed: int = 0
    equal: int = 0


class DatedTable(Published):
    """A keyed table with a folder per value of ``date_col``, the date of
    ``event_time`` (or a DATE column of the rows themselves).

    ``cluster_by`` sorts the rows inside a file.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        date_col: str = "event_date",
        event_time: str | None = None,
        cluster_by: Sequence[str] = (),
    ):
        super().__init__(spark, root)
        self.keys = list(keys)
        self.date_col = date_col
        self.event_time = event_time
        self.cluster_by = list(cluster_by)

    # ---- read ----

    def days(self) -> list[dt.date]:
        return sorted(dt.date.fromisoformat(d) for d in self._state(self.version()).get("days", {}))

    def folder(self, day: dt.date) -> str:
        """The folder that holds ``day`` in the current version."""
        return f"{self.root}/data/{_LOAD}={self._state(self.version())['days'][day.isoformat()]}/{self.date_col}={day.isoformat()}"

    def read(self, days: Sequence[dt.date] | None = None) -> DataFrame:
        """The rows, or those of ``days``: only their folders are listed. A
        filter on the date column prunes folders as well."""
        state = self._state(self.version())
        if not state:
            raise FileNotFoundError(f"no committed version under {self.root}")
        schema = T.StructType.fromJson(state["schema"])
        wanted = set(state["days"]) if days is None else {d.isoformat() for d in days}
        by_load: dict[str, list[str]] = {}
        for day, load in sorted(state["days"].items()):
            if day in wanted:
                by_load.setdefault(load, []).append(day)
        paths = []
        for load, its in by_load.items():
            folder = f"{self.root}/data/{_LOAD}={load}"
            whole = len(its) == state["written"][load]  # all that the load wrote: one folder to list
            paths += [folder] if whole else [f"{folder}/{self.date_col}={day}" for day in its]
        if not paths:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, T.StructField(_LOAD, T.StringType())])
        return self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths).drop(_LOAD)

    def _index(self, state: dict) -> DataFrame | None:
        """(keys, date, nth): the entries of all loads."""
        if not state.get("index"):
            return None
        fields = [f for f in T.StructType.fromJson(state["schema"]).fields if f.name in self.keys]
        schema = T.StructType([*fields, T.StructField("_date", T.DateType()), T.StructField("_nth", T.LongType())])
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/index/{name}" for name in state["index"]])

    # ---- write ----

    def upsert(
        self,
        source: DataFrame,
        keys: Sequence[str] | None = None,
        update_cols: Sequence[str] | None = None,
        insert_only: Mapping[str, Column] | None = None,
        stamps: Mapping[str, Column] | None = None,
        contract: Contract | None = None,
        load: tuple[str, int] | None = None,
    ) -> Changes:
        """Keyed upsert (rules of ``merge``) of the days that the source's keys
        have or get. A row without a date, a NULL key or a key twice, and a
        breach of ``contract`` fail the load; a ``load`` that the table has
        already is left out."""
        if keys is not None and list(keys) != self.keys:
            raise ValueError(f"table is keyed on {self.keys}, not {list(keys)}")
        if load and self.loaded(load):
            return Changes()
        version = self.version() or 0
        state = self._state(version or None)
        attempt = uuid.uuid4().hex
        d = self.date_col
        date = F.to_date(self.event_time) if self.event_time else F.col(d)
        # written once: its keys, its days and its rows are asked for separately
        path = f"{self.root}/_staging/{attempt}"
        source.withColumn(d, date).write.parquet(path)
        staged = self.spark.read.parquet(path)
        key = [F.col(k) for k in self.keys]
        new = staged.select(*key, F.col(d).alias("_new"))
        index = self._index(state)
        if index is None:
            known = new.withColumn("_old", F.lit(None).cast("date"))
        else:
            mine = index.join(new.select(*key), self.keys, "left_semi")
            latest = mine.groupBy(*key).agg(F.max_by("_date", "_nth").alias("_old"))
            known = new.join(latest, self.keys, "left")
        moves = known.where("_old is null or _old <> _new")
        # at most as many rows as there are days
        touched = known.select(F.explode(F.array("_old", "_new")).alias("day")).where("day is not null").groupBy("day").count()
        rows = {r.day: r["count"] for r in touched.collect()}
        days = list(rows)
        have = set(state.get("days", {}))
        target = self.read([x for x in days if x.isoformat() in have]) if state else None
        if target is not None:
            for r in target.groupBy(d).count().collect():
                rows[r[d]] += r["count"]
        if update_cols is not None and d not in update_cols:
            update_cols = [*update_cols, d]  # the date follows the event time
        compared = [c for c in (update_cols or staged.columns) if target is not None and c in target.columns and c not in self.keys]
        same = F.lit(True)
        for c in compared:
            was, now = F.col("_t").getField(c), F.col("_s").getField(c)
            if isinstance(staged.schema[c].dataType, T.VariantType):  # compared as text: it has no equality
                was, now = F.to_json(was), F.to_json(now)
            same = same & was.eqNullSafe(now)
        merged = merge_grouped(
            target, staged, self.keys, update_cols, insert_only, stamps,
            extra={
                "_kind": F.when(F.col("_s").isNull(), "kept").when(F.col("_t").isNull(), "inserted").when(same, "equal").otherwise("changed"),
                "_was": F.col("_t").getField(d) if target is not None else F.lit(None).cast("date"),
            },
        )
        merged, obs, names = held(merged, contract, self.keys)
        kinds = {k: F.count_if(F.col("_kind") == k).alias(k) for k in ("inserted", "equal", "changed")}
        differs = F.col("_kind").isin("inserted", "changed")
        merged, seen = self._watched(
            merged, *kinds.values(), F.count_if(F.col(d).isNull()).alias("undated"),
            F.collect_set(F.when(differs, F.col(d))).alias("to"), F.collect_set(F.when(differs, F.col("_was"))).alias("from"),
        )
        merged = merged.drop("_kind", "_was")
        written = self._write(merged, attempt, rows)
        try:
            refuse(obs, names)
            got = seen.get
            if got["undated"]:
                raise ContractError(f"{got['undated']} rows without {d}")
            if not moves.isEmpty():
                entry = moves.select(*key, F.col("_new").alias("_date"), F.lit(version + 1).cast("long").alias("_nth"))
                entry.write.parquet(f"{self.root}/index/{attempt}")
                entries = [*state.get("index", []), attempt]
            else:
                entries = state.get("index", [])
            kept = {day: at for day, at in state.get("days", {}).items() if dt.date.fromisoformat(day) not in set(days)}
            next_state = {
                **self._after(state, kept, written, attempt),
                "index": entries,
                "loads": self._ledger(state, load),
                "schema": merged.schema.jsonValue(),
            }
            if len(entries) > INDEX_LOADS:
                next_state["index"] = [self._compacted(next_state)]
            self._publish(version + 1, next_state)
        except Exception:
            _delete(self.spark, f"{self.root}/data/{_LOAD}={attempt}")
            raise
        finally:
            _delete(self.spark, path)
        return Changes(
            sorted({x for x in [*got["to"], *got["from"]] if x is not None}), int(got["inserted"]), int(got["changed"]), int(got["equal"])
        )

    def replace_days(
        self, df: DataFrame, days: Sequence[dt.date], contract: Contract | None = None, rows: Mapping[dt.date, int] | None = None
    ) -> None:
        """The rows of ``days`` become those of ``df`` (SNK-4); a day without
        rows is gone. All days change together. For tables that are computed
        as a whole by day, such as marts; keys are not indexed. ``rows`` says
        how many rows a day may have, so that a large one is cut into files."""
        version = self.version() or 0
        state = self._state(version or None)
        if state.get("index"):
            raise ValueError("days of a table with a key index change by upsert only")
        attempt = uuid.uuid4().hex
        out, obs, names = held(df.where(F.col(self.date_col).isin(list(days))), contract)
        written = self._write(out, attempt, rows or {})
        try:
            refuse(obs, names)
        except ContractError:
            _delete(self.spark, f"{self.root}/data/{_LOAD}={attempt}")
            raise
        gone = {x.isoformat() for x in days}
        kept = {day: at for day, at in state.get("days", {}).items() if day not in gone}
        self._publish(version + 1, {**self._after(state, kept, written, attempt), "schema": df.schema.jsonValue()})

    @staticmethod
    def _after(state: dict, kept: dict[str, str], written: list[str], attempt: str) -> dict:
        """The folders of the days, and how many days each folder in use was written with."""
        days = kept | {day: attempt for day in written}
        sizes = state.get("written", {}) | {attempt: len(written)}
        return {"days": days, "written": {load: n for load, n in sizes.items() if load in set(days.values())}}

    @staticmethod
    def _watched(df: DataFrame, *metrics: Column):
        obs = Observation(f"seen-{uuid.uuid4().hex}")
        return df.observe(obs, *metrics), obs

    def _write(self, df: DataFrame, attempt: str, rows: Mapping[dt.date, int]) -> list[str]:
        """Write rows by day below a folder of their own; the days written. A
        day goes to one task and file per ``ROWS_PER_FILE`` rows: a hot day is
        cut by key, a small day is one file."""
        d = self.date_col
        path = f"{self.root}/data/{_LOAD}={attempt}"
        hot = {day: -(-n // ROWS_PER_FILE) for day, n in rows.items() if n > ROWS_PER_FILE}
        piece = F.lit(0).cast("long")
        if hot:  # as many entries as days, at most
            files = F.create_map(*[F.lit(x) for day, n in hot.items() for x in (day, n)])
            piece = F.pmod(F.xxhash64(*self.keys), F.coalesce(F.try_element_at(files, F.col(d)), F.lit(1)))
        # a set number of partitions: small ones are not merged, as the files
        # of many small days are the work here, not their bytes
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        out = df.withColumn("_piece", piece).repartition(parts, F.col(d), F.col("_piece")).drop("_piece")
        if self.cluster_by:
            out = out.sortWithinPartitions(d, *self.cluster_by)
        out.write.partitionBy(d).parquet(path)
        prefix = f"{d}="
        return [n[len(prefix) :] for n in _list_names(self.spark, path) if n.startswith(prefix) and n[len(prefix) :][:1] != "_"]

    def _compacted(self, state: dict) -> str:
        """The index rewritten as its latest entries."""
        name = uuid.uuid4().hex
        latest = self._index(state).groupBy(*self.keys).agg(F.max(F.struct("_nth", "_date")).alias("x"))
        latest.select(*self.keys, "x._date", "x._nth").write.parquet(f"{self.root}/index/{name}")
        return name
