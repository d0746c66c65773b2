"""History tables on a catalog without row-level writes.

A keyed table is a Parquet table with a partition column of its own, ``_slice``: the
hash of the merge key, modulo the number of slices. It is also bucketed by the key,
into as many buckets, so a slice is one file and Spark joins the table in place. A
merge joins the incoming rows with the slices that they touch, and writes those
with dynamic partition overwrite: Spark replaces these partitions and leaves all
others alone. Only the incoming rows are shuffled.

What a merge costs in writing is the touched slices: rows whose keys are spread touch
all of them, and then the table is written anew. A table that takes few and scattered
changes belongs on a catalog with row-level writes; see ``merge_into``.

A failed write leaves the table as it was, unless it fails while Spark exchanges the
partitions; a merge is repeated with the same result. Whole tables are replaced by
writing a new folder and pointing the table's name, a view, at it. The load log has one
entry for each write. One writer per table is assumed.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from math import ceil
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from assaylake.functions.columns import ts_lit
from assaylake.operators.upsert import any_null, changed_rows, require_no_conflicts, upsert
from assaylake.sources.bronze import read_if_present

log = logging.getLogger(__name__)

LOG_SCHEMA = (
    "table string, version int, op string, rows long, load_ts timestamp, path string, "
    "keys array<string>, slices int, unique_keys boolean"
)
PROFILE_SCHEMA = "table string, version int, column string, rows long, nulls long, load_ts timestamp"
#: Partition column of keyed tables; the views do not show it.
SLICE = "_slice"
#: A source whose share of a slice is below this is hashed, so the history is not sorted.
HASH_BYTES = 64 << 20
#: Bytes of its source files that a slice is to hold at the most, where the number of slices follows from them.
SLICE_BYTES = 16 << 20


class State(NamedTuple):
    """What the log says of a table; ``slices`` is None for a table without key."""

    version: int
    rows: int
    path: str
    keys: tuple[str, ...]
    slices: int | None
    unique_keys: bool


class TableStore:
    """Tables below one base folder, which all executors can reach.

    ``buckets`` is the number of slices a keyed table is split into; choose it so
    that one slice fits a task. By default a new table gets as many as there are
    shuffle partitions, and an old one keeps its number. ``keep`` is the number of
    folders of a table that stay, the current one included; a new one begins
    when the whole table is written.
    """

    def __init__(
        self, spark: SparkSession, base: str, buckets: int | None = None, keep: int = 2
    ):
        if keep < 2:
            raise ValueError("the folder being read cannot be the one being written")
        self.spark = spark
        self.base = base.rstrip("/")
        self.buckets = buckets
        self.keep = keep
        self._log_path, self._profile_path = f"{self.base}/_load_log", f"{self.base}/_load_profile"
        self._current: dict[str, State] = {}
        self._attach()

    # ---- catalog ------------------------------------------------------------

    def create_namespace(self, namespace: str) -> None:
        try:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{namespace}`")
        except Exception as e:  # a catalog may forbid it and yet hold the schema
            log.warning("schema %s: %s", namespace, e)

    def exists(self, name: str) -> bool:
        """Whether this store has the table; the log decides, not the catalog."""
        return name in self._current

    def tables(self, namespace: str) -> list[str]:
        """Names of the current tables, without their versions."""
        return sorted(n.split(".")[1] for n in self._current if n.split(".")[0] == namespace)

    def columns(self, name: str) -> DataFrame:
        """Column names and types of a table."""
        return self.spark.createDataFrame(
            [(f.name, f.dataType.simpleString()) for f in self.read(name).schema.fields],
            "col_name string, data_type string",
        )

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def unique_keys(self, name: str) -> bool:
        """Whether the table has one row per non-null key, as far as its loads tell."""
        return self._current[name].unique_keys

    def namespaces(self) -> list[str]:
        return sorted(d.name for d in self.spark.catalog.listDatabases())

    def sample(self, name: str, n: int = 10) -> DataFrame:
        return self.read(name).limit(n)

    def history(self, name: str | None = None) -> DataFrame:
        """The load log: one row per version, oldest first."""
        entries = self._log()
        if name is not None:
            entries = entries.filter(F.col("table") == name)
        return entries.orderBy("table", "version")

    def profiles(self, name: str | None = None) -> DataFrame:
        """Rows and nulls of the loads that were profiled: one row per version and column."""
        entries = read_if_present(self.spark, self._profile_path)
        entries = self.spark.createDataFrame([], PROFILE_SCHEMA) if entries is None else entries
        return (entries if name is None else entries.filter(F.col("table") == name)).orderBy("table", "version", "column")

    def _log_profile(self, name: str, columns: Sequence[str], seen: dict, load_ts) -> None:
        version = self._current[name].version
        rows = [(name, version, c, seen["rows"], seen[f"nulls{i}"]) for i, c in enumerate(columns)]
        entries = self.spark.createDataFrame(rows, "table string, version int, column string, rows long, nulls long")
        entries = entries.withColumn("load_ts", ts_lit(load_ts)).select("table", "version", "column", "rows", "nulls", "load_ts")
        entries.coalesce(1).write.mode("append").parquet(self._profile_path)

    def _log(self) -> DataFrame:
        logged = read_if_present(self.spark, self._log_path)
        return logged if logged is not None else self.spark.createDataFrame([], LOG_SCHEMA)

    def _attach(self) -> None:
        """Point every table at what its last write has left."""
        whole = F.struct(*State._fields)
        for e in self._log().groupBy("table").agg(F.max_by(whole, "version").alias("e")).collect():
            state = State(*e["e"])._replace(keys=tuple(e["e"]["keys"]))
            self._current[e["table"]] = state
            self.create_namespace(e["table"].split(".")[0])
            self._attach_data(e["table"], state)
            self._point(e["table"], state)

    def _attach_data(self, name: str, state: State) -> None:
        data = _data_table(name, state.path)
        if self._location(data) is not None:
            return
        fields = self.spark.read.parquet(state.path).schema.fields
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        layout = ""
        if state.slices:
            keys = ", ".join(f"`{k}`" for k in state.keys)
            layout = f"PARTITIONED BY ({SLICE}) CLUSTERED BY ({keys}) INTO {state.slices} BUCKETS"
        self.spark.sql(f"CREATE TABLE {data} ({ddl}) USING parquet {layout} LOCATION '{state.path}'")
        if state.slices:
            self.spark.sql(f"ALTER TABLE {data} RECOVER PARTITIONS")

    def _location(self, data: str) -> str | None:
        """Where a data table of the catalog lies. One that is not this store's is an error."""
        if not self.spark.catalog.tableExists(data):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {data}").filter("col_name = 'Location'").collect()
        found = rows[0]["data_type"] if rows else ""
        if not _plain(found).startswith(_plain(self.base) + "/"):
            raise ValueError(f"{data} belongs to another store, at {found}")
        return found

    def _point(self, name: str, state: State) -> None:
        data = _data_table(name, state.path)
        columns = [f"`{c}`" for c in self.spark.table(data).columns if c != SLICE]
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(columns)} FROM {data}")

    # ---- writes -------------------------------------------------------------

    def _publish(
        self, name: str, df: DataFrame, op: str, load_ts, keys: Sequence[str],
        unique_keys: bool, by_key: bool = False,
    ) -> int:
        """Write the frame as the whole table, in a new folder; returns its rows.

        ``by_key`` tells that the frame's last shuffle, if any, is by the keys.
        """
        namespace, table = name.split(".")
        self.create_namespace(namespace)
        last = self._current.get(name)
        version = last.version + 1 if last else 1
        keys = tuple(keys)
        slices = self._slices_for(last, keys)
        path = f"{self.base}/{namespace}/{table}/g{version}"
        data = _data_table(name, path)
        self._remove(path)  # of a failed run
        if self._location(data) is not None:
            self.spark.sql(f"DROP TABLE {data}")
        if slices:
            if not by_key:
                df = df.repartition(slices, *keys)
            df = df.withColumn(SLICE, slice_of(df, keys, slices))
        writer = df.write.format("parquet").option("path", path)
        if slices:
            writer = writer.partitionBy(SLICE).bucketBy(slices, *keys)
        with self._set("spark.sql.shuffle.partitions", slices if by_key else None):
            writer.saveAsTable(data)
        return self._logged(name, op, load_ts, State(version, 0, path, keys, slices, unique_keys))

    def _replace_slices(self, name: str, df: DataFrame, load_ts, unique_keys: bool) -> int:
        """Write the frame in place of the table's slices that it has rows of."""
        last = self._current[name]
        data = _data_table(name, last.path)
        rows = df.withColumn(SLICE, slice_of(df, last.keys, last.slices)).select(self.spark.table(data).columns)
        with self._set("spark.sql.sources.partitionOverwriteMode", "dynamic"):
            rows.write.insertInto(data, overwrite=True)
        self.spark.catalog.refreshTable(data)
        return self._logged(
            name, "merge", load_ts, last._replace(version=last.version + 1, unique_keys=unique_keys)
        )

    def _logged(self, name: str, op: str, load_ts, state: State) -> int:
        """Enter a write into the log and show its result under the table's name; returns its rows.

        The rows are counted from the files' footers; no column is read.
        """
        state = state._replace(rows=self.spark.table(_data_table(name, state.path)).count())
        entry = self.spark.range(1).select(
            F.lit(name).alias("table"),
            F.lit(state.version).alias("version"),
            F.lit(op).alias("op"),
            F.lit(state.rows).cast("long").alias("rows"),
            ts_lit(load_ts).alias("load_ts"),
            F.lit(state.path).alias("path"),
            F.array(*[F.lit(k) for k in state.keys]).cast("array<string>").alias("keys"),
            F.lit(state.slices).cast("int").alias("slices"),
            F.lit(state.unique_keys).alias("unique_keys"),
        )
        entry.coalesce(1).write.mode("append").parquet(self._log_path)
        self._current[name] = state
        self._point(name, state)
        self._clean(name)
        log.info("%s %s v%d: %d rows", op, name, state.version, state.rows)
        return state.rows

    def _slices_for(self, last: State | None, keys: tuple[str, ...]) -> int | None:
        if not keys:
            return None
        if self.buckets:
            return self.buckets
        if last and last.slices and last.keys == keys:
            return last.slices
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    @contextmanager
    def _set(self, key: str, value: object) -> Iterator[None]:
        """A setting of the session, for one write; None leaves it alone."""
        before = self.spark.conf.get(key)
        if value is not None:
            self.spark.conf.set(key, str(value))
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def create_if_absent(self, name: str, df: DataFrame, load_ts, keys: str | Sequence[str] = ()) -> bool:
        """An empty table with the frame's schema, unless the table is there."""
        if self.exists(name):
            return False
        self._publish(name, df.limit(0), "create", load_ts, _names(keys), unique_keys=True)
        return True

    def overwrite(
        self, name: str, df: DataFrame, load_ts, keys: str | Sequence[str] = (), by_key: bool = False
    ) -> int:
        return self._publish(name, df, "overwrite", load_ts, _names(keys), unique_keys=False, by_key=by_key)

    def merge(
        self,
        name: str,
        source: DataFrame,
        keys: str | Sequence[str],
        load_ts,
        update_cols: Sequence[str] | None = None,
        source_unique: bool = True,
        drop_null_keys: bool = False,
        by_key: bool = False,
        profile: bool = False,
        written: bool = False,
    ) -> int:
        """Upsert ``source``; the first merge creates the table. Returns its rows.

        ``profile`` counts the source's rows and the nulls of its columns while it is
        written, without another scan; ``profiles`` has them.

        The source is written out once, so that looking for its slices, for null
        keys and for conflicts does not compute it again, and a lost executor
        costs no recomputation of it; ``written`` tells that it is already, as a
        settled frame. ``by_key`` tells that the source's last
        shuffle is by the keys, as after ``latest_rows``; a first load then needs
        no other.
        """
        keys = _names(keys)
        # several rows per key may pile up in one slice, so do not slice them
        place_by = keys if source_unique else []
        if not self.exists(name):
            if drop_null_keys:
                source = source.dropna(subset=keys)
            columns, seen = source.columns, Observation()
            if profile:
                source = source.observe(seen, *_null_counts(columns))
            rows = self._publish(
                name, source, "create", load_ts, place_by, unique_keys=source_unique, by_key=by_key
            )
            if profile:
                self._log_profile(name, columns, seen.get, load_ts)
            return rows
        last = self._current[name]
        unique = source_unique and (last.unique_keys or not last.rows)
        staging = f"{self.base}/_staging/{name}"
        seen = Observation()
        observed = source.observe(seen, *_null_counts(source.columns)) if profile else source
        if written and not profile:
            staged = source
        else:
            observed.write.mode("overwrite").parquet(staging)
            staged = self.spark.read.schema(source.schema).parquet(staging)
        if not source_unique:
            require_no_conflicts(self.read(name), staged, keys)
        null_keys = not staged.filter(any_null(keys)).isEmpty()
        options = {"drop_null_keys": drop_null_keys, "source_has_null_keys": null_keys}
        fits = last.slices and tuple(place_by) == last.keys and self.buckets in (None, last.slices)
        if not fits:
            merged = upsert(self.read(name), staged, keys, update_cols, **options)
            rows = self._publish(name, merged, "merge", load_ts, place_by, unique_keys=unique)
        elif not (touched := self._touched(name, staged)):
            return last.rows
        else:
            rows = self._merge_slices(name, touched, staged, update_cols, load_ts, unique, options)
        if profile:
            self._log_profile(name, source.columns, seen.get, load_ts)
        return rows

    def _merge_slices(
        self, name: str, touched: Sequence[int], staged: DataFrame, update_cols, load_ts, unique: bool, options: dict
    ) -> int:
        last = self._current[name]
        merged = upsert(
            self.slices(name, touched), staged, last.keys, update_cols, hash_source=self._hashed(name, staged), **options
        )
        return self._replace_slices(name, merged, load_ts, unique)

    def _hashed(self, name: str, staged: DataFrame) -> bool:
        """Whether a slice's share of a written source is small enough to be hashed."""
        return planned_bytes(staged) / self._current[name].slices * 3 < HASH_BYTES

    def changes(
        self, name: str, source: DataFrame, columns: Sequence[str], update_cols: Sequence[str] | None = None
    ) -> DataFrame:
        """What a merge of a written source is going to change, as ``changed_rows``; reads the touched slices only."""
        state = self._current[name]
        if not state.keys:
            raise ValueError(f"{name} has no key")
        rows = self.slices(name, self._touched(name, source.dropna(subset=list(state.keys))))
        return changed_rows(rows, source, state.keys, columns, update_cols, self._hashed(name, source))

    def add_sums(self, name: str, delta: DataFrame, by: Sequence[str], load_ts) -> int:
        """Add to a table of sums, which has one row for each ``by``; returns its rows.

        All other columns are sums. ``delta`` has the same columns and is read twice, so it
        should be written out. Only the slices of its keys are written. Groups stay
        when their sums become 0, as a slice without rows would not be replaced.
        """
        state = self._current[name]
        touched = self._touched(name, delta)
        if not touched:
            return state.rows
        old = self.slices(name, touched)
        both = old.unionByName(delta.select(*[F.col(f.name).cast(f.dataType) for f in old.schema.fields]))
        sums = [F.sum(c).alias(c) for c in old.columns if c not in by]
        # a slice is in one task, which writes one file of it
        placed = both.repartition(state.slices, *state.keys)
        return self._replace_slices(
            name, placed.groupBy(*by).agg(*sums).select(old.columns), load_ts, state.unique_keys
        )

    def _touched(self, name: str, rows: DataFrame) -> list[int]:
        """The slices that the keys of these rows lie in; at most as many as there are."""
        state = self._current[name]
        types = self.read(name).schema
        keys = rows.select([F.col(f"`{k}`").cast(types[k].dataType).alias(k) for k in state.keys])
        return sorted(r[0] for r in keys.select(slice_of(keys, state.keys, state.slices)).distinct().collect())

    def slices(self, name: str, numbers: Sequence[int]) -> DataFrame:
        """The table's rows in these slices; no other partition is read."""
        state = self._current[name]
        data = self.spark.table(_data_table(name, state.path))
        if len(numbers) < state.slices:
            data = data.filter(F.col(SLICE).isin(*numbers))
        return data.drop(SLICE)

    def rows_of_keys(self, name: str, keys: DataFrame) -> DataFrame:
        """The table's rows that have one of these keys; only their slices are read, in place.

        ``keys`` has the columns that place the table's rows, without repetition, and is
        read twice. A single null key matches nothing; null parts of several match.
        """
        state = self._current[name]
        if not state.keys:
            raise ValueError(f"{name} has no key")
        keys = keys.select(*state.keys)
        if len(state.keys) == 1:
            keys = keys.dropna()
            return self.slices(name, self._touched(name, keys)).join(keys, list(state.keys), "left_semi")
        rows = self.slices(name, self._touched(name, keys)).alias("t")
        same = [F.col(f"t.{k}").eqNullSafe(F.col(f"k.{k}")) for k in state.keys]
        return rows.join(keys.alias("k"), reduce(and_, same), "left_semi")

    # ---- files --------------------------------------------------------------

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), jpath

    def _remove(self, path: str) -> None:
        if not path.startswith(f"{self.base}/"):
            raise ValueError(f"not below {self.base}: {path}")
        fs, jpath = self._fs(path)
        if fs.exists(jpath):
            fs.delete(jpath, True)

    def _clean(self, name: str) -> None:
        """Delete the folders of the table but for the last ``keep``."""
        namespace, table = name.split(".")
        fs, root = self._fs(f"{self.base}/{namespace}/{table}")
        folders = [f.getPath() for f in fs.listStatus(root) if re.fullmatch(r"g\d+", f.getPath().getName())]
        for path in sorted(folders, key=lambda p: int(p.getName()[1:]))[: -self.keep]:
            data = _data_table(name, path.toString())
            if self._location(data) is not None:
                self.spark.sql(f"DROP TABLE {data}")
            fs.delete(path, True)


def _null_counts(columns: Sequence[str]) -> list[Column]:
    nulls = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"nulls{i}") for i, c in enumerate(columns)]
    return [F.count(F.lit(1)).alias("rows"), *nulls]


def slice_of(df: DataFrame, keys: Sequence[str], slices: int) -> Column:
    """The slice of a row, by the hash of its keys."""
    return F.pmod(F.hash(*[df[f"`{k}`"] for k in keys]), F.lit(slices))


def planned_bytes(df: DataFrame) -> int:
    """Size of a frame as the planner knows it; of files, that of the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def slices_for(frames: Sequence[DataFrame], least: int) -> int:
    """So many slices that each one's share of the largest frame is at most ``SLICE_BYTES``."""
    return max(least, *[ceil(planned_bytes(df) / SLICE_BYTES) for df in frames])


def _data_table(name: str, path: str) -> str:
    return f"{name}__{path.rstrip('/').rsplit('/', 1)[1]}"


def _plain(path: str) -> str:
    """A path without its scheme, as file systems spell one path in several ways."""
    return re.sub(r"^[a-z0-9]+:/+", "/", path.rstrip("/"))


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)
