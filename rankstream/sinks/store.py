"""Catalog tables ``layer.name`` on parquet: append, overwrite, upsert.

Rows that replace others are first written to a working copy and then swapped in by one dynamic
partition overwrite, so a failure before the swap leaves the old rows in place and the step can be
run again. Unpartitioned tables are written to a new folder, and the catalog is pointed at it.

Keyed tables without partitions of their own are partitioned by a bucket of their key: an upsert
reads and rewrites the buckets of its rows only. When the buckets hold more than ``bucket_bytes`` on
average their number doubles: each bucket is split by one more bit of the key's hash. Key columns have
Parquet bloom filters, so that an upsert of a few keys opens only the row groups that may hold them.

An upsert with a ``delivery`` keeps the rows it brought and the rows it replaced in the table
``<name>_changes``, from which metric tables are maintained (:mod:`rankstream.operators.deltas`).

A column's type widens when rows of a wider type arrive (:data:`WIDER`); files written before are read
as the wider type.
"""

from __future__ import annotations

import contextlib
import re
import time
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankstream.operators import clustering, deltas
from rankstream.operators.dedupe import first_per_key, match_on, merge_rows
from rankstream.session import shared_folder
from rankstream.sinks import folders

LAYERS = ("bronze", "silver", "gold")

_VERSION = "v"
BUCKET = "key_bucket"
_BUCKETS = "rankstream.buckets"
# Stored bytes of a file of a clustered table: its rows are sorted by one task, unpacked.
_FILE_BYTES = 32 << 20
_BLOOM = "parquet.bloom.filter.enabled#"
DELIVERY = "delivery"
# Up to this many keys an upsert names them in its read of the table, as Spark pushes them down.
_FEW_KEYS = "spark.sql.parquet.pushdown.inFilterThreshold"

# What each type can widen to without changing a value, nearest first. Parquet files of the
# narrower type can be read as the wider one.
WIDER: dict[str, tuple[str, ...]] = {
    "tinyint": ("smallint", "int", "bigint", "decimal(20,0)", "double"),
    "smallint": ("int", "bigint", "decimal(20,0)", "double"),
    "int": ("bigint", "decimal(20,0)", "double"),
    "bigint": ("decimal(20,0)",),
    "float": ("double",),
}


def wider_type(known: str, other: str) -> str | None:
    """The nearest type that holds all values of both; None if there is none in :data:`WIDER`."""
    ups = [known, *WIDER.get(known, ())], [other, *WIDER.get(other, ())]
    return next((t for t in ups[0] if t in ups[1]), None)


def _nullable(fields: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def _sql_literal(value: object) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


class TableStore:
    """Reads and writes the layered tables of one warehouse root."""

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        buckets: int = 16,
        bucket_bytes: int = 512 << 20,
    ):
        self.spark, self.buckets, self.bucket_bytes = spark, buckets, bucket_bytes
        self.root = (root or f"{shared_folder(spark)}/rankstream/warehouse").rstrip("/")

    # -- catalog ---------------------------------------------------------------------------

    def initialize(self, layers: Sequence[str] = LAYERS) -> None:
        """Makes the layer databases that are missing."""
        for layer in layers:
            location = _sql_literal(f"{self.root}/{layer}")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION {location}")

    def exists(self, name: str) -> bool:
        """Whether exactly this table exists."""
        return self.spark.catalog.tableExists(name)

    def read(self, name: str) -> DataFrame:
        return self._rows(name).drop(BUCKET)

    def _rows(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def partition_columns(self, name: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]

    # -- writes ----------------------------------------------------------------------------

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Adds rows; columns new to the table are added to it, missing ones are null."""
        if not self.exists(name):
            self._create(name, df, partition_by)
            return
        self._fit_schema(name, df)
        self._insert(name, df)

    def replace_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        """Replaces the partitions that ``df`` has rows of, at once; creates the table on first use."""
        if not self.exists(name):
            self._create(name, df, partition_by)
            return
        self._fit_schema(name, df)
        with self.staging() as stage:
            self._overwrite_partitions(name, stage(df), partition_by, [])

    def overwrite(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Replaces the table by ``df``, which may read the table itself."""
        same_layout = (
            self.exists(name)
            and list(partition_by) == self.partition_columns(name)
            and _columns(self._rows(name)) == _columns(df)
        )
        if same_layout and partition_by:
            with self.staging() as stage:
                rows = stage(df)
                kept = self._partitions(rows, partition_by)
                gone = [r for r in self._partitions(self._rows(name), partition_by) if r not in kept]
                self._overwrite_partitions(name, rows, partition_by, gone)
            return
        if same_layout:
            version = self._write_version(name, df, partition_by)
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION {_sql_literal(version)}")
            self.spark.catalog.refreshTable(name)
            return
        self.rewrite(name, df, partition_by)

    def rewrite(
        self, name: str, df: DataFrame, partition_by: Sequence[str] = (),
        buckets: int = 0, keys: Sequence[str] = (),
    ) -> None:
        """Writes ``df``, which may read the table, beside it; the copy then takes its place."""
        version = self._write_version(name, df, partition_by, keys)
        self._take_place(name, df, version, partition_by, buckets, keys)

    def upsert(
        self,
        name: str,
        source: DataFrame,
        keys: Sequence[str],
        order: Sequence[Column | str] = (),
        partition_by: Sequence[str] = (),
        prepared: bool = False,
        delivery: str | None = None,
    ) -> None:
        """Updates rows that match on ``keys`` (null-safe) and inserts the others.

        Several source rows with one key are cut to the first by ``order``. Rows that the table
        already holds unchanged are skipped. Partitions without a row to update are only appended
        to; those with one are rewritten, and so a row whose partition value changes leaves its
        old partition. A failure raises; running the same upsert again completes it.

        ``prepared`` says that ``source`` has one row per key and is cheap to read again, such as
        a projection of stored rows; the cut and the working copy are then left out.

        ``delivery`` names the rows' delivery and asks for its change feed (:meth:`changes`). The
        feed is stored before the table changes, and an upsert repeated under the same name after
        a failure keeps it, since the table may have been changed in part.
        """
        if not prepared:
            source = first_per_key(source, keys, order)
        with self.staging() as stage:
            if self.exists(name):
                self._merge(name, source, keys, stage, delivery)
                self._grow(name, keys)
                return
            if delivery is not None:
                source = stage(source)
                self._feed(name, delivery, deltas.signed(source))
            if partition_by:
                self._create(name, source, partition_by, keys=keys)
            else:
                bucketed = _bucketed(source, keys, self.buckets)
                self._create(name, bucketed, [BUCKET], self.buckets, keys)
                self._grow(name, keys)

    def changes(self, name: str, delivery: str | None = None) -> DataFrame:
        """The change feed: rows with :data:`~rankstream.operators.deltas.SIGN`, of one delivery or all."""
        feed = self._rows(f"{name}_changes")
        return feed if delivery is None else feed.filter(F.col(DELIVERY) == delivery)

    def _feed(self, name: str, delivery: str, rows: DataFrame) -> None:
        feed = f"{name}_changes"
        if self.exists(feed) and not self.changes(name, delivery).isEmpty():
            return  # of the run before, which saw the table as it was
        named = rows.drop(BUCKET).withColumn(DELIVERY, F.lit(delivery))
        self.replace_partitions(feed, named, [DELIVERY])

    def _merge(
        self, name: str, source: DataFrame, keys: Sequence[str], stage, delivery: str | None = None
    ) -> None:
        parts = self.partition_columns(name)
        if parts == [BUCKET]:
            source = _bucketed(source, keys, self._bucket_count(name))
        self._fit_schema(name, source)
        source = stage(self._align(name, source))
        target = self._rows(name)
        if parts == [BUCKET]:
            target = target.filter(_in_partitions(parts, self._partitions(source, parts)))
        target_of_keys = target.filter(self._few_keys(source, keys))
        # The stored rows are first cut to the incoming keys, so that a small source is broadcast
        # and the table is scanned without a shuffle; rows delivered again unchanged are skipped.
        incoming = source.select(*keys)
        stored = stage(
            target_of_keys.join(incoming, match_on(target_of_keys, incoming, keys), "left_semi")
        )
        same = match_on(source, stored, target.columns)
        changed = stage(source.join(stored, same, "left_anti"))
        renewed, known = changed.select(*keys), stored.select(*keys)
        replaced = stored.join(renewed, match_on(stored, renewed, keys), "left_semi")
        if delivery is not None and not changed.isEmpty():
            self._feed(name, delivery, deltas.signed(changed, replaced))
        if replaced.isEmpty():
            self._insert(name, changed)
            return
        if not parts:
            version = self._write_version(name, merge_rows(target, changed, keys), ())
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION {_sql_literal(version)}")
            self.spark.catalog.refreshTable(name)
            return
        # Partitions that lose a row and partitions that get it in its place change together.
        moved = changed.join(known, match_on(changed, known, keys), "left_semi")
        touched = self._partitions(replaced.unionByName(moved), parts)
        inside = _in_partitions(parts, touched)
        old = target.filter(inside)
        kept = old.join(renewed, match_on(old, renewed, keys), "left_anti")
        rewritten = stage(kept.unionByName(changed.filter(inside)))
        filled = self._partitions(rewritten, parts)
        emptied = [row for row in touched if row not in filled]
        self._overwrite_partitions(name, rewritten, parts, emptied)
        self._insert(name, changed.filter(~inside))

    def write_or_upsert(
        self,
        name: str,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[Column | str] = (),
        partition_by: Sequence[str] = (),
        prepared: bool = False,
        delivery: str | None = None,
    ) -> None:
        """Creates the table on first use, else upserts; never falls back to a blind append."""
        self.upsert(name, df, keys, order, partition_by, prepared, delivery)

    def split_buckets(self, name: str, keys: Sequence[str], buckets: int) -> None:
        """Gives a keyed table a multiple of its buckets: each is split by more of the key's hash."""
        self.rewrite(name, _bucketed(self.read(name), keys, buckets), [BUCKET], buckets, keys)

    def _grow(self, name: str, keys: Sequence[str]) -> None:
        """Doubles the buckets until they would hold ``bucket_bytes`` at most, on average."""
        if self.partition_columns(name) != [BUCKET]:
            return
        held = folders.size(self.spark, self._location(name))
        known = buckets = self._bucket_count(name)
        while held > self.bucket_bytes * buckets:
            buckets *= 2
        if buckets > known:
            self.split_buckets(name, keys, buckets)

    def cluster(self, name: str, columns: Sequence[str], bits: int = 6) -> None:
        """Rewrites the table along a Z-order curve of ``columns``, within its partitions.

        Rows near in all of the columns come to lie in the same row groups, so that a predicate on
        any of them skips most. The number of tasks grows with the table, so that what one sorts does
        not. See :func:`rankstream.operators.clustering.z_value`.
        """
        rows, parts = self._rows(name), self.partition_columns(name)
        placed = clustering.with_z_value(rows, columns, bits)
        files = max(1, -(-folders.size(self.spark, self._location(name)) // _FILE_BYTES))
        dealt = placed.repartitionByRange(files, *parts, clustering.Z_VALUE)
        ordered = dealt.sortWithinPartitions(*parts, clustering.Z_VALUE).drop(clustering.Z_VALUE)
        keys = self._bloomed(name)
        version = self._new_folder(name)
        writer = ordered.write.options(**_blooms(keys))
        (writer.partitionBy(*parts) if parts else writer).parquet(version)
        buckets = self._bucket_count(name) if parts == [BUCKET] else 0
        self._take_place(name, rows, version, parts, buckets, keys)

    # -- upkeep ----------------------------------------------------------------------------

    @contextlib.contextmanager
    def staging(self) -> Iterator:
        """Gives a function that writes a frame and returns the written copy, for a frame that is
        read several times. The copies are dropped at the end."""
        made: list[str] = []

        def stage(df: DataFrame) -> DataFrame:
            made.append(f"{self.root}/_staging/{uuid.uuid4().hex}")
            df.write.parquet(made[-1])
            return self.spark.read.schema(df.schema).parquet(made[-1])

        try:
            yield stage
        finally:
            for folder in made:
                folders.drop(self.spark, folder)

    def vacuum(self, name: str, keep_hours: float = 168) -> list[str]:
        """Drops folders that the table no longer uses and that are older than ``keep_hours``.

        The age keeps readers that started before the last rewrite safe. Returns what was dropped.
        """
        base = f"{self.root}/{name.replace('.', '/')}"
        used = self._location(name).rpartition("/")[2]
        limit = time.time() - keep_hours * 3600
        unused = [
            child
            for child in folders.children(self.spark, base)
            if child.startswith(_VERSION)
            and child != used
            and int(child.removeprefix(_VERSION).split("-")[0]) / 1000 < limit
        ]
        for child in unused:
            folders.drop(self.spark, f"{base}/{child}")
        return unused

    # -- helpers ---------------------------------------------------------------------------

    def _new_folder(self, name: str) -> str:
        stamp = f"{_VERSION}{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:12]}"
        return f"{self.root}/{name.replace('.', '/')}/{stamp}"

    def _location(self, name: str) -> str:
        described = self.spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'")
        return described.first()["data_type"].rstrip("/")

    def _write_version(
        self, name: str, df: DataFrame, partition_by: Sequence[str], keys: Sequence[str] = ()
    ) -> str:
        version = self._new_folder(name)
        writer = df.hint("rebalance", *partition_by).write.options(**_blooms(keys))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(version)
        return version

    def _register(
        self, name: str, df: DataFrame, version: str, partition_by: Sequence[str],
        buckets: int = 0, keys: Sequence[str] = (),
    ) -> None:
        columns = _nullable(df.schema.fields).toDDL()
        clause = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        properties = f"TBLPROPERTIES ('{_BUCKETS}'='{buckets}')" if buckets else ""
        blooms = ", ".join(f"{_sql_literal(k)} {_sql_literal(v)}" for k, v in _blooms(keys).items())
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"{f'OPTIONS ({blooms})' if blooms else ''} {clause} "
            f"LOCATION {_sql_literal(version)} {properties}"
        )
        if partition_by and folders.exists(self.spark, version):
            self.spark.catalog.recoverPartitions(name)

    def _take_place(
        self, name: str, df: DataFrame, version: str, partition_by: Sequence[str],
        buckets: int = 0, keys: Sequence[str] = (),
    ) -> None:
        """Makes the catalog's ``name`` a table over ``version`` with the columns of ``df``."""
        # a run lost between the last two steps leaves the rows under the new name
        made = f"{name}__new"
        self.spark.sql(f"DROP TABLE IF EXISTS {made}")
        self._register(made, df, version, partition_by, buckets, keys)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"ALTER TABLE {made} RENAME TO {name}")

    def _create(
        self, name: str, df: DataFrame, partition_by: Sequence[str], buckets: int = 0,
        keys: Sequence[str] = (),
    ) -> None:
        base = f"{self.root}/{name.replace('.', '/')}"
        if folders.children(self.spark, base):
            raise RuntimeError(
                f"{base} holds data but the catalog has no {name}: use the catalog that made it"
            )
        # Named first, filled second: a run lost in between leaves an empty table to go on with.
        self._register(name, df, self._new_folder(name), partition_by, buckets, keys)
        self._insert(name, df)

    def _insert(self, name: str, df: DataFrame) -> None:
        parts = self.partition_columns(name)
        self._align(name, df).hint("rebalance", *parts).write.insertInto(name)
        # a micro-batch writes through a session of its own; this one must list the files anew
        self.spark.catalog.refreshTable(name)

    def _fit_schema(self, name: str, df: DataFrame) -> None:
        """Adds the columns that are new, and widens those that get values of a wider type."""
        stored = self._rows(name)
        known = _columns(stored)
        new = [f for f in df.schema.fields if f.name not in known]
        if new:
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_nullable(new).toDDL()})")
        parts = self.partition_columns(name)
        wider = {}
        for field in df.schema.fields:
            if field.name in known and field.name not in parts:
                before = known[field.name].simpleString()
                after = wider_type(before, field.dataType.simpleString())
                if after and after != before:
                    wider[field.name] = after
        if wider:
            rows = self._rows(name)
            widened = rows.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in wider.items()})
            # the catalog entry alone changes: the files stay and are read as the wider type
            buckets = self._bucket_count(name) if parts == [BUCKET] else 0
            keys = self._bloomed(name)
            self._take_place(name, widened, self._location(name), parts, buckets, keys)

    def _bloomed(self, name: str) -> list[str]:
        """The columns whose files have bloom filters."""
        found = self.spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Storage Properties'")
        row = found.first()
        text = row["data_type"] if row else ""
        return re.findall(rf"{re.escape(_BLOOM)}([^=,\]]+)=true", text)

    def _few_keys(self, source: DataFrame, keys: Sequence[str]) -> Column:
        """A predicate that names the keys if they are few; Parquet filters are then asked for them."""
        most = int(self.spark.conf.get(_FEW_KEYS, "10"))
        found = source.select(*keys).distinct().limit(most + 1).collect()
        if len(found) > most:
            return F.lit(True)
        return reduce(lambda a, b: a & b, [_one_of(k, [r[k] for r in found]) for k in keys])

    def _align(self, name: str, df: DataFrame) -> DataFrame:
        fields = self._rows(name).schema.fields
        return df.select(
            *[
                (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in fields
            ]
        )

    def _bucket_count(self, name: str) -> int:
        found = self.spark.sql(f"SHOW TBLPROPERTIES {name} ('{_BUCKETS}')").first()
        return int(found["value"])

    def _partitions(self, df: DataFrame, parts: Sequence[str]) -> list[Row]:
        """Partition values of the rows: at most as many as the catalog lists."""
        return df.select(*parts).distinct().collect()

    def _overwrite_partitions(
        self, name: str, rows: DataFrame, parts: Sequence[str], emptied: Sequence[Row]
    ) -> None:
        """Swaps in the partitions of ``rows``, a stored copy, and drops those left without rows."""
        aligned = self._align(name, rows).hint("rebalance", *parts)
        with _dynamic_overwrite(aligned.sparkSession):
            aligned.write.mode("overwrite").insertInto(name)
        if emptied:
            specs = [
                "PARTITION (" + ", ".join(f"`{p}`={_sql_literal(r[p])}" for p in parts) + ")"
                for r in emptied
            ]
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(specs)}")
        self.spark.catalog.refreshTable(name)


@contextlib.contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts that overwrite replace the partitions of their rows and no others."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _blooms(keys: Sequence[str]) -> dict[str, str]:
    """Writer options for bloom filters on the keys, as large as their row groups need."""
    if not keys:
        return {}
    return {"parquet.bloom.filter.adaptive.enabled": "true"} | {f"{_BLOOM}{k}": "true" for k in keys}


def _columns(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with the bucket of its key, from the key's text so that types need not agree."""
    texts = [F.col(f"`{k}`").cast("string") for k in keys]
    bucket = F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int")
    return df.withColumn(BUCKET, bucket)


def _one_of(name: str, values: Sequence[object]) -> Column:
    """A predicate that Parquet readers can be given; null is a value."""
    known = [v for v in values if v is not None]
    hit = F.col(f"`{name}`").isin(known) if known else F.lit(False)
    return hit | F.col(f"`{name}`").isNull() if len(known) < len(values) else hit


def _in_partitions(parts: Sequence[str], values: Sequence[Row]) -> Column:
    """Predicate for the given partitions; on partition columns only, so it prunes."""
    if not parts:
        return F.lit(True)
    if len(parts) == 1:
        name = parts[0]
        known = [v[name] for v in values if v[name] is not None]
        hit = F.col(name).isin(known) if known else F.lit(False)
        if len(known) < len(values):
            hit = hit | F.col(name).isNull()
        return F.coalesce(hit, F.lit(False))
    each = [reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(v[p])) for p in parts]) for v in values]
    return reduce(lambda a, b: a | b, each)
