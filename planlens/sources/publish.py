"""Catalog tables by layer: replaced as a whole, together or by partition, read whole, by
column or in order."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The catalog schemas.
LAYERS = ("raw", "staging", "analytics")

# Tables written at a time. Each write is its own Spark job; small tables leave
# most of the cluster idle when written one by one.
WRITERS = 4


def concurrently(*writes: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run independent writes side by side; results in the order given."""
    with ThreadPoolExecutor(WRITERS) as pool:
        return [done.result() for done in [pool.submit(write) for write in writes]]


class Warehouse:
    """Layers are catalog schemas, used by their plain names."""

    def __init__(self, spark: SparkSession, layers: dict[str, str | None] | None = None) -> None:
        """``layers``: the schemas to create, each with its folder or None; ``LAYERS`` in the
        catalog's own folder by default."""
        self.spark = spark
        for layer, folder in (layers or dict.fromkeys(LAYERS)).items():
            place = f" LOCATION '{folder}'" if folder else ""
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}{place}")

    def write(
        self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Replace ``layer.table`` and return it as stored.

        A partitioned table is rebalanced by its partition columns first, or
        every task would leave a small file in every partition. AQE splits the
        partitions that come out large, so a hot month is written by many tasks.
        """
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("overwrite").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(f"{layer}.{table}")
        return self.read(layer, table)

    # -- several tables at once ------------------------------------------------

    def replace_all(
        self,
        layer: str,
        tables: dict[str, DataFrame],
        *,
        batch_id: str | None = None,
        loaded_at: datetime | None = None,
    ) -> list[DataFrame]:
        """Replace several tables together, or none, for every reader at the same moment.

        A load is a *batch*: a partition of each table's ``__batches`` table, which no reader
        sees until the batch is committed. The commit is one file that takes its place in the
        folder of ``load_commits`` by a rename that fails if the place is taken. The tables
        are views of the batch that the last commit names, so they switch together, in plain
        SQL too, and a load that dies before, between or after its steps leaves one whole
        batch: the last or the new one. Before the first commit the tables are empty.

        The batch before the new one is kept for the queries that still read it; older ones, and
        those of loads that died, are dropped. Raises ``RuntimeError`` if another load
        committed meanwhile.

        ``batch_id`` and ``loaded_at`` are noted in the commit with each table's rows, for
        ``load_log``.
        """
        number = self._last_commit(layer) + 1
        batch = f"{number:08d}-{uuid.uuid4().hex}"
        for table, df in tables.items():
            self._prepare(layer, table, df)
        concurrently(*[
            partial(self._append_batch, layer, table, df, batch) for table, df in tables.items()
        ])
        self._commit(layer, number, batch, {
            "batch_id": batch_id or batch,
            "loaded_at": (loaded_at or datetime.now(timezone.utc)).isoformat(),
            "rows": self._rows(layer, tables, batch),
        })
        self._refresh(layer, tables)
        self._forget_before(layer, tables, number - 1, batch)
        return [self.read(layer, table) for table in tables]

    def _commits(self, layer: str) -> str:
        """The folder of the layer's commits, a table of its own."""
        place = self.spark.sql(f"DESCRIBE SCHEMA {layer}").where("info_name = 'Location'").first()
        folder = f"{place.info_value}/load_commits"
        files = self._path(folder).getFileSystem(self._conf)
        files.mkdirs(self._path(folder))
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {layer}.load_commits (number BIGINT, batch STRING, "
            f"batch_id STRING, loaded_at STRING, rows MAP<STRING, BIGINT>) USING json LOCATION '{folder}'"
        )
        return folder

    @property
    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _last_commit(self, layer: str) -> int:
        """The number of the last commit, 0 before the first."""
        folder = self._path(self._commits(layer))
        names = [s.getPath().getName() for s in folder.getFileSystem(self._conf).listStatus(folder)]
        return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != "_"], default=0)

    def _prepare(self, layer: str, table: str, df: DataFrame) -> None:
        """The table of batches, and the view of the committed one."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        names = ", ".join(f"`{c}`" for c in df.columns)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {layer}.{table}__batches ({columns}, _batch STRING) "
            "USING parquet PARTITIONED BY (_batch)"
        )
        plain = [t.name for t in self.spark.catalog.listTables(layer) if t.tableType != "VIEW"]
        if table in plain:  # as stored before there were batches
            self.spark.sql(f"DROP TABLE {layer}.{table}")
        # The batch is a scalar of the commits, so only its partition is read.
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {layer}.{table} AS SELECT {names} FROM {layer}.{table}__batches "
            f"WHERE _batch = (SELECT max_by(batch, number) FROM {layer}.load_commits)"
        )

    def _append_batch(self, layer: str, table: str, df: DataFrame, batch: str) -> DataFrame:
        stamped = df.withColumn("_batch", F.lit(batch))
        stamped.write.mode("append").insertInto(f"{layer}.{table}__batches")
        return stamped

    def _rows(self, layer: str, tables: Iterable[str], batch: str) -> dict[str, int]:
        """Rows per table of a batch, from the footers of its files."""
        each = [
            self.spark.table(f"{layer}.{table}__batches").where(F.col("_batch") == batch)
            .agg(F.count("*").alias("n")).select(F.lit(table).alias("table_name"), "n")
            for table in tables
        ]
        return {r.table_name: r.n for r in reduce(DataFrame.unionByName, each).collect()}

    def load_log(self, layer: str) -> DataFrame:
        """(table_name, _loaded_at, _batch_id, row_count) of every load and table, from the
        commits: no landed row is read, however many there are."""
        self._commits(layer)
        return self.spark.table(f"{layer}.load_commits").select(
            F.explode("rows").alias("table_name", "row_count"),
            F.col("loaded_at").cast("timestamp").alias("_loaded_at"),
            F.col("batch_id").alias("_batch_id"),
        ).select("table_name", "_loaded_at", "_batch_id", "row_count")

    def _commit(self, layer: str, number: int, batch: str, note: dict) -> None:
        folder = self._commits(layer)
        draft = self._path(f"{folder}/_{batch}")
        out = draft.getFileSystem(self._conf).create(draft, False)
        out.write(json.dumps({"number": number, "batch": batch, **note}).encode())
        out.close()
        jvm = self.spark._jvm.org.apache.hadoop.fs
        none = self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
        files = jvm.FileContext.getFileContext(draft.toUri(), self._conf)
        try:
            files.rename(draft, self._path(f"{folder}/{number:08d}.json"), none)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                raise RuntimeError(f"another load of {layer} committed meanwhile") from error
            raise

    def _refresh(self, layer: str, tables: Iterable[str]) -> None:
        """Let this session list the files anew."""
        for name in ("load_commits", *[f"{t}__batches" for t in tables], *tables):
            self.spark.catalog.refreshTable(f"{layer}.{name}")

    def _forget_before(self, layer: str, tables: Iterable[str], least: int, batch: str) -> None:
        """Drop the batches numbered below ``least``, and uncommitted ones up to ``batch``."""
        committed = {
            r.batch for r in self.spark.table(f"{layer}.load_commits").where(F.col("number") >= least).collect()
        }
        for table in tables:
            name = f"{layer}.{table}__batches"
            for row in self.spark.table(name).select("_batch").distinct().collect():
                if row._batch not in committed and row._batch.split("-")[0] <= batch.split("-")[0]:
                    folder = self._path(f"{self._location(name)}/_batch={row._batch}")
                    folder.getFileSystem(self._conf).delete(folder, True)
                    self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (_batch = '{row._batch}')")
            self.spark.catalog.refreshTable(name)

    def _location(self, name: str) -> str:
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
        return told.where("col_name = 'Location'").first().data_type

    # -- a table that is checked before it is replaced --------------------------

    def draft(
        self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Store ``df`` as what ``layer.table`` may become; readers of that see nothing of it."""
        self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}__draft")
        return self.write(layer, f"{table}__draft", df, partition_by)

    def promote(self, layer: str, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace ``layer.table`` by its draft.

        Of a partitioned table only the partitions whose rows differ are written, and those
        that the draft lacks are dropped; the files of the others stay. Partitions are
        compared by the count and an order-free hash of their rows, in one pass over each
        side. A table that is new, or whose columns or most of whose partitions change, is
        replaced as a whole.
        """
        name, draft = f"{layer}.{table}", f"{layer}.{table}__draft"
        changed = self._changed_partitions(name, draft, partition_by)
        if changed is None and partition_by:
            # Not renamed: a catalog may keep the partitions' old places.
            self.write(layer, table, self.spark.table(draft), partition_by)
            self.spark.sql(f"DROP TABLE {draft}")
            return self.read(layer, table)
        if changed is None:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.sql(f"ALTER TABLE {draft} RENAME TO {name}")
            return self.read(layer, table)
        replaced, gone = changed
        if replaced:
            # A session of its own, whose overwrite replaces the partitions that it writes.
            other = self.spark.newSession()
            other.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
            rows = other.table(draft).where(F.col(partition_by[0]).isin(replaced))
            rows.hint("rebalance", *partition_by).write.mode("overwrite").insertInto(name)
        for value in gone:
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition_by[0]} = '{value}')")
            folder = self._path(f"{self._location(name)}/{partition_by[0]}={value}")
            folder.getFileSystem(self._conf).delete(folder, True)
        self.spark.sql(f"DROP TABLE {draft}")
        self.spark.catalog.refreshTable(name)
        return self.read(layer, table)

    def _changed_partitions(
        self, name: str, draft: str, partition_by: Sequence[str]
    ) -> tuple[list, list] | None:
        """(values to write, values to drop) of the partition column; None if the table should
        be replaced as a whole."""
        if len(partition_by) != 1 or not self.spark.catalog.tableExists(name):
            return None
        old, new = self.spark.table(name), self.spark.table(draft)
        if old.schema != new.schema:
            return None
        column = partition_by[0]

        def printed(df: DataFrame, side: str) -> DataFrame:
            row = F.xxhash64(*df.columns)
            return df.groupBy(column).agg(F.struct(
                F.count("*"), F.sum(row.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(row))
            ).alias(side))

        # One row per partition.
        both = printed(old, "old").join(printed(new, "new"), column, "full").collect()
        replaced = [r[column] for r in both if r.new is not None and r.new != r.old]
        gone = [r[column] for r in both if r.new is None]
        if None in replaced or None in gone or 2 * len(replaced) > len(both):
            return None
        return replaced, gone

    def view(self, layer: str, name: str, select: str) -> DataFrame:
        """A stored view over stored tables."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS {select}")
        return self.read(layer, name)

    def read(
        self,
        layer: str,
        table: str,
        columns: Sequence[str] = (),
        order_by: Sequence[str | Column] = (),
    ) -> DataFrame:
        df = self.spark.table(f"{layer}.{table}")
        if columns:
            df = df.select(*columns)
        return df.orderBy(*order_by) if order_by else df
