"""The layer tables: one database per layer, every table fully replaced on each build."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillworks import schemas
from tillworks.sources import seeds
from tillworks.values import LOADED_AT, MARTS_DB, RAW_DB, SOURCE, STAGING_DB, TABS

DECLARED = schemas.STAGING | schemas.MARTS
COLUMN_ORDER = {table: schemas.names(ddl) for table, ddl in DECLARED.items()}
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
KEPT_VERSIONS = 1  # earlier contents of a table that stay readable for queries that began before it was replaced


def declared_schema(layer: str, table: str, stamped: bool = True) -> T.StructType | None:
    """Columns and types that a table is declared with; those of raw tabs are all text, with the load's stamp or without."""
    tab = next((t for t in TABS.values() if t.table == table), None)
    if layer == RAW_DB and tab:
        return T.StructType([T.StructField(c, T.StringType()) for c in (*tab.columns, *((LOADED_AT, SOURCE) if stamped else ()))])
    ddl = DECLARED.get(table) if layer != RAW_DB else seeds.SCHEMAS.get(table)
    return T.StructType.fromDDL(ddl) if ddl else None


_writes = Counter()  # writes under way in each session, which share its settings
_counting = Lock()


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written here go when it is written, not when the driver collects its garbage: a rebuild would
    keep those of all tables. Nothing reads them again, as a written plan is not run twice. A session that sets this itself is
    left as it is."""
    with _counting:
        ours = _writes[id(spark)] > 0 or spark.conf.get(DROP_SHUFFLES) != "true"
        if ours:
            _writes[id(spark)] += 1
            spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _counting:
            if ours:
                _writes[id(spark)] -= 1
                if not _writes[id(spark)]:
                    spark.conf.unset(DROP_SHUFFLES)


class Layers:
    """Names, places and replaces the tables of the three layers.

    ``location`` is a folder all executors share; without it tables go to the warehouse directory. ``prefix`` keeps
    several sets of layers apart in one catalog.

    A table's name is a view of one of its versions, each of which is a table with a folder of its own. Replacing a table
    writes a new version and then points the view there, which is one change in the catalog: readers find the old content or
    the new one, whatever fails in between. The last ``kept_versions`` contents before the current one stay.
    """

    def __init__(
        self, spark: SparkSession, location: str | None = None, prefix: str = "", kept_versions: int = KEPT_VERSIONS
    ) -> None:
        self.spark, self.location, self.prefix, self.kept_versions = spark, location, prefix, kept_versions
        for layer in (RAW_DB, STAGING_DB, MARTS_DB):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`")

    def name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}{layer}`.`{table}`"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def table(self, layer: str, table: str) -> DataFrame:
        """Scan a layer table; columns come in declared order, also where a partition column is stored last."""
        df = self.spark.table(self.name(layer, table))
        return df.select(COLUMN_ORDER.get(table, df.columns))

    def raw(self, table: str) -> DataFrame:
        return self.table(RAW_DB, table)

    def staging(self, table: str) -> DataFrame:
        return self.table(STAGING_DB, table)

    def mart(self, table: str) -> DataFrame:
        return self.table(MARTS_DB, table)

    def _checked(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """The table with its columns as declared, in order; a table without a declaration needs a type for each column."""
        declared = declared_schema(layer, table, LOADED_AT in df.columns)
        if declared is None:
            untyped = [f.name for f in df.schema if f.dataType.typeName() == "void"]
            if untyped:
                raise ValueError(f"{table}: columns {untyped} have no type")
            return df
        if sorted(declared.names) != sorted(df.columns):
            raise ValueError(f"{table}: columns {sorted(set(declared.names) ^ set(df.columns))} are not as declared")
        kinds = {f.name: f.dataType for f in df.schema}
        other = {f.name: kinds[f.name].simpleString() for f in declared if kinds[f.name] != f.dataType}
        if other:
            raise ValueError(f"{table}: columns {other} are not of the declared type")
        return df.select(declared.names)

    def replace(self, df: DataFrame, layer: str, table: str, partition_by: str | None = None) -> None:
        """Write ``df`` as the whole new content of a table. No global sort.

        A partitioned table is rebalanced by its partition column first: AQE gathers a small month into one file and
        splits a large one over several tasks, instead of every task writing a file for every month.
        """
        df = self._checked(df, layer, table)
        if partition_by:
            df = self.spark.sql(f"SELECT /*+ REBALANCE({partition_by}) */ * FROM {{df}}", df=df)
        version = self._write(df, layer, table, partition_by)
        self._point(layer, table, version, df.columns)
        self.drop_versions(layer, table, self.kept_versions)

    def _write(self, df: DataFrame, layer: str, table: str, partition_by: str | None) -> str:
        """A new version of a table, complete, which no name refers to yet."""
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
        version = f"{table}__{stamp}_{uuid.uuid4().hex[:8]}"
        folder = f"{self._folder(layer, table)}/{version}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        with dropping_shuffles(self.spark):
            writer.parquet(folder, compression="zstd")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        parted = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
        self.spark.sql(f"CREATE TABLE {self.name(layer, version)} ({columns}) USING parquet {parted} LOCATION '{folder}'")
        if partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name(layer, version)}")
        return version

    def _point(self, layer: str, table: str, version: str, columns: list[str]) -> None:
        name = self.name(layer, table)
        if self.exists(layer, table) and self.spark.catalog.getTable(name).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {name}")  # not written by this class, e.g. an external tab
        quoted = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {quoted} FROM {self.name(layer, version)}")

    def drop(self, layer: str, table: str) -> None:
        """Remove a table's name; its versions stay until it is replaced again or ``drop_versions`` is called."""
        if self.exists(layer, table):
            kind = "VIEW" if self.spark.catalog.getTable(self.name(layer, table)).tableType == "VIEW" else "TABLE"
            self.spark.sql(f"DROP {kind} {self.name(layer, table)}")

    def _folder(self, layer: str, table: str) -> str:
        base = self.location or self.spark.conf.get("spark.sql.warehouse.dir")
        return f"{base.rstrip('/')}/{self.prefix}{layer}/{table}"

    def _system(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self, layer: str, table: str) -> list[str]:
        """The contents of a table but the current one, the latest first; also those whose write did not come to its end."""
        pattern = re.compile(re.escape(table) + r"__\d{20}_[0-9a-f]{8}")
        tables = self.spark.sql(f"SHOW TABLES IN `{self.prefix}{layer}` LIKE '{table}__*'").collect()
        system, top = self._system(self._folder(layer, table))
        folders = [f.getPath().getName() for f in system.listStatus(top)] if system.exists(top) else []
        found = {n for n in (*(r.tableName for r in tables), *folders) if pattern.fullmatch(n)}
        return sorted(found - {self._current(layer, table)}, reverse=True)

    def _current(self, layer: str, table: str) -> str | None:
        if not self.exists(layer, table):
            return None
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}").where("col_name = 'View Text'").first()
        return described and described.data_type.rsplit("`", 2)[-2]

    def drop_versions(self, layer: str, table: str, keep: int = 0) -> None:
        """Delete earlier contents but for the last ``keep``. Nothing may still be reading them, and nothing else may be
        replacing the table."""
        for version in self.versions(layer, table)[keep:]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, version)}")
            system, folder = self._system(f"{self._folder(layer, table)}/{version}")
            system.delete(folder, True)
