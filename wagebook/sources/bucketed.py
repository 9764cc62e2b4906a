"""Growing tables on shared storage that joins do not move."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Bucketed:
    """A growing table bucketed and sorted by one column, so that joins on it do not move it.

    path: a shared folder. Data lie in its folder `buckets-<n>`, so whoever opens the path later, in another session or under
    another name, finds them and their number of buckets; asking for another number is an error. Without a path the table is
    the catalog's own and goes with its name.
    """

    def __init__(self, spark: SparkSession, name: str, key: str, path: str | None = None, buckets: int | None = None):
        self.spark, self.name, self.key, self.path, self._asked = spark, name, key, path, buckets
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _found(self) -> int | None:
        """The number of buckets of the data that the path holds."""
        if self.path is None:
            return None
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        found = sorted({int(n.removeprefix("buckets-")) for n in names if n.startswith("buckets-")})
        if len(found) > 1:
            raise ValueError(f"{self.path} holds tables of {found} buckets")
        return found[0] if found else None

    def _open(self, schema: StructType | None = None) -> bool:
        """Makes the catalog know the table; False if there is none yet and no schema to make one by."""
        found = self._found()
        if found is not None:
            if self._asked not in (None, found):
                raise ValueError(f"{self.path} has {found} buckets, not {self._asked}")
            self.buckets = found
        at = f"{self.path}/buckets-{self.buckets}" if self.path else None
        if self.spark.catalog.tableExists(self.name):
            told = {r[0]: r[1] for r in self.spark.sql(f"DESCRIBE FORMATTED {self.name}").collect()}
            if at and self.spark._jvm.org.apache.hadoop.fs.Path(at).toUri().getPath() != self.spark._jvm.org.apache.hadoop.fs.Path(told["Location"]).toUri().getPath():
                raise ValueError(f"{self.name} is a table at {told['Location']}, not at {at}")
            self.buckets = int(told["Num Buckets"])
            self.spark.catalog.refreshTable(self.name)
            return True
        if found is not None:
            schema = self.spark.read.parquet(at).schema if self._has_files(at) else schema
        if schema is None:
            return False
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        place = f" LOCATION '{at}'" if at else ""
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS{place}")
        return True

    def _has_files(self, at: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return any(f.getPath().getName().startswith("part-") for f in fs.listStatus(folder))

    def exists(self) -> bool:
        return self._open()

    def append(self, rows: DataFrame) -> None:
        self._open(rows.schema)
        rows = rows.repartition(self.buckets, self.key)
        rows.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key).mode("append").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def rows(self) -> DataFrame:
        self._open()
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Takes the name out of the catalog. Files of a table with a path stay and are found again by the path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
