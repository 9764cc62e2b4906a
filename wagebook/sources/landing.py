"""Documents landed by year and month, and error records as files: what reports of a year read and nothing else."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wagebook.operators.reports import messages
from wagebook.operators.store import destination_path

DOCUMENTS = "id string, sha256 string, filename string, status string, template_name string, destination string, anomalie array<string>, anno int, mese int"
ERRORS = "run_id string, filename string, error_type string, message string, batch string"


class Landing:
    """A folder with documents, Parquet partitioned by anno and mese (null: no period), and errors, JSON lines by batch.

    A document has its destination and the messages of its anomalies with it, so reports of a year read that year's partitions
    and join nothing. Landing a year again replaces its months and removes those that no document is in any longer; other
    years stay as they are. A month with very many documents has several files.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, name: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)

    def _remove(self, name: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)

    def _read(self, name: str, ddl: str, kind: str) -> DataFrame:
        if not self._exists(name):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).format(kind).load(f"{self.path}/{name}")

    def documents(self, year: int | None = None) -> DataFrame:
        """All documents, or those of a year, of which only its partitions are read."""
        rows = self._read("documents", DOCUMENTS, "parquet")
        return rows if year is None else rows.where(F.col("anno") == year)

    def errors(self, batch: str | None = None) -> DataFrame:
        rows = self._read("errors", ERRORS, "json")
        return rows if batch is None else rows.where(F.col("batch") == batch)

    def land(self, docs: DataFrame, periods: DataFrame, anomalies: DataFrame, years: list[int] | None = None) -> None:
        """Puts the documents (payroll_document) there, or those of years alone; None among years: documents without a period.

        Where all are landed, what was there before goes. The driver holds the list of months.
        """
        p = periods.select(F.col("id").alias("period_id"), F.col("anno").cast("int").alias("anno"), F.col("mese").cast("int").alias("mese"))
        rows = docs.drop("anno", "mese").join(p, "period_id", "left")
        year = F.col("anno")
        wanted = None if years is None else F.when(year.isNull(), F.lit(None in years)).otherwise(year.isin([y for y in years if y is not None]))
        rows = rows if years is None else rows.where(wanted)
        anomalies = anomalies if "rule_no" in anomalies.columns else anomalies.withColumn("rule_no", F.lit(0))
        notes = anomalies.groupBy("document_id").agg(messages().alias("anomalie"))
        rows = rows.join(notes, rows["id"] == notes["document_id"], "left").withColumn("filename", F.col("original_filename"))
        rows = destination_path(rows).withColumn("anomalie", F.coalesce("anomalie", F.array().cast("array<string>")))
        rows = rows.select("id", "sha256", "filename", "status", "template_name", "destination", "anomalie", "anno", "mese")
        before = set() if years is None else {tuple(r) for r in self.documents().where(wanted).select("anno", "mese").distinct().collect()}
        mode, seen = "static" if years is None else "dynamic", Observation(f"landed_{uuid.uuid4().hex}")
        rows = rows.hint("rebalance", F.col("anno"), F.col("mese")).observe(seen, F.collect_set(F.struct("anno", "mese")).alias("months"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("anno", "mese").parquet(f"{self.path}/documents")
        told = lambda x: "__HIVE_DEFAULT_PARTITION__" if x is None else str(x)
        for anno, mese in sorted(before - {tuple(r) for r in seen.get["months"]}, key=str):
            self._remove(f"documents/anno={told(anno)}/mese={told(mese)}")

    def land_errors(self, errors: DataFrame) -> None:
        """Error records (run_id, filename, error_type, message, batch); a batch that comes again replaces its own."""
        errors.select("run_id", "filename", "error_type", "message", "batch").hint("rebalance", F.col("batch")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy("batch").json(f"{self.path}/errors")

    def coverage(self) -> DataFrame:
        """anno, totale, caricati as reports.year_coverage has them."""
        d = self.documents().where("anno is not null")
        return d.groupBy("anno").agg(F.count(F.lit(1)).alias("totale"), F.count_if(F.col("status") == "PROCESSED").alias("caricati")).orderBy("anno")

    def problems(self, year: int | None = None) -> DataFrame:
        """anno, filename, status, anomalie of documents that are not in order: of a year, or of all."""
        bad = self.documents(year).where("anno is not null and status <> 'PROCESSED'")
        return bad.select("anno", "filename", "status", "anomalie").orderBy("anno", "filename")

    def without_year(self) -> DataFrame:
        bad = self.documents().where("anno is null and status <> 'PROCESSED'")
        return bad.select("filename", "status", "anomalie").orderBy("filename")
