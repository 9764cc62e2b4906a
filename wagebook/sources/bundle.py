"""Sources and versioned bundles: files by hash, raw extractions, export, re-import, upgrade, reconciliation."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wagebook import schemas
from wagebook.sources import migrations as M


def ingest_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """filename, sha256 of the files right in folder that fit pattern; contents are dropped as soon as they are hashed."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), F.sha2("content", 256).alias("sha256"))


def raw_extraction(pages: DataFrame, words: DataFrame, unmapped: DataFrame, ocr: bool = False) -> DataFrame:
    """doc_id, full_text (pages parted by a blank line), words in page order, unrecognized_rows, ocr_used."""
    text = pages.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "full_text"))), lambda x: x["full_text"]), "\n\n").alias("full_text"))
    w = F.struct("page", "seq", F.struct("text", "x0", "x1", "top", "bottom").alias("w"))
    if "words" in words.columns:  # documents given whole
        item = lambda x: F.struct(x["page"], x["seq"], F.struct(*[x[c].alias(c) for c in ("text", "x0", "x1", "top", "bottom")]).alias("w"))
        flat = words.select("doc_id", F.transform(F.array_sort(F.transform("words", item)), lambda x: x["w"]).alias("words"))
    else:
        flat = words.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(w)), lambda x: x["w"]).alias("words"))
    out = text.join(flat.hint("merge"), "doc_id", "left").join(unmapped.select("doc_id", F.col("texts").alias("unrecognized_rows")).hint("merge"), "doc_id", "left")
    return out.select("doc_id", "full_text", F.coalesce("words", F.array().cast(flat.schema["words"].dataType)).alias("words"), F.coalesce("unrecognized_rows", F.array().cast("array<string>")).alias("unrecognized_rows"), F.create_map().cast("map<string,string>").alias("font_metadata"), F.lit(ocr).alias("ocr_used"))


def as_text(df: DataFrame) -> DataFrame:
    """Decimals, dates and timestamps as strings."""
    return df.select(*[F.col(n).cast("string").alias(n) if t.startswith(("decimal", "date", "timestamp")) else F.col(n) for n, t in df.dtypes])


def bundle_name(exported_at: datetime, version: str = schemas.VERSION) -> str:
    return f"{exported_at:%Y%m%dT%H%M%SZ}_{version}"


def line(df: DataFrame) -> Column:
    """A row of df as one text: nulls are told, maps are in the order of their keys."""
    cols = [F.array_sort(F.map_entries(n)).alias(n) if t.startswith("map") else F.col(n) for n, t in df.dtypes]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def measures(df: DataFrame) -> list[Column]:
    """Aggregates n, the number of rows, and digest, a sum over rows that does not depend on their order."""
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64(line(df)).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("digest")]


def export_bundle(tables: dict[str, DataFrame], folder: str, exported_at: datetime, max_rows: int = 500_000, version: str = schemas.VERSION) -> str:
    """One JSON-lines dataset per table, nulls kept, in import order; returns the bundle's path. An older version is written
    without the columns that came after it.

    Each table is read once: its rows are counted and digested while they are written. The manifest is written last, so a
    folder without one is no bundle.
    """
    path, found = f"{folder.rstrip('/')}/{bundle_name(exported_at, version)}", {}
    if version != schemas.VERSION:
        tables = {t: M.lowered(df, t, version) for t, df in tables.items()}
    for name in (t for t in schemas.TABLES if t in tables):
        rows, seen = as_text(tables[name]), Observation(f"{name}_{uuid.uuid4().hex}")
        rows.observe(seen, *measures(rows)).write.option("ignoreNullFields", "false").option("maxRecordsPerFile", max_rows).json(f"{path}/{name}")
        found[name] = seen.get
    if found:
        spark = next(iter(tables.values())).sparkSession
        counts, digests = {t: x["n"] for t, x in found.items()}, {t: x["digest"] for t, x in found.items()}
        _manifest(spark, exported_at, counts, digests, version).coalesce(1).write.json(f"{path}/manifest")
    return path


def _manifest(spark: SparkSession, exported_at: datetime, counts: dict[str, int], digests: dict[str, str], version: str) -> DataFrame:
    kinds = "schema_version string, exported_at string, import_order array<string>, row_counts map<string,bigint>, digests map<string,string>"
    return spark.createDataFrame([(version, exported_at.isoformat(), list(counts), counts, digests)], kinds)


def verify_bundle(spark: SparkSession, path: str) -> DataFrame:
    """name, expected, found, same of each table that the manifest tells: its rows as told and as read back, and whether number
    and digest agree. Rows are read as the bundle's own version has them. A bundle without digests is held to its numbers alone."""
    told, parts = manifest(spark, path), []
    for name, df in read_bundle(spark, path).items():
        rows, digest = as_text(df), (told["digests"] or {}).get(name)
        same = F.col("n") == told["row_counts"][name]
        same = same & (F.col("digest") == digest) if digest is not None else same
        parts.append(rows.agg(*measures(rows)).select(F.lit(name).alias("name"), F.lit(told["row_counts"][name]).alias("expected"), F.col("n").alias("found"), same.alias("same")))
    return reduce(DataFrame.unionByName, parts)


def differences(tables: dict[str, DataFrame], back: dict[str, DataFrame]) -> DataFrame:
    """name, rows, missing, extra: rows of each table, those that the other side lacks, and those that only it has; a row that
    repeats counts as often as it does."""
    parts = []
    for name in [t for t in schemas.TABLES if t in tables or t in back]:
        sides = [as_text(x[name]).select(line(as_text(x[name])).alias("row"), F.lit(k).alias("k")) for x, k in ((tables, 1), (back, -1)) if name in x]
        per = reduce(DataFrame.unionByName, sides).groupBy("row").agg(F.sum("k").alias("k"), F.count_if(F.col("k") > 0).alias("n"))
        parts.append(per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(a) for a, c in (("rows", F.col("n")), ("missing", F.greatest("k", F.lit(0))), ("extra", F.greatest(-F.col("k"), F.lit(0))))]).select(F.lit(name).alias("name"), "rows", "missing", "extra"))
    return reduce(DataFrame.unionByName, parts)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n of each table, in one job."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()])


def export_manifest(tables: dict[str, DataFrame], exported_at: datetime) -> DataFrame:
    """One row: schema_version, exported_at, import_order, row_counts."""
    order = [t for t in schemas.TABLES if t in tables]
    counts = table_counts({t: tables[t] for t in order})
    return counts.agg(F.lit(schemas.VERSION).alias("schema_version"), F.lit(exported_at.isoformat()).alias("exported_at"), F.from_json(F.lit(json.dumps(order)), "array<string>").alias("import_order"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("row_counts"))


def manifest(spark: SparkSession, path: str):
    """The manifest's row: schema_version, exported_at, import_order, row_counts, digests. A version that is not told is the
    current one, a time that is not told is before all others."""
    kinds = "schema_version string, exported_at string, import_order array<string>, row_counts map<string,bigint>, digests map<string,string>"
    rows = spark.read.schema(kinds).json(f"{path}/manifest")
    return rows.withColumns({"schema_version": F.coalesce("schema_version", F.lit(schemas.VERSION)), "exported_at": F.coalesce("exported_at", F.lit("0001-01-01T00:00:00"))}).first()


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a bundle as the version that its manifest tells has them; what does not parse is null. A version that is not
    in the chain is refused."""
    told = manifest(spark, path)
    had = {t: M.columns_at(t, told["schema_version"]) for t in told["import_order"]}
    return {t: M.cast_to(spark.read.schema(schemas.ddl_of(c, as_text=True)).json(f"{path}/{t}"), c) for t, c in had.items()}


def import_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a bundle in the current schema, taken up from its own version step by step (see migrations)."""
    version = manifest(spark, path)["schema_version"]
    return {t: M.upgraded(df, t, version) for t, df in read_bundle(spark, path).items()}


def import_bundles(spark: SparkSession, paths: list[str]) -> dict[str, DataFrame]:
    """Tables of several bundles, each of any version, as one model in the current schema.

    Of a row that several bundles hold, by id, the one that was exported last counts (at one time: that of the later path). What
    hangs on a document comes whole from the bundle that its document comes from. Rows without an id stay. A bundle may lack tables. Only ids that two bundles hold are joined with the rows.
    """
    def when(path: str) -> datetime:
        at = datetime.fromisoformat(manifest(spark, path)["exported_at"])
        return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at

    at = {p: when(p) for p in paths}
    order = sorted(range(len(paths)), key=lambda i: (at[paths[i]], i), reverse=True)
    read = [import_bundle(spark, paths[i]) for i in order]  # the last export first

    def held(table: str, key: str) -> DataFrame | None:
        """key, first: the last export that holds it, where several do."""
        ids = [t[table].select(F.col("id").alias(key), F.lit(k).alias("k")) for k, t in enumerate(read) if table in t]
        if len(ids) < 2:
            return None
        return reduce(DataFrame.unionByName, ids).where(F.col(key).isNotNull()).groupBy(key).agg(F.min("k").alias("first"), F.max("k").alias("_last")).where(F.col("_last") > F.col("first")).select(key, "first")

    documents, out = held("payroll_document", "document_id"), {}
    for name in (t for t in schemas.TABLES if any(t in b for b in read)):
        rows = reduce(DataFrame.unionByName, [b[name].withColumn("_k", F.lit(k)) for k, b in enumerate(read) if name in b])
        older = [(held(name, "id"), "id")]
        if name in schemas.CHILDREN:
            older = [(documents, "document_id"), *older]
        for ids, key in older:
            if ids is not None:
                rows = rows.alias("r").join(ids.alias("o"), (F.col(f"r.{key}") == F.col(f"o.{key}")) & (F.col("r._k") > F.col("o.first")), "left_anti")
        out[name] = rows.drop("_k")
    return out


def upgrade_schema(df: DataFrame, table: str) -> DataFrame:
    """Columns of the current schema, in order and type; those that df lacks are null, unknown ones go."""
    return M.cast_to(df, schemas.columns(table))


def reconcile_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """name, expected, found where they differ; a table missing on one side differs."""
    j = expected.select("name", F.col("n").alias("expected")).join(actual.select("name", F.col("n").alias("found")), "name", "full_outer")
    return j.where(~F.col("expected").eqNullSafe(F.col("found")))
