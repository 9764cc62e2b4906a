"""Tables on storage: which partitions a change rewrites, what a second run gives, jobs from folder to report."""

import datetime

import pytest
from pyspark.sql import functions as F

from wagebook import schemas
from wagebook.plans import common, jobs
from wagebook.sources.files import new_folder, stored
from wagebook.sources.tables import DEPENDENT, Tables


def rows_of(spark, ids, kids=("tax", "pay_line", "anomaly")):
    """Documents and one row of each child table for each."""
    docs = spark.createDataFrame([(i,) for i in ids], "id string")
    fill = lambda df, t, have: df.select(*[F.col(c) if c in have else F.lit({"string": "x", "boolean": False, "array<string>": None}.get(k)).cast(k).alias(c) for c, k, _ in schemas.columns(t)])
    out = {"payroll_document": fill(docs, "payroll_document", {"id"})}
    for t in schemas.CHILDREN:
        some = docs if t in kids else docs.where("false")
        out[t] = fill(some.select(F.concat("id", F.lit(t)).alias("id"), F.col("id").alias("document_id")), t, {"id", "document_id"})
    return out


def files(tables, name):
    try:
        return {(r["batch"], r["f"].rsplit("/", 1)[1]) for r in tables.read(name).select("batch", F.input_file_name().alias("f")).distinct().collect()}
    except Exception:
        return set()


def ids(tables, name, col="document_id"):
    return sorted((r[col], r["batch"]) for r in tables.read(name).collect())


def gone(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "document_id string")


def test_only_touched_partitions_are_rewritten(spark):
    t = Tables(spark, new_folder(spark))
    for batch, docs in (("1", ["a", "b"]), ("2", ["c", "d"]), ("3", ["e"])):
        t.apply(batch, gone(spark), rows_of(spark, docs))
    assert ids(t, "tax") == [("a", "1"), ("b", "1"), ("c", "2"), ("d", "2"), ("e", "3")]
    before = {n: files(t, n) for n in DEPENDENT}
    t.apply("4", gone(spark, "a", "e", "none"), rows_of(spark, ["a", "f"]))
    for n in ("payroll_document", "tax", "pay_line", "anomaly"):
        col = "id" if n == "payroll_document" else "document_id"
        assert ids(t, n, col) == [("a", "4"), ("b", "1"), ("c", "2"), ("d", "2"), ("f", "4")]
        now, old = files(t, n), before[n]
        assert {f for f in now if f[0] == "2"} == {f for f in old if f[0] == "2"}  # not rewritten
        assert not {f for f in now if f[0] == "1"} & {f for f in old if f[0] == "1"} and not {f for f in now if f[0] == "3"}
    assert t.read("tfr").count() == 0
    again = {n: sorted(map(str, t.read(n).collect())) for n in DEPENDENT}
    t.apply("4", gone(spark, "a", "e"), rows_of(spark, ["a", "f"]))  # run again
    assert again == {n: sorted(map(str, t.read(n).collect())) for n in DEPENDENT}
    t.apply("5", gone(spark, "c"))  # a deletion alone
    assert ids(t, "tax") == [("a", "4"), ("b", "1"), ("d", "2"), ("f", "4")]
    untouched = files(t, "tax")
    t.apply("6", gone(spark))
    assert files(t, "tax") == untouched


def test_a_run_that_stops_midway_is_mended_by_running_it_again(spark, monkeypatch):
    t = Tables(spark, new_folder(spark))
    t.apply("1", gone(spark), rows_of(spark, ["a", "b"]))
    write = Tables.write
    monkeypatch.setattr(Tables, "write", lambda self, name, *a: (_ for _ in ()).throw(RuntimeError("lost")) if name == "anomaly" else write(self, name, *a))
    with pytest.raises(RuntimeError, match="lost"):
        t.apply("2", gone(spark, "a"), rows_of(spark, ["a", "c"]))
    assert ids(t, "payroll_document", "id") == [("a", "1"), ("b", "1")]
    monkeypatch.undo()
    t.apply("2", gone(spark, "a"), rows_of(spark, ["a", "c"]))
    for n in ("payroll_document", "tax", "anomaly"):
        assert ids(t, n, "id" if n == "payroll_document" else "document_id") == [("a", "2"), ("b", "1"), ("c", "2")]


def test_folder_to_tables(spark, tmp_path):
    """Words in a folder, two runs, a deletion, and the same file again."""
    folder = new_folder(spark)
    words = stored(common.words(spark, "/root/testdata/sf0.001").where("cast(doc_id as long) < 400"))
    words.write.parquet(f"{folder}/words")
    spark.createDataFrame([("nothing",)], "doc_id string").unionByName(words.select("doc_id").distinct()).write.parquet(f"{folder}/pages")
    t = Tables(spark, f"{folder}/tables")
    jobs.run(t, folder, "0001", "2024-01-01")
    first = {r["status"]: r["n"] for r in jobs.summary(t, "0001").collect()}
    docs = t.read("payroll_document").count()
    assert docs + first.get("FAILED", 0) == words.select("doc_id").distinct().count() + 1
    jobs.run(t, folder, "0002", "2024-02-01")
    second = {r["status"]: r["n"] for r in jobs.summary(t, "0002").collect()}
    good = first.get("PROCESSED", 0) + first.get("PROCESSED_WITH_ANOMALIES", 0)
    assert second["SKIPPED"] == good and second["NEEDS_REVIEW"] == first["NEEDS_REVIEW"] and t.read("payroll_document").count() == docs
    assert {r["batch"] for r in t.read("payroll_document").where("status = 'NEEDS_REVIEW'").select("batch").distinct().collect()} == {"0002"}
    gone_ = t.read("payroll_document").where("status = 'PROCESSED_WITH_ANOMALIES'").orderBy("id").first()
    report = jobs.delete(t, "0003", sha256=gone_["sha256"]).collect()
    assert [r["deleted"] for r in report] == [True] and t.read("pay_line").where(F.col("document_id") == gone_["id"]).count() == 0
    jobs.run(t, folder, "0004", "2024-03-01")
    assert t.read("payroll_document").where(F.col("id") == gone_["id"]).first()["batch"] == "0004"
    assert t.read("payroll_document").count() == docs and t.model()["payroll_document"].columns == [c for c, _, _ in schemas.columns("payroll_document")]
    cover = jobs.check_years(t)["coverage"].agg(F.sum("totale")).first()[0]
    assert cover == t.read("payroll_document").where("period_id is not null").count()
    path, off = jobs.export(t, f"{folder}/out", datetime.datetime(2025, 7, 15, 10, 30))
    assert off.count() == 0 and path.endswith("20250715T103000Z_1.0.0")
