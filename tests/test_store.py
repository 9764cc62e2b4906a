"""Dedup, dimensions, deletes, reports and bundles on small tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from wagebook import schemas
from wagebook.operators import quality as Q
from wagebook.operators import reports as R
from wagebook.operators import skew
from wagebook.operators import store as S
from wagebook.plans import queries_store
from wagebook.sources import bundle as B
from wagebook.sources import registry
from wagebook.sources.files import new_folder, stored
from wagebook.sources.registry import Registry

TS = datetime.datetime(2024, 1, 1)


def empty(spark, t):
    return spark.createDataFrame([], schemas.ddl(t))


def test_schema_round_trip(spark):
    for t in schemas.TABLES:
        assert [(n, k) for n, k, _ in schemas.columns(t)] == [(f.name, f.dataType.simpleString()) for f in empty(spark, t).schema]


def test_skip_and_dedup(spark):
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "filename string, sha256 string")
    reg = spark.createDataFrame([("1", "PROCESSED"), ("2", "NEEDS_REVIEW")], "sha256 string, status string")
    new, known = S.skip_known(files, reg)
    assert [r["filename"] for r in new.orderBy("filename").collect()] == ["b", "c"] and known.first()["filename"] == "a"
    o = spark.createDataFrame([("1", "b", "PROCESSED"), ("1", "a", "PROCESSED"), ("2", "c", "NEEDS_REVIEW"), ("2", "d", "NEEDS_REVIEW"), ("3", "e", "FAILED"), ("3", "f", "FAILED")], "sha256 string, filename string, status string")
    kept, skipped = S.dedup_batch(o)
    assert sorted(r["filename"] for r in kept.collect()) == ["a", "d", "e", "f"] and [r["filename"] for r in skipped.collect()] == ["b"]


def test_registry(spark):
    place = new_folder(spark)
    files = spark.createDataFrame([(f"f{i}", "hot" if i % 3 == 0 else f"h{i}" if i % 3 == 1 else None) for i in range(900)], "filename string, sha256 string").repartition(4)
    one = Registry(spark, "registry_one", place, 4)
    new, known = S.skip_known(files, one)
    assert new.count() == 900 and known.count() == 0
    one.record(spark.createDataFrame([("hot", "NEEDS_REVIEW"), ("h1", "PROCESSED"), ("h4", "PROCESSED"), *[(f"old{i}", "PROCESSED") for i in range(500)]], "sha256 string, status string"), "0001")
    one.record(spark.createDataFrame([("hot", "PROCESSED_WITH_ANOMALIES"), ("h4", "NEEDS_REVIEW")], "sha256 string, status string"), "0002")
    one.forget()
    two = Registry(spark, "registry_two", place)  # found by its path
    new, known = S.skip_known(files, two)
    assert {r["sha256"] for r in known.select("sha256").distinct().collect()} == {"hot", "h1"} and known.count() == 301 and new.count() == 599
    assert {r["status"] for r in two.latest(stored(files.select(F.lit("hot").alias("sha256")).limit(1)), S.OK, besides="0002").collect()} == {"NEEDS_REVIEW"}
    hashes = stored(files.where("sha256 is not null").select("sha256").distinct())
    assert sorted(map(tuple, two.latest(hashes, S.OK).collect())) == sorted(map(tuple, two.latest(hashes, S.OK, filtered=False).collect())) == [("h1", "PROCESSED"), ("h4", "NEEDS_REVIEW"), ("hot", "PROCESSED_WITH_ANOMALIES")]


def test_registry_is_not_exchanged_and_is_thinned(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = Registry(spark, "registry_three", new_folder(spark), 4)
        r.record(spark.createDataFrame([(f"h{i}", "PROCESSED") for i in range(4000)], "sha256 string, status string"), "1")
        hashes = stored(spark.createDataFrame([(f"h{i}",) for i in range(0, 4000, 40)], "sha256 string"))
        plan = r.latest(hashes, S.OK)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        scan = next(i for i, x in enumerate(lines) if "registry_three" in x)
        indent = lambda x: len(x) - len(x.lstrip(" :+-"))
        above, at = [], indent(lines[scan])
        for x in reversed(lines[:scan]):
            if indent(x) < at:
                above.append(x)
                at = indent(x)
        assert not any("Exchange" in x for x in above) and any("SortMergeJoin" in x for x in above) and "Bucketed: true" in plan
        left = registry._thinned(r.rows(), hashes, 100).count()
        assert 100 <= left < 700
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_only_hot_keys_are_copied(spark):
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(3000)], "key string, i int")
    groups = stored(skew.counted(rows, "key", {"least": F.min("i")}))
    assert skew.share(groups, most_keys=10, least_rows=100) == 300
    got = skew.joined(rows, groups, "key", F.col("i"), most_keys=10, least_rows=100)
    assert got.count() == 3000 and got.where("key = 'hot' and least <> 1 or key <> 'hot' and least <> i").count() == 0
    assert skew.joined(rows.where("false"), groups.where("false"), "key", F.col("i")).count() == 0


def test_dedup_of_mixed_outcomes(spark):
    files = {"1": "a FAILED b PROCESSED c NEEDS_REVIEW d FAILED e PROCESSED", "2": "a NEEDS_REVIEW b PROCESSED_WITH_ANOMALIES", "3": "a FAILED b NEEDS_REVIEW c NEEDS_REVIEW d FAILED", "4": "a FAILED"}
    rows = [(k, f"{k}{x[i]}", x[i + 1]) for k, v in files.items() for x in [v.split()] for i in range(0, len(x), 2)]
    kept, skipped = S.dedup_batch(spark.createDataFrame(rows, "sha256 string, filename string, status string").repartition(3))
    assert sorted(r["filename"] for r in kept.collect()) == ["1a", "1b", "2b", "3a", "3c", "3d", "4a"]
    assert sorted(r["filename"] for r in skipped.collect()) == ["1c", "1d", "1e"]


def test_reports_of_problems(spark):
    docs = spark.createDataFrame([("a", "z", 3, 2020, "o", "X", "CF"), ("b", "c", 0, 0, "o", "", ""), ("c", "unknown", None, None, None, None, None), ("d", "z", 3, 2020, "o", "X", "CF")], "doc_id string, template string, mese int, anno int, tipo string, ragione_sociale string, codice_fiscale string")
    good = "IT60X0542811101000000123456"
    totals = spark.createDataFrame([("a", 1, good), ("b", None, None), ("d", 1, good[:-1] + "7")], "doc_id string, netto_mese int, iban string")
    lines, none = spark.createDataFrame([("a",), ("d",)], "doc_id string"), spark.createDataFrame([], "doc_id string, severita string")
    report = R.acceptance_report(docs, lines, totals, none)
    assert {r["doc_id"]: r["problems"] for r in report.collect()} == {"a": "", "b": "azienda, codice_fiscale, periodo, netto, iban mancante, righe", "c": "template", "d": "iban non valido"}
    want = [("a", "z", 3, 2021), ("b", "c", None, None), ("c", "z", 1, 2020), ("d", "z", 3, 2020), ("e", "z", None, None)]
    got = R.check_expected(report, spark.createDataFrame(want, "doc_id string, template string, mese int, anno int"))
    assert {r["doc_id"]: r["problems"] for r in got.collect()} == {"a": "anno", "b": "azienda, codice_fiscale, periodo, netto, iban mancante, righe", "c": "template", "d": "iban non valido", "e": "documento"}


def test_dimensions(spark):
    docs = spark.createDataFrame(
        [("A", None, "x", "CF1", "First", 1, 2020, "ordinario", TS, "a.pdf"), ("A", None, "y", "CF1", "Later", 1, 2020, "extra", TS, "b.pdf"), ("A", "7", "z", "", "No", 0, 0, "ordinario", TS, "c.pdf"), ("", None, "w", None, "No", None, None, "ordinario", TS, "d.pdf")],
        "ragione_sociale string, codice_azienda string, indirizzo string, codice_fiscale string, cognome_nome string, mese int, anno int, tipo string, run_ts timestamp, filename string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("inail_aut", "inail_del", "inail_sede", "posizione_inps", "pat_inail")}).withColumn("label", F.lit("l"))
    c = S.upsert_company(S.upsert_company(empty(spark, "company"), docs), docs.withColumn("indirizzo", F.lit("new")))
    assert {(r["ragione_sociale"], r["codice_azienda"], r["indirizzo"]) for r in c.collect()} == {("A", None, "x"), ("A", "7", "z")}
    e = S.upsert_employee(empty(spark, "employee"), docs).collect()
    assert [(r["codice_fiscale"], r["cognome_nome"]) for r in e] == [("CF1", "First")]
    p = S.upsert_period(empty(spark, "payroll_period"), docs).collect()
    assert {(r["mese"], r["tipo"]) for r in p} == {(1, "ordinario"), (1, "extra")}


def test_employment_is_back_filled(spark):
    d = "employee_id string, company_id string, hire_date date, run_ts timestamp, filename string"
    one = S.upsert_employment(empty(spark, "employment"), spark.createDataFrame([("e", "c", None, TS, "a"), (None, "c", None, TS, "b")], d))
    r = one.first()
    assert one.count() == 1 and str(r["valid_from"]) == "1970-01-01" and r["data_assunzione"] is None
    two = S.upsert_employment(one, spark.createDataFrame([("e", "c", datetime.date(2020, 5, 1), TS, "b"), ("e", "c", datetime.date(2021, 5, 1), TS, "c")], d))
    r = two.first()
    assert two.count() == 1 and str(r["valid_from"]) == "2020-05-01" == str(r["data_assunzione"])


def test_logical_keys(spark):
    docs = spark.createDataFrame([("1", "b", "e", "c", "p"), ("2", "a", "e", "c", "p"), ("3", "c", None, "c", "p"), ("4", "d", None, "c", "p"), ("5", "e", "e2", "c", "p")], "id string, filename string, employee_id string, company_id string, period_id string")
    ok, bad = S.logical_key_conflicts(docs, docs.where("id = '5'"))
    assert sorted(r["id"] for r in ok.collect()) == ["2", "3", "4"] and sorted(r["id"] for r in bad.collect()) == ["1", "5"]


def test_delete(spark):
    docs = spark.createDataFrame([("1", "s1", "f"), ("2", "s2", "f"), ("3", "s3", "g")], "id string, sha256 string, original_filename string").withColumn("status", F.lit("PROCESSED"))
    kids = spark.createDataFrame([("a", "1"), ("b", "3")], "id string, document_id string")
    t = {"payroll_document": docs, "pay_line": kids, "audit_event": kids}
    out, report = S.delete_document(t, filename="f")
    assert out["payroll_document"].count() == 3 and report.count() == 2 and not report.first()["deleted"]
    out, report = S.delete_document(t, sha256="s3")
    assert (out["payroll_document"].count(), out["pay_line"].count(), out["audit_event"].count()) == (2, 1, 1)
    with pytest.raises(ValueError):
        S.delete_document(t)
    with pytest.raises(ValueError):
        S.delete_document(t, filename="f", doc_id="1")


def test_audit(spark):
    t = {
        "payroll_document": spark.createDataFrame([("1",)], "id string"), "tax": spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "9")], "id string, document_id string"),
        "anomaly": spark.createDataFrame([("x", "1", "t", "fatal", "m")], "id string, document_id string, tipo string, severita string, messaggio string"), "payroll_period": spark.createDataFrame([("p", 13, 2020, "o")], "id string, mese int, anno int, tipo string"),
    }
    got = {(r["table"], r["check"], r["key"]) for r in S.audit_constraints(t).collect()}
    assert got == {("tax", "one_per_document", "1"), ("tax", "orphan", "c"), ("anomaly", "severity", "x"), ("payroll_period", "month", "p")}


def test_route_and_status(spark):
    d = spark.createDataFrame([("a" * 64, "07.pdf", "PROCESSED", 7, 2025), ("b" * 64, "07.pdf", "PROCESSED", 0, 0), ("c" * 64, "x.pdf", "FAILED", 7, 2025)], "sha256 string, filename string, status string, mese int, anno int")
    assert [r["destination"] for r in S.destination_path(d).orderBy("sha256").collect()] == ["processed/2025/07/aaaaaaaa_07.pdf", "processed/non_riconosciuti/bbbbbbbb_07.pdf", "error/x.pdf"]
    docs = spark.createDataFrame([("1",), ("2",), ("3",)], "doc_id string")
    a = spark.createDataFrame([("2", "warning"), ("3", "error"), ("3", "info")], "doc_id string, severita string")
    assert {r["doc_id"]: (r["status"], r["anomalies"]) for r in Q.determine_status(docs, a).collect()} == {"1": ("PROCESSED", 0), "2": ("PROCESSED_WITH_ANOMALIES", 1), "3": ("NEEDS_REVIEW", 2)}


def test_net_edge(spark):
    t = spark.createDataFrame([("ok", 1000, 300, "701.50"), ("off", 1000, 300, "650"), ("part", None, 300, "1")], "doc_id string, c int, t int, n string")
    t = t.select("doc_id", F.col("c").cast("decimal(14,5)").alias("totale_competenze"), F.col("t").cast("decimal(14,5)").alias("totale_trattenute"), F.col("n").cast("decimal(14,5)").alias("netto_mese"))
    got = Q.rule_net(t).collect()
    assert [(r["doc_id"], r["messaggio"]) for r in got] == [("off", "Netto atteso 700.00, trovato 650.00")]


def test_coverage(spark):
    docs = spark.createDataFrame([("1", "p1", "PROCESSED", "a"), ("2", "p1", "FAILED", "b"), ("3", "p2", "PROCESSED", "c"), ("4", None, "PROCESSED", "d"), ("5", None, "NEEDS_REVIEW", "e")], "id string, period_id string, status string, original_filename string")
    periods = spark.createDataFrame([("p1", 1, 2023, "o"), ("p2", 1, 2022, "o")], "id string, mese int, anno int, tipo string")
    an = spark.createDataFrame([("5", 2, "error", "t2", "m2"), ("5", 1, "info", "t1", "m1")], "document_id string, rule_no int, severita string, tipo string, messaggio string")
    assert [tuple(r) for r in R.year_coverage(docs, periods).collect()] == [(2022, 1, 1), (2023, 2, 1)]
    assert [tuple(r) for r in R.year_problems(docs, periods, an).collect()] == [(2023, "b", "FAILED", [])]
    assert [tuple(r) for r in R.without_year(docs, periods, an).collect()] == [("e", "NEEDS_REVIEW", ["[info] t1: m1", "[error] t2: m2"])]
    assert R.run_summary(docs).first().asDict() == {"total": 5, "processed": 3, "with_anomalies": 0, "needs_review": 1, "failed": 1, "skipped": 0}
    assert R.run_summary(docs.where("false")).first()["total"] == 0
    files = spark.createDataFrame([("a.PDF",), ("b.pdf",), ("b.pdf:Zone.Identifier",), ("c.txt",)], "path string")
    assert R.input_backlog(files).first()["n"] == 2


def test_bundle(spark):
    at = datetime.datetime(2025, 7, 15, 10, 30)
    periods = spark.createDataFrame([("p", 1, 2023, "o", None)], schemas.ddl("payroll_period"))
    totals = spark.sql("select 't' as id, 'd' as document_id, cast(null as decimal(14,5)) as imponibile_inps, cast(1234.56789 as decimal(14,5)) as netto_mese")
    totals = B.upgrade_schema(totals, "payroll_totals")
    path = B.export_bundle({"payroll_totals": totals, "payroll_period": periods}, new_folder(spark), at)
    assert path.endswith("/20250715T103000Z_1.0.0")
    raw = spark.read.text(f"{path}/payroll_totals").first()[0]
    assert '"netto_mese":"1234.56789"' in raw and '"iban":null' in raw
    back = B.import_bundle(spark, path)
    assert list(back) == ["payroll_period", "payroll_totals"] and back["payroll_totals"].dtypes == totals.dtypes
    assert str(back["payroll_totals"].first()["netto_mese"]) == "1234.56789"
    assert B.reconcile_counts(B.table_counts(back), B.table_counts({"payroll_period": periods, "payroll_totals": totals})).count() == 0
    off = B.reconcile_counts(B.table_counts(back), B.table_counts({"payroll_period": periods.where("false")})).collect()
    assert {(r["name"], r["expected"], r["found"]) for r in off} == {("payroll_period", 1, 0), ("payroll_totals", 1, None)}


def test_bundle_tells_every_difference(spark):
    kinds = "id string, document_id string, tipo string, severita string, messaggio string, campo string, created_at timestamp"
    notes = spark.createDataFrame([("a", "1", "t", "info", "é\n\"x\"", None, TS), ("a", "1", "t", "info", "é\n\"x\"", None, TS), ("b", "2", "t", "error", "", "f", None)], kinds)
    words = [(("w", 1.5, 2.0, 1e-9, 3.0),)]
    raw = spark.createDataFrame([("r", "1", "", [w[0] for w in words], [], {"b": "1", "a": "2"}, False), ("s", "2", "x", [], ["u"], {}, None)], schemas.ddl("raw_extraction"))
    tables = {"anomaly": notes, "raw_extraction": raw, "tax": empty(spark, "tax")}
    path = B.export_bundle(tables, new_folder(spark), datetime.datetime(2025, 7, 15))
    assert {tuple(r) for r in B.verify_bundle(spark, path).collect()} == {("anomaly", 3, 3, True), ("raw_extraction", 2, 2, True), ("tax", 0, 0, True)}
    back = B.import_bundle(spark, path)
    assert {tuple(r) for r in B.differences(tables, back).collect()} == {("anomaly", 3, 0, 0), ("raw_extraction", 2, 0, 0), ("tax", 0, 0, 0)}
    other = dict(back, anomaly=notes.limit(0).unionByName(notes.where("id = 'a'").limit(1)).unionByName(notes.where("id = 'b'").withColumn("campo", F.lit("g"))))
    assert {tuple(r) for r in B.differences(tables, other).where("name = 'anomaly'").collect()} == {("anomaly", 3, 2, 1)}
    notes.where("id = 'a'").withColumn("created_at", F.col("created_at").cast("string")).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/anomaly")
    assert {tuple(r) for r in B.verify_bundle(spark, path).where("not same").collect()} == {("anomaly", 3, 2, False)}


def test_ingest(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"ciao mondo")
    (tmp_path / "b.PDF").write_bytes(b"x")
    got = B.ingest_files(spark, f"file://{tmp_path}").collect()
    assert [r["filename"] for r in got] == ["a.pdf"] and got[0]["sha256"].startswith("6c872dc1")


def test_raw_extraction_by_document(spark, tmp_path):
    texts = ["one\n\n\ntwo", "", "x", "a\nb\n"]
    doc = spark.createDataFrame([(i, t, "A" if i < 3 else "B") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    doc.write.parquet(f"file://{tmp_path}/documents.parquet")
    raw = {r["doc_id"]: r for r in queries_store.raw_by_line(doc.withColumn("doc_id", F.col("doc_id").cast("string"))).collect()}
    assert {i: r["full_text"] for i, r in raw.items()} == {str(i): t.replace("\n", "\n\n") for i, t in enumerate(texts)}
    got = {tuple(r) for r in queries_store.a2(spark, f"file://{tmp_path}").collect()}
    assert got == {("A", 9 + 0 + 1 + 4, 3, 0), ("B", 4, 1, 0)}
