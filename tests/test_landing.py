"""Bundles of several versions, and documents landed by year and month."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from wagebook import schemas
from wagebook.plans import jobs
from wagebook.sources import bundle as B
from wagebook.sources import migrations as M
from wagebook.sources.files import new_folder
from wagebook.sources.landing import Landing
from wagebook.sources.tables import Tables

AT = datetime.datetime(2025, 7, 15)


def some(spark, table, *rows):
    """Rows of a table from dicts; what is not told is null."""
    names = [c for c, _, _ in schemas.columns(table)]
    rows = [tuple(r.get(c) for c in names) for r in rows]
    return spark.createDataFrame(rows, schemas.ddl(table))


def test_chain():
    assert [s.version for s in M.chain(list(reversed(M.STEPS)))] == ["0.1.0", "0.2.0", "0.3.0", "1.0.0"] and M.STEPS[-1].version == schemas.VERSION
    assert [s.version for s in M.later("0.2.0")] == ["0.3.0", "1.0.0"] and M.later("1.0.0") == []
    known = {t: {c for c, _, _ in schemas.columns(t)} for t in schemas.TABLES}
    assert all(set(cols) <= known[t] for s in M.STEPS for t, cols in s.added.items())
    with pytest.raises(ValueError, match="2.0.0"):
        M.later("2.0.0")
    for broken in ([*M.STEPS, M.Step("2.0.0", "1.5.0")], M.STEPS[1:], [M.Step("a", None), M.Step("b", "a"), M.Step("c", "a")], [M.Step("a", "b"), M.Step("b", "a")]):
        with pytest.raises(ValueError, match="one chain"):
            M.chain(broken)


def test_steps_fill_what_they_add(spark):
    steps = [M.Step("0.1.0", None), M.Step("0.2.0", "0.1.0", {"tax": ("imposta_dovuta_annua",)}, {"tax.imposta_dovuta_annua": "imponibile_irpef * 2"}), M.Step("1.0.0", "0.2.0", {"tax": ("imposta_pagata_annua",)}, {"tax.imposta_pagata_annua": "imposta_dovuta_annua + 1"})]
    old = spark.createDataFrame([("t", "d", "10.5", "99", "x")], "id string, document_id string, imponibile_irpef string, imposta_pagata_annua string, no_column string")
    for version, due, paid in (("0.1.0", 21, 22), ("0.2.0", None, None), ("1.0.0", None, 99)):
        got = M.upgraded(old, "tax", version, steps)
        row = got.first()
        assert got.dtypes == [(n, t) for n, t, _ in schemas.columns("tax")]
        assert (row["imponibile_irpef"], row["imposta_dovuta_annua"], row["imposta_pagata_annua"]) == (10.5, due, paid)


def test_bundles_of_all_versions(spark):
    doc = lambda i, **x: {"id": i, "sha256": i, "original_filename": f"{i}.pdf", **x}
    line = lambda i, d, **x: {"id": i, "document_id": d, "descrizione": i, "note": "n", "competenza": None, **x}
    tax = {"imponibile_irpef": 1, "imposta_lorda_annua": 2, "imponibile_previdenziale_non_arrotondato": 3}
    from decimal import Decimal

    tax = {k: Decimal(v) for k, v in tax.items()}
    folder, paths = new_folder(spark), []
    had = [("0.1.0", ["a", "z"], [("l1", "a"), ("l2", "a"), ("l9", "z")]), ("0.2.0", ["b"], [("l3", "b")]), ("0.3.0", ["c"], [("l4", "c"), ("l4", "c")]), ("1.0.0", ["d", "a"], [("l5", "d"), ("l1", "a"), (None, "d")])]
    for v, (version, docs, lines) in enumerate(had):
        tables = {"payroll_document": some(spark, "payroll_document", *[doc(i, template_name=version) for i in docs]), "pay_line": some(spark, "pay_line", *[line(*x) for x in lines])}
        if v != 1:  # a bundle may lack a table
            tables["tax"] = some(spark, "tax", *[{"id": f"t{i}", "document_id": i, **tax} for i in docs])
        paths.append(B.export_bundle(tables, folder, AT.replace(minute=v), version=version))
        assert paths[-1].endswith(version)
        assert all(r["same"] for r in B.verify_bundle(spark, paths[-1]).collect())
    raw = json.loads(spark.read.text(f"{paths[0]}/pay_line").first()[0])
    assert "note" not in raw and "note" in json.loads(spark.read.text(f"{paths[1]}/pay_line").first()[0])
    for order in (paths, paths[::-1]):
        t = B.import_bundles(spark, order)
        assert list(t) == ["payroll_document", "pay_line", "tax"]
        assert sorted((r["id"], r["template_name"]) for r in t["payroll_document"].collect()) == [("a", "1.0.0"), ("b", "0.2.0"), ("c", "0.3.0"), ("d", "1.0.0"), ("z", "0.1.0")]
        # l2 hangs on the old a, which the newest bundle replaces; rows that repeat within a bundle, or lack an id, stay
        assert sorted((r["id"] or "", r["note"] or "") for r in t["pay_line"].collect()) == [("", "n"), ("l1", "n"), ("l3", "n"), ("l4", "n"), ("l4", "n"), ("l5", "n"), ("l9", "")]
        got = {r["document_id"]: [None if r[c] is None else int(r[c]) for c in tax] for r in t["tax"].collect()}
        assert got == {"z": [1, None, None], "c": [1, 2, None], "d": [1, 2, 3], "a": [1, 2, 3]}
        assert all(t[n].dtypes == [(c, k) for c, k, _ in schemas.columns(n)] for n in t)
    one = B.import_bundles(spark, paths[:1])
    assert {n: df.count() for n, df in one.items()} == {"payroll_document": 2, "pay_line": 3, "tax": 2}
    assert B.import_bundles(spark, []) == {}
    # what an old bundle cannot have had is not taken over; a version of the future is refused
    spark.createDataFrame([("l1", "a", "sneaked in")], "id string, document_id string, note string").write.mode("overwrite").json(f"{paths[0]}/pay_line")
    assert B.import_bundle(spark, paths[0])["pay_line"].first()["note"] is None
    spark.createDataFrame([("9.0.0", ["tax"])], "schema_version string, import_order array<string>").write.mode("overwrite").json(f"{paths[0]}/manifest")
    with pytest.raises(ValueError, match="9.0.0"):
        B.import_bundle(spark, paths[0])
    with pytest.raises(ValueError, match="9.0.0"):
        B.export_bundle({"tax": some(spark, "tax")}, folder, AT, version="9.0.0")


DOCS = [("a", "p1", "PROCESSED"), ("b", "p1", "NEEDS_REVIEW"), ("c", "p2", "FAILED"), ("d", "p3", "NEEDS_REVIEW"), ("e", None, "NEEDS_REVIEW"), ("f", "none", "PROCESSED")]


def landed(spark, docs=DOCS):
    docs = some(spark, "payroll_document", *[{"id": i, "sha256": i * 64, "original_filename": f"{i}.pdf", "period_id": p, "status": s} for i, p, s in docs])
    periods = some(spark, "payroll_period", *[{"id": i, "anno": y, "mese": m, "tipo": "o"} for i, y, m in (("p1", 2023, 1), ("p2", 2023, 12), ("p3", 2024, 2))])
    notes = some(spark, "anomaly", {"id": "1", "document_id": "b", "tipo": "t", "severita": "error", "messaggio": "m"}, {"id": "2", "document_id": "b", "tipo": "s", "severita": "info", "messaggio": "m"})
    return docs, periods, notes


def files(landing):
    return {r["f"].split("/documents/")[1] for r in landing.documents().select(F.input_file_name().alias("f")).distinct().collect()}


def test_landing(spark):
    x = Landing(spark, new_folder(spark))
    assert x.documents().count() == 0 and x.coverage().count() == 0 and x.errors().count() == 0
    x.land(*landed(spark))
    assert {r["id"]: r["destination"] for r in x.documents().collect()} == {
        "a": "processed/2023/01/aaaaaaaa_a.pdf", "b": "processed/2023/01/bbbbbbbb_b.pdf", "c": "error/c.pdf", "d": "processed/2024/02/dddddddd_d.pdf",
        "e": "processed/non_riconosciuti/eeeeeeee_e.pdf", "f": "processed/non_riconosciuti/ffffffff_f.pdf",
    }
    assert [tuple(r) for r in x.coverage().collect()] == [(2023, 3, 1), (2024, 1, 0)]
    assert [tuple(r) for r in x.problems().collect()] == [(2023, "b.pdf", "NEEDS_REVIEW", ["[error] t: m", "[info] s: m"]), (2023, "c.pdf", "FAILED", []), (2024, "d.pdf", "NEEDS_REVIEW", [])]
    assert [tuple(r) for r in x.without_year().collect()] == [("e.pdf", "NEEDS_REVIEW", [])]
    plan = x.problems(2023)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "= 2023" in scan and "PartitionFilters: []" not in plan
    assert {r["f"].split("/")[-3] for r in x.documents(2023).select(F.input_file_name().alias("f")).collect()} == {"anno=2023"}
    before = files(x)
    # 2023 again: c has gone, so its month goes; other years' files are as they were
    x.land(*landed(spark, [d for d in DOCS if d[0] not in "cde"]), years=[2023])
    now = files(x)
    assert {f for f in now if "2023" not in f} == {f for f in before if "2023" not in f} and not any("mese=12" in f for f in now)
    assert sorted(r["id"] for r in x.documents().collect()) == ["a", "b", "d", "e", "f"]
    x.land(*landed(spark, DOCS[:1]), years=[None])
    assert sorted(r["id"] for r in x.documents().collect()) == ["a", "b", "d"]
    x.land(*landed(spark, DOCS[3:4]), years=[])
    assert sorted(r["id"] for r in x.documents().collect()) == ["a", "b", "d"]
    x.land(*landed(spark, DOCS[3:5]))
    assert sorted(r["id"] for r in x.documents().collect()) == ["d", "e"]


def test_errors_land_as_files(spark):
    x = Landing(spark, new_folder(spark))
    rows = [("r", "a.pdf", "ValueError", "é \"x\"\n", "1"), ("r", "a.pdf", "ValueError", "é \"x\"\n", "1"), ("s", "b.pdf", None, None, "2")]
    errors = spark.createDataFrame(rows, "run_id string, filename string, error_type string, message string, batch string")
    x.land_errors(errors)
    x.land_errors(errors.where("batch = '2'"))
    assert sorted(map(str, (tuple(r) for r in x.errors().collect()))) == sorted(map(str, rows)) and x.errors("2").count() == 1
    assert '"error_type":"ValueError"' in spark.read.text(f"{x.path}/errors/batch=1").first()[0]


def test_job_lands_what_a_batch_touches(spark):
    t, x = Tables(spark, new_folder(spark)), Landing(spark, new_folder(spark))
    docs, periods, notes = landed(spark)
    for name, rows in (("payroll_document", docs), ("payroll_period", periods), ("anomaly", notes)):
        t.write(name, rows.withColumn("batch", F.lit("1")), [])
    jobs.land(t, x)
    assert x.documents().count() == 6
    before = files(x)
    t.apply("2", spark.createDataFrame([("d",), ("e",)], "document_id string"))
    jobs.land(t, x, "2")  # the batch has no document; those it took away have left their years
    assert sorted(r["id"] for r in x.documents().collect()) == ["a", "b", "c", "f"]
    assert {f for f in files(x) if "2023" in f} == {f for f in before if "2023" in f}
