"""Layouts as data: the same rows as the code of layout c, on rendered and on odd payslips; rules that are refused."""

import json

import pytest
from pyspark.sql import functions as F

from wagebook.operators import documents as D
from wagebook.operators import layouts as L
from wagebook.plans import common as K
from wagebook.plans import process
from wagebook.sources.files import new_folder, stored

SF = "/root/testdata/sf0.001"


def word(doc, top, x0, text, page=1):
    return (doc, page, text, float(x0), float(x0) + 6.0 * len(text), float(top), float(top) + 8.0)


def line(doc, top, text, page=1, x0=20, step=0):
    out, x = [], x0
    for t in text.split():
        out.append(word(doc, top, x, t, page))
        x += step or 6 * len(t) + 4
    return out


def page(spark, words):
    at, out = {}, []
    for w in words:
        n = at[w[:2]] = at.get(w[:2], -1) + 1
        out.append((w[0], w[1], n, *w[2:]))
    return spark.createDataFrame(out, "doc_id string, page int, seq int, text string, x0 double, x1 double, top double, bottom double")


def odd(spark):
    """Documents that the renderer does not make: no header, thirteenth month, figurative and split amounts, empty blocks, AP2."""
    start = lambda d: line(d, 10, "Codice Azienda/Filiale/Stabil Ragione Sociale Azienda")
    full = [
        *start("full"), *line("full", 40, "ATS/ 12 / VR DITTA SRL"), *line("full", 60, "77/3 ROSSI D'ARCO 12 MARIO"), *line("full", 80, "RSSMRA01A01H501X 4/7/2016 5/8/2017"), *line("full", 90, "13-esima 2021"), *line("full", 95, "Marzo 2020"),
        *line("full", 200, "Descrizione Competenze"),
        *line("full", 210, "0001 Paga"), word("full", 210, 300, "5"), word("full", 210, 320, "GG"), word("full", 210, 360, "10,00"), word("full", 210, 510, "50,00"),
        *line("full", 220, "A002 Auto"), word("full", 220, 510, "70,00"), word("full", 220, 560, "F"),
        *line("full", 230, "0003 Reso"), word("full", 230, 510, "-7,00"), *line("full", 240, "nulla di noto 3,00"), *line("full", 250, "INPS Contributo FAP 9,49 -100,00 -9,49"), *line("full", 255, "INPS Contributo FAP 9,49"),
        *line("full", 260, "Imponibile Previdenziale Non Arrotondato 99,50"), *line("full", 266, "Imponibile Previdenziale Non Arrotondato"),
        *line("full", 280, "Totale Ritenute Sociali 1,00"), *line("full", 300, "2021IM 5,00"), *line("full", 305, "2021IM"), *line("full", 310, "detrfi 6,00"), *line("full", 315, "CvL001 AC 7,00"), *line("full", 320, "cvl001 8,00"),
        *line("full", 325, "Imp.Fisc.Annuo"), *line("full", 330, "x"), *line("full", 335, "Imp.Fisc.Annuo"), *line("full", 340, "12,00"),
        *line("full", 350, "Spettanti Godute Residue"), *line("full", 360, "AC 1,00 2,00 3,00 4,00"), *line("full", 370, "AP2 1,00 2,00 9,00 4,00 5,00 0,00"), *line("full", 380, "AC 7,00"),
        *line("full", 400, "Retribuz. TFR"), *line("full", 410, "44,00"), *line("full", 420, "Accant. Anticipazioni", step=200), *line("full", 430, "1,00 2,00", step=200),
        *line("full", 440, "Totale Ritenute Totale Competenze"), *line("full", 450, "2.911,2 3 5,00"), *line("full", 460, "Totale Ritenute Totale Competenze"), *line("full", 470, "9,00"),
        *line("full", 480, "IT 60 X 05428 11101 000000123456"), *line("full", 490, "Netto da pagare"), *line("full", 500, "x"), *line("full", 510, "-77,00"),
    ]
    bare = line("bare", 300, "CPLUACC1")
    late = [*line("late", 300, "CPLUACC1"), *line("late", 20, "ATS/ 1 / VR TARDI SRL", page=2), *line("late", 30, "Spettanti Godute Residue", page=2), *line("late", 40, "AP 1,00 2,00 3,00", page=2)]
    huge = [*start("huge"), *line("huge", 200, "Descrizione Competenze"), *line("huge", 210, "0001 Paga"), word("huge", 210, 510, "12345678901234,00"), *line("huge", 260, "Totale Ritenute Sociali")]
    other = line("other", 20, "niente di noto")
    return page(spark, [*full, *bare, *late, *huge, *other])


def same(a, b):
    cols = sorted(a.columns)
    key = lambda df: sorted(map(repr, df.select(*cols).collect()))
    assert sorted(b.columns) == cols and key(a) == key(b)


def both(words, spine=None):
    data = L.beside_known([L.profile(L.shipped("c"))])
    assert [p.name for p in data][:3] == ["z", "c", "s"]
    return process.parse_words(words, pages=spine), process.parse_words(words, pages=spine, registry=data)


def test_rendered_payslips_give_the_same_rows_as_the_code(spark):
    rows = stored(K.rows(spark, SF, 1), key="doc_id")
    data = L.profile(L.shipped("c")).mapping(rows)
    same(data["header"], D.header_c(rows))
    same(data["period"], D.period_c(rows))
    tax = D.tax_c(rows).join(D.imponibile_previdenziale(rows), "doc_id").join(D.imponibile_fiscale_annuo(rows), "doc_id")
    same(data["tax"], tax)
    same(data["tfr"], D.tfr(rows, "c"))
    same(data["leave"], D.leave_c(rows))
    same(data["totals"], D.totals_c(rows))
    section = D.section_c(rows)
    same(data["lines"], D.pay_lines_c(section).where("is_line").select(*D.LINE).unionByName(D.inps_fap_lines(section)))
    assert data["header"].count() > 100


def test_odd_payslips_give_the_same_rows_as_the_code_in_the_job(spark):
    code, data = both(odd(spark))
    for name in ("docs", "lines", "totals", "unmapped", "failed", "codes", "tax", "tfr", "leave", "raw"):
        same(getattr(code, name), getattr(data, name))
    assert [r.doc_id for r in data.failed.collect()] == ["huge"]
    r = data.docs.where("doc_id = 'full'").first()
    assert (r.codice_azienda, r.matricola, r.cognome_nome, r.mese, r.anno, r.tipo) == ("ATS/12/VR", "77", "ROSSI D'ARCO", 12, 2021, "mensilita_aggiuntiva")
    assert sorted(r.tipo for r in data.leave.where("doc_id = 'full'").collect()) == ["ferie", "ferie_ap2", "rol_ex_festivita"]


def test_empty_input(spark):
    rows = K.rows_of(odd(spark).where("false"))
    for name, df in L.profile(L.shipped("c")).mapping(rows).items():
        assert df.count() == 0, name


def test_fields_of_stored_rows_exchange_nothing(spark):
    rows = stored(D.prepared(K.rows(spark, SF, 1).select("doc_id", "page", "row_idx", "doc_row", "top", "words", "text")), key="doc_id")
    plan = L.fields(L.shipped("c"), rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_further_layout_from_a_folder(spark):
    own = {"name": "own", "version": "2", "found": {"starts": "niente"}, "totals": {"fields": {"netto_mese": {"when": {"label": "netto"}, "value": {"after": "netto"}, "take": "last"}}}, "period": []}
    folder = new_folder(spark)
    spark.createDataFrame([(json.dumps(own, indent=1),)], "value string").coalesce(1).write.text(folder)
    registry = L.beside_known(L.read(spark, folder))
    assert [p.name for p in registry][-1] == "own"
    words = odd(spark).where("doc_id in ('other', 'bare')").unionByName(page(spark, line("other", 60, "Netto 12,50")).withColumn("seq", F.lit(9)))
    p = process.parse_words(words, registry=registry)
    assert {(r.doc_id, r.template) for r in p.docs.collect()} == {("other", "own"), ("bare", "c")}
    assert [(r.template, float(r.netto_mese)) for r in p.totals.where("doc_id = 'other'").collect()] == [("own", 12.5)]


@pytest.mark.parametrize("change", [
    {"found": {"labels": "x"}}, {"colour": 1}, {"lines": {"begins": {}}}, {"header": {"fields": {"a": {"when": {}, "value": {"amount": 0, "word": 1}}}}},
    {"header": {"fields": {"a": {"when": {}, "value": {"const": 1}, "take": "best"}}}}, {"leave": {"begins": {}, "within": 1, "rows": ["A"], "items": [{"name": "x"}]}},
])
def test_odd_rules_are_refused(spark, change):
    layout = {"name": "own", "version": "1", "found": {"page": 1}} | change
    with pytest.raises(ValueError):
        L.check(layout)
