"""Column functions on single values."""

import datetime
import random
import re
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wagebook.functions import columns as C
from wagebook.functions import ids as I
from wagebook.functions import text as X

WORDS = "array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>"


def one(spark, fn, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def w(*pairs, top=100.0):
    return [(t, float(x), x + 5.0 * len(t) + 2, top, top + 10) for t, x in pairs]


def test_labels(spark):
    assert one(spark, X.normalize_label, ["Totale Competenze", "Totale sCompetenze", "TOTALE", None]) == ["totalecompetenze", "totalecompetenze", "totale", None]
    assert X.label("Totale Ritenute Sociali") == "totaleritenuteociali"


def test_amounts(spark):
    cases = {"128": 128, "1.234,56": "1234.56", "(128,00)": -128, "{128,00)": -128, "(128,00": -128, "297,10)": "-297.10", "abc": None, "  42,50  ": "42.50", "1.2.3": 123, "12,": 12, ",5": "0.5", "-5": -5, "(-5)": 5, "(": None, "": None, "1e5": 100000, "inf": None, "NaN": None, "1_0": None, "99999999999999": None}
    got = one(spark, X.parse_amount, list(cases))
    assert got == [None if v is None else Decimal(str(v)) for v in cases.values()]
    assert one(spark, X.find_amounts, ["Base 1.234,56 Trattenuta 128,00 Altro 5"]) == [["1.234,56", "128,00", "5"]]
    assert one(spark, X.has_amount, ["a b", "a 5,0", "", None]) == [False, True, False, False]
    assert one(spark, X.looks_like_data, ["GG", "%", "(", "5", "x", None]) == [True, True, True, True, False, False]


def test_dates(spark):
    got = one(spark, X.parse_italian_month_year, ["Agosto 2022", "Dicembre 2023 AGG.", "Marzone 2022", None])
    assert [g and (g["mese"], g["anno"]) for g in got] == [(8, 2022), (12, 2023), None, None]
    assert one(spark, X.parse_date, ["Emesso il 15-07-2025 a Roma", "31-02-2025", "x"]) == [datetime.date(2025, 7, 15), None, None]
    assert one(spark, lambda c: X.parse_date(c, "/"), ["4/7/2016", "x 4/7/2016", "31/2/2016", "29/02/2020"]) == [datetime.date(2016, 7, 4), None, None, datetime.date(2020, 2, 29)]


def test_identifiers(spark):
    assert one(spark, I.cf_checksum_valid, ["RSSMRA80A01H501U", "RSSMRA80A01H501A", "rssmra80a01h501u", "RSS", None]) == [True, False, False, False, False]
    body = "O0542811101000000123456"
    good = next(f"IT{c:02d}{body}" for c in range(100) if int("".join(str(int(x, 36)) for x in f"{body}IT{c:02d}")) % 97 == 1)
    assert one(spark, I.iban_mod97_valid, [good, good[:-1] + "7", "IT!!", "", None]) == [True, False, False, False, False]
    got = one(spark, I.recover_iban, [good[:4] + "0" + good[5:], good[:4] + "1" + good[5:], "FR" + good[2:], good])
    assert [(g["iban"], g["repaired"]) for g in got][0] == (good, True)
    assert [g["repaired"] for g in got][1:] == [False, False, False]
    got = one(spark, I.recover_code, ["2P9960", "\\F03020", "200020", "F02000", "xx"])
    assert [(g["code"], g["reason"]) for g in got] == [("ZP9960", "font_digit_lettera"), ("F03020", "prefisso_spurio"), ("200020", None), ("F02000", None), ("xx", None)]
    rows = [w(("*", 1), ("'", 2), ("F02000", 3)), w(("*", 1), ("'", 2), ("-", 3), ("F02000", 4)), w(("F02000", 1)), []]
    assert one(spark, I.leading_code_index, rows, WORDS) == [2, None, 0, None]
    assert one(spark, lambda c: I.suspect_code(c, F.lit(True)), ["200020", "F02000", None]) == [True, False, False]


@pytest.mark.parametrize("descr, want", [("Contributo IVS", "contributo"), ("Ferie godute", "assenza"), ("Ticket elettronico", "benefit"), ("Spese carta di credito", "rimborso"), ("Premio", "retribuzione"), ("Voce", "altro")])
def test_categories(spark, descr, want):
    assert one(spark, C.classify, [descr]) == [want]


def test_zones(spark):
    edges = [199.9, 200.0, 344.9, 345.0, 444.9, 445.0]
    assert one(spark, lambda c: C.column_of(c, "z"), edges, "double") == ["descrizione", "importo_base", "importo_base", "riferimento", "riferimento", "importo"]
    assert one(spark, lambda c: C.column_of(c, "s2"), [299.9, 300.0, 385.0, 455.0, 520.0], "double") == [None, "importo_base", "aliquota", "trattenuta", "competenza"]


def test_amount_zone(spark):
    rows = [w(("(", 460), ("128,00", 465)), w(("408,00)", 460)), w(("100,00", 460)), w(("100,00", 520)), w(("x", 520)), []]
    got = one(spark, lambda c: C.split_amount_zone(X.enriched(c), 513.0), rows, WORDS)
    assert [(g["trattenuta"], g["competenza"]) for g in got] == [(128, None), (408, None), (100, None), (None, 100), (None, None), (None, None)]


def test_repair_and_iban(spark):
    rows = [w(("1.229,03", 1), ("2.911,2", 50), ("3", 90)), w(("2.911,2", 50), ("NETTO", 90)), []]
    got = one(spark, lambda c: X.text_of(C.repair_split_amounts(c)), rows, WORDS)
    assert got == ["1.229,03 2.911,23", "2.911,2 NETTO", ""]
    bare = w(("97", 1), ("E", 2), ("03111", 3), ("11101", 4), ("000000123456", 5))
    assert one(spark, C.find_iban, [bare, bare[:4], []], WORDS) == ["IT97E0311111101000000123456", None, None]


def test_nearest_column(spark):
    heads = F.array(*[F.struct(F.lit(x).alias("x0"), F.lit(n).alias("field")) for x, n in ((100.0, "a"), (200.0, "b"))])
    rows = [w(("1,00", 150), ("2,00", 205), ("3,00", 195)), w(("9,00", 900)), w(("x", 100))]
    got = one(spark, lambda c: C.nearest_column(heads, X.enriched(c), 60.0), rows, WORDS)
    assert got == [{"a": Decimal(1), "b": Decimal(3)}, None, None]


def test_amount_after_label(spark):
    rows = [w(("5,00", 1), ("TOTALE", 50), ("COMPETENZE", 90), ("(", 150), ("7,00", 160)), w(("TOTALE", 1), ("COMPETENZE", 60)), w(("3,00", 1), ("altro", 60)), []]
    assert one(spark, lambda c: X.amount_after_label(X.enriched(c), X.label("TOTALE COMPETENZE")), rows, WORDS) == [7, None, 3, None]


def plain_iban(words):
    """First word that fits each step, one after the other."""
    steps, out = [r"\d{2}", r"[A-Z]", r"\d{5}", r"\d{5}", r"\d{12}"], "IT"
    for t in words:
        if steps and re.fullmatch(steps[0], t, re.ASCII):
            out, steps = out + t, steps[1:]
    return None if steps else out


def test_iban_of_long_and_odd_rows(spark):
    rng = random.Random(5)
    parts = ["97", "E", "03111", "11101", "000000123456", "x", "12", "1", "ab 12", "", "É", "99999"]
    rows = [[rng.choice(parts) for _ in range(rng.randrange(1, 25))] for _ in range(300)]
    got = one(spark, C.find_iban, [w(*[(t, i) for i, t in enumerate(r)]) for r in rows], WORDS)
    assert got == [plain_iban(" ".join(r).split(" ")) for r in rows] and sum(g is not None for g in got) > 20
    long = [("97", 1), *[("Z", i) for i in range(10_000)], ("03111", 1), ("11101", 2), *[("03111", i) for i in range(10_000)], ("000000123456", 3)]
    began = time.time()
    assert one(spark, C.find_iban, [w(*long), w(*long[:-1], ("123456789012x", 4))], WORDS) == ["IT97Z0311111101000000123456", None]
    assert time.time() - began < 8


def plain_after(words, wanted):
    norm, at = "", 0
    for k, (t, _, amt) in enumerate(words):
        norm += "".join(c for c in t if c.isascii() and c.isalnum()).lower().replace("s", "")
        if wanted in norm:
            at = k + 1
            break
    return next((amt for _, _, amt in words[at:] if amt is not None), None)


def test_amount_after_label_of_long_and_odd_rows(spark):
    rng = random.Random(6)
    parts = [("TOTALE", None), ("COMPETENZE", None), ("sTotale", None), ("Comp", None), ("etenze", None), ("5,00", Decimal(5)), ("7", Decimal(7)), ("(", None), ("é", None), ("", None)]
    rows = [[(*p[:1], i, p[1]) for i, p in enumerate(rng.choice(parts) for _ in range(rng.randrange(0, 14)))] for _ in range(300)]
    got = one(spark, lambda c: X.amount_after_label(X.enriched(c), X.label("TOTALE COMPETENZE")), [w(*[x[:2] for x in r]) for r in rows], WORDS)
    assert got == [plain_after(r, "totalecompetenze") for r in rows] and len(set(got)) == 3
    long = [("TOTALE", 1), *[("a", i) for i in range(20_000)], ("TOTALE", 1), ("COMPETENZE", 2), ("9,00", 3)]
    began = time.time()
    assert one(spark, lambda c: X.amount_after_label(X.enriched(c), X.label("TOTALE COMPETENZE")), [w(*long)], WORDS) == [9]
    assert time.time() - began < 8
