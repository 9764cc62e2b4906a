"""Payslips made from the order tables, as positioned words: input for queries, tests and benches.

An order is a payslip, its customer the employee, the customer's nation the company, its date the period, its line items
the pay lines. Layout and faults follow from the order number, so what must be read back is known from the tables alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagebook.functions.ids import cf_check_letter
from wagebook.functions.text import MONTHS

#: SQL, good in Spark and DuckDB alike, that gives payslips and their lines from the tables.
SLIPS = """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS doc_id, o_orderkey AS k, o_orderkey % 3 AS layout, c_custkey AS cust, c_nationkey AS nat,
       month(o_orderdate) AS mese, year(o_orderdate) AS anno
FROM orders JOIN customer ON o_custkey = c_custkey
"""
LINES = """
SELECT CAST(l_orderkey AS VARCHAR(20)) AS doc_id, l_orderkey AS k, l_orderkey % 3 AS layout, l_linenumber AS n, l_partkey % 10000 AS code, l_returnflag AS flag,
       l_linestatus AS status, l_quantity AS qty, floor(CAST(round(l_extendedprice * 100) AS BIGINT) * CASE WHEN l_returnflag = 'R' THEN CAST(round(l_tax * 100) AS BIGINT) ELSE 100 END / 100.0) / 100.0 AS amount
FROM lineitem
"""
#: Fixed values of the rendering: flag -> (unit, description in layout z).
UNIT = {"R": "%", "A": "GG", "N": "ORE"}
DESCRIPTION = {"R": "Contributo IVS", "A": "Retribuzione Ordinaria", "N": "Ferie Godute"}
EARN_X, DEDUCT_X = 530.0, 460.0


def italian(value: Column) -> Column:
    """1234.5 -> '1.234,50'."""
    return F.translate(F.format_number(value, 2), ",.", ".,")


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """text over the tables of sf_dir, which are given with the query, so that no view of the session is made."""
    tables = {}
    for t in ("orders", "customer", "lineitem"):
        if f"FROM {t}" in text or f"JOIN {t}" in text:
            text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
            tables[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(text, **tables)


def slips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, SLIPS)


def slip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, LINES)


def first15(cust: Column) -> Column:
    """A fiscal code without its check letter."""
    tens = F.lpad((cust / 100).cast("int").cast("string"), 2, "0")
    return F.concat(F.lit("RSSMRA"), F.lpad((cust % 100).cast("string"), 2, "0"), F.lit("A"), tens, F.lit("H501"))


def with_fiscal_code(df: DataFrame, cust: str = "cust", k: str = "k") -> DataFrame:
    """df with cf, whose check letter is one further and so wrong for order numbers divisible by 11.

    In steps of one column each: the letter reads the first fifteen characters many times.
    """
    df = df.withColumn("first15", first15(F.col(cust))).withColumn("letter", cf_check_letter(F.col("first15")))
    wrong = F.translate("letter", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "BCDEFGHIJKLMNOPQRSTUVWXYZA")
    return df.withColumn("cf", F.concat("first15", F.when(F.col(k) % 11 == 0, wrong).otherwise(F.col("letter"))))


def iban(cust: Column) -> Column:
    """Check digits are not worked out: about one in 97 is valid."""
    return F.concat(F.lit("IT"), F.lpad((cust % 97).cast("string"), 2, "0"), F.lit("O0542811101"), F.lpad(cust.cast("string"), 12, "0"))


class _C(str):
    """The name of a column of a payslip; a plain str is a literal."""


@dataclass(frozen=True)
class _Piece:
    """A word: its text, place, whether the lines push it down, and the condition under which it is printed."""

    text: str
    x: float
    top: float
    pushed: bool
    when: str = ""


class _At(float):
    """A height that the lines push down."""


def _row(top: float, *pieces, when: str = "") -> list[_Piece]:
    """A row's words: each piece is (text, x0)."""
    return [_Piece(t, float(x), float(top), isinstance(top, _At), when) for t, x in pieces]


def _text(top: float, text: str) -> list[_Piece]:
    x, out = 30.0, []
    for word in text.split(" "):
        out.append((word, x))
        x += 5 * len(word) + 10
    return _row(top, *out)


@dataclass(frozen=True)
class _Body:
    """A row for each line: its code after a prefix, then (text, x0) pieces; an amount without x0 stands by its flag."""

    base: float
    prefix: str
    spec: list
    earn_x: float = EARN_X
    deduct_x: float = DEDUCT_X


#: Conditions by name, over order numbers.
_WHEN = {"note": lambda k: k % 7 == 0, "net": lambda k: k % 13 != 0, "orphan": lambda k: k % 17 == 0}


#: What layouts z, c and s print, top to bottom and left to right.
_Z = [
    _text(10, "Codice Azienda Ragione Sociale"), _row(70, (_C("company"), 30), ("SOCIETA", 70), (_C("n_nat"), 120), ("SPA", 150)),
    _text(80, "Via Roma 1 Aut. 12345"), _text(90, "20100 MILANO (MI)"), _text(100, "Sede Territoriale Del 001 Sede 002"), _text(110, "12345678901 1234567/01 7654321/01"),
    _row(120, (_C("badge"), 30), ("ROSSI", 80), ("MARIO", 120), (_C("cf"), 170)), _text(130, "01-01-2020 15-03-2020"),
    _row(140, ("TipoCosto", 30), (_C("month"), 90), (_C("year"), 160)), _text(260, "IMPORTO BASE RIFERIMENTO TRATTENUTE COMPETENZE"),
    _Body(270.0, "ZP", [("first", 60), ("second", 130), ("amount", 210), ("qty", 350), ("unit", 380), ("amount", None)]),
    _row(_At(270.0), ("Riferimento", 60), ("anno", 120), ("2020/2021", 150), when="note"),
    _row(_At(300.0), ("Retribuzione", 30), ("utile", 100), ("T.F.R.", 140), (_C("earn"), 200)), _row(_At(305.0), ("Quota", 30), ("T.F.R.", 70), ("a", 110), ("Fondi", 130), (_C("deduct"), 180)),
    _row(_At(312.0), ("Rivalutaz.", 100), ("Imp.rival.", 200), ("Quota", 300), ("anno", 340), ("Anticipi", 400)), _row(_At(322.0), (_C("revaluation"), 105), ("1.000,00", 205), ("200,00", 305)),
    _row(_At(350.0), ("PROGRESSIVI", 30), ("Imp.", 90), ("INPS", 110), ("Imp.", 160), ("INAIL", 180), ("Imp.", 230), ("IRPEF", 250)), _row(_At(360.0), (_C("earn"), 112), ("500,00", 182), (_C("deduct"), 252)),
    _row(_At(363.4), ("F09110", 30), ("Addizionale", 70), ("regionale", 140), ("2022", 200), ("VENETO", 240), ("Residuo", 290), (_C("earn"), 350)), _row(_At(366.7), ("F09120", 30), ("Addizionale", 70), ("comunale", 140), (_C("deduct"), 350)),
    _row(_At(370.0), ("TOTALE", 30), ("COMPETENZE", 80), (_C("earn"), 160)), _row(_At(380.0), ("TOTALE", 30), ("TRATTENUTE", 80), (_C("deduct"), 160)),
    _row(_At(390.0), ("NETTO", 30), ("DEL", 70), ("MESE", 100)),
    _row(_At(400.0), (_C("net"), 420), when="net"), _row(_At(410.0), ("IBAN", 30), (_C("acct"), 70)),
    _row(_At(430.0), ("Maturato", 90), ("Goduto", 150), ("Residuo", 210), ("Residuo", 270), ("AP", 320)), _row(_At(440.0), ("Ferie", 30), ("20,00", 90), ("15,00", 150), ("5,00", 210)),
]
_C_ROWS = [
    _text(20, "Codice Azienda/Filiale/Stabil Ragione Sociale Azienda"), _row(34, ("ATS/", 30), (_C("branch"), 60), ("VR", 90), ("SOCIETA", 110), (_C("n_nat"), 170), ("SRL", 200)),
    _row(60, (_C("short_badge"), 30), ("ROSSI", 100), ("MARIO", 140)), _row(107, ("37124", 30), ("VERONA", 60), ("04/07/2016", 200), ("23/04/1991", 260), (_C("cf"), 330), ("del", 450)),
    _row(148, (_C("month_year"), 300)), _text(255, "Cod. Descrizione Ore/GG % Dato Base Ritenute Competenze"),
    _Body(264.0, "", [("first", 55), ("second", 120), ("qty", 250), ("unit", 290), ("amount", 350), ("amount", None)]),
    _row(_At(264.0), ("Riga", 30), ("libera", 60), ("12,00", 460), when="orphan"),
    _row(_At(274.0), ("INPS", 30), ("Contributo", 60), ("FAP", 120), ("9,490", 250), (_C("earn"), 350), (_C("deduct"), 440)), _row(_At(284.0), ("Imponibile", 30), ("Previdenziale", 90), ("Non", 160), ("Arrotondato", 190), (_C("earn"), 460)),
    _row(_At(300.0), ("Totale", 30), ("Ritenute", 70), ("Sociali", 120)), _row(_At(310.0), ("1001IM", 30), ("Imponibile", 70), (_C("earn"), 300)), _row(_At(320.0), ("1001RM", 30), ("Lorda", 70), (_C("deduct"), 300)),
    _row(_At(330.0), ("CvL024", 30), ("AC", 70), ("Acconto", 90), ("33,00", 300)), _row(_At(340.0), ("RfVE01", 30), ("Regionale", 70), ("44,00", 300)),
    _row(_At(350.0), ("Retribuz.", 100), ("Utile", 160), ("TFR", 200)), _row(_At(360.0), (_C("earn"), 110)), _row(_At(370.0), ("Accant.", 100), ("Anticipazioni", 300)), _row(_At(380.0), ("77,00", 102), ("88,00", 305)),
    _row(_At(400.0), ("Imp.Fisc.Annuo", 30), ("Imposta", 150)), _row(_At(410.0), (_C("earn"), 40), ("1,00", 160)), _row(_At(430.0), ("Spettanti", 100), ("Godute", 150), ("Residue", 200)),
    _row(_At(440.0), ("AC", 30), ("20,00", 100), ("15,00", 150), ("5,00", 200), ("8,00", 250), ("4,00", 300), ("4,00", 350)), _row(_At(450.0), ("AP", 30), ("1,00", 100), ("1,00", 150), ("3,00", 200)),
    _row(_At(560.0), ("Totale", 400), ("Ritenute", 430), ("Totale", 500), ("Competenze", 530)), _row(_At(572.0), (_C("deduct"), 440), (_C("earn"), 510)),
    _row(_At(594.0), ("Paese", 20), ("IT", 60), (_C("acct_check"), 90), ("CIN", 120), ("O", 150), ("ABI", 180), ("05428", 210), ("CAB", 240), ("11101", 270), ("C/C", 300), (_C("acct_number"), 330), ("NETTO", 447), ("A", 485), ("PAGARE", 495)),
    _row(_At(619.0), (_C("net"), 471), when="net"),
]
_S = [
    _text(81, "LIBRO UNICO DEL LAVORO"), _row(90, ("SOCIETA", 30), (_C("n_letters"), 90), ("SRL", 120)), _text(109, "Data Ass. Conv. Data Assunzione"), _text(113, "01/01/2015 04/07/2016"),
    _row(129, (_C("cf"), 30)), _row(196, ("Codice:", 30), (_C("code17"), 80)), _row(206, ("SAP", 30), ("Nr.:", 60), (_C("long_badge"), 100)), _row(259.7, (_C("month"), 300), (_C("year"), 360)),
    _text(302, "VOCI RETRIBUTIVE ORE/GIORNI IMPORTO UNITARIO"),
    _Body(310.0, "A", [("first", 58), ("second", 120), ("qty", 240), ("amount", 290), ("amount", None)], 536.0, 460.0),
    _row(_At(310.0), ("riga", 30), ("libera", 60), ("12,00", 460), when="orphan"),
    _row(_At(400.0), ("TRATTENUTE", 30), ("PREVIDENZIALI", 100), ("IMPONIBILI", 300), ("ALIQUOTE", 385)), _row(_At(410.0), ("/300", 30), ("x", 60)), _row(_At(420.0), ("Z300", 21), ("Contributo", 58), (_C("earn"), 310), ("9,19", 390), (_C("deduct"), 460)),
    _row(_At(449.0), ("ADDIZIONALI", 30), ("ANNO", 110), ("IMPON/RATA", 150)), _row(_At(459.0), ("B401", 30), ("Addizionale", 70), ("Regionale", 140), ("55,00", 300)), _row(_At(469.0), ("VENETO", 30)), _row(_At(479.0), ("B402", 30), ("Addizionale", 70), ("Comunale", 140), ("66,00", 300)),
    _row(_At(500.0), ("Descrizione", 30), ("Imponibile", 100), ("Fiscale", 160)), _row(_At(510.0), ("Emolumenti", 30), ("correnti", 90), (_C("earn"), 200)), _row(_At(520.0), ("Imposta", 100), ("Lorda", 140), ("Detr.", 250), ("Lav.", 280), ("Dip.", 300), ("Imposta", 400), ("Netta", 440)), _row(_At(530.0), (_C("deduct"), 105), ("11,00", 255), ("22,00", 405)),
    _row(_At(540.0), ("Accant.", 100), ("Tesoreria", 200), ("Anticipazioni", 300)), _row(_At(550.0), ("77,00", 102), ("66,00", 204), ("88,00", 305)), _row(_At(560.0), ("Retr.", 30), ("Utile", 70), ("TFR", 110)), _row(_At(570.0), (_C("earn"), 40)),
    _row(_At(588.0), ("Totale", 400), ("Trattenute", 440), ("Totale", 500), ("Competenze", 540)), _row(_At(617.0), (_C("deduct"), 468), (_C("earn"), 538)), _row(_At(633.0), (_C("acct"), 56)), _row(_At(641.0), ("NETTO", 484)), _row(_At(665.0), ("200,00", 30)), _row(_At(665.0), (_C("net"), 493), when="net"),
    _row(_At(700.0), ("Maturate", 100), ("Godute", 150), ("Residue", 200), ("AP", 240), ("Residue", 260), ("AP2", 300), ("Saldo", 340)), _row(_At(710.0), ("FERIE", 30), ("20,00", 102), ("15,00", 152), ("3,00", 205), ("2,00", 262), ("5,00", 342)),
    _row(_At(740.0), ("Imponibile", 125), ("Fiscale", 180), ("Annuo", 220)), _row(_At(750.0), (_C("earn"), 130), (_C("deduct"), 270)), _row(_At(760.0), ("Imp.", 20), ("INPS", 40), ("Progr.", 60)), _row(_At(770.0), (_C("earn"), 20), ("99,00", 70)),
]
LAYOUTS = [[x for row in rows for x in (row if isinstance(row, list) else [row])] for rows in (_Z, _C_ROWS, _S)]
#: Columns of a payslip that each layout prints.
_PRINTED = [sorted({x.text for x in rows if isinstance(x, _Piece) and isinstance(x.text, _C)}) for rows in LAYOUTS]
#: Payslips that are laid out at once.
AT_ONCE = 1000


def words(spark: SparkSession, sf_dir: str, layout_no: int | None = None) -> DataFrame:
    """doc_id, page, seq, text, x0, x1, top, bottom of all payslips, or of those of one layout: documents, word by word."""
    return documents(spark, sf_dir, layout_no).select("doc_id", F.explode("words").alias("w")).select("doc_id", "w.*")


def unprinted(spark: SparkSession, sf_dir: str, layout_no: int | None = None) -> DataFrame:
    """doc_id, k, layout, lines and texts: what each payslip, or each of one layout (0 z, 1 c, 2 s), prints. See laid_out.

    Faults by order number: divisible by 11 bad fiscal code; 13 no net; 17 a row with an amount that is no pay line;
    19 net off by 2,00; 7 a note under the last line (layout z).
    """
    lines = slip_lines(spark, sf_dir)
    d = slips(spark, sf_dir)
    if layout_no is not None:
        lines, d = lines.where(F.col("layout") == layout_no), d.where(F.col("layout") == layout_no)
    part = lambda of: F.sum(F.when(of, F.col("amount")).otherwise(0))
    per = lines.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("n", F.col("code").cast("long").alias("code"), "flag", F.col("qty").cast("double").alias("qty"), F.col("amount").cast("double").alias("amount")))).alias("lines"), part(F.col("flag") != "R").alias("e"), part(F.col("flag") == "R").alias("d"))
    k, cust = F.col("k"), F.col("cust")
    # Printing takes time and not room: tasks are as many as partitions where nothing is broadcast, not fewer by size.
    d = d.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    d = with_fiscal_code(d.join(per, "doc_id")).select(
        "doc_id", "k", "layout", "lines", "cust", "cf", iban(cust).alias("acct"), F.element_at(F.lit([m.capitalize() for m in MONTHS]), F.col("mese")).alias("month"), F.col("anno").cast("string").alias("year"),
        F.lpad(F.col("nat").cast("string"), 2, "0").alias("nat2"), italian(F.abs(F.col("e") - F.col("d")) + F.when(k % 19 == 0, 2.0).otherwise(0.0)).alias("net"), italian(F.col("e")).alias("earn"), italian(F.col("d")).alias("deduct"), italian(F.col("nat") + 50.0).alias("revaluation"),
    )
    nat2 = F.col("nat2")
    made = {
        "company": F.concat(F.lit("1000"), nat2), "n_nat": F.concat(F.lit("N"), nat2), "branch": F.concat(nat2, F.lit("/")), "code17": F.concat(F.lit("17"), nat2), "n_letters": F.concat(F.lit("N"), F.translate(nat2, "0123456789", "ABCDEFGHIJ")), "month_year": F.concat("month", "year"),
        "badge": F.lpad((cust % 10000000).cast("string"), 7, "0"), "short_badge": F.concat((cust % 10000).cast("string"), F.lit("/8")), "long_badge": F.lpad((cust % 100000000).cast("string"), 8, "0"), "acct_check": F.substring("acct", 3, 2), "acct_number": F.substring("acct", 16, 12),
    }
    names = _PRINTED[layout_no] if layout_no is not None else sorted({n for x in _PRINTED for n in x})
    return d.select("doc_id", F.col("k").cast("long").alias("k"), F.col("layout").cast("int").alias("layout"), "lines", F.struct(*[made.get(n, F.col(n)).alias(n) for n in names]).alias("texts"))


def _italian(values: pa.Array) -> pa.Array:
    """italian of many amounts at once, inside a task: to two decimals, ties to even."""
    x = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
    cents = np.rint(x * 100)
    odd = np.flatnonzero(~(np.abs(x * 100 - cents) < 1e-3) | (np.abs(x) > 1e12))  # no whole cents: by their exact value
    cents[odd] = 0
    cents = np.abs(cents).astype(np.int64)
    digits = lambda n, width: pc.utf8_lpad(pc.cast(pa.array(n), pa.string()), width, "0")
    whole, part = cents // 100, digits(cents % 100, 2)
    text = pc.cast(pa.array(whole), pa.string())
    for power in (3, 6, 9, 12):
        if (big := whole >= 10**power).any():
            groups = [digits(whole // 10**p % 1000, 3) for p in range(power - 3, -1, -3)]
            text = pc.if_else(pa.array(big), pc.binary_join_element_wise(pc.cast(pa.array(whole // 10**power), pa.string()), *groups, "."), text)
    text = pc.binary_join_element_wise(text, part, ",")
    if (minus := np.signbit(x)).any():
        text = pc.if_else(pa.array(minus), pc.binary_join_element_wise(pa.scalar("-"), text, ""), text)
    if len(odd):
        exact = [f"{Decimal(v).quantize(Decimal('0.01'), ROUND_HALF_EVEN):,}".translate(str.maketrans(",.", ".,")) for v in x[odd].tolist()]
        text = pc.replace_with_mask(text, pa.array(np.isin(np.arange(len(x)), odd)), pa.array(exact, pa.string()))
    return pc.if_else(values.is_valid(), text, pa.scalar(None, pa.string()))


def _placed(rows: list, no: np.ndarray, k: np.ndarray, lines: pa.ListArray, texts: pa.StructArray) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
    """Words of the payslips of one layout, whose numbers in their batch are no: texts, each word's index among these, and its
    payslip's number, place in it, x0 and top."""
    n, ends = len(no), lines.offsets.to_numpy().astype(np.int64)
    line, count = lines.values.slice(ends[0], ends[-1] - ends[0]), np.diff(ends)
    ends = ends - ends[0]
    owner, nth = np.repeat(np.arange(n), count), np.arange(len(line)) - np.repeat(ends[:-1], count)
    pool, begins, size = [], {}, 0

    def begin(key, array: pa.Array) -> int:
        nonlocal size
        if key not in begins:
            pool.append(array)
            begins[key] = size
            size += len(array)
        return begins[key]

    flag = line.field("flag")
    printed = {"qty": pc.cast(pc.cast(pc.trunc(line.field("qty")), pa.int32()), pa.string()), "amount": _italian(line.field("amount"))}
    of = np.where(pc.fill_null(pc.equal(flag, "R"), False).to_numpy(zero_copy_only=False), 0, np.where(pc.fill_null(pc.equal(flag, "A"), False).to_numpy(zero_copy_only=False), 1, 2))
    by_flag = {"first": [DESCRIPTION[f].split(" ")[0] for f in "RAN"], "second": [DESCRIPTION[f].split(" ")[1] for f in "RAN"], "unit": [UNIT[f] for f in "RAN"]}
    parts, upto = [], np.zeros(n, np.int64)  # of each payslip, how many words are placed
    for x in rows:
        if isinstance(x, _Body):
            digits = pc.utf8_lpad(pc.cast(line.field("code"), pa.string()), 4, "0")
            code = pc.binary_join_element_wise(pa.scalar(x.prefix), digits, "") if x.prefix else digits
            spec = [(begin("code", code) + np.arange(len(line)), 21.0)]
            for what, at in x.spec:
                index = begin(what, pa.array(by_flag[what])) + of if what in by_flag else begin(("line", what), printed[what]) + np.arange(len(line))
                spec.append((index, np.where(of == 0, x.deduct_x, x.earn_x) if at is None else float(at)))
            for j, (index, at) in enumerate(spec):
                parts.append((index, owner, upto[owner] + nth * len(spec) + j, np.broadcast_to(at, len(line)), x.base + nth * 10.0))
            upto = upto + count * len(spec)
            continue
        some = np.flatnonzero(_WHEN[x.when](k)) if x.when else np.arange(n)
        index = begin(x.text, texts.field(str(x.text))) + some if isinstance(x.text, _C) else np.full(len(some), begin(("const", x.text), pa.array([x.text])))
        parts.append((index, some, upto[some], np.full(len(some), x.x), x.top + count[some] * 10.0 if x.pushed else np.full(len(some), x.top)))
        upto[some] += 1
    index, doc, place, x0, top = (np.concatenate([p[i] for p in parts]) for i in range(5))
    return pa.concat_arrays([a.cast(pa.string()) for a in pool]), index, [no[doc], place, x0, top]


#: Fields of a word.
FIELDS = {"page": "int", "seq": "int", "text": "string", "x0": "double", "x1": "double", "top": "double", "bottom": "double"}


def laid_out(batch: pa.RecordBatch, fields: list[str] | None = None) -> pa.ListArray:
    """Words (page, seq, text, x0, x1, top, bottom, or those fields) of each of some payslips, which come as unprinted has them."""
    k, layout = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
    pools, at, parts = [], 0, []
    for number, rows in enumerate(LAYOUTS):
        no = np.flatnonzero(layout == number)
        if len(no):
            lines, texts = (batch.column(i).take(pa.array(no)) for i in (3, 4))
            pool, index, more = _placed(rows, no, k[no], lines, texts)
            pools.append(pool)
            parts.append([index + at, *more])
            at += len(pool)
    kinds = [np.int64, np.int64, np.int64, np.float64, np.float64]
    index, doc, place, x0, top = (np.concatenate([p[i] for p in parts] or [np.zeros(0)]).astype(t) for i, t in enumerate(kinds))
    upto = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))])
    order = np.empty(len(doc), np.int64)
    order[upto[doc] + place] = np.arange(len(doc))
    text = pa.concat_arrays(pools or [pa.array([], pa.string())]).take(pa.array(index[order]))
    x0, top = x0[order], top[order]
    made = {
        "page": lambda: pa.array(np.ones(len(doc), np.int32)), "seq": lambda: pa.array(place[order].astype(np.int32)), "text": lambda: text, "x0": lambda: pa.array(x0),
        "x1": lambda: pc.add(pc.add(pa.array(x0), pc.cast(pc.multiply(pc.utf8_length(text), 5), pa.float64())), 2.0), "top": lambda: pa.array(top), "bottom": lambda: pa.array(top + 10),
    }
    fields = fields or list(FIELDS)
    return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays([made[f]() for f in fields], fields))


def documents(spark: SparkSession, sf_dir: str, layout_no: int | None = None, fields: list[str] | None = None) -> DataFrame:
    """doc_id and words (page, seq, text, x0, x1, top, bottom) of all payslips, or of those of one layout (0 z, 1 c, 2 s). fields: of
    these, those that are wanted; others are not brought back from Python."""
    fields = [f for f in FIELDS if not fields or f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, AT_ONCE):
                some = b.slice(i, AT_ONCE)
                yield pa.RecordBatch.from_arrays([some.column(0), laid_out(some, fields)], ["doc_id", "words"])

    return unprinted(spark, sf_dir, layout_no).mapInArrow(run, f"doc_id string, words array<struct<{','.join(f'{f}:{FIELDS[f]}' for f in fields)}>>")
