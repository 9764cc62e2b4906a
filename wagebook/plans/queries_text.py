"""Queries of scalar functions over words of the documents, and of page reconstruction."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagebook.functions import columns as C
from wagebook.functions import ids as I
from wagebook.functions import text as X
from wagebook.operators import pages as P
from wagebook.plans import common as K
from wagebook.plans.common import WITH, cf_letter, edge, mod97, table

QUERIES: dict[str, tuple] = {}


def add(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = (lambda s, d: edge(fn(s, d)), sql)
        return fn

    return put


def tokens(s, d):
    return table(s, d, "documents").select("doc_id", F.posexplode(F.split("text", r"\s+")).alias("i", "w"))


TOK = r"WITH w AS (SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS w FROM documents) "
CORE = r"replace(replace(regexp_replace({0}, '^\s*[({{]?\s*|\s*\)?\s*$', '', 'g'), '.', ''), ',', '.')"
AMOUNT = lambda w: rf"CASE WHEN regexp_matches({CORE.format(w)}, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN TRY_CAST({CORE.format(w)} AS DECIMAL(14, 5)) * CASE WHEN regexp_matches({w}, '^\s*[({{]|\)\s*$') THEN -1 ELSE 1 END END"
NORM = lambda t: f"replace(lower(regexp_replace({t}, '[^A-Za-z0-9]', '', 'g')), 's', '')"
DATA = lambda w: f"({w} IN ('GG', 'ORE', '%', '(', ')', '{{', '}}') OR ({AMOUNT(w)}) IS NOT NULL)"


@add("b1_normalize_label", TOK + f"SELECT {NORM('w')} AS label, count(*) AS n FROM w GROUP BY 1")
def b1(s, d):
    return tokens(s, d).groupBy(X.normalize_label(F.col("w")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@add("b2_parse_amount", TOK + f"SELECT doc_id, w AS token, CAST({AMOUNT('w')} AS DOUBLE) AS amount FROM w WHERE ({AMOUNT('w')}) IS NOT NULL")
def b2(s, d):
    w = tokens(s, d).where(F.col("w").rlike("[0-9]"))  # no amount is without a digit
    return w.select("doc_id", F.col("w").alias("token"), X.parse_amount(F.col("w")).alias("amount")).where("amount is not null")


@add("b3_find_amounts", r"""SELECT doc_id, CAST(len(f) AS BIGINT) AS n, array_to_string(f, ' ') AS found
  FROM (SELECT doc_id, regexp_extract_all(text, '-?[0-9]{1,3}([.][0-9]{3})*,[0-9]+|-?[0-9]+,[0-9]+|-?[0-9]+') AS f FROM documents)""")
def b3(s, d):
    a = X.find_amounts(F.col("text"))
    return table(s, d, "documents").select("doc_id", F.size(a).alias("n"), F.array_join(a, " ").alias("found"))


@add("b4_month_year", f"SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 10 <> 0 THEN month(o_orderdate) END AS BIGINT) AS mese, CAST(CASE WHEN o_orderkey % 10 <> 0 THEN year(o_orderdate) END AS BIGINT) AS anno FROM orders")
def b4(s, d):
    names = "Gennaio Febbraio Marzo Aprile Maggio Giugno Luglio Agosto Settembre Ottobre Novembre Dicembre".split()
    month = F.element_at(F.lit(names), F.month("o_orderdate"))
    name = F.when(F.col("o_orderkey") % 10 == 0, F.concat(month, F.lit("ne"))).otherwise(month)
    my = X.parse_italian_month_year(F.concat(F.lit("Busta "), F.lit("2: "), name, F.lit(" "), F.year("o_orderdate"), F.lit(" AGG.")))
    return table(s, d, "orders").select("o_orderkey", my["mese"].alias("mese"), my["anno"].alias("anno"))


@add("b5_dates", """SELECT o_orderkey, CASE WHEN day(o_orderdate) <= 28 OR o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS found,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS whole FROM orders""")
def b5(s, d):
    o = table(s, d, "orders")
    bad = (F.col("o_orderkey") % 5 == 0) & (F.day("o_orderdate") > 28)
    dash = F.when(bad, F.concat(F.lit("31-02-"), F.year("o_orderdate"))).otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    slash = F.concat(F.date_format("o_orderdate", "d/M/yyyy"), F.when(F.col("o_orderkey") % 2 == 0, "").otherwise(" x"))
    return o.select("o_orderkey", X.parse_date(F.concat(F.lit("Emesso il "), dash, F.lit(" a"))).alias("found"), X.parse_date(slash, "/").alias("whole"))


@add("b6_looks_like_data", TOK + f"SELECT doc_id, CAST(count(*) FILTER (WHERE {DATA('w')}) AS BIGINT) AS n_data, count(*) AS n FROM w GROUP BY doc_id")
def b6(s, d):
    return tokens(s, d).groupBy("doc_id").agg(F.count_if(X.looks_like_data(F.col("w"))).alias("n_data"), F.count(F.lit(1)).alias("n"))


@add("b7_rows_with_amount", rf"""WITH r AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS r FROM documents),
q AS (SELECT doc_id, len(list_filter(string_split_regex(trim(r), '\s+'), lambda w: ({AMOUNT('w')}) IS NOT NULL)) > 0 AS has FROM r)
SELECT doc_id, count(*) AS n_rows, CAST(count(*) FILTER (WHERE has) AS BIGINT) AS n_with FROM q GROUP BY doc_id""")
def b7(s, d):
    r = table(s, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("r"))
    return r.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(X.has_amount(F.col("r"))).alias("n_with"))


def order_words(s, d):
    """Label and amount words made of a line item, as a row of words."""
    a = K.render.italian(F.col("l_extendedprice"))
    mark = lambda *t: F.array(*[F.struct((F.lit(x) if isinstance(x, str) else x).alias("text"), F.lit(30.0 + 60 * i).alias("x0"), F.lit(50.0 + 60 * i).alias("x1"), F.lit(100.0).alias("top"), F.lit(110.0).alias("bottom")) for i, x in enumerate(t)])
    li = table(s, d, "lineitem")
    qty = K.render.italian(F.col("l_quantity"))
    odd = F.col("l_linenumber") % 2 == 1
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag", F.when(odd, mark(qty, "(", "TOTALE", "COMPETENZE", "(", a)).otherwise(mark("nulla", qty, "TOTALE", a)).alias("w"))


@add("b8_first_amount", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity AS amount FROM lineitem")
def b8(s, d):
    return order_words(s, d).select("l_orderkey", "l_linenumber", X.first_amount(X.enriched(F.col("w"))).alias("amount"))


@add("b9_amount_after_label", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CASE WHEN l_linenumber % 2 = 1 THEN l_extendedprice ELSE l_quantity END AS amount FROM lineitem")
def b9(s, d):
    w = order_words(s, d).withColumn("w", X.enriched(F.col("w")))
    return w.select("l_orderkey", "l_linenumber", X.amount_after_label(F.col("w"), X.label("TOTALE COMPETENZE")).alias("amount"))


F15 = "'RSSMRA' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || 'A' || lpad(CAST(c_custkey // 100 AS VARCHAR), 2, '0') || 'H501'"


@add("b10_fiscal_code", f"""WITH f AS (SELECT c_custkey, {F15} AS f FROM customer), g AS (SELECT *, {cf_letter('f')} AS letter FROM f)
SELECT c_custkey, f || CASE WHEN c_custkey % 11 = 0 THEN translate(letter, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'BCDEFGHIJKLMNOPQRSTUVWXYZA') ELSE letter END AS cf, true AS format_ok, c_custkey % 11 <> 0 AS check_ok FROM g""")
def b10(s, d):
    c = K.render.with_fiscal_code(table(s, d, "customer"), "c_custkey", "c_custkey")
    return c.select("c_custkey", "cf", I.cf_format(F.col("cf")).alias("format_ok"), I.cf_checksum_valid(F.col("cf")).alias("check_ok"))


IB = "'IT' || lpad(CAST(c_custkey % 97 AS VARCHAR), 2, '0') || 'O0542811101' || lpad(CAST(c_custkey AS VARCHAR), 12, '0')"


@add("b11_iban", f"SELECT c_custkey, {IB} AS iban, true AS format_ok, {mod97(IB)} = 1 AS check_ok FROM customer")
def b11(s, d):
    c = table(s, d, "customer").select("c_custkey", K.render.iban(F.col("c_custkey")).alias("iban"))
    return c.select("c_custkey", "iban", I.iban_format(F.col("iban")).alias("format_ok"), I.iban_mod97_valid(F.col("iban")).alias("check_ok"))


ZERO = IB.replace("'O0542811101'", "'00542811101'")


@add("b12_recover_iban", f"SELECT c_custkey, CASE WHEN {mod97(IB)} = 1 THEN {IB} ELSE {ZERO} END AS iban, {mod97(IB)} = 1 AS repaired FROM customer")
def b12(s, d):
    r = I.recover_iban(F.overlay(K.render.iban(F.col("c_custkey")), F.lit("0"), F.lit(5), F.lit(1)))
    return table(s, d, "customer").select("c_custkey", r["iban"].alias("iban"), r["repaired"].alias("repaired"))


@add("b13_recover_code", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'ZP' WHEN 1 THEN 'F' WHEN 2 THEN '' ELSE 'xx' END || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') AS code,
  CASE p_partkey % 4 WHEN 0 THEN 'font_digit_lettera' WHEN 1 THEN 'prefisso_spurio' END AS reason FROM part""")
def b13(s, d):
    n = F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0")
    pre = F.element_at(F.array(F.lit("2P"), F.lit("\\F"), F.lit(""), F.lit("xx")), (F.col("p_partkey") % 4 + 1).cast("int"))
    r = I.recover_code(F.concat(pre, n))
    return table(s, d, "part").select("p_partkey", r["code"].alias("code"), r["reason"].alias("reason"))


@add("b14_suspect_code", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, max(l_partkey % 7 = 0) OVER (PARTITION BY l_orderkey) AND l_partkey % 3 = 0 AS suspect FROM lineitem""")
def b14(s, d):
    from pyspark.sql.window import Window

    flag = F.max(F.col("l_partkey") % 7 == 0).over(Window.partitionBy("l_orderkey"))
    code = F.concat(F.when(F.col("l_partkey") % 3 == 0, "2").otherwise("3"), F.lpad((F.col("l_partkey") % 100000).cast("string"), 5, "0"))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", I.suspect_code(code, flag).alias("suspect"))


@add("b15_leading_code", "SELECT p_partkey, CASE WHEN p_partkey % 5 < 3 THEN CAST(p_partkey % 5 AS BIGINT) END AS at FROM part")
def b15(s, d):
    code = F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0")
    w = F.concat(F.array_repeat(F.lit("*x"), (F.col("p_partkey") % 5).cast("int")), F.array(code))
    return table(s, d, "part").select("p_partkey", I.leading_code_index(F.transform(w, lambda t: F.struct(t.alias("text")))).alias("at"))


#: What is looked for in b16, with the category that must come out, written out apart from the operator's own table.
CATEGORY_OF = {
    "f.do sostegno": "contributo", "contributo ivs": "contributo", "contributo previp": "contributo", "ctr.prev": "contributo", "ferie godute": "assenza", "perm.": "assenza", "permesso": "assenza",
    "ticket elettronico": "benefit", "polizza rsmo": "benefit", "vendita azioni": "benefit", "stock options": "benefit", "cassa inf": "benefit", "spese carta di credito": "rimborso",
    "retribuzione ordinaria": "retribuzione", "anticipo retribuzione": "retribuzione", "anticipo festivit": "retribuzione", "mensilita": "retribuzione", "malattia": "retribuzione",
    "assenza assunti": "retribuzione", "premio": "retribuzione", "arrotond": "retribuzione", "x": "altro",
}


@add("b16_classify", f"""WITH p AS (SELECT p_partkey, [{', '.join(repr(v) for v in CATEGORY_OF.values())}][1 + p_partkey % {len(CATEGORY_OF)}] AS c, p_partkey // {len(CATEGORY_OF)} % 2 = 1 AS twice FROM part)
SELECT p_partkey, CASE WHEN twice AND c IN ('retribuzione', 'altro', 'rimborso', 'benefit') THEN 'assenza' ELSE c END AS categoria FROM p""")
def b16(s, d):
    """Every other description has a second keyword, of absences; the first category in order wins."""
    n = len(CATEGORY_OF)
    key = F.get(F.lit(list(CATEGORY_OF)), (F.col("p_partkey") % n).cast("int"))
    twice = F.when((F.col("p_partkey") / n).cast("long") % 2 == 1, "Permesso").otherwise("voce")
    return table(s, d, "part").select("p_partkey", C.classify(F.concat_ws(" ", "p_size", twice, F.upper(key))).alias("categoria"))


@add("b17_column_of", """WITH p AS (SELECT p_partkey, (p_partkey * 37 % 6000) / 10.0 AS x FROM part) SELECT p_partkey,
  CASE WHEN x >= 445 THEN 'importo' WHEN x >= 345 THEN 'riferimento' WHEN x >= 200 THEN 'importo_base' ELSE 'descrizione' END AS z,
  CASE WHEN x >= 420 THEN 'importo' WHEN x >= 345 THEN 'dato_base' ELSE 'ore_gg' END AS c,
  CASE WHEN x >= 520 THEN 'competenza' WHEN x >= 455 THEN 'trattenuta' WHEN x >= 365 THEN 'importi_figurati' WHEN x >= 280 THEN 'importo_base' WHEN x >= 230 THEN 'ore_giorni' END AS s1,
  CASE WHEN x >= 520 THEN 'competenza' WHEN x >= 455 THEN 'trattenuta' WHEN x >= 385 THEN 'aliquota' WHEN x >= 300 THEN 'importo_base' END AS s2,
  CASE WHEN x >= 478 THEN 'imposta_pagata_annua' WHEN x >= 374 THEN 'imposta_dovuta_annua' WHEN x >= 259 THEN 'imposta_lorda_annua' WHEN x >= 121 THEN 'imponibile_fiscale_annuo' ELSE 'retribuzione_utile_tfr_annua' END AS s_tax,
  CASE WHEN x >= 236 THEN 'cong_debito_annuo' WHEN x >= 182 THEN 'cong_credito_annuo' WHEN x >= 121 THEN 'ctr_dip_inps_progr_annuo' WHEN x >= 57 THEN 'ctr_inps_progr_annuo' ELSE 'imp_inps_progr_annuo' END AS s_inps FROM p""")
def b17(s, d):
    x = (F.col("p_partkey") * 37 % 6000) / 10.0
    return table(s, d, "part").select("p_partkey", *[C.column_of(x, z).alias(z) for z in C.ZONES])


@add("b18_split_amount", """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CASE WHEN l_linenumber % 2 = 1 OR l_returnflag = 'R' THEN l_extendedprice END AS trattenuta,
  CASE WHEN NOT (l_linenumber % 2 = 1 OR l_returnflag = 'R') THEN l_extendedprice END AS competenza FROM lineitem""")
def b18(s, d):
    a = K.render.italian(F.col("l_extendedprice"))
    x = F.when(F.col("l_returnflag") == "R", 460.0).otherwise(520.0)
    word = F.struct(F.when(F.col("l_linenumber") % 4 == 1, F.concat(a, F.lit(")"))).otherwise(a).alias("text"), x.alias("x0"), x.alias("x1"), F.lit(1.0).alias("top"), F.lit(2.0).alias("bottom"))
    mark = F.struct(F.lit("{").alias("text"), F.lit(450.0).alias("x0"), F.lit(451.0).alias("x1"), F.lit(1.0).alias("top"), F.lit(2.0).alias("bottom"))
    w = F.when(F.col("l_linenumber") % 4 == 3, F.array(mark, word)).otherwise(F.array(word))
    r = C.split_amount_zone(X.enriched(w), C.EARNINGS_FROM["z"])
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", r["trattenuta"].alias("trattenuta"), r["competenza"].alias("competenza"))


@add("b19_repair_split_amounts", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(CASE WHEN l_linenumber % 2 = 1 THEN 2 ELSE 3 END AS BIGINT) AS n_words, CASE WHEN l_linenumber % 2 = 1 THEN l_extendedprice ELSE 7.0 END AS last_amount FROM lineitem")
def b19(s, d):
    a = K.render.italian(F.col("l_extendedprice"))
    word = lambda t, x: F.struct(t.alias("text"), F.lit(float(x)).alias("x0"), F.lit(x + 9.0).alias("x1"), F.lit(1.0).alias("top"), F.lit(2.0).alias("bottom"))
    cut = F.array(word(F.lit("1,00"), 1), word(F.substring(a, F.lit(1), F.length(a) - 1), 20), word(F.substring(a, -1, 1), 40))
    whole = F.array(word(F.lit("1,00"), 1), word(a, 20), word(F.lit("7"), 40))
    w = X.enriched(C.repair_split_amounts(F.when(F.col("l_linenumber") % 2 == 1, cut).otherwise(whole)))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.size(w).alias("n_words"), F.element_at(w, -1)["amt"].alias("last_amount"))


@add("b20_find_iban", f"SELECT c_custkey, CASE WHEN c_custkey % 6 <> 5 THEN {IB} END AS iban FROM customer")
def b20(s, d):
    acct = K.render.iban(F.col("c_custkey"))
    parts = [F.substring(acct, 3, 2), F.substring(acct, 5, 1), F.substring(acct, 6, 5), F.substring(acct, 11, 5), F.substring(acct, 16, 12)]
    names = ["Eur", "CIN", "ABI", "CAB", "C/C"]
    words = F.array(*[x for n, p in zip(names, parts) for x in (F.lit(n), p)])
    bare = F.array(*parts)
    k = F.col("c_custkey") % 6
    w = F.when(k < 3, words).when(k < 5, bare).otherwise(F.slice(bare, 1, 4))
    return table(s, d, "customer").select("c_custkey", C.find_iban(F.transform(w, lambda t: F.struct(t.alias("text")))).alias("iban"))


# Pages


def char_pages(s, d):
    """Characters of short pages made of customers: name letters, on every fourth page all drawn at their word's x0."""
    c = table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"), F.lit(1).alias("page"), "c_custkey", F.concat(F.lit("AB"), "c_name").alias("t"))
    ch = c.select("doc_id", "page", "c_custkey", F.posexplode(F.split("t", "")).alias("seq", "text")).where("text <> ''")
    x = F.when(F.col("c_custkey") % 4 == 0, F.when(F.col("seq") < 2, 10.0).otherwise(100.0)).otherwise(F.when(F.col("seq") < 2, 10.0 + F.col("seq") * 6).otherwise(100.0 + F.col("seq") * 6))
    return ch.select("doc_id", "page", "seq", "text", x.alias("x0"), (x + 5).alias("x1"), F.lit(50.0).alias("top"), F.lit(60.0).alias("bottom"))


def word_pages(s, d):
    """Words of the same pages, as they would be extracted: the side bar, then both halves of the name."""
    halves = F.split("c_name", "#")
    item = lambda k, t, x: F.struct(F.lit(k).alias("seq"), t.alias("text"), F.lit(x).alias("x0"), F.lit(x + 11.0).alias("x1"), F.lit(50.0).alias("top"), F.lit(60.0).alias("bottom"))
    words = F.array(item(0, F.lit("AB"), 10.0), item(1, halves[0], 112.0), item(2, halves[1], 166.0))
    return table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.explode(words).alias("w")).select("doc_id", "page", "w.*")


NAMES = "SELECT CAST(c_custkey AS VARCHAR) AS doc_id, c_custkey, 'AB' || c_name AS t FROM customer"


@add("c1_drop_sidebar", "SELECT CAST(c_custkey AS VARCHAR) AS doc_id, CAST(length(c_name) AS BIGINT) AS n FROM customer")
def c1(s, d):
    return P.drop_sidebar(char_pages(s, d)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@add("c2_scrambled_pages", f"""WITH c AS ({NAMES}), p AS (SELECT doc_id, c_custkey, length(t) AS n, len(list_filter(range(2, length(t) + 1), lambda i: i <> 3 AND substr(t, i, 1) <> substr(t, i - 1, 1))) AS differ FROM c)
SELECT doc_id, 1::BIGINT AS page, c_custkey % 4 = 0 AND differ / (n - 1) > 0.2 AS scrambled FROM p""")
def c2(s, d):
    return P.scrambled_pages(char_pages(s, d))


@add("c3_reconstruct_words", f"WITH c AS ({NAMES}) SELECT doc_id, 1::BIGINT AS page, substr(t, 3) AS text, 100.0::DOUBLE AS x0 FROM c WHERE c_custkey % 4 = 0 UNION ALL SELECT doc_id, 1::BIGINT, 'AB', 10.0::DOUBLE FROM c WHERE c_custkey % 4 = 0")
def c3(s, d):
    return P.reconstruct_words(char_pages(s, d).where(F.col("doc_id").cast("long") % 4 == 0)).select("doc_id", "page", "text", "x0")


@add("c4_cluster_rows", WITH + """SELECT doc_id, CAST(n_lines + CASE layout WHEN 0 THEN 24 + CAST(k % 7 = 0 AS INTEGER) + CAST(net IS NOT NULL AS INTEGER)
  WHEN 1 THEN 25 + CAST(k % 17 = 0 AS INTEGER) + CAST(net IS NOT NULL AS INTEGER) ELSE 35 + CAST(k % 17 = 0 AS INTEGER) END AS BIGINT) AS n_rows FROM d""")
def c4(s, d):
    return K.rows(s, d, None, ["page", "row_idx"]).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows"))


@add("c5_page_words", f"""WITH c AS ({NAMES}) SELECT doc_id, CAST(count(*) AS BIGINT) AS n_words, bool_or(bad) AS recovered FROM (
  SELECT doc_id, c_custkey % 4 = 0 AS bad, unnest(CASE WHEN c_custkey % 4 = 0 THEN ['w'] ELSE ['w', 'x'] END) FROM c) GROUP BY doc_id""")
def c5(s, d):
    return P.page_words(word_pages(s, d), char_pages(s, d)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"), F.bool_or("recovered").alias("recovered"))


@add("c6_page_text", f"WITH c AS ({NAMES}) SELECT doc_id, 1::BIGINT AS page, CASE WHEN c_custkey % 4 = 0 THEN substr(t, 3) ELSE replace(substr(t, 3), '#', ' ') END AS full_text FROM c")
def c6(s, d):
    """Of all pages: scrambled ones are rebuilt, so their name is one word."""
    return P.page_text(P.cluster_rows(P.page_words(word_pages(s, d), char_pages(s, d))))


@add("c7_classify_text_layer", "SELECT source AS doc_id, CASE WHEN sum(length(coalesce(text, ''))) / count(*) >= 3000 THEN 'textual' ELSE 'scanned' END AS kind FROM documents GROUP BY 1")
def c7(s, d):
    pages = table(s, d, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("page"), "text")
    return P.classify_text_layer(pages, 3000)


@add("c8_number_rows", WITH + "SELECT CAST(n AS BIGINT) AS n_lines, count(*) AS documents FROM (SELECT doc_id, count(DISTINCT n) AS n FROM l GROUP BY doc_id) GROUP BY 1")
def c8(s, d):
    w = K.render.slip_lines(s, d).select("doc_id", F.lit(1).alias("page"), F.col("n").alias("seq"), F.col("flag").alias("text"), F.lit(30.0).alias("x0"), F.lit(40.0).alias("x1"), (F.col("n") * 10.0).alias("top"), (F.col("n") * 10.0 + 5).alias("bottom"))
    return P.number_rows(P.cluster_rows(w)).groupBy("doc_id").agg(F.max("doc_row").alias("n_lines")).groupBy("n_lines").agg(F.count(F.lit(1)).alias("documents"))
