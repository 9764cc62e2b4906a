"""Queries of quality rules, the relational model, reports and bundles."""

from __future__ import annotations

import uuid
from dataclasses import fields
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagebook import schemas
from wagebook.operators import quality as Q
from wagebook.operators import reports as R
from wagebook.operators import store as S
from wagebook.plans import common as K
from wagebook.plans import jobs, process, queries_documents
from wagebook.plans.common import WITH, edge, mod97, table
from wagebook.sources import bundle as B
from wagebook.sources.files import new_folder, stored
from wagebook.sources.landing import Landing
from wagebook.sources.registry import Registry
from wagebook.sources.tables import DEPENDENT, Tables

QUERIES: dict[str, tuple] = {}


def add(name: str, sql: str | None = None, head: str = WITH):
    def put(fn):
        QUERIES[name] = (lambda s, d: edge(fn(s, d)), head + sql if sql else None)
        return fn

    return put


def slips(s, d):
    """Payslip facts as parsing gives them, made from the tables and stored: input of rules and reports."""
    x = K.render.slip_lines(s, d).groupBy("doc_id").agg(F.sum(F.when(F.col("flag") != "R", F.col("amount")).otherwise(0)).cast("decimal(14,5)").alias("e"), F.sum(F.when(F.col("flag") == "R", F.col("amount")).otherwise(0)).cast("decimal(14,5)").alias("t"), F.count(F.lit(1)).alias("n_lines"))
    x = K.render.with_fiscal_code(K.render.slips(s, d).join(x, "doc_id"))
    k = F.col("k")
    cf = F.col("cf")
    net = F.when(k % 13 != 0, (F.abs(F.col("e") - F.col("t")) + F.when(k % 19 == 0, F.lit("2").cast("decimal(14,5)")).otherwise(F.lit("0").cast("decimal(14,5)"))).cast("decimal(14,5)"))
    return stored(x.select(
        "doc_id", "k", "n_lines", "cust", "nat", F.element_at(F.array(F.lit("z"), F.lit("c"), F.lit("s")), (F.col("layout") + 1).cast("int")).alias("template"), F.lit("1.0.0").alias("parser_version"),
        F.when(k % 11 == 0, "").otherwise(cf).alias("codice_fiscale"), cf.alias("cf_original"), (k % 11 == 0).alias("cf_invalid"), F.when(k % 23 == 0, "").otherwise(F.concat(F.lit("N"), "nat")).alias("ragione_sociale"),
        F.lit(None).cast("string").alias("codice_azienda"), F.when(k % 29 == 0, 0).otherwise(F.col("mese")).cast("int").alias("mese"), F.col("anno").cast("int").alias("anno"), F.lit("ordinario").alias("tipo"), F.lit("").alias("label"),
        F.lit("31-11-2020").alias("hire_text"), F.when(k % 5 != 0, F.lit("2020-03-15").cast("date")).alias("hire_date"), (k % 31 == 0).alias("recovered"), F.col("e").alias("totale_competenze"), F.col("t").alias("totale_trattenute"), net.alias("netto_mese"),
        F.when(k % 37 != 0, K.render.iban(F.col("cust"))).alias("iban"), K.render.iban(F.col("cust")).alias("iban_original"), (k % 41 == 0).alias("repaired"), F.concat(F.lit("Rossi "), "cust").alias("cognome_nome"),
        F.sha2(F.col("doc_id").cast("binary"), 256).alias("sha256"), F.concat("doc_id", F.lit(".pdf")).alias("filename"), F.lit("2024-01-01").cast("timestamp").alias("run_ts"),
    ))


D3 = "['z', 'c', 's'][layout + 1]"


def an(no, tipo, sev, msg, campo, where, extra=""):
    return f"SELECT doc_id, {no}::BIGINT AS rule_no, '{tipo}' AS tipo, '{sev}' AS severita, {msg} AS messaggio, {campo} AS campo FROM d WHERE {where}{extra}"


@add("q1_rule_header", " UNION ALL ".join([an(1, "codice_fiscale_non_valido", "error", "'Codice fiscale con carattere di controllo errato: ''' || cf_printed || ''''", "'codice_fiscale'", "k % 11 = 0"), an(3, "header_incompleto", "error", "'Ragione sociale non trovata'", "'ragione_sociale'", "k % 23 = 0")]))
def q1(s, d):
    return Q.rule_header(slips(s, d))


@add("q2_rule_period", " UNION ALL ".join([an(4, "periodo_non_riconosciuto", "warning", "'Periodo non riconosciuto'", "'periodo'", "k % 29 = 0"), an(5, "data_non_valida", "warning", "'Data di assunzione impossibile: ''31-11-2020'''", "'data_assunzione'", "layout = 0 AND k % 5 = 0")]))
def q2(s, d):
    return Q.rule_period(slips(s, d))


@add("q3_rule_unmapped", an(6, "righe_non_mappate", "info", "CASE WHEN k % 34 = 0 THEN '2' ELSE '1' END || ' righe con importo non mappate su 2'", "'pay_lines'", "k % 17 = 0"))
def q3(s, d):
    x = slips(s, d).withColumn("t", F.explode(F.array(F.lit("riga 12,00"), F.when(F.col("k") % 2 == 0, "altra 5").otherwise("testo")))).where("k % 17 = 0")
    from wagebook.operators.documents import unmapped_rows

    return Q.rule_unmapped(unmapped_rows(x.select("doc_id", F.monotonically_increasing_id().alias("doc_row"), F.col("t").alias("text"))))


CODED = """, c AS (SELECT doc_id, k, n, row_number() OVER (PARTITION BY doc_id ORDER BY n, l.code, qty, amount) AS r, lpad(CAST(l.code AS VARCHAR), 4, '0') AS c4, l.code AS code FROM l),
v AS (SELECT *, CASE WHEN code % 50 = 0 THEN '2P' || c4 WHEN code % 50 = 1 THEN '\\F' || c4 ELSE '2' || c4 END AS raw, CASE WHEN code % 50 = 0 THEN 'ZP' || c4 WHEN code % 50 = 1 THEN 'F' || c4 ELSE '2' || c4 END AS cod FROM c)
SELECT doc_id, 7::BIGINT AS rule_no, 'codice_causale_corretto_automaticamente' AS tipo, 'warning' AS severita, 'Codici corretti: ' || string_agg('''' || raw || ''' -> ''' || cod || '''', ', ' ORDER BY r) AS messaggio, 'codice_causale' AS campo FROM v WHERE code % 50 < 2 GROUP BY doc_id
UNION ALL SELECT doc_id, 8, 'codice_causale_sospetto', 'warning', 'Codici sospetti: ' || string_agg('''' || cod || '''', ', ' ORDER BY r) FILTER (WHERE code % 50 > 1), 'codice_causale' FROM v GROUP BY doc_id HAVING bool_or(code % 50 = 0) AND bool_or(code % 50 > 1)"""


@add("q4_rule_codes", CODED)
def q4(s, d):
    from pyspark.sql.window import Window

    from wagebook.functions import ids as I

    c4 = F.lpad(F.col("code").cast("string"), 4, "0")
    m = F.col("code") % 50
    raw = F.concat(F.when(m == 0, "2P").when(m == 1, "\\F").otherwise("2"), c4)
    r = F.row_number().over(Window.partitionBy("doc_id").orderBy("n", "code", "qty", "amount"))
    x = K.render.slip_lines(s, d).select("doc_id", r.alias("doc_row"), raw.alias("raw_code")).withColumn("c", I.recover_code(F.col("raw_code")))
    return Q.rule_codes(x.select("doc_id", "doc_row", "raw_code", F.col("c.code").alias("codice"), F.col("c.reason").alias("correction")))


@add("q5_rule_iban", an(9, "iban_corretto_automaticamente", "warning", "'IBAN corretto: ''' || iban || ''' -> ''' || iban || ''''", "'iban'", "k % 41 = 0 AND k % 37 <> 0") + " UNION ALL " + an(9, "iban_corretto_automaticamente", "warning", "NULL", "'iban'", "k % 41 = 0 AND k % 37 = 0") + " UNION ALL " + an(9, "iban_non_valido", "warning", "'IBAN con checksum errato: ''' || iban || ''''", "'iban'", f"layout > 0 AND k % 37 <> 0 AND {mod97('iban')} <> 1"))
def q5(s, d):
    return Q.rule_iban(slips(s, d))


@add("q6_rule_reconstructed", an(10, "testo_ricostruito", "warning", "'Testo ricostruito dai caratteri'", "'raw_extraction'", "k % 31 = 0 AND layout > 0"))
def q6(s, d):
    return Q.rule_reconstructed(slips(s, d))


MISS = "concat_ws(', ', CASE WHEN net IS NULL THEN 'netto_mese' END, CASE WHEN k % 37 = 0 THEN 'iban' END)"


@add("q7_rule_missing_totals", an(11, "totali_mancanti", "error", f"'Totali mancanti: ' || {MISS}", MISS, "net IS NULL OR k % 37 = 0"))
def q7(s, d):
    return Q.rule_missing_totals(slips(s, d))


@add("q8_rule_format", an(13, "formato_non_valido", "warning", "'IBAN con formato non valido: ''' || replace(iban, 'IT', 'FR') || ''''", "'iban'", "k % 43 = 0 AND k % 37 <> 0") + " UNION ALL " + an(12, "formato_non_valido", "warning", "'Codice fiscale con formato non valido: ''' || lower(cf) || ''''", "'codice_fiscale'", "k % 47 = 0 AND cf <> ''"))
def q8(s, d):
    x = slips(s, d)
    x = x.withColumn("iban", F.when(F.col("k") % 43 == 0, F.replace("iban", F.lit("IT"), F.lit("FR"))).otherwise(F.col("iban")))
    x = x.withColumn("codice_fiscale", F.when(F.col("k") % 47 == 0, F.lower("codice_fiscale")).otherwise(F.col("codice_fiscale")))
    return Q.rule_format(x, x)


@add("q9_rule_no_lines", "SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, 14::BIGINT AS rule_no, 'nessuna_riga_voce' AS tipo, 'warning' AS severita, 'Nessuna riga voce' AS messaggio, 'pay_lines' AS campo FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)", "")
def q9(s, d):
    docs = table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"))
    return Q.rule_no_lines(docs, K.render.slip_lines(s, d))


NET2 = lambda x: f"CAST(CAST({x} AS DECIMAL(14, 2)) AS VARCHAR)"


@add("q10_rule_net", an(15, "quadratura_netto", "warning", f"'Netto atteso ' || {NET2('earn - deduct')} || ', trovato ' || {NET2('net')}", "'netto_mese'", "net IS NOT NULL AND abs(round(earn - deduct, 2) - net) > 1.5"))
def q10(s, d):
    return Q.rule_net(slips(s, d))


def faults(more: str = "") -> str:
    """Anomalies of the payslips that render.py prints, by fault; more: further ones, as UNION ALL of (doc_id, tipo, severita)."""
    return f""", a AS MATERIALIZED (SELECT doc_id, 'codice_fiscale_non_valido' AS tipo, 'error' AS severita FROM d WHERE k % 11 = 0
  UNION ALL SELECT doc_id, 'totali_mancanti', 'error' FROM d WHERE net IS NULL
  UNION ALL SELECT doc_id, 'righe_non_mappate', 'info' FROM d WHERE k % 17 = 0 AND layout > 0
  UNION ALL SELECT doc_id, 'quadratura_netto', 'warning' FROM d WHERE net IS NOT NULL AND abs(round(earn - deduct, 2) - net) > 1.5
  UNION ALL SELECT doc_id, 'iban_non_valido', 'warning' FROM d WHERE layout > 0 AND {mod97('iban')} <> 1 {more}),
st AS MATERIALIZED (SELECT d.*, CASE WHEN bool_or(severita = 'error') THEN 'NEEDS_REVIEW' WHEN count(severita) > 0 THEN 'PROCESSED_WITH_ANOMALIES' ELSE 'PROCESSED' END AS status, count(severita) AS n_anomalies
  FROM d LEFT JOIN a USING (doc_id) GROUP BY ALL)
"""


FAULTS = faults()


def parsed(s, d):
    return process.parse_words(K.documents(s, d), lies=True)


@add("q11_all_anomalies", FAULTS + "SELECT doc_id, tipo, severita FROM a")
def q11(s, d):
    return process.anomalies(parsed(s, d)).select("doc_id", "tipo", "severita")


@add("q12_determine_status", FAULTS + "SELECT doc_id, status, CAST(n_anomalies AS BIGINT) AS anomalies FROM st")
def q12(s, d):
    p = parsed(s, d)
    return Q.determine_status(p.docs, process.anomalies(p))


@add("process_documents", FAULTS + f"""SELECT doc_id, {D3} AS template, CAST(mese AS BIGINT) AS mese, CAST(anno AS BIGINT) AS anno, cf AS codice_fiscale, CAST(n_lines + CASE WHEN layout > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_lines, net AS netto_mese, status FROM st""")
def process_documents(s, d):
    p = parsed(s, d)
    st = Q.determine_status(p.docs, process.anomalies(p))
    n = p.lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))
    return p.docs.join(st, "doc_id").join(n, "doc_id", "left").join(p.totals.select("doc_id", "netto_mese"), "doc_id", "left").select("doc_id", "template", "mese", "anno", "codice_fiscale", "n_lines", "netto_mese", "status")


#: The tables of the model in long form: table, key, field and a number or a text; null fields have no row.
LONG = 'SELECT {0} AS "table", {1} AS key, {2} AS field, {3} AS num, {4} AS txt'


def _long(table_name: str, *names: str, skip: tuple = (), extra: str = "", field: str = "name") -> list[str]:
    """SQL of the number fields that queries of single blocks have, for the documents that are stored."""
    out = []
    for n in names:
        drop = ", ".join(("doc_id", *skip))
        keep = f", {extra}" if extra else ""
        wide = f"SELECT b.* FROM ({BLOCKS[n]}) b JOIN g USING (doc_id) WHERE stored"
        out.append(f"SELECT '{table_name}' AS \"table\", doc_id AS key, {field} AS field, value AS num, NULL AS txt FROM (UNPIVOT (SELECT doc_id{keep}, * EXCLUDE ({drop}) FROM ({wide})) ON COLUMNS(* EXCLUDE (doc_id{keep})) INTO NAME name VALUE value)")
    return out


BLOCKS = queries_documents.BARE
NAMES = "CASE layout WHEN 0 THEN 'SOCIETA N' || {0} || ' SPA' WHEN 1 THEN 'SOCIETA N' || {0} || ' SRL' ELSE 'SOCIETA N' || translate({0}, '0123456789', 'ABCDEFGHIJ') || ' SRL' END".format(queries_documents.NAT2)
REGION = ("addizionale_regionale_regione",)
MODEL = faults("UNION ALL SELECT doc_id, 'testo_ricostruito', 'warning' FROM d WHERE k % 31 = 0 AND layout > 0") + f""", g AS MATERIALIZED (SELECT *, cf = '' OR row_number() OVER (PARTITION BY cf, nat, layout, mese, anno ORDER BY doc_id || '.pdf') = 1 AS stored FROM st),
blank AS (SELECT 'blank' || c_custkey AS doc_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
""" + " UNION ALL ".join([
    *_long("tax", "g2_tax_z", "g2_tax_s", skip=REGION), *_long("tax", "g2_tax_c", "g3_imponibile_previdenziale", "g4_imponibile_fiscale_annuo", "g5_annual_summary"), *_long("tfr", "g6_tfr_z", "g6_tfr_c", "g6_tfr_s"),
    *_long("payroll_totals", "g8_progressivi"), *[x for n in "zcs" for x in _long("payroll_totals", f"g9_totals_{n}", skip=("iban",))],
    *_long("leave_balance", "g7_leave_z", "g7_leave_c", "g7_leave_s", skip=("tipo",), extra="tipo", field="tipo || '.' || name"),
    "SELECT 'tax', doc_id, 'addizionale_regionale_regione', NULL, 'VENETO' FROM g WHERE stored AND layout <> 1", "SELECT 'payroll_totals', doc_id, 'iban', NULL, iban FROM g WHERE stored",
    "SELECT 'pay_line', doc_id, unnest(['lines', 'competenza', 'trattenuta']), unnest([CAST(n_lines + CASE WHEN layout > 0 THEN 1 ELSE 0 END AS DOUBLE), earn, CASE WHEN layout > 0 THEN 2 ELSE 1 END * deduct]), NULL FROM g WHERE stored",
    "SELECT 'payroll_document', doc_id, 'status', NULL, status FROM g WHERE stored", "SELECT 'payroll_document', doc_id, 'status', NULL, 'NEEDS_REVIEW' FROM blank", "SELECT 'audit_event', doc_id, 'anomalies', CAST(n_anomalies AS DOUBLE), NULL FROM g WHERE stored", "SELECT 'audit_event', doc_id, 'anomalies', 2.0, NULL FROM blank",
    "SELECT 'anomaly', doc_id, tipo, NULL, severita FROM a JOIN g USING (doc_id) WHERE stored", "SELECT 'anomaly', doc_id, unnest(['template_non_riconosciuto', 'nessuna_riga_voce']), NULL, unnest(['error', 'warning']) FROM blank",
    "SELECT 'raw_extraction', doc_id, 'unrecognized', CAST(CASE WHEN layout = 2 THEN 1 ELSE 0 END + CASE WHEN layout > 0 AND k % 17 = 0 THEN 1 ELSE 0 END AS DOUBLE), NULL FROM g WHERE stored", "SELECT 'raw_extraction', doc_id, 'unrecognized', 0.0, NULL FROM blank",
    f"SELECT DISTINCT 'company', {NAMES}, 'codice_azienda', NULL, CASE layout WHEN 0 THEN '1000' || {queries_documents.NAT2} WHEN 1 THEN 'ATS/' || {queries_documents.NAT2} || '/VR' ELSE '17' || {queries_documents.NAT2} END FROM g WHERE stored",
    f"SELECT DISTINCT 'company', {NAMES}, unnest(['indirizzo', 'inail_aut', 'inail_del', 'inail_sede', 'posizione_inps', 'pat_inail']), NULL, unnest(['Via Roma 1, 20100 MILANO (MI)', '12345', '001', '002', '1234567/01', '7654321/01']) FROM g WHERE stored AND layout = 0",
    "SELECT DISTINCT 'employee', cf, 'employee', NULL, 'x' FROM g WHERE stored AND cf <> ''", "SELECT 'error', doc_id || '.pdf', 'IntegrityError', NULL, 'employee, company and period are stored already' FROM g WHERE NOT stored",
    "SELECT 'outcome', doc_id || '.pdf', CASE WHEN stored THEN status ELSE 'FAILED' END, NULL, CASE WHEN stored THEN 'processed/' || anno || '/' || lpad(CAST(mese AS VARCHAR), 2, '0') || '/' || substr(sha256(doc_id), 1, 8) || '_' ELSE 'error/' END || doc_id || '.pdf' FROM g",
    "SELECT 'outcome', doc_id || '.pdf', 'NEEDS_REVIEW', NULL, 'processed/non_riconosciuti/' || substr(sha256(doc_id), 1, 8) || '_' || doc_id || '.pdf' FROM blank",
])


def letters(words):
    """Characters of every 31st payslip, all of a word drawn at the word's place, as some printers leave them."""
    w = words.where(F.col("doc_id").cast("long") % 31 == 0)
    if "words" in w.columns:  # documents given whole
        w = w.select("doc_id", F.explode("words").alias("w")).select("doc_id", "w.*")
    w = w.select("*", F.posexplode(F.split("text", "")).alias("i", "ch")).where("ch <> ''")
    return w.select("doc_id", "page", (F.col("seq") * 1000 + F.col("i")).alias("seq"), F.col("ch").alias("text"), "x0", "x1", "top", "bottom")


@add("process_model", MODEL)
def process_model(s, d):
    """The whole job, from pages, words and characters to the tables of the model, errors and outcomes: each table is
    written, and the fields of all of its rows are given in long form."""
    words, orders = stored(K.documents(s, d), key="doc_id", lies=True), table(s, d, "orders")
    blank = table(s, d, "customer").join(orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select(F.concat(F.lit("blank"), "c_custkey").alias("doc_id"))
    pages = orders.select(F.col("o_orderkey").cast("string").alias("doc_id")).join(words.select("doc_id"), "doc_id", "left_semi").unionByName(blank)
    p = process.parse_words(words, letters(words), pages, lies=True)
    found = stored(process.anomalies(p))
    taken = process.admitted(p, found, "run", "2024-01-01")
    tables = {t: stored(x) for t, x in process.model(p, found, "run", "2024-01-01", taken=taken).items()}
    names = tables["payroll_document"].select(F.col("id").alias("document_id"), F.substring_index("original_filename", ".", 1).alias("key"))

    def long(name, df, key, fields):
        """fields: name or column of a name -> column; numbers and texts go apart."""
        kind = lambda c: F.struct(c[0].alias("field"), c[1].cast("double").alias("num") if c[2] else F.lit(None).cast("double").alias("num"), F.lit(None).cast("string").alias("txt") if c[2] else c[1].cast("string").alias("txt"))
        x = df.select(key.alias("key"), F.explode(F.array(*[kind(c) for c in fields])).alias("x")).where("x.num is not null or x.txt is not null")
        return x.select(F.lit(name).alias("table"), "key", "x.*")

    def numbers(t, skip=(), prefix=None):
        cols = [n for n, k, _ in schemas.columns(t) if k.startswith("decimal")]
        label = lambda n: F.concat(prefix, F.lit(f".{n}")) if prefix is not None else F.lit(n)
        texts = [n for n, k, _ in schemas.columns(t) if k == "string" and n not in ("id", "document_id", *skip)]
        return long(t, tables[t].join(names, "document_id"), F.col("key"), [(label(n), F.col(n), True) for n in cols] + [(F.lit(n), F.col(n), False) for n in texts])

    of = lambda t: tables[t].join(names, "document_id")
    n = of("pay_line").groupBy("key").agg(F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum("competenza"), F.lit(0)).alias("competenza"), F.coalesce(F.sum("trattenuta"), F.lit(0)).alias("trattenuta"))
    co = [c for c, _, _ in schemas.columns("company") if c not in ("id", "ragione_sociale", "created_at")]
    parts = [
        numbers("tax"), numbers("tfr"), numbers("payroll_totals"), numbers("leave_balance", ("tipo",), F.col("tipo")),
        long("pay_line", n, F.col("key"), [(F.lit(c), F.col(c), True) for c in ("lines", "competenza", "trattenuta")]),
        long("payroll_document", tables["payroll_document"], F.substring_index("original_filename", ".", 1), [(F.lit("status"), F.col("status"), False)]),
        long("audit_event", of("audit_event"), F.col("key"), [(F.lit("anomalies"), F.col("detail.anomalies"), True)]), long("anomaly", of("anomaly"), F.col("key"), [(F.col("tipo"), F.col("severita"), False)]),
        long("raw_extraction", of("raw_extraction"), F.col("key"), [(F.lit("unrecognized"), F.size("unrecognized_rows"), True)]), long("company", tables["company"], F.col("ragione_sociale"), [(F.lit(c), F.col(c), False) for c in co]),
        long("employee", tables["employee"], F.col("codice_fiscale"), [(F.lit("employee"), F.lit("x"), False)]), long("error", taken.errors, F.col("filename"), [(F.col("error_type"), F.col("message"), False)]),
        long("outcome", taken.outcomes, F.col("filename"), [(F.col("status"), F.col("destination"), False)]),
    ]
    return reduce(DataFrame.unionByName, parts)


#: Two batches and a deletion: even payslips, then all of them. What is stored well is skipped, what needed review is replaced.
TWO = FAULTS + """, g AS (SELECT *, doc_id || '.pdf' AS filename, cf = '' AS exempt, cf || '|' || nat || '|' || layout || '|' || mese || '|' || anno AS lk FROM st),
one AS (SELECT *, exempt OR row_number() OVER (PARTITION BY lk ORDER BY filename) = 1 AS stored FROM g WHERE k % 2 = 0),
good AS (SELECT * FROM one WHERE stored AND status <> 'NEEDS_REVIEW'),
two AS (SELECT *, exempt OR (lk NOT IN (SELECT lk FROM good) AND row_number() OVER (PARTITION BY lk ORDER BY filename) = 1) AS stored FROM g WHERE doc_id NOT IN (SELECT doc_id FROM good)),
kept AS (SELECT '0001' AS batch, * FROM good UNION ALL SELECT '0002', * FROM two WHERE stored)"""
BATCHES = TWO + f""", f AS MATERIALIZED (SELECT * FROM kept WHERE filename <> (SELECT min(filename) FROM kept)),
leave AS (SELECT doc_id, count(*) AS n FROM ({" UNION ALL ".join(f"SELECT doc_id FROM ({BLOCKS[n]})" for n in ("g7_leave_z", "g7_leave_c", "g7_leave_s"))}) GROUP BY doc_id),
rows AS (SELECT doc_id, batch, unnest(['payroll_document', 'pay_line', 'tax', 'tfr', 'leave_balance', 'payroll_totals', 'anomaly', 'raw_extraction', 'audit_event']) AS "table",
  unnest([1, n_lines + CASE WHEN layout > 0 THEN 1 ELSE 0 END, 1, 1, coalesce(leave.n, 0), 1, n_anomalies, 1, 1]) AS n, unnest([NULL, earn, NULL, NULL, NULL, net, NULL, NULL, n_anomalies]) AS num FROM f LEFT JOIN leave USING (doc_id))
SELECT "table", doc_id AS key, batch, CAST(n AS BIGINT) AS n, CAST(num AS DOUBLE) AS num, NULL AS txt FROM rows WHERE n > 0
UNION ALL SELECT 'outcome', doc_id, '0001', 1, NULL, CASE WHEN stored THEN status ELSE 'FAILED' END FROM one
UNION ALL SELECT 'outcome', doc_id, '0002', 1, NULL, 'SKIPPED' FROM good UNION ALL SELECT 'outcome', doc_id, '0002', 1, NULL, CASE WHEN stored THEN status ELSE 'FAILED' END FROM two
UNION ALL SELECT 'error_record', doc_id, '0001', 1, NULL, 'IntegrityError' FROM one WHERE NOT stored UNION ALL SELECT 'error_record', doc_id, '0002', 1, NULL, 'IntegrityError' FROM two WHERE NOT stored
UNION ALL SELECT 'employee', cf, min(batch), 1, NULL, NULL FROM (SELECT cf, '0001' AS batch FROM one WHERE stored UNION ALL SELECT cf, '0002' FROM two WHERE stored) WHERE cf <> '' GROUP BY cf"""


def two_batches(s, d) -> Tables:
    """Tables on storage after two runs of the job: even payslips, then all."""
    p = parsed(s, d)
    found = stored(process.anomalies(p))
    p = process.Parsed(*[stored(getattr(p, f.name), key="doc_id") for f in fields(p)])
    tables = Tables(s, new_folder(s))
    even = F.col("doc_id").cast("long") % 2 == 0
    jobs.ingest(tables, p.where(even), found.where(even), "0001", "2024-01-01")
    jobs.ingest(tables, p, found, "0002", "2024-02-01")
    return tables


@add("p3_p13_stored_batches", BATCHES)
def p3_p13(s, d):
    """Two runs of the job against tables on storage, then the deletion of the first document by name: what all nine tables that
    depend on documents hold at the end, the employees, and each run's outcomes and errors."""
    tables = two_batches(s, d)
    first = tables.read("payroll_document").agg(F.min("original_filename")).first()[0]
    jobs.delete(tables, "0003", filename=first)
    names = tables.read("payroll_document").select(F.col("id").alias("document_id"), F.substring_index("original_filename", ".", 1).alias("key"))
    num = {"pay_line": F.coalesce(F.sum("competenza"), F.lit(0)), "payroll_totals": F.sum("netto_mese"), "audit_event": F.sum("detail.anomalies")}
    none, parts = F.lit(None).cast("double"), []
    for t in DEPENDENT:
        rows = tables.read(t).withColumnsRenamed({"id": "document_id"} if t == "payroll_document" else {})
        n = rows.groupBy("document_id", "batch").agg(F.count(F.lit(1)).alias("n"), (num[t].cast("double") if t in num else F.first(none)).alias("num"))
        parts.append(n.join(names, "document_id", "left").select(F.lit(t).alias("table"), "key", "batch", "n", "num", F.lit(None).cast("string").alias("txt")))
    single = lambda t, key, txt: tables.read(t).select(F.lit(t).alias("table"), key.alias("key"), "batch", F.lit(1).cast("long").alias("n"), none.alias("num"), txt.alias("txt"))
    name = F.substring_index("filename", ".", 1)
    parts += [single("outcome", name, F.col("status")), single("error_record", name, F.col("error_type")), single("employee", F.col("codice_fiscale"), F.lit(None).cast("string"))]
    return reduce(DataFrame.unionByName, parts)


REPORTS = TWO + """, o AS (SELECT doc_id, 'SKIPPED' AS status FROM good UNION ALL SELECT doc_id, CASE WHEN stored THEN status ELSE 'FAILED' END FROM two),
last AS (SELECT * FROM kept)
SELECT 'coverage' AS report, CAST(anno AS VARCHAR) AS key, 'all' AS txt, count(*) AS n FROM last GROUP BY anno UNION ALL SELECT 'coverage', CAST(anno AS VARCHAR), 'loaded', count(*) FILTER (WHERE status = 'PROCESSED') FROM last GROUP BY anno
UNION ALL SELECT 'problems', filename, status, CAST(n_anomalies AS BIGINT) FROM last WHERE status <> 'PROCESSED'
UNION ALL SELECT 'summary', k, NULL, n FROM (SELECT unnest(['total', 'processed', 'with_anomalies', 'needs_review', 'failed', 'skipped']) AS k, unnest([count(*), count(*) FILTER (status = 'PROCESSED'), count(*) FILTER (status = 'PROCESSED_WITH_ANOMALIES'), count(*) FILTER (status = 'NEEDS_REVIEW'), count(*) FILTER (status = 'FAILED'), count(*) FILTER (status = 'SKIPPED')]) AS n FROM o)
UNION ALL SELECT 'not_ok', filename, status, NULL FROM last WHERE status = 'NEEDS_REVIEW'"""


@add("r1_r9_stored_reports", REPORTS)
def r1_r9(s, d):
    """Reports over the tables that two runs left on storage: coverage, problems with their number of anomalies, the second run's
    summary with skipped and failed files, and the documents that are not in order."""
    tables = two_batches(s, d)
    years, last = jobs.check_years(tables), tables.read("outcome", batches=["0002"])
    row = lambda df, name, key, txt, n: df.select(F.lit(name).alias("report"), key.cast("string").alias("key"), txt.cast("string").alias("txt"), n.cast("long").alias("n"))
    none, cover = F.lit(None), years["coverage"]
    summed = R.run_summary(last).select(F.explode(F.create_map(*[x for c in ("total", "processed", "with_anomalies", "needs_review", "failed", "skipped") for x in (F.lit(c), F.col(c).cast("long"))])))
    problems = years["problems"].select("filename", "status", "anomalie").unionByName(years["without_year"].select("filename", "status", "anomalie"))
    parts = [
        row(cover, "coverage", F.col("anno"), F.lit("all"), F.col("totale")), row(cover, "coverage", F.col("anno"), F.lit("loaded"), F.col("caricati")), row(problems, "problems", F.col("filename"), F.col("status"), F.size("anomalie")),
        row(summed, "summary", F.col("key"), none, F.col("value")), row(R.not_ok(tables.read("payroll_document")), "not_ok", F.col("original_filename"), F.col("status"), none),
    ]
    return reduce(DataFrame.unionByName, parts)


# Store: documents as files, their hash the key


def files(s, d):
    return table(s, d, "documents").select(F.concat("doc_id", F.lit(".pdf")).alias("filename"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha256"), "doc_id")


HASHED = "WITH f AS (SELECT doc_id, doc_id || '.pdf' AS filename, sha256(coalesce(text, '')) AS sha256 FROM documents) "


@add("a1_ingest_files", "SELECT sha256(s_name || chr(10)) AS sha256, 'txt' AS suffix FROM supplier", "")
def a1(s, d):
    """Supplier names, each written to a file of its own, are read back as files by their hash."""
    path = new_folder(s)
    table(s, d, "supplier").select("s_name").write.option("maxRecordsPerFile", 1).text(path)
    return B.ingest_files(s, path, "*.txt").select("sha256", F.element_at(F.split("filename", r"\."), -1).alias("suffix"))


@add("p1_skip_known", HASHED + "SELECT filename, sha256 IN (SELECT sha256 FROM f WHERE doc_id % 3 = 0 AND doc_id % 2 = 0) AS skipped FROM f", "")
def p1(s, d):
    """A registry on storage has every third document; even ones of these with a good outcome."""
    f = files(s, d)
    reg = Registry(s, f"registry_{uuid.uuid4().hex}", new_folder(s))
    reg.record(f.where("doc_id % 3 = 0").select("sha256", F.when(F.col("doc_id") % 2 == 0, "PROCESSED").otherwise("NEEDS_REVIEW").alias("status")), "0001")
    new, known = S.skip_known(f, reg)
    reg.forget()
    return new.select("filename", F.lit(False).alias("skipped")).unionByName(known.select("filename", F.lit(True).alias("skipped")))


MIXED = "CASE doc_id % 4 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'NEEDS_REVIEW' WHEN 2 THEN 'PROCESSED' ELSE CASE WHEN doc_id % 8 < 4 THEN 'NEEDS_REVIEW' ELSE 'FAILED' END END"


@add("p2_dedup_batch", HASHED + f""", x AS (SELECT *, {MIXED} AS status FROM f),
o AS (SELECT *, min(CASE WHEN status = 'PROCESSED' THEN filename END) OVER (PARTITION BY sha256) AS a, max(CASE WHEN status = 'NEEDS_REVIEW' THEN filename END) OVER (PARTITION BY sha256) AS b FROM x)
SELECT filename, status, CASE WHEN filename > a THEN 'skipped' ELSE 'kept' END AS outcome FROM o WHERE coalesce(filename > a, false) OR status <> 'NEEDS_REVIEW' OR (a IS NULL AND filename = b)""", "")
def p2(s, d):
    """Copies of one file have all outcomes, as those may depend on more than the bytes."""
    m = F.col("doc_id") % 4
    late = F.when(F.col("doc_id") % 8 < 4, "NEEDS_REVIEW").otherwise("FAILED")
    status = F.when(m == 0, "FAILED").when(m == 1, "NEEDS_REVIEW").when(m == 2, "PROCESSED").otherwise(late)
    kept, skipped = S.dedup_batch(files(s, d).withColumn("status", status))
    return kept.select("filename", "status", F.lit("kept").alias("outcome")).unionByName(skipped.select("filename", "status", F.lit("skipped").alias("outcome")))


def facts(s, d):
    return S.document_fact(slips(s, d))


@add("p3_replace_documents", "SELECT 'payroll_document' AS name, doc_id, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS round, 0::BIGINT AS n FROM d UNION ALL SELECT 'pay_line', doc_id, CASE WHEN l.k % 3 = 0 THEN 1 ELSE 0 END::BIGINT, CAST(n AS BIGINT) FROM l")
def p3(s, d):
    """Every third document is replaced by a new one with new lines."""
    docs = facts(s, d).select("id", "k", "doc_id", F.lit(0).alias("round"), F.lit(0).alias("n"))
    lines = K.render.slip_lines(s, d).select("doc_id", "n", F.lit(0).alias("round")).join(docs.select("doc_id", F.col("id").alias("document_id")), "doc_id")
    third = docs.where("k % 3 = 0")
    new = {"payroll_document": third.withColumn("round", F.lit(1)), "pay_line": lines.join(third.select("doc_id"), "doc_id", "left_semi").withColumn("round", F.lit(1))}
    t = S.replace_documents({"payroll_document": docs, "pay_line": lines}, third.select(F.col("id").alias("document_id")), new)
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("name"), "doc_id", "round", "n") for n, df in t.items()])


def empty(s, t):
    return s.createDataFrame([], schemas.ddl(t))


EXTRA = ["indirizzo", "inail_aut", "inail_del", "inail_sede", "posizione_inps", "pat_inail"]
FIRST = "arg_min({0}, doc_id || '.pdf')"


@add("p4_upsert_company", f"SELECT 'N' || nat AS ragione_sociale, {FIRST.format('cust')} || ' street' AS indirizzo FROM d WHERE k % 23 <> 0 GROUP BY nat")
def p4(s, d):
    docs = slips(s, d).withColumns({c: F.concat("cust", F.lit(" street")) for c in EXTRA})
    old = S.upsert_company(empty(s, "company"), docs)
    return S.upsert_company(old, docs.withColumn("indirizzo", F.lit("later"))).select("ragione_sociale", "indirizzo")


def _twice(s, d):
    """Odd orders come first, with names of their own; even ones then find those employees or bring new ones."""
    x = slips(s, d)
    first = S.upsert_employee(empty(s, "employee"), x.where("k % 2 = 1").withColumn("cognome_nome", F.concat(F.lit("Prima "), "filename")))
    return S.upsert_employee(first, x.where("k % 2 = 0").withColumn("cognome_nome", F.concat(F.lit("Poi "), "filename")))


@add("p5_upsert_employee", "SELECT cf AS codice_fiscale, coalesce('Prima ' || min(doc_id || '.pdf') FILTER (WHERE k % 2 = 1), 'Poi ' || min(doc_id || '.pdf')) AS cognome_nome FROM d WHERE cf <> '' GROUP BY cf")
def p5(s, d):
    return _twice(s, d).select("codice_fiscale", "cognome_nome")


@add("p6_upsert_employment", "SELECT cf, nat, CASE WHEN bool_or(k % 5 <> 0) THEN date '2020-03-15' ELSE date '1970-01-01' END AS valid_from, CASE WHEN bool_or(k % 5 <> 0) THEN date '2020-03-15' END AS data_assunzione FROM d WHERE cf <> '' AND k % 23 <> 0 GROUP BY cf, nat")
def p6(s, d):
    docs = facts(s, d)
    first = S.upsert_employment(empty(s, "employment"), docs.withColumn("hire_date", F.lit(None).cast("date")))
    who = docs.where("employee_id is not null and company_id is not null").select("employee_id", "company_id", F.col("codice_fiscale").alias("cf"), "nat").distinct()
    return S.upsert_employment(first, docs).join(who, ["employee_id", "company_id"]).select("cf", "nat", "valid_from", "data_assunzione")


@add("p7_upsert_period", "SELECT DISTINCT CAST(mese AS BIGINT) AS mese, CAST(anno AS BIGINT) AS anno, 'ordinario' AS tipo FROM d WHERE k % 29 <> 0")
def p7(s, d):
    return S.upsert_period(empty(s, "payroll_period"), slips(s, d)).select("mese", "anno", "tipo")


@add("p8_document_fact", "SELECT doc_id, CASE WHEN cf <> '' THEN sha256('+' || cf) END AS employee_id, CASE WHEN k % 23 <> 0 THEN sha256('+N' || nat || chr(31) || '-') END AS company_id, CASE WHEN k % 29 <> 0 THEN sha256('+' || mese || chr(31) || '+' || anno || chr(31) || '+ordinario') END AS period_id FROM d")
def p8(s, d):
    return facts(s, d).select("doc_id", "employee_id", "company_id", "period_id")


@add("p9_logical_key_conflicts", """, x AS (SELECT doc_id, cf = '' OR k % 23 = 0 OR k % 29 = 0 AS exempt, min(doc_id || '.pdf') OVER w AS first, max(k % 50 = 0) OVER w AS stored FROM d WINDOW w AS (PARTITION BY cf, nat, k % 23 = 0, k % 29 = 0, mese, anno))
SELECT doc_id, exempt OR (NOT stored AND doc_id || '.pdf' = first) AS ok FROM x""")
def p9(s, d):
    docs = facts(s, d)
    ok, bad = S.logical_key_conflicts(docs, docs.where("k % 50 = 0"))
    return ok.select("doc_id", F.lit(True).alias("ok")).unionByName(bad.select("doc_id", F.lit(False).alias("ok")))


@add("p10_child_tables", "SELECT doc_id, 'Z' || code AS codice_causale, CAST(n AS BIGINT) AS raw_text, CASE WHEN flag <> 'R' THEN amount END AS competenza FROM l")
def p10(s, d):
    lines = K.render.slip_lines(s, d).select("doc_id", F.concat(F.lit("Z"), F.col("code")).alias("codice_causale"), F.lit("x").alias("descrizione"), F.lit("altro").alias("categoria"), F.lit(True).alias("is_recognized"), F.when(F.col("flag") != "R", F.col("amount")).cast("decimal(14,5)").alias("competenza"), F.col("n").cast("string").alias("raw_text"))
    docs = facts(s, d)
    c = S.child_table(lines, docs, "pay_line").join(docs.select(F.col("id").alias("document_id"), "doc_id"), "document_id")
    return c.select("doc_id", "codice_causale", F.col("raw_text").cast("bigint").alias("raw_text"), "competenza")


@add("p11_audit_constraints", """SELECT 'payroll_period' AS "table", 'month' AS "check", CAST(count(*) AS BIGINT) AS n FROM d WHERE month(date '2020-01-01') = 1 AND k % 29 = 0 UNION ALL
  SELECT 'employee', 'length:codice_fiscale', count(*) FROM d WHERE k % 11 = 0 UNION ALL SELECT 'employee', 'required:cognome_nome', count(*) FROM d WHERE k % 7 = 0 UNION ALL SELECT 'pay_line', 'orphan', count(*) FROM l JOIN d USING (doc_id) WHERE d.k % 3 = 0""")
def p11(s, d):
    docs = facts(s, d)
    lines = K.render.slip_lines(s, d).join(docs.select("doc_id", "id"), "doc_id").select(S.key_id("id", "n", "code").alias("id"), F.col("id").alias("document_id"))
    t = {"payroll_document": docs.where("k % 3 <> 0").select("id"), "payroll_period": docs.select("id", F.col("mese")), "employee": docs.select("id", F.when(F.col("k") % 11 == 0, F.concat("cf_original", F.lit("X"))).otherwise(F.col("cf_original")).alias("codice_fiscale"), F.when(F.col("k") % 7 != 0, F.col("cognome_nome")).alias("cognome_nome")), "pay_line": lines}
    return S.audit_constraints(t).groupBy("table", "check").agg(F.count(F.lit(1)).alias("n"))


@add("p12_audit_events", FAULTS + "SELECT doc_id, status, CAST(n_anomalies AS BIGINT) AS anomalies, 'document_processed' AS event_type FROM st")
def p12(s, d):
    p = parsed(s, d)
    st = Q.determine_status(p.docs, process.anomalies(p)).withColumns({"id": F.col("doc_id"), "created_at": F.lit("2024-01-01").cast("timestamp")})
    return S.audit_events(st, "run").select(F.col("document_id").alias("doc_id"), "detail.status", "detail.anomalies", "event_type")


@add("p13_delete_document", "SELECT 'payroll_document' AS name, doc_id, 0::BIGINT AS n FROM d WHERE doc_id || '.pdf' <> (SELECT min(doc_id || '.pdf') FROM d) UNION ALL SELECT 'pay_line', doc_id, CAST(n AS BIGINT) FROM l WHERE doc_id || '.pdf' <> (SELECT min(doc_id || '.pdf') FROM d)")
def p13(s, d):
    docs = facts(s, d).select("id", "doc_id", F.col("filename").alias("original_filename"), "sha256", F.lit("PROCESSED").alias("status"), F.lit(0).alias("n"))
    lines = K.render.slip_lines(s, d).join(docs.select("doc_id", F.col("id").alias("document_id")), "doc_id").select("doc_id", "document_id", "n")
    name = docs.agg(F.min("original_filename")).first()[0]
    t, _ = S.delete_document({"payroll_document": docs, "pay_line": lines}, filename=name)
    return reduce(DataFrame.unionByName, [df.select(F.lit(k).alias("name"), "doc_id", "n") for k, df in t.items()])


@add("p14_isolate", "SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CASE WHEN bool_or(code % 100 = 0) THEN 'bad code' END AS error FROM l GROUP BY doc_id")
def p14(s, d):
    lines = K.render.slip_lines(s, d)
    ok, bad = S.isolate(lines, F.when(F.col("code") % 100 == 0, "bad code"))
    n = lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))
    good = ok.select("doc_id").distinct().join(n, "doc_id").select("doc_id", "n_lines", F.lit(None).cast("string").alias("error"))
    return good.unionByName(bad.join(n, "doc_id").select("doc_id", "n_lines", "error"))


# Bundles


@add("a2_raw_extraction", "SELECT source AS doc_id, CAST(sum(length(text)) + 2 * (count(*) - 1) AS BIGINT) AS n_chars, count(*) AS n_words, CAST(0 AS BIGINT) AS n_unmapped FROM documents GROUP BY source", "")
def a2(s, d):
    """Each document is a payslip and its lines are the pages; what the extractions hold is then summed by source."""
    doc = stored(table(s, d, "documents").select(F.monotonically_increasing_id().cast("string").alias("doc_id"), "source", "text"))
    r = raw_by_line(doc).join(doc.select("doc_id", "source"), "doc_id")
    # Two line feeds part the pages, so each pair is one line feed of the text.
    n = F.count(F.lit(1))
    chars = F.sum(F.length(F.replace("full_text", F.lit("\n\n"), F.lit("\n")))) + 2 * (n - 1)
    return r.groupBy(F.col("source").alias("doc_id")).agg(chars.alias("n_chars"), F.sum(F.size("words")).alias("n_words"), F.sum(F.size("unrecognized_rows")).alias("n_unmapped"))


def raw_by_line(doc):
    """Raw extractions of doc (doc_id, text), a page for each line of text and one word for each document."""
    pages = doc.select("doc_id", F.posexplode_outer(F.split("text", "\n", -1)).alias("page", "full_text"))
    words = doc.select("doc_id", F.lit(0).alias("page"), F.lit(0).alias("seq"), F.lit("w").alias("text"), *[F.lit(1.0).alias(c) for c in ("x0", "x1", "top", "bottom")])
    return B.raw_extraction(pages, words, pages.select("doc_id", F.array("full_text").alias("texts")).where("false"))


AT = datetime(2025, 7, 15, 10, 30)


def model_tables(s, d):
    """Three tables of the model from the order tables, as a bundle would hold them."""
    docs = facts(s, d)
    fact = docs.select("id", "sha256", F.col("filename").alias("original_filename"), F.lit("PROCESSED").alias("status"), F.col("template").alias("template_name"), "parser_version", F.lit(False).alias("source_used_ocr"), *[F.lit(None).cast("string").alias(c) for c in ("processed_path", "error_path")], "employee_id", "company_id", "period_id", "hire_date", F.col("run_ts").alias("created_at"), F.col("run_ts").alias("updated_at"))
    totals = S.child_table(docs.select("doc_id", "totale_competenze", "totale_trattenute", "netto_mese", "iban"), docs, "payroll_totals")
    return {"employee": S.upsert_employee(empty(s, "employee"), docs), "payroll_period": S.upsert_period(empty(s, "payroll_period"), docs), "payroll_document": fact, "payroll_totals": totals}


@add("a3_a5_export_import", "SELECT doc_id, CASE WHEN k % 37 <> 0 THEN iban END AS iban, earn AS totale_competenze, deduct AS totale_trattenute, net AS netto_mese, cf AS codice_fiscale, CASE WHEN k % 29 <> 0 THEN CAST(mese AS BIGINT) END AS mese, CASE WHEN k % 5 <> 0 THEN date '2020-03-15' END AS hire_date FROM d")
def a3(s, d):
    """Four tables are written as a bundle, read back and joined."""
    t = B.import_bundle(s, B.export_bundle(model_tables(s, d), new_folder(s), AT))
    docs = t["payroll_document"].join(t["payroll_totals"].drop("id"), F.col("id") == F.col("document_id")).drop("id")
    docs = docs.join(t["employee"].select(F.col("id").alias("employee_id"), "codice_fiscale"), "employee_id", "left").join(t["payroll_period"].select(F.col("id").alias("period_id"), "mese"), "period_id", "left")
    return docs.select(F.substring_index("original_filename", ".", 1).alias("doc_id"), "iban", "totale_competenze", "totale_trattenute", "netto_mese", F.coalesce("codice_fiscale", F.lit("")).alias("codice_fiscale"), "mese", "hire_date")


@add("a4_manifest", "SELECT '1.0.0' AS schema_version, 'employee, payroll_period, payroll_document, payroll_totals' AS import_order, (SELECT count(*) FROM d) AS documents, (SELECT count(DISTINCT cf) FROM d WHERE cf <> '') AS employees")
def a4(s, d):
    m = B.export_manifest(model_tables(s, d), AT)
    return m.select("schema_version", F.array_join("import_order", ", ").alias("import_order"), F.col("row_counts")["payroll_document"].alias("documents"), F.col("row_counts")["employee"].alias("employees"))


@add("a6_reconcile_counts", "SELECT 'payroll_document' AS name, count(*) AS expected, CAST(count(*) FILTER (WHERE k % 2 = 0) AS BIGINT) AS found FROM d UNION ALL SELECT 'payroll_totals', count(*), NULL FROM d")
def a6(s, d):
    t = model_tables(s, d)
    docs = t["payroll_document"]
    even = docs.where(F.regexp_extract("original_filename", r"^(\d+)", 1).cast("long") % 2 == 0)
    return B.reconcile_counts(B.table_counts(t), B.table_counts({"employee": t["employee"], "payroll_period": t["payroll_period"], "payroll_document": even}))


#: Rows of all tables after a run over all payslips.
COUNTED = FAULTS + f""", g AS MATERIALIZED (SELECT *, cf = '' OR row_number() OVER (PARTITION BY cf, nat, layout, mese, anno ORDER BY doc_id || '.pdf') = 1 AS stored FROM st),
f AS MATERIALIZED (SELECT *, {NAMES} AS company FROM g WHERE stored),
n AS (SELECT count(*) AS docs, sum(n_lines + CASE WHEN layout > 0 THEN 1 ELSE 0 END) AS lines, sum(n_anomalies) AS notes, count(DISTINCT company) AS companies, count(DISTINCT cf) FILTER (cf <> '') AS people, count(DISTINCT (cf, company)) FILTER (cf <> '') AS jobs, count(DISTINCT (mese, anno)) AS periods FROM f),
leave AS (SELECT count(*) AS n FROM ({" UNION ALL ".join(f"SELECT doc_id FROM ({BLOCKS[n]})" for n in ("g7_leave_z", "g7_leave_c", "g7_leave_s"))}) JOIN f USING (doc_id))
SELECT unnest(['company', 'employee', 'employment', 'payroll_period', 'payroll_document', 'pay_line', 'tax', 'tfr', 'leave_balance', 'payroll_totals', 'anomaly', 'raw_extraction', 'audit_event']) AS name,
  CAST(unnest([companies, people, jobs, periods, docs, lines, docs, docs, (SELECT n FROM leave), docs, notes, docs, docs]) AS BIGINT) AS rows, 0::BIGINT AS missing, 0::BIGINT AS extra, true AS same FROM n"""


@add("a3_a6_whole_bundle", COUNTED)
def a3_a6(s, d):
    """All 13 tables of a run are exported, held against the bundle's manifest, imported and compared row by row."""
    p = parsed(s, d)
    found = stored(process.anomalies(p))
    tables = {t: stored(x) for t, x in process.model(p, found, "run", "2024-01-01").items()}
    path = B.export_bundle(tables, new_folder(s), AT)
    off = B.differences(tables, B.import_bundle(s, path))
    return off.join(B.verify_bundle(s, path).select("name", "same"), "name")


@add("a7_upgrade_schema", "SELECT doc_id, cust AS employee_no, CAST(NULL AS VARCHAR) AS note, earn AS competenza FROM d")
def a7(s, d):
    old = slips(s, d).select(F.col("doc_id").alias("document_id"), F.col("cust").cast("string").alias("codice_causale"), F.col("totale_competenze").cast("string").alias("competenza"), F.lit("gone").alias("old_column"))
    return B.upgrade_schema(old, "pay_line").select(F.col("document_id").alias("doc_id"), F.col("codice_causale").cast("bigint").alias("employee_no"), "note", "competenza")


#: Version of the bundle that each document comes from: by its number, every twelfth one from the last.
MIXED = """, v AS (SELECT *, CASE WHEN k % 12 = 0 THEN 3 ELSE k % 4 END AS v FROM d)
SELECT doc_id, cf AS codice_fiscale, CAST(count(*) FILTER (v < 3 OR k % 12 <> 0 OR l.flag <> 'R') AS BIGINT) AS lines, CAST(count(*) FILTER (v >= 1 AND (k % 12 <> 0 OR l.flag <> 'R')) AS BIGINT) AS notes,
  earn AS imponibile_irpef, CASE WHEN v >= 2 THEN earn END AS imponibile_fiscale_annuo, CASE WHEN v >= 3 THEN deduct END AS imponibile_previdenziale_non_arrotondato, CASE WHEN v >= 2 THEN deduct END AS retribuzione_utile_tfr_annua
FROM v JOIN (SELECT doc_id, flag FROM l) l USING (doc_id) GROUP BY ALL"""


@add("a7_mixed_versions", MIXED)
def a7_mixed(s, d):
    """Bundles of three old versions and of the current one in one import. Every twelfth document is in the oldest and in the
    newest bundle, in the newest without its deductions; it comes whole from there."""
    docs = stored(facts(s, d).select("*", F.col("filename").alias("original_filename"), F.col("template").alias("template_name"), F.lit("PROCESSED").alias("status"), F.lit(False).alias("source_used_ocr")))
    lines = stored(K.render.slip_lines(s, d).select("doc_id", "n", "flag", F.col("amount").alias("competenza"), F.lit("seen").alias("note"), *[F.lit("x").alias(c) for c in ("descrizione", "categoria", "raw_text")], F.lit(True).alias("is_recognized")))
    folder, paths = new_folder(s), []
    for v, version in enumerate(("0.1.0", "0.2.0", "0.3.0", "1.0.0")):
        twelfth = F.col("k") % 12 == 0
        mine = docs.where((F.col("k") % 4 == v) | (twelfth if v == 3 else F.lit(False)))
        kept = lines if v < 3 else lines.join(docs.where(twelfth).select("doc_id", F.lit(True).alias("twelfth")), "doc_id", "left").where("twelfth is null or flag <> 'R'").drop("twelfth")
        sums = {"tax": {"imponibile_irpef": "totale_competenze", "imponibile_fiscale_annuo": "totale_competenze", "imponibile_previdenziale_non_arrotondato": "totale_trattenute"}, "tfr": {"retribuzione_utile_tfr_annua": "totale_trattenute"}}
        tables = {"employee": S.upsert_employee(empty(s, "employee"), mine), "payroll_document": B.upgrade_schema(mine, "payroll_document"), "pay_line": S.child_table(kept.drop("flag"), mine, "pay_line")}
        tables |= {t: S.child_table(mine.select("doc_id", *[F.col(x).alias(c) for c, x in of.items()]), mine, t) for t, of in sums.items()}
        paths.append(B.export_bundle(tables, folder, AT.replace(minute=v), version=version))
    t = B.import_bundles(s, paths)
    per = t["pay_line"].groupBy("document_id").agg(F.count(F.lit(1)).alias("lines"), F.count("note").alias("notes"))
    out = t["payroll_document"].select(F.col("id").alias("document_id"), "employee_id", F.substring_index("original_filename", ".", 1).alias("doc_id")).join(per, "document_id", "left")
    for name in ("tax", "tfr"):
        out = out.join(t[name].drop("id"), "document_id", "left")
    out = out.join(t["employee"].select(F.col("id").alias("employee_id"), "codice_fiscale"), "employee_id", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("lines", "notes")]
    return out.select("doc_id", F.coalesce("codice_fiscale", F.lit("")).alias("codice_fiscale"), *zero, "imponibile_irpef", "imponibile_fiscale_annuo", "imponibile_previdenziale_non_arrotondato", "retribuzione_utile_tfr_annua")


@add("a8_destination_path", FAULTS + "SELECT doc_id, CASE WHEN k % 29 = 0 THEN 'processed/non_riconosciuti/' ELSE 'processed/' || anno || '/' || lpad(CAST(mese AS VARCHAR), 2, '0') || '/' END || substr(sha256(doc_id), 1, 8) || '_' || doc_id || '.pdf' AS destination FROM d WHERE k % 53 <> 0 UNION ALL SELECT doc_id, 'error/' || doc_id || '.pdf' FROM d WHERE k % 53 = 0")
def a8(s, d):
    x = slips(s, d).withColumn("status", F.when(F.col("k") % 53 == 0, "FAILED").otherwise("PROCESSED"))
    return S.destination_path(x).select("doc_id", "destination")


@add("a9_error_records", "SELECT 'run' AS run_id, doc_id || '.pdf' AS filename, 'ValueError' AS error_type, 'bad code' AS message FROM l GROUP BY doc_id HAVING bool_or(code % 100 = 0)")
def a9(s, d):
    _, bad = S.isolate(K.render.slip_lines(s, d), F.when(F.col("code") % 100 == 0, "bad code"))
    return S.error_records(bad.select(F.concat("doc_id", F.lit(".pdf")).alias("filename"), F.lit("ValueError").alias("error_type"), F.col("error").alias("message")), "run")


# Reports


def period_of(docs):
    return docs.where("period_id is not null").groupBy(F.col("period_id").alias("id")).agg(*[F.first(c).alias(c) for c in ("mese", "anno", "tipo")])


ST = ", g AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'NEEDS_REVIEW' WHEN k % 7 = 0 THEN 'FAILED' WHEN k % 5 = 0 THEN 'PROCESSED_WITH_ANOMALIES' ELSE 'PROCESSED' END AS status FROM d) "


def graded(s, d):
    k = F.col("k")
    return facts(s, d).withColumn("status", F.when(k % 11 == 0, "NEEDS_REVIEW").when(k % 7 == 0, "FAILED").when(k % 5 == 0, "PROCESSED_WITH_ANOMALIES").otherwise("PROCESSED"))


@add("r1_year_coverage", FAULTS + "SELECT CAST(anno AS BIGINT) AS anno, count(*) AS totale, CAST(count(*) FILTER (WHERE status = 'PROCESSED') AS BIGINT) AS caricati FROM st GROUP BY anno")
def r1(s, d):
    """From positioned words to the report."""
    p = parsed(s, d)
    docs = S.document_fact(p.docs.join(Q.determine_status(p.docs, process.anomalies(p)), "doc_id").withColumn("sha256", F.col("doc_id")))
    return R.year_coverage(docs, period_of(docs))


def doc_anomalies(docs):
    return Q.rule_header(docs).join(docs.select("doc_id", F.col("id").alias("document_id")), "doc_id")


LIST = "concat_ws(' | ', CASE WHEN k % 11 = 0 THEN '[error] codice_fiscale_non_valido: Codice fiscale con carattere di controllo errato: ''' || cf_printed || '''' END, CASE WHEN k % 23 = 0 THEN '[error] header_incompleto: Ragione sociale non trovata' END) AS anomalie"


@add("r2_year_problems", ST + f"SELECT CAST(anno AS BIGINT) AS anno, doc_id || '.pdf' AS filename, status, {LIST} FROM g WHERE status <> 'PROCESSED' AND k % 29 <> 0")
def r2(s, d):
    g = graded(s, d)
    docs = g.select("id", "period_id", "status", F.col("filename").alias("original_filename"))
    return R.year_problems(docs, period_of(g), doc_anomalies(g)).withColumn("anomalie", F.array_join("anomalie", " | "))


@add("r3_without_year", ST + f"SELECT doc_id || '.pdf' AS filename, status, {LIST} FROM g WHERE status <> 'PROCESSED' AND k % 29 = 0")
def r3(s, d):
    g = graded(s, d)
    docs = g.select("id", "period_id", "status", F.col("filename").alias("original_filename"))
    return R.without_year(docs, period_of(g), doc_anomalies(g)).withColumn("anomalie", F.array_join("anomalie", " | "))


LANDED = ST + f""", p AS (SELECT doc_id || '.pdf' AS filename, CASE WHEN k % 29 <> 0 THEN CAST(anno AS BIGINT) END AS anno, mese, status, doc_id, k, {LIST} FROM g)
SELECT 'coverage' AS report, anno, 'totale' AS key, NULL AS txt, count(*) AS n FROM p WHERE anno IS NOT NULL GROUP BY anno
UNION ALL SELECT 'coverage', anno, 'caricati', NULL, count(*) FILTER (status = 'PROCESSED') FROM p WHERE anno IS NOT NULL GROUP BY anno
UNION ALL SELECT CASE WHEN anno IS NULL THEN 'without_year' ELSE 'problem' END, anno, filename, status || ': ' || anomalie, NULL FROM p WHERE status <> 'PROCESSED'
UNION ALL SELECT 'document', anno, filename, CASE WHEN status = 'FAILED' THEN 'error/' || filename WHEN anno IS NULL THEN 'processed/non_riconosciuti/' || substr(sha256(doc_id), 1, 8) || '_' || filename ELSE 'processed/' || anno || '/' || lpad(CAST(mese AS VARCHAR), 2, '0') || '/' || substr(sha256(doc_id), 1, 8) || '_' || filename END, CASE WHEN anno IS NOT NULL THEN CAST(mese AS BIGINT) END FROM p
UNION ALL SELECT 'error', NULL, filename, 'ValueError: lost', NULL FROM p WHERE status = 'FAILED'"""


@add("r1_r3_landed", LANDED)
def r1_r3_landed(s, d):
    """Documents are landed by year and month and errors as files; one year is landed again. Reports read what landed."""
    g = graded(s, d)
    docs = stored(g.select("id", "sha256", "period_id", "status", F.col("filename").alias("original_filename"), F.col("template").alias("template_name")))
    periods, notes, landing = stored(period_of(g)), stored(doc_anomalies(g)), Landing(s, new_folder(s))
    landing.land(docs, periods, notes)
    landing.land(docs, periods, notes, [periods.agg(F.min("anno")).first()[0], None])
    landing.land_errors(S.error_records(docs.where("status = 'FAILED'").select(F.col("original_filename").alias("filename"), F.lit("ValueError").alias("error_type"), F.lit("lost").alias("message")), "run").withColumn("batch", F.lit("0001")))
    none, cover = F.lit(None), landing.coverage()
    row = lambda df, name, anno, key, txt, n: df.select(F.lit(name).alias("report"), anno.cast("long").alias("anno"), key.alias("key"), txt.cast("string").alias("txt"), n.cast("long").alias("n"))
    told = F.concat("status", F.lit(": "), F.array_join("anomalie", " | "))
    parts = [
        row(cover, "coverage", F.col("anno"), F.lit("totale"), none, F.col("totale")), row(cover, "coverage", F.col("anno"), F.lit("caricati"), none, F.col("caricati")), row(landing.problems(), "problem", F.col("anno"), F.col("filename"), told, none),
        row(landing.without_year(), "without_year", none, F.col("filename"), told, none), row(landing.documents(), "document", F.col("anno"), F.col("filename"), F.col("destination"), F.col("mese")),
        row(landing.errors(), "error", none, F.col("filename"), F.concat("error_type", F.lit(": "), F.col("message")), none),
    ]
    return reduce(DataFrame.unionByName, parts)


@add("r4_status_counts", "SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1", "")
def r4(s, d):
    return R.status_counts(table(s, d, "events").withColumnRenamed("event_type", "status"))


@add("r5_run_summary", ST + "SELECT count(*) AS total, CAST(count(*) FILTER (WHERE status = 'PROCESSED') AS BIGINT) AS processed, CAST(count(*) FILTER (WHERE status = 'PROCESSED_WITH_ANOMALIES') AS BIGINT) AS with_anomalies, CAST(count(*) FILTER (WHERE status = 'NEEDS_REVIEW') AS BIGINT) AS needs_review, CAST(count(*) FILTER (WHERE status = 'FAILED') AS BIGINT) AS failed, 0::BIGINT AS skipped FROM g")
def r5(s, d):
    return R.run_summary(graded(s, d))


@add("r6_input_backlog", "SELECT CAST(count(*) FILTER (WHERE doc_id % 3 < 2) AS BIGINT) AS n FROM documents", "")
def r6(s, d):
    m = F.col("doc_id") % 3
    return R.input_backlog(table(s, d, "documents").select(F.concat("doc_id", F.when(m == 0, ".pdf").when(m == 1, ".PDF").otherwise(".pdf:Zone.Identifier")).alias("path")))


PROBLEMS = f"concat_ws(', ', CASE WHEN k % 23 = 0 THEN 'azienda' END, CASE WHEN cf = '' THEN 'codice_fiscale' END, {{0}}, CASE WHEN net IS NULL THEN 'netto' END, CASE WHEN k % 37 = 0 THEN 'iban mancante' WHEN {mod97('iban')} <> 1 THEN 'iban non valido' END)"
REPORT = f"SELECT doc_id, {D3} AS template, CASE WHEN k % 29 = 0 THEN 'N/D' ELSE lpad(CAST(mese AS VARCHAR), 2, '0') || '/' || anno END AS period, 'ordinario' AS tipo, CAST(n_lines AS BIGINT) AS lines, net IS NOT NULL AS net_present, k % 37 <> 0 AND {mod97('iban')} = 1 AS iban_valid, 0::BIGINT AS info, 0::BIGINT AS warning, CAST(CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END AS BIGINT) AS error, {PROBLEMS.format("CASE WHEN k % 29 = 0 THEN 'periodo' END")} AS problems FROM d"


def report(s, d):
    x = slips(s, d)
    return R.acceptance_report(x, K.render.slip_lines(s, d), x, Q.rule_header(x))


@add("r7_acceptance_report", REPORT)
def r7(s, d):
    return report(s, d).select("doc_id", "template", "period", "tipo", "lines", "net_present", "iban_valid", "info", "warning", "error", "problems")


EXPECT = PROBLEMS.format("CASE WHEN k % 2 = 0 AND (k % 29 = 0 OR mese <> 3) THEN 'mese' END, CASE WHEN k % 2 = 0 AND anno <> 1995 THEN 'anno' END, CASE WHEN k % 2 = 1 AND k % 29 = 0 THEN 'periodo' END")


@add("r8_check_expected", f"SELECT doc_id, CASE WHEN layout <> 0 AND k % 5 < 4 THEN 'template' ELSE {EXPECT} END AS problems FROM d UNION ALL SELECT 'none' || c_custkey, 'documento' FROM customer")
def r8(s, d):
    x = slips(s, d)
    even = F.col("k") % 2 == 0
    e = x.select("doc_id", F.when(F.col("k") % 5 < 4, "z").otherwise(F.col("template")).alias("template"), F.when(even, 3).alias("mese"), F.when(even, 1995).alias("anno"))
    none = table(s, d, "customer").select(F.concat(F.lit("none"), "c_custkey").alias("doc_id"), F.lit("z").alias("template"), F.lit(3).alias("mese"), F.lit(1995).alias("anno"))
    return R.check_expected(report(s, d), e.unionByName(none))


@add("r9_not_ok", ST + "SELECT doc_id, status FROM g WHERE status IN ('NEEDS_REVIEW', 'FAILED')")
def r9(s, d):
    return R.not_ok(graded(s, d)).select("doc_id", "status")
