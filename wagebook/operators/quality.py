"""Quality rules: each gives anomalies (doc_id, rule_no, tipo, severita, messaggio, campo); the status follows from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagebook.functions import ids as I

COLS = ["doc_id", "rule_no", "tipo", "severita", "messaggio", "campo"]


def _anomaly(rows: DataFrame, no: int, tipo: str, severity: str, message: Column | str, field: Column | str | None = None) -> DataFrame:
    text = lambda x: F.lit(x).cast("string") if x is None or isinstance(x, str) else x
    return rows.select("doc_id", F.lit(no).alias("rule_no"), F.lit(tipo).alias("tipo"), F.lit(severity).alias("severita"), text(message).alias("messaggio"), text(field).alias("campo"))


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def rule_template(docs: DataFrame) -> DataFrame:
    return _anomaly(docs.where("template = 'unknown'"), 0, "template_non_riconosciuto", "error", "Nessun layout riconosciuto", "template")


def rule_header(docs: DataFrame) -> DataFrame:
    """docs: doc_id, codice_fiscale, cf_original, cf_invalid, ragione_sociale."""
    return _union(
        _anomaly(docs.where("cf_invalid"), 1, "codice_fiscale_non_valido", "error", F.concat(F.lit("Codice fiscale con carattere di controllo errato: "), quoted(F.col("cf_original"))), "codice_fiscale"),
        _anomaly(docs.where("codice_fiscale = '' and not cf_invalid"), 2, "header_incompleto", "error", "Codice fiscale non trovato", "codice_fiscale"),
        _anomaly(docs.where("coalesce(ragione_sociale, '') = ''"), 3, "header_incompleto", "error", "Ragione sociale non trovata", "ragione_sociale"),
    )


def rule_period(docs: DataFrame) -> DataFrame:
    """docs: doc_id, template, mese, hire_text, hire_date."""
    return _union(
        _anomaly(docs.where("coalesce(mese, 0) = 0"), 4, "periodo_non_riconosciuto", "warning", "Periodo non riconosciuto", "periodo"),
        _anomaly(docs.where("template = 'z' and hire_text is not null and hire_date is null"), 5, "data_non_valida", "warning", F.concat(F.lit("Data di assunzione impossibile: "), quoted(F.col("hire_text"))), "data_assunzione"),
    )


def rule_unmapped(unmapped: DataFrame) -> DataFrame:
    """unmapped: doc_id, texts, n_with_amount."""
    some = unmapped.where("n_with_amount > 0")
    return _anomaly(some, 6, "righe_non_mappate", "info", F.concat(F.col("n_with_amount").cast("string"), F.lit(" righe con importo non mappate su "), F.size("texts").cast("string")), "pay_lines")


def rule_codes(lines: DataFrame) -> DataFrame:
    """lines: doc_id, doc_row, codice, raw_code, correction. Repaired codes, and codes that look wrong in the same way."""
    fixed = lines.where("correction is not null").groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_row", F.concat(quoted(F.col("raw_code")), F.lit(" -> "), quoted(F.col("codice"))).alias("t")))), lambda x: x["t"]), ", ").alias("t"))
    flagged = lines.groupBy("doc_id").agg(F.bool_or(F.coalesce(F.col("correction") == "font_digit_lettera", F.lit(False))).alias("z"), F.array_sort(F.collect_list(F.struct("doc_row", "codice"))).alias("c"))
    suspect = F.filter("c", lambda x: I.suspect_code(x["codice"], F.lit(True)))
    flagged = flagged.where("z").withColumn("s", suspect).where(F.size("s") > 0)
    return _union(
        _anomaly(fixed, 7, "codice_causale_corretto_automaticamente", "warning", F.concat(F.lit("Codici corretti: "), F.col("t")), "codice_causale"),
        _anomaly(flagged, 8, "codice_causale_sospetto", "warning", F.concat(F.lit("Codici sospetti: "), F.array_join(F.transform("s", lambda x: quoted(x["codice"])), ", ")), "codice_causale"),
    )


def rule_iban(totals: DataFrame) -> DataFrame:
    """totals: doc_id, template, iban, iban_original, repaired."""
    bad = totals.where(F.col("template").isin("c", "s") & F.col("iban").isNotNull() & ~I.iban_mod97_valid(F.col("iban")))
    return _union(
        _anomaly(totals.where("repaired"), 9, "iban_corretto_automaticamente", "warning", F.concat(F.lit("IBAN corretto: "), quoted(F.col("iban_original")), F.lit(" -> "), quoted(F.col("iban"))), "iban"),
        _anomaly(bad, 9, "iban_non_valido", "warning", F.concat(F.lit("IBAN con checksum errato: "), quoted(F.col("iban"))), "iban"),
    )


def rule_reconstructed(docs: DataFrame) -> DataFrame:
    """docs: doc_id, template, recovered (whether any page was rebuilt from characters)."""
    return _anomaly(docs.where("recovered and template in ('c', 's')"), 10, "testo_ricostruito", "warning", "Testo ricostruito dai caratteri", "raw_extraction")


def rule_missing_totals(totals: DataFrame) -> DataFrame:
    missing = F.array_join(F.filter(F.array(F.when(F.col("netto_mese").isNull(), "netto_mese"), F.when(F.col("iban").isNull(), "iban")), lambda x: x.isNotNull()), ", ")
    rows = totals.where("template <> 'unknown' and (netto_mese is null or iban is null)")
    return _anomaly(rows, 11, "totali_mancanti", "error", F.concat(F.lit("Totali mancanti: "), missing), missing)


def rule_format(docs: DataFrame, totals: DataFrame) -> DataFrame:
    cf = docs.where((F.col("codice_fiscale") != "") & ~I.cf_format(F.col("codice_fiscale")))
    acct = totals.where(F.col("iban").isNotNull() & ~I.iban_format(F.col("iban")))
    return _union(
        _anomaly(cf, 12, "formato_non_valido", "warning", F.concat(F.lit("Codice fiscale con formato non valido: "), quoted(F.col("codice_fiscale"))), "codice_fiscale"),
        _anomaly(acct, 13, "formato_non_valido", "warning", F.concat(F.lit("IBAN con formato non valido: "), quoted(F.col("iban"))), "iban"),
    )


def rule_no_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    return _anomaly(docs.join(lines.select("doc_id").hint("merge"), "doc_id", "left_anti"), 14, "nessuna_riga_voce", "warning", "Nessuna riga voce", "pay_lines")


def rule_net(totals: DataFrame, tol: str = "1.50") -> DataFrame:
    """Where earnings, deductions and net are all there: earnings - deductions within tol of net."""
    want = F.col("totale_competenze") - F.col("totale_trattenute")
    off = totals.where(F.abs(want - F.col("netto_mese")) > F.lit(tol).cast("decimal(14,5)"))
    two = lambda c: c.cast("decimal(14,2)").cast("string")
    return _anomaly(off, 15, "quadratura_netto", "warning", F.concat(F.lit("Netto atteso "), two(want), F.lit(", trovato "), two(F.col("netto_mese"))), "netto_mese")


def all_anomalies(*parts: DataFrame) -> DataFrame:
    """Anomalies of all rules; rule_no gives their order within a document."""
    return _union(*parts)


def determine_status(docs: DataFrame, anomalies: DataFrame) -> DataFrame:
    """doc_id, status, anomalies: an error needs review, any other anomaly is told, none is processed."""
    per = anomalies.groupBy("doc_id").agg(F.bool_or(F.col("severita") == "error").alias("e"), F.count(F.lit(1)).alias("n"))
    out = docs.select("doc_id").join(per.hint("merge"), "doc_id", "left")
    return out.select("doc_id", F.when(F.col("e"), "NEEDS_REVIEW").when(F.col("n") > 0, "PROCESSED_WITH_ANOMALIES").otherwise("PROCESSED").alias("status"), F.coalesce("n", F.lit(0)).cast("int").alias("anomalies"))
