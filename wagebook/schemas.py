"""Schemas of the input tables and of the relational model, in import order."""

from __future__ import annotations

WORDS = "doc_id string, page int, seq int, text string, x0 double, x1 double, top double, bottom double"

_DEC = "decimal(14,5)"
#: Table -> columns; a column marked ! is never null. The order is safe for foreign keys.
TABLES: dict[str, str] = {
    "company": "id! string, ragione_sociale! string, indirizzo string, codice_azienda string, inail_aut string, inail_del string, inail_sede string, posizione_inps string, pat_inail string, created_at timestamp",
    "employee": "id! string, cognome_nome! string, codice_fiscale! string, created_at timestamp",
    "employment": "id! string, employee_id! string, company_id! string, matricola string, data_assunzione date, data_cessazione date, valid_from! date, valid_to date",
    "payroll_period": "id! string, mese! int, anno! int, tipo! string, label_originale string",
    "payroll_document": "id! string, sha256! string, original_filename! string, status! string, template_name! string, parser_version! string, source_used_ocr! boolean, processed_path string, error_path string, employee_id string, company_id string, period_id string, hire_date date, created_at timestamp, updated_at timestamp",
    "pay_line": f"id! string, document_id! string, codice_causale string, descrizione! string, categoria! string, is_recognized! boolean, importo_base {_DEC}, quantita {_DEC}, unita string, aliquota {_DEC}, trattenuta {_DEC}, competenza {_DEC}, raw_text! string, note string",
    "tax": "id! string, document_id! string, " + ", ".join(f"{c} {_DEC}" for c in ("imponibile_irpef", "irpef_lorda", "detrazioni_lav_dip", "ritenute_irpef", "imponibile_previdenziale_non_arrotondato", "addizionale_regionale")) + ", addizionale_regionale_regione string, " + ", ".join(f"{c} {_DEC}" for c in ("addizionale_comunale", "acconto_addizionale_comunale", "imponibile_fiscale_annuo", "imposta_lorda_annua", "imposta_dovuta_annua", "imposta_pagata_annua", "imp_inps_progr_annuo", "ctr_inps_progr_annuo", "ctr_dip_inps_progr_annuo", "cong_credito_annuo", "cong_debito_annuo")),
    "tfr": "id! string, document_id! string, " + ", ".join(f"{c} {_DEC}" for c in ("retribuzione_utile_tfr", "quota_tfr_fondi", "rivalutazione", "imponibile_rivalutazione", "quota_anno", "anticipi", "retribuzione_utile_tfr_annua")),
    "leave_balance": f"id! string, document_id! string, tipo! string, maturato {_DEC}, goduto {_DEC}, residuo {_DEC}, residuo_ap {_DEC}",
    "payroll_totals": "id! string, document_id! string, " + ", ".join(f"{c} {_DEC}" for c in ("imponibile_inps", "imponibile_inail", "imponibile_irpef", "totale_competenze", "totale_trattenute", "netto_mese")) + ", iban string, banca string",
    "anomaly": "id! string, document_id! string, tipo! string, severita! string, messaggio! string, campo string, created_at timestamp",
    "raw_extraction": "id! string, document_id! string, full_text! string, words! array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>, unrecognized_rows! array<string>, font_metadata map<string,string>, ocr_used boolean",
    "audit_event": "id! string, document_id string, run_id! string, event_type! string, detail struct<status:string,anomalies:int>, created_at timestamp",
}
VERSION = "1.0.0"
CHILDREN = ["pay_line", "tax", "tfr", "leave_balance", "payroll_totals", "anomaly", "raw_extraction", "audit_event"]
ONE_PER_DOCUMENT = ["tax", "tfr", "payroll_totals", "raw_extraction"]
#: Longest text of each column.
LENGTHS = {
    ("company", "ragione_sociale"): 255, ("company", "indirizzo"): 255, ("company", "codice_azienda"): 32, ("company", "inail_aut"): 32, ("company", "inail_del"): 32,
    ("company", "inail_sede"): 32, ("company", "posizione_inps"): 64, ("company", "pat_inail"): 64, ("employee", "cognome_nome"): 255, ("employee", "codice_fiscale"): 16,
    ("employment", "matricola"): 32, ("payroll_period", "tipo"): 32, ("payroll_period", "label_originale"): 64,
    ("payroll_document", "sha256"): 64, ("payroll_document", "original_filename"): 255, ("payroll_document", "status"): 32, ("payroll_document", "template_name"): 64,
    ("payroll_document", "parser_version"): 32, ("payroll_document", "processed_path"): 512, ("payroll_document", "error_path"): 512,
    ("pay_line", "codice_causale"): 16, ("pay_line", "descrizione"): 255, ("pay_line", "categoria"): 32, ("pay_line", "unita"): 8, ("tax", "addizionale_regionale_regione"): 64,
    ("leave_balance", "tipo"): 32, ("payroll_totals", "iban"): 34, ("payroll_totals", "banca"): 255, ("anomaly", "tipo"): 64, ("anomaly", "severita"): 16, ("anomaly", "campo"): 64,
    ("audit_event", "run_id"): 64, ("audit_event", "event_type"): 64,
}


def columns(table: str) -> list[tuple[str, str, bool]]:
    """(name, type, required) of each column."""
    out, depth, part = [], 0, ""
    for c in TABLES[table] + ",":
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            name, kind = part.strip().split(" ", 1)
            out.append((name.rstrip("!"), kind, name.endswith("!")))
            part = ""
        else:
            part += c
    return out


def ddl(table: str, as_text: bool = False) -> str:
    """Schema for createDataFrame or readers. as_text: decimals, dates and timestamps as strings, as bundles hold them."""
    return ddl_of(columns(table), as_text)


def ddl_of(cols: list[tuple[str, str, bool]], as_text: bool = False) -> str:
    kinds = {"date": "string", "timestamp": "string", _DEC: "string"} if as_text else {}
    return ", ".join(f"{n} {kinds.get(k, k)}" for n, k, _ in cols)
