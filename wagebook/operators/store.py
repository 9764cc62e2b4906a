"""Dedup, dimensions, facts, deletes and audits over the relational model, as joins that never overload one key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wagebook import schemas
from wagebook.operators.skew import counted, joined
from wagebook.sources.files import stored
from wagebook.sources.registry import Registry, known

OK = ["PROCESSED", "PROCESSED_WITH_ANOMALIES"]


def key_id(*cols: str | Column) -> Column:
    """Identifier of a natural key; a null part differs from an empty one."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-")) for c in parts]), 256)


def skip_known(files: DataFrame, registry: Registry | DataFrame, besides: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(new, skipped) files by sha256: those stored with a good outcome are skipped. A file without a hash is new.

    The registry meets each hash of files once, and is not exchanged where it is a Registry; a hash that very many files
    have is dealt over several tasks. besides: a batch of the registry that does not count.
    """
    met = joined(files.where("sha256 is not null"), known(files, registry, OK, besides), "sha256", F.col("filename"))
    new = met.where(~F.col("done")).select(*files.columns).unionByName(files.where("sha256 is null"))
    return new, met.where("done").select(*files.columns)


def dedup_batch(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped) of outcomes (sha256, filename, status) in filename order. Of a sha256 the first file with a good
    outcome is kept and all good ones after it are skipped. Where none is good, the last that needs review replaces those
    before it (neither kept nor skipped). A file that comes before the good one and needs review is replaced by it; one
    that comes after is skipped, as it is not read again. Failures before the good file all stay; those after are skipped.

    Copies are ranked by aggregation, not by a window; only a file with very many copies has its ranks copied.
    """
    good, review = F.col("status").isin(OK), F.col("status") == "NEEDS_REVIEW"
    per = stored(counted(outcomes, "sha256", {"first": F.min(F.when(good, F.col("filename"))), "last": F.max(F.when(review, F.col("filename")))}))
    o = joined(outcomes, per, "sha256", F.col("filename"))
    after = F.coalesce(F.col("filename") > F.col("first"), F.lit(False))
    keep = ~after & F.when(good, True).when(review, F.col("first").isNull() & (F.col("filename") == F.col("last"))).otherwise(True)
    return o.where(keep).select(*outcomes.columns), o.where(after).select(*outcomes.columns)


def replace_documents(tables: dict[str, DataFrame], ids: DataFrame, new: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """tables without the documents in ids (document_id) and all that hangs on them, then with the rows of new."""
    out = {}
    for name, df in tables.items():
        key = "id" if name == "payroll_document" else "document_id" if name in schemas.CHILDREN else None
        if key:
            df = df.join(ids.select(F.col("document_id").alias(key)), key, "left_anti").select(*df.columns)
        out[name] = df.unionByName(new[name]) if new and name in new else df
    return out


def _new_rows(dim: DataFrame, docs: DataFrame, key: list[str], first: list[str], order: Column) -> DataFrame:
    """First-seen attributes of the keys in docs that dim lacks; keys compare null-safe."""
    seen = docs.groupBy(*key).agg(F.min_by(F.struct(*[F.col(c) for c in first]) if first else F.lit(1), order).alias("f"), F.min(order).alias("o"))
    have = dim.select(*[F.col(c).alias(f"_{c}") for c in key])
    return seen.join(have, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]), "left_anti")


ORDER = ["run_ts", "filename"]


def _order() -> Column:
    return F.struct(*ORDER)


def new_companies(dim: DataFrame, docs: DataFrame) -> DataFrame:
    """The companies of docs that dim lacks, by (ragione_sociale, codice_azienda); what was seen first stays.

    docs also carry run_ts and filename, which say what came first. Blank names are no company."""
    extra = ["indirizzo", "inail_aut", "inail_del", "inail_sede", "posizione_inps", "pat_inail"]
    new = _new_rows(dim, docs.where("coalesce(ragione_sociale, '') <> ''"), ["ragione_sociale", "codice_azienda"], extra, _order())
    return new.select(key_id("ragione_sociale", "codice_azienda").alias("id"), "ragione_sociale", "f.indirizzo", "codice_azienda", *[f"f.{c}" for c in extra[1:]], F.col("o.run_ts").alias("created_at"))


def upsert_company(dim: DataFrame, docs: DataFrame) -> DataFrame:
    return dim.unionByName(new_companies(dim, docs))


def new_employees(dim: DataFrame, docs: DataFrame) -> DataFrame:
    new = _new_rows(dim, docs.where("coalesce(codice_fiscale, '') <> ''"), ["codice_fiscale"], ["cognome_nome"], _order())
    return new.select(key_id("codice_fiscale").alias("id"), "f.cognome_nome", "codice_fiscale", F.col("o.run_ts").alias("created_at"))


def upsert_employee(dim: DataFrame, docs: DataFrame) -> DataFrame:
    return dim.unionByName(new_employees(dim, docs))


def employment_changes(dim: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dim as docs leave it, new rows). One employment per employee and company. Without a hire date it begins at 1970-01-01; the first date seen, now or
    later, fills that in. docs: employee_id, company_id, hire_date, run_ts, filename."""
    sentinel = F.lit("1970-01-01").cast("date")
    key = ["employee_id", "company_id"]
    seen = docs.where("employee_id is not null and company_id is not null").groupBy(*key).agg(F.min_by("hire_date", F.when(F.col("hire_date").isNotNull(), _order())).alias("hired"))
    old = dim.join(seen, key, "left").withColumn("data_assunzione", F.coalesce("data_assunzione", "hired"))
    old = old.withColumn("valid_from", F.when(F.col("valid_from") == sentinel, F.coalesce("hired", F.lit(sentinel))).otherwise(F.col("valid_from"))).select(*dim.columns)
    new = seen.join(dim.select(*key), key, "left_anti")
    null = lambda t: F.lit(None).cast(t)
    rows = new.select(key_id(*key).alias("id"), *key, null("string").alias("matricola"), F.col("hired").alias("data_assunzione"), null("date").alias("data_cessazione"), F.coalesce("hired", sentinel).alias("valid_from"), null("date").alias("valid_to"))
    return old, rows


def upsert_employment(dim: DataFrame, docs: DataFrame) -> DataFrame:
    old, rows = employment_changes(dim, docs)
    return old.unionByName(rows)


def new_periods(dim: DataFrame, docs: DataFrame) -> DataFrame:
    new = _new_rows(dim, docs.where("coalesce(mese, 0) <> 0"), ["mese", "anno", "tipo"], ["label"], _order())
    return new.select(key_id("mese", "anno", "tipo").alias("id"), "mese", "anno", "tipo", F.col("f.label").alias("label_originale"))


def upsert_period(dim: DataFrame, docs: DataFrame) -> DataFrame:
    return dim.unionByName(new_periods(dim, docs))


def document_fact(docs: DataFrame) -> DataFrame:
    """docs with id, employee_id, company_id and period_id. Identifiers are hashes of natural keys, so no dimension need be
    joined; blank keys give null."""
    return docs.withColumns({
        "id": key_id("sha256"),
        "employee_id": F.when(F.coalesce("codice_fiscale", F.lit("")) != "", key_id("codice_fiscale")),
        "company_id": F.when(F.coalesce("ragione_sociale", F.lit("")) != "", key_id("ragione_sociale", "codice_azienda")),
        "period_id": F.when(F.coalesce("mese", F.lit(0)) != 0, key_id("mese", "anno", "tipo")),
    })


LOGICAL = ["employee_id", "company_id", "period_id"]


def logical_key_conflicts(docs: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok, failed) documents: one per employee, company and period, stored ones first, then by filename. A null in the key
    exempts a document; such rows are not moved."""
    exempt = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in LOGICAL])
    keyed = docs.where(~exempt)
    first = keyed.groupBy(*LOGICAL).agg(F.min(F.struct("filename", "id")).alias("w"))
    first = first.join(registry.select(*LOGICAL).distinct().withColumn("taken", F.lit(True)), LOGICAL, "left")
    k = keyed.join(first, LOGICAL)
    good = F.col("taken").isNull() & (F.col("id") == F.col("w.id"))
    return k.where(good).select(*docs.columns).unionByName(docs.where(exempt)), k.where(~good).select(*docs.columns)


def child_table(parsed: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """Rows of a child table for stored documents. parsed: doc_id and fields; docs: doc_id, id."""
    rows = parsed.join(docs.select("doc_id", F.col("id").alias("document_id")), "doc_id")
    have = set(rows.columns)
    no = F.lit("") if name in schemas.ONE_PER_DOCUMENT else F.xxhash64(*[c for c in sorted(have) if c not in ("words",)]).cast("string")
    rows = rows.withColumn("id", key_id(F.lit(name), F.col("document_id"), no))
    return rows.select(*[(F.col(c) if c in {*have, "id"} else F.lit(None)).cast(t).alias(c) for c, t, _ in schemas.columns(name)])


def audit_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """table, check, key of each row that breaks a rule: required, length, range, month, severity, one per document, orphan.

    All checks of single rows are made in one pass over a table.
    """
    found = []
    for name, df in tables.items():
        checks = {}
        for c, kind, required in schemas.columns(name):
            if c not in df.columns:
                continue
            if required:
                checks[f"required:{c}"] = F.col(c).isNull()
            if (n := schemas.LENGTHS.get((name, c))) is not None:
                checks[f"length:{c}"] = F.length(c) > n
            if kind.startswith("decimal") and df.schema[c].dataType.simpleString() != kind:
                checks[f"range:{c}"] = F.col(c).isNotNull() & F.col(c).cast("string").try_cast(kind).isNull()
        if name == "payroll_period" and "mese" in df.columns:
            checks["month"] = ~F.col("mese").between(1, 12)
        if name == "anomaly" and "severita" in df.columns:
            checks["severity"] = ~F.col("severita").isin("info", "warning", "error")
        if checks:
            broken = F.filter(F.array(*[F.when(bad, F.lit(k)) for k, bad in checks.items()]), lambda x: x.isNotNull())
            found.append(df.select(F.lit(name).alias("table"), F.explode(broken).alias("check"), F.col("id").cast("string").alias("key")))
        if name in schemas.ONE_PER_DOCUMENT:
            found.append(df.groupBy("document_id").count().where("count > 1").select(F.lit(name).alias("table"), F.lit("one_per_document").alias("check"), F.col("document_id").cast("string").alias("key")))
        if name in schemas.CHILDREN and "payroll_document" in tables:
            orphans = df.where("document_id is not null").join(tables["payroll_document"].select(F.col("id").alias("document_id")), "document_id", "left_anti")
            found.append(orphans.select(F.lit(name).alias("table"), F.lit("orphan").alias("check"), F.col("id").cast("string").alias("key")))
    return reduce(DataFrame.unionByName, found)


def audit_events(docs: DataFrame, run_id: str) -> DataFrame:
    """An event per document (id, status, anomalies, created_at)."""
    return docs.select(key_id(F.lit(run_id), F.col("id")).alias("id"), F.col("id").alias("document_id"), F.lit(run_id).alias("run_id"), F.lit("document_processed").alias("event_type"), F.struct("status", F.col("anomalies").cast("int").alias("anomalies")).alias("detail"), "created_at")


def delete_document(tables: dict[str, DataFrame], *, filename: str | None = None, sha256: str | None = None, doc_id: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables, report). Exactly one of the three says which document goes, with children and audit events. Where several
    fit, the report lists them and nothing is deleted."""
    given = [(c, v) for c, v in (("original_filename", filename), ("sha256", sha256), ("id", doc_id)) if v is not None]
    if len(given) != 1:
        raise ValueError("give exactly one of filename, sha256, doc_id")
    (col, value), docs = given[0], tables["payroll_document"]
    hits = docs.where(F.col(col) == value)
    n = hits.limit(2).count()
    report = hits.select("id", "original_filename", "sha256", "status", F.lit(n == 1).alias("deleted"))
    return (replace_documents(tables, hits.select(F.col("id").alias("document_id"))) if n == 1 else tables), report


def isolate(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """(ok, failed) documents: error (doc-level text or null, any row of a document) fails the whole document alone."""
    bad = df.withColumn("error", error).where("error is not null").groupBy("doc_id").agg(F.min("error").alias("error"))
    return df.join(bad.select("doc_id"), "doc_id", "left_anti"), bad


def destination_path(docs: DataFrame) -> DataFrame:
    """docs with destination: error/, processed/duplicati/ (skipped), processed/<year>/<month>/ or
    processed/non_riconosciuti/, the last two named by sha256 and file."""
    name = F.concat(F.substring("sha256", 1, 8), F.lit("_"), F.col("filename"))
    dated = F.coalesce((F.col("mese") > 0) & (F.col("anno") > 0), F.lit(False))
    path = F.when(F.col("status") == "FAILED", F.concat(F.lit("error/"), F.col("filename"))).when(F.col("status") == "SKIPPED", F.concat(F.lit("processed/duplicati/"), F.col("filename"))).when(dated, F.concat(F.lit("processed/"), F.col("anno").cast("string"), F.lit("/"), F.lpad(F.col("mese").cast("string"), 2, "0"), F.lit("/"), name))
    return docs.withColumn("destination", path.otherwise(F.concat(F.lit("processed/non_riconosciuti/"), name)))


def error_records(failures: DataFrame, run_id: str) -> DataFrame:
    """failures: filename, error_type, message."""
    return failures.select(F.lit(run_id).alias("run_id"), "filename", "error_type", "message")
