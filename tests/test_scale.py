"""Findings of round 3: what a step costs, and that it gives what the plain one gives."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from wagebook.functions import ids as I
from wagebook.operators import documents as D
from wagebook.operators import pages as P
from wagebook.plans import common as K
from wagebook.plans import process
from wagebook.sources.files import stored


def _mod97(text: str) -> bool:
    turned = (text[4:] + text[:4]).upper()
    if not turned or not turned.isascii() or not turned.isalnum():
        return False
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def test_checksum_of_texts_of_any_length(spark):
    texts = ["", "IT", "IT60X0542811101000000123456", "it60x0542811101000000123456", "IT60X05428111010000001234è6", "IT60 0542811101000000123456", "GB82WEST12345698765432", None]
    for n in (1, 17, 18, 19, 27, 35, 36, 37, 72, 73, 200):
        texts += [("ZX9" * n)[:n], ("0123456789" * n)[:n], *[("A1" * n)[: n - 1] + c for c in "0123456789ABCXYZ"]]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", I.iban_mod97_valid(F.col("t")).alias("ok")).collect()
    assert [(r.t, r.ok) for r in got] == [(t, t is not None and _mod97(t)) for t in texts]
    assert any(r.ok for r in got)


def test_checksums_take_microseconds(spark):
    iban = F.concat(F.lit("IT"), F.lpad((F.col("id") % 97).cast("string"), 2, "0"), F.lit("00542811101"), F.lpad(F.col("id").cast("string"), 12, "0"))
    rows = spark.range(0, 60_000, 1, 1).select(I.recover_iban(iban).alias("r"))
    rows.limit(10).collect()
    began = time.time()
    assert rows.where("r.repaired").count() > 100
    assert time.time() - began < 15


SF = "/root/testdata/sf0.001"


def test_texts_of_rows_are_those_of_prepared(spark):
    data = [("a", 1, i, t, 30.0 + i, 31.0 + i, 10.0 * (i // 3), 5.0) for i, t in enumerate(["Società", "SASSO", None, None, None, None, "s", "S", "", "(1.234,56)", "ß", "İx", "a b", "13-ESIMA", "Imp.Fisc.Annuo", " x"])]
    words = spark.createDataFrame([*data, ("b", 1, 0, None, 30.0, 40.0, 1.0, 2.0)], "doc_id string, page int, seq int, text string, x0 double, x1 double, top double, bottom double")
    docs = P.whole(words).withColumn("template", F.lit("z"))
    plain, fast = D.prepared(P.document_rows(docs.drop("template"))), P.document_rows(docs, texts=True)
    cols = ["doc_id", "doc_row", "text", "norm", "compact", "words"]
    assert sorted(map(str, fast.select(*cols).collect())) == sorted(map(str, plain.select(*cols).collect()))
    assert {r.template for r in fast.collect()} == {"z"}


def test_documents_given_whole_are_parsed_as_their_words(spark):
    """Words need not come one by one, so none is exchanged; the last table holds all words and texts."""
    docs = K.documents(spark, SF).where(F.col("doc_id").cast("long") % 40 < 3)
    one, all_ = process.parse_words(docs.select("doc_id", F.explode("words").alias("w")).select("doc_id", "w.*")), process.parse_words(docs)
    for name in ("docs", "lines", "totals", "raw"):
        a, b = (sorted(map(str, getattr(p, name).collect())) for p in (one, all_))
        assert a == b and len(a) > 50, name


def test_rows_that_lie_by_key_are_stored_without_exchange(spark):
    docs = stored(K.documents(spark, SF), key="doc_id")
    made = P.document_rows(docs.join(docs.select("doc_id").distinct().hint("merge"), "doc_id"))
    kept = stored(made, key="doc_id", lies=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(kept.inputFiles()) <= n and kept.count() == made.count()
    assert "Exchange" not in kept.groupBy("doc_id").count()._jdf.queryExecution().executedPlan().toString()
    assert kept.groupBy("doc_id").agg(F.max("doc_row").alias("m"), F.count("doc_row").alias("n")).where("m <> n").count() == 0


def test_amount_below_label_sorts_no_words(spark):
    """The label and the amounts are found in a document's own words: no join."""
    docs = K.documents(spark, SF, 2)
    below = D.amount_below_label(docs, "NETTO")
    words = docs.select("doc_id", F.explode("words").alias("w")).select("doc_id", "w.*")
    assert sorted(map(str, D.amount_below_label(words, "NETTO").collect())) == sorted(map(str, below.collect()))
    assert below._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == docs._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")
