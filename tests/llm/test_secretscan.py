"""Secret scans against Python's own matcher, and what the ledger scans and skips."""

import hashlib
import re

from pyspark.sql import functions as F

from wagebook.llm import secretscan
from wagebook.llm.common import scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
KINDS = [("assign", r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12), ("access", r"AKIA[A-Z0-9]+", 18, 0), ("hex", r"[0-9a-f]+", 16, 0), ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 1, 0)]
TEXTS = [
    "Password: abcdefghijkl and secret=token: abcdefghijklmnop", "token=token=abcdefghijkl", "API_KEY = 'AbC-_/+=.0123456789'; apikey=short", "token== abcdefghijklmnop", "key AKIA" + "A1" * 7, "AKIA" + "A" * 13, "xAKIAAKIA" + "B" * 14 + " AKIAé",
    "deadbeefdeadbee", "é🎉 deadbeefdeadbeef0 🎉deadbeefdeadbeef", "passwd" + " " * 3000 + "=" + "0123456789abcdef" * 2, "-----BEGIN RSA PRIVATE KEY-----\nab", "", None, "deadbeefdeadbeef " * 30_000, 'secret":"AKIA' + "Z" * 20 + '"', "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop", "secret\n=abcdefghijklmnop",
]


def plain(text):
    text, per = text or "", {}
    for k, (kind, pattern, least, value) in enumerate(KINDS):
        found = [m for m in re.finditer(pattern, text) if len(m[0]) >= least and (not value or len(m[2]) >= value)]
        per[kind] = [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in found]
    text_of = lambda kinds: ",".join(x[2] for x in sorted(y for k in kinds for y in per[k]))
    base = text_of(["assign", "access", "hex"])
    return len(per["assign"]), len(per["access"]), len(per["hex"]), hashlib.sha256(base.encode()).hexdigest(), text_of(per), hashlib.sha256(text.encode()).hexdigest()


def test_as_plain(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], None, None, None), (0, TEXTS[0], "en", "s", 1)] + [(100 + i, TEXTS[8], "en", "s", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("clash") for c in ("blob", "salt", "rules", "hits", "spans", "about", "copies", "hex")})
    got = secretscan.query(spark, docs)
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(map(tuple, got.collect()), key=order) == sorted([(r[0], *plain(r[1])) for r in rows], key=order)
    assert secretscan.query(spark, docs.where("false")).count() == 0


def test_only_unseen_pairs_are_scanned(spark):
    place, history = scratch(spark), "path string, version int, text string"
    first = spark.createDataFrame([("a", 1, "token=abcdefghijkl"), ("a", 2, "plain"), ("b", 1, "token=abcdefghijkl")], history)
    one = secretscan.Ledger(spark, "ledger_one", place)
    got = secretscan.scan_history(first, one, secretscan.BASE, ("path", "version")).collect()
    assert sorted((r.path, r.version, len(r.assign)) for r in got) == [("a", 1, 1), ("a", 2, 0), ("b", 1, 1)]
    assert one.rows().count() == 2 * 3  # two blobs, three rules
    one.forget()
    two = secretscan.Ledger(spark, "ledger_two", place)  # found by its path
    second = first.union(spark.createDataFrame([("b", 2, "-----BEGIN PRIVATE KEY-----")], history))
    texts = second.select(F.sha2("text", 256).alias("blob"), "text")
    assert [r.rules for r in two.unseen(texts, secretscan.BASE).collect()] == [["assign/1", "access/1", "hex/1"]]
    secretscan.scan_history(second, two, secretscan.BASE, ("path", "version"))
    assert two.rows().count() == 3 * 3
    assert {tuple(r.rules) for r in two.unseen(texts, secretscan.BASE + secretscan.ADDED).collect()} == {("pem/1",)}
    got = secretscan.scan_history(second, two, about=("path", "version")).collect()
    assert sorted((r.path, r.version, len(r.assign), len(r.pem)) for r in got) == [("a", 1, 1, 0), ("a", 2, 0, 0), ("b", 1, 1, 0), ("b", 2, 0, 1)]
    assert two.rows().count() == 3 * 4 and two.unseen(texts, secretscan.BASE + secretscan.ADDED).count() == 0
    two.forget()


def test_no_python(spark):
    docs = spark.createDataFrame([(1, "t", "en", "s", 1)], SCHEMA)
    ledger = secretscan.new_ledger(spark)
    plan = secretscan.scanned(ledger.unseen(docs.select(F.sha2("text", 256).alias("blob"), "text"), secretscan.BASE), secretscan.BASE)
    assert not any(w in plan._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Arrow", "Pandas"))
