"""Secret scans over a history of texts, with an incremental blob ledger.

Every historical version of a path is content-addressed: its text is a blob, named by its SHA-256. The ledger says which blob
was scanned by which version of which rule, and what was found. A run scans only the pairs of blob and rule version that the
ledger lacks, each blob's text once however many paths and versions have it, appends them, and joins the findings back to all
paths. A new rule, or a new version of one, is scanned over old blobs when their texts are given again; all else is skipped.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wagebook.llm.common import attached, dealt, grouped, scratch, written
from wagebook.sources.bucketed import Bucketed


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern. A match stays if it has at least `least` characters, and its group
    `group`, if any, at least `group_least`. A change of any of these is a new version."""

    kind: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0
    group_least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"


#: Fixed values. `hex` and `access` need no check of their length: a shorter run holds no match at all.
BASE = (
    Rule("assign", 1, r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16),
)
#: What the ledger's rules add to the base ones.
ADDED = (Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),)


class Ledger(Bucketed):
    """blob, rule (`kind/version`), spans (start and end of each finding, in code points, end exclusive); one row for each pair
    that was scanned, also where nothing was found. Bucketed and sorted by blob. Scanning a batch twice adds nothing; a run
    that fails midway leaves whole rows or none."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        super().__init__(spark, name, "blob", path, buckets)

    def unseen(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """blobs (blob, text; any number of rows each) to one row for each blob that lacks rules: blob, text, rules.

        Copies are reduced in each task before the exchange by blob; the ledger is not exchanged.
        """
        rows = blobs.groupBy("blob").agg(F.first("text").alias("text"))
        wanted = F.array(*[F.lit(r.key) for r in rules])
        if not self.exists():
            return rows.withColumn("rules", wanted)
        known = self.rows().groupBy("blob").agg(F.collect_set("rule").alias("known")).hint("merge")
        lacks = F.array_except(wanted, F.coalesce("known", F.array().cast("array<string>")))
        return rows.join(known, "blob", "left").select("blob", "text", lacks.alias("rules")).where(F.size("rules") > 0)

    def scan(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> None:
        self.append(scanned(self.unseen(blobs, rules), rules))

    def findings(self, rules: tuple[Rule, ...]) -> DataFrame:
        """One row a blob: blob and, for each rule, its spans under the rule's kind."""
        spans = [F.first(F.when(F.col("rule") == r.key, F.col("spans")), ignorenulls=True).alias(r.kind) for r in rules]
        return self.rows().where(F.col("rule").isin([r.key for r in rules])).groupBy("blob").agg(*spans)


def scanned(unseen: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """unseen (blob, text, rules) to one row for each blob and rule that it lacks: blob, rule, spans.

    Matches alternate with what splitting the text by the same pattern leaves, so sums of lengths give the places. Matches are
    rows of their own while they are summed, within their blob and rule: a text with very many is no longer than itself.
    """
    lacks = lambda r: F.array_contains("rules", r.key)
    found = unseen.select("blob", "text", "rules", *[F.when(lacks(r), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).alias(f"_{k}") for k, r in enumerate(rules)])
    hits = []
    for k, r in enumerate(rules):
        m = F.col(f"_{k}")
        keeps = lambda s, r=r: (F.length(s) >= r.least) & (F.length(F.regexp_extract(s, r.pattern, r.group)) >= r.group_least)
        gaps = F.slice(F.split("text", r.pattern, -1), F.lit(1), F.size(m))
        pairs = F.zip_with(gaps, m, lambda g, s: F.struct(F.length(g).alias("gap"), F.length(s).alias("len"), keeps(s).alias("keep")))
        none = F.array().cast("array<struct<gap:int,len:int,keep:boolean>>")
        hits.append(F.struct(F.lit(r.key).alias("rule"), F.when(m.isNotNull(), F.when(F.size(m) > 0, pairs).otherwise(none)).alias("hits")))
    rows = found.select("blob", F.explode(F.filter(F.array(*hits), lambda h: h["hits"].isNotNull())).alias("h"))
    rows = rows.select("blob", "h.rule", F.posexplode_outer("h.hits").alias("at", "x"))
    end = F.sum(F.col("x.gap") + F.col("x.len")).over(Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    rows = rows.select("blob", "rule", "x.keep", F.struct((end - F.col("x.len")).alias("start"), end.alias("end")).alias("span"))
    return rows.groupBy("blob", "rule").agg(F.sort_array(F.collect_list(F.when(F.col("keep"), F.col("span")))).alias("spans"))


def joined(rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of all spans by start, then by the order of rules, joined by commas."""
    of = lambda k, r: F.transform(r.kind, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), F.lit(r.kind).alias("kind")))
    spans = F.sort_array(F.concat(*[of(k, r) for k, r in enumerate(rules)]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def new_ledger(spark: SparkSession) -> Ledger:
    """An empty ledger in the shared folder, under a name of its own."""
    return Ledger(spark, f"blob_ledger_{uuid.uuid4().hex}", scratch(spark))


def scan_history(history: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = BASE + ADDED, about: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """One row per row of history: its columns `about` (paths, versions), blob, and the spans of each rule under its kind.

    Texts are read whole; a null one is empty, as is what has no findings. Rows that repeat share a blob and each get a row. A
    blob that very many rows have is reduced in each task, scanned once, and its findings meet its rows by salts. Columns of
    about may be null and of any type; other columns are not looked at. No rows give no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = history.select(F.struct(*[F.col(f"`{c}`") for c in about]).alias("about"), F.sha2(text, 256).alias("blob"), text.alias("text"))
    rows = written(dealt(texts.select("about", "blob")))
    ledger.scan(texts.select("blob", "text"), rules)
    groups = grouped(rows, "blob", {"copies": (F.count(F.lit(1)), F.sum)})
    return attached(rows, groups.join(ledger.findings(rules).hint("merge"), "blob"), "blob").select("about.*", "blob", *[r.kind for r in rules])


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    ledger = new_ledger(spark)
    rows = scan_history(docs, ledger)
    out = rows.select("doc_id", *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in BASE], F.sha2(joined(BASE), 256).alias("base_sha256"), joined(BASE + ADDED).alias("spans"), "blob")
    out = written(out)
    ledger.forget()
    return out


def _sql() -> str:
    one = []
    for k, r in enumerate(BASE + ADDED):
        pattern = r.pattern.replace("'", "''")
        one.append(f"SELECT row, {k} AS k, '{r.kind}' AS kind, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps FROM d")
    value = BASE[0].pattern.replace("'", "''")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(one)}),
u AS (SELECT row, k, kind, unnest(ms) AS s, length(unnest(ps[:len(ms)])) AS gap, generate_subscripts(ms, 1) AS nth FROM m WHERE len(ms) > 0),
p AS (SELECT row, k, kind, s, sum(gap + length(s)) OVER (PARTITION BY row, k ORDER BY nth) AS stop FROM u),
f AS (SELECT row, k, kind, stop - length(s) AS start, kind || ':' || (stop - length(s))::BIGINT || ':' || stop::BIGINT AS span FROM p
  WHERE k <> 0 OR length(regexp_extract(s, '{value}', 2)) >= 12),
g AS (SELECT row, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(span, ',' ORDER BY start, k) FILTER (k < 3) AS base, string_agg(span, ',' ORDER BY start, k) AS spans FROM f GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob FROM d LEFT JOIN g USING (row)
"""


SQL = _sql()
