"""Mixing sources to target weights by a hierarchical budget.

The sources form a tree (domain, language, source). A token budget goes from the root down: children share it by weight,
and what a child's subtree cannot fill goes to its siblings; only what all children of a node together cannot fill goes
to the node's own siblings. A leaf then takes whole passes (epochs) over its documents, and of the next epoch the
longest prefix that its budget allows. The order of an epoch is a hash of seed, epoch and id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wagebook.llm.common import attached, dealt, grouped, running_starts, written

SEP = "\x1f"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _weight(path: list[str], weights: dict[tuple, float]) -> Column:
    given = {p: w for p, w in weights.items() if len(p) == len(path)}
    out = F.lit(1.0)
    if given:
        flat = [x for p, w in given.items() for x in (F.lit(SEP.join(p)), F.lit(float(w)))]
        out = F.coalesce(F.try_element_at(F.create_map(*flat), F.concat_ws(SEP, *path)), out)
    return out


def budgets(leaves: DataFrame, tree: list[str], weights: dict[tuple, float], share: float, max_epochs: int) -> DataFrame:
    """leaves: tree columns (not null), tokens, ... -> leaves with budget, in tokens.

    weights: tree path -> weight among its siblings, 1 where none is given; 0 leaves the subtree out. The whole budget is
    share of all tokens, or what max_epochs passes over everything hold if that is less. Children of one node are
    handled together: their number is that of the groups, not of the documents.
    """
    caps = leaves.withColumn("cap_3", F.when(_weight(tree, weights) > 0, F.col("tokens") * F.lit(float(max_epochs))).otherwise(0.0))
    level = {len(tree): caps.select(*tree, "cap_3")}
    for k in range(len(tree) - 1, 0, -1):
        up = level[k + 1].groupBy(*tree[:k]).agg(F.sum(f"cap_{k + 1}").alias("c"))
        level[k] = up.select(*tree[:k], F.when(_weight(tree[:k], weights) > 0, F.col("c")).otherwise(0.0).alias(f"cap_{k}"))
    root = level[1].agg(F.sum("cap_1").alias("c"))
    have = leaves.agg(F.sum("tokens").alias("t"))
    total = min(float(root.first()["c"] or 0), float(int((have.first()["t"] or 0) * share)))
    given = level[1].withColumn("given", F.lit(total))
    for k in range(1, len(tree) + 1):
        w, c, parent = _weight(tree[:k], weights), F.col(f"cap_{k}"), tree[: k - 1]
        nodes = given.withColumn("w", w).withColumn("ratio", F.when(F.col("w") > 0, c / F.col("w")).otherwise(F.lit(float("inf"))))
        order = Window.partitionBy(*(parent or [F.lit(0)])).orderBy("ratio", tree[k - 1])
        before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
        level_of = (F.col("given") - F.coalesce(F.sum(c).over(before), F.lit(0.0))) / F.sum("w").over(after)
        nodes = nodes.withColumn("level", F.when(F.col("w") > 0, level_of))
        over = Window.partitionBy(*(parent or [F.lit(0)]))
        rate = F.max("level").over(over)  # it rises up to the first child that is not filled, then falls
        nodes = nodes.withColumn("rate", rate).withColumn("budget", F.when(F.col("w") > 0, F.least(c, F.col("w") * F.col("rate"))).otherwise(0.0))
        if k < len(tree):
            given = level[k + 1].join(nodes.select(*tree[:k], F.col("budget").alias("given")), tree[:k])
        else:
            given = nodes.select(*tree, F.floor("budget").cast("long").alias("budget"))
    return leaves.join(given, tree)


def mixed(docs: DataFrame, tree: list[str], weights: dict[tuple, float], share: float, max_epochs: int, seed: int = 9, id_col: str = "doc_id", parts: int = 4096) -> DataFrame:
    """docs (id_col, tree columns, tokens): each row with epochs, the number of passes that take it (0: left out).

    Null tree values count as the empty string. Documents without tokens cost nothing; they go with their place in the
    order. Rows that repeat an id, null ids too, follow each other and each count. A leaf's documents are dealt by hash
    into parts, of which only sums are carried on; the prefix ends within one part. No rows give no rows. The children
    of one tree node meet in one task, so a tree suits sources by the thousand, not hosts by the million.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in tree]
    rows = docs.select(F.col(id_col).alias("id"), *names, "tokens").withColumn("leaf", F.concat_ws(SEP, *tree))
    rows = written(dealt(rows))
    sums = {"tokens": (F.sum("tokens"), F.sum), **{c: (F.min(c), F.min) for c in tree}}
    leaves = written(budgets(written(grouped(rows, "leaf", sums)), tree, weights, share, max_epochs))
    passes = F.when(F.col("tokens") > 0, F.least(F.lit(max_epochs), F.floor(F.col("budget") / F.col("tokens")))).otherwise(F.lit(0)).cast("int")
    plan = leaves.select("leaf", "salts", "budget", passes.alias("passes"), (F.col("budget") - passes * F.col("tokens")).alias("rest"))
    drawn = attached(rows, plan, "leaf").withColumn("rest", F.when(F.col("passes") < max_epochs, F.col("rest")).otherwise(-1))
    drawn = drawn.withColumn("h", F.md5(F.concat_ws("/", F.lit(str(seed)), F.col("passes"), F.col("id")).cast("binary")))
    drawn = written(drawn.withColumn("part", F.conv(F.substring("h", 1, 3), 16, 10).cast("int") % parts))
    starts = running_starts(drawn.groupBy("leaf", "part").agg(F.sum("tokens").alias("n")), "leaf", "part", "n", "start")
    run = F.sum("tokens").over(Window.partitionBy("leaf", "part").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0))
    out = drawn.join(starts, ["leaf", "part"]).withColumn("taken", (F.col("start") + run <= F.col("rest")).cast("int"))
    return out.select(F.col("id").alias(id_col), *tree, "tokens", "budget", (F.col("passes") + F.col("taken")).alias("epochs"))


#: Parameters of the registered query and of the pipeline: source -> domain for sources that are not of the web.
DOMAINS = {**{f"src{k}": "forum" for k in range(10, 15)}, **{f"src{k}": "reference" for k in range(15, 20)}}
TREE = ["domain", "lang", "source"]
WEIGHTS = {("web",): 5.0, ("forum",): 2.0, ("reference",): 3.0} | {(d, g): w for d in ("web", "forum", "reference") for g, w in (("en", 4.0), ("de", 2.0), ("fr", 2.0), ("es", 2.0))}


def with_tree(docs: DataFrame) -> DataFrame:
    domain = F.lit("web")
    for d in sorted(set(DOMAINS.values())):
        domain = F.when(F.col("source").isin([s for s, x in DOMAINS.items() if x == d]), d).otherwise(domain)
    return docs.select("doc_id", domain.alias("domain"), "lang", "source", words(F.col("text")).alias("tokens"))


def query(spark, docs: DataFrame) -> DataFrame:
    return mixed(with_tree(docs), TREE, WEIGHTS, 0.8, 3).select("doc_id", *TREE, "tokens", "budget", "epochs")


def keep_mix(docs: DataFrame, share: float = 0.9) -> DataFrame:
    """docs of the mix, each once at most; columns as they came. Rows that repeat a doc_id share one fate if they can."""
    taken = mixed(with_tree(docs), TREE, WEIGHTS, share, 1).where("epochs > 0").select(F.col("doc_id").alias("id")).distinct()
    return docs.join(taken, docs["doc_id"].eqNullSafe(taken["id"]), "left_semi")


def _fill(k: int, given: str) -> str:
    cols, parent = ", ".join(TREE[:k]), ", ".join(TREE[: k - 1])
    part = f"PARTITION BY {parent}" if parent else ""
    order = f"{part} ORDER BY ratio, {TREE[k - 1]}"
    return f"""
a{k} AS (SELECT *, CASE WHEN w > 0 THEN cap / w ELSE CAST('inf' AS DOUBLE) END AS ratio FROM ({given})),
b{k} AS (SELECT *, CASE WHEN w > 0 THEN (given - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
              / sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS level FROM a{k}),
c{k} AS (SELECT *, max(level) OVER ({part}) AS rate FROM b{k}),
d{k} AS (SELECT {cols}, CASE WHEN w > 0 THEN least(cap, w * rate) ELSE 0.0 END AS budget FROM c{k})"""


def oracle() -> str:
    cases = " ".join(f"WHEN source IN ({', '.join(repr(s) for s, x in DOMAINS.items() if x == d)}) THEN '{d}'" for d in sorted(set(DOMAINS.values())))
    w1 = " ".join(f"WHEN domain = '{p[0]}' THEN {w}" for p, w in WEIGHTS.items() if len(p) == 1)
    w2 = " ".join(f"WHEN domain = '{p[0]}' AND lang = '{p[1]}' THEN {w}" for p, w in WEIGHTS.items() if len(p) == 2)
    w1, w2 = f"CASE {w1} ELSE 1.0 END", f"CASE {w2} ELSE 1.0 END"
    return rf"""
WITH r AS (SELECT doc_id, CASE {cases} ELSE 'web' END AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             CAST(length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM r GROUP BY 1, 2, 3),
l3 AS (SELECT *, tokens * 3.0::DOUBLE AS cap FROM leaf),
l2 AS (SELECT domain, lang, sum(cap) AS cap FROM l3 GROUP BY 1, 2),
l1 AS (SELECT domain, sum(cap) AS cap FROM l2 GROUP BY 1),
t AS (SELECT least((SELECT sum(cap) FROM l1), CAST(floor((SELECT sum(tokens) FROM leaf) * 0.8::DOUBLE) AS DOUBLE)) AS total),
{_fill(1, f"SELECT domain, cap, total AS given, CAST({w1} AS DOUBLE) AS w FROM l1, t")},
{_fill(2, f"SELECT l2.*, d1.budget AS given, CAST({w2} AS DOUBLE) AS w FROM l2 JOIN d1 USING (domain)")},
{_fill(3, "SELECT l3.*, d2.budget AS given, 1.0::DOUBLE AS w FROM l3 JOIN d2 USING (domain, lang)")},
b AS (SELECT domain, lang, source, leaf.tokens AS leaf_tokens, CAST(floor(d3.budget) AS BIGINT) AS budget FROM leaf JOIN d3 USING (domain, lang, source)),
p AS (SELECT *, CASE WHEN leaf_tokens > 0 THEN least(3, budget // leaf_tokens) ELSE 0 END AS passes FROM b),
o AS (SELECT r.*, p.budget, p.passes, CASE WHEN passes < 3 THEN budget - passes * leaf_tokens ELSE -1 END AS rest,
             md5('9/' || passes || coalesce('/' || doc_id, '')) AS h FROM r JOIN p USING (domain, lang, source)),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT doc_id, domain, lang, source, tokens, budget, CAST(passes + CASE WHEN run <= rest THEN 1 ELSE 0 END AS INTEGER) AS epochs FROM c
"""


SQL = oracle()
