"""Merkle manifest of a dataset: a root over all groups, a root for each group, and a proof for each row.

Rows are ranked within their group. The base-8 digits of a rank say where its leaf hangs: four digits make a block of at most
4,096 leaves. Within a block the digit columns are grouped away one after the other, each time nesting the children in their
parent's struct, so a block ends as one bounded nested row and, of its leaves, nothing is exchanged again. Block hashes are
the leaves of the next round. Proofs come out of the same rows from the top down: a transform gives each child what stands
left and right of it, and an explode goes one level down. A block gets the path above it as one more row of its group, so no
step joins leaves with nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagebook.llm.common import running_starts, written

FAN, DIGITS = 8, 4
BLOCK = FAN**DIGITS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def digest(*fields: Column) -> Column:
    """Hex sha256 of the fields: each `-` if null, else its UTF-8 byte count, `:` and itself."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def group_key(c: Column) -> Column:
    """A group as text that is never null; orders as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (g and others) with rank within g by order, from 0, and levels, the levels of a tree over the rows of g.

    One exchange by ranges of g and order; the place within a range and the sums of the ranges before give the rank, so a group
    of any size is ranked by all tasks. order must end in a column that tells equal rows apart, which is then left out.
    """
    rows = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    at = F.monotonically_increasing_id()
    rows = written(rows.select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND(2**33 - 1).alias("_at")).drop(order[-1]))
    parts = rows.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    parts = written(parts)
    starts = running_starts(parts, "g", "_part", "_n", "_start")
    last = F.sum("_n") - 1
    levels = parts.groupBy("g").agg(F.when(last == 0, 0).otherwise(F.length(F.conv(last.cast("string"), 10, FAN))).alias("levels"))
    places = parts.join(starts, ["g", "_part"]).join(levels, "g").select("g", "_part", (F.col("_start") - F.col("_first")).alias("_off"), "levels")
    return rows.join(places, ["g", "_part"]).withColumn("rank", F.col("_at") + F.col("_off")).drop("_part", "_at", "_off")


def rolled(nodes: DataFrame, base: int) -> DataFrame:
    """nodes (g, rank, levels, hash, leaf) to one row a block: g, block, levels, hash, kids.

    kids are nested DIGITS deep: structs of the digit, the hash and, inside, the next kids or at last the leaf. Levels from
    `levels` on do not exist: there a single child passes through. base: levels below these nodes.
    """
    digits = [f"d{j}" for j in range(DIGITS)]
    at = [F.pmod(F.shiftright("rank", 3 * j), F.lit(FAN)).cast("int").alias(d) for j, d in enumerate(digits)]
    rows = nodes.select("g", F.shiftright("rank", 3 * DIGITS).alias("block"), "levels", *at, "hash", F.col("leaf").alias("inside")).repartition("g", "block")
    for j, d in enumerate(digits):
        kids = F.sort_array(F.collect_list(F.struct(F.col(d).alias("d"), "hash", "inside")))
        rows = rows.groupBy("g", "block", "levels", *digits[j + 1 :]).agg(kids.alias("inside"))
        joined = F.sha2(F.array_join(F.transform("inside", lambda k: k["hash"]), ""), 256)
        rows = rows.withColumn("hash", F.when(F.col("levels") > base + j, joined).otherwise(F.get("inside", F.lit(0))["hash"]))
    return rows.withColumnRenamed("inside", "kids")


def _around(kids: str) -> Column:
    """Of each kid: itself and the hashes on its left and right as one text each."""
    text = lambda x: F.array_join(F.transform(x, lambda k: k["hash"]), "")
    return F.transform(kids, lambda k, i: F.struct(k.alias("kid"), text(F.slice(F.col(kids), F.lit(1), i)).alias("left"), text(F.slice(F.col(kids), i + 2, F.lit(FAN))).alias("right")))


def unrolled(blocks: DataFrame, base: int) -> DataFrame:
    """Blocks with path, root and subroot to one row for each leaf: g, rank, hash, leaf, path (from the leaf up), root, subroot."""
    rows = blocks.select("g", F.col("block").alias("rank"), "levels", "kids", "path", "root", "subroot")
    for j in reversed(range(DIGITS)):
        rows = rows.withColumn("x", F.explode(_around("kids")))
        step = F.array(F.struct("x.left", "x.right"))
        path = F.when(F.col("levels") > base + j, F.concat(step, "path")).otherwise(F.col("path"))
        inside = F.col("x.kid.inside").alias("kids" if j else "leaf")
        rows = rows.select("g", (F.col("rank") * FAN + F.col("x.kid.d")).alias("rank"), "levels", F.col("x.kid.hash").alias("hash"), inside, path.alias("path"), "root", "subroot")
    return rows.drop("levels")


def _met(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Each block with the path above it: both are rows of the block's group, two to a group."""
    both = blocks.select("g", "block", "levels", "kids").unionByName(above.select("g", F.col("rank").alias("block"), "path", "root", "subroot"), allowMissingColumns=True)
    return both.groupBy("g", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "path", "root", "subroot")])


def tree(leaves: DataFrame, most: int) -> list[DataFrame]:
    """Rounds of blocks over ranked leaves, the lowest first, written. most: the most levels that a group has."""
    rounds = [written(rolled(leaves, 0))]
    while most > DIGITS * len(rounds):
        nodes = rounds[-1].select("g", F.col("block").alias("rank"), "levels", "hash", F.struct(F.lit(0).alias("none")).alias("leaf"))
        rounds.append(written(rolled(nodes, DIGITS * len(rounds))))
    return rounds


def _proofs(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """above: g, rank 0, path, root, subroot of each group's top."""
    for t in reversed(range(len(rounds))):
        above = unrolled(_met(rounds[t], above), DIGITS * t)
    return above


def _most(ranked_rows: DataFrame) -> int:
    return ranked_rows.agg(F.max("levels")).first()[0] or 0


def proofs(leaves: DataFrame) -> DataFrame:
    """leaves: g (see group_key), key (orders the leaves of g, any type that can be ordered, null first), hash, leaf (a struct).

    One row a leaf: g, rank, hash, leaf, path, subroot, root. path has what stands left and right of the leaf's run on each
    level, through the top of its group to the root. Leaves of equal key go by hash; equal hashes are interchangeable.
    """
    tie = F.xxhash64(F.monotonically_increasing_id())
    rows = written(ranked(written(leaves.withColumn("_tie", tie)), ["key", "hash", "_tie"]).drop("key"))
    rounds = tree(rows, _most(rows))
    tops = rounds[-1].select(F.lit("").alias("g"), F.col("g").alias("key"), "hash", F.struct("g").alias("leaf"), F.lit(0).alias("_tie"))
    tops = written(ranked(tops, ["key", "_tie"]).drop("key"))
    upper = tree(tops, _most(tops))
    above = upper[-1].select("g", F.col("block").alias("rank"), F.array().cast(PATH).alias("path"), F.col("hash").alias("root"), F.lit(None).cast("string").alias("subroot"))
    groups = _proofs(upper, above).select(F.col("leaf.g").alias("g"), F.lit(0).cast("long").alias("rank"), "path", "root", F.col("hash").alias("subroot"))
    return _proofs(rounds, groups)


def siblings(path: Column) -> Column:
    """Hex sha256 of a proof's sibling hashes, from the leaf to the root and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(path, leaf, lambda a, p: F.sha2(F.concat(p["left"], a, p["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves are digests of doc_id, source, lang, n_chars and text; groups are languages. Every third id (by checksum; never a null
    one) is tampered with: its text's A-Z are lower-cased. Null ids come first; rows of one id go by leaf, and rows that repeat all
    fields are interchangeable leaves. Texts are read whole, once; only digests are exchanged. Other columns are not looked at.
    No rows give no rows.
    """
    fields = lambda text: digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    tampered = F.when(hit, fields(F.translate("text", UPPER, LOWER)))
    leaves = docs.select(group_key(F.col("lang")).alias("g"), F.col("doc_id").alias("key"), fields(F.col("text")).alias("hash"), F.struct("doc_id", tampered.alias("tampered")).alias("leaf"))
    rows = proofs(leaves).withColumn("folded_root", folded(F.coalesce("leaf.tampered", "hash"), F.col("path")))
    return rows.select("leaf.doc_id", F.col("hash").alias("leaf"), "subroot", "root", siblings(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def query(spark, docs: DataFrame) -> DataFrame:
    return manifest(docs)


_CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} END AS tampered FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY g) AS n FROM d),
a AS (SELECT 0 AS level, g, r AS idx, n, leaf AS hash FROM l
  UNION ALL
  SELECT level + 1, g, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM a WHERE n > 1 GROUP BY level, g, idx // 8, n),
s AS (SELECT g, hash AS subroot, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM a WHERE n = 1),
b AS (SELECT 0 AS level, r AS idx, n, subroot AS hash FROM s
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM b WHERE n > 1 GROUP BY level, idx // 8, n),
pa AS (SELECT level, g, idx, coalesce(string_agg(hash, '') OVER (PARTITION BY level, g, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || ':'
  || coalesce(string_agg(hash, '') OVER (PARTITION BY level, g, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS p FROM a WHERE n > 1),
pb AS (SELECT level, idx, coalesce(string_agg(hash, '') OVER (PARTITION BY level, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || ':'
  || coalesce(string_agg(hash, '') OVER (PARTITION BY level, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS p FROM b WHERE n > 1),
up AS (SELECT s.g, s.subroot, coalesce(list(pb.p ORDER BY pb.level) FILTER (pb.p IS NOT NULL), []) AS ps FROM s LEFT JOIN pb ON pb.idx = s.r // (8 ** pb.level)::BIGINT GROUP BY s.g, s.subroot),
ll AS (SELECT l.g, l.r, coalesce(list(pa.p ORDER BY pa.level) FILTER (pa.p IS NOT NULL), []) AS ps FROM l LEFT JOIN pa ON pa.g = l.g AND pa.idx = l.r // (8 ** pa.level)::BIGINT GROUP BY l.g, l.r),
f AS (SELECT l.doc_id, l.leaf, up.subroot, (SELECT hash FROM b WHERE n = 1) AS root, ll.ps || up.ps AS ps, coalesce(l.tampered, l.leaf) AS begun FROM l JOIN ll USING (g, r) JOIN up USING (g)),
o AS (SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(ps, ''), ':', '')) AS proof_sha256,
  list_reduce([begun] || ps, lambda x, p: sha256(split_part(p, ':', 1) || x || split_part(p, ':', 2))) AS folded_root FROM f)
SELECT *, folded_root = root AS verified FROM o
"""
