"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest. New rows are reduced to their distinct digests, held against the
index by a sort-merge anti-join that does not move the index, and what is new is appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagebook.llm.common import attached, dealt, grouped, id_key, one_each, scratch, written
from wagebook.sources.bucketed import Bucketed


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class DigestIndex(Bucketed):
    """digest -> keep_id, the smallest id of the batch that brought the digest.

    Adding a batch twice changes nothing. A batch that fails midway leaves the index as it was or with whole rows that
    the next attempt finds. Null ids count as larger than any; a digest that only null ids have gets a null keep_id.
    An index with a path is found again by it, whatever name it is opened under. Every append adds a sorted file to each
    bucket; compact() makes them one again, so that joins need no sort.
    """

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        super().__init__(spark, name, "digest", path, buckets)

    def compact(self) -> DigestIndex:
        """The index as one sorted file a bucket, under a new name; this one stays for those who read it."""
        new = new_index(self.spark)
        new.buckets = self.buckets
        new.append(self.rows())
        return new

    def add(self, batch: DataFrame) -> None:
        """batch: digest, id. The batch is pre-aggregated, so a digest with very many copies costs one row a task."""
        new = batch.groupBy("digest").agg(F.min("id").alias("keep_id"))
        if self.exists():
            new = new.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        self.append(new)


def _cuts(rows: DataFrame, batches: int, draws: int = 15) -> list:
    """batches - 1 ids at about even distances: order statistics of `draws` ids that hashes choose. Ids of any type that
    can be ordered will do."""
    drawn = F.array_distinct(F.array_sort(F.array(*[F.min_by("id", F.xxhash64(F.lit(k), "id")) for k in range(draws)])))
    got = rows.where("id is not null").agg(drawn.alias("d")).first()["d"]
    got = [x for x in got if x is not None]
    return sorted({got[len(got) * i // batches] for i in range(1, batches)}) if got else []


def exact_groups(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """One row per row of docs: id, check (hash of the raw text), digest, keep_id, group_size.

    docs go into the index in batches of ascending id, so that within docs the smallest id of equal texts stays, and a
    text that the index knows from earlier data keeps the id it has there. Ids are of any type that can be ordered; a
    null id counts as larger than any. Rows that repeat both id and text count in group_size and share one fate. Texts
    are read whole; a null one is empty. Other columns of docs are not looked at. No rows give no rows.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("check"), F.sha2(normalised(text).cast("binary"), 256).alias("digest"))
    rows = written(dealt(rows))
    at = F.lit(0)
    cuts = _cuts(rows, batches) if batches > 1 else []
    for c in cuts:
        at = at + F.when(F.col("id") > F.lit(c), 1).otherwise(0)
    at = F.when(F.col("id").isNull(), len(cuts)).otherwise(at)
    for k in range(len(cuts) + 1):
        index.add(rows.where(at == k).select("id", "digest"))
    groups = grouped(rows, "digest", {"group_size": (F.count(F.lit(1)), F.sum)})
    return attached(rows, groups.join(index.rows().hint("merge"), "digest"), "digest")


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder, under a name of its own."""
    return DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", scratch(spark))


def drop_copies(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose text another row, or the index, keeps; columns as they came.

    Of the rows that share the kept id, the text with the smallest hash stays, and of rows that repeat id and text one
    stays, whatever the id: so copies that only null ids have go too. index: without it one of docs alone is made, and
    its name is taken out of the catalog again.
    """
    own = index or new_index(docs.sparkSession)
    rows = exact_groups(docs, own, id_col, text_col)
    mine = F.col("id").eqNullSafe(F.col("keep_id"))
    rows = written(dealt(rows.select("digest", id_key(F.col("id")).alias("id_key"), "check", mine.alias("mine"))))
    stay = grouped(rows.where("mine"), "digest", {"stays": (F.min("check"), F.min)})
    fate = rows.join(stay.withColumn("salt", F.explode("salts")).drop("salts"), ["digest", "salt"], "left")
    gone = fate.where(~(F.col("mine") & (F.col("check") == F.col("stays")))).select("id_key", "check").distinct()
    if index is None:
        own.forget()
    return one_each(docs, gone, id_col, text_col)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    index = new_index(spark)
    g = written(exact_groups(docs, index))
    index.forget()
    return g.select(F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
