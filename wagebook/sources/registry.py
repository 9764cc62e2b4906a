"""The registry of stored files: which hash has which outcome. It grows with every batch and is never exchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagebook.sources.bucketed import Bucketed
from wagebook.sources.files import stored

SCHEMA = "sha256 string, status string, batch string"
BITS, BITMAP = 16, 32768
MOST_HASHES = 16_000_000  # of a batch, for which its filter is 32 MB


class Registry(Bucketed):
    """sha256, status, batch: outcomes of files in the batch that stored them, bucketed and sorted by sha256. What a later batch
    says of a hash counts, batches being in the order of their names; of several outcomes in one batch a good one counts. A batch
    that is recorded twice says the same twice."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        super().__init__(spark, name, "sha256", path, buckets)

    def record(self, outcomes: DataFrame, batch: str) -> None:
        """outcomes: sha256, status."""
        self.append(outcomes.select("sha256", "status", F.lit(batch).alias("batch")))

    def latest(self, hashes: DataFrame, good: list[str], filtered: bool = True, besides: str | None = None) -> DataFrame:
        """sha256, status of the hashes (written, one row each) that the registry has, as their latest batch left them.

        A Bloom filter of the hashes, one bit each of 16, goes ahead of the join where there are no more than MOST_HASHES: it
        thins out the registry while it is read. Beyond that the join alone decides, with the same result. besides: a batch
        whose records do not count, as it is run again.
        """
        if not self.exists():
            return hashes.select("sha256", F.lit(None).cast("string").alias("status")).where("false")
        rows, n = self.rows(), hashes.count() if filtered else 0
        rows = rows.where(F.col("batch") != besides) if besides is not None else rows
        if 0 < n <= MOST_HASHES:
            rows = _thinned(rows, hashes, n)
        last = rows.join(hashes.select("sha256").hint("merge"), "sha256", "left_semi")
        return last.groupBy("sha256").agg(F.max_by("status", F.struct("batch", F.col("status").isin(good))).alias("status"))


def _slot(bits: int) -> Column:
    return F.pmod(F.xxhash64("sha256"), F.lit(bits)) + 1


def _thinned(rows: DataFrame, hashes: DataFrame, n: int) -> DataFrame:
    """rows whose hash may be among hashes: bitmaps of BITMAP bits, found by their number. Their size is bounded by n."""
    bits = -(-n * BITS // BITMAP) * BITMAP
    maps = hashes.select(_slot(bits).alias("s")).groupBy(F.bitmap_bucket_number("s").alias("_map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("_bits"))
    at = F.bitmap_bit_position(_slot(bits))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.withColumn("_map", F.bitmap_bucket_number(_slot(bits))).join(F.broadcast(maps), "_map")
    return met.where(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1).select(*rows.columns)


def known(files: DataFrame, registry: Registry | DataFrame, good: list[str], besides: str | None = None) -> DataFrame:
    """sha256, n (files of it), done: one row for each hash of files; done says whether it is stored with a good outcome."""
    hashes = stored(files.where("sha256 is not null").groupBy("sha256").agg(F.count(F.lit(1)).alias("n")))
    last = registry.latest(hashes, good, besides=besides) if isinstance(registry, Registry) else registry.where(F.col("status").isin(good)).select("sha256", "status").dropDuplicates(["sha256"])
    done = last.where(F.col("status").isin(good)).select("sha256", F.lit(True).alias("done"))
    return stored(hashes.join(done, "sha256", "left").withColumn("done", F.coalesce("done", F.lit(False))))
