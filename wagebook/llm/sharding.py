"""Uniform shuffle into shards of exact sizes.

Rows are cut into blocks. A communication matrix says how many rows each block sends to each shard; its rows are drawn
from the multivariate hypergeometric law that a uniform permutation of all rows would give them. Each block is permuted
by itself and cut by its row of the matrix, the pieces are exchanged, and each shard is permuted once more.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wagebook.llm.common import running_starts, written


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among draws without replacement. By inversion around the mode, as totals can be over 10**9."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    reach = int(14 * (draws * (good / total) * (bad / total)) ** 0.5) + 20
    up = np.arange(mode, min(high, mode + reach), dtype=np.float64)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=np.float64)
    rise = np.cumprod((good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1)))
    fall = np.cumprod(down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1)))
    weight = np.concatenate([fall[::-1], [1.0], rise])
    at = np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), side="right")
    return int(mode - len(down) + min(at, len(weight) - 1))


def communication_matrix(block_rows: list[int], shard_rows: list[int], seed: int) -> list[list[int]]:
    """[block][shard] -> rows sent; each block's row sums to its rows, each shard's column to its size."""
    rng, left, out = np.random.default_rng(seed), list(shard_rows), []
    for n in block_rows:
        row, rest = [], sum(left)
        for s in left[:-1]:
            rest -= s
            row.append(k := hypergeometric(rng, s, rest, n))
            n -= k
        row.append(n)
        left = [a - b for a, b in zip(left, row)]
        out.append(row)
    return out


def shuffled(rows: DataFrame, key: list[str], shards: int, seed: int = 7, blocks: int = 4096, parts: int = 4096) -> DataFrame:
    """rows with shard (0 to shards - 1; row counts differ by one at most) and slot (0 to the shard's rows - 1).

    key: columns that tell rows apart; the same rows and seed give the same result however they are partitioned. Rows
    equal in all of key are interchangeable; null keys are keys like others. rows should be narrow, as they are exchanged twice. The driver holds the
    matrix, of blocks * shards numbers, at any number of rows; a block or part of a shard that one task sorts has about
    rows / blocks or rows / (shards * parts) rows. Some blocks of few rows are empty. No rows give no rows.
    """
    rows = written(rows.select("*", *[F.xxhash64(F.lit(f"{seed}/{k}"), *key).alias(f"_h{k}") for k in range(3)]))
    total = rows.count()
    rows = rows.withColumn("_block", F.pmod("_h0", F.lit(blocks)).cast("int"))
    sent = {r["_block"]: r["n"] for r in rows.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([sent.get(b, 0) for b in range(blocks)], sizes, seed)
    ends = F.from_json(F.lit(json.dumps([list(map(int, np.cumsum(r))) for r in matrix])), "array<array<bigint>>")
    place = F.row_number().over(Window.partitionBy("_block").orderBy("_h1", *key)) - 1
    rows = rows.withColumn("_at", place).withColumn("shard", F.size(F.filter(F.get(ends, F.col("_block")), lambda e: e <= F.col("_at"))))
    rows = written(rows.drop("_at", "_block", "_h0", "_h1").withColumn("_part", F.pmod(F.shiftrightunsigned("_h2", 20), F.lit(parts)).cast("int")))
    starts = running_starts(rows.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n")), "shard", "_part", "_n", "_start")
    slot = F.col("_start") + F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_h2", *key)) - 1
    return rows.join(starts, ["shard", "_part"]).withColumn("slot", slot).drop("_part", "_start", "_h2")


def query(spark, docs: DataFrame) -> DataFrame:
    """Null and empty texts have size 1 and checksum 0; rows that repeat a doc_id are rows of their own."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    out = shuffled(rows, ["doc_id", "text_crc32", "size"], 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
