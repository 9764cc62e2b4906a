"""What the operators share: the scratch folder, written tables, and group work that no single key can overload."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SALTS = 256
_LOCAL: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share.

    Only where the setting is absent and the master is local does a temporary folder stand in for it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="spark-"))
        base = _LOCAL[0]
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows of df as a table in the shared folder: cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def salted(rows: DataFrame, on: Column, salts: int = SALTS) -> DataFrame:
    """rows with a column salt in [0, salts), taken from on."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(on), F.lit(salts)).cast("int"))


def dealt(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """rows with a column salt in [0, salts) that tells even equal rows apart. To be written before it is used twice."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int"))


def grouped(rows: DataFrame, key: str, aggs: dict[str, tuple[Column, callable]]) -> DataFrame:
    """One row per key of salted rows: key, aggs, and salts, the list of the salts that the key has.

    aggs: name -> (partial aggregate over rows, function of the partial column that merges it). Rows of one key are
    first reduced per salt, so that no task gets more than its share of a key with very many rows.
    """
    per_salt = rows.groupBy(key, "salt").agg(*[a.alias(n) for n, (a, _) in aggs.items()])
    return per_salt.groupBy(key).agg(*[f(n).alias(n) for n, (_, f) in aggs.items()], F.collect_list("salt").alias("salts"))


def attached(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Salted rows with the columns of their group; each group row meets only the salts that its key has."""
    return rows.join(groups.withColumn("salt", F.explode("salts")).drop("salts"), [key, "salt"]).drop("salt")


def by_small(rows: DataFrame, small: DataFrame, key: list[str], on: Column, salts: int = 64, how: str = "left", grows: bool = False) -> DataFrame:
    """rows joined with an aggregated table that has one row per key.

    The table is repeated once per salt, so that a key with a third of all rows is spread over `salts` tasks; where the
    table is small enough by Spark's own threshold, Spark broadcasts it instead. grows: the table grows with the input,
    so it is never broadcast. A null key finds nothing.
    """
    spread = small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = spread.hint("merge") if grows else spread
    return salted(rows, on, salts).join(spread, [*key, "salt"], how).drop("salt")


def hashed_under(h: Column, share: float) -> Column:
    """Whether a 64-bit hash lies in the lowest share of its range."""
    return F.lit(True) if share >= 1 else h <= F.lit(int(-(2**63) + share * 2**64))


def first_by_hash(rows: DataFrame, h: Column, k: int) -> DataFrame:
    """The k distinct rows that come first by h, a 64-bit hash of them (ties by columns); all where there are fewer.

    Rows are counted first. Only those whose hash is under a bound that leaves somewhat more than k are ordered, so what meets
    in one task does not grow with the input; where repeats leave fewer than k, the bound is raised.
    """
    n = rows.count()
    share = 1.0 if n <= 2 * k else (1.2 * k + 100) / n
    while True:
        near = rows.where(hashed_under(h, share)).distinct()
        if share >= 1 or near.count() >= k:
            return near.orderBy(h, *[F.col(f"`{c}`") for c in rows.columns]).limit(k)
        share *= 4


def running_starts(parts: DataFrame, key: str, part: str, n: str, start: str, block: int = 64) -> DataFrame:
    """parts (key, part, n; one row each): key, part, and start, the sum of n over the key's smaller parts.

    In two steps, over blocks of parts and within a block, so that no task orders more than a block or a list of blocks.
    """
    rows = parts.withColumn("_block", F.floor(F.col(part) / block).cast("int"))
    before = lambda of, by, order: F.coalesce(F.sum(of).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = rows.groupBy(key, "_block").agg(F.sum(n).alias("_n"))
    blocks = blocks.select(key, "_block", before("_n", [key], "_block").alias("_at"))
    return rows.withColumn("_in", before(n, [key, "_block"], part)).join(blocks, [key, "_block"]).select(key, part, (F.col("_at") + F.col("_in")).alias(start))


def one_each(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs without the rows named in gone (id_key, check; see id_key), and one row where rows repeat id and text.

    Repeats are reduced before the exchange, so a row with very many copies is no hot spot; the join with gone uses the
    exchange that the reduction needs anyway. Columns come out as they came in.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(id_key(F.col(id_col)).alias("id_key"), F.xxhash64(F.col(text_col)).alias("check"), row.alias("row"))
    return keyed.groupBy("id_key", "check").agg(F.first("row").alias("row")).join(gone, ["id_key", "check"], "left_anti").select("row.*")


def id_key(c: Column) -> Column:
    """An id of any type as text that is never null; a null id differs from any other."""
    return F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-"))
