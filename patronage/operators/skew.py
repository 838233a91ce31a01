"""Heavy keys: found by counting, cut into pieces on both sides of a join.

A bucketed join has one task per bucket, and adaptive execution can't split it.
Here a key whose rows exceed a bucket's fair share is dealt over several salts;
the other side holds such a key once per salt.  Both sides are bucketed on
(key, salt), so the join still needs no shuffle and no bucket gets all of a
customer with a third of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SALT = "salt"


def heavy_keys(rows: DataFrame, key: str, pieces: int) -> DataFrame:
    """(key, salts): keys with more than 1 / ``pieces`` of the rows, which are
    fewer than ``pieces``, and into how many such shares each is cut."""
    total = rows.select(F.greatest(F.count(F.lit(1)), F.lit(1))).scalar()
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.withColumn("salts", F.ceil(F.col("_n") * pieces / total).cast("int")).where("salts > 1").select(
        key, "salts")


def salted(rows: DataFrame, heavy: DataFrame, key: str, by: str | Column) -> DataFrame:
    """``rows`` with a salt: 0, or for a heavy key its piece by the hash of ``by``."""
    piece = F.pmod(F.xxhash64(by), F.coalesce("salts", F.lit(1))).cast("int")
    return rows.join(F.broadcast(heavy), key, "left").withColumn(SALT, piece).drop("salts")  # under ``pieces`` rows


def replicated(rows: DataFrame, heavy: DataFrame, key: str) -> DataFrame:
    """``rows`` once per salt of their key."""
    salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
    return rows.join(F.broadcast(heavy), key, "left").withColumn(SALT, F.explode(salts)).drop("salts")


def cut_by_salt(fact: DataFrame, dim: DataFrame, key: str, by: str, pieces: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join on ``key`` with salts; join them on (key, salt)."""
    heavy = materialize(heavy_keys(fact, key, pieces), "heavy-keys")
    return salted(fact, heavy, key, by), replicated(dim, heavy, key)
