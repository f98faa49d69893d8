"""Plan shapes that hold when one key carries a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 32


def top_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, hot: bool = False
) -> DataFrame:
    """First k rows of each group with their `rank`.

    Spark trims every map task to k rows per group before the shuffle. With
    `hot`, a group is first trimmed in SALTS independent parts, so a group met
    by very many map tasks is never sorted in a single task. Use it on file
    rows; grouped rows arrive in few enough tasks without it.
    """
    if hot:
        rest = [name for name in df.columns if name not in keys]
        df = df.withColumn("_salt", _salt(rest, SALTS))
        part = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = df.withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= k)
        df = df.drop("_n", "_salt")
    group = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= k)


def top_k_overall(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of the whole frame with their `rank`.

    Each task keeps k rows and only those are merged; the window runs on k rows.
    """
    first = df.orderBy(*order).limit(k)
    return first.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def salted_join(
    big: DataFrame, small: DataFrame, on: Sequence[str], how: str, salts: int = SALTS, by: Sequence[str] = ()
) -> DataFrame:
    """Join file rows with one row per key.

    The rows of a key spread over `salts` tasks and the single row on the other
    side is repeated for each, so no task receives a whole hot key. Spark still
    broadcasts the small side when its measured size allows.

    With `by`, rows are spread by these columns and `_salt` stays: what then looks at rows by
    `on`, `_salt` and them needs no other shuffle.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how}: the repeated side must not be preserved")
    rest = by or [name for name in big.columns if name not in on]
    spread = big.withColumn("_salt", _salt(rest, salts))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    repeated = small.withColumn("_salt", copies)
    joined = spread.join(repeated, [*on, "_salt"], how)
    return joined if by else joined.drop("_salt")


def heavy_keys(df: DataFrame, key: str, k: int = 64) -> Column:
    """The values of a bigint column that hold more than 1 / (2 k) of all rows: fewer than 2 k, by a sketch of fixed size.

    One that the sketch takes for heavy by mistake does no harm.
    """
    found = df.agg(F.expr(f"approx_top_k({key}, {k}, {64 * k})").alias("top"), F.count("*").alias("n"))
    heavy = F.filter("top", lambda t: t["count"] * 2 * k > F.col("n"))
    return found.select(F.transform(heavy, lambda t: t["item"])).scalar()


def heavy_join(big: DataFrame, small: DataFrame, on: Sequence[str], key: str, heavy: Column) -> DataFrame:
    """Inner join with one row per key, in which the rows of heavy keys stay where they are.

    Both sides have `key`, a hash of the columns joined `on`. Heavy keys are fewer than a
    bound (see `heavy_keys`), so their rows of `small` are sent to all tasks; all other
    rows are joined as usual.
    """
    hot = F.array_contains(heavy, F.col(key))
    plain = big.where(~hot).join(small.where(~hot).drop(key), on)
    return plain.unionByName(big.where(hot).join(F.broadcast(small.where(hot).drop(key)), on))


def _salt(columns: Sequence[str], salts: int) -> Column:
    # from the values, so a retried task sends each row to the same place again
    return F.pmod(F.xxhash64(*columns), F.lit(salts).cast("bigint"))
