"""Equi-joins of rows with members that stay balanced when one member holds a third of the rows.

The rows of every member are counted, and a member is cut into slices of a fixed number of rows: its rows on the
many side are spread over as many salts as it has slices, it is repeated once per salt on the other side, and the join
runs on member and salt. Every row still meets its member exactly once, so results do not change. AQE does
not split this kind of join by itself: it wants a plain shuffle on both sides, and the member side is usually an
aggregate.

What tells the salts is broadcast, so it must not grow: members share buckets, and a bucket takes the salts of its
largest member. Members that share one with a large member are repeated in vain, but for every slice there is
that many rows, so all repeats together stay below the rows divided by SLICE_ROWS, times the members of a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 4_194_304     # rows of two ints that are broadcast, at most and at any data size
SLICE_ROWS = 1_000_000  # rows of one member that one task joins, at any data size
GROUPS = 4_096          # groups of members that are counted first where slices are large


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _of_large_groups(rows: DataFrame, key: list[str], slice_rows: int) -> DataFrame:
    """Rows of the groups of members that have more rows than a slice: every hot member is in one of them.

    Each map task shuffles a row per group, not one per member. Without large groups the rows are not read again.
    """
    group = F.pmod(F.xxhash64(*key), F.lit(GROUPS)).cast("int")
    large = rows.groupBy(group.alias("_group")).agg(F.count("*").alias("_rows")).where(F.col("_rows") > slice_rows)
    # Broadcast is safe: at most GROUPS rows.
    return rows.join(F.broadcast(large.select("_group")), group == F.col("_group"), "left_semi")


def hot_buckets(rows: DataFrame, key: str | Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Buckets with a member of more rows than a slice, and the slices of its largest one: at most BUCKETS rows.

    `rows` need hold no more than the key. Rows are counted per member, combined on the map side.
    """
    slices = F.ceil(F.col("_rows") / F.lit(slice_rows)).cast("int")
    # Smaller slices than these are passed by most groups, so that counting those first would spare nothing.
    few = _of_large_groups(rows, _names(key), slice_rows) if slice_rows >= SLICE_ROWS else rows
    return (
        few.groupBy(*_names(key)).agg(F.count("*").alias("_rows")).where(F.col("_rows") > slice_rows)
        .groupBy(_bucket(_names(key)).alias("_bucket")).agg(F.max(slices).alias("_salts"))
    )


def _with_salt(df: DataFrame, key: list[str], hot: DataFrame, salt: Column) -> DataFrame:
    # Broadcast is safe: `hot` has at most BUCKETS rows of two ints.
    marked = df.join(F.broadcast(hot), _bucket(key) == F.col("_bucket"), "left")
    return marked.select(*df.columns, salt.alias("_salt"))


def join_members(rows: DataFrame, members: DataFrame, hot: DataFrame, how: str = "inner",
                 key: str | Sequence[str] = "member_id", keep: Sequence[str] | None = None) -> DataFrame:
    """Join `rows` (many per member) with `members` on the member, or on other keys, salting hot ones.

    `how` is inner, left or left_anti. `members` should hold one row per member, since each is repeated per salt. The salt
    is a hash of the row's own columns, not a random number, so a recomputed task sends each row where it went
    before; rows should therefore be distinct. `keep` names those columns of `rows`, keys among them, that move; the others
    only tell the salt.
    """
    keys = _names(key)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    row_salt = F.pmod(F.xxhash64(*rows.columns), salts).cast("int")
    every_salt = F.explode(F.sequence(F.lit(0), salts - 1))
    salted_members = _with_salt(members, keys, hot, every_salt)
    salted_rows = _with_salt(rows, keys, hot, row_salt)
    if keep is not None:
        salted_rows = salted_rows.select(*keep, "_salt")
    return salted_rows.join(salted_members, [*keys, "_salt"], how).drop("_salt")
