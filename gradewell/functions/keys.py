"""The person key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gradewell.schemas import KEY_COLUMNS


def member_id(columns: Sequence[str] = KEY_COLUMNS) -> Column:
    """SHA-256 of the key columns joined by `||`.

    NULLs are skipped, so the same values around a moved NULL share an id. Such persons
    show up as duplicate members and are quarantined. Money must already be decimal:
    the text of a double depends on its size.

    The hash of a text is never NULL, but Spark cannot know: without the coalesce every join on the id
    filters on it first, which computes the hash twice and keeps equal scans from being shared.
    """
    return F.coalesce(F.sha2(F.concat_ws("||", *columns), 256), F.lit(""))


def injective_text(columns: Sequence[str]) -> Column:
    """A text that differs wherever the values do: each with its length before it, a NULL as a mark of its own."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def injective_key(columns: Sequence[str]) -> Column:
    """SHA-256 of the values, NULLs included; beside member_id() it tells persons apart that share one."""
    return F.sha2(injective_text(columns), 256)


def with_member_id(applications: DataFrame) -> DataFrame:
    return applications.withColumn("member_id", member_id())


# Before a text that is no SHA-256 in hex digits: one byte more than such a hash has, so that neither is taken for the other.
_AS_TEXT = "00" * 33


def packed(column: str) -> Column:
    """An id in half the bytes, to be shuffled: the 32 bytes of a hash in hex digits, any other text behind a mark."""
    text = F.col(column)
    plain = F.concat(F.unhex(F.lit(_AS_TEXT)), text.cast("binary"))
    return F.when(text.rlike(r"^[0-9a-f]{64}\z"), F.unhex(text)).otherwise(plain)


def unpacked(column: str) -> Column:
    """The text that packed() was given."""
    packed_id = F.col(column)
    plain = F.substring(packed_id, 34, 2**31 - 1).cast("string")
    return F.when(F.octet_length(packed_id) == 32, F.lower(F.hex(packed_id))).otherwise(plain)


def with_packed_members(table: DataFrame) -> DataFrame:
    """`table` with its person ids packed, if it has any."""
    return table.withColumn("member_id", packed("member_id")) if "member_id" in table.columns else table


def with_unpacked_members(table: DataFrame) -> DataFrame:
    return table.withColumn("member_id", unpacked("member_id")) if "member_id" in table.columns else table
