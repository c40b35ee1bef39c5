"""Salted joins against plain ones, on rows of which one member holds a third."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from gradewell.operators.quality import exclude
from gradewell.operators.skew import BUCKETS, hot_buckets, join_members


@pytest.fixture(scope="module")
def rows(spark):
    member = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 500))
    return spark.range(60_000).select(member.alias("member_id"), F.col("id").alias("loan"))


@pytest.fixture(scope="module")
def members(rows):
    return rows.select("member_id").distinct().where("member_id <> 'm7'").withColumn("size", F.length("member_id"))


@pytest.fixture(scope="module")
def hot(rows):
    return hot_buckets(rows.select("member_id"), "member_id", slice_rows=1_000)


def contents(frame):
    columns = sorted(frame.columns)
    return Counter(tuple(r) for r in frame.select(*columns).collect())


def test_only_the_hot_bucket_is_salted(hot):
    found = hot.collect()
    assert len(found) == 1 and found[0]["_salts"] == 20


@pytest.mark.parametrize("times", [1, 10])
def test_slices_do_not_grow_with_the_rows(rows, members, spark, times):
    """Ten times the rows give ten times the salts, without a limit."""
    more = rows.crossJoin(spark.range(times).select(F.col("id").alias("copy")))
    hot = hot_buckets(more, "member_id", slice_rows=1_000)
    assert hot.agg(F.max("_salts")).first()[0] == 20 * times
    salted = F.pmod(F.xxhash64(*more.columns), F.lit(20 * times))
    slices = more.where("member_id = 'hot'").groupBy(salted).count().agg(F.max("count"), F.min("count")).first()
    assert 850 < slices[1] <= slices[0] < 1_200


def test_histogram_is_bounded(spark):
    wide = spark.range(200_000).select(F.col("id").cast("string").alias("member_id"))
    assert hot_buckets(wide, "member_id", slice_rows=0).count() <= BUCKETS


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_join_equals_the_plain_one(rows, members, hot, how):
    salted = join_members(rows, members, hot, how)
    plain = rows.join(members, "member_id", how)
    assert salted.columns == plain.columns
    assert contents(salted) == contents(plain)


def test_hot_rows_are_spread(spark, rows, members, hot):
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def largest(frame):
            return frame.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = rows.join(members, "member_id")
        assert largest(plain) >= 20_000
        assert largest(join_members(rows, members, hot)) < 14_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_excluding_a_hot_member(rows, hot):
    bad = rows.select("member_id").distinct().where("member_id in ('hot', 'm1')")
    kept = exclude(rows, bad, hot)
    assert contents(kept) == contents(rows.where("member_id not in ('hot', 'm1')"))
