from pyspark.sql import functions as F

from sparkmill.llm import slots


def test_no_member_is_lost_and_others_are_the_rest(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("key"), "id")
    found = slots.members(rows.filter("id % 7 = 0").select("key"))
    assert len(found) == 1 << slots.BITS and found.sum() > 0
    some = {r["id"] for r in slots.likely(rows, "key", found).collect()}
    rest = {r["id"] for r in slots.likely(rows, "key", found, others=True).collect()}
    assert some | rest == set(range(5000)) and not some & rest
    assert {i for i in range(5000) if i % 7 == 0} <= some and len(some) < 800


def test_no_keys(spark):
    none = slots.members(spark.range(0).select(F.xxhash64("id").alias("key")))
    assert none.sum() == 0
