import pytest
from pyspark.sql import functions as F

from clipsieve.operators import reconcile

KIND = "video_id string"


def listed(rows):
    return sorted((r["video_id"] or "", r["stage"], r["n"], r["n_first"]) for r in rows.collect())


def numbered(spark, start, end):
    return spark.range(start, end, numPartitions=4).select(F.concat(F.lit("v"), F.col("id")).alias("video_id"))


def test_equal_stages_give_no_row(spark):
    rows = numbered(spark, 0, 20_000)
    stages = {"a": rows, "b": rows.repartition(3), "c": rows.withColumn("extra", F.lit(1))}
    assert reconcile.differing_hashes(stages) == set()
    assert listed(reconcile.differing_ids(stages)) == []


def test_one_difference_of_each_kind(spark):
    rows = numbered(spark, 0, 5_000)
    stages = {
        "a": rows,
        "fewer": rows.where("video_id <> 'v7'"),
        "more": rows.unionByName(numbered(spark, 5_000, 5_001)),
        "again": rows.unionByName(numbered(spark, 3, 4)).unionByName(numbered(spark, 3, 4)),
        "swapped": rows.where("video_id <> 'v9'").unionByName(spark.createDataFrame([(None,)], KIND)),
    }
    assert listed(reconcile.differing_ids(stages)) == sorted(
        [
            ("v7", "fewer", 0, 1),
            ("v5000", "more", 1, 0),
            ("v3", "again", 3, 1),
            ("v9", "swapped", 0, 1),
            ("", "swapped", 1, 0),
        ]
    )


def test_ten_thousand_differences_need_a_larger_table(spark):
    first, second = numbered(spark, 0, 30_000), numbered(spark, 5_000, 35_000)
    stages = {"a": first, "b": second}
    assert reconcile.differing_hashes(stages, (11,)) is None
    found = reconcile.differing_ids(stages)
    ends = found.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("n") == 0).alias("fewer"),
        F.count_if((F.col("n") == 1) & F.substring("video_id", 2, 9).cast("long").between(30_000, 34_999)).alias("more"),
    ).first()
    assert tuple(ends) == (10_000, 5_000, 5_000)


def test_all_ids_are_counted_where_no_table_is_large_enough(spark):
    stages = {"a": numbered(spark, 0, 300), "b": numbered(spark, 100, 400)}
    assert reconcile.differing_hashes(stages, (4,)) is None
    found = listed(reconcile.differing_ids(stages, (4,)))
    assert found == listed(reconcile.differing_ids(stages)) and len(found) == 200


@pytest.mark.parametrize("empty", ["first", "second"])
def test_empty_stages(spark, empty):
    some, none = numbered(spark, 0, 3), spark.createDataFrame([], KIND)
    stages = {"a": none, "b": some} if empty == "first" else {"a": some, "b": none}
    n = (1, 0) if empty == "first" else (0, 1)
    assert listed(reconcile.differing_ids(stages)) == [(f"v{i}", "b", *n) for i in range(3)]
    assert listed(reconcile.differing_ids({"a": some})) == []


def test_what_is_shuffled_does_not_grow_with_equal_ids(spark):
    for n in (1_000, 100_000):
        rows = numbered(spark, 0, n)
        assert reconcile.summary({"a": rows, "b": rows.where("video_id <> 'v5'")}, 11).count() == 3
