"""Tag lists, dates and column resolution against hand-made values."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipsieve.functions.challenges import parse_challenges
from clipsieve.functions.dates import epoch_seconds, utc_date
from clipsieve.session import clear_stages, materialize
from clipsieve.sources import posts


def test_text_tags(values):
    expected = {
        None: [],
        "": [],
        "x, #y ,,#": ["x", "y"],
        '["a","#b",1,{"title":"T","name":"n"},{"name":"N"},null]': ["a", "#b", "T", "N"],
        '[{"title":"","challenge_name":"C"}]': ["C"],
        "[bad]": [],
        '[{"title":5}]': ["5"],
        '[{"title":0,"name":"z"}]': ["z"],
        '[{"title":true}]': ["True"],
        '[{"title":[],"name":{},"challenge_name":false}]': [],
        '[{"title":"a","title":"b"}]': ["b"],
        ' ["p"] ': ["p"],
        '{"title":"x"}': ['{"title":"x"}'],
        "　#wide , plain": ["wide", "plain"],
        "[]": [],
        '["",""]': [],
    }
    found = values(lambda x: parse_challenges(x, T.StringType()), list(expected))
    assert found == list(expected.values())


def test_native_tags(spark):
    kinds = {
        "array<string>": (["a", "", None, "b"], ["a", "b"]),
        "array<struct<name:string,title:string>>": ([("n", ""), ("n", "t"), (None, None)], ["n", "t"]),
        "struct<title:int,name:string>": ((0, "z"), ["z"]),
        "struct<other:string>": (("q",), []),
        "bigint": (7, []),
    }
    for kind, (value, expected) in kinds.items():
        frame = spark.createDataFrame([(value,), (None,)], f"x {kind}")
        tags = parse_challenges(F.col("x"), frame.schema["x"].dataType)
        assert [row[0] for row in frame.select(tags).collect()] == [expected, []], kind


@pytest.mark.parametrize(
    ("kind", "value", "seconds", "date"),
    [
        ("int", 0, 0.0, "1970-01-01"),
        ("int", -1, -1.0, "1969-12-31"),
        ("string", "1700000000", 1.7e9, "2023-11-14"),
        ("string", " 1.7e9 ", 1.7e9, "2023-11-14"),
        ("bigint", 1700000000000, None, ""),
        ("string", "x", None, ""),
        ("string", "12d", None, ""),
        ("string", "nan", None, ""),
        ("double", float("nan"), None, ""),
        ("string", None, None, ""),
        ("timestamp", datetime.datetime(2024, 2, 29, 23, 59, 59, 500000, datetime.UTC), 1709251199.5, "2024-02-29"),
    ],
)
def test_dates(spark, kind, value, seconds, date):
    frame = spark.createDataFrame([(value,)], f"x {kind}")
    time = epoch_seconds(F.col("x"), frame.schema["x"].dataType)
    assert tuple(frame.select(time, utc_date(time)).first()) == (seconds, date)


def test_first_alias_wins_and_missing_columns_are_null(spark):
    raw = spark.createDataFrame(
        [(1, "first", "second", None)], "aweme_id int, desc string, desc_raw string, uid string"
    )
    row = posts.normalize_columns(raw).first()
    assert row.asDict() == {
        "video_id": "1",
        "author_id": "unknown",
        "created_at": None,
        "desc_raw": "first",
        "challenges_raw": None,
    }


def test_rows_without_id_are_counted_and_dropped(spark):
    raw = spark.createDataFrame([("a", None), (None, None)], "id string, author_id string")
    assert [row["video_id"] for row in posts.ingest(raw).collect()] == ["a"]
    assert posts.ingest_checks(raw).first().asDict() == {
        "raw_rows": 2,
        "rows_without_id": 1,
        "rows_without_author": 2,
        "all_authors_missing": True,
    }


def test_repeated_ids(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "video_id string, v int")
    with pytest.raises(ValueError, match="1 values of video_id"):
        posts.require_unique(rows)
    kept = posts.keep_one(rows, [F.desc("v")])
    assert sorted(map(tuple, kept.collect())) == [("a", 2), ("b", 1)]
    assert posts.require_unique(kept) is kept


def test_nested_challenges_are_kept_as_json(spark):
    raw = spark.createDataFrame([("a", ["x", "y"])], "id string, hashtags array<string>")
    row = posts.ingest(raw).first()
    assert (row["challenges_raw"], row["hashtags_list_raw"]) == ('["x","y"]', ["x", "y"])


def test_scan_reads_any_format(spark, tmp_path):
    spark.createDataFrame([("a", "t")], "id string, desc string").write.json(f"{tmp_path}/posts")
    rows = posts.ingest(posts.scan(spark, f"{tmp_path}/posts", "json"))
    assert [(row["video_id"], row["desc_raw"]) for row in rows.collect()] == [("a", "t")]


def test_stages_can_be_cleared(spark):
    kept = materialize(spark.range(3))
    folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert Path(folder).exists()
    clear_stages(spark)
    assert not Path(folder).exists()
