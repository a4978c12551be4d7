"""Lexicon scores against hand-made values and the join form."""

from clipsieve import Settings
from clipsieve.operators import lexicon


def evidence(spark, rows):
    return spark.createDataFrame(
        [("r", *row) for row in rows],
        "run_id string, video_id string, lex_tokens array<string>, hashtags_list_norm array<string>",
    )


def test_tags_repeat_and_are_not_noise_filtered(spark):
    row = lexicon.lexicon_scores(
        evidence(spark, [("1", ["love", "love", "trend_free"], ["trend", "love"])]), Settings()
    ).first()
    assert row["sentiment_scores_raw"] == {"positive": 4.0, "negative": 0.0}
    assert row["format_scores_raw"]["challenge"] == 2.0
    assert row["format_top_tokens"] == {"challenge": [("trend", 2.0)]}
    assert row["role_top_tokens"] == {}
    assert row["sentiment_polarity"] == 4.0
    assert row["lexicon_evidence"]["role"] == {"creator": [], "professional": []}


def test_weight_is_rounded_half_to_even():
    assert [Settings(hashtag_weight=w).hashtag_repeat for w in (0.2, 0.5, 1.5, 2.5, 3.5)] == [1, 1, 2, 2, 4]


def test_repeated_keywords_and_stable_top_five(spark):
    words = ["p", "o", "n", "m", "l", "k", "k"]
    settings = Settings(lexicons={"fam": {"x": ["K", "l", "m", "n", "o", "p", "k"], "none": ["zzz"]}})
    row = lexicon.lexicon_scores(evidence(spark, [("1", words, [])]), settings).first()
    assert row["fam_scores_raw"] == {"x": 9.0, "none": 0.0}
    assert row["fam_top_tokens"]["x"] == [("k", 2.0), ("k", 2.0), ("l", 1.0), ("m", 1.0), ("n", 1.0)]
    assert row["sentiment_polarity"] == 0.0


def test_join_form_agrees_with_row_form(spark):
    rows = evidence(
        spark,
        [("1", ["love", "great", "bad"], ["love"]), ("2", ["x"], []), ("3", [], ["happy", "song"])],
    )
    settings = Settings()
    joined = lexicon.lexicon_hits(rows, lexicon.lexicon_frame(spark, settings.lexicons), settings)
    totals = {}
    for row in joined.collect():
        key = (row["video_id"], row["family"], row["label"])
        totals[key] = totals.get(key, 0) + row["n"]
    scores = lexicon.score_rows(lexicon.lexicon_scores(rows, settings), settings).collect()
    assert {tuple(row)[:3]: row["score"] for row in scores if row["score"]} == totals
    assert len(scores) == 3 * sum(len(labels) for labels in settings.lexicons.values())


def test_scores_need_no_shuffle(spark):
    rows = evidence(spark, [("1", ["love"], [])])
    plan = lexicon.lexicon_scores(rows, Settings())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_empty_lexicons(spark):
    row = lexicon.contributions(evidence(spark, [("1", ["a"], [])]), Settings(lexicons={})).first()
    assert row["contributions"] == []
