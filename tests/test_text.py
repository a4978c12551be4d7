"""Text views against hand-made values, for both pattern sets."""

import unicodedata

from pyspark.sql import functions as F

from clipsieve import Settings
from clipsieve.functions import text
from clipsieve.functions.arrays import value_counts
from clipsieve.functions.rules import RULES
from clipsieve.functions.unicode import nfc, nfkc, nfkc_all
from clipsieve.operators.evidence import prepare_evidence
from clipsieve.operators.hooks import language_detector
from clipsieve.operators.noise import token_noise_report
from clipsieve.settings import NoiseLists
from clipsieve.sources.posts import ingest

DESC = "Wow It's The Great_Day @a.b https://u.x/1 #Fun"


def evidence(spark, rows, settings=None, **options):
    raw = spark.createDataFrame(rows, "id string, desc string, challenges string")
    return prepare_evidence(ingest(raw), settings or Settings(), **options)


def test_normalize_token(values):
    found = values(text.normalize_token, [" #Foo_Bar ", "__", "A  b", "x　 y"])
    assert found == ["foo bar", "", "a b", "x y"]


def test_views(spark):
    row = evidence(spark, [("1", DESC, '["#New_Life"]')]).first()
    assert row["topic_text"] == "wow it's great day new life"
    assert row["lex_tokens"] == ["wow", "it's", "great day", "fun", "new", "life"]
    assert row["ner_text"] == (
        "Wow It's The Great_Day <HANDLE>@a.b</HANDLE> <URL> #Fun [HASHTAG: #New_Life]"
    )
    assert row["insufficient_topic_evidence"] is False
    assert row["hashtags_list_norm"] == ["new life"]


def test_null_text(spark):
    row = evidence(spark, [("1", None, None)]).first()
    assert (row["desc_raw"], row["topic_text"], row["ner_text"]) == ("", "", "")
    assert (row["lex_tokens"], row["noise_hits"]) == ([], [])
    assert row["insufficient_topic_evidence"] is True


def test_threshold_is_read_from_settings(spark):
    rows = [("1", "one two three", None)]
    loose = Settings(insufficient_topic_threshold=3)
    assert evidence(spark, rows).first()["insufficient_topic_evidence"] is True
    assert evidence(spark, rows, loose).first()["insufficient_topic_evidence"] is False


def test_unicode_words(spark):
    row = evidence(spark, [("1", "Élan vital naïve 日本語 #Größe https://x.y/é nach", None)]).first()
    assert row["topic_text"] == "élan vital naïve 日本語 nach"
    assert "größe" in row["lex_tokens"]


def test_noise_hits_come_from_unfiltered_tokens(spark):
    rows = [("1", "FYP viral cats the", '["follow"]')]
    assert evidence(spark, rows).first()["noise_hits"] == ["fyp", "viral", "follow"]
    report = token_noise_report(evidence(spark, rows), Settings())
    found = {(row["section"], row["token"]): (row["n"], row["rank"]) for row in report.collect()}
    assert found == {
        ("removed", "follow"): (1, 1),
        ("removed", "fyp"): (1, 2),
        ("removed", "the"): (1, 3),
        ("removed", "viral"): (1, 4),
        ("platform", "follow"): (1, 1),
        ("platform", "fyp"): (1, 2),
        ("platform", "viral"): (1, 3),
        ("kept", "cats"): (1, 1),
    }


def test_noise_lists_are_lower_case_and_distinct():
    assert NoiseLists(("The", "the"), ("X",)).all_words == ("the", "x")


def test_language_filter(spark):
    def detector(desc):
        return F.struct(F.substring(desc, 1, 2).alias("lang"), F.lit(0.6).alias("conf"))

    rows = [("1", "en one", None), ("2", "fr two", None)]

    def kept(settings, with_detector=detector):
        return [r["video_id"] for r in evidence(spark, rows, settings, detector=with_detector).collect()]

    assert kept(Settings()) == ["1"]
    assert kept(Settings(language_threshold=0.7)) == []
    assert sorted(kept(Settings(english_only=False))) == ["1", "2"]
    seen = language_detector(lambda: lambda texts: [(value[:2], 0.9) for value in texts])
    assert kept(Settings(), seen) == ["1"]
    empty = evidence(spark, [("3", "", None)], Settings(english_only=False), detector=seen).first()
    assert (empty["language_pred"], empty["language_conf"]) == ("unknown", 0.0)


def test_literal_patterns(values):
    rules = RULES["literal"]
    found = values(
        lambda x: F.regexp_extract_all(x, F.lit(rules.token), F.lit(0)), ["wow it's a \\wild world"]
    )
    assert found == [["w", "w", "'", "\\w", "w"]]
    assert values(lambda x: x.rlike(rules.punct_only), ["!!!", "WW"]) == [False, True]
    assert values(lambda x: x.rlike(rules.digits_only), ["123"]) == [False]
    tags = values(
        lambda x: F.regexp_extract_all(x, F.lit(rules.inline_tag), F.lit(0)), ["#abc #\\www x"]
    )
    assert tags == [["#\\www"]]


def test_normal_forms(values, spark):
    samples = ["plain", "été", "ﬁne ² Ⅷ", "ｆｕｌｌ", "가", "½", "ạ̇", "ſ"]
    assert values(nfc, samples) == [unicodedata.normalize("NFC", s) for s in samples]
    expected = [unicodedata.normalize("NFKC", s) for s in samples]
    assert values(nfkc, samples) == expected
    assert values(nfkc_all, [samples, ["a"], []], "array<string>") == [expected, ["a"], []]


def test_value_counts(values):
    found = values(value_counts, [["b", "a", "b", "c", "b"], [], ["x"]], "array<string>")
    assert [[tuple(item) for item in items] for items in found] == [
        [("a", 1), ("b", 3), ("c", 1)],
        [],
        [("x", 1)],
    ]


def test_literal_views(spark):
    row = evidence(spark, [("1", "wow it's #new @x\\y", "tag")], Settings(rules="literal")).first()
    assert row["topic_text"] == "w w ' w tag"
    assert row["ner_text"] == "wow it's #new <HANDLE>@x\\y</HANDLE> [HASHTAG: tag]"
