"""Entity extraction against hand-made values."""

from pyspark.sql import functions as F

from clipsieve import Settings, schemas
from clipsieve.operators import entities
from clipsieve.operators.evidence import prepare_evidence
from clipsieve.operators.hooks import with_model_entities
from clipsieve.sources.posts import ingest

SETTINGS = Settings()


def evidence(spark, rows, columns="id string, desc string, challenges string"):
    return prepare_evidence(ingest(spark.createDataFrame(rows, columns)), SETTINGS)


def test_tag_type(values):
    found = values(entities.tag_type, ["src0 tv", "fr life", "prince", "cats", "brandtips"])
    entity, topic = "HASHTAG_ENTITY", "HASHTAG_TOPIC"
    assert found == [entity, topic, entity, topic, topic]


def test_rejection_order(spark):
    cases = [
        ("!!!", "PERSON", "punct"),
        ("", "PERSON", "punct"),
        ("2024", "HASHTAG_TOPIC", "digit_only"),
        ("a@b", "PERSON", "handle_mistype"),
        ("@a", "HANDLE", None),
        ("The", "PERSON", "noise"),
        ("x" * 81, "WORK", "too_long"),
        ("x" * 80, "WORK", None),
        ("日本", "WORK", None),
    ]
    frame = spark.createDataFrame([(i, *case[:2]) for i, case in enumerate(cases)], "i int, e string, t string")
    reason = entities.reject_reason(F.col("e"), F.col("t"), SETTINGS.noise)
    assert [row[0] for row in frame.orderBy("i").select(reason).collect()] == [c[2] for c in cases]


def test_canonical(values):
    found = values(entities.canonical, ["  ﬁne   x ", "plain", "Ａ　b"])
    assert found == ["fine x", "plain", "A b"]


def test_phrases_read_inside_marks(spark):
    frame = spark.createDataFrame(
        [("r", "1", "<HANDLE>@JohnDoe</HANDLE> <URL> New York City iPhone [HASHTAG: Foo]", [], [])],
        "run_id string, video_id string, ner_text string, hashtags_list_raw array<string>, "
        "hashtags_list_norm array<string>",
    )
    rows = entities.mentions(entities.candidates(frame, SETTINGS)).collect()
    phrases = [row["entity_surface"] for row in rows if row["source"] == "DESC_MODEL"]
    assert phrases == ["John", "Doe", "New York City", "Phone", "Foo"]


def test_all_sources(spark):
    rows = evidence(
        spark,
        [("1", "hi @Some.One", '["#New_Life","ﬁx tv"]', "Big Song", ""), ("2", "", "#the", None, None)],
        "id string, desc string, challenges string, music_title string, poi_name string",
    )
    found = entities.candidates(rows, SETTINGS)
    listed = [
        (r["video_id"], r["entity_surface"], r["entity_canon"], r["entity_type"], r["source"], r["confidence"])
        for r in entities.mentions(found).collect()
    ]
    assert listed == [
        ("1", "@Some.One", "@some.one", "HANDLE", "HANDLE_REGEX", 0.99),
        ("1", "#New_Life", "new life", "HASHTAG_TOPIC", "HASHTAG_PARSE", 0.55),
        ("1", "ﬁx tv", "fix tv", "HASHTAG_ENTITY", "HASHTAG_PARSE", 0.75),
        ("1", "Some", "some", "PERSON", "DESC_MODEL", 0.5),
        ("1", "One", "one", "PERSON", "DESC_MODEL", 0.5),
        ("1", "New", "new", "PERSON", "DESC_MODEL", 0.5),
        ("1", "Life", "life", "PERSON", "DESC_MODEL", 0.5),
        ("1", "Big Song", "big song", "WORK", "QA_STRUCTURED", 0.6),
    ]
    by_video = entities.entities_by_video(found)
    assert by_video.schema == schemas.ENTITIES_BY_VIDEO or [
        (f.name, f.dataType.simpleString()) for f in by_video.schema
    ] == [(f.name, f.dataType.simpleString()) for f in schemas.ENTITIES_BY_VIDEO]
    only = by_video.collect()
    assert [row["video_id"] for row in only] == ["1"]
    assert only[0]["entities_by_type"]["PERSON"] == ["some", "one", "new", "life"]
    rejected = entities.reject_counts(found).collect()
    assert [tuple(row) for row in rejected] == [("2", "noise", 1)]
    qa = entities.ner_qa(rows, entities.mentions(found), by_video, SETTINGS).first()
    assert qa.asDict() == {
        "universe": 2,
        "coverage": 0.5,
        "garbage_rate": 0.0,
        "handle_mistype_rate": 0.0,
    }


def test_rates_of_nothing_are_zero(spark):
    rows = evidence(spark, [("1", "nothing", None)])
    found = entities.candidates(rows, SETTINGS)
    qa = entities.ner_qa(rows, entities.mentions(found), entities.entities_by_video(found), SETTINGS)
    assert tuple(qa.first()) == (1, 0.0, 0.0, 0.0)


def test_model_replaces_the_phrase_rule(spark):
    def make_model():
        def model(texts):
            return [[("Acme", "ORG", None), ("x", "DATE", None), ("Bo", "PERSON", 0.7)] for _ in texts]

        return model

    rows = with_model_entities(evidence(spark, [("1", "Hello World", None)]), make_model)
    found = entities.mentions(entities.candidates(rows, SETTINGS)).collect()
    assert [(r["entity_surface"], r["entity_type"], r["confidence"]) for r in found] == [
        ("Acme", "ORG_BRAND", 0.8),
        ("Bo", "PERSON", 0.7),
    ]


def test_long_posts_pass_every_stage(spark):
    """Phrases, tokens and keywords of posts with 100,000 words, where a recursive pattern would end the JVM."""
    from clipsieve.operators import lexicon, profiles

    posts = [
        ("a", " ".join(["Word"] * 100_000), "[]"),
        ("b", " ".join(["same"] * 100_000), "[]"),
        ("c", "Aa " * 50_000 + "#tag " * 1000, "tag"),
    ]
    rows = evidence(spark, posts)
    found = entities.candidates(rows, SETTINGS)
    assert entities.mentions(found).select("video_id").distinct().count() >= 1
    assert lexicon.lexicon_scores(rows, SETTINGS).count() == 3
    members = spark.createDataFrame([(x, 1) for x in "abc"], "video_id string, cluster_id int")
    texts = profiles.cluster_texts(members, rows)
    assert profiles.median_topic_length(texts).first()["median_topic_length"] >= 0
    assert profiles.cluster_keywords(texts, SETTINGS, []).count() >= 1


def test_model_confidence_of_zero_stays(spark):
    rows = evidence(spark, [("a", "Some Body", "[]"), ("b", "Other Body", "[]")])

    def make_model():
        return lambda texts: [[(t, "PERSON", 0.0 if t.startswith("Some") else None)] for t in texts]

    found = {r["video_id"]: r["model_entities"][0]["confidence"] for r in with_model_entities(rows, make_model).collect()}
    assert found == {"a": 0.0, "b": 0.8}
