"""The pipeline's stages, each against a plain version on what the stage before kept."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clipsieve.llm import language
from clipsieve.llm.queries import held_out
from tests.llm import brute

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def make_documents():
    rng = random.Random(11)
    vocabulary = {
        lang: ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(200)]
        for lang, letters in (("en", "abcdefgh"), ("fr", "éaimnorst"), ("de", "üßklpqrs"))
    }
    rows = []
    for i in range(90):
        lang = ("en", "fr", "de")[i % 3]
        words = [rng.choice(vocabulary[lang]) for _ in range(rng.randrange(20, 120))]
        if i % 9 == 0:
            words += ["+1 (555) 123-4567", "me.too@mail.example.com", "10.1.2.3", "4111 1111 1111 1111"]
        if i % 4 == 0:
            words += [vocabulary[lang][k] for k in range(40)]
        text = " ".join(words)
        if i % 10 == 5:
            text = rows[i - 3][1]
        if i % 10 == 8:
            text = rows[i - 6][1] + " " + vocabulary[lang][0]
        rows.append((i, text, lang, f"src{i % 4}", len(text)))
    rows += [(200, None, "en", None, None), (201, "", None, "src0", 0), (202, "12 34", "en", "src1", 5)]
    rows += [(203, "жизнь прожить не поле перейти", None, "src1", 29), rows[7], (None, rows[3][1] + " xx", "en", None, 1)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(make_documents(), DOCUMENTS).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The documents before the first stage and after each one."""
    out, docs = [], spark.read.parquet(f"{folder}/documents.parquet")
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows_of(frame):
    return frame.collect()


def test_columns_stay(stages):
    for frame in stages[1:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_languages(stages):
    kept = {(r["doc_id"], r["text"]) for r in rows_of(stages[1])}
    gone = {(r["doc_id"], r["text"]) for r in rows_of(stages[0])} - kept
    assert {d for d, _ in gone} == {200, 201, 202, 203}


def test_near_copies(stages):
    def grams(text):
        words = text.lower().encode().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    rows = [(r["doc_id"], r["text"]) for r in rows_of(stages[1])]
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0]))
    sets, root = [grams(t) for _, t in order], list(range(len(order)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(order)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    expected = [order[i][0] for i in range(len(order)) if root[i] == i]
    found = [r["doc_id"] for r in rows_of(stages[2])]
    assert sorted(found) == sorted(expected) and len(found) < len(rows)


def test_repeats(stages):
    before = {r["doc_id"]: r["text"] for r in rows_of(stages[2])}
    expected = brute.remove_bytes(list(before.items()))
    after = {r["doc_id"]: r for r in rows_of(stages[3])}
    assert after.keys() == before.keys()
    for doc_id, r in after.items():
        assert r["n_chars"] == len(r["text"])
        if expected[doc_id][1] == 0:
            assert r["text"] == before[doc_id]
        else:
            assert len(r["text"].encode()) <= expected[doc_id][0] - expected[doc_id][1]
    assert any(x[1] for x in expected.values())


def test_personal_data(stages):
    before = {r["doc_id"]: r["text"] for r in rows_of(stages[3])}
    after = {r["doc_id"]: r["text"] for r in rows_of(stages[4])}
    assert after.keys() == before.keys()
    for doc_id, text in before.items():
        spans = sorted((a, b, k) for k, own in brute.pii_spans(text).items() for a, b in own)
        plain, at = "", 0
        for a, b, k in spans:
            if a >= at:
                plain += text[at:a] + f"[{k.upper()}]"
            at = max(at, b)
        assert after[doc_id] == plain + text[at:]
    assert any("[EMAIL]" in t for t in after.values())


def test_packing(stages, words_of):
    texts = {r["doc_id"]: r["text"] for r in rows_of(stages[4])}
    pieces = {}
    for r in rows_of(stages[5]):
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == texts.keys()
    for doc_id, own in pieces.items():
        ids = words_of(texts[doc_id]) + [2]
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == brute.crc(ids[at : at + r["length"]])
            at += r["length"]
        assert at == len(ids)


@pytest.fixture(scope="module")
def words_of():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(corpus_pipeline.WORD_VOCABULARY)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_run_equals_the_stages(spark, folder, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    found = corpus_pipeline.run(spark, folder)
    assert found.agg(F.sum("length")).first()[0] == stages[-1].agg(F.sum("length")).first()[0]
    by_doc = ["doc_id", "doc_tokens"]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found.select(by_doc).distinct().collect()), key=key) == sorted(
        map(tuple, stages[-1].select(by_doc).distinct().collect()), key=key
    )
    assert set(columns) <= set(found.columns)


def test_empty_tables_pass(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_accuracy_on_held_out_rows(spark):
    """On the given documents, with the sample of the query."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs, language.fit(docs.where(~held_out()))).join(docs, "doc_id").where(held_out())
    right, n = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right >= 0.97 * n and re.fullmatch(r"\d+", str(n))
