"""Language, personal data, packing, BPE, token files and quality against plain versions."""

import random
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import base64
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clipsieve.llm import byte_bpe, language, packing, pii, quality, token_files
from clipsieve.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY
from tests.llm import brute
from tests.llm.conftest import pairs


@pytest.fixture(scope="module")
def words():
    tokenizer = Tokenizer.from_file(WORD_VOCABULARY)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tiktoken_encoding():
    with open(BYTE_VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


# language


def test_language(spark, docs, empty, rows):
    rng = random.Random(5)
    sample = {x: ["".join(rng.choice(a) for _ in range(3000))] for x, a in (("aa", "abc "), ("bb", "xyz "))}
    model = language.train(sample)
    assert [p[0] for p in model.predict(["abcab cba", "Zyx XYZ", "12 !", ""])] == ["aa", "bb", "und", "und"]
    found = {r["doc_id"]: r for r in language.identify(docs, language.fit(docs)).collect()}
    assert len(found) == len(rows)
    assert all(found[i]["lang_pred"] == "und" for i in (100, 101, 102, 103))
    assert found[104]["lang_pred"] in ("de", "en") and 0 <= found[104]["score"] <= 1
    nothing = language.fit(empty)
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(empty, model).collect() == []
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=80))
def test_phrases_are_longest_matches(text, sample):
    automaton = language.SuffixAutomaton(sample)
    model = language.LanguageModel(["x"], [automaton.phrase_table(8)], [1.0], {}, 8)
    found = int(model.phrases([np.array(text, np.uint8)])[0, 0])
    expected, at, joined = 0, 0, [tuple(sample[i:j]) for i in range(len(sample)) for j in range(i, len(sample) + 1)]
    known = set(joined)
    while at < len(text):
        end = at + 1
        while end < len(text) and tuple(text[at : end + 1]) in known and tuple(text[at:end]) in known:
            end += 1
        expected, at = expected + 1, end
    assert found == expected


def test_phrases_of_many_texts():
    """Segments of many lengths side by side give what each text gives alone."""
    rng = random.Random(8)
    sample = {x: ["".join(rng.choice(a) for _ in range(900))] for x, a in (("aa", "abcé "), ("bb", "xyzé "))}
    model = language.train(sample)
    texts = [model.to_symbols("".join(rng.choice("abcxyzéq ") for _ in range(rng.randrange(90)))) for _ in range(60)]
    together = model.phrases(texts, segment=16)
    alone = [sum(model.phrases([t[at : at + 16]])[0] for at in range(0, len(t), 16)) for t in texts]
    assert all((a == b).all() for a, b in zip(together, alone))


def test_language_without_caps(spark):
    """Eighty languages, three of them with a thousand letters, are all found; an unknown script is not."""
    rng = random.Random(4)
    alphabets = {f"l{i:02}": [chr(0xAC00 + 9 * i + j) for j in range(9)] for i in range(77)}
    alphabets |= {f"w{i}": [chr(0x4E00 + 1000 * i + j) for j in range(1000)] for i in range(3)}
    assert len(alphabets) == 80 and all(c.lower().isalpha() for own in alphabets.values() for c in own)
    text = lambda own, n: "".join(rng.choice([*own, " "]) if rng.random() < 0.8 else " " for _ in range(n))
    labelled = [(text(own, 1500), lang) for lang, own in alphabets.items() for _ in range(2)]
    model = language.fit(spark.createDataFrame(labelled, "text string, lang string"))
    assert model.languages == sorted(alphabets)
    short = [(lang, text(own, 60) + own[0]) for lang, own in alphabets.items() for _ in range(3)]
    assert [found[0] for found in model.predict([t for _, t in short])] == [lang for lang, _ in short]
    thai = spark.createDataFrame([(1, "".join(chr(0xE01 + rng.randrange(46)) for _ in range(300)))], "doc_id long, text string")
    assert language.identify(thai, model).first()["bits"] > 10 and language.keep_identified(thai, model).count() == 0


def test_language_sample(spark):
    """Copies fill one place of the sample, texts are whole, and only a language of long texts has one of them."""
    copies = [("the very same words", "en")] * 100 + [(f"other words {chr(97 + i)}", "en") for i in range(5)]
    long = [("é" * 700, "fr"), ("è" * 600, "fr"), ("q" * 600 + "z", "en")]
    frame = spark.createDataFrame(copies + long + [(None, "en"), ("x", None)], "text string, lang string").repartition(4)
    taken = {}
    original, language.train = language.train, lambda texts: taken.update(texts)
    try:
        language.fit(frame, sample_rows=64, sample_chars=500)
    finally:
        language.train = original
    assert sorted(taken["en"]) == sorted({t for t, _ in copies}) and taken["fr"] == ["è" * 600]


# personal data


def test_pii_against_plain_patterns(docs, empty, rows):
    found = {r["doc_id"]: r.asDict() for r in pii.digest(docs).collect()}
    for doc_id, text in pairs(rows):
        for key, value in brute.pii_row(text).items():
            assert found[doc_id][key] == value, (doc_id, key)
    assert pii.digest(empty).collect() == []


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c_d@e.f x..y@z-.q.w a@b a@.b @c.d a@b.c@d.e é@ü.de +@x.yy",
        "1.2.3.4.5 256.1.1.1 0.0.0.0 001.002.003.004 1.2.3 1..2.3.4 99999999999.1.1.1",
        "4111 1111-1111 1111 41111111111111111 4111  1111 1111 1111 0000000000000000000 -4111111111111111-",
        "+1 (555) 123-4567 +1-----2 ++12345678 +123456789012345 +1234567890123456 + 12345678 +1(((((9",
        "+4111111111111111 10.0.0.1@x.org +10.0.0.1.5",
    ],
)
def test_pii_corner_cases(spark, text):
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert {k: v for k, v in pii.digest(frame).first().asDict().items() if k in brute.pii_row(text)} == brute.pii_row(text)


def test_pii_long_runs(spark):
    long = ["7 " * 100_000, "a." * 100_000 + "@", "x@" + "b." * 50_000 + "c", "+" + "1(" * 100_000, "9" * 200_000]
    frame = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    assert [r["n_email"] for r in pii.digest(frame).orderBy("doc_id").collect()] == [0, 0, 1, 0, 0]


def test_pii_many_spans(spark):
    """The cost of a text grows with its length, not with the square of its spans."""
    text = " ".join(f"é{i} mail a{i}@b.org," for i in range(100_000))
    frame = spark.createDataFrame([(1, text), (1, text), (2, "a@b.org" * 3)], "doc_id long, text string")
    began = time.perf_counter()
    found = pii.digest(frame).where("doc_id = 1").collect()
    masked = [r["text"] for r in pii.mask(frame).where("doc_id = 1").collect()]
    assert time.perf_counter() - began < 40
    expected = brute.pii_row(text)
    assert len(found) == 2 and all({k: r[k] for k in expected} == expected for r in found)
    assert masked == [" ".join(f"é{i} mail [EMAIL]," for i in range(100_000))] * 2


def test_pii_context_over_matches(spark):
    """Context words count over the matches before a span, and only within their distance."""
    texts = ["bank 123-45-6789 social security 123-45-6789 123-45-6789", "ssn" + " " * 36 + " 123-45-6789", "ssn" + " " * 36 + "  123-45-6789"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["spans"].count("ssn:") for r in pii.digest(frame).orderBy("doc_id").collect()] == [2, 1, 0]


def test_pii_added_kinds_and_mask(spark):
    texts = [
        "iban DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432",
        "DE88370400440532013000",
        "her ssn 123-45-6789", "part 123-45-6789",
        "mail a@b.org and 10.0.0.1", None,
    ]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, email string, found string")
    spans = {r["doc_id"]: r["spans"] for r in pii.digest(frame).collect()}
    assert spans[0].count("iban") == 2 and spans[1] == "" and "ssn" in spans[2] and spans[3] == ""
    masked = {r["doc_id"]: r for r in pii.mask(frame).collect()}
    assert masked[4]["text"] == "mail [EMAIL] and [IP]" and masked[5]["text"] is None and masked[4]["email"] == "x"
    assert masked[3]["text"] == texts[3]


@pytest.mark.parametrize("after", ["BIC", "2024", "50", "X1 DE89 3704 0044 0532 0130 00", ""])
@pytest.mark.parametrize(
    "number", ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201", "NO93 8601 1117 947"]
)
def test_pii_account_before_a_short_word(spark, number, after):
    frame = spark.createDataFrame([(1, f"IBAN {number} {after}")], "doc_id long, text string")
    assert pii.digest(frame).first()["spans"].split(",")[0] == f"iban:5:{5 + len(number)}"


# packing


@pytest.mark.parametrize("weights", [None, {"s0": 3, "s2": 1}, {"absent": 1, None: 2}])
def test_packing_keeps_every_token(docs, rows, words, weights):
    found = packing.pack(docs, WORD_VOCABULARY, window=64, weights=weights).collect()
    expected = {d: words(t) + [2] for d, t in pairs(rows)}
    pieces, places = {}, {}
    for r in found:
        ids = expected[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == brute.crc(ids[r["start"] : r["start"] + r["length"]])
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, own in pieces.items():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == len(expected[d])
    sizes = []
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        sizes.append(at)
    assert sum(s != 64 for s in sizes) <= 1 and sorted(places) == list(range(len(places)))


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "A<|endoftext|>B <|ENDOFTEXT|> É<|startoftext|>", "<|x|> <|endoftext|", "É <| B"])
def test_special_strings_are_read_as_the_library_does(spark, words, text):
    frame = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    assert packing.pack(frame, WORD_VOCABULARY).first()["ids_crc32"] == brute.crc(words(text) + [2])
    files = token_files.write_tokens(frame, WORD_VOCABULARY)
    assert token_files.read_documents(files).first()["ids_crc32"] == brute.crc(words(text) + [1])


def test_packing_refuses_more_weights_than_queues(docs):
    with pytest.raises(ValueError):
        packing.pack(docs, WORD_VOCABULARY, weights={f"s{i}": 1 for i in range(70)})
    found = packing.pack(docs, WORD_VOCABULARY, window=64, weights={f"s{i}": 1 for i in range(70)}, queues=71)
    assert found.select("queue").distinct().count() >= 3


def test_packing_mixture_and_empty(docs, empty, repeated):
    assert packing.pack(empty, WORD_VOCABULARY).collect() == []
    assert packing.pack(repeated, WORD_VOCABULARY).count() >= repeated.count()
    schedule = packing.Schedule([1000, 3000, 17], [1, 3, 0], 40)
    for r in range(80):
        before, after = schedule.served(r), schedule.served(r + 1)
        taken = [b - a for a, b in zip(before, after)]
        if r < 90 and before[0] < 900:
            assert abs(taken[0] - 10) <= 1 and abs(taken[1] - 30) <= 1
    assert schedule.served(schedule.rounds) == [1000, 3000, 17]


# byte-level BPE


@settings(max_examples=150, deadline=None)
@given(st.text("aabbcde theing'sé中😀1 \n\t.", max_size=60))
def test_bpe_equals_the_library(text):
    with open(BYTE_VOCABULARY, "rb") as f:
        global _library
        if "_library" not in globals():
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            _library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.text_encoder(BYTE_VOCABULARY, P.PATTERN)
    ids = encoder.encode(text)
    assert ids == _library.encode_ordinary(text) and encoder.decode(ids) == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.text("the andingr", max_size=120), st.integers(0, 120), st.integers(0, 6), st.text("xing ", max_size=6))
def test_bpe_edits(text, start, cut, new):
    ranks = byte_bpe.text_encoder(BYTE_VOCABULARY, P.PATTERN).ranks
    data = text.encode()
    start = min(start, len(data))
    stop = min(start + cut, len(data))
    edited = byte_bpe.Prefixes(ranks, data)
    edited.replace(start, stop, new.encode())
    fresh = byte_bpe.Prefixes(ranks, data[:start] + new.encode() + data[stop:])
    assert edited.data == fresh.data and edited.last == fresh.last
    appended = byte_bpe.Prefixes(ranks, data[:start])
    appended.append(data[start:])
    assert appended.ids() == byte_bpe.Prefixes(ranks, data).ids()


def test_bpe_documents(docs, empty, repeated, rows, tiktoken_encoding):
    found = {r["doc_id"]: r for r in byte_bpe.digest_documents(docs, BYTE_VOCABULARY, P.PATTERN).collect()}
    for doc_id, text in pairs(rows):
        ids = tiktoken_encoding.encode_ordinary(text or "")
        r = found[doc_id]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == brute.sha(" ".join(map(str, ids)).encode())
        assert r["decoded_sha256"] == brute.sha((text or "").encode())
    encoded = byte_bpe.encode_documents(repeated, BYTE_VOCABULARY, P.PATTERN)
    assert encoded.count() == repeated.count()
    assert byte_bpe.digest_documents(empty, BYTE_VOCABULARY, P.PATTERN).collect() == []


# token files


@pytest.mark.parametrize("chunk_ids,plane", [(1 << 16, "bit"), (50, "bit"), (50, "byte")])
def test_token_files_round_trip(docs, rows, words, chunk_ids, plane):
    files = token_files.write_tokens(docs, WORD_VOCABULARY, chunk_ids=chunk_ids, plane=plane)
    found = {r["doc_id"]: r for r in token_files.read_documents(files).collect()}
    start = 0
    for doc_id, text in sorted(pairs(rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = words(text) + [1]
        r = found[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), brute.crc(ids))
        start += len(ids)
    index = files.collect()
    assert all(len(r["payload"]) == sum(r["plane_bytes"]) and r["n_ids"] <= chunk_ids for r in index)


def test_token_files_repeated_and_empty(repeated, empty):
    found = token_files.read_documents(token_files.write_tokens(repeated, WORD_VOCABULARY, chunk_ids=64)).collect()
    assert len(found) == repeated.count()
    at = 0
    for r in sorted(found, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert token_files.read_documents(token_files.write_tokens(empty, WORD_VOCABULARY)).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**16 - 1), min_size=1, max_size=70), st.sampled_from(["bit", "byte"]))
def test_planes(ids, plane):
    for bits in (16, 24, 32):
        assert token_files.from_planes(token_files.to_planes(np.array(ids), bits, plane), len(ids)).tolist() == ids


# quality


def plain_quality(text):
    data = text or ""
    split = data.encode().split()
    n = len(split)
    seen = {}
    for i in range(n - 4):
        seen.setdefault(tuple(split[i : i + 5]), []).append(i)
    covered = {j for places in seen.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    lines = [x for x in data.split("\n") if x.encode().split()]
    return (
        n, sum(len(w.decode()) for w in split), sum(c in "#*$%&|<>" for c in data),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n,
    )


def test_quality(spark, docs, empty, repeated, rows):
    found = {r["doc_id"]: r for r in quality.measure(docs).collect()}
    for doc_id, text in pairs(rows):
        r = found[doc_id]
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == plain_quality(text), doc_id
        assert not (r["kept"] and r["base_failed"])
    assert found[101]["ratio"] is None and quality.measure(empty).collect() == []
    assert quality.measure(repeated).count() == repeated.count()


def test_quality_bands():
    rng = random.Random(2)
    noise = "".join(chr(rng.randrange(33, 127)) for _ in range(20_000)).encode()
    prose = " ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(3000)).encode()
    for data, bad in ((noise, True), (b"over and over again " * 900, True), (prose, False)):
        ratio, chunks, outside = quality.compression(data, quality.CHUNK_BYTES)
        assert (quality.outside(ratio, len(data)) or outside > quality.BAD_CHUNKS * chunks) == bad
    many = [f"w{i}".encode() for i in range(70_000)] * 2
    assert quality.repeat_words(many) == len(many)


@pytest.mark.parametrize("size", [128, 200, 260, 400, 1024, 4000, 20_000])
def test_quality_finds_planted_noise(size):
    rng = random.Random(size)
    base_64 = b" ".join(base64.b64encode(rng.randbytes(6)) for _ in range(size // 9 + 1))[:size]
    hexadecimal = b" ".join(rng.randbytes(4).hex().encode() for _ in range(size // 9 + 1))[:size]
    repeated = (b"buy now cheap pills " * 1000)[:size]
    found = [quality.outside(quality.compression(x, 1 << 20)[0], size) for x in (base_64, hexadecimal, repeated)]
    assert found == [True, size >= 3072, True]
