"""Token alignment and its counts against whole-text encoding and plain counting; the perfect hash on its own."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clipsieve.llm import alignment
from clipsieve.llm.perfect_hash import PerfectHash, build_segment

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def plain(libraries, text):
    """Ids and byte ranges of a text's tokens by both libraries; None without tokens."""
    a, b = libraries
    if not text:
        return None
    plain_bytes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain_bytes}
    letters |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain_bytes)}
    found, ids = a.encode(" " + text, add_special_tokens=False), b.encode(text, num_threads=1)
    parts_a = [bytes(letters[c] for c in t) for t in found.tokens]
    parts_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in ids
    ]
    if b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
        return None
    return (found.ids, list(itertools.accumulate(map(len, parts_a)))), (ids, list(itertools.accumulate(map(len, parts_b))))


def links_and_groups(found):
    (a, ends_a), (b, ends_b) = found
    starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
    links, j = [], 0
    for i in range(len(a)):
        while ends_b[j] <= starts_a[i]:
            j += 1
        k = j
        while k < len(b) and starts_b[k] < ends_a[i]:
            links.append((a[i], b[k]))
            k += 1
    groups, at_a, at_b = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        i, j = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(f"{','.join(map(str, a[at_a:i]))}|{','.join(map(str, b[at_b:j]))}")
        at_a, at_b = i, j
    return links, groups


def plain_rows(libraries, pairs):
    described, counts, best = [], Counter(), defaultdict(int)
    for doc_id, text in pairs:
        found = plain(libraries, text)
        described.append((doc_id, found, *(links_and_groups(found) if found else ((), ()))))
        counts.update(set(described[-1][2]))
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for doc_id, found, links, groups in described:
        if not found:
            rows.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        n_best = sum(counts[x] == best[x[0]] for x in links)
        sums = sum(counts[x] for x in links)
        rows.append((doc_id, len(found[0][0]), len(found[1][0]), len(groups), len(links), n_best, sums, digest))
    return rows, counts


def odd_texts(n=1500):
    rng = random.Random(5)
    pieces = list("abcXYZ éßñ.,'\"#*&%$!?0123\n\t\r  \x0b\x1c\x85\xa0▁　中\U0001f600-_/\\|")
    pieces += [" the", "'ll", "<|endoftext|>", "  ", "\n\n", "<0x0A>", "<s>", "</s>", "ing", "\x00", " \r\n", "é"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_units_are_the_whole_text(libraries):
    given = alignment.encoder(PATH_A, PATH_B)
    assert given.cuts
    texts = odd_texts() + [None, "", " ", "\n"]
    for text, (a, b) in zip(texts, given.encode(texts)):
        found = plain(libraries, text)
        ids = [np.frombuffer(x, kind).tolist() for x, kind in zip((a, b), given.kinds)]
        assert ids == ([found[0][0], found[1][0]] if found else [[], []]), repr(text)


def check(libraries, frame, pairs, **bounds):
    expected, _ = plain_rows(libraries, pairs)
    got = [tuple(r[c] for c in COLUMNS) for r in alignment.aligned(frame, PATH_A, PATH_B, **bounds).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_documents(spark, libraries, rows, docs, repeated):
    pairs = [(r[0], r[1]) for r in rows]
    check(libraries, docs, pairs)
    check(libraries, repeated, pairs + pairs[::3] + [(1, "another text of one")])


def test_many_segments_tables_and_levels(spark, libraries, rows, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 64)
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 100)
    monkeypatch.setattr(alignment, "_DOCS_AT_ONCE", 5)
    pairs = [(r[0], r[1]) for r in rows] + list(enumerate(odd_texts(60), 500))
    frame = spark.createDataFrame(pairs, "doc_id long, text string").repartition(7)
    check(libraries, frame, pairs, segment_pairs=50, table_pairs=400)


def test_pair_counts(libraries, docs, rows):
    _, counts = plain_rows(libraries, [(r[0], r[1]) for r in rows])
    got = alignment.pair_counts(docs, PATH_A, PATH_B, segment_pairs=300, table_pairs=1000).collect()
    assert Counter({(r["a_id"], r["b_id"]): r["n_docs"] for r in got}) == counts and len(got) == len(counts)


def test_empty_table(empty):
    assert alignment.aligned(empty, PATH_A, PATH_B).collect() == []
    assert alignment.pair_counts(empty, PATH_A, PATH_B).collect() == []


@pytest.mark.parametrize("sizes", [[0], [1], [5, 0, 1], [4000, 17, 300, 0]])
def test_perfect_hash(sizes):
    rng = np.random.default_rng(2)
    segments = [np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64)) for n in sizes]
    table = PerfectHash.join([build_segment(s) for s in segments])
    keys = np.concatenate([np.zeros(0, np.uint64), *segments])
    of = np.repeat(np.arange(len(sizes)), [len(s) for s in segments])
    index = table.index(keys, of)
    assert sorted(index.tolist()) == list(range(table.n)) and table.n == len(keys)
    assert (table.keys[index] == keys).all()
    strangers = np.setdiff1d(rng.integers(0, 1 << 62, 2000, dtype=np.uint64), keys)
    assert (table.index(strangers, rng.integers(0, len(sizes), len(strangers))) == -1).all()


def test_perfect_hash_refuses_equal_keys():
    with pytest.raises(ValueError):
        build_segment(np.array([7, 7], np.uint64))
