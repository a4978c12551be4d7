"""Spelling variants against plain comparisons of all words."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipsieve.llm import spelling

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, ratio=10):
    out = {}
    for word, n in counts.items():
        others = sorted((-m, w) for w, m in counts.items() if near(word, w))
        best = others[0] if others else (0, None)
        has = bool(others) and -best[0] >= ratio * n
        out[word] = [best[1] if has else None, n, len(others), -best[0] if has else None]
    rows = set()
    for word, (form, n, n_near, form_n) in out.items():
        root = word
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((word, form, root, n, n_near, form_n))
    return rows


def plain_words(pairs, noise=31, least=7):
    counts = Counter()
    for doc_id, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return counts


def found(frame):
    rows = [tuple(r[c] for c in COLUMNS) for r in frame.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return set(rows)


@pytest.mark.parametrize("noise, least, ratio", [(31, 7, 10), (2, 4, 3)])
def test_whole_operator(spark, rows, docs, repeated, noise, least, ratio):
    pairs = [(r[0], r[1]) for r in rows]
    doubled = pairs + pairs[::3] + [(1, "another text of one")]
    for frame, given_pairs in ((docs, pairs), (repeated, doubled)):
        counts = {w: n for w, n in plain_words(given_pairs, noise, least).items() if n >= 2}
        got = found(spelling.group_variants(frame, noise, least, ratio=ratio))
        assert got == plain_variants(counts, ratio)


def test_counts_passed_on_in_parts(docs, rows, monkeypatch):
    monkeypatch.setattr(spelling, "_HELD_WORDS", 3)
    got = {r["word"]: r["n"] for r in spelling.count_words(docs, 31, 4).collect()}
    assert got == dict(plain_words([(r[0], r[1]) for r in rows], 31, 4))


def test_chains_ties_and_runs_of_letters(spark):
    counts = {
        "aaaaaaa": 5, "aaaaaaaa": 60, "aaaaaaaaa": 700, "aaaaaaab": 60, "baaaaaaa": 60,
        "éaaaaaaa": 8, "straßen": 3, "strassen": 50, "strasse": 500, "strasßen": 4, "lonesome": 9,
    }
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(spelling.variants(frame)) == plain_variants(counts)


def test_ranges_over_many_batches(spark):
    counts = {a + "x" * 5 + b: 1 + 37 * i * j % 400 for i, a in enumerate("abcdefghijk") for j, b in enumerate("abcdefghijk")}
    counts |= {a + "x" * 5: 9 for a in "abcdef"}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(spelling.variants(frame)) == plain_variants(counts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(empty):
    assert spelling.group_variants(empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=1, max_size=6), st.integers(2, 500), min_size=1, max_size=30))
def test_ranges_alone(counts):
    """The scan of one range after another, without Spark."""
    ranges = {}
    for word, n in counts.items():
        for i in range(len(word) + 1):
            ranges.setdefault(f"{word[i:]}${word[:i]}", []).append((None, n))
        for i in range(len(word)):
            ranges.setdefault(f"{word[i + 1:]}${word[:i]}", []).append((word[i], n))
    got = Counter()
    for prefix, members in ranges.items():
        members.sort(key=lambda m: (m[0] is not None, -m[1], m[0] or ""))
        for word, _, k, _, best in spelling._group(prefix, *map(list, zip(*members))):
            assert near(word, best)
            got[word] += k
    assert got == Counter({w: k for w in counts if (k := sum(near(w, v) for v in counts))})
