"""Near-duplicates, repeated byte strings and repeated word windows against plain versions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipsieve.llm import components, simhash, substring_dedup, suffix_dedup, windows
from pyspark.sql import functions as F
from tests.llm import brute
from tests.llm.conftest import pairs


def with_ids(rows):
    return [(windows.NULL_ID if d is None else d, t) for d, t in pairs(rows)]


def test_simhash_components(docs, rows):
    known = [(d, t) for d, t in pairs(rows) if d is not None]
    prints = {d: brute.fingerprint(t) for d, t in known}
    roots = brute.components(prints)
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    assert len(found) == len(rows)
    for d in prints:
        assert (found[d]["fingerprint"], found[d]["component_id"]) == (prints[d], roots[d])
    assert found[100]["fingerprint"] == "0" * 16 and found[102]["component_id"] == roots[100]
    assert found[None]["component_id"] is None  # no row with an id is near it


def test_simhash_repeated_and_empty(repeated, empty, rows):
    assert simhash.near_duplicates(repeated).count() == repeated.count()
    assert simhash.near_duplicates(empty).collect() == []


def test_small_blocks_find_the_same_links(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 12)
    values = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 62, (30, 2))}
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    counts = simhash.part_counts(F.col("fp"), 4)
    expected = brute.components({v: f"{v:016x}" for v in values})
    for block_rows in (7, 1 << 14):
        roots = components.connected(simhash.links(distinct, counts, block_rows=block_rows)).collect()
        found = {v: v for v in values} | {r["node"]: r["root"] for r in roots}
        assert found == expected


def test_keep_one(spark, repeated, empty):
    base = " ".join(f"w{i}" for i in range(300))
    near = base.replace("w150", "other").replace("w7 ", "more ")
    far = base.replace("w1", "q")
    rows = [(5, near), (3, base), (9, far), (9, far), (None, base), (11, None), (12, ""), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("first", F.lit(1))
    kept = simhash.keep_one(frame).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(3, base), (9, far), (11, None)]
    assert simhash.keep_one(repeated).columns == repeated.columns
    assert simhash.keep_one(empty).collect() == []


def test_keep_one_compares_sets_without_repeats(spark):
    """Filler that is repeated does not make texts equal, nor texts of one set different."""
    filler = " ".join(f"f{i}" for i in range(23))
    own = [" ".join(f"{x}{i}" for i in range(400)) for x in "ab"]
    rows = [(1, f"{filler} " * 200 + own[0]), (2, f"{filler} " * 200 + own[1]), (3, f"{filler} " * 2 + own[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(frame).collect()) == [1, 2]


def test_keep_one_checks_links_that_others_stand_in_for(spark):
    """Of three texts two are at Jaccard 0.81, both at 0.794 to the one between them."""
    rows = []
    for k in range(40):
        first = [f"t{k}w{i}" for i in range(100)]
        last, between = list(first), list(first)
        for text, places in ((last, (20, 60)), (between, (20, 40, 99))):
            for i in places:
                text[i] = f"t{k}x{i}"
        rows += [(3 * k + i, " ".join(t)) for i, t in enumerate((first, between, last))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(frame).collect()) == [i for i in range(120) if i % 3 < 2]


def shingles(text, size=5):
    words = text.split()
    return zip(*(words[i:] for i in range(size)))


def two_groups(m, rng):
    """Texts of two groups: shingle sets alike by about 0.98 inside a group and 0.76 across."""
    shared = [f"w{i}" for i in range(500)]
    texts = []
    for side in "ab":
        body = shared[:432] + [f"{side}{i}" for i in range(68)]
        for k in range(m):
            words = list(body)
            words[rng.randrange(5, 400)] = f"{side}x{k}"
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("m, block_rows", [(2000, 2048), (150, 40)])
def test_links_of_two_large_groups_below_the_limit(spark, monkeypatch, m, block_rows):
    texts = two_groups(m, random.Random(4))
    inside, across = (len(a & b) / len(a | b) for a, b in ([set(shingles(texts[i])), set(shingles(texts[j]))] for i, j in ((0, 1), (0, m))))
    assert inside > 0.9 and 0.7 < across < 0.8
    counted, plain = [], simhash._links_in_groups

    def counting(*given):
        found = plain(*given)
        counted.append((given[0].count(), found.count()))
        return found

    monkeypatch.setattr(simhash, "_links_in_groups", counting)
    monkeypatch.setattr(simhash, "SET_BLOCK_ROWS", block_rows)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    assert sorted(r["doc_id"] for r in simhash.keep_one(frame).collect()) == [0, m]
    for n_rows, n_links in counted:
        assert n_links <= n_rows


@pytest.mark.parametrize("block_rows", [1, 3, 2048])
def test_links_in_groups_against_all_pairs(spark, monkeypatch, block_rows):
    rng = random.Random(8)
    monkeypatch.setattr(simhash, "SET_BLOCK_ROWS", block_rows)
    base = [rng.sample(range(1, 400), 60) for _ in range(3)]
    rows, sets = [], {}
    for fp in range(60):
        grams = set(base[fp % 3])
        for _ in range(rng.randrange(0, 14)):
            grams.discard(rng.choice(sorted(grams)))
            grams.add(rng.randrange(1, 400))
        code = simhash.wide_fingerprint(np.array(sorted(grams), np.uint64) * np.uint64(0x9E3779B97F4A7C15), 4)
        sets[fp] = grams
        rows.append((fp, fp % 2, fp // 2 * 2 if fp % 10 == 2 else fp, code.tobytes(), len(grams)))
    frame = spark.createDataFrame(rows, "fp long, group long, root long, code binary, n_grams int")
    shipped = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "fp long, grams array<long>")
    found = simhash._links_in_groups(frame, shipped, 0.8, 256).collect()

    def components(links):
        above = {r[0]: r[2] for r in rows}
        changed = True
        while changed:
            changed = False
            for a, b in links:
                low = min(above[a], above[b])
                for x in [k for k in above if above[k] in (above[a], above[b])]:
                    changed |= above[x] != low
                    above[x] = low
        return above

    true = [
        (a, b) for a in sets for b in sets
        if a < b and a % 2 == b % 2 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    assert len(true) > 10
    for r in found:
        assert (min(r), max(r)) in true
    assert components([tuple(r) for r in found]) == components(true)


def test_keep_one_small_sets(spark):
    """Eight words and the same with a ninth: four of five shingles."""
    rows = [(2 * i + j, " ".join(f"w{i}x{k}" for k in range(8 + j))) for i in range(200) for j in range(2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.keep_one(frame).collect()} == set(range(0, 400, 2))


def test_connected_long_path(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (None, 3), (200, 200)]
    found = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61)) and found[101] == 100 and found[200] == 200


def test_suffix_dedup(docs, rows):
    expected = brute.remove_bytes(with_ids(rows))
    found = suffix_dedup.remove_repeats(docs)
    found = found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")).collect()
    got = {windows.NULL_ID if r[0] is None else r[0]: tuple(r)[1:] for r in found}
    assert got == expected and sum(x[1] for x in expected.values()) > 0


@pytest.mark.parametrize("rule", [suffix_dedup.rule(), substring_dedup.rule()], ids=["bytes", "words"])
def test_groups_cut_apart_between_blocks(spark, docs, rule):
    """A partition read in blocks of a few rows gives the spans of one read at once."""

    def spans(block_rows):
        found = windows.removed_spans(docs, rule, block_rows).collect()
        out = set()
        for r in found:
            for s in r["spans"]:
                out |= {(r["doc"], r["tie"], i) for i in range(s["start"], s["end"])}
        return out

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "3")
    try:
        small = spans(3)
    finally:
        spark.conf.unset(key)
    assert small == spans(windows.ROWS) and small


@pytest.mark.parametrize("block", [5, 1 << 19])
def test_small_blocks_remove_the_same(spark, docs, rows, monkeypatch, block):
    """Blocks that cut groups apart give the same result; workers see the bounds through the closure."""
    known = [(1, "ab" * 150), (2, "x" + "ab" * 120), (3, "q" * 400), (4, "ab" * 150), (5, "q" * 130 + "r" * 20)]
    frame = spark.createDataFrame(known, "doc_id long, text string").coalesce(1)
    batches = frame.select("doc_id", F.col("text")).toArrow().to_batches()
    monkeypatch.setattr(windows, "ROWS", block)
    monkeypatch.setattr(windows, "WINDOWS", block)
    rule = suffix_dedup.rule()
    schema = windows.to_arrow(windows._parsed(windows._ROWS))
    settler = windows._Settler(rule, schema)
    total = 0
    for batch in batches:
        for doc, key, values in windows._documents(batch, rule.units):
            n = len(values) - rule.length + 1
            if n > 0:
                at = np.arange(n)
                wh = windows._signed(windows.window_hashes(values, at, rule.length))
                out = settler.add(np.zeros(n, np.int64), wh, np.full(n, doc), np.int64(key) << 40 | at << 8 | 1)
                total += sum(b.num_rows for b in out)
    assert total + sum(b.num_rows for b in settler.flush()) > 0
    found = suffix_dedup.remove_repeats(frame).select("row.doc_id", "n_bytes", "n_removed", "n_spans").collect()
    assert {r[0]: tuple(r)[1:] for r in found} == {d: x[:3] for d, x in brute.remove_bytes(known).items()}


def test_dedup_repeated_rows(repeated, empty, rows):
    """Rows with one id and text count as one document; with one id and another text as another."""
    found = suffix_dedup.remove_repeats(repeated).select("row.doc_id", "n_removed", "row.text").collect()
    assert len(found) == repeated.count()
    expected = brute.remove_bytes(with_ids(rows))
    for r in found:
        if r["text"] != "another text of one":
            assert r["n_removed"] == expected[windows.NULL_ID if r["doc_id"] is None else r["doc_id"]][1]
    words = substring_dedup.remove_repeats(repeated).select("row.doc_id", "n_removed", "row.text").collect()
    plain = brute.remove_words(with_ids(rows))
    for r in words:
        if r["text"] != "another text of one":
            assert r["n_removed"] == plain[windows.NULL_ID if r["doc_id"] is None else r["doc_id"]][1]
    assert suffix_dedup.remove_repeats(empty).collect() == [] and substring_dedup.remove_repeats(empty).collect() == []


@pytest.mark.parametrize("copies", [2, 5])
def test_suffix_dedup_copies_in_one_task(spark, copies):
    """Repeated rows that meet in one task after a shuffle join count as one document."""
    rng = np.random.default_rng(8)
    letters = ["".join(map(chr, rng.integers(97, 123, 300))) for _ in range(5)]
    known = [(1, letters[0] + letters[1] + letters[2]), (2, letters[3] + letters[1] + letters[4])]
    frame = spark.createDataFrame(known * copies, "doc_id long, text string").coalesce(1)
    options = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "1"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        found = suffix_dedup.remove_repeats(frame).select("row.doc_id", "n_bytes", "n_removed", "n_spans").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    expected = {d: x[:3] for d, x in brute.remove_bytes(known).items()}
    assert len(found) == 2 * copies and all(tuple(r)[1:] == expected[r[0]] for r in found)


def test_texts_without_id_that_share_a_checksum(spark):
    """Null ids and ties that are equal: neither text gets the spans of the other."""
    rng = np.random.default_rng(9)
    words = lambda n: " ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(n))
    shared, long = words(40), words(120)
    ties = {}
    while True:
        short = words(50)
        if (other := ties.setdefault(windows.tie(short.encode()), short)) != short:
            break
    rows = [(None, other), (None, short), (None, f"{shared} {long}"), (1, f"{other} {shared}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.remove_repeats(frame).select("row.text", "n_removed").collect()
    assert {r[0]: r[1] for r in found} == {other: 50, short: 0, f"{shared} {long}": 40, f"{other} {shared}": 90}
    found = suffix_dedup.remove_repeats(frame).select("row.text", "n_removed").collect()
    assert {r[0]: r[1] for r in found if r[0] in (other, short)} == {other: 0, short: 0}


def test_substring_dedup(docs, rows):
    expected = brute.remove_words(with_ids(rows))
    found = substring_dedup.remove_repeats(docs)
    found = found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha")).collect()
    got = {windows.NULL_ID if r[0] is None else r[0]: tuple(r)[1:] for r in found}
    assert got == expected and sum(x[1] for x in expected.values()) > 0


@settings(max_examples=30, deadline=None)
@given(st.text("ab", max_size=300))
def test_previous_factors(text):
    data = np.frombuffer(text.encode() + bytes(40), np.uint8)
    starts = np.arange(len(text))
    order, common = suffix_dedup.suffix_order(data, starts, 32)
    factors = np.zeros(len(text), int)
    factors[order] = suffix_dedup.previous_factors(order, common)
    raw = text.encode() + bytes(40)
    for i in range(len(text)):
        best = 0
        for j in range(i):
            k = 0
            while k < 32 and raw[i + k] == raw[j + k]:
                k += 1
            best = max(best, k)
        assert factors[i] == best


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=200), st.integers(1, 12))
def test_cells_cover_every_window_once(units, gram):
    values = windows.mix(np.array(units, np.uint64) + np.uint64(1))
    length = 12
    first, count, _, _ = windows.cells(values, np.array([len(values)]), length, gram)
    covered = [w for f, c in zip(first, count) for w in range(f, f + c)]
    assert covered == list(range(max(0, len(values) - length + 1)))
