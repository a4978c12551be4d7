"""Spelling variants by permuterm rotations.

A word with its terminator is turned so that an edited place comes last: of the word ``x c y`` the rotation is
``y $ x c``. Words that differ in that place alone share all but the last code point, and the word without it,
``x y``, has the whole shared part as a rotation of its own. So with all rotations in order, the words near each
other stand side by side: a range of one prefix, where only the code point after it is skipped. A scan of the
ranges counts the neighbours and finds the most frequent one. A range has at most one word for each letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipsieve.llm.stages import write_stage
from clipsieve.llm.texts import texts_of

LETTERS = "A-Za-zÀ-ÿ"
#: Least code points and occurrences of a word, and how much more frequent its form must be.
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: One in so many runs of letters (by a hash with the document) loses a code point, so that variants occur.
NOISE = 31
TERMINATOR = "$"
_HELD_WORDS = 400_000  # words that a task counts before it passes its counts on


def _with_noise(run: str, seed: int | None, noise: int) -> str:
    """``run`` without one code point if ``noise`` divides its hash; as it is without a seed."""
    if seed is None or not noise:
        return run
    h = zlib.crc32(run.encode(), seed)
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, noise: int = NOISE, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word, n``: occurrences of the words of all ``doc_id, text``, of ``least_length`` code points at least.

    Words are maximal runs of letters with A-Z in lower case. Each task adds up its own before the shuffle.
    A null text has no words; words of a null id are taken as they are.
    """
    # Shorter runs cannot become words; the first letter of a longer one starts a match, which takes all of it.
    pattern = re.compile(f"[{LETTERS}]{{{least_length},}}")
    kind = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def drain(counts: Counter) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=kind)
        counts.clear()
        return out

    def run(batches):
        counts = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                seed = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter(pattern.findall(text.lower().decode())).items():
                    word = _with_noise(word, seed, noise)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= _HELD_WORDS:
                    yield drain(counts)
        if counts:
            yield drain(counts)

    partial = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, edited, n``: each rotation of each word of ``word, n``, whole (``edited`` null) and without
    its last code point, which is then ``edited``."""
    w, size = F.col("word"), F.length("word")

    def turned(after, upto):
        return F.concat(F.substring(w, after + 1, size), F.lit(TERMINATOR), F.substring(w, F.lit(1), upto))

    whole = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(turned(i, i).alias("prefix"), F.lit(None).cast("string").alias("edited"), F.col("n").alias("n")),
    )
    without_last = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.struct(
            turned(i, i - 1).alias("prefix"), F.substring(w, i, F.lit(1)).alias("edited"), F.col("n").alias("n")
        ),
    )
    return words.select(F.inline(F.concat(whole, without_last)))


def _group(prefix: str, edited: list, n: list) -> Iterator[tuple]:
    """The members of one range as (word, n, neighbours in it, n and word of the most frequent of them)."""
    tail, head = prefix.split(TERMINATOR)
    shorter = n[0] if edited[0] is None else None
    members = [(c, k) for c, k in zip(edited, n) if c is not None]  # most frequent first, then by code point
    joined = head + tail
    # A word may lose any letter of a run of equal ones; the pair is taken at the first of them alone.
    pairs = [shorter is not None and not head.endswith(c) for c, _ in members]
    for i, (c, k) in enumerate(members):
        near = len(members) - 1 + pairs[i]
        if not near:
            continue
        best = [(-members[i == 0][1], head + members[i == 0][0] + tail)] if len(members) > 1 else []
        best += [(-shorter, joined)] if pairs[i] else []
        most, word = min(best)
        yield head + c + tail, k, near, -most, word
    if any(pairs):
        c, k = members[pairs.index(True)]
        yield joined, shorter, sum(pairs), k, head + c + tail


def scan(sorted_rotations: DataFrame) -> DataFrame:
    """``word, n, near, best_n, best``: for each word and range with others, how many neighbours it has there
    and the most frequent one. Takes ``prefix, edited, n`` with each range whole in a partition and in order."""
    schema = "word string, n long, near long, best_n long, best string"
    kind = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def ranges(table: pa.Table, last: bool):
        """Rows of the members of whole ranges, and the rows that may go on in the next batch."""
        prefix = table.column("prefix").combine_chunks()
        if isinstance(prefix, pa.ChunkedArray):
            prefix = pa.concat_arrays(prefix.chunks)
        cuts = pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(cuts) + 1])
        ends = np.concatenate([starts[1:], [len(prefix)]])
        rest = table.slice(len(prefix))
        if not last:
            rest = table.slice(starts[-1])
            starts, ends = starts[:-1], ends[:-1]
        several = ends - starts > 1
        starts, ends = starts[several], ends[several]
        if not len(starts):
            return None, rest
        sizes = ends - starts
        rows = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        taken = table.take(pa.array(rows))
        prefixes, edited, n = (taken.column(c).to_pylist() for c in ("prefix", "edited", "n"))
        found, at = [], 0
        for size in sizes.tolist():
            found += _group(prefixes[at], edited[at : at + size], n[at : at + size])
            at += size
        return found, rest

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None or not rest.num_rows else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            found, rest = ranges(table, False)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), kind)], schema=kind)
        if rest is not None and rest.num_rows:
            found, _ = ranges(rest, True)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found), kind)], schema=kind)

    return sorted_rotations.mapInArrow(run, schema)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n, n_near, best, best_n`` for each row of ``word, n`` (words all different): the number of words
    that differ by one inserted, deleted or replaced code point, and the most frequent of them (of several the
    least in code-point order; null if there is none)."""
    order = ["prefix", F.col("edited").isNotNull(), F.desc("n"), "edited"]
    found = scan(rotations(words).repartition("prefix").sortWithinPartitions(*order))
    none = words.select("word", "n", F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("string"))
    least = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    grouped = found.union(none).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), least.alias("top"))
    return grouped.select("word", "n", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``word, n`` (words all different).

    The form is the most frequent near word (ties: the least in code-point order) if it occurs at least
    ``ratio`` times as often, else null. The root is where the forms lead to; counts grow by the ratio at each
    step, so paths are short, and each round of joins doubles the steps. An empty table gives no row.
    """
    has_form = F.col("best_n") >= ratio * F.col("n")
    found = neighbours(words).select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n", "n_near", F.when(has_form, F.col("best_n")).alias("form_n")
    )
    found = write_stage(found)
    steps = write_stage(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        longer = write_stage(longer)
        moved = longer.where("moved").limit(1).count()
        steps = longer.select("word", "root")
        if not moved:
            break
    rooted = found.join(steps, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(
    docs: DataFrame, noise: int = NOISE, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO
) -> DataFrame:
    """The words of all ``doc_id, text`` with their spelling groups, as ``variants`` returns them.

    Null and empty texts have no words, repeated rows count each time, a null id takes no part in the noise;
    an empty table gives no row. ``noise`` 0 takes all words as written.
    """
    words = count_words(docs, noise, least_length).where(F.col("n") >= least_count)
    return variants(write_stage(words), ratio)
