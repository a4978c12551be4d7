"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text finds longest matches. A text is parsed into phrases,
each the longest match from where the last one ended; the number of phrases, normalised by the sizes of text
and labelled sample, estimates the cross-entropy. The language that needs least wins.
"""

from __future__ import annotations

import math
import random
import sys
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipsieve.llm.stages import write_stage
from clipsieve.llm.texts import map_batches, texts_of

#: Bounds of the labelled sample of each language: rows, and characters of these rows together.
SAMPLE_ROWS, SAMPLE_CHARS = 64, 32_768
#: Slices in which the rows of a language are ranked.
SLICES = 64
#: Texts are parsed in segments of so many symbols, side by side. Each begins a phrase of its own, so a text
#: has at most one phrase more for each full segment, where some 80 are usual.
SEGMENT = 512

UNKNOWN = "und"
#: Texts of a known language need 2 to 3, short ones with names and numbers up to 7; texts whose letters the
#: sample does not have need 15.
MOST_BITS = 10.0


class SuffixAutomaton:
    """The suffix automaton of a sequence of small integers."""

    def __init__(self, sequence):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for symbol in sequence:
            last = self._add(last, symbol)

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(edges)
        self.link.append(link)
        return len(self.length) - 1

    def _add(self, last: int, symbol: int) -> int:
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            target = self.next[at][symbol]
            if self.length[target] == self.length[at] + 1:
                self.link[new] = target
            else:
                copy = self._state(self.length[at] + 1, dict(self.next[target]), self.link[target])
                while at >= 0 and self.next[at].get(symbol) == target:
                    self.next[at][symbol] = copy
                    at = self.link[at]
                self.link[target] = self.link[new] = copy
        return new

    def phrase_table(self, symbols: int) -> "PhraseTable":
        """The transitions as one table: a state is a place in it, and its symbols are counted from there."""
        picks = random.Random(len(self.next))
        size = 4 * sum(map(len, self.next)) + symbols + 2
        used, places = bytearray(size + symbols), [0] * len(self.next)
        taken = {0}  # the root's place, which no transition names: there each symbol begins a phrase
        for state in sorted(range(1, len(self.next)), key=lambda i: -len(self.next[i])):
            edges = self.next[state]
            while True:
                place = picks.randrange(1, size)
                if place not in taken and not any(used[place + symbol] for symbol in edges):
                    break
            taken.add(place)
            places[state] = place
            for symbol in edges:
                used[place + symbol] = 1
        owner, target = np.full(size + symbols, -1, np.int32), np.zeros(size + symbols, np.int32)
        for state, edges in enumerate(self.next[1:], 1):
            for symbol, to in edges.items():
                owner[places[state] + symbol] = places[state]
                target[places[state] + symbol] = places[to]
        first = np.zeros(symbols, np.int32)
        for symbol, to in self.next[0].items():
            first[symbol] = places[to]
        return PhraseTable(owner, target, first)


@dataclass
class PhraseTable:
    """Where a symbol leads: ``target`` if ``owner`` names the state; else a phrase begins at ``first``."""

    owner: np.ndarray
    target: np.ndarray
    first: np.ndarray

    def count(self, grid: np.ndarray, active: list[int]) -> np.ndarray:
        """Phrases of each column of ``grid``; of row i the first ``active[i]`` columns hold symbols."""
        state, total = np.zeros(grid.shape[1], np.int32), np.zeros(grid.shape[1], np.int32)
        for row, n in zip(grid, active):
            symbols, at = row[:n], state[:n]
            place = at + symbols
            begins = self.owner[place] != at
            total[:n] += begins
            state[:n] = np.where(begins, self.first[symbols], self.target[place])
        return total


def _letters(text: str) -> np.ndarray:
    """Lower-case code points."""
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


@dataclass
class LanguageModel:
    languages: list[str]
    tables: list[PhraseTable]
    weights: list[float]  # log2 of the sample's length
    letters: dict[int, int]  # code point to symbol; 1 is the space, 2 a letter that no sample has
    symbols: int

    def symbol_table(self) -> np.ndarray:
        """Symbols of all code points."""
        if not hasattr(self, "_table"):
            points = range(sys.maxunicode + 1)
            table = np.fromiter((1 + chr(p).isalpha() for p in points), np.int32, len(points))
            for point, symbol in self.letters.items():
                table[point] = symbol
            self._table = table
        return self._table

    def to_symbols(self, text: str) -> np.ndarray:
        symbols = self.symbol_table()[_letters(text)]
        space = symbols == 1
        return symbols[~(space & np.concatenate(([True], space[:-1])))] if len(symbols) else symbols

    def phrases(self, texts: list[np.ndarray], segment: int = SEGMENT) -> np.ndarray:
        """Number of phrases of each text (rows) in each language (columns)."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        parts = [(i, t[at : at + segment]) for i, t in enumerate(texts) for at in range(0, len(t), segment)]
        if not parts:
            return out
        parts.sort(key=lambda part: -len(part[1]))  # so that the columns still in use stand first
        owner, lengths = np.array([i for i, _ in parts]), np.array([len(t) for _, t in parts])
        grid = np.zeros((len(parts), lengths[0]), np.int32)
        for row, (_, t) in zip(grid, parts):
            row[: len(t)] = t
        grid = np.ascontiguousarray(grid.T)
        active = (lengths[None, :] > np.arange(len(grid))[:, None]).sum(axis=1).tolist()
        for j, table in enumerate(self.tables):
            np.add.at(out[:, j], owner, table.count(grid, active))
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None]]:
        """(language, score, bits per symbol) of each text. The score is 1 less the ratio of the best and the
        second cross-entropy. Ties go to the language that comes first by name."""
        symbols = [self.to_symbols(t) for t in texts]
        phrases = self.phrases(symbols)
        out = []
        for text, seq, row in zip(texts, symbols, phrases):
            if not self.languages or not len(seq) or not any(map(str.isalpha, text)):
                out.append((UNKNOWN, 0.0, None))
                continue
            bits = row * np.array(self.weights) / len(seq)
            best = int(np.argmin(bits))
            rest = np.delete(bits, best)
            score = float(1 - bits[best] / rest.min()) if len(rest) else 1.0
            out.append((self.languages[best], min(max(score, 0.0), 1.0), float(bits[best])))
        return out


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> LanguageModel:
    """Fit on a bounded sample of the rows with ``text`` and non-null ``lang``: of every language up to
    ``sample_rows`` different texts, those with the smallest hash, while they have ``sample_chars`` characters
    together. Texts are taken whole. A longer text is taken only where a language has no other, and then the
    shortest. The model is some 2 MB for each language. An empty table gives a model without languages.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", F.xxhash64("text").alias("h"), F.length("text").alias("chars")
    )
    beyond = F.when(F.col("chars") > sample_chars, F.col("chars")).otherwise(0)
    order = Window.partitionBy("lang").orderBy(beyond, "h", "chars")
    of_slice = Window.partitionBy("lang", F.pmod("h", F.lit(SLICES))).orderBy(beyond, "h", "chars")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    # A frequent language is ranked by slices of the hash first; the texts of what is chosen are looked up.
    chosen = write_stage(
        rows.select("lang", "h", "chars")
        .distinct()
        .withColumn("place", F.row_number().over(of_slice))
        .where(F.col("place") <= sample_rows)
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= sample_rows)
        .withColumn("together", F.sum("chars").over(upto))
        .where((F.col("place") == 1) | (F.col("together") <= sample_chars))
        .drop("together")
    )
    sample = rows.join(chosen, ["lang", "h", "chars"]).groupBy("lang", "place").agg(F.min("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "place").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return train(texts)


def train(texts: dict[str, list[str]]) -> LanguageModel:
    """The model of labelled texts; languages without a letter are left out."""
    points = {p for own in texts.values() for p in np.unique(_letters(" ".join(own))).tolist() if chr(p).isalpha()}
    model = LanguageModel([], [], [], {p: i + 3 for i, p in enumerate(sorted(points))}, len(points) + 3)
    for lang in sorted(texts):
        sequence = model.to_symbols(" ".join(texts[lang]))
        if (sequence > 1).any():
            automaton = SuffixAutomaton(sequence.tolist())
            model.languages.append(lang)
            model.tables.append(automaton.phrase_table(model.symbols))
            model.weights.append(math.log2(len(sequence) + 1))
    return model


def judge(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred, score, bits`` for each row; only ``text`` is read.

    Null text and text without a letter give ``und``, score 0 and null bits, as does a model without
    languages. Repeated rows are judged alike; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"), "text")

    def work(batch):
        texts = [t.decode() for t in texts_of(batch)]
        found = []
        for i in range(0, len(texts), 512):
            found += shared.value.predict(texts[i : i + 512])
        columns = list(map(list, zip(*found))) if found else [[], [], []]
        yield dict(zip(("row", "lang_pred", "score", "bits"), [batch.column("row"), *columns]))

    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, bits double"
    return map_batches(rows, ["row", "text"], work, schema)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score, bits`` for each row of ``doc_id, text``, as ``judge`` gives them."""
    found = judge(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", "lang_pred", "score", "bits")


def keep_identified(docs: DataFrame, model: LanguageModel, most_bits: float = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` whose language was found and whose text needs at most ``most_bits`` bits a symbol
    in it. Null text and text without a letter go."""
    found = judge(docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("bits") <= most_bits))
    return found.select("row.*")
