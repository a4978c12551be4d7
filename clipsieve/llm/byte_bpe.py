"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a text has exactly one valid last token: the last token of the prefix's own encoding. It is
the token t ending there that may follow the last token of the prefix before t. So one array of last tokens
per text gives the encoding of every prefix; appending bytes only adds entries, and an edit needs new
entries from its place to where the old ones hold again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from clipsieve.llm.texts import map_batches, texts_of

#: Remembered matches and token pairs of one Python worker; a full table starts anew.
REMEMBERED_MATCHES = 800_000
REMEMBERED_PAIRS = 600_000
_LONGEST_REMEMBERED = 64


class Ranks:
    """A vocabulary of byte strings and their ranks, lower ranks being merged first."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs if token}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.decimal = {rank: str(rank) for rank in self.token}
        # Every ending of a token: its own rank if it is a token, else -1.
        self.endings = {t[i:]: -1 for t in self.rank for i in range(len(t))} | self.rank
        self._parts: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._edges: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}
        self.pairs: dict[int, bool] = {}

    def parts(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens that a token is merged from; None for a single byte."""
        if token not in self._parts:
            self._parts[token] = None if len(token) == 1 else self._last_merge(token)
        return self._parts[token]

    def _last_merge(self, token: bytes) -> tuple[bytes, bytes]:
        pieces = [token[i : i + 1] for i in range(len(token))]
        while len(pieces) > 2:
            ranks = [self.rank.get(a + b, 1 << 60) for a, b in zip(pieces, pieces[1:])]
            i = ranks.index(min(ranks))
            if ranks[i] >= self.rank[token]:
                break
            pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        if len(pieces) != 2:
            return b"", b""  # no merges lead to this token, so it is never used
        return pieces[0], pieces[1]

    def reachable(self, token: bytes) -> bool:
        return self.parts(token) != (b"", b"")

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at an edge (0 left, 1 right) of a token while it is merged, and the rank that ends it."""
        if (token, side) not in self._edges:
            out, ends = [(token, 1 << 60)], token
            while (pair := self.parts(ends)) is not None:
                out.append((pair[side], self.rank[ends]))
                ends = pair[side]
            self._edges[token, side] = out
        return self._edges[token, side]

    def follows(self, left: int, right: int) -> bool:
        """Whether both stay whole, one after the other: no merge across their border comes first.

        Of merges of one rank the leftmost is first: the one across the border comes after those in the
        left token and before those in the right one.
        """
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stay_whole(self.token[left], self.token[right])
        return known

    def _stay_whole(self, left: bytes, right: bytes) -> bool:
        if not self.reachable(right):
            return False
        rank, begins = self.rank, self._edge(right, 0)
        for a, a_ends in self._edge(left, 1):
            for b, b_ends in begins:
                across = rank.get(a + b)
                if across is not None and across < a_ends and across <= b_ends:
                    return False
        return True


class Prefixes:
    """A byte string and the rank of the last token of each of its prefixes (of the empty one: -1)."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", [-1]
        self.append(data)

    def _extend(self, end: int) -> None:
        """Add the entries of the prefixes longer than ``end - 1`` bytes, up to the whole."""
        data, last, endings = self.data, self.last, self.ranks.endings
        pairs, follows = self.ranks.pairs, self.ranks.follows
        for end in range(end, len(data) + 1):
            start, found = end - 1, []
            while start >= 0:
                rank = endings.get(data[start:end])
                if rank is None:
                    break
                if rank >= 0:
                    found.append((start, rank))
                start -= 1
            for start, rank in reversed(found):
                if start == 0:
                    if self.ranks.reachable(data[:end]):
                        break
                else:
                    known = pairs.get(last[start] << 32 | rank)
                    if known or known is None and follows(last[start], rank):
                        break
            last.append(rank)

    def append(self, more: bytes) -> None:
        """Add bytes; the entries so far stay as they are."""
        self.data += more
        self._extend(len(self.last))

    def restart(self, data: bytes) -> None:
        """Take another string, keeping the entries of the prefix that both share."""
        same, most = 0, min(len(data), len(self.data))
        while same < most and data[same] == self.data[same]:
            same += 1
        del self.last[same + 1 :]
        self.data = data
        self._extend(same + 1)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of bytes start to stop; returns how many entries were computed again.

        After the edit, once as many entries in a row as the longest token has bytes are the old ones, all
        later ones are.
        """
        old, shift, whole = self.last, len(new) - (stop - start), self.data
        whole = whole[:start] + new + whole[stop:]
        self.data, self.last = whole[:start], old[: start + 1]
        longest, same = max(map(len, self.ranks.rank)), 0
        for end in range(start + 1, len(whole) + 1):
            if same >= longest:
                self.data, self.last = whole, self.last + old[end - shift :]
                return end - start - 1
            self.data = whole[:end]
            self._extend(end)
            token = self.last[end]
            inside = end - len(self.ranks.token[token]) >= start + len(new)
            same = same + 1 if inside and token == old[end - shift] else 0
        return len(whole) - start

    def ids(self) -> list[int]:
        out, end, token = [], len(self.data), self.ranks.token
        while end:
            out.append(self.last[end])
            end -= len(token[out[-1]])
        return out[::-1]


class TextEncoder(dict):
    """Each match of the pattern encoded alone: match to its decimal ids, joined by spaces."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.ranks = Ranks(path)
        self._split = regex.compile(pattern).findall
        # Texts of ASCII need no Unicode properties; the standard library then splits them faster.
        plain = pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
        plain = plain.replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+")
        self._split_ascii = self._split if r"\p" in plain else re.compile(plain, re.ASCII).findall
        self.by_decimal = {str(rank): token for rank, token in self.ranks.token.items()}
        self._prefixes = Prefixes(self.ranks)

    def split(self, text: str) -> list[str]:
        return self._split_ascii(text) if text.isascii() else self._split(text)

    def _learn(self, match: str, data: bytes) -> str:
        rank = self.ranks.rank.get(data)
        if rank is not None and self.ranks.reachable(data):
            found = self.ranks.decimal[rank]
        else:
            self._prefixes.restart(data)
            found = " ".join(map(self.ranks.decimal.__getitem__, self._prefixes.ids()))
        if len(data) <= _LONGEST_REMEMBERED:
            self[match] = found
        return found

    def __missing__(self, match: str) -> str:
        return self._learn(match, match.encode())

    def learn(self, matches: set[str]) -> None:
        """Encode new matches in sorted order, so that each one keeps what it shares with the one before."""
        new = sorted((m.encode(), m) for m in matches if len(m) <= _LONGEST_REMEMBERED and m not in self)
        if len(self) + len(new) > REMEMBERED_MATCHES:
            self.clear()
        for data, match in new:
            self._learn(match, data)

    def all_decimals(self, texts: list[str]):
        """For each text its ids in decimal, joined by spaces, and their number."""
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        for matches in split:
            decimals = " ".join(map(self.__getitem__, matches))
            yield decimals, decimals.count(" ") + 1 if decimals else 0

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in next(self.all_decimals([text]))[0].split()]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.ranks.token[i] for i in ids])


@lru_cache(maxsize=4)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


def _in_turn(encoder: TextEncoder, texts: list[bytes], most: int = 1 << 22):
    """Encode texts in groups of about ``most`` bytes, which bounds what is split at once."""
    group, size = [], 0
    for text in texts:
        group.append(text.decode())
        size += len(text)
        if size >= most:
            yield from encoder.all_decimals(group)
            group, size = [], 0
    yield from encoder.all_decimals(group)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text. Null text is empty and has no ids; repeated rows and
    null ids are kept; an empty table gives no row."""

    def run(batch):
        encoder = text_encoder(vocabulary, pattern)
        ids = [[int(x) for x in d.split()] for d, _ in _in_turn(encoder, texts_of(batch))]
        yield {"doc_id": batch.column("doc_id"), "ids": ids}

    return map_batches(docs, ["doc_id", "text"], run, "doc_id long, ids array<int>")


def digest_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256`` (decimal ids joined by a space) and ``decoded_sha256`` (the bytes
    decoded from those ids), without moving the ids. Rows as in ``encode_documents``."""

    def run(batch):
        encoder = text_encoder(vocabulary, pattern)
        decode = encoder.by_decimal.__getitem__
        counts, ids, decoded = [], [], []
        for decimals, n in _in_turn(encoder, texts_of(batch)):
            counts.append(n)
            ids.append(hashlib.sha256(decimals.encode()).hexdigest())
            decoded.append(hashlib.sha256(b"".join(map(decode, decimals.split()))).hexdigest())
        yield {
            "doc_id": batch.column("doc_id"), "n_tokens": counts, "ids_sha256": ids, "decoded_sha256": decoded,
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs, ["doc_id", "text"], run, schema)
