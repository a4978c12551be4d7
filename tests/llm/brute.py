"""Plain versions of the operators' results, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

ORDER = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def pii_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out = {}
    for kind in ORDER:
        found = []
        for m in re.finditer(PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if fine:
                found.append(m.span())
        out[kind] = found
    return out


def pii_row(text: str | None) -> dict:
    spans = pii_spans(text or "")
    row = {f"n_{k}": len(v) for k, v in spans.items()}
    row["base_sha256"] = sha(",".join(f"{k}:{a}:{b}" for k in ORDER for a, b in spans[k]).encode())
    return row


def fingerprint(text: str | None) -> str:
    words = (text or "").encode().lower().split()
    if not words:
        return "0" * 16
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return f"{bits:016x}"


def components(fingerprints: dict[int, str], radius: int = 2) -> dict[int, int]:
    ids = sorted(fingerprints)
    values = {i: int(fingerprints[i], 16) for i in ids}
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if bin(values[a] ^ values[b]).count("1") <= radius:
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def _runs(gone: list[bool]) -> int:
    return sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))


def remove_bytes(docs: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple]:
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), _runs(gone), sha(kept))
    return out


def remove_words(docs: list[tuple[int, str | None]], length: int = 35) -> dict[int, tuple]:
    counts: dict[tuple, int] = {}
    split = {d: (t or "").encode().split() for d, t in docs}
    for words in split.values():
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            counts[key] = counts.get(key, 0) + 1
    out = {}
    for d, words in split.items():
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if counts[tuple(words[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = [w for w, g in zip(words, gone) if not g]
        out[d] = (len(words), sum(gone), sha(b" ".join(kept)))
    return out


def crc(ids: list[int]) -> int:
    import numpy as np

    return zlib.crc32(np.array(ids, "<u4").tobytes())
