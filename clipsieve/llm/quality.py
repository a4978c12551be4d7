"""Quality rules by compression bands.

zstandard's ratio (compressed over plain bytes) is low for repetitive text and high for text without
structure. Whole documents and fixed chunks are compressed; each has a band of accepted ratios that depends
on its length, as short texts compress less.
"""

from __future__ import annotations

import bisect

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from clipsieve.llm.texts import SEPARATORS, map_batches, texts_of

SYMBOLS = b"#*$%&|<>"
CHUNK_BYTES = 4096
LEVEL = 3
#: (least bytes, lowest and highest accepted ratio); texts shorter than the first are not judged. Natural text
#: reaches 0.92 of 128 bytes, 0.74 of 256, 0.59 of 1,024 and 0.48 of 4,096; below 128 bytes it is as high as
#: random letters and only repetition is judged.
BANDS = (
    (64, 0.40, 2.0), (96, 0.38, 2.0), (128, 0.30, 0.94), (192, 0.30, 0.88), (256, 0.30, 0.80), (384, 0.30, 0.76),
    (512, 0.30, 0.74), (768, 0.30, 0.68), (1024, 0.28, 0.64), (1536, 0.28, 0.58), (2048, 0.28, 0.53),
    (3072, 0.28, 0.52), (4096, 0.26, 0.51), (8192, 0.26, 0.49), (16384, 0.22, 0.46),
)
#: A document goes if more than this share of its chunks is outside their bands.
BAD_CHUNKS = 0.5

_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, chunks long, bad_chunks long"
)


def repeat_words(words: list[bytes], width: int = 5) -> int:
    """Words in windows of ``width`` words that the text has twice or more."""
    if len(words) <= width:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    n = len(ids) - width + 1
    codes, base = ids[:n].copy(), len(numbers)
    bound = base
    for k in range(1, width):
        if bound > (1 << 62) // base:  # keep codes exact: number the different ones anew
            codes = np.unique(codes, return_inverse=True)[1]
            bound = n
        codes = codes * base + ids[k : k + n]
        bound *= base
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(width):
        covered[k : k + n] |= twice
    return int(covered.sum())


def outside(ratio: float, n_bytes: int, bands=BANDS) -> bool:
    i = bisect.bisect_right([b[0] for b in bands], n_bytes) - 1
    return i >= 0 and not bands[i][1] <= ratio <= bands[i][2]


def compression(data: bytes, chunk_bytes: int, bands=BANDS) -> tuple[float | None, int, int]:
    """(ratio of the whole text, number of chunks, chunks outside their band)."""
    if not data:
        return None, 0, 0
    squeeze = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False).compress
    ratio = len(squeeze(data)) / len(data)
    if len(data) <= chunk_bytes:
        return ratio, 1, int(outside(ratio, len(data), bands))
    chunks = [data[i : i + chunk_bytes] for i in range(0, len(data), chunk_bytes)]
    return ratio, len(chunks), sum(outside(len(squeeze(c)) / len(c), len(c), bands) for c in chunks)


def measure(
    docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bands=BANDS, bad_chunks: float = BAD_CHUNKS
) -> DataFrame:
    """One row per row of ``doc_id, text``: base counts, compression figures and the verdict ``kept``.

    Null or empty text has no word, so it fails the base rule (fewer than 10 words); its ratio is null.
    Repeated rows are measured alike; an empty table gives no row.
    """

    def one(data: bytes) -> tuple:
        words = data.split()
        lines = [line for line in data.split(b"\n") if line.strip()]
        repeats = repeat_words(words)
        chars = len(data.translate(None, SEPARATORS).decode())
        symbols = len(data) - len(data.translate(None, SYMBOLS))
        failed = len(words) < 10 or 100 * repeats > 20 * len(words)
        ratio, n_chunks, bad = compression(data, chunk_bytes, bands)
        fine = ratio is not None and not outside(ratio, len(data), bands) and bad <= bad_chunks * n_chunks
        return (
            len(words), chars, symbols, len(lines) - len(set(lines)), repeats, failed, not failed and fine,
            ratio, n_chunks, bad,
        )

    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def run(batch):
        rows = [one(t) for t in texts_of(batch)]
        columns = list(map(list, zip(*rows))) if rows else [[] for _ in names[1:]]
        yield dict(zip(names, [batch.column("doc_id"), *columns]))

    return map_batches(docs, ["doc_id", "text"], run, _SCHEMA)
