"""Quality rules by repetition coverage.

The words of a text are hashed to 64 bits; a polynomial rolling hash over those, taken in numpy for
n = 2, 3, ... words, finds every window that occurs twice or more in its text. The windows' words are
marked, and the characters (code points) of the marked words are the coverage of that n. A length with
no repeated window ends the search, for no longer window can repeat either.

Cases: a null or empty text has no words and fails the base rule; lines without a word are no lines;
repeated rows are judged alike; rows with a null doc_id keep it; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_document, texts_of

#: Percent of word characters that repeated windows of so many words may cover.
COVERAGE_LIMITS = {5: 50, 6: 48, 7: 46, 8: 44, 9: 42, 10: 40}
#: Percent of the characters of all lines that repeats of earlier lines may have.
LINE_LIMIT = 40
MIN_WORDS, REPEAT_LIMIT, REPEAT_WINDOW = 20, 30, 8
#: Symbols counted in the base columns (fixed values).
SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def repeated(hashes: np.ndarray) -> np.ndarray | None:
    """Flags of the values that occur twice or more; None where there is none."""
    s = np.sort(hashes)
    twice = s[1:][s[1:] == s[:-1]]
    return np.isin(hashes, twice) if len(twice) else None


def covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Flags of the words inside windows of n words that begin at the flagged places."""
    edge = np.zeros(len(starts) + n, np.int32)
    edge[: len(starts)] += starts
    edge[n:] -= starts
    return np.cumsum(edge)[:-1] > 0


def window_repeats(words: list[bytes], lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """For each length with repeats, the flags of the words inside repeated windows."""
    n, found = len(words), {}
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    roll = h
    for k in range(2, max(lengths) + 1):
        if k > n - 1:
            break
        roll = roll[:-1] * _BASE + h[k - 1 :]
        if k in lengths:
            if (flags := repeated(roll)) is None:
                break
            found[k] = covered(flags, k)
    return found


def measure(text: bytes) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, line and window coverage in characters)."""
    words = text.split()
    n = len(words)
    chars = len(b"".join(words).decode("utf-8", "replace"))
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    line_chars = dup_chars = 0
    if dup_lines:
        seen: set[bytes] = set()
        for x in lines:
            size = len(x.decode("utf-8", "replace"))
            line_chars += size
            if x in seen:
                dup_chars += size
            seen.add(x)
    flags = window_repeats(words, tuple(COVERAGE_LIMITS))
    repeats = int(flags[REPEAT_WINDOW].sum()) if REPEAT_WINDOW in flags else 0
    cover = dict.fromkeys(COVERAGE_LIMITS, 0)
    if flags:
        sizes = np.fromiter((len(w.decode("utf-8", "replace")) for w in words), np.int64, n)
        cover |= {k: int(sizes[f].sum()) for k, f in flags.items()}
    failed = n < MIN_WORDS or 100 * repeats > REPEAT_LIMIT * n
    kept = not failed and 100 * dup_chars <= LINE_LIMIT * line_chars and all(100 * c <= COVERAGE_LIMITS[k] * chars for k, c in cover.items())
    return n, chars, len(text) - len(text.translate(None, SYMBOLS)), dup_lines, repeats, failed, kept, dup_chars, *cover.values()


FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, dup_line_chars long, " + ", ".join(f"cover_{k} long" for k in COVERAGE_LIMITS)


def repetition(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every row's whole text. No shuffle; memory is one Arrow batch."""
    return per_document(texts_of(docs), lambda texts: list(zip(*map(measure, texts), strict=True)), FIELDS)


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([measure(t.encode() if t else b"")[6] for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
