"""Byte-level BPE as a monoid: encode halves, join at the seam; decode up the same tree.

A string's encoding is right exactly if every two neighbouring tokens are: merging the bytes of the two must
give back the two. So two right encodings join by looking at the seam alone. If the pair there is right, the
concatenation is; if not, a window of tokens around the seam is encoded anew and grows on the side whose
outer pair is not yet right. Once both outer pairs are right, nothing outside the window can change.

Cases: a null or empty text has no tokens, and the SHA-256 of nothing twice; very long pieces are halved
until ``LEAF`` bytes; repeated rows are encoded alike; the cache of pieces is bounded and only saves time.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import regex
from pyspark.sql import DataFrame

from .common import per_document, texts_of

#: Up to so many bytes are merged at once, at the leaves of the tree.
LEAF = 4
#: Pieces kept with their ids, by a worker; beyond that the cache starts anew.
CACHE_PIECES, CACHE_BYTES = 200_000, 48
#: Parts of pieces kept likewise.
PART_BYTES = 8


class ByteBPE:
    """Encoder and decoder for a file of ranks (base64 token, rank); ``pattern`` cuts texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        self.ranks, self.leaf = ranks, max(1, leaf)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, str] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.parts: dict[bytes, list[int]] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """The merges in order of rank, the leftmost first among equals."""
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        above = 1 << 60
        cost = [rank(piece[i : i + 2], above) for i in range(len(piece) - 1)]
        while cost:
            best = min(cost)
            if best == above:
                break
            i = cost.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del cost[i]
            if i < len(cost):
                cost[i] = rank(parts[i] + parts[i + 1], above)
            if i:
                cost[i - 1] = rank(parts[i - 1] + parts[i], above)
        return [self.ranks[p] for p in parts]

    def stands(self, a: int, b: int) -> bool:
        """Whether the two tokens side by side stay as they are."""
        if (got := self.pairs.get((a, b))) is None:
            if len(self.pairs) > CACHE_PIECES:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return got

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenation of what two encodings stand for."""
        if not left or not right or self.stands(left[-1], right[0]):
            return left + right
        i, j = len(left) - 1, 1
        while True:
            window = self.merge(self.decode(left[i:] + right[:j]))
            wider_left = i > 0 and not self.stands(left[i - 1], window[0])
            wider_right = j < len(right) and not self.stands(window[-1], right[j])
            if not wider_left and not wider_right:
                return left[:i] + window + right[j:]
            i -= wider_left and min(i, len(left) - i)
            j += wider_right and min(len(right) - j, j)

    def tree(self, piece: bytes) -> list[int]:
        """The encoding of the piece's halves, joined; what short parts give is kept, for parts recur more than pieces."""
        if (got := self.parts.get(piece)) is not None:
            return got
        if len(piece) <= self.leaf:
            out = self.merge(piece)
        else:
            half = len(piece) // 2
            out = self.join(self.tree(piece[:half]), self.tree(piece[half:]))
        if len(piece) <= PART_BYTES:
            if len(self.parts) >= CACHE_PIECES:
                self.parts.clear()
            self.parts[piece] = out
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        return [whole] if (whole := self.ranks.get(piece)) is not None else self.tree(piece)

    def _said(self, piece: str) -> str:
        raw = piece.encode("utf-8")
        said = ",".join(map(str, self.encode_piece(raw)))
        if len(raw) <= CACHE_BYTES:
            if len(self.known) >= CACHE_PIECES:
                self.known.clear()
            self.known[piece] = said
        return said

    def encode_said(self, text: str) -> str:
        """The ids in decimal, joined by commas."""
        known, said = self.known, self._said
        return ",".join([known.get(p) or said(p) for p in self.pieces(text)])

    def encode(self, text: str) -> list[int]:
        said = self.encode_said(text)
        return list(map(int, said.split(","))) if said else []

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated up a tree of halves."""
        if len(ids) > 64:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.lru_cache(2)
def loaded(path: str, pattern: str) -> ByteBPE:
    return ByteBPE.load(path, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: n_tokens, and SHA-256 of the ids and of the decoded bytes. No shuffle."""

    def digests(texts: list[bytes]) -> list[list]:
        bpe = loaded(path, pattern)
        n, ids_sha, text_sha = [], [], []
        for raw in texts:
            said = bpe.encode_said(raw.decode("utf-8", "replace"))
            ids = list(map(int, said.split(","))) if said else []
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(said.encode()).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return [n, ids_sha, text_sha]

    return per_document(texts_of(docs), digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of the whole text."""
    return per_document(texts_of(docs), lambda texts: [[loaded(path, pattern).encode(t.decode("utf-8", "replace")) for t in texts]], "ids array<int>")
