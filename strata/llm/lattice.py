"""Subword lattices: all segmentations of words into vocabulary pieces, in log space.

A word is its UTF-8 bytes after a marker; a piece that begins with the marker
can only start a word. The probability of a word is the sum, over all its
segmentations, of the products of the piece probabilities; as a word ends
where the next marker begins, the probabilities of all words sum to one when
those of all pieces do.
"""

from __future__ import annotations

import math

import numpy as np

from strata.llm.common import mix

MARK = b" "  # words hold no space
LONGEST = 16  # bytes of a piece
BATCH_LONGEST = 48  # longer words are handled one by one
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 22


def _key(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * int(_STEP) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([h], np.uint64))[0])


class Lattice:
    """Pieces with log probabilities; equal 64-bit keys of two pieces would raise."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        keys = np.array([_key(p) for p in pieces], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a key")
        self.log_p = np.asarray(log_p, np.float64)
        self.used = np.zeros(1 << _SLOTS, bool)
        self.used[(keys >> np.uint64(64 - _SLOTS)).astype(np.int64)] = True

    def _match(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` that are pieces, and the pieces."""
        key = mix(h)
        hit = np.flatnonzero(self.used[(key >> np.uint64(64 - _SLOTS)).astype(np.int64)])
        if not len(hit):
            return hit, hit
        at = np.searchsorted(self.keys, key[hit])
        at[at == len(self.keys)] = 0
        same = self.keys[at] == key[hit]
        return hit[same], self.ids[at[same]]

    def score(self, words: list[bytes], counts: np.ndarray | None = None) -> np.ndarray:
        """Natural log probability of each word; adds expected piece counts to ``counts`` when given."""
        out = np.empty(len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        edge = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            n = int(sizes[order[a]])
            if n > BATCH_LONGEST:
                for i in order[a:b]:
                    out[i] = self._one(words[i], counts)
                continue
            for at in range(a, b, 20_000):
                rows = order[at:min(b, at + 20_000)]
                buf = np.frombuffer(b"".join(MARK + words[i] for i in rows), np.uint8).reshape(len(rows), n + 1)
                out[rows] = self._batch(buf.astype(np.uint64).T.copy(), counts)
        return out

    def _batch(self, chars: np.ndarray, counts: np.ndarray | None) -> np.ndarray:
        m, n = chars.shape
        alpha = np.full((m + 1, n), -np.inf)
        alpha[0] = 0.0
        arcs = []
        one = np.uint64(1)
        for j in range(m):
            h = np.zeros(n, np.uint64)
            for size in range(1, min(LONGEST, m - j) + 1):
                h = h * _STEP + chars[j + size - 1] + one
                rows, piece = self._match(h)
                if len(rows):
                    lp = self.log_p[piece]
                    end = alpha[j + size]
                    end[rows] = np.logaddexp(end[rows], alpha[j, rows] + lp)
                    if counts is not None:
                        arcs.append((j, size, rows, piece, lp))
        if counts is not None:
            beta = np.full((m + 1, n), -np.inf)
            beta[m] = 0.0
            for j, size, rows, piece, lp in reversed(arcs):
                tail = lp + beta[j + size, rows]
                beta[j, rows] = np.logaddexp(beta[j, rows], tail)
                counts += np.bincount(piece, np.exp(alpha[j, rows] + tail - alpha[m, rows]), len(counts))
        return alpha[m]

    def _one(self, word: bytes, counts: np.ndarray | None) -> float:
        chars = np.frombuffer(MARK + word, np.uint8).astype(np.uint64)
        m = len(chars)
        h, starts, ends, pieces = np.zeros(m, np.uint64), [], [], []
        for size in range(1, min(LONGEST, m) + 1):
            h = h[:m - size + 1] * _STEP + chars[size - 1:] + np.uint64(1)
            rows, piece = self._match(h)
            starts.append(rows)
            ends.append(rows + size)
            pieces.append(piece)
        start, end, piece = map(np.concatenate, (starts, ends, pieces))
        order = np.argsort(start, kind="stable")
        arcs = list(zip(start[order].tolist(), end[order].tolist(), self.log_p[piece[order]].tolist(), strict=True))
        none = -math.inf

        def add(x: float, y: float) -> float:
            hi, lo = (x, y) if x >= y else (y, x)
            return hi if lo == none else hi + math.log1p(math.exp(lo - hi))

        alpha = [none] * (m + 1)
        alpha[0] = 0.0
        for a, b, lp in arcs:
            alpha[b] = add(alpha[b], alpha[a] + lp)
        if counts is not None:
            beta = [none] * (m + 1)
            beta[m] = 0.0
            share = np.zeros(len(arcs))
            for k in range(len(arcs) - 1, -1, -1):
                a, b, lp = arcs[k]
                beta[a] = add(beta[a], lp + beta[b])
                x = alpha[a] + lp + beta[b] - alpha[m]
                share[k] = math.exp(x) if x > -700 else 0.0
            counts += np.bincount(piece[order], share, len(counts))
        return alpha[m]


def vocabulary_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a public sentencepiece vocabulary with starting log probabilities.

    The file's scores order the pieces; a piece of rank r starts at a
    probability in proportion to 1 / (r + 10). Every single byte is added, at
    the start of a word and inside, so that each byte string has a segmentation.
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, float] = {}
    ranked = sorted(range(model.get_piece_size()), key=model.get_score, reverse=True)
    for rank, i in enumerate(ranked):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        text = model.id_to_piece(i)
        body = text.replace("▁", "")
        # A marker inside or alone would stand for white space, which words do not hold.
        if not body or "▁" in text[1:] or any(c in body for c in " \t\n\r\x0b\x0c"):
            continue
        piece = (MARK if text[0] == "▁" else b"") + body.encode()
        if len(piece) <= LONGEST:
            found.setdefault(piece, 1.0 / (rank + 10))
    for b in range(256):
        for piece in (bytes([b]), MARK + bytes([b])):
            if b not in (9, 10, 11, 12, 13, 32):
                found.setdefault(piece, 1.0 / (len(ranked) + 10))
    p = np.array(list(found.values()))
    return list(found), np.log(p / p.sum())
