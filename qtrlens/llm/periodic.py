"""Periodic runs of words, found by block convolution.

A run is a maximal stretch of words that repeats with a smallest period ``q``
at least ``EXPONENT`` times. Periods are taken by dyadic scales: for ``q`` in
``[B, 2B)`` the stretch is cut at multiples of ``B``, and any run of length
``4q`` or more holds two neighbouring blocks of ``B`` words that come again
``q`` words later. The sum of squared differences of a block and every place
of the window that follows it is

    sum(x^2) + sum(y^2) - 2 sum(x y)

whose last term, for all places at once, is one cyclic convolution of size
``2B``. It is done in integers by a number-theoretic transform modulo the
Fermat prime 65537, where a product reduces by a shift. Words become numbers
below ``V`` with ``B (V - 1)^2 < 65537``, so the residue is the sum itself and
a zero says exactly that all numbers agree. Zeros give distances; a distance
that two neighbouring blocks share is extended word by word to its maximal
stretch. Scales go up, so a stretch found again with a multiple of its period
is known already.

Documents are independent: one pass, nothing is shuffled. Documents of a batch
are transformed together in pieces of about a megabyte; memory grows with the
longest single text only.

Defined results: a null text has no words, hence no runs. Every input row
gives one row; null ids, repeated rows and repeated ids are rows of their own.
An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from qtrlens.llm.common import U, mix64, narrow, pieces, text_buffer, words

EXPONENT = 4                  # a run holds its period so many times at least
MIN_LENGTH = 6                # words of a run, at least
PRIME = 65537                 # 2^16 + 1; 3 generates its units
TOP = 1 << 15                 # longest block: its transform of 2 * TOP is the longest there is
STEP_CELLS = 1 << 16          # numbers transformed at a time
JOIN_WORDS = 1 << 17          # words turned to text at a time

_TWIDDLES: dict[tuple[int, bool], np.ndarray] = {}
_MIRRORS: dict[int, np.ndarray] = {}


def _twiddles(size: int, inverse: bool) -> np.ndarray:
    """Powers 0 to ``size / 2`` of a root of unity of order ``size``."""
    if (size, inverse) not in _TWIDDLES:
        root = pow(3, (PRIME - 1) // size, PRIME)
        if inverse:
            root = pow(root, -1, PRIME)
        out = np.ones(max(1, size // 2), dtype=np.int64)
        done = 1
        while done < len(out):                    # doubling: the next powers are the first ones times root^done
            more = out[:min(done, len(out) - done)] * pow(root, done, PRIME) % PRIME
            out[done:done + len(more)] = more
            done += len(more)
        _TWIDDLES[size, inverse] = out
    return _TWIDDLES[size, inverse]


def _fold(x: np.ndarray) -> np.ndarray:
    """The same residues with small absolute values: 2^16 is -1."""
    return (x & 0xFFFF) - (x >> 16)


def _mirror(size: int) -> np.ndarray:
    """In bit-reversed order, the place of frequency ``-k`` for each ``k``."""
    if size not in _MIRRORS:
        rev = np.zeros(1, dtype=np.int64)
        while len(rev) < size:
            rev = np.concatenate([2 * rev, 2 * rev + 1])
        _MIRRORS[size] = rev[-rev % size]
    return _MIRRORS[size]


def ntt(blocks: np.ndarray) -> np.ndarray:
    """Transforms of the columns, each followed by as many zeros, in
    bit-reversed order. Values stay below 2^34 without a full reduction: a
    stage at most doubles them."""
    half, rows = blocks.shape
    a = np.empty((2 * half, rows), dtype=np.int64)
    a[:half] = blocks
    a[half:] = _fold(blocks * _twiddles(2 * half, False)[:, None])
    while half > 1:
        length, half = half, half // 2
        part = a.reshape(-1, 2, half, rows)
        a = np.empty_like(part)
        np.add(part[:, 0], part[:, 1], out=a[:, 0])
        turned = part[:, 0] - part[:, 1]
        if half > 1:
            turned *= _twiddles(length, False)[:, None]
            a[:, 1] = _fold(turned)
        else:
            a[:, 1] = turned
    return a.reshape(-1, rows)


def inverse_ntt(a: np.ndarray) -> np.ndarray:
    """The first half of the columns whose transforms (bit-reversed) are
    given, as numbers of 0 to 65536."""
    size, rows = a.shape
    half = 1
    while True:
        part = a.reshape(-1, 2, half, rows)
        turned = part[:, 1] if half == 1 else _fold(part[:, 1] * _twiddles(2 * half, True)[:, None])
        if 2 * half == size:
            return _fold((part[:, 0] + turned).reshape(half, rows)) * pow(size, -1, PRIME) % PRIME
        a = np.empty_like(part)
        np.add(part[:, 0], turned, out=a[:, 0])
        np.subtract(part[:, 0], turned, out=a[:, 1])
        half *= 2


def symbols(hashes: np.ndarray, block: int) -> np.ndarray:
    """Numbers for words, small enough that ``block`` products of two add up
    to less than the prime."""
    top = int((PRIME - 1) // block) ** 0.5
    return (mix64(hashes + U(block)) % U(int(top) + 1)).astype(np.int64)


def zero_distances(s: np.ndarray, block: int, every: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """``(p, d)`` where ``s[p:p + block]`` equals ``s[p + d:p + d + block]``,
    for p at multiples of ``every * block`` and d from ``every * block`` up to
    twice that. ``s`` holds whole blocks and ends with ``2 * every`` of them
    that are not asked for."""
    n = len(s) // block
    grid = s.reshape(n, block)
    square = np.concatenate([[0], np.cumsum(s * s)])
    sums = square[block:] - square[:-block]           # of the squares of s[i:i + block]
    asked = np.arange(0, n - 2 * every, every)
    found_p, found_d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, STEP_CELLS // (2 * block))
    for c in range(0, len(asked), step):
        mine = asked[c:c + step]
        lo, m = int(mine[0]), len(mine)
        f = ntt(grid[lo:int(mine[-1]) + 2 * every + 1].T)
        x = _fold(f[:, 0:(m - 1) * every + 1:every][_mirror(2 * block)])      # of the reversed block
        own = sums[mine * block]
        for lag in range(every, 2 * every):
            y1, y2 = (f[:, g:g + (m - 1) * every + 1:every] for g in (lag, lag + 1))
            y = np.empty_like(x)              # of two blocks, one after the other
            np.add(y1[:block], y2[:block], out=y[:block])
            np.subtract(y1[block:], y2[block:], out=y[block:])
            product = inverse_ntt(_fold(x * _fold(y)))
            at = (lo + lag) * block
            there = sums[at:at + ((m - 1) * every + 1) * block].reshape(-1, block)[::every].T
            t, r = np.nonzero(2 * product == there + own)
            found_p.append(mine[r] * block)
            found_d.append(lag * block + t)
    return np.concatenate(found_p), np.concatenate(found_d)


def _neighbouring(p: np.ndarray, d: np.ndarray, block: int) -> np.ndarray:
    """Seeds whose distance the block before or after them has too."""
    order = np.lexsort((p, d))
    p, d = p[order], d[order]
    next_too = (d[1:] == d[:-1]) & (p[1:] == p[:-1] + block)
    keep = np.zeros(len(p), dtype=bool)
    keep[1:] |= next_too
    keep[:-1] |= next_too
    return order[keep]


def _reach(same: Callable[[int, int], np.ndarray], most: int) -> int:
    """How many leading entries agree, of at most ``most``; ``same(a, b)``
    says it for entries a to b."""
    done, step = 0, 32
    while done < most:
        part = same(done, min(done + step, most))
        if not part.all():
            return done + int(np.argmin(part))
        done += len(part)
        step *= 4
    return most


class _Known:
    """Runs found so far, by their places in the sequence."""

    def __init__(self):
        self.runs: dict[tuple[int, int], int] = {}

    def seal(self):
        rows = sorted((a, b, q) for (a, b), q in self.runs.items())
        a, b, q = (np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
        far = np.zeros(len(a), dtype=np.int64)       # of the runs up to each, the one that reaches furthest
        best = 0
        for i in range(len(a)):
            best = i if b[i] >= b[best] else best
            far[i] = best
        self.start, self.stop, self.period, self.far = a, b, q, far

    def covers(self, p: np.ndarray, d: np.ndarray, block: int) -> np.ndarray:
        """Seeds inside a run whose period divides their distance: their
        stretch is that run's."""
        if not len(self.start):
            return np.zeros(len(p), dtype=bool)
        at = np.searchsorted(self.start, p, side="right") - 1
        run = self.far[np.maximum(at, 0)]
        return (at >= 0) & (self.stop[run] >= p + d + block) & (d % self.period[run] == 0)


def find_runs(hashes: np.ndarray, off: np.ndarray, exponent: int = EXPONENT, min_length: int = MIN_LENGTH):
    """Runs of the texts ``hashes[off[i]:off[i + 1]]`` as rows ``(text, start,
    length, period)``, by text, start and period."""
    if exponent < 4:
        raise ValueError("two neighbouring blocks lie in a run only if it holds its period four times")
    sizes = np.diff(off)
    order = np.argsort(-sizes, kind="stable")         # long texts first: a scale's texts are a prefix
    seq = np.concatenate([hashes[off[i]:off[i + 1]] for i in order]) if len(order) else hashes[:0]
    ends = np.cumsum(sizes[order])
    known, block = _Known(), 1
    while True:
        least = max(min_length, exponent * block)
        texts = int(np.searchsorted(-sizes[order], -least, side="right"))
        if not texts:
            break
        n = int(ends[texts - 1])
        short = min(block, TOP)                        # a longer block is known by its first words
        s = np.zeros((-(-n // block) + 2) * block, dtype=np.int64)
        s[:n] = symbols(seq[:n], short)
        p, d = zero_distances(s, short, block // short)
        text = np.searchsorted(ends, p, side="right")
        fits = p + d + short <= ends[np.minimum(text, texts - 1)]
        p, d = p[fits], d[fits]
        keep = _neighbouring(p, d, block)
        p, d = p[keep], d[keep]                        # in the order of distance, then place
        known.seal()
        new = ~known.covers(p, d, short)
        last_d = last_stop = -1
        for at, q in zip(p[new].tolist(), d[new].tolist()):
            if q == last_d and at + q + short <= last_stop:
                continue                               # inside the stretch extended last
            i = int(np.searchsorted(ends, at, side="right"))
            lo, hi = int(ends[i - 1]) if i else 0, int(ends[i])
            right = _reach(lambda a, b: seq[at + a:at + b] == seq[at + q + a:at + q + b], hi - q - at)
            if not right:
                continue
            left = _reach(lambda a, b: (seq[at - b:at - a] == seq[at + q - b:at + q - a])[::-1], at - lo)
            a, b = at - left, at + right + q
            last_d, last_stop = q, b
            if b - a >= max(min_length, exponent * q):
                known.runs.setdefault((a, b), q)
        block *= 2
    out = []
    for (a, b), q in known.runs.items():
        i = int(np.searchsorted(ends, a, side="right"))
        out.append((int(order[i]), a - (int(ends[i - 1]) if i else 0), b - a, q))
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def _joined(text: np.ndarray, start: np.ndarray, end: np.ndarray, lo: int, hi: int):
    """Words lo to hi joined by one space, some at a time."""
    for a in range(lo, hi, JOIN_WORDS):
        b = min(a + JOIN_WORDS, hi)
        yield b" ".join(text[start[a]:end[b - 1]].tobytes().split())


def _stretches(n: int, runs) -> list[tuple[int, int]]:
    """Ranges of the words that stay: every run keeps its first period."""
    gone = np.zeros(n + 1, dtype=np.int64)
    for _, start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    stay = np.cumsum(gone)[:n] == 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], stay, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_OUT = ("doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
        "collapsed_sha256 string, collapsed string")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(prepare, with_text, exponent, min_length):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            column = batch.column(1)
            if prepare is not None:
                column = pa.array([prepare(i, t.as_py()) for i, t in zip(ids, column)], pa.string())
            data, off = text_buffer(column)
            for lo, hi in pieces(off):
                w = words(data, off[lo:hi + 1])
                per: list[list] = [[] for _ in range(lo, hi)]
                for r in find_runs(w.hash, w.off, exponent, min_length):
                    per[r[0]].append(r)
                rows = []
                for i, runs in enumerate(per):
                    a, n = int(w.off[i]), int(w.off[i + 1] - w.off[i])
                    start, end = w.start[a:a + n], w.end[a:a + n]
                    digest, kept, gap = hashlib.sha256(), [], b""
                    for x, y in _stretches(n, runs):
                        for part in _joined(data, start, end, x, y):
                            digest.update(gap + part)
                            if with_text:
                                kept.append(part)
                            gap = b" "
                    rows.append((ids[lo + i], n, [{"start": r[1], "length": r[2], "period": r[3]} for r in runs],
                                 digest.hexdigest(), b" ".join(kept).decode("utf-8", "replace") if with_text else None))
                kinds = [pa.int64(), pa.int64(), _RUNS, pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=["doc_id", "n_words", "runs", "collapsed_sha256", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT,
                  min_length: int = MIN_LENGTH, with_text: bool = False,
                  prepare: Callable[[int | None, str | None], str | None] | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs`` (``start, length,
    period`` in words, by start, then period), ``collapsed_sha256`` and, with
    ``with_text``, ``collapsed``: the words joined by one space with every run
    cut to its first period. ``prepare(id, text)`` may change a text first.

    Words are compared by their 64-bit hashes."""
    out = narrow(docs, id_col, text_col).mapInArrow(_scan(prepare, with_text, exponent, min_length), _OUT)
    return out if with_text else out.drop("collapsed")
