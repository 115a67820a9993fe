"""Runs of repeated words: maximal stretches whose words repeat with a period at least four times over.

Every text gets a run-length grammar by recompression: blocks of equal symbols and pairs of neighbours are
replaced by new symbols in turn, whatever the place they stand at, until one symbol per text is left. Equal
stretches are then parsed alike but for their ends, so the longest common extension of two places needs only
a few comparisons per level: up while symbols agree, down where they differ. A run with period q and four
periods or more covers three multiples in a row of q, so places on the grid of multiples of 3 * q, compared
with the word q further on, find every run; the grammar extends those that agree to both sides exactly.

All texts of a block are parsed side by side in numpy. A text is never split, and a block holds at most
``BLOCK`` words or one text.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import texts, words

#: Words parsed together.
BLOCK = 400_000
REPEATS = 4
SHORTEST = 6
#: Grid places compared, and candidates extended, at a time.
_GRID = 1 << 20

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


class Grammar:
    """Levels of a run-length grammar over ``symbols``: texts between closing symbols, which are the greatest numbers.

    Every closing symbol is of its own kind, so none is ever joined to anything and no rule crosses it. ``size`` holds how many words each symbol of a level covers, ``child`` where its first symbol lies one level
    down, and ``parent`` the symbol above. ``starts`` marks symbols that begin the one above.
    """

    def __init__(self, symbols: np.ndarray, closings: int, seed: int = 7):
        self.symbol: list[np.ndarray] = [symbols]
        self.size: list[np.ndarray] = [np.ones(len(symbols), np.int64)]
        self.child: list[np.ndarray | None] = [None]
        self.parent: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        self.blocks: list[bool] = [False]
        rng = np.random.default_rng(seed)
        now, closing = symbols, symbols > int(symbols.max()) - closings
        blocks = True
        while len(now) > 2 * closings:
            if blocks:
                begins = np.ones(len(now), bool)
                begins[1:] = (now[1:] != now[:-1]) | closing[1:]
            else:
                left = rng.integers(0, 2, int(now.max()) + 1, dtype=np.int8).astype(bool)[now] & ~closing
                joined = np.zeros(len(now), bool)
                joined[1:] = left[:-1] & ~left[1:] & ~closing[1:]
                begins = ~joined
            at = np.flatnonzero(begins)
            count = np.diff(at, append=len(now))
            if len(at) < len(now):
                second = now[np.minimum(at + 1, len(now) - 1)]
                tail = count if blocks else np.where(count == 2, second + 2, 1)
                width = int(tail.max()) + 1
                _, number = np.unique(now[at] * width + tail, return_inverse=True)
                size = np.add.reduceat(self.size[-1], at)
                self._level(at, begins, number, size, blocks)
                closing, now = closing[at], number
            blocks = not blocks

    def _level(self, at: np.ndarray, begins: np.ndarray, number: np.ndarray, size: np.ndarray, blocks: bool) -> None:
        self.parent.append(np.cumsum(begins) - 1)
        self.starts.append(begins)
        self.symbol.append(number)
        self.size.append(size)
        self.child.append(at)
        self.blocks.append(blocks)

    def reversed(self) -> "Grammar":
        """The grammar of the symbols read backwards: the same rules, seen from the other end."""
        other = object.__new__(Grammar)
        other.symbol = [s[::-1] for s in self.symbol]
        other.size = [s[::-1] for s in self.size]
        other.blocks = self.blocks
        other.parent, other.starts, other.child = [], [], [None]
        for h, parent in enumerate(self.parent):
            up = len(self.symbol[h + 1]) - 1 - parent[::-1]
            begins = np.ones(len(up), bool)
            begins[1:] = up[1:] != up[:-1]
            other.parent.append(up)
            other.starts.append(begins)
            other.child.append(np.flatnonzero(begins))
        return other

    def _left(self, h: int, x: np.ndarray) -> np.ndarray:
        """Symbols from ``x`` to the end of the one above."""
        ends = np.append(self.child[h + 1][1:], len(self.symbol[h]))
        return ends[self.parent[h][x]] - x

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols agree from places ``i`` and ``j`` on; ``i < j``, both in the same closed text."""
        a, b = i.copy(), j.copy()
        found = np.zeros(len(i), np.int64)
        level = np.zeros(len(i), np.int64)
        rising = np.arange(len(i))
        # Up: step over what agrees until both places begin a symbol above.
        for h in range(len(self.symbol)):
            symbol, size = self.symbol[h], self.size[h]
            last = h == len(self.symbol) - 1
            at = rising
            ready = []
            while len(at):
                x, y = a[at], b[at]
                if last:
                    aligned = np.zeros(len(at), bool)
                else:
                    aligned = self.starts[h][x] & self.starts[h][y]
                    ready.append(at[aligned])
                at, x, y = at[~aligned], x[~aligned], y[~aligned]
                same = symbol[x] == symbol[y]
                level[at[~same]] = h
                at, x, y = at[same], x[same], y[same]
                steps = 1
                if not last and self.blocks[h + 1]:
                    # Inside blocks of the same symbol: over what is left of the shorter one at once.
                    steps = np.minimum(self._left(h, x), self._left(h, y))
                found[at] += size[x] * steps
                a[at], b[at] = x + steps, y + steps
            if last:
                break
            rising = np.concatenate(ready) if ready else at
            a[rising], b[rising] = self.parent[h][a[rising]], self.parent[h][b[rising]]
        # Down: where symbols differ, the first difference lies inside them or right behind what they share.
        for h in range(len(self.symbol) - 1, 0, -1):
            at = np.flatnonzero(level == h)
            x, y = a[at], b[at]
            if self.blocks[h]:
                # Blocks of one symbol agree as far as the shorter goes, and differ right behind it.
                p, q = self.child[h][x], self.child[h][y]
                symbol, size = self.symbol[h - 1], self.size[h - 1]
                counts = self.size[h][x] // size[p], self.size[h][y] // size[q]
                shared = np.where(symbol[p] == symbol[q], np.minimum(*counts), 0)
                found[at] += shared * size[p]
                a[at], b[at] = p + shared, q + shared
            else:
                p, q = self.child[h][x], self.child[h][y]
                symbol, size = self.symbol[h - 1], self.size[h - 1]
                for _ in range(2):
                    same = symbol[p] == symbol[q]
                    found[at] += np.where(same, size[p], 0)
                    p, q = p + same, q + same
                    if not same.any():
                        break
                a[at], b[at] = p, q
            level[at] = h - 1
        return found


def _grid(n: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the grids of periods ``first`` to ``last`` - 1 in a text of ``n`` words."""
    period = np.arange(first, last)
    step = (REPEATS - 1) * period
    many = np.maximum(-(-(n - period) // step), 0)
    of = np.repeat(period, many)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    return nth * (REPEATS - 1) * of, of


_PAIRS: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
_SHORT = 2048


def _short_grid(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The grid of a short text: a prefix of a stored one, ordered by the word that the period leads to."""
    if not _PAIRS:
        place, period = _grid(_SHORT, 1, _SHORT // REPEATS + 1)
        order = np.argsort(place + period, kind="stable")
        _PAIRS.append((place[order], period[order], (place + period)[order]))
    place, period, to = _PAIRS[0]
    k = int(np.searchsorted(to, n))
    place, period = place[:k], period[:k]
    fits = period * REPEATS <= n
    return place[fits], period[fits]


def _agreeing(w: np.ndarray, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those whose word, and the two before or the two behind it, are the same one period further on.

    A run holds at least five agreeing places in a row, so two of them lie on one side of any.
    """
    same = w[place] == w[place + period]
    place, period = place[same], period[same]
    n = len(w)
    near = np.zeros(len(place), bool)
    for shifts in ((1, 2), (-1, -2)):
        side = np.ones(len(place), bool)
        for d in shifts:
            x = place + d
            side &= (x >= 0) & (x + period < n)
            side &= w[np.clip(x, 0, n - 1)] == w[np.clip(x + period, 0, n - 1)]
        near |= side
    return place[near], period[near]


def candidates(w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) on the grids where the text may be in a run, a bounded number at a time."""
    n = len(w)
    if SHORTEST <= n <= _SHORT:
        yield _agreeing(w, *_short_grid(n))
    elif n > _SHORT:
        first, most = 1, n // REPEATS + 1
        while first < most:
            last, held = first + 1, n // (3 * first) + 1
            while last < most and held < _GRID:
                held += n // (3 * last) + 1
                last += 1
            yield _agreeing(w, *_grid(n, first, last))
            first = last


def _extended(grammar: Grammar, back: Grammar, of: np.ndarray, place: np.ndarray, period: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Runs around the candidates, as rows (text, start, length, period), each once."""
    i = base[of] + place
    j = i + period
    n = len(grammar.symbol[0])
    # Read backwards, the words before both places, the nearer one to the text's end first.
    behind = back.extension(n - j, n - i)
    length = behind + period + grammar.extension(i, j)
    keep = (length >= SHORTEST) & (length >= REPEATS * period)
    return np.unique(np.stack([of, place - behind, length, period], axis=1)[keep], axis=0)


def runs_of(coded: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, given as word numbers, its runs as rows (start, length, period), sorted by start and period."""
    out = [np.zeros((0, 3), np.int64)] * len(coded)
    short = {i: next(candidates(w)) for i, w in enumerate(coded) if SHORTEST <= len(w) <= _SHORT}
    busy = [i for i, w in enumerate(coded) if len(w) > _SHORT or (i in short and len(short[i][0]))]
    if not busy:
        return out
    top = max(int(coded[i].max()) for i in busy) + 1
    parts, base, at = [np.array([top])], [], 1
    for k, i in enumerate(busy):
        parts += [coded[i], np.array([top + 1 + k])]
        base.append(at)
        at += len(coded[i]) + 1
    grammar = Grammar(np.concatenate(parts), len(busy) + 1)
    back, base = grammar.reversed(), np.array(base)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows, size = [], 0

    def flush() -> None:
        rows.append(_extended(grammar, back, *(np.concatenate(x) for x in zip(*held)), base))
        held.clear()

    for k, i in enumerate(busy):
        for place, period in [short[i]] if i in short else candidates(coded[i]):
            held.append((np.full(len(place), k), place, period))
            size += len(place)
            if size >= _GRID:
                flush()
                size = 0
    if held:
        flush()
    # The same stretch with a multiple of its period is not a run of its own: the smallest period stays.
    found = np.unique(np.concatenate(rows), axis=0)
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[fresh]
    found = found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]
    ends = np.searchsorted(found[:, 0], np.arange(len(busy) + 1))
    for k, i in enumerate(busy):
        out[i] = found[ends[k]:ends[k + 1], 1:]
    return out


def planted(doc_id: int | None, w: list[bytes]) -> list[bytes]:
    """The words with a stretch that repeats, in every tenth document by the checksum of its id (null: none)."""
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g = h // 10
    n, a = len(w), g % len(w)
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + i % p] for i in range(n - a)]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Marks the words outside all runs, and those inside that lie in the first period of every run over them."""
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(covered)[:-1] == 0


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """(start, length, period) of the run with the greatest length / period; ties: smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = start, length, period
    return best


class _Numbers(dict):
    """Numbers words in the order they are first seen."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def summary(w: list[bytes], runs: np.ndarray) -> tuple:
    best = strongest(runs)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs.tolist())
    left = [x for x, k in zip(w, kept_words(len(w), runs).tolist()) if k] if len(runs) else w
    return (
        len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(left)).hexdigest(),
    )


def digests(docs: DataFrame, doc_id: str = "doc_id", body: str = "text", plant: bool = True) -> DataFrame:
    """One row per row of ``docs``: its runs of words, the strongest one, and what is left without repeats.

    Null and empty texts have no words and no runs; equal rows get equal results; null ids stay null. ``plant`` first makes
    a stretch of every tenth document periodic.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            held, coded, size, first, numbers = [], [], 0, 0, _Numbers()
            known = ids.to_pylist()
            for k, (doc, text) in enumerate(zip(known, texts(batch.column(1)))):
                w = words(text)
                if plant:
                    w = planted(doc, w)
                held.append(w)
                coded.append(np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)))
                size += len(w)
                if size >= BLOCK or k + 1 == len(known):
                    rows = [summary(w, r) for w, r in zip(held, runs_of(coded))]
                    columns = [*zip(*rows)]
                    kinds = [pa.int64()] * 5 + [pa.string()] * 2
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(first, len(held)), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                        names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
                    )
                    held, coded, size, first, numbers = [], [], 0, k + 1, _Numbers()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(body).alias("text")).mapInArrow(found, SCHEMA)
