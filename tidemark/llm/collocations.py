"""Phrases of two and three words whose parts seldom occur apart, by weighted acyclic automata over words.

Every task turns blocks of text into count automata: the block's n-grams of one to three words, sorted, become states
and arcs level by level, an arc's weight being how often the n-gram that ends there occurs; states with the same arcs
and weights are kept once. An automaton is cut by prefix range before it is sent off: n-grams of two words and more lie in the range
of their first two words, single words in that of the word, so a very frequent word is spread over all ranges. A range's automata are
united, weights of equal paths added, and pruned to what can matter. For the parts of a phrase, each range sends the
range that holds them an acceptor of all parts it asks for; composed with the automaton there it yields their counts.

Only paths that occur ``least`` times or more are kept after the union: a part occurs at least as often as its phrase, so
nothing that is looked up is missing. A range is united in passes of bounded size.
"""

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.staging import stage
from tidemark.llm.words import texts

LEAST = 10
#: Percentage of a phrase's occurrences inside a longer one from which on the shorter one is dropped.
INSIDE = 50
SCALE = 1_000_000
UNKNOWN = "und"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH = 16 << 20
#: Shares in which a language's best phrases are looked for.
SHARES = 32
#: Words (and ends of pieces) counted together, bytes of text cut into words at a time, and arcs united at a time.
BLOCK = 600_000
CHUNK = 4 << 20
UNITED = 1_500_000

_ENDS = b".,;:!?\n\x0b\x0c\r"
_FROM = string.ascii_uppercase.encode() + _ENDS + b"\t"
_TABLE = bytes.maketrans(_FROM, string.ascii_lowercase.encode() + b"\n" * len(_ENDS) + b" ")
_END = b"\n"


class Automaton:
    """N-grams of up to three words with weights, as states and arcs.

    ``words`` are sorted. Arcs of the first level lead from the root: ``w1`` with weights ``n1`` and ``c1`` arcs of the
    second level behind each; those are ``w2`` with ``n2`` and ``state``, the number of the state behind them. State
    ``s`` has ``cs[s]`` arcs of the third level, which follow each other in ``w3`` and ``n3``. Arcs of a state are sorted.
    """

    PARTS = ("w1", "n1", "c1", "w2", "n2", "state", "cs", "w3", "n3")

    def __init__(self, words: list[bytes], **parts: np.ndarray):
        self.words = words
        for name in self.PARTS:
            setattr(self, name, parts[name])

    @classmethod
    def of(cls, words: list[bytes], one: tuple, two: tuple, three: tuple) -> "Automaton":
        """From sorted n-grams: (w1, n), (w1, w2, n) and (w1, w2, w3, n), where every prefix is in the level before."""
        w1, n1 = one
        a, w2, n2 = two
        b, c, w3, n3 = three
        many = len(words) + 1
        c1 = np.bincount(np.searchsorted(w1, a), minlength=len(w1))
        of = np.searchsorted(a * many + w2, b * many + c)
        state, cs, w3, n3 = shared_states(np.bincount(of, minlength=len(w2)), w3, n3, many)
        return cls(words, w1=w1, n1=n1, c1=c1, w2=w2, n2=n2, state=state, cs=cs, w3=w3, n3=n3)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.repeat(self.w1, self.c1), self.w2, self.n2

    def triples(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(arc of the second level, w3, n3) behind the arcs numbered ``chosen``."""
        state = self.state[chosen]
        size, first = self.cs[state], (np.cumsum(self.cs) - self.cs)[state]
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.repeat(chosen, size), self.w3[at], self.n3[at]

    def dump(self) -> bytes:
        """Weights take 64 bits, all else 32."""
        arrays = [np.asarray(getattr(self, name), "<i8" if name[0] == "n" else "<i4") for name in self.PARTS]
        head = np.array([len(a) for a in arrays], "<i8").tobytes()
        return zstandard.compress(b"".join([head, *(a.tobytes() for a in arrays), b" ".join(self.words)]), 1)

    @classmethod
    def load(cls, raw: bytes) -> "Automaton":
        raw = zstandard.decompress(raw)
        at, parts = 8 * len(cls.PARTS), {}
        for name, n in zip(cls.PARTS, np.frombuffer(raw, "<i8", len(cls.PARTS)).tolist()):
            kind = np.dtype("<i8" if name[0] == "n" else "<i4")
            parts[name] = np.frombuffer(raw, kind, n, at).astype(np.int64)
            at += n * kind.itemsize
        return cls(raw[at:].split(b" ") if at < len(raw) else [], **parts)

    def compose(self, asked: "Automaton") -> np.ndarray:
        """Weights of the paths that ``asked`` marks (weight 1), in its order: single words, then pairs; 0 where unknown."""
        number = {w: i for i, w in enumerate(self.words)}
        label = np.fromiter((number.get(w, -1) for w in asked.words), np.int64, len(asked.words))

        def follow(arcs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
            if not len(arcs):
                return np.full(len(wanted), -1)
            at = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
            return np.where(arcs[at] == wanted, at, -1)

        many = len(self.words) + 1
        to = follow(self.w1, label[asked.w1])
        one = np.where(to >= 0, self.n1[to] if len(self.n1) else 0, 0)[asked.n1 > 0]
        from_state, second = np.repeat(to, asked.c1), label[asked.w2]
        arcs = np.repeat(np.arange(len(self.w1)), self.c1) * many + self.w2
        to = follow(arcs, np.where((from_state >= 0) & (second >= 0), from_state * many + second, -1))
        two = np.where(to >= 0, self.n2[to] if len(self.n2) else 0, 0)
        return np.concatenate((one, two))


def shared_states(size: np.ndarray, w3: np.ndarray, n3: np.ndarray, many: int) -> tuple[np.ndarray, ...]:
    """(state of each arc, arcs per state, w3, n3) with equal lists of arcs kept once."""
    first = np.cumsum(size) - size
    state = np.zeros(len(size), np.int64)
    empty, single = size == 0, size == 1
    kept_size, kept_at = [np.zeros(1, np.int64)], []
    held = 1  # state 0 has no arcs
    if single.any():
        at = first[single]
        _, where, number = np.unique(w3[at] + many * n3[at], return_index=True, return_inverse=True)
        state[single] = held + number
        kept_size.append(np.ones(len(where), np.int64))
        kept_at.append(at[where])
        held += len(where)
    register: dict[bytes, int] = {}
    for arc in np.flatnonzero(~(empty | single)).tolist():
        a, b = int(first[arc]), int(first[arc] + size[arc])
        key = w3[a:b].tobytes() + n3[a:b].tobytes()
        if key not in register:
            register[key] = held + len(register)
            kept_size.append(size[arc:arc + 1])
            kept_at.append(np.arange(a, b))
        state[arc] = register[key]
    at = np.concatenate(kept_at) if kept_at else np.zeros(0, np.int64)
    return state, np.concatenate(kept_size), w3[at], n3[at]


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[begins], np.add.reduceat(weights[order], begins)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def range_of(first: np.ndarray, second: np.ndarray | None, ranges: int) -> np.ndarray:
    """Prefix range by the hashes of the first word, or the first two."""
    mixed = first if second is None else first * np.uint64(0x9E3779B97F4A7C15) + second
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(20)) % np.uint64(ranges)).astype(np.int64)


def dealt(words: list[bytes], one: tuple, two: tuple, three: tuple, ranges: int) -> Iterator[tuple[int, Automaton]]:
    """The automaton of sorted n-grams, cut by prefix range. Prefixes that lie elsewhere get weight 0."""
    h = _hashes(words)
    (w1, n1), (a, w2, n2), (b, c, w3, n3) = one, two, three
    many = len(words) + 1
    own, pair = range_of(h[w1], None, ranges), range_of(h[a], h[w2], ranges)
    triple = pair[np.searchsorted(a * many + w2, b * many + c)]
    orders = [np.argsort(r, kind="stable") for r in (own, pair, triple)]
    cuts = [np.searchsorted(r[o], np.arange(ranges + 1)) for r, o in zip((own, pair, triple), orders)]
    for at in range(ranges):
        i, j, k = (o[c[at]:c[at + 1]] for o, c in zip(orders, cuts))
        if not len(i) and not len(j):
            continue
        used, local = np.unique(np.concatenate((w1[i], a[j], w2[j], w3[k])), return_inverse=True)
        x1, xa, x2, x3 = np.split(local, np.cumsum([len(i), len(j), len(j)]))
        heads, weights = _summed(np.concatenate((x1, xa)), np.concatenate((n1[i], np.zeros(len(j), np.int64))))
        xb, xc = np.searchsorted(used, b[k]), np.searchsorted(used, c[k])
        yield at, Automaton.of([words[u] for u in used.tolist()], (heads, weights), (xa, x2, n2[j]), (xb, xc, x3, n3[k]))


class Block:
    """Words of one language as numbers, with 0 at ends of pieces, until they are counted."""

    def __init__(self, carried: list[bytes] = ()):
        self.numbers = _Numbers({_END: 0})
        self.parts: list[np.ndarray] = []
        self.size = 0
        self.skipped = len(carried)
        if carried:
            self.add(list(carried))

    def add(self, found: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.size += len(found)

    def counted(self) -> tuple[list[bytes], tuple, tuple, tuple]:
        """(sorted words, single words, pairs, triples); n-grams that end among carried words were counted before."""
        del self.numbers[_END]
        words = sorted(self.numbers)
        rank = np.zeros(len(words) + 1, np.int64)
        for i, w in enumerate(words, 1):
            rank[self.numbers[w]] = i
        ids = rank[np.concatenate([np.zeros(0, np.int32), *self.parts])]
        self.parts.clear()
        self.numbers.clear()
        many = len(words) + 1
        new = np.arange(len(ids)) >= self.skipped
        single, n1 = np.unique(ids[(ids > 0) & new], return_counts=True)
        pair = (ids[:-1] > 0) & (ids[1:] > 0)
        keys, number = np.unique(ids[:-1] * many + ids[1:], return_inverse=True)
        n2 = np.bincount(number[pair & new[1:]], minlength=len(keys))
        triple = pair[:-1] & pair[1:] & new[2:]
        threes, n3 = np.unique(number[:-1][triple] * many + ids[2:][triple], return_counts=True)
        # A triple's first two words are a prefix even where the pair itself was counted before.
        prefix = np.zeros(len(keys), bool)
        prefix[threes // many] = True
        kept = (n2 > 0) | prefix
        place = keys[threes // many]
        return (
            words, (single - 1, n1), (keys[kept] // many - 1, keys[kept] % many - 1, n2[kept]),
            (place // many - 1, place % many - 1, threes % many - 1, n3),
        )


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def cut(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, ``\\n`` at ends of pieces, in lists of a bounded number of bytes."""
    text = text.translate(_TABLE)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + CHUNK) if start + CHUNK < len(text) else -1
        part = text[start:end if end >= 0 else len(text)]
        yield [w for w in part.replace(_END, b" \n ").split(b" ") if w]
        start = end if end >= 0 else len(text)


def shards(docs: DataFrame, ranges: int, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, range, automaton): the count automata of all blocks of text."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, Block] = {}

        def flush(carry: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
            for of, block in sorted(blocks.items()):
                rows = [(at, a.dump()) for at, a in dealt(*block.counted(), ranges)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([of] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                        names=["lang", "range", "automaton"],
                    )
            blocks.clear()
            blocks.update((of, Block(words)) for of, words in carry.items())

        for batch in batches:
            for of, body in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                last: list[bytes] = []
                for found in cut(body):
                    blocks.setdefault(of, Block()).add(found)
                    last = [*last, *found][-2:]
                    if sum(b.size for b in blocks.values()) >= BLOCK:
                        # The text may go on: its last two words are carried over, up to the end of a piece.
                        while _END in last:
                            last = last[last.index(_END) + 1:]
                        yield from flush({of: last})
                if body:
                    blocks.setdefault(of, Block()).add([_END])
        yield from flush({})

    columns = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    return columns.mapInArrow(built, "lang string, range int, automaton binary")


def united(dumps: list[bytes], least: int = LEAST) -> tuple[Automaton, int]:
    """(the union of automata with weights of equal paths added, without paths below ``least``; all single words' weight)."""
    numbers, labels = _Numbers(), []
    total = arcs = 0
    ones: list[tuple[np.ndarray, np.ndarray]] = []
    held: list[Automaton] = []  # as long as they are few
    for raw in dumps:
        a = Automaton.load(raw)
        held.append(a)
        labels.append(np.fromiter(map(numbers.__getitem__, a.words), np.int64, len(a.words)))
        ones.append((labels[-1][a.w1], a.n1))
        total += int(a.n1.sum())
        arcs += len(a.w2)
        if arcs > UNITED:
            held.clear()

    def every() -> Iterator[tuple[Automaton, np.ndarray]]:
        return zip(held if arcs <= UNITED else map(Automaton.load, dumps), labels)

    words = sorted(numbers)
    rank = np.zeros(len(words), np.int64)
    for i, w in enumerate(words):
        rank[numbers[w]] = i
    many = len(words) + 1
    w1, n1 = _summed(rank[np.concatenate([x for x, _ in ones])], np.concatenate([n for _, n in ones])) if ones else (np.zeros(0, np.int64),) * 2
    passes = max(1, -(-arcs // UNITED))
    twos, threes = [], []
    for turn in range(passes):
        # Pairs first; triples only behind pairs that are left, a small part of all.
        keys, weights = [], []
        for automaton, label in every():
            a, b, n = automaton.pairs()
            key = rank[label[a]] * many + rank[label[b]]
            mine = key % passes == turn
            keys.append(key[mine])
            weights.append(n[mine])
        pair, n2 = _summed(np.concatenate(keys), np.concatenate(weights))
        pair, n2 = pair[n2 >= least], n2[n2 >= least]
        twos.append((pair, n2))
        at, third, weights = [], [], []
        for automaton, label in every():
            a, b, _ = automaton.pairs()
            key = rank[label[a]] * many + rank[label[b]]
            where = np.minimum(np.searchsorted(pair, key), max(len(pair) - 1, 0))
            chosen = np.flatnonzero(pair[where] == key) if len(pair) else np.zeros(0, np.int64)
            arc, w3, n3 = automaton.triples(chosen)
            at.append(key[arc])
            third.append(rank[label[w3]])
            weights.append(n3)
        at, third, weights = np.concatenate(at), np.concatenate(third), np.concatenate(weights)
        three, n3 = _summed(np.searchsorted(pair, at) * many + third, weights)
        three, n3 = three[n3 >= least], n3[n3 >= least]
        threes.append((pair[three // many] if len(pair) else three, three % many, n3))
    pair, n2 = (np.concatenate(x) for x in zip(*twos))
    order = np.argsort(pair)
    pair, n2 = pair[order], n2[order]
    head, w3, n3 = (np.concatenate(x) for x in zip(*threes))
    order = np.lexsort((w3, head))
    head, w3, n3 = head[order], w3[order], n3[order]
    heads, weights = _summed(
        np.concatenate((w1[n1 >= least], pair // many)), np.concatenate((n1[n1 >= least], np.zeros(len(pair), np.int64)))
    )
    # Labels that are left over keep their place in the order.
    used, local = np.unique(np.concatenate((heads, pair // many, pair % many, w3, head // many, head % many)), return_inverse=True)
    x1, xa, x2, x3, xb, xc = np.split(local, np.cumsum([len(heads), len(pair), len(pair), len(w3), len(head)]))
    return Automaton.of([words[u] for u in used.tolist()], (x1, weights), (xa, x2, n2), (xb, xc, x3, n3)), total


def _groups(batches: Iterator[pa.RecordBatch], keys: int = 2) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that come sorted by their first columns, as (key, rows) with the other columns."""
    key, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in batch.columns)
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held


def unions(made: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, range, automaton, total): one automaton per prefix range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, at), rows in _groups(batches):
            automaton, total = united([r[0] for r in rows], least)
            yield pa.RecordBatch.from_pylist([{"lang": lang, "range": at, "automaton": automaton.dump(), "total": total}], schema=_UNION)

    return (
        made.repartition("lang", "range").sortWithinPartitions("lang", "range")
        .mapInArrow(run, "lang string, range int, automaton binary, total long")
    )


_UNION = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("automaton", pa.binary()), ("total", pa.int64())])


class Parts:
    """What a range asks for: the single words and the last two words of its phrases, by the range that holds them."""

    def __init__(self, held: Automaton, ranges: int):
        self.held = held
        first, second, self.pair_n = held.pairs()
        arc, third, self.triple_n = held.triples(np.arange(len(second)))
        self.first, self.second, self.arc, self.third = first, second, arc, third
        h = _hashes(held.words)
        self.many = len(held.words) + 1
        self.singles = np.unique(np.concatenate((first, second, third)))
        self.pairs = np.unique(second[arc] * self.many + third)
        a, b = self.pairs // self.many, self.pairs % self.many
        self.single_at = range_of(h[self.singles], None, ranges)
        self.pair_at = range_of(h[a], h[b], ranges)

    def _of(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        return np.flatnonzero(self.single_at == at), np.flatnonzero(self.pair_at == at)

    def asked(self) -> Iterator[tuple[int, Automaton]]:
        """(range, acceptor of the parts it holds)."""
        words = self.held.words
        for at in np.unique(np.concatenate((self.single_at, self.pair_at))).tolist():
            i, j = self._of(at)
            one, a, b = self.singles[i], self.pairs[j] // self.many, self.pairs[j] % self.many
            used, local = np.unique(np.concatenate((one, a, b)), return_inverse=True)
            x, xa, xb = np.split(local, np.cumsum([len(one), len(a)]))
            heads, marks = _summed(np.concatenate((x, xa)), np.concatenate((np.ones(len(x), np.int64), np.zeros(len(xa), np.int64))))
            none = np.zeros(0, np.int64)
            yield at, Automaton.of([words[u] for u in used.tolist()], (heads, marks), (xa, xb, np.ones(len(xa), np.int64)), (none,) * 4)

    def phrases(self, answers: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, bytes, int, int, int, int]]:
        """(number of words, phrase, a, l, r, score) of all phrases, given the counts of their parts by range."""
        single, pair = np.zeros(self.many, np.int64), np.zeros(len(self.pairs), np.int64)
        for at, counts in answers:
            i, j = self._of(at)
            single[self.singles[i]] = counts[:len(i)]
            pair[j] = counts[len(i):]
        words = self.held.words
        for x, y, a in zip(self.first.tolist(), self.second.tolist(), self.pair_n.tolist()):
            left, right = int(single[x]), int(single[y])
            yield 2, words[x] + b" " + words[y], a, left, right, SCALE * a * a // (left * right)
        behind = pair[np.searchsorted(self.pairs, self.second[self.arc] * self.many + self.third)]
        for arc, z, rest, a in zip(self.arc.tolist(), self.third.tolist(), behind.tolist(), self.triple_n.tolist()):
            x, y = int(self.first[arc]), int(self.second[arc])
            cuts = [(int(single[x]), rest), (int(self.pair_n[arc]), int(single[z]))]
            score, _, left, right = min((SCALE * a * a // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
            yield 3, b" ".join((words[x], words[y], words[z])), a, left, right, score


_ASKED = "lang string, range int, origin int, body binary"


def scored(automata: DataFrame, ranges: int) -> DataFrame:
    """(lang, words, phrase, a, l, r, score) of all phrases in ``automata``."""
    fields = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("origin", pa.int32()), ("body", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, origin, raw in zip(*(c.to_pylist() for c in batch.columns)):
                rows = [
                    {"lang": lang, "range": at, "origin": origin, "body": a.dump()} for at, a in Parts(Automaton.load(raw), ranges).asked()
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=fields)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            rows = []
            for lang, at, origin, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if origin is None:
                    key, held = (lang, at), Automaton.load(raw)
                elif key == (lang, at):
                    counts = held.compose(Automaton.load(raw))
                    rows.append({"lang": lang, "range": origin, "origin": at, "body": counts.astype("<i8").tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=fields)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "words", "phrase", "a", "l", "r", "score"]
        kinds = [pa.int32(), pa.binary(), *[pa.int64()] * 4]
        for (lang, _), rows in _groups(batches):
            parts = Parts(Automaton.load(rows[0][1]), ranges)
            found = list(parts.phrases((at, np.frombuffer(raw, "<i8")) for at, raw in rows[1:]))
            if found:
                columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
                columns[1] = columns[1].cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), *columns], names=names)

    def met(rows: DataFrame) -> DataFrame:
        """The rows with their range's automaton before them."""
        own = automata.select("lang", "range", F.lit(None).cast("int").alias("origin"), F.col("automaton").alias("body"))
        return own.unionAll(rows).repartition("lang", "range").sortWithinPartitions("lang", "range", F.col("origin").asc_nulls_first())

    asked = stage(automata.select("lang", "range", "automaton").mapInArrow(ask, _ASKED), "asked-parts")
    answered = stage(met(asked).mapInArrow(answer, _ASKED), "answered-parts")
    return met(answered).mapInArrow(resolve, "lang string, words int, phrase string, a long, l long, r long, score long")


def collocations(docs: DataFrame, first: int = 2000, lang: str = "lang", text: str = "text", least: int = LEAST, inside: int = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by score, occurrences and bytes.

    Null languages count as ``und``, null texts as empty; repeated rows count as often as they occur. A language
    without a phrase that is frequent enough has no row.
    """
    spark = docs.sparkSession
    ranges = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Rows with automata are large; by default up to 256 MB of them would be handed over at a time.
    spark.conf.set(BATCH_BYTES, str(BATCH))
    automata = stage(unions(stage(shards(docs, ranges, lang, text), "count-automata"), least), "united-automata")
    found = stage(scored(automata, ranges), "phrases")
    totals = automata.groupBy("lang").agg(F.sum("total").alias("n"))  # one row per language
    longer = found.where("words = 3")
    two = [F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)]
    covers = longer.select("lang", F.explode(F.array(*two)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    pairs = found.where("words = 2").join(covers, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * inside)
    )
    kept = longer.drop("words").unionByName(pairs.drop("words", "most"))
    # A language's best are found in shares first, so that the last ranking sees a bounded number of them.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    dealt_out = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    best = dealt_out.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= first)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
