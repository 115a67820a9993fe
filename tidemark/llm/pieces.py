"""SentencePiece encoding and decoding: the segmentation into pieces with the highest sum of scores.

Spaces become the marker U+2581, one is put in front, and a Viterbi search over a double-array trie of the
pieces finds the best path; a character that no piece starts with costs more than any piece and comes out
as its UTF-8 bytes. No piece holds a marker behind another character, so text is cut before every run of
markers and each different stretch is searched once; all stretches of a block are searched side by side.

Decoding joins pieces and bytes, turns markers into spaces and drops the first. Text that has U+2581 itself
comes back with a space in its place; all other text comes back as it was.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.tokens import StretchEncoder

MARKER = "▁"
#: How far below the lowest score a character without a piece stands.
UNKNOWN_PENALTY = 10.0
#: Bytes of stretches searched side by side.
SIDE_BY_SIDE = 1 << 18


class DoubleArray:
    """A trie over bytes in two arrays: the child of state s by byte b is base[s] + b, if check there is s."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys.items():
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    values.append(-1)
                node = children[node][byte]
            values[node] = value
        # Nodes with many children first, they are the hardest to fit; those with one fill the gaps.
        start = [0] * len(children)
        used = np.zeros(max(1024, 4 * len(children)) + 1024, bool)
        used[0] = True
        front = 1
        for node in sorted(range(len(children)), key=lambda x: -len(children[x])):
            bytes_ = np.array(sorted(children[node]), np.int64)
            if not len(bytes_):
                break
            if len(bytes_) == 1:
                while used[front] or front <= bytes_[0]:
                    front += 1
                start[node] = front - int(bytes_[0])
                used[front] = True
                continue
            spot = front
            while True:
                spots = np.arange(spot, spot + 256)
                if spots[-1] + 256 >= len(used):
                    used = np.concatenate((used, np.zeros(len(used), bool)))
                fits = ~used[spots[:, None] + bytes_].any(axis=1)
                if fits.any():
                    break
                spot += 256
            start[node] = int(spots[fits.argmax()])
            used[start[node] + bytes_] = True
            # Crowded room is not searched again for nodes of several children.
            if spot > front and used[front:spot].mean() > 0.9:
                front = spot
        size = int(np.flatnonzero(used).max()) + 257
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        state = [0] * len(children)
        for node, below in enumerate(children):  # parents come before their children
            self.base[state[node]] = start[node]
            for byte, child in below.items():
                state[child] = start[node] + byte
                self.check[state[child]], self.value[state[child]] = state[node], values[child]


class Pieces:
    """Pieces and scores of a SentencePiece model file, as plain arrays that go to the workers."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(n)]
        plain = {model.id_to_piece(i): i for i in range(n) if not special[i]}
        self.scores = np.array([model.get_score(i) for i in range(n)], np.float64)
        self.unknown = float(self.scores[list(plain.values())].min()) - UNKNOWN_PENALTY
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.trie = DoubleArray({piece.encode(): i for piece, i in plain.items()})
        self.cut_at_markers = not any(MARKER in piece.lstrip(MARKER) for piece in plain)
        self.cut_at_lines = not any("\n" in piece for piece in plain)
        self.spelled = [b""] * n
        for piece, i in plain.items():
            self.spelled[i] = piece.replace(MARKER, " ").encode()
        for b, i in enumerate(self.bytes.tolist()):
            self.spelled[i] = bytes([b])

    def search(self, stretches: list[bytes]) -> list[list[int]]:
        """Best path of each stretch, all searched side by side."""
        n, longest = len(stretches), max(map(len, stretches))
        text = np.zeros((n, longest + 1), np.int64)
        for row, stretch in zip(text, stretches):
            row[:len(stretch)] = np.frombuffer(stretch, np.uint8)
        sizes = np.fromiter(map(len, stretches), np.int64, n)
        best = np.full((n, longest + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((n, longest + 1), np.int32), np.full((n, longest + 1), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        lead = np.select([text < 0x80, text < 0xE0, text < 0xF0], [1, 2, 3], 4)
        for i in range(longest):
            rows = np.flatnonzero((best[:, i] > -np.inf) & (i < sizes))
            if not len(rows):
                continue
            start, state, end = best[rows, i], np.zeros(len(rows), np.int64), i + lead[rows, i]
            single, of = np.zeros(len(rows), bool), np.arange(len(rows))
            for j in range(i, longest):
                byte = text[rows[of], j]
                to = base[state] + byte
                goes = (check[to] == state) & (j < sizes[rows[of]])
                of, state = of[goes], to[goes]
                if not len(of):
                    break
                hit = value[state] >= 0
                if hit.any():
                    which, ids = of[hit], value[state[hit]]
                    single[which] |= end[which] == j + 1
                    total, at = start[which] + self.scores[ids], rows[which]
                    better = total > best[at, j + 1]
                    at = at[better]
                    best[at, j + 1], back[at, j + 1], piece[at, j + 1] = total[better], i, ids[better]
            for which in np.flatnonzero(~single):
                row, stop = rows[which], end[which]
                if start[which] + self.unknown > best[row, stop]:
                    best[row, stop], back[row, stop], piece[row, stop] = start[which] + self.unknown, i, -1
        found = []
        for stretch, size, backs, ids in zip(stretches, sizes.tolist(), back, piece):
            path, at = [], size
            while at:
                before, chosen = int(backs[at]), int(ids[at])
                path += [chosen] if chosen >= 0 else self.bytes[np.frombuffer(stretch[before:at], np.uint8)][::-1].tolist()
                at = before
            found.append(path[::-1])
        return found

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes that are no UTF-8 come out as U+FFFD."""
        raw = b"".join(map(self.spelled.__getitem__, ids))
        return raw[raw[:1] == b" ":].decode("utf-8", errors="replace")


class PieceEncoder(StretchEncoder):
    def __init__(self, pieces: Pieces):
        super().__init__()
        self._pieces = pieces
        line = r"\n|" if pieces.cut_at_lines else ""
        outside = MARKER + (r"\n" if pieces.cut_at_lines else "")
        self._find = re.compile(f"{line}{MARKER}*[^{outside}]+|{MARKER}+").findall

    def _cut(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARKER + text.replace(" ", MARKER)
        return self._find(marked) if self._pieces.cut_at_markers else [marked]

    def _encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [s.encode() for s in stretches]
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        found: list[list[int]] = [[]] * len(raw)
        first = 0
        while first < len(order):
            # Stretches of like length, as many as fit the room for one block.
            last = first + 1
            while last < len(order) and (last + 1 - first) * len(raw[order[last]]) <= SIDE_BY_SIDE:
                last += 1
            for i, path in zip(order[first:last], self._pieces.search([raw[i] for i in order[first:last]])):
                found[i] = path
            first = last
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum())), sizes


_ENCODERS: dict[str, PieceEncoder] = {}


def encoded(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_pieces, n_bytes, ids_crc32, round_trip) of every row, and the ids if asked for.

    ``n_bytes`` counts ids that stand for single bytes; ``round_trip`` says whether decoding gave the text back. Null and empty
    texts have no pieces. The model file is read on the driver only.
    """
    pieces = Pieces(model_file)
    is_byte = np.zeros(len(pieces.scores), bool)
    is_byte[pieces.bytes] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.setdefault(model_file, PieceEncoder(pieces))
        for batch in batches:
            bodies = batch.column(1).fill_null("").to_pylist()
            for first, ids, counts in encoder.encode(bodies):
                ends = np.cumsum(counts)
                raw, single = ids.astype("<u4"), np.concatenate(([0], np.cumsum(is_byte[ids])))
                spans = list(zip((ends - counts).tolist(), ends.tolist()))
                out = [
                    batch.column(0).slice(first, len(counts)).cast(pa.int64()), pa.array(counts, pa.int64()),
                    pa.array([int(single[b] - single[a]) for a, b in spans], pa.int64()),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                    pa.array([pieces.decode(ids[a:b].tolist()) == body for (a, b), body in zip(spans, bodies[first:])]),
                ]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_pieces", "n_bytes", "ids_crc32", "round_trip", "ids"][:len(out)])

    schema = "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, round_trip boolean" + (", ids array<int>" if with_ids else "")
    return docs.select(doc_id, text).mapInArrow(rows, schema)
