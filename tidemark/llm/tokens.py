"""Token ids by a public vocabulary, with each different stretch of text encoded once per worker.

Byte-pair merges never reach across the vocabulary's own pre-tokens, and no pre-token of the vocabularies
used here holds something else followed by white space, or a letter followed by another kind of character.
So a text may be cut before any space or line feed that follows something else and behind Latin letters,
its stretches encoded on their own and the ids strung together. There are two exceptions, in which the whole text is
encoded as it is: a stretch that ends in other white space, which may belong to the next one, and a text that spells one
of the vocabulary's special tokens, which the library finds first and gives its own id.
"""

import json
import os
import re
from collections.abc import Iterator

import numpy as np

#: A Latin word that ASCII (no letter) or white space follows, or anything up to white space. U+0130 is left
#: out: its lower case is two characters, of which the second is no letter.
_STRETCH = re.compile(r"[ \n]*(?:[A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u024f]++(?=[!-@\[-`{-~ \n]|\Z)|[^ \n]+)|[ \n]+")

#: Latin letters with at most one space before them: each vocabulary known below takes such a stretch for one pre-token.
_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u024f]+")
#: (normalizer, pre-tokenizer) of vocabularies whose model may be asked for a word directly, and whether they read
#: words in lower case without the space.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_KNOWN = [
    (None, _BYTE_LEVEL | {"use_regex": True}, False),
    (
        {"type": "Sequence", "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
        ]},
        {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
             "behavior": "Removed", "invert": True},
            _BYTE_LEVEL | {"use_regex": False},
        ]},
        True,
    ),
]
#: The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

#: Stretches kept for good by each worker; later ones are forgotten after use. Bounds memory, not results.
KEPT = 400_000
#: Characters encoded together.
BLOCK = 2_000_000
#: Stretches strung together for the library.
_TOGETHER = 24


class _Places(dict):
    """Numbers stretches in the order they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, stretch: str) -> int:
        self.new.append(stretch)
        self[stretch] = place = len(self)
        return place


class StretchEncoder:
    """Ids of whole texts, stretch by stretch; ``end``, if any, is appended to each text.

    A subclass says how texts are cut, what a stretch encodes to, and which stretches cannot be encoded on
    their own.
    """

    def __init__(self, end: int | None = None, kept: int = KEPT):
        self._end, self._kept = end, kept
        self._place = _Places()
        self._odd: set[str] = set()
        self._starts = np.zeros(0, np.int64)
        self._sizes = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _cut(self, text: str) -> list[str]:
        raise NotImplementedError

    def _encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many each has)."""
        raise NotImplementedError

    def _depends(self, stretch: str) -> bool:
        """Whether what follows may change the stretch's ids."""
        return False

    def _uncut(self, text: str) -> bool:
        """Whether a text must be encoded as a whole."""
        return False

    def _whole(self, text: str) -> np.ndarray:
        return self._encode([text])[0]

    def _learn(self, new: list[str]) -> None:
        ids, sizes = self._encode(new)
        ends = np.cumsum(sizes) + len(self._ids)
        self._starts = np.concatenate((self._starts, ends - sizes))
        self._sizes = np.concatenate((self._sizes, sizes))
        self._ids = np.concatenate((self._ids, ids))

    def _forget(self, new: list[str]) -> None:
        keep = max(self._kept - (len(self._place) - len(new)), 0)
        for stretch in new[keep:]:
            del self._place[stretch]
        n = len(self._place)
        self._starts, self._sizes = self._starts[:n], self._sizes[:n]
        self._ids = self._ids[: self._starts[-1] + self._sizes[-1]] if n else self._ids[:0]

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        uncut = {i for i, text in enumerate(texts) if self._uncut(text)}
        cut = [self._cut(text) if i not in uncut else [] for i, text in enumerate(texts)]
        place = self._place.__getitem__
        places = [np.fromiter(map(place, stretches), np.int64, len(stretches)) for stretches in cut]
        new, self._place.new = self._place.new, []
        self._learn(new)
        self._odd.update(filter(self._depends, new))
        whole = set(uncut)
        if self._odd:
            whole.update(i for i, stretches in enumerate(cut) if not self._odd.isdisjoint(stretches))
        for i in whole:
            places[i] = places[i][:0]
        counts = np.array([self._sizes[p].sum() for p in places], np.int64)
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        sizes = self._sizes[at]
        first = np.cumsum(sizes) - sizes
        ids = self._ids[np.repeat(self._starts[at] - first, sizes) + np.arange(int(sizes.sum()))]
        if whole:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in whole:
                parts[i] = self._whole(texts[i])
                counts[i] = len(parts[i])
            ids = np.concatenate(parts)
        self._forget(new)
        if self._end is None:
            return ids, counts
        return np.insert(ids, np.cumsum(counts), self._end), counts + 1

    def encode(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(place of the first text, ids, ids per text) of blocks of neighbouring texts."""
        first = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= BLOCK or i + 1 == len(texts):
                yield first, *self._block(texts[first:i + 1])
                first, size = i + 1, 0


class Encoder(StretchEncoder):
    """Ids by a file of the ``tokenizers`` library, as a plain call with ``add_special_tokens=False`` gives them.

    Stretches are encoded many at a time with a special token between them: the library cuts a text there
    before anything else, so each stretch is encoded on its own, and the token's id says where it ends.
    """

    def __init__(self, vocabulary: str, end: int, kept: int = KEPT):
        super().__init__(end, kept)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._cut = _STRETCH.findall
        added = self._tokenizer.get_added_tokens_decoder()
        self._special = re.compile("|".join(re.escape(t.content) for t in added.values())) if added else None
        plain = [(i, t.content) for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self._between = plain[0] if plain else None
        with open(vocabulary, encoding="utf-8") as file:
            parts = json.load(file)
        lowered = [low for n, p, low in _KNOWN if (n, p) == (parts.get("normalizer"), parts.get("pre_tokenizer"))]
        self._direct, self._lowered = bool(lowered) and parts["model"]["type"] == "BPE", lowered == [True]

    def _uncut(self, text: str) -> bool:
        return self._special is not None and self._special.search(text) is not None

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def _encode(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words go to the vocabulary's model at once, which takes a third of the time; all else goes through the whole library."""
        if not self._direct:
            return self._marked(stretches)
        word = np.fromiter((_WORD.fullmatch(s) is not None for s in stretches), bool, len(stretches))
        rest, rest_sizes = self._marked([s for s, w in zip(stretches, word) if not w])
        words = [s for s, w in zip(stretches, word) if w]
        if self._lowered:
            words = [s.lstrip(" ").lower() for s in words]
        # Of ASCII only the space is written in another way.
        words = [s.replace(" ", "Ġ") if s.isascii() else s.encode().decode("latin-1").translate(_BYTES) for s in words]
        found, counts, tokenize = [], [], self._tokenizer.model.tokenize
        for w in words:
            ids = [t.id for t in tokenize(w)]
            found += ids
            counts.append(len(ids))
        sizes = np.zeros(len(stretches), np.int64)
        sizes[word], sizes[~word] = counts, rest_sizes
        of_word = np.repeat(word, sizes)
        ids = np.zeros(len(of_word), np.int32)
        ids[of_word], ids[~of_word] = found, rest
        return ids, sizes

    def _marked(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self._between is None:
            found = [self._whole(s) for s in stretches]
            return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(f) for f in found], np.int64)
        mark, between = self._between
        joined = [between.join([*stretches[i:i + _TOGETHER], ""]) for i in range(0, len(stretches), _TOGETHER)]
        found = self._tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.int32), *(np.array(e.ids, np.int32) for e in found)])
        return ids[ids != mark], np.diff(np.flatnonzero(ids == mark), prepend=-1) - 1

    def _depends(self, stretch: str) -> bool:
        return stretch[-1].isspace() and stretch[-1] not in " \n"


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(vocabulary: str, end: int) -> Encoder:
    """The worker's encoder for a vocabulary; its stretches serve all its tasks."""
    if (vocabulary, end) not in _ENCODERS:
        _ENCODERS[vocabulary, end] = Encoder(vocabulary, end)
    return _ENCODERS[vocabulary, end]


def forget() -> None:
    """Gives back what the worker's encoders keep; called where it turns to other work."""
    _ENCODERS.clear()
