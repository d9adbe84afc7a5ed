"""Exact tokens of whole texts, word by distinct word.

The vocabulary drops white space and merges nothing across it, so a text's
tokens are its words' tokens in order.  A batch of texts is cut at ASCII white
space in its buffer, distinct words are encoded once by the library, and the
rest is lookups in arrays.  Words are encoded many in one string, between NUL
words, whose one token marks the ends; words that hold NUL go one by one.

Words are cut further between an ASCII letter and an ASCII digit or sign other
than the apostrophe, which no token spans, and A-Z are lower-cased as the
vocabulary does.  Both are left out for a part that holds ``<|``, as special
tokens do, or combining accents, which could join a letter in one case only.

White space outside ASCII and the strings of special tokens stay inside words,
where the library treats them as it does in the whole text.
"""

from __future__ import annotations

import ctypes
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

#: Bytes of text that are cut and looked up at once; one longer text is a part of its own.
PART_BYTES = 24 << 20
KNOWN = 400_000
_JOINED = 20_000
_CODES = np.arange(256)
_LETTER = ((_CODES >= 97) & (_CODES <= 122)) | ((_CODES >= 65) & (_CODES <= 90))
_SIGN = (_CODES > 32) & (_CODES < 127) & ~_LETTER & (_CODES != ord("'"))
_LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_SHORT = 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def parts(batch: pa.RecordBatch, column: str = "text", most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``most`` bytes."""
    sizes = np.diff(_offsets(_filled(batch.column(column))))
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    yield batch.slice(start)


def tidied(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; afterwards the worker, which later tasks reuse, returns freed memory."""
    yield from rows
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _filled(texts: pa.Array) -> pa.Array:
    return texts.cast(pa.large_string()).fill_null("")


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], dtype="<i8")[texts.offset : texts.offset + len(texts) + 1]


class Words:
    """The texts of one part: their bytes, and each word's place and distinct number.

    Without ``cut`` words end at ASCII white space only and keep their case.
    """

    def __init__(self, column: pa.Array, cut: bool = True) -> None:
        texts = _filled(column)
        offsets = _offsets(texts) if len(texts) else np.zeros(1, dtype="<i8")
        held = texts.buffers()[2]
        data = np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
        self.data, self.bounds = data, offsets - offsets[0]
        self.inside = inside = ~_WHITE[data]
        fresh = np.zeros(len(data) + 1, dtype=bool)
        fresh[self.bounds] = True
        fresh[1:-1] |= ~inside[:-1]
        raw = data.tobytes()
        if cut and not (b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw):
            letter, sign = _LETTER[data], _SIGN[data]
            fresh[1:-1] |= (letter[1:] & sign[:-1]) | (sign[1:] & letter[:-1])
            data = _LOWER[data]
        fresh = fresh[:-1][inside]
        starts = np.flatnonzero(fresh)
        packed = data[inside].tobytes()
        bounds = np.append(starts, len(packed))
        words = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)]
        ).dictionary_encode()
        self.of = words.indices.to_numpy(zero_copy_only=False)
        self.raw: list[bytes] = words.dictionary.to_pylist()
        #: Number of words before each text, and after the last.
        self.first_word = np.searchsorted(starts, self.counted(inside))

    @property
    def distinct(self) -> list[str]:
        return [w.decode("utf-8", "replace") for w in self.raw]

    def counted(self, flags: np.ndarray) -> np.ndarray:
        """How many flags are set before each text, and before the end."""
        counts = [np.count_nonzero(flags[a:b]) for a, b in zip(self.bounds, self.bounds[1:])]
        return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


def spread(flat: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``chosen`` of ``flat`` one after the other, and where each begins."""
    lengths = np.diff(bounds)[chosen]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    at = np.repeat(bounds[:-1][chosen] - ends[:-1], lengths) + np.arange(ends[-1])
    return flat[at], ends


class Encoder:
    """The library's tokenizer, for distinct words and for their prefixes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path = path
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self._mark = self.ids("\0")[0]
        self._known: dict[str, int] = {}
        self._long: LongPieces | None = None

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and where each word's begin."""
        counts = np.zeros(len(words), dtype=np.int64)
        found = []
        for at in range(0, len(words), _JOINED):
            some = words[at : at + _JOINED]
            odd = {i: self.ids(w) for i, w in enumerate(some) if "\0" in w}
            joined = " \0 ".join("" if i in odd else w for i, w in enumerate(some)) + " \0"
            encoded = self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids
            ids = np.array(encoded, dtype="<u4")
            marks = np.flatnonzero(ids == self._mark)
            counts[at : at + len(some)] = np.diff(np.concatenate(([-1], marks))) - 1
            if odd:
                pieces = np.split(ids, marks + 1)
                for i, own in odd.items():
                    counts[at + i] = len(own)
                    pieces[i] = np.array([*own, self._mark], dtype="<u4")
                ids = np.concatenate(pieces)
                ends = np.cumsum(counts[at : at + len(some)] + 1) - 1
                ids = np.delete(ids, ends)
            else:
                ids = np.delete(ids, marks)
            found.append(ids)
        bounds = np.concatenate(([0], np.cumsum(counts)))
        return (np.concatenate(found) if found else np.zeros(0, dtype="<u4")), bounds

    def prefix_counts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of every prefix of every word, by code points, and where each word's begin.

        Words share most of their prefixes, so each distinct prefix is encoded once.
        The first ``KNOWN`` that a worker meets, where the frequent ones are, it remembers.
        """
        kept = self._known
        fresh = {w[:n] for w in words if len(w) <= _SHORT for n in range(1, len(w) + 1)}
        prefixes = list(fresh.difference(kept))
        _, bounds = self.encode(prefixes)
        found = dict(zip(prefixes, np.diff(bounds).tolist()))
        if len(kept) < KNOWN:
            kept.update(found)
            known = kept
        else:
            known = found | {p: kept[p] for p in fresh.intersection(kept)}
        counts: list[int] = []
        ends = [0]
        for w in words:
            if len(w) <= _SHORT:
                counts.extend([known[w[:n]] for n in range(1, len(w) + 1)])
            else:
                counts.extend(self._long_counts(w))
            ends.append(len(counts))
        return np.array(counts, dtype=np.int64), np.array(ends, dtype=np.int64)

    def _long_counts(self, word: str) -> list[int]:
        special = any(t.content in word for t in self.library.get_added_tokens_decoder().values())
        if special or not unicodedata.is_normalized("NFC", word):
            return [len(self.ids(word[:n])) for n in range(1, len(word) + 1)]
        self._long = self._long or LongPieces(self)
        return self._long.counts(word)


class LongPieces:
    """Prefix counts of long words, in time that grows with their length.

    A merge sequence has the property that a prefix of its tokens is the
    encoding of their text.  So the tokens of a prefix are those of a shorter
    one and one more, which is the token that stays apart from the shorter
    one's last when the two are encoded together.  Each step looks back by at
    most the longest token.
    """

    _PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, encoder: Encoder) -> None:
        import json

        self.encoder = encoder
        with open(encoder.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.vocabulary, self.end = model["vocab"], model["end_of_word_suffix"]
        self.longest = max(map(len, self.vocabulary))
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = dict(zip(visible, map(chr, visible)))
        hidden = (b for b in range(256) if b not in shown)
        self.letter = shown | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.apart: dict[tuple[str, str], bool] = {}

    def counts(self, word: str) -> list[int]:
        lowered = "".join(c.lower() for c in word)
        if len(lowered) != len(word):
            return [len(self.encoder.ids(word[:n])) for n in range(1, len(word) + 1)]
        out, done, at = [], 0, 0
        for piece in self._PIECE.finditer(lowered):
            out.extend([done] * (piece.start() - at))
            text = piece.group()
            inner = (
                [len(self.encoder.ids(text[:n])) for n in range(1, len(text) + 1)]
                if len(text) <= _SHORT else self._piece(text)
            )
            out.extend(done + n for n in inner)
            done, at = out[-1], piece.end()
        out.extend([done] * (len(word) - at))
        return out

    def _piece(self, text: str) -> list[int]:
        letters, ends = [], []
        for c in text:
            letters.extend(self.letter[b] for b in c.encode("utf-8"))
            ends.append(len(letters))
        joined = "".join(letters)
        count, last = [0], [""]
        for n in range(1, len(joined) + 1):
            size, token = self._last(joined, n, last, "")
            count.append(count[n - size] + 1)
            last.append(token)
        return [count[n - self._last(joined, n, last, self.end)[0]] + 1 for n in ends]

    def _last(self, joined: str, n: int, last: list[str], end: str) -> tuple[int, str]:
        for size in range(1, min(n, self.longest) + 1):
            token = joined[n - size : n] + end
            if token in self.vocabulary and self._stay(last[n - size], joined[n - size : n], end):
                return size, token
        raise ValueError(f"no token ends {joined[:n][-20:]!r}")

    def _stay(self, left: str, right: str, end: str) -> bool:
        key = (left, right + end)
        if key not in self.apart:
            symbols = [*left, *right[:-1], right[-1] + end]
            while len(symbols) > 1:
                best = min(range(len(symbols) - 1), key=lambda i: self.rank.get((symbols[i], symbols[i + 1]), 1 << 60))
                if (symbols[best], symbols[best + 1]) not in self.rank:
                    break
                pair = (symbols[best], symbols[best + 1])
                merged, i = [], 0
                while i < len(symbols):
                    if tuple(symbols[i : i + 2]) == pair:
                        merged.append(pair[0] + pair[1])
                        i += 2
                    else:
                        merged.append(symbols[i])
                        i += 1
                symbols = merged
            self.apart[key] = symbols == ([left, right + end] if left else [right + end])
        return self.apart[key]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One tokenizer for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
