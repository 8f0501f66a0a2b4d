"""Token ids of whole texts by a public tokenizer, with the ids of repeated words kept.

The tokenizers used here split a text before every space and around every line break
before they merge anything, so words can be encoded apart. Texts for which that does not
hold (runs of white space, other white space than space and line break, special tokens)
are encoded whole.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import repeat

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: What a text that is encoded by words must not hold: white space in runs or of other kinds, special tokens.
_RUNS = ["  ", "\n\n", " \n", "\n ", "<|", "\0", "\t", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x1f"]
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A full stop or comma that is one piece with what stands beside it: other punctuation, or a space before it.
_TOGETHER = re.compile(r"[.,](?:[^\w\s]|_|(?<![^\W_].))")
#: Letters of Latin-1, with a space before them at most, and punctuation behind: two pieces for either vocabulary.
_WORD = re.compile(r"( ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([^\w\s']*)")
#: Byte-level vocabularies write the bytes of these ranges as themselves, all others, in order, from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in set(_PRINTED))}


class Encoder:
    """Encodes texts; keeps the ids of `kept` words and drops those seen once when it holds more."""

    def __init__(self, path: str, kept: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaced = self.tokenizer.pre_tokenizer.__class__.__name__ == "ByteLevel"
        self.kept = kept
        self.at: dict[str, int] = {}
        self.ids, self.starts, self.uses = [np.zeros(1 << 16, kind) for kind in (np.uint16, np.int64, np.int32)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has ids[offsets[i]:offsets[i + 1]], 32-bit integers."""
        if len(self.at) > self.kept:
            self._forget()
        units, ends, whole = [], [], {}
        for i, text in enumerate(texts):
            if any(x in text for x in _RUNS) or (not text.isascii() and _WIDE.search(text)):
                whole[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                units += self._units(text)
            ends.append(len(units))
        at = np.fromiter(map(self.at.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self._learn({units[k] for k in missing})
            at[missing] = [self.at[units[k]] for k in missing]
        self.uses += np.bincount(at, minlength=len(self.uses)).astype(np.int32)
        sizes = self.starts[at + 1] - self.starts[at]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        ids = self.ids[np.repeat(self.starts[at] - (stops - sizes), sizes) + np.arange(total)].astype(np.uint32)
        offsets = np.concatenate(([0], np.concatenate(([0], stops))[ends])).astype(np.int64)
        if whole:
            parts = [whole.get(i, ids[offsets[i] : offsets[i + 1]]) for i in range(len(texts))]
            ids = np.concatenate(parts)
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, offsets

    def _units(self, text: str) -> list[str]:
        cut = text.replace(" ", "\0 ").replace("\n", "\0\n\0") if self.spaced else _lower(text).replace(" ", "\0").replace("\n", "\0")
        if not _TOGETHER.search(text):
            cut = cut.replace(",", "\0,\0").replace(".", "\0.\0")
        return list(filter(None, cut.split("\0")))

    def _learn(self, units: set[str]) -> None:
        gc.disable()  # many small lists that hold no cycles
        rows, known, at = [], {}, self.at
        for unit in units:
            if unit.isascii() and (unit.isalpha() or (unit[0] == " " and unit[1:].isalpha())):
                rows.append(self._merged(unit))
                continue
            cut = _WORD.fullmatch(unit)
            ids = []
            for piece in (cut[1], cut[2]) if cut and cut[2] else (unit,):
                place = at.get(piece)
                if place is not None:
                    ids += self.ids[self.starts[place] : self.starts[place + 1]].tolist()
                    continue
                if piece not in known:
                    known[piece] = self._merged(piece) if cut and piece is not cut[2] else self.tokenizer.encode(piece, add_special_tokens=False).ids
                ids += known[piece]
            rows.append(ids)
        self._append(list(units), rows)
        gc.enable()

    def _merged(self, word: str) -> list[int]:
        """Ids of letters, which need no splitting, straight from the tokenizer's merges."""
        word = word if self.spaced else word.lower()
        shown = word.replace(" ", "\u0120") if word.isascii() else word.encode().decode("latin-1").translate(_SHOWN)
        return [token.id for token in self.model.tokenize(shown)]

    def _append(self, units: list[str], rows: list[list[int]]) -> None:
        n, used = len(self.at), int(self.starts[len(self.at)])
        self.at.update(zip(units, range(n, n + len(units))))
        ends = used + np.cumsum([len(r) for r in rows])
        self.ids = _room(self.ids, int(ends[-1]) + 1)
        self.ids[used : ends[-1]] = [x for r in rows for x in r]
        self.starts = _room(self.starts, n + len(units) + 2)
        self.starts[n + 1 : n + 1 + len(units)] = ends
        self.uses = _room(self.uses, n + len(units) + 1)

    def _forget(self) -> None:
        kept = [(u, k) for u, k in self.at.items() if self.uses[k] > 1]
        kept = kept[: self.kept // 2]
        rows = [self.ids[self.starts[k] : self.starts[k + 1]].tolist() for _, k in kept]
        uses = self.uses[[k for _, k in kept]] // 2 if kept else np.zeros(0, np.int32)
        self.at, self.starts = {}, np.zeros(1 << 16, np.int64)
        self.uses = np.zeros(1 << 16, np.int32)
        if kept:
            self._append([u for u, _ in kept], rows)
            self.uses[: len(uses)] = uses


def _lower(text: str) -> str:
    return text.lower() if text.isascii() or max(text) <= "\xff" else text


def _room(array: np.ndarray, n: int) -> np.ndarray:
    return array if len(array) >= n else np.concatenate((array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
