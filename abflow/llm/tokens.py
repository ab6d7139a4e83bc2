"""Public tokenizers on whole texts, each distinct word encoded once per worker.

A text is cut at single spaces where the tokenizer cuts too, and the pieces'
ids are remembered, so most words cost one dictionary lookup. A new piece is cut
into the tokenizer's words, which are remembered too, and only new words
are merged by the library. The ids are those of the library on the whole text:
texts and pieces where a cut could matter go to the library whole.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import release

# white space on both sides of a space: a run that a cut at the space would split
_RUN = re.compile(r"\s \s")
# pieces in which letters, digits and other signs are told apart without Unicode tables
_LATIN = re.compile(r"[\n\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d|"
_BYTE_WORDS = re.compile(rf"{_SHORT} ?[{_L}]+| ?[0-9]+| ?[^\s0-9{_L}]+|\s+(?!\S)|\s+")
_PLAIN_WORDS = re.compile(rf"{_SHORT}[{_L}]+|[0-9]|[^\s0-9{_L}]+")
# byte-level models name a byte by a printable character: its own, or the next one from 256 on
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_NAMES = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
_loaded: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts, packed in ``dtype``. Of pieces and words, the last ``limit`` and up to as many before them are remembered."""

    def __init__(self, path: str, limit: int = 600_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path) as f:
            spec = json.load(f)
        before, norm = spec["pre_tokenizer"] or {}, spec["normalizer"]
        # byte level: a word keeps the space before it
        self.spaced = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and norm is None
        # white space is only a separator, case is folded
        self.plain = before.get("type") == "Sequence" and before["pretokenizers"][0].get("behavior") == "Removed" and norm is not None
        self.special = [x["content"] for x in spec["added_tokens"]]
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype, self.code = np.dtype("<u4" if wide else "<u2"), "I" if wide else "H"
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _word(self, word: str) -> bytes:
        """A word of the tokenizer, all of it merged by the model."""
        got = self.known.get(word) or self.old.get(word)
        if got is None:
            if word.isascii() and word.isprintable():
                named = word.replace(" ", _NAMES[32])
            else:
                named = word.encode().decode("latin-1").translate(_NAMES)
            got = self._pack([t.id for t in self.model.tokenize(named)])
        self.known[word] = got
        return got

    def _piece(self, piece: str) -> bytes | None:
        """A new piece's ids; None if only the library can tell."""
        got = self.old.get(piece)
        if got is None:
            if not _LATIN.fullmatch(piece) or ("<" in piece and any(s in piece for s in self.special)):
                return None
            text = piece.lower() if self.plain else piece
            if text.lstrip(" ").isalpha():
                got = self._word(text)
            else:
                got = b"".join([self._word(w) for w in (_PLAIN_WORDS if self.plain else _BYTE_WORDS).findall(text)])
        self.known[piece] = got
        return got

    def _cut(self, text: str) -> list[str]:
        parts = text.split(" ")
        if self.plain:
            return [x for x in parts if x]
        return ([parts[0]] if parts[0] else []) + [" " + x for x in parts[1:]]

    def _ids(self, text: str) -> bytes:
        if not (self.plain or (self.spaced and not _RUN.search(text))):
            return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        pieces = self._cut(text)
        got = list(map(self.known.get, pieces))
        if None in got:
            hard = []
            for i, g in enumerate(got):
                if g is None:
                    got[i] = g = self.known.get(pieces[i]) or self._piece(pieces[i])
                    if g is None:
                        hard.append(i)
            if hard:
                new = self.tokenizer.encode_batch([pieces[i] for i in hard], add_special_tokens=False)
                for i, e in zip(hard, new, strict=True):
                    got[i] = self.known[pieces[i]] = self._pack(e.ids)
        return b"".join(got)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, null as empty."""
        out = []
        for t in texts:
            if len(self.known) > self.limit:
                self.old, self.known = self.known, {}
            out.append(np.frombuffer(self._ids(t) if t else b"", self.dtype))
        return out


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def forget() -> None:
    """Let go of what this worker remembers from an earlier stage; workers outlive stages."""
    if _loaded:
        import gc

        _loaded.clear()
        gc.collect()
        release()


def some_texts(texts: list[str | None], chars: int = 1 << 20):
    """(first row, texts) in parts of about ``chars`` characters, whole texts."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n < chars):
            n += len(texts[j] or "")
            j += 1
        yield i, texts[i:j]
        i = j


def column_texts(col: pa.Array, size: int = 1 << 20):
    """(first row, texts) of an Arrow column in parts of about ``size`` bytes, whole texts; only one part is held as strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right")))
        yield i, col.slice(i, j - i).to_pylist()
        i = j


def public_path(name: str) -> str:
    """Place of a public tokenizer's file; the package is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)
