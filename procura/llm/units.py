"""Encode whole texts with the ``tokenizers`` library, unit by unit.

Neither vocabulary has tokens that cross certain white space, so a text can be cut
there without changing its ids.  Every distinct unit is encoded once per Python worker
by the library and its ids (32-bit little-endian) are remembered.

* ``word``: the pre-tokenizer drops white space; cut at ASCII white space.
* ``byte``: a space goes with the word after it; cut before a space that a
  non-space follows.  Any other white space stays inside the unit to its left.

A punctuation mark after a letter and before white space is a unit of its own (so a word is remembered once,
whatever follows it), and with ``byte`` so are a line end between a letter or such a mark and a letter, and the word after
that line end.  Such units carry a leading byte that no UTF-8 text has.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata

from tokenizers.models import BPE

from .common import held, tokenizer

KINDS = {"word": b"", "byte": b" "}
#: Longer units (rare: encoded blobs) are not remembered.
KEEP_UNIT_BYTES = 64
#: Units in one generation of a worker's memory; the generation before it is kept as well.
KEEP_UNITS = 400_000

_SPACE_AHEAD = re.compile(r" (?=[^\s])")
#: Leading bytes of a unit that follows its left neighbour without a space: a mark or line end, and a word.
_GLUED, _NO_SPACE = b"\xfe", b"\xfd"
_MARKS = ".,;:!?"
_MARK = re.compile(rb"([.,;:!?])(?<=[A-Za-z].)(?=\s)")
_MARK_SPACE = re.compile(rb"([.,;:!?])(?<=[A-Za-z].)(?= [^\s]|\n[A-Za-z])")
_LINE_END = re.compile(rb"\n(?:(?<=[A-Za-z]\n)|(?<=\xfe[.,;:!?]\n))(?=[A-Za-z])")
_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def byte_letters() -> list[str]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


_LETTERS = byte_letters()


def _bare_model(path: str) -> BPE:
    """The library's BPE of a vocabulary file, without its own cache (the units are remembered here)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    return BPE(
        vocab=model["vocab"],
        merges=[tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]],
        cache_capacity=0,
        **{k: model[k] for k in ("end_of_word_suffix",) if model[k] is not None},
    )


def _packed(ids: list[int]) -> bytes:
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


class _NotAUnit(Exception):
    """A piece that belongs to the unit before it (runs of white space)."""


class _Units(dict):
    """unit without its leading space -> ids as bytes."""

    def __init__(self, tok, model: BPE, lead: bytes, folds: bool):
        super().__init__()
        self.tok = tok
        self.model = model
        self.lead = lead
        self.start = "".join([_LETTERS[b] for b in lead])
        self.folds = folds  # the vocabulary is lower case
        self.older: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {c: self.encode(c) for c in _MARKS}
        #: Units with a leading byte of their own, and who encodes words without a space before them.
        self.glued = {_GLUED: b""} | {_GLUED + c.encode(): self.encode(c) for c in [*_MARKS, "\n"]}
        self.bare: _Units = self

    def encode(self, text: str) -> bytes:
        return _packed(self.tok.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes | None:
        """A run of Latin letters is one pre-token, so the library's model can take it as it is."""
        if not word.isalpha():
            return None
        if word.isascii():
            raw = word.lower() if self.folds else word
        elif max(word) >= "\u0250":
            return None
        else:
            if self.folds:
                word = "".join([c.lower() for c in unicodedata.normalize("NFC", word)])
                if not word.isalpha():
                    return None
            raw = "".join([_LETTERS[b] for b in word.encode("utf-8")])
        return _packed([t.id for t in self.model.tokenize(self.start + raw)])

    def ids(self, unit: bytes) -> bytes:
        text = unit.decode("utf-8")
        if text[-1:] in self.marks and (out := self.word(text[:-1])) is not None:
            return out + self.marks[text[-1]]
        out = self.word(text)
        return self.encode(self.lead.decode() + text) if out is None else out

    def __missing__(self, unit: bytes) -> bytes:
        if (out := self.older.get(unit)) is None:
            if unit.isalpha():  # ASCII letters
                out = _packed([t.id for t in self.model.tokenize(self.start + (unit.lower() if self.folds else unit).decode())])
            elif unit[:1] == _GLUED:
                out = self.glued[unit]
            elif unit[:1] == _NO_SPACE:
                out = self.bare[unit[1:]]
            elif self.lead and (not unit or unit.decode("utf-8")[0].isspace()):
                raise _NotAUnit
            else:
                out = self.ids(unit)
        if len(unit) <= KEEP_UNIT_BYTES:
            if len(self) >= KEEP_UNITS:
                self.older = dict(self)
                self.clear()
            self[unit] = out
        return out


class Encoder:
    """ids of whole texts, equal to ``encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str, kind: str):
        tok, model = tokenizer(path), _bare_model(path)
        self.first = _Units(tok, model, b"", folds=kind == "word")
        self.rest = _Units(tok, model, KINDS[kind], folds=False) if KINDS[kind] else self.first
        self.rest.bare = self.first
        self.cut_spaces = kind == "byte"

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.cut_spaces:
            return b"".join(map(self.first.__getitem__, _MARK.sub(b" \xfe\\1", text.encode("utf-8")).split()))
        raw = _MARK_SPACE.sub(b" \xfe\\1", text.encode("utf-8"))
        if b"\n" in raw:
            raw = _LINE_END.sub(b" \xfe\\n \xfd", raw)
        head, *tail = raw.split(b" ")
        try:
            return self._head(head) + b"".join(map(self.rest.__getitem__, tail))
        except _NotAUnit:
            head, *tail = _SPACE_AHEAD.split(text)
            return self._head(head.encode("utf-8")) + b"".join([self.rest[x.encode("utf-8")] for x in tail])

    def _head(self, unit: bytes) -> bytes:
        return self.first[unit] if unit else b""


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return held(("encoder", path, kind), lambda: Encoder(path, kind))
