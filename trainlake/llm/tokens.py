"""Token ids of texts by the tokenizers library, with repeated words looked up."""

from __future__ import annotations

import re
import struct
from collections.abc import Sequence
from functools import cached_property

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

_SPACE = r"\t-\r \x85\xa0  -     　"
_LETTER = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: Byte-level BPE never joins a word with the blank, line break or mark behind it, so
#: the ids of a text are those of these pieces in order.
_PIECE = re.compile(
    rf" ?[{_LETTER}]+(?=[ \n,.!?;:|]|\Z)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: Words that are one piece for the tokenizer, too. A byte-level vocabulary writes visible bytes as themselves in Latin-1, the blank and
#: all others as the letters from this one on.
_WORD = re.compile(rf" ?[{_LETTER}]+\Z")
_HIDDEN = [b for b in range(256) if b < 33 or 127 <= b <= 160 or b == 173]
_SHOWN = {b: chr(0x100 + k) for k, b in enumerate(_HIDDEN)}
_BLANK = _SHOWN[32]
CACHED_PIECES = 800_000
LONGEST_CACHED = 64
#: Stands between pieces that are asked for together; its token has no other byte.
_BETWEEN = "\x00"
ASKED = 128


def _positions(values: list, wanted: object) -> list[int]:
    found, at = [], -1
    try:
        while True:
            at = values.index(wanted, at + 1)
            found.append(at)
    except ValueError:
        return found


class Encoder:
    """Encodes whole texts of a byte-level BPE, with the ids that the library gives without added special tokens.

    The library is asked once for each different piece (a word with the blank before it), for many pieces in one call. At most
    ``cached`` pieces are remembered, in two halves: when the newer is full it becomes the older, and what is used again moves up.
    Texts that hold a special string of the tokenizer, or the character between pieces, are encoded as they are.
    """

    def __init__(self, path: str, cached: int = CACHED_PIECES):
        self._path = path
        self._joined = Tokenizer.from_file(path)
        self._joined.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(_BETWEEN, "isolated"), self._joined.pre_tokenizer])
        (self._between,) = self._joined.encode(_BETWEEN, add_special_tokens=False).ids
        self._model = self._joined.model
        self._whole = [_BETWEEN, *(t.content for t in self._joined.get_added_tokens_decoder().values())]
        self._newer: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._half = max(1, cached // 2)

    @property
    def vocabulary(self) -> int:
        return self._joined.get_vocab_size()

    @cached_property
    def _plain(self) -> Tokenizer:
        return Tokenizer.from_file(self._path)

    def _ask(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of different pieces: of words from the model itself, of all others through the tokenizer's splitting."""
        found, others = {}, []
        for piece in pieces:
            if _WORD.match(piece):
                shown = piece.replace(" ", _BLANK) if piece.isascii() else piece.encode().decode("latin-1").translate(_SHOWN)
                ids = [token.id for token in self._model.tokenize(shown)]
                found[piece] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                others.append(piece)
        for k in range(0, len(others), ASKED):
            some = others[k : k + ASKED]
            (encoded,) = self._joined.encode_batch_fast([_BETWEEN.join(some)], add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            data, start = ids.tobytes(), 0
            for piece, end in zip(some, [*np.flatnonzero(ids == self._between).tolist(), len(ids)], strict=True):
                found[piece] = data[4 * start : 4 * end]
                start = end + 1
        return found

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        older = self._older
        found = {p: older[p] for p in pieces if p in older}
        if len(found) < len(pieces):
            found.update(self._ask([p for p in pieces if p not in found]))
        for piece, ids in found.items():
            if len(piece) <= LONGEST_CACHED:
                if len(self._newer) >= self._half:
                    self._older, self._newer = self._newer, {}
                self._newer[piece] = ids
        return found

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; nothing for NULL or empty texts."""
        out = []
        for text in texts:
            if not text:
                out.append(b"")
            elif any(special in text for special in self._whole):
                (encoded,) = self._plain.encode_batch_fast([text], add_special_tokens=False)
                out.append(np.array(encoded.ids, "<u4").tobytes())
            else:
                pieces = _PIECE.findall(text)
                found = list(map(self._newer.get, pieces))
                unknown = _positions(found, None)
                if unknown:
                    learned = self._learn({pieces[k] for k in unknown})
                    for k in unknown:
                        found[k] = learned[pieces[k]]
                out.append(b"".join(found))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker, so that tasks share its memory."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
