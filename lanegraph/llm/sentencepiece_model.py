"""SentencePiece model files read field by field (protobuf wire format)."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

# Piece types and model types of the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class SentencePieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    whitespace_as_suffix: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @property
    def unk_id(self) -> int:
        return self.types.index(UNKNOWN)


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = buf[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def fields(buf: bytes):
    """(field number, value) of a message; bytes for nested ones."""
    at = 0
    while at < len(buf):
        tag, at = _varint(buf, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(buf, at)
        elif kind == 1:
            value, at = buf[at:at + 8], at + 8
        elif kind == 2:
            n, at = _varint(buf, at)
            value, at = buf[at:at + n], at + n
        elif kind == 5:
            value, at = struct.unpack("<f", buf[at:at + 4])[0], at + 4
        else:
            raise ValueError(f"wire type {kind} is not in use")
        yield tag >> 3, value


def parse(buf: bytes) -> SentencePieceModel:
    """Read a serialised model; fields that encoding doesn't need are skipped."""
    m = SentencePieceModel()
    for number, value in fields(buf):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for k, v in fields(value):
                if k == 1:
                    piece = v.decode()
                elif k == 2:
                    score = v
                elif k == 3:
                    kind = v
            m.pieces.append(piece)
            m.scores.append(score)
            m.types.append(kind)
        elif number == 2:
            for k, v in fields(value):
                if k == 3:
                    m.model_type = v
                elif k == 24:
                    m.whitespace_as_suffix = bool(v)
                elif k == 35:
                    m.byte_fallback = bool(v)
        elif number == 3:
            for k, v in fields(value):
                if k == 2:
                    m.charsmap = v
                elif k == 3:
                    m.add_dummy_prefix = bool(v)
                elif k == 4:
                    m.remove_extra_whitespaces = bool(v)
                elif k == 5:
                    m.escape_whitespaces = bool(v)
    return m
