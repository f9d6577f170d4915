"""A SentencePiece model's file: its fields, its normaliser and safe places to cut a text."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SPACE = "▁"  # stands for a space in normalised text
SPACE_BYTES = SPACE.encode()

# Field numbers of the model file.
PIECE, NORMALIZER = 1, 3
PIECE_TEXT, PIECE_TYPE = 1, 3
NAME, CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 1, 2, 3, 4, 5
UNKNOWN, BYTE_PIECE = 2, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes, int, int]]:
    """Number, value, first and past-the-last byte of every field of a message."""
    at = 0
    while at < len(data):
        start = at
        key, at = _varint(data, at)
        kind = key & 7
        value: int | bytes
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        yield key >> 3, value, start, at


def _written(number: int, value: int | bytes) -> bytes:
    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes(out + bytearray([n]))

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


class CharacterMap:
    """The compiled map of a normaliser: a double-array trie over UTF-8 bytes, then texts."""

    def __init__(self, blob: bytes) -> None:
        self.units = np.zeros(0, dtype=np.uint32)
        self.texts = b""
        if blob:
            size = struct.unpack("<I", blob[:4])[0]
            self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4")
            self.texts = blob[4 + size :]
        self.unit_list = self.units.tolist()

    def longest_prefix(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes matched from ``at`` on and what replaces them, for the longest match."""
        units = self.unit_list
        found = None
        node = self._offset(units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        start = found[1]
        return found[0], self.texts[start : self.texts.index(b"\0", start)]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


@dataclass(frozen=True)
class Normalizer:
    """Normalises as the model says and keeps, for each byte, where it came from."""

    charsmap: CharacterMap
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source offset of each; one more closes the last."""
        data = text.encode()
        if not self.charsmap.unit_list and not self.remove_extra:
            return self._spaces_only(data)
        parts: list[tuple[bytes, int]] = []
        at = 0
        while at < len(data):
            width, new = self._step(data, at)
            parts.append((new, at))
            at += width
        return self._joined(parts, len(data))

    def _step(self, data: bytes, at: int) -> tuple[int, bytes]:
        if self.charsmap.unit_list and (found := self.charsmap.longest_prefix(data, at)):
            return found
        lead = data[at]
        width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return width, data[at : at + width]

    def _joined(self, parts: list[tuple[bytes, int]], size: int) -> tuple[bytes, np.ndarray]:
        space = SPACE_BYTES if self.escape else b" "
        out, source = bytearray(), []

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        start = 0
        if self.remove_extra:  # leading spaces go
            while start < len(parts) and parts[start][0] in (b" ", b""):
                start += 1
        if start == len(parts):
            return b"", np.array([size])
        if self.dummy_prefix:
            put(space, parts[start][1])
        after_space = self.remove_extra
        for piece, at in parts[start:]:
            if self.remove_extra and after_space:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", space), at)
                after_space = piece.endswith(b" ")
        end = size
        if self.remove_extra:  # trailing spaces go
            while out.endswith(space):
                end = source[-len(space)]
                del out[-len(space) :], source[-len(space) :]
        return bytes(out), np.array([*source, end])

    def _spaces_only(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Without a map only spaces change, so the alignment is a few vector operations."""
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        space = SPACE_BYTES if self.escape else b" "
        raw = np.frombuffer(data, dtype=np.uint8)
        width = np.where(raw == 0x20, len(space), 1)
        source = np.repeat(np.arange(len(data)), width)
        lead = len(space) if self.dummy_prefix else 0
        source = np.concatenate([np.zeros(lead, dtype=np.int64), source, [len(data)]])
        return space[:lead] + data.replace(b" ", space), source


class PieceModel:
    """What the operators need of a model file. Build it inside the task that uses it."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        pieces: list[tuple[str, int]] = []
        settings: dict[int, int | bytes] = {}
        self._normalizer_at = (len(data), len(data))
        for number, value, start, end in _fields(data):
            if number == PIECE:
                own = {n: v for n, v, _, _ in _fields(value)}
                pieces.append((own[PIECE_TEXT].decode(), own.get(PIECE_TYPE, 1)))
            elif number == NORMALIZER:
                settings = {n: v for n, v, _, _ in _fields(value)}
                self._normalizer_at = (start, end)
        self.normalizer = Normalizer(
            CharacterMap(settings.get(CHARSMAP, b"")),
            bool(settings.get(DUMMY_PREFIX, 1)),
            bool(settings.get(REMOVE_EXTRA, 1)),
            bool(settings.get(ESCAPE, 1)),
        )
        self.byte_fallback = any(kind == BYTE_PIECE for _, kind in pieces)
        self.widths = np.array(
            [1 if kind == BYTE_PIECE else len(text.encode()) for text, kind in pieces]
        )
        # A cut before a space is safe if no piece goes on from another character into one.
        self.cuts_at_spaces = (
            not self.normalizer.charsmap.unit_list
            and self.normalizer.dummy_prefix
            and not self.normalizer.remove_extra
            and not any(re.search(f"[^{SPACE}]{SPACE}", text) for text, _ in pieces)
        )

    def processor(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.data)

    def plain_processor(self):
        """The model without normalisation, for text that is normalised already."""
        from sentencepiece import SentencePieceProcessor

        plain = b"".join(
            [_written(NAME, b"identity"), *(_written(n, 0) for n in (DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE))]
        )
        start, end = self._normalizer_at
        data = self.data[:start] + _written(NORMALIZER, plain) + self.data[end:]
        return SentencePieceProcessor(model_proto=data)


_SAFE = re.compile(r"(?<=[^ ▁]) (?=[^ ▁])")


def safe_parts(text: str, limit: int) -> list[str]:
    """The text in parts whose token counts add up to that of the whole.

    A part of more than ``limit`` characters ends at the next single space between two
    other characters; the space itself goes, as the encoder puts one before every part.
    A stretch without such a place stays whole.
    """
    parts, start = [], 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if not cut:
            break
        parts.append(text[start : cut.start()])
        start = cut.end()
    parts.append(text[start:])
    return parts
