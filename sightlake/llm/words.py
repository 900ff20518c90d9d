"""Words of UTF-8 texts, by byte tables: one pass in C for each text."""

from __future__ import annotations

_LETTERS = bytes(range(0x41, 0x5B))
_WORD_BYTES = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: A-Z to a-z; whatever is in no word to a blank.
_ALNUM = bytes(
    b + 32 if b in _LETTERS else b if b in _WORD_BYTES else 0x20 for b in range(256))
#: Bytes that continue a code point.
CONTINUATION = bytes(range(0x80, 0xC0))


def blank_words(text: bytes) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+``."""
    return text.split()


def alnum_words(text: bytes) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z."""
    return text.translate(_ALNUM).split()


def code_points(text: bytes) -> int:
    return len(text.translate(None, CONTINUATION))
