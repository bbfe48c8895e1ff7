"""The rules of ``text.py`` on UTF-8 bytes, for functions that get whole texts.

Separators, letters and digits are ASCII, so no character is decoded. The lax
form takes a text that ``text.reduced`` has normalised.
"""

from __future__ import annotations

import re

_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
_BLANK = b" \t\n\r\f"
_LOWER = bytes.maketrans(_LETTERS.upper(), _LETTERS)
_DROP = bytes({*range(256)} - {*_LETTERS, *_LETTERS.upper(), *b"0123456789", *_BLANK})
_STOP = re.compile(rb"\.[ \t\n\x0b\f\r]")
_TOKEN = re.compile(rb"[^ \t\n\r\f]+")


def strict_words(text: bytes) -> list[bytes]:
    """The unigrams of a text without empty ones."""
    return text.translate(_LOWER, _DROP).split()


def lax_words(reduced: bytes) -> list[bytes]:
    return _TOKEN.findall(reduced)


def sentence_list(text: bytes) -> list[bytes]:
    """Pieces between a period followed by white space, without empty ones at the end."""
    if not text:
        return [text]
    pieces = _STOP.split(text)
    while pieces and not pieces[-1]:
        pieces.pop()
    return pieces
