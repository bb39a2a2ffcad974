"""Normal forms of text that is written or laid out in different ways."""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np

# fixed values: letters of other scripts that look like Latin ones
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "А": "a", "В": "b", "С": "c", "Е": "e", "Н": "h", "І": "i", "Ј": "j", "К": "k", "М": "m", "О": "o", "Р": "p", "Ѕ": "s", "Т": "t", "У": "y", "Х": "x",
}
_TABLE = str.maketrans(LOOKALIKES) | {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0xFEFF)}
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
_TAG = re.compile(r"</?[a-zA-Z][^<>\n]{0,80}>")
_HYPHEN = re.compile(r"([^\W\d_])[-‐]\r?\n[-+ >*#/;%|]{0,8}[ \t]*([^\W\d_])")
_WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def normal_form(text: str) -> str:
    """Escapes, entities, tags, look-alike letters, ligatures and hidden characters resolved; case as it is.

    ASCII text without escapes, entities and tags, the usual case, takes the short way.
    """
    if "\\" in text:
        text = _ESCAPE.sub(lambda m: chr(int(m[1], 16)), text)
        text = text.replace("\\n", " ").replace("\\t", " ").replace("\\r", " ")
    if "&" in text or "<" in text:
        text = html.unescape(_TAG.sub(" ", text))
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_TABLE)
        if not text.isascii():
            text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    if "-\n" in text or "-\r\n" in text or "‐\n" in text:
        text = _HYPHEN.sub(r"\1\2", text)
    return text


def words(text: str) -> list[str]:
    """The words of the normal form: runs of letters and digits, underscores and signs apart."""
    return _WORD.findall(normal_form(text).lower())


_rng = np.random.default_rng(7)
_POWER = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.zeros(256, np.uint8)  # 0: no part of a word
for _c in range(256):
    if chr(_c).isascii() and chr(_c).isalnum() or _c >= 128:
        _LOWER[_c] = ord(chr(_c).lower()) if _c < 128 else _c
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True


def hashed_words(texts: list[str], parts: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of all texts, in order, and the index of each word's text.

    The words are those of ``words``; with ``parts``, letters only, and camelCase is cut into its parts.
    Texts are brought to normal form one by one, everything after that is one array operation per batch.
    """
    data = [(normal_form(t) + "\n").encode("utf-8", "replace") for t in texts]
    ends = np.cumsum([len(b) for b in data])
    raw = np.frombuffer(b"".join(data), np.uint8)
    low = _LOWER[raw]
    inside = _LETTER[raw] if parts else low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    if parts:
        up = _UPPER[raw]
        first[1:] |= up[1:] & inside[:-1] & ~up[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(inside)
    new = first[at]
    heads = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
    h = np.add.reduceat(low[at].astype(np.uint64) * _POWER[np.minimum(place, 63)], heads)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h, np.searchsorted(ends, starts, side="right")
