"""Hashed character n-grams of words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Characters looked at in one go; longer texts are cut where no letter stands, so no n-gram is lost.
PIECE = 1 << 19
_GAP = re.compile(r"[\W\d_]")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case letter of each code point; a blank for what is no letter."""
    table = np.full(0x110000, 0x20, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            table[c] = ord(low) if len(low := x.lower()) == 1 else c
    return table


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Batches of texts, or parts of long ones, with the places of the texts that they belong to."""
    of: list[int] = []
    parts: list[str] = []
    size = 0
    for k, text in enumerate(texts):
        start = 0
        while start < len(text):
            end = start + PIECE
            if end < len(text) and (m := _GAP.search(text, end, end + PIECE)):
                end = m.start()
            of.append(k)
            parts.append(text[start:end])
            size += len(parts[-1])
            start = end
            if size >= PIECE:
                yield of, parts
                of, parts, size = [], [], 0
    if parts:
        yield of, parts


def hashed(parts: list[str], orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: the buckets of all n-grams, and where those of each text begin and end.

    An n-gram lies within a word, the blank before or after it included.
    """
    points = np.frombuffer((" " + "  ".join(parts) + " ").encode("utf-32-le"), np.uint32)
    codes = _letters()[points]
    blank = codes == 0x20
    ends = np.cumsum([len(p) + 2 for p in parts])
    begins = np.concatenate([[0], ends[:-1]])
    rolled, gap = codes.copy(), np.zeros(len(codes), bool)
    for n in range(2, max(orders) + 1):
        # rolled[i]: hash of codes[i-n+1 .. i]; gap[i]: a blank stands inside of them
        rolled[n - 1 :] = rolled[n - 2 : -1] * np.uint32(0x01000193) + codes[n - 1 :]
        if n > 2:
            gap[n - 1 :] = gap[n - 2 : -1] | blank[n - 2 : -1]
        if n in orders:
            good = ~gap
            good[: n - 1] = False
            good[n - 1 :] &= ~(blank[n - 1 :] & blank[: len(blank) - n + 1]) if n == 2 else True
            at = np.flatnonzero(good)
            mixed = (rolled[at] ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0xC2B2AE35)
            yield mixed >> np.uint32(32 - bits), np.searchsorted(at, begins), np.searchsorted(at, ends)
