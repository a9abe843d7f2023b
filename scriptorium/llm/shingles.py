"""Word shingles as 64-bit numbers, for the operators on near duplicates and passages.

Words are the runs of letters, digits and underscores of the lower-case text. A shingle is five words in a row; a text
of one to four words has one shingle of all its words, and a text without words has none.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np

SHINGLE = 5
WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Words whose numbers a worker remembers at once.
REMEMBERED = 200_000


class WordHashes(dict):
    """A 64-bit number for each word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return found


_hashes = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    words = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads numbers evenly over 64 bits; different numbers stay different."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of ``n`` words, in order."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        h = mixed(h * _FACTOR) + words[i : len(words) - n + 1 + i]
    return mixed(h * _FACTOR + np.uint64(n))


def shingle_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a whole text, sorted."""
    words = word_hashes(text)
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(grams(words, min(n, len(words))))


def shingles_sql(table: str, key: str, n: int = SHINGLE) -> str:
    """DuckDB: the distinct shingles g of each row of a table."""
    return f"""SELECT DISTINCT {key}, array_to_string(ws[i:i + {n - 1}], ' ') AS g FROM (
      SELECT {key}, ws, unnest(CASE WHEN len(ws) >= {n} THEN range(1, len(ws) - {n - 2}) WHEN len(ws) > 0 THEN [1] ELSE [] END) AS i
      FROM (SELECT {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM {table}))"""
