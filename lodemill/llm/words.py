"""Words of a text: maximal runs of Unicode letters or digits of the lower-cased text."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

import numpy as np

# \w without the underscore holds exactly the characters of str.isalnum, the categories L and N
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


@cache
def letters_and_digits() -> np.ndarray:
    """A flag for each code point: category L or N."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LN" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
