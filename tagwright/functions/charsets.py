"""Character classes, spelled out so that Java and RE2 regexes agree."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

#: white space as ``str.split()`` sees it (Java's ``\s`` lacks U+001C-1F and NBSP)
SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
#: capitals, with the letter-like ones that are not of class Lu
UPPER = r"\p{Lu}\x{2160}-\x{216f}\x{24b6}-\x{24cf}\x{1f130}-\x{1f149}\x{1f150}-\x{1f169}\x{1f170}-\x{1f189}"
#: letters, numbers and the underscore
WORD = r"\p{L}\p{N}_"


def _ranges(points: list[int]) -> str:
    out, start, prev = [], None, None
    for p in [*points, None]:
        if start is not None and p != prev + 1:
            out.append(f"\\x{{{start:x}}}-\\x{{{prev:x}}}" if prev > start else f"\\x{{{start:x}}}")
            start = None
        if start is None:
            start = p
        prev = p
    return "".join(out)


@lru_cache(maxsize=None)
def digit_class() -> str:
    """Decimal digits plus superscripts, circled digits and the like (``str.isdigit``)."""
    extra = [
        i for i in range(0x80, sys.maxunicode + 1)
        if unicodedata.category(chr(i)) == "No" and chr(i).isdigit()
    ]
    return r"\p{Nd}" + _ranges(extra)


@lru_cache(maxsize=None)
def decimal_digits() -> tuple[str, str]:
    """All non-ASCII decimal digits and, position by position, their ASCII forms."""
    chars = [
        chr(i) for i in range(0x80, sys.maxunicode + 1)
        if unicodedata.category(chr(i)) == "Nd"
    ]
    return "".join(chars), "".join(str(unicodedata.decimal(c)) for c in chars)
