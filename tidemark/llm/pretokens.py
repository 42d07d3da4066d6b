"""Pre-token patterns, with a fast form for texts in Latin script.

The letters of Latin script lie in a few ranges, so for texts that hold nothing but those, ASCII and blanks a
pattern with ranges finds the same pre-tokens as one with Unicode classes, in half the time.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

#: ASCII letters and the Latin letters up to U+024F, all of which are letters by Unicode's classes.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_only_latin = re.compile(rf"[\t\n\r -~{_LETTERS}]*").fullmatch


def finder(pattern: str) -> Callable[[str], list[str]]:
    r"""All matches of a pattern, in which \p{L} and \p{N} stand for letters and digits, inside classes or alone."""
    ranges = re.sub(r"\[([^]]*)\]", lambda m: m[0].replace(r"\p{L}", _LETTERS).replace(r"\p{N}", "0-9"), pattern)
    ranges = ranges.replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", "[0-9]")
    find_any, find_latin = regex.compile(pattern).findall, re.compile(ranges).findall
    return lambda text: find_latin(text) if _only_latin(text) else find_any(text)


def byte_letters() -> list[str]:
    """For each byte the character that stands for it in byte-level vocabularies: itself if it is a visible Latin-1 character, else the next unused code point from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    out, spare = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in visible else spare))
        spare += byte not in visible
    return out
