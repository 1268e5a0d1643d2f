"""Plain versions of the operators, one text after the other, to hold results against."""

from __future__ import annotations

import re
from itertools import combinations

import xxhash

PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def phrase_places(text: str | None) -> tuple[int, list[tuple[int, str]]]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    found = []
    for phrase, label in PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(found)


def simhash(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(codes: dict[int, int], most: int = 2) -> dict[int, int]:
    parent = {i: i for i in codes}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(codes, 2):
        if (codes[a] ^ codes[b]).bit_count() <= most:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in codes}


def removed_bytes(texts: list[bytes], length: int = 100) -> list[bytearray]:
    """A 1 for each byte that a string of so many bytes covers which also starts earlier; texts in order."""
    seen: set[bytes] = set()
    marks = []
    for text in texts:
        mark = bytearray(len(text))
        for i in range(len(text) - length + 1):
            part = text[i:i + length]
            if part in seen:
                mark[i:i + length] = b"\1" * length
            seen.add(part)
        marks.append(mark)
    return marks
