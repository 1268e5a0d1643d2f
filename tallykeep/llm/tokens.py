"""Token ids of texts."""

from __future__ import annotations

import functools
import json
import sys
from array import array
from collections.abc import Iterable, Iterator

import tiktoken
from tokenizers import Tokenizer

#: Fixed value: how byte-level BPE splits a text into words.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """The vocabulary as merge ranks and the added tokens, if the file is a byte-level BPE whose ids are in the order of
    its merges and whose added tokens are taken wherever they stand."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) \
            or spec.get("normalizer") or model.get("type", "BPE") != "BPE" or model.get("dropout"):
        return None
    added = spec.get("added_tokens", [])
    if any(x.get(k) for x in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        return None
    special = {x["content"]: x["id"] for x in added}
    byte_of = _byte_of()
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    order = [model["vocab"][m.replace(" ", "")] for m in merged]
    return (ranks, special) if order == sorted(order) else None


@functools.lru_cache(1)
def ids_of(path: str) -> Ids:
    """One for each Python worker and file."""
    return Ids(path)


class Ids:
    """Ids as the `tokenizers` file gives them, packed as little-endian unsigned 32-bit numbers.

    The vocabulary of a byte-level BPE file is handed to tiktoken as ranks, which gives the same ids in a third of the
    time. Other files are read with `tokenizers`. The name of a special token in a text is that token, as there.
    """

    def __init__(self, path: str) -> None:
        known = _ranks(path)
        if known is None:
            tokenizer = Tokenizer.from_file(path)
            self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ranks, special = known
            encoding = tiktoken.Encoding("own", pat_str=_BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)
            self.encode = functools.partial(encoding.encode, allowed_special="all")

    def packed(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        for text in texts:
            ids = array("I", self.encode(text or ""))
            if sys.byteorder == "big":
                ids.byteswap()
            yield ids.tobytes()
