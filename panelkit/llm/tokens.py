"""Byte-level BPE ids of texts, from the vocabulary file of a public tokenizer."""

from __future__ import annotations

import json
from functools import lru_cache, partial

import numpy as np


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def encoder(path: str, special: bool = True):
    """A function text -> list of ids for a byte-level BPE file of the tokenizers library.

    The file's merges are its ids in order, so its vocabulary can be handed to a faster encoder as ranks; the ids are
    those of the tokenizers library (tests compare them). As there, a string of the file's added tokens becomes that
    token's id; with ``special`` false it is text, as with the library's ``encode_special_tokens``.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    # byte-level files write each byte as a printable character: printable bytes as themselves, the rest from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    bpe = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return partial(bpe.encode, allowed_special="all") if special else bpe.encode_ordinary


def ids_of(path: str, text: str | None, end: int, special: bool = True) -> np.ndarray:
    """The text's ids (null: none) and the id that ends a document."""
    return np.array([*encoder(path, special)(text or ""), end], np.uint32)
