"""Byte-level BPE vocabularies of the ``tokenizers`` JSON format, read as plain tables."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from typing import Callable

import regex

# The split pattern of the byte-level pre-tokenizer; must match.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_chars() -> dict[str, int]:
    """Vocabulary character -> byte: printable bytes stand for themselves, the
    others take the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def newer_letters() -> str:
    """A character class of the letters and numbers that only the newest Unicode tables
    know.  ``regex`` counts them as such, the tokenizers library may not."""
    known = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, sys.maxunicode + 1)]))
    runs: list[list[int]] = []
    for c in regex.findall(r"[\p{L}\p{N}]", known):
        if unicodedata.category(c) == "Cn":
            if runs and runs[-1][1] == ord(c) - 1:
                runs[-1][1] = ord(c)
            else:
                runs.append([ord(c)] * 2)
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in runs)


def splitter(raw: bytes, newer: str) -> Callable[[str], list[str]]:
    """The pieces of a text as the library's pre-tokenizer makes them: by the split
    pattern, or by the library itself where a text has a character of ``newer``."""
    from tokenizers import Tokenizer

    find, odd = regex.compile(SPLIT).findall, re.compile(f"[{newer}]").search
    library = Tokenizer.from_str(raw.decode()).pre_tokenizer

    def split(text: str) -> list[str]:
        if text.isascii() or not odd(text):
            return find(text)
        return [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]

    return split


def read_vocabulary(raw: bytes) -> tuple[list[int], dict[int, int], dict[int, int], list[str]]:
    """(symbol of each byte, rank of a symbol pair, symbol that a rank makes, added
    strings) of a byte-level BPE file; a pair is ``left << 32 | right``.

    A file with a step that this reader does not follow is refused."""
    spec = json.loads(raw)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = (spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
             and not split.get("add_prefix_space") and model.get("type", "BPE") == "BPE" and not model.get("dropout")
             and not model.get("ignore_merges") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
    odd = [t["content"] for t in spec["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"]]
    if not plain or odd:
        raise ValueError("not a plain byte-level BPE vocabulary")
    ids = model["vocab"]
    chars = byte_chars()
    symbols = [0] * 256
    for char, byte in chars.items():
        symbols[byte] = ids[char]
    ranks, made = {}, {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        ranks[ids[left] << 32 | ids[right]] = rank
        made[rank] = ids[left + right]
    return symbols, ranks, made, [t["content"] for t in spec["added_tokens"]]


def token_bytes(raw: bytes) -> list[bytes]:
    """The bytes of each id of the vocabulary, added tokens in UTF-8."""
    spec = json.loads(raw)
    chars = byte_chars()
    ids = spec["model"]["vocab"]
    out = [b""] * (1 + max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]))
    for token, i in ids.items():
        out[i] = bytes(chars[c] for c in token)
    for t in spec["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out
