"""Pre-tokens of the byte-level pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
as array operations over whole texts (no per-character Python)."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np

LETTER, NUMBER, OTHER, WHITE, SPACE, QUOTE = range(6)
# Unicode White_Space, and the contractions of the pattern.
WHITE_SPACE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


@lru_cache(maxsize=4)
def class_table(tokenizer_file: str) -> np.ndarray:
    """Class of every code point (QUOTE is an OTHER that may open a contraction, SPACE a WHITE that may join a word).

    Code points that this Python's Unicode tables don't know are classed by asking
    the tokenizer's own pre-tokenizer, a block at a time.
    """
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    unknown = []
    for c in range(0x110000):
        k = unicodedata.category(chr(c))
        if k[0] == "L":
            table[c] = LETTER
        elif k[0] == "N":
            table[c] = NUMBER
        elif k == "Cn":
            unknown.append(c)
    table[WHITE_SPACE] = WHITE
    table[0x20], table[0x27] = SPACE, QUOTE
    pre = load(tokenizer_file).pre_tokenizer
    alone = lambda s: len(pre.pre_tokenize_str(s)) == 1
    for i in range(0, len(unknown), 256):
        block = unknown[i : i + 256]
        if not alone("." + "".join(map(chr, block))):
            for c in block:
                table[c] = LETTER if alone("x" + chr(c)) else NUMBER if alone("1" + chr(c)) else OTHER
    return table


@lru_cache(maxsize=4)
def load(tokenizer_file: str):
    """The library's tokenizer (one per worker process; its own threads off)."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file)


def byte_letters() -> dict[str, int]:
    """The byte alphabet of byte-level files: printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=4)
def rank_merger(tokenizer_file: str):
    """Ids of one pre-token's bytes.  Checks that the file's ids rise with its merges, which is what makes ids ranks."""
    import tiktoken

    with open(tokenizer_file, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = byte_letters()
    spell = lambda s: bytes(letters[ch] for ch in s)
    ranks = {spell(k): v for k, v in model["vocab"].items() if all(ch in letters for ch in k)}
    merged = [ranks[b"".join(map(spell, m if isinstance(m, list) else m.split(" ")))] for m in model["merges"]]
    if any(b <= a for a, b in zip(merged, merged[1:])):
        raise ValueError("the ids of this tokenizer do not rise with its merges")
    return tiktoken.Encoding("merges", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def starts(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Positions where a pre-token of the text (code points) starts."""
    n = len(codes)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    cls = table[codes]
    kind = np.minimum(cls, WHITE)  # SPACE -> WHITE
    kind[cls == QUOTE] = OTHER
    white = kind == WHITE
    first = np.ones(n, dtype=bool)
    change = kind[1:] != kind[:-1]
    # A run starts a token, unless a space before it joins it.
    first[1:] = change & ~((cls[:-1] == SPACE) & ~white[1:])
    # The last of several white-space characters before a word is left to the word (or stands alone).
    first[:-1] |= white[:-1] & ~white[1:]
    quotes = np.flatnonzero(first[:-1] & (cls[:-1] == QUOTE) & (cls[1:] == LETTER))
    for q in quotes:
        tail = "".join(map(chr, codes[q + 1 : q + 3]))
        size = next((len(c) for c in CONTRACTIONS if tail.startswith(c)), 0)
        if size:
            first[q + 1 : q + 1 + size] = False
            if q + 1 + size < n:
                first[q + 1 + size] = True
    return np.flatnonzero(first)


def split(text: str, table: np.ndarray) -> list[str]:
    """The pre-tokens of a text without special tokens."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at = starts(codes, table).tolist()
    return [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]
