"""Texts cut at spaces across which no token of a tokenizer reaches, and tokenizers from their files.

A space that follows a visible character begins a new word for byte-level pre-tokenization and for
pieces that hold the space mark only at their front. The chunks between such spaces have the same
tokens by themselves as in the text, so a task looks each distinct chunk up once.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from typing import Any

SPACE = "\u2581"
# Controls and all white space that any version of Unicode names; after these no cut is made.
BLANK = "\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
BLANK_BEFORE = re.compile(f"[{BLANK}] ")
CUT = re.compile(f"(?<=[^{BLANK}])(?= )")
# What a task remembers of distinct chunks before it starts anew; bounds memory, not results.
KEPT_CHUNKS, KEPT_CHARACTERS = 400_000, 8_000_000
ENCODED_AT_ONCE = 4096


def cut(text: str) -> list[str]:
    """The chunks of a text in order; each but the first begins with a space. Empty text: none."""
    if not text:
        return []
    if text[0] == " " or BLANK_BEFORE.search(text):
        return CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + part for part in rest]]


class Numbered:
    """Numbers of the distinct chunks met since the last clearing."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.characters = 0

    def full(self) -> bool:
        return len(self.number) > KEPT_CHUNKS or self.characters > KEPT_CHARACTERS

    def clear(self) -> None:
        self.number.clear()
        self.characters = 0

    def add(self, cut_texts: list[list[str]]) -> list[str]:
        """The chunks not met before, numbered in this order from here on."""
        known = self.number
        new = list(dict.fromkeys(c for chunks in cut_texts for c in chunks if c not in known))
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        self.characters += sum(map(len, new))
        return new


def json_tokenizer(content: bytes, plain_specials: bool = False) -> Any:
    """A tokenizer of the `tokenizers` library, without truncation and padding.

    `plain_specials` reads the strings of special tokens inside texts as plain text. The library's cache of
    words is off: it outlives its tokenizer, so a worker would keep one for each task it has run.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = plain_specials
    if hasattr(tokenizer.model, "_resize_cache"):
        tokenizer.model._resize_cache(0)
    return tokenizer


def ids_of(tokenizer: Any, texts: list[str]) -> Iterator[list[int]]:
    """Ids of each text without added tokens; the library's results, far larger than the ids, are let go in between."""
    for at in range(0, len(texts), ENCODED_AT_ONCE):
        for encoded in tokenizer.encode_batch(texts[at: at + ENCODED_AT_ONCE], add_special_tokens=False):
            yield encoded.ids


def json_cuts_at_spaces(content: bytes) -> bool:
    """Whether the tokens of chunks are those of the text: plain byte-level words, nothing normalised."""
    spec = json.loads(content)
    before, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (
        spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space", True) and model.get("type") == "BPE" and not model.get("dropout")
        and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix")
    )


def pieces_cut_at_spaces(processor: Any) -> bool:
    """Whether no piece of a sentencepiece model holds the space mark behind another character."""
    return not any(SPACE in processor.id_to_piece(i).lstrip(SPACE) for i in range(processor.get_piece_size()))
