"""Ids of short texts by a byte-level vocabulary, through whichever library reads them safely and fast."""

from __future__ import annotations

import base64
import os
import re

#: Longer texts go through `tokenizers` alone: the other library's pattern engine fails on very long runs.
RANKED_CHARS = 4096
# The vocabulary's special token and its pattern of words.
SPECIAL = "<|endoftext|>"
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = re.compile(r"[\t-\r\x20-~À-ÿ]*")


def ranked_encoding(path: str):
    """The byte-level vocabulary from a file of ranks; no token is special."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranked", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Encodes texts; where the vocabulary is also given as ranks, short texts of plain characters take that way.

    With `special`, the special token's string in a text is that token; without, it is a text like any other.
    """

    def __init__(self, path: str, ranks: str | None = None, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special
        self._ranked = ranked_encoding(ranks) if ranks else None
        self._special = special

    def __call__(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = [None] * len(texts)
        if self._ranked:
            for i, text in enumerate(texts):
                if len(text) <= RANKED_CHARS and _PLAIN.fullmatch(text) and not (self._special and SPECIAL in text):
                    out[i] = self._ranked.encode_ordinary(text)
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, encoding in zip(rest, self._tokenizer.encode_batch([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = encoding.ids
        return out

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id."""
        letters = _byte_letters()
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        return [bytes(letters[c] for c in self._tokenizer.id_to_token(i) or "") for i in range(size)]


def _byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(own))
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}
