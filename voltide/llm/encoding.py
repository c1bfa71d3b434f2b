"""Byte-level BPE inside tasks, from a rank file: ``Encoder`` gives the ids that the tiktoken library gives for a whole text."""

from __future__ import annotations

import base64
import functools
import json
import unicodedata

import numpy as np
import public_tokenizers
import tiktoken


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}


class Encoder:
    def __init__(self, ranks_path: str):
        self.codec = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks_path), special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return np.asarray(self.codec.encode_ordinary(text), dtype="<u4").tobytes()


class TokenizerFile:
    """Ids of a byte-level ``tokenizers`` file; ``ranks_path`` holds the same vocabulary as ranks.

    The two libraries know different Unicode versions. A text with a character that Unicode 3.2 had not assigned goes
    to ``tokenizers``; all others get the same ids from the ranks, several times faster. The file's added tokens (such as
    the end of a text) have ids of their own where their strings occur in a text, as by the library's defaults;
    ``plain`` makes them ordinary text.
    """

    def __init__(self, json_path: str, ranks_path: str, plain: bool = False):
        self.json_path, self.ranks, self.plain = json_path, Encoder(ranks_path), plain
        with open(json_path, encoding="utf-8") as file:
            self.added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
        self.ranks_path = ranks_path

    @functools.cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.json_path)
        tokenizer.encode_special_tokens = self.plain
        return tokenizer

    def token_bytes(self) -> dict[int, bytes]:
        """The bytes of every id."""
        tokens = {id: token for token, id in read_ranks(self.ranks_path).items()}
        return tokens | {id: content.encode() for content, id in self.added.items()}

    def _needs_file(self, text: str) -> bool:
        if not self.plain and any(content in text for content in self.added):
            return True
        if text.isascii():
            return False
        category = unicodedata.ucd_3_2_0.category
        return any(category(c) == "Cn" for c in set(text) if c > "\x7f")

    def _by_file(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self._by_file(text) if self._needs_file(text) else self.ranks.encode(text)


@functools.lru_cache(maxsize=4)
def encoder(ranks_path: str) -> Encoder:
    """One per Python worker, so that the rank file is read once."""
    return Encoder(ranks_path)


@functools.lru_cache(maxsize=2)
def tokenizer_file(json_path: str, ranks_path: str, plain: bool = False) -> TokenizerFile:
    return TokenizerFile(json_path, ranks_path, plain)
