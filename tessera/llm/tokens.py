"""Byte-level BPE ids of whole texts, encoded chunk by chunk.

A chunk is a run up to the next space, with its leading space. The pre-tokenizer never joins
characters across such a border, except in texts with white space on both sides of a space;
those, and texts that spell a special token, are encoded whole. Ids of chunks are kept in a
dictionary of bounded size, since most words of a corpus are repeats.
"""

from __future__ import annotations

import base64
import json
import re
from functools import cache, cached_property

import numpy as np
import public_tokenizers

#: Chunks kept in a task's dictionary; it is cleared when full.
KEEP = 150_000
#: Longer chunks are not kept, so that the dictionary's bytes are bounded too.
KEEP_CHARS = 64
_CROSSING = re.compile(r"\s \s")


class ChunkIds(dict):
    """Chunk -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, chunk: str) -> bytes:
        found = np.array(self.encode(self.lead + chunk), "<u4").tobytes()
        if len(chunk) <= KEEP_CHARS:
            if len(self) >= KEEP:
                self.clear()
            self[chunk] = found
        return found


class ByteBpe:
    """``ids(text)``: the ids of the whole text, as bytes."""

    def __init__(self, name: str = "byte_bpe_50k"):
        import tiktoken

        self.file = public_tokenizers.path(f"{name}.json")
        with open(self.file, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, added))) if added else re.compile(r"(?!)")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # the same vocabulary; this encoder is faster for one chunk at a time
        fast = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first, self.later = ChunkIds(fast.encode_ordinary, ""), ChunkIds(fast.encode_ordinary, " ")

    @cached_property
    def whole(self):
        """The tokenizer itself; loaded where a text can't be cut into chunks, which is rare."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if _CROSSING.search(text) or self.special.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.later.__getitem__, rest))


@cache
def byte_bpe(name: str = "byte_bpe_50k") -> ByteBpe:
    """One encoder for a worker process."""
    return ByteBpe(name)
