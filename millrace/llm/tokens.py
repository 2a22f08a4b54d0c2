"""Byte-level BPE token ids with public vocabulary files; no training here.

The driver reads the vocabulary file and its bytes travel with the tasks, so executors need no copy. A Python worker
keeps the coder between tasks.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types

import numpy as np

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: How the vocabulary's texts were cut before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Coder:
    def __init__(self, vocabulary: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.end = max(ranks.values()) + 1
        self.kind = np.dtype("<u2" if self.end < 1 << 16 else "<u4")
        self.lengths = np.zeros(self.end + 1, np.int64)
        for piece, rank in ranks.items():
            self.lengths[rank] = len(piece)
        self._coding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _direct(self, text: str) -> bytes:
        return np.array(self._coding.encode_ordinary(text), self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of the whole text, packed. Nothing is kept: looking words up costs more than merging them again."""
        return self._direct(text)


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def coder(vocabulary: bytes) -> Coder:
    """This worker's coder for a vocabulary."""
    held = sys.modules.setdefault("_held_coders", types.ModuleType("_held_coders")).__dict__
    key = hashlib.md5(vocabulary).hexdigest()
    if key not in held:
        held[key] = Coder(vocabulary)
    return held[key]
