"""Byte-level BPE through the tokenizers library, once per distinct pre-token.

Pre-tokens are encoded independently, so a text's ids are those of its
pre-tokens in order.  The cuts are made for a whole chunk of texts at once
(see ``pretoken``); each distinct pre-token goes through the library once per
worker.  Special tokens in a text are cut out first, as the library does.
"""

from __future__ import annotations

import json
import re

import numpy as np

from starlane.llm.common import worker_state
from starlane.llm.pretoken import PieceCache, Pieces, ids_by_text


class ByteTokens:
    def __init__(self, path: str, special: bool = True):
        """``special=False``: special strings in a text are ordinary text."""
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"] if special else []
        if not special:
            self.library.encode_special_tokens = True
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.cache = PieceCache(self._encode)

    def _encode(self, pieces: list[str]):
        return [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)], []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.cut and any(s in t for t in texts if "<" in t for s in self.special):
            parts = [self.cut.split(t) for t in texts]
            plain = iter(self._plain([p for ps in parts for p in ps[::2]]))
            return [np.concatenate([np.array([self.special[p]], dtype=np.uint32) if i % 2 else next(plain)
                                    for i, p in enumerate(ps)]) for ps in parts]
        return self._plain(texts)

    def _plain(self, texts):
        return ids_by_text(Pieces(texts).byte_level(), self.cache, len(texts))


def worker_tokens(path: str, special: bool = True) -> ByteTokens:
    return worker_state(f"byte-tokens:{path}:{special}", lambda: ByteTokens(path, special))
