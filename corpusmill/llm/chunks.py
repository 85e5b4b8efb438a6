"""A bounded cache of what a tokenizer gives for each chunk of text between two spaces."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

CACHE_ENTRIES = 300_000
CACHE_CHARS = 48

_TOKENIZERS: dict = {}


def tokenizer(path: str):
    """The tokenizer of a worker process, loaded once."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        _TOKENIZERS[path] = tok
    return _TOKENIZERS[path]


class ChunkCache:
    """Chunk to value, in two generations of at most `entries` each.

    When the younger is full it becomes the older one, and what is asked for again moves
    back, so that frequent chunks stay whatever passes by. hot is always there.
    """

    def __init__(self, values: Callable[[list[str]], list], hot: Mapping | None = None, entries: int = CACHE_ENTRIES):
        self.values, self.hot, self.entries = values, hot or {}, entries
        self.young, self.old = dict(self.hot), {}

    def known(self, chunks: set[str]) -> Mapping:
        """A table that has all of chunks; new short ones stay in the cache."""
        missing = chunks.difference(self.young)
        if not missing:
            return self.young
        if len(self.young) + len(missing) > self.entries:
            self.old, self.young = self.young, dict(self.hot)
            missing = chunks.difference(self.young)
        again = {c for c in missing if c in self.old}
        self.young.update((c, self.old[c]) for c in again)
        order = list(missing - again)
        new = dict(zip(order, self.values(order), strict=True))
        long = {c: v for c, v in new.items() if len(c) > CACHE_CHARS}
        self.young.update((c, v) for c, v in new.items() if c not in long)
        return {c: long[c] if c in long else self.young[c] for c in chunks} if long else self.young
