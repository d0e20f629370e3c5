"""Ids of byte-level vocabularies by a compiled encoder, one piece at a time and remembered."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import tiktoken

from .bpe import Vocabulary


class ByteVocabulary(Vocabulary):
    """A vocabulary whose unknown pieces are encoded by tiktoken; for files without a word-end suffix."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        if self.suffix or self.lowers:
            raise ValueError(f"{path} is not byte-level")
        self.encoder = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=self.whole, special_tokens={})

    def learn(self, words: list[str]) -> None:
        encoded = self.encoder.encode_ordinary
        for word in words:
            self.words[word] = np.array(encoded(word), "<u4").tobytes()


@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> ByteVocabulary:
    return ByteVocabulary(path)
