"""Encoders, one of each per Python worker."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

#: Regular expression that cuts text into words before byte pairs are merged (a fixed value of the vocabulary).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ID = np.dtype("<u4")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a ``.json`` file with truncation and padding off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


@lru_cache(maxsize=4)
def special_strings(path: str) -> tuple[str, ...]:
    """Strings that the tokenizer turns into one id wherever they occur."""
    return tuple(t.content for t in tokenizer(path).get_added_tokens_decoder().values())


@lru_cache(maxsize=4)
def _ranks(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def encode_ids(texts: list[str], path: str, ranks_path: str | None = None) -> list[np.ndarray]:
    """The ids of each text, special strings read as the tokenizer reads them.

    With ``ranks_path`` (the same vocabulary as ranks) texts in Latin-1 without
    special strings are encoded from the ranks, which gives the same ids faster.
    Other texts always take the tokenizer: tables of letters differ between libraries.
    """
    out: list[np.ndarray | None] = [None] * len(texts)
    slow = []
    for i, text in enumerate(texts):
        if ranks_path is not None and not any(s in text for s in special_strings(path)):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                out[i] = np.array(_ranks(ranks_path).encode_ordinary(text), ID)
                continue
        slow.append(i)
    for i, found in zip(slow, tokenizer(path).encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
        out[i] = np.array(found.ids, ID)
    return out


def slices(texts: list[str], most: int = 1 << 20):
    """Index ranges of ``texts`` with about ``most`` characters each, to bound what is encoded at once."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
