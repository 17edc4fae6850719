"""Sizes of texts in tokens of a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame

#: The vocabulary file (ranks of a byte-level BPE) and its splitting pattern, a fixed value of that family of tokenizers.
VOCABULARY = os.environ.get("RAQIM_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = 100_000
_SPLIT = regex.compile(PATTERN)


@lru_cache(maxsize=2)
def encoding(path: str):
    """The tokenizer, once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str | None, path: str = VOCABULARY) -> int:
    """Tokens of a text; 0 for null.  Very long texts are counted in pieces that end where the splitting pattern ends one."""
    if not text:
        return 0
    enc = encoding(path)
    if len(text) <= PIECE:
        return len(enc.encode_ordinary(text))
    total, start = 0, 0
    for m in _SPLIT.finditer(text):
        if m.end() - start >= PIECE or m.end() == len(text):
            total += len(enc.encode_ordinary(text[start : m.end()]))
            start = m.end()
    return total


def sizes(df: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The columns of ``keep`` with ``tokens``, the size of the text."""
    fields = [df.schema[c] for c in keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[keep].copy()
            out["tokens"] = pd.Series([count(t, path) if isinstance(t, str) else 0 for t in pdf[text]], dtype="int64", index=pdf.index)
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", tokens long"
    return df.select(*keep, *([text] if text not in keep else [])).mapInPandas(run, schema)
