"""Token counts by a public tokenizer; the vocabulary's path is a parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache, partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_pandas

VOCABULARY = os.environ.get("TEXTLOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the pattern that splits a text before the merges of these byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: longer texts are counted in parts cut at white space, so that no call holds more
PART = 1 << 20


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str = PATTERN):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, path: str = VOCABULARY) -> int:
    enc, n, at = encoding(path), 0, 0
    while len(text) - at > PART:
        cut = max(text.rfind(" ", at + 1, at + PART), text.rfind("\n", at + 1, at + PART))
        cut = at + PART if cut <= at else cut
        n += len(enc.encode_ordinary(text[at:cut]))
        at = cut
    return n + len(enc.encode_ordinary(text[at:]))


def _count(it, path: str):
    for pdf in it:
        n = [count_tokens(t, path) if isinstance(t, str) else 0 for t in pdf["text"]]
        yield pdf.drop(columns="text").assign(n_tokens=pd.Series(n, index=pdf.index, dtype="int64"))


def token_counts(df: DataFrame, id_col: str, text_col: str, *others: str, path: str = VOCABULARY) -> DataFrame:
    """(id, others..., n_tokens) of every row; null and empty texts have no tokens."""
    rows = df.select(F.col(id_col).alias("id"), *others, F.col(text_col).alias("text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text") + ", n_tokens long"
    return map_pandas(rows, partial(_count, path=path), schema)
