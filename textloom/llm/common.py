"""Word splitting and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ..session import map_pandas

#: Zero-width and invisible joining characters, soft hyphen, byte-order mark.
INVISIBLE = "­​‌‍‎‏⁠⁡⁢⁣⁤﻿᠎"
_DROP = {ord(c): None for c in INVISIBLE}
_WORD = re.compile(r"[^\W_]+")
_ASCII_WORD = re.compile(r"[a-z0-9]+")


def fold(text: str) -> str:
    """NFKC, invisible characters removed, lower case."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFKC", text).translate(_DROP).lower()


def words(text: str | None) -> list[str]:
    """The longest runs of letters and digits of the folded text; none for null or blank."""
    if not text:
        return []
    if text.isascii():
        return _ASCII_WORD.findall(text.lower())
    return _WORD.findall(fold(text))


class WordHashes(dict):
    """word -> 64-bit hash, remembered for the words seen so far (forgotten past ``bound``)."""

    def __init__(self, bound: int = 1_000_000):
        self.bound = bound

    def __missing__(self, w: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence, bit-parallel over the words of ``a``."""
    at: dict = {}
    for j, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & at.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


_BLOCK = 1 << 16
_BLOCKS = "block int, salt int, counts binary"


def table_blocks(table: np.ndarray):
    """A task's table of counts as compressed blocks; blocks of zeros are left out."""
    yield from _as_blocks({k: table[k * _BLOCK : (k + 1) * _BLOCK] for k in range(-(-len(table) // _BLOCK))})


def _as_blocks(blocks: dict[int, np.ndarray]):
    z = zstandard.ZstdCompressor(level=1)
    keep = {k: v for k, v in blocks.items() if v.any()}
    yield pd.DataFrame({"block": np.fromiter(keep, np.int32, len(keep)), "salt": np.full(len(keep), TaskContext.get().partitionId() % 64, np.int32), "counts": [z.compress(v.astype(np.uint64).tobytes()) for v in keep.values()]})


def _add(it):
    total: dict[int, np.ndarray] = {}
    for pdf in it:
        for k, c in zip(pdf["block"], pdf["counts"], strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(zstandard.decompress(c), np.uint64)
    if total:
        yield from _as_blocks(total)


def summed_tables(rows: DataFrame, counted, size: int) -> np.ndarray:
    """The sum of the tables of ``size`` counts that ``counted`` gives, as ``table_blocks``, for each task's rows.

    Blocks are added up in two steps, so no task and not the driver sees more than one table of each of 64 groups of tasks.
    """
    parts = map_pandas(rows, counted, _BLOCKS)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for keys in (("block", "salt"), ("block",)):
        parts = map_pandas(parts.repartition(min(n, 64), *keys), _add, _BLOCKS)
    table = np.zeros(-(-size // _BLOCK) * _BLOCK, np.uint64)
    for r in parts.collect():  # at most size / _BLOCK rows of at most 8 * _BLOCK bytes
        table[r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = np.frombuffer(zstandard.decompress(r["counts"]), np.uint64)
    return table[:size].astype(np.int64)
