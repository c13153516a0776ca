"""Problem 6: passages of evaluation items inside training text.

Every window of ``WINDOW`` words of an item is searched for among the windows of as many words of
the corpus; an item of fewer words is one window of its own size. Windows are embedded by a random
walk (CGK): at each step the current word is written out, and a random bit of (step, word) says
whether to go on to the next word. Windows at a small edit distance come out at a small Hamming
distance, equal windows equal. ``SAMPLED`` of the steps, drawn anew with a new walk for each
repetition, form a bucket key; windows that share a key in any repetition are candidates, verified
by their word edit distance. Equal windows share all keys, so a passage of WINDOW words held in full
is never missed. For edited ones the number of repetitions is taken from the recall asked for
(``TARGET``): pairs of windows at the largest distance allowed are simulated, and repetitions added
until that share of them meets.

Before the walk a window of the corpus must hold enough word pairs of the items: ``e`` edits leave
at least ``size - 1 - 2 e`` of a window's pairs as they were, so this count loses nothing, and few
windows of a large corpus pass it.

The items are the stated query set: they go to every task in blocks of at most ``BLOCK`` windows,
and the corpus is read once per block. No row of the corpus is shuffled.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_pandas, ship
from .common import WordHashes, mix, words

WINDOW, MAX_EDITS = 10, 2
SAMPLED, SEED = 4, 20_101
TARGET, MOST_REPEATS, SIMULATED = 0.95, 64, 4000
BLOCK = 500_000
PAIRS = 1 << 22  #: places of the table of the items' word pairs


def edits_allowed(size: int, most: int = MAX_EDITS) -> int:
    """Edits in proportion to the window: ``most`` in WINDOW words."""
    return most * size // WINDOW


def places(repeat: int, size: int = WINDOW) -> np.ndarray:
    """The sampled steps of a repetition, within the part of the walk that is almost surely taken."""
    return np.sort(np.random.default_rng(SEED + 1000 * size + repeat).choice(2 * size, min(SAMPLED, 2 * size), replace=False))


def keys(w: np.ndarray, start: np.ndarray, size: int, repeat: int) -> np.ndarray:
    """Bucket keys of the windows w[start : start + size]."""
    seed = np.uint64(0x9E3779B97F4A7C15 * (repeat + 1) & 0xFFFFFFFFFFFFFFFF)
    out = np.full(len(start), repeat + 1, np.uint64)
    at, end = start.astype(np.int64).copy(), start.astype(np.int64) + size
    sampled = set(places(repeat, size).tolist())
    last = len(w) - 1
    for j in range(max(sampled) + 1):
        live = at < end  # the walk may have left the window
        sym = np.where(live, w[np.minimum(at, last)], np.uint64(0))
        if j in sampled:
            out = mix(out * np.uint64(0x100000001B3) + sym)
        at += ((mix(sym ^ seed) >> np.uint64(j % 48)) & np.uint64(1)).astype(np.int64) & live
    return out


def _edited(rng, rows: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows with random words replaced, put in or left out, as long as before; the place of the first edit."""
    out, first = [], []
    for r in rows.tolist():
        where = sorted(rng.integers(len(r), size=edits).tolist(), reverse=True)
        first.append(where[-1])
        for at in where:
            new = int(rng.integers(1, 2**62))
            kind = rng.integers(3) if edits > 1 else 0
            if kind == 0:
                r[at] = new
            elif kind == 1:
                r = (r[:at] + [new] + r[at:])[: len(r)]
            else:
                r = r[:at] + r[at + 1 :] + [new]
        out.append(r)
    return np.array(out, np.uint64), np.array(first)


@lru_cache(maxsize=64)
def repeats(size: int, edits: int, target: float = TARGET) -> int:
    """Repetitions after which ``target`` of the windows with so many edits meet their originals, wherever the first edit is."""
    if not edits:
        return 1
    rng = np.random.default_rng(SEED)
    a = rng.integers(1, 2**62, (SIMULATED, size)).astype(np.uint64)
    b, first = _edited(rng, a, edits)
    start, met = np.arange(SIMULATED) * size, np.zeros(SIMULATED, bool)
    for r in range(MOST_REPEATS):
        met |= keys(a.ravel(), start, size, r) == keys(b.ravel(), start, size, r)
        if all(met[first == k].mean() >= target for k in np.unique(first) if (first == k).sum() >= 50):
            return r + 1
    raise ValueError(f"windows of {size} words do not reach recall {target} in {MOST_REPEATS} repetitions")


def _hashed(w: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    out = np.full(len(start), size, np.uint64)
    for j in range(size):
        out = mix(out * np.uint64(0x100000001B3) + w[start + j])
    return out


def _pair_places(w: np.ndarray) -> np.ndarray:
    return (mix(w[:-1] * np.uint64(0x100000001B3) + mix(w[1:])) >> np.uint64(42)).astype(np.int64) if len(w) > 1 else np.zeros(0, np.int64)


class _Words:
    """A batch of word lists as one array of hashes; windows of a size by their start."""

    def __init__(self, hashes: WordHashes, rows: list[list[str]]):
        self.n = np.fromiter(map(len, rows), np.int64, len(rows))
        self.at = np.cumsum(self.n) - self.n
        self.w = np.fromiter((hashes[x] for r in rows for x in r), np.uint64, int(self.n.sum()))
        self.doc = np.repeat(np.arange(len(rows)), self.n)

    def starts(self, size: int) -> np.ndarray:
        if len(self.w) < size:
            return np.zeros(0, np.int64)
        at = np.arange(len(self.w) - size + 1)
        return at[self.doc[at] == self.doc[at + size - 1]]


def edit_distance(a, b, most: int) -> int:
    """Word edit distance, or most + 1 where it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def longest_run(a: list, b: list) -> int:
    """Words of the longest passage that stands in both."""
    best, row = 0, [0] * (len(b) + 1)
    at: dict = {}
    for j, y in enumerate(b, 1):
        at.setdefault(y, []).append(j)
    for x in a:
        new = {j: row[j - 1] + 1 for j in at.get(x, ())}
        row = [0] * (len(b) + 1)
        for j, v in new.items():
            row[j] = v
            best = max(best, v)
    return best


class Block:
    """The items of a block: their windows by size, keys of each repetition, and word pairs."""

    def __init__(self, items: list[tuple[str, list[str]]], max_edits: int, target: float):
        self.names = [n for n, _ in items]
        text = _Words(WordHashes(), [w for _, w in items])
        self.w, self.at, self.n, self.doc = text.w, text.at, text.n, text.doc
        self.pairs = np.zeros(PAIRS, bool)
        own = text.doc[:-1] == text.doc[1:]
        self.pairs[_pair_places(text.w)[own]] = True
        self.sizes = {}
        for size in np.unique(np.minimum(text.n, WINDOW)).tolist():
            start = text.starts(size)
            start = start[(text.n[text.doc[start]] >= WINDOW) if size == WINDOW else (text.n[text.doc[start]] == size)]
            edits = edits_allowed(size, max_edits)
            k = [keys(text.w, start, size, r) for r in range(repeats(size, edits, target))]
            order = [np.argsort(x, kind="stable").astype(np.int32) for x in k]
            self.sizes[size] = edits, start, _hashed(text.w, start, size), [(x[o], o) for x, o in zip(k, order, strict=True)]

    def item(self, j: int) -> list[int]:
        return self.w[self.at[j] : self.at[j] + self.n[j]].tolist()

    def meet(self, text: _Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start in the text, start in the items, edits) of the windows of a size within the edits allowed."""
        edits, start, hashed, lists = self.sizes[size]
        at = text.starts(size)
        if size > 1 and len(at):
            held = np.concatenate(([0], np.cumsum(self.pairs[_pair_places(text.w)])))
            at = at[held[at + size - 1] - held[at] >= size - 1 - 2 * edits]
        none = np.zeros(0, np.int64)
        if not len(at) or not len(start):
            return none, none, none
        found = [np.zeros(0, np.int64)]
        for r, (k, order) in enumerate(lists):
            mine = keys(text.w, at, size, r)
            lo, hi = np.searchsorted(k, mine), np.searchsorted(k, mine, side="right")
            hit = np.flatnonzero(hi > lo)
            many = hi[hit] - lo[hit]
            to = np.arange(int(many.sum())) + np.repeat(lo[hit] - (np.cumsum(many) - many), many)
            found.append(np.unique(np.repeat(hit, many) * len(start) + order[to]))
        pair = np.unique(np.concatenate(found))
        x, y = np.divmod(pair, len(start))
        here = _hashed(text.w, at, size)
        # a pair of equal contents is verified once, however often it stands in the corpus
        _, one, back = np.unique(mix(here[x]) ^ hashed[y], return_index=True, return_inverse=True)
        far = np.zeros(len(one), np.int64)
        for n, p in enumerate(one.tolist()):
            if here[x[p]] != hashed[y[p]]:
                a, b = at[x[p]], start[y[p]]
                far[n] = edit_distance(text.w[a : a + size].tolist(), self.w[b : b + size].tolist(), edits)
        e = far[back]
        ok = e <= edits
        return at[x[ok]], start[y[ok]], e[ok]


def _best(block: Block, text: _Words, size: int):
    """((text, item), edits, run) of the closest window of each pair, equal windows joined to their whole passage."""
    p, q, e = block.meet(text, size)
    if not len(p):
        return
    d, j = text.doc[p], block.doc[q]
    same = e == 0
    if same.any():
        sd, sj, sp, diag = d[same], j[same], p[same], p[same] - q[same]
        o = np.lexsort((sp, diag, sj, sd))
        sd, sj, sp, diag = sd[o], sj[o], sp[o], diag[o]
        new = np.concatenate(([True], (np.diff(sd) != 0) | (np.diff(sj) != 0) | (np.diff(diag) != 0) | (np.diff(sp) != 1)))
        run = np.diff(np.append(np.flatnonzero(new), len(sp))) + size - 1
        for a, b, r in zip(sd[new].tolist(), sj[new].tolist(), run.tolist(), strict=True):
            yield (a, b), 0, r
    known = set(zip(d[same].tolist(), j[same].tolist(), strict=True))
    o = np.argsort(e, kind="stable")
    for a, b, x, far in zip(d[o].tolist(), j[o].tolist(), p[o].tolist(), e[o].tolist(), strict=True):
        if (a, b) not in known:
            known.add((a, b))
            lo, hi = max(text.at[a], x - WINDOW), min(text.at[a] + text.n[a], x + 2 * WINDOW)
            yield (a, b), far, longest_run(text.w[lo:hi].tolist(), block.item(b))


def _find(it, block):
    items, hashes = block.value, WordHashes()
    for pdf in it:
        fields = [c for c in pdf.columns if c != "id"]
        text = _Words(hashes, [words(x) if isinstance(x, str) else [] for c in fields for x in pdf[c]])
        seen: dict[tuple[int, int], tuple[int, int]] = {}
        for size in items.sizes:
            for pair, e, run in _best(items, text, size):
                if pair not in seen or (-e, run) > (-seen[pair][0], seen[pair][1]):
                    seen[pair] = (e, run)
        rows = [(pdf["id"].iat[d % len(pdf)], fields[d // len(pdf)], items.names[j], e, run, min(1.0, run / max(int(items.n[j]), 1))) for (d, j), (e, run) in seen.items()]
        yield pd.DataFrame(rows, columns=["id", "field", "item", "edits", "run", "share"]).astype({"edits": "int32", "run": "int32", "share": "float64"})


def item_blocks(items, max_edits: int = MAX_EDITS, target: float = TARGET):
    """The items' windows and keys, in blocks of at most BLOCK windows."""
    block, size = [], 0
    for name, text in items:
        w = words(text)
        if not w:
            continue
        block.append((name, w))
        size += max(1, len(w) - WINDOW + 1)
        if size >= BLOCK:
            yield Block(block, max_edits, target)
            block, size = [], 0
    if block:
        yield Block(block, max_edits, target)


def item_leaks(corpus: DataFrame, id_col: str, text_cols: list[str], items: DataFrame, item_col: str, item_text: str, max_edits: int = MAX_EDITS, target: float = TARGET) -> DataFrame:
    """(id, field, item, edits, run, share): the corpus texts that hold a passage of an item.

    A passage is a window of WINDOW words within ``max_edits`` word edits, or a whole shorter item
    within the edits in proportion to its size (none below half of WINDOW); distances are between
    windows of the same size, so a word put in counts up to two. ``target`` is the share of the
    passages with the most edits allowed that are found; those without edits are all found.
    ``edits`` is the best window's, ``run`` the words of the longest passage found in common around
    it, ``share`` that over the item's words. One row per text and item. Null and wordless texts and
    items hold nothing; repeated rows come out once; other columns are not read.
    """
    spark = corpus.sparkSession
    ship(spark)
    rows = corpus.select(F.col(id_col).alias("id"), *(F.col(c) for c in text_cols))
    schema = f"id {dict(rows.dtypes)['id']}, field string, item string, edits int, run int, share double"
    out = None
    stated = ((r[0], r[1]) for r in items.select(F.col(item_col).cast("string"), item_text).where(F.col(item_text).isNotNull()).toLocalIterator())
    for block in item_blocks(stated, max_edits, target):
        got = map_pandas(rows, partial(_find, block=spark.sparkContext.broadcast(block)), schema)
        out = got if out is None else out.unionByName(got)
    if out is None:
        return spark.createDataFrame([], schema)
    best = F.max(F.struct((-F.col("edits")).alias("e"), "run", "share"))
    return out.groupBy("id", "field", "item").agg(best.alias("b")).select("id", "field", "item", (-F.col("b.e")).cast("int").alias("edits"), "b.run", "b.share")
