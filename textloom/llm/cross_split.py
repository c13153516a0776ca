"""Problem 1: the same or nearly the same record on both sides of a split.

A weighted cosine join between the evaluation side and the training side over inverted lists.

*Vectors.* A text is the vector of its numbered words ("the" the first time, "the" the second
time), whatever its length: words that stand in both texts in order are shared numbered words, so
the threshold of the definition is one of the vectors and nothing is lost. (Shingles are not used:
changes at every third word leave none of them.) A term weighs ``ln(1 + N / f)`` by its frequency,
counted over all rows in a table of fixed size.

*Bound.* A partner shares at least ``t`` of the words, so at most the heaviest ``n - ceil(t n)``
terms of a text are not shared: what it shares has at least the rest of its squared norm,
``T = 1 - heaviest / norm^2``. A pair's cosine is thus at least ``sqrt(T_x T_y)``, a threshold of its
own for every pair, below which no pair of the definition lies whatever the weights are.

*Pruning.* Terms are ordered by falling weight. Once what is left of a vector has less than ``T`` of
its squared norm, no partner can lie in that rest alone, so one of the terms before it is shared; with
the bound above these are the heaviest ``n - ceil(t n) + 1`` terms, and only they are put into the
lists. Along a list a pair is dropped when the lengths differ too much, when what is left of either
vector cannot hold the words still missing, or when a bound of the shared words from 48 packed word
counts is too small. Where a list is long on both sides, that bound is first taken for all its pairs
as a matrix product of the counts in unary. The pairs that remain are scored by their exact dot
product; those that reach their threshold are decided by the longest common subsequence.

*Skew.* Exact copies in a task enter the lists once, copies from several tasks are united in the
list. A list that is longer than ``LIST`` is cut into a grid of list pieces. The frequency table
decides on that and on the order only; it never drops a term.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, map_pandas
from .common import WordHashes, lcs_length, mix, summed_tables, table_blocks, words

SAME = 0.8  #: share of the longer text's words that must stand in the other, in order
BUCKETS = 48
UNARY, TILE, DENSE = 4, 256, 4_000  #: levels of a count, rows of a tile, pairs of a list from which it is a matrix
TABLE = 1 << 20  #: places of the frequency table
LIST = 1 << 16
FLUSH = 500_000
CHUNK = 1 << 20
BROADCAST_ROWS = 200_000  #: 24 bytes each

EVAL, TRAIN = 1, 2


def split_side(split: Column) -> Column:
    """1 for the evaluation splits, 2 for the training splits, else null."""
    s = F.lower(F.regexp_replace(split, r"(?U)^\s+|\s+$", ""))
    return F.when(s.isin("validation", "test"), EVAL).when(s.isin("train", "safety_train"), TRAIN)


class _Texts:
    """The words of a batch of texts as one array of hashes with offsets."""

    def __init__(self, hashes: WordHashes, rows: list[list[str]]):
        self.n = np.fromiter(map(len, rows), np.int64, len(rows))
        self.at = np.concatenate(([0], np.cumsum(self.n)))
        self.w = np.fromiter((hashes[x] for r in rows for x in r), np.uint64, int(self.at[-1]))
        self.doc = np.repeat(np.arange(len(rows)), self.n)

    def terms(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, term) of all numbered words, by text."""
        d, t = self.doc, self.w
        if not len(d):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        order = np.lexsort((t, d))
        d, t = d[order], t[order]
        new = np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])))
        nth = np.arange(len(d)) - np.maximum.accumulate(np.where(new, np.arange(len(d)), 0))
        return d, mix(t + np.uint64(0x51ED27) * (nth.astype(np.uint64) + np.uint64(1)))

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the words in BUCKETS hash buckets, rounded up to 15 steps of ``q``: nibbles and q."""
        b = (mix(self.w) >> np.uint64(40)) % np.uint64(BUCKETS)
        c = np.bincount(self.doc * BUCKETS + b.astype(np.int64), minlength=len(self.n) * BUCKETS).reshape(-1, BUCKETS)
        q = np.maximum(1, -(-c.max(axis=1, initial=0) // 15))
        c = -(-c // q[:, None])
        return (c[:, 0::2] | c[:, 1::2] << 4).astype(np.uint8), q.astype(np.uint32)


def _unpacked(nibbles: np.ndarray, q: np.ndarray) -> np.ndarray:
    c = np.empty((len(nibbles), BUCKETS), np.uint8)
    c[:, 0::2] = nibbles & 15
    c[:, 1::2] = nibbles >> 4
    return c.astype(np.uint32) * q[:, None] if (q > 1).any() else c


def _batch_words(texts) -> list[list[str]]:
    return [words(x) if isinstance(x, str) else [] for x in texts]


def _count(it, texts: str):
    """The term counts of a task in the frequency table, as compressed blocks."""
    hashes, table = WordHashes(), np.zeros(TABLE, np.uint32)
    for pdf in it:
        _, t = _Texts(hashes, _batch_words(pdf[texts])).terms()
        table += np.bincount((t >> np.uint64(44)).astype(np.int64), minlength=TABLE).astype(np.uint32)
    yield from table_blocks(table)


def term_counts(rows: DataFrame) -> np.ndarray:
    """The table of term frequencies over all rows: TABLE counts, whatever the number of rows."""
    return summed_tables(rows.select("text"), partial(_count, texts="text"), TABLE)


_POST = np.dtype([("term", "<u4"), ("lo", "<u4"), ("hi", "u1"), ("n", "<u2"), ("left", "<u2"), ("q", "<u2"), ("counts", "u1", BUCKETS // 2)])


def class_key(ws: list[str]) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(" ".join(ws))
    return h >> 64, h & 0xFFFFFFFFFFFFFFFF


def _lists(it, table, n_buckets: int):
    """Entries of the inverted lists, packed by bucket and side."""
    freq, hashes, seen, held, size = table.value, WordHashes(), set(), [], 0
    z = zstandard.ZstdCompressor(level=1)

    def flush():
        if not held:
            return None
        bucket, side, post = (np.concatenate(x) for x in zip(*held, strict=True))
        key = bucket * 4 + side
        order = np.argsort(key << 32 | post["term"])
        key, post = key[order], post[order]
        cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        out = {"bucket": [], "side": [], "entries": []}
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            p = post[a:b]
            out["bucket"].append(int(key[a] >> 2))
            out["side"].append(int(key[a] & 3))
            out["entries"].append(z.compress(b"".join(np.ascontiguousarray(p[f]).tobytes() for f in _POST.names)))
        held.clear()
        return pd.DataFrame(out).astype({"bucket": "int32", "side": "int32"})

    for pdf in it:
        ws, sides, ids = [], [], []
        for x, s in zip(pdf["text"], pdf["side"], strict=True):
            w = words(x) if isinstance(x, str) else []
            if not w:
                continue
            k = class_key(w)
            if (k, s) in seen:
                continue
            if len(seen) > 2_000_000:
                seen.clear()
            seen.add((k, s))
            ws.append(w)
            sides.append(s)
            ids.append(k[0] >> 24)
        if not ws:
            continue
        t = _Texts(hashes, ws)
        d, term = t.terms()
        f = freq[(term >> np.uint64(44)).astype(np.int64)]
        order = np.lexsort((term, f, d))
        d, term, f = d[order], term[order], f[order]
        n = t.n[d]
        at = np.arange(len(d)) - t.at[d]
        keep = at <= n - np.ceil(SAME * n - 1e-9)
        d, term, f, n, at = d[keep], term[keep], f[keep], n[keep], at[keep]
        nib, q = t.packed()
        ids, sides = np.array(ids, np.uint64), np.array(sides, np.int64)
        post = np.zeros(len(d), _POST)
        post["term"] = (mix(term) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        post["lo"], post["hi"] = (ids[d] & np.uint64(0xFFFFFFFF)).astype(np.uint32), (ids[d] >> np.uint64(32)).astype(np.uint8)
        top = 65535
        post["n"], post["left"], post["q"] = np.minimum(n, top), np.minimum(n - at, top), np.minimum(q[d], top)
        post["counts"] = nib[d]
        side = sides[d]
        # long lists: a grid of pieces, the own piece along one side and all pieces of the other
        pieces = -(-f.astype(np.int64) // LIST)
        where = mix(term) >> np.uint64(32)
        if (pieces > 1).any():
            own = (mix(ids[d]) >> np.uint64(20)).astype(np.int64) % np.maximum(pieces, 1)
            rep = np.repeat(np.arange(len(d)), np.maximum(pieces, 1))
            other = np.arange(len(rep)) - np.repeat(np.cumsum(np.maximum(pieces, 1)) - np.maximum(pieces, 1), np.maximum(pieces, 1))
            cell = np.where(side[rep] == EVAL, own[rep] * pieces[rep] + other, other * pieces[rep] + own[rep])
            where, side, post = mix(where[rep] + (cell.astype(np.uint64) << np.uint64(33))) >> np.uint64(32), side[rep], post[rep]
        held.append(((where % np.uint64(n_buckets)).astype(np.int64), side, post))
        size += len(post)
        if size >= FLUSH:
            yield flush()
            size = 0
    last = flush()
    if last is not None:
        yield last


def _entries(blob: bytes) -> np.ndarray:
    raw = zstandard.decompress(blob)
    n = len(raw) // _POST.itemsize
    out, at = np.empty(n, _POST), 0
    for f in _POST.names:
        kind, size = _POST[f], n * _POST[f].itemsize
        out[f] = np.frombuffer(raw, kind.base, offset=at, count=size // kind.base.itemsize).reshape((n, *kind.shape))
        at += size
    return out


def _ids(p: np.ndarray) -> np.ndarray:
    return p["lo"].astype(np.int64) | p["hi"].astype(np.int64) << 32


def _once(p: np.ndarray) -> np.ndarray:
    """Sorted by term; a text once per term."""
    ids = _ids(p)
    order = np.lexsort((p["left"], ids, p["term"]))[::-1]
    p, ids = p[order], ids[order]
    return p[np.concatenate(([True], (p["term"][1:] != p["term"][:-1]) | (ids[1:] != ids[:-1])))][::-1] if len(p) else p


def _unary(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as 0s and 1s whose dot product is the sum of the smaller counts, and what exceeds UNARY."""
    return (c[:, :, None] > np.arange(UNARY)).reshape(len(c), -1).astype(np.float32), (c.astype(np.int64) - np.minimum(c, UNARY)).sum(axis=1).astype(np.float32)


def _near(ec, en, tc, tn, lo, hi):
    """Pairs (row of e, row of t) of one list, both sides by length, whose word counts allow a match."""
    base = int(lo.min())
    tu, trest = _unary(tc[base : int(hi.max())])
    tneed = (SAME * tn[base : int(hi.max())] - 1e-3).astype(np.float32)
    for a in range(0, len(ec), TILE):
        b = min(a + TILE, len(ec))
        eu, erest = _unary(ec[a:b])
        eneed = (SAME * en[a:b] - 1e-3).astype(np.float32)[:, None]
        for c in range(int(lo[a]) - base, int(hi[b - 1]) - base, CHUNK // TILE):
            k = slice(c, min(c + CHUNK // TILE, int(hi[b - 1]) - base))
            dot = eu @ tu[k].T
            if erest.any() and trest[k].any():
                dot += np.minimum(erest[:, None], trest[k])
            x, y = np.nonzero((dot >= eneed) & (dot >= tneed[k]))
            yield x + a, y + base + c


def _meet(e: np.ndarray, t: np.ndarray):
    """The pairs of texts that share a term and pass the bounds, by chunks."""
    e, t = _once(e), _once(t)
    # the lists by length, so that the partners of a length are one range of a list
    order = np.argsort(e["term"].astype(np.uint64) << np.uint64(16) | e["n"].astype(np.uint64), kind="stable")
    e = e[order]
    at = t["term"].astype(np.uint64) << np.uint64(16) | t["n"].astype(np.uint64)
    order = np.argsort(at, kind="stable")
    at, t = at[order], t[order]
    n = e["n"].astype(np.float64)
    term = e["term"].astype(np.uint64) << np.uint64(16)
    lo = np.searchsorted(at, term | np.ceil(SAME * n - 1e-6).astype(np.uint64))
    hi = np.searchsorted(at, term | np.minimum(np.floor(n / SAME + 1e-6), 65535).astype(np.uint64), side="right")
    some = np.flatnonzero(hi > lo)
    if not len(some):
        return
    e, lo, hi = e[some], lo[some], hi[some]
    ec, tc = _unpacked(e["counts"], e["q"].astype(np.uint32)), _unpacked(t["counts"], t["q"].astype(np.uint32))
    ei, ti = _ids(e), _ids(t)
    en, el = e["n"].astype(np.float32), e["left"].copy()
    tn, tl = t["n"].astype(np.float32), t["left"].copy()

    def passed(x, y):
        # what is left of either vector must reach the dot product still missing
        long = np.maximum(en[x], tn[y])
        ok = (np.minimum(el[x], tl[y]) >= SAME * long - 1e-3) | (long == 65535)
        x, y, need = x[ok], y[ok], SAME * long[ok] - 1e-3
        dot = np.minimum(ec[x], tc[y]).sum(axis=1, dtype=np.uint32)
        ok = dot >= need
        return ei[x[ok]], ti[y[ok]]

    size = hi - lo
    first = np.flatnonzero(np.concatenate(([True], e["term"][1:] != e["term"][:-1])))
    many = np.add.reduceat(size, first) >= DENSE
    ends = np.concatenate((first[1:], [len(e)]))
    for a, b in zip(first[many], ends[many], strict=True):
        for x, y in _near(ec[a:b], en[a:b], tc, tn, lo[a:b], hi[a:b]):
            if len(x):
                yield passed(x + a, y)
    few = np.flatnonzero(np.repeat(~many, ends - first))
    lo, size = lo[few], size[few]
    cut = np.flatnonzero(np.diff(np.concatenate(([-1], np.cumsum(size) // CHUNK))))
    cut = np.unique(np.concatenate(([0], cut, [len(size)])))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        s = size[a:b]
        x = np.repeat(few[a:b], s)
        y = np.arange(len(x)) + np.repeat(lo[a:b] - (np.cumsum(s) - s), s)
        yield passed(x, y)


def _pairs(it):
    """Candidate pairs from the buckets, which come one after the other."""

    def done(sides):
        if len(sides) == 2:
            found = [np.empty((0, 2), np.int64)]
            for a, b in _meet(np.concatenate(sides[EVAL]), np.concatenate(sides[TRAIN])):
                found.append(np.unique(np.stack((a, b), axis=1), axis=0))
            p = np.unique(np.concatenate(found), axis=0)
            if len(p):
                yield pd.DataFrame({"eval_class": p[:, 0], "train_class": p[:, 1]})

    now, sides = None, {}
    for pdf in it:
        for b, s, blob in zip(pdf["bucket"], pdf["side"], pdf["entries"], strict=True):
            if b != now:
                yield from done(sides)
                now, sides = b, {}
            sides.setdefault(s, []).append(_entries(blob))
    yield from done(sides)


def _members(it, wanted):
    """The rows with words, or with ``wanted`` only those of the classes in it."""
    only = set(wanted.value.tolist()) if wanted is not None else None
    for pdf in it:
        ws = _batch_words(pdf["text"])
        keys = [class_key(w) if w else None for w in ws]
        keep = np.array([k is not None and (only is None or k[0] >> 24 in only) for k in keys], bool)
        ws = [w for w, k in zip(ws, keep, strict=True) if k]
        keys = [w for w, k in zip(keys, keep, strict=True) if k]
        if not keys:
            continue
        # plain objects: a filtered Arrow column may come in several chunks or none
        out = pd.DataFrame({c: [x for x, k in zip(pdf[c].tolist(), keep, strict=True) if k] for c in ("id", "side", "label", "origin")}).astype({"side": "int32"})
        out["short"] = np.array([k[0] >> 24 for k in keys], np.int64)
        out["k"] = [b"%016x%016x" % k for k in keys]
        out["words"] = [" ".join(w) for w in ws]
        yield out


def _weighted(texts: _Texts, freq: np.ndarray, total: float):
    """(text, term, squared weight) of all terms, the squared norms, and the share of the norm that a partner must hold."""
    d, t = texts.terms()
    w = np.log1p(total / np.maximum(freq[(t >> np.uint64(44)).astype(np.int64)], 1)) ** 2
    norm = np.bincount(d, weights=w, minlength=len(texts.n))
    order = np.lexsort((-w, d))
    nth = np.arange(len(d)) - texts.at[d[order]]
    missing = texts.n - np.ceil(SAME * texts.n - 1e-9)
    heaviest = np.bincount(d[order], weights=np.where(nth < missing[d[order]], w[order], 0.0), minlength=len(texts.n))
    return d, t, w, norm, 1 - heaviest / np.maximum(norm, 1e-300)


def cosines(a: list[list[str]], b: list[list[str]], freq: np.ndarray, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The weighted cosine of each pair of texts, and the least that a pair of the definition has."""
    total = float(freq.sum()) or 1.0
    (da, ta, wa, na, ra), (db, tb, _, nb, rb) = (_weighted(_Texts(hashes, x), freq, total) for x in (a, b))
    pair, term = np.concatenate((da, db)), np.concatenate((ta, tb))
    w = np.concatenate((wa, np.zeros(len(tb))))
    order = np.lexsort((np.concatenate((np.zeros(len(da)), np.ones(len(db)))), term, pair))
    pair, term, w = pair[order], term[order], w[order]
    both = np.flatnonzero((pair[1:] == pair[:-1]) & (term[1:] == term[:-1])) if len(pair) else np.zeros(0, np.int64)
    dot = np.bincount(pair[both], weights=w[both], minlength=len(a))
    return dot / np.sqrt(np.maximum(na * nb, 1e-300)), np.sqrt(np.maximum(ra * rb, 0))


def _score(it, table):
    freq, hashes = table.value, WordHashes()
    for pdf in it:
        a, b = ([x.split(" ") for x in pdf[c]] for c in ("a_words", "b_words"))
        cosine, least = cosines(a, b, freq, hashes)
        rows = []
        for k in np.flatnonzero(cosine >= least - 1e-9):
            x, y = a[k], b[k]
            same = 1.0 if x == y else lcs_length(x, y) / max(len(x), len(y))
            if same >= SAME - 1e-9:
                rows.append((pdf["a"].iat[k], pdf["b"].iat[k], min(1.0, float(cosine[k])), same))
        if rows:
            yield pd.DataFrame(rows, columns=["a", "b", "cosine", "same"]).astype({"cosine": "float64", "same": "float64"})


def cross_split_links(df: DataFrame, id_col: str, text_col: str, split_col: str, origin_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Links between classes of equal texts of the two sides, and the classes' members.

    Returns links (a, b, cosine, same) -- ``a`` a class with evaluation rows, ``b`` one with
    training rows, ``a = b`` for copies -- and members (k, id, side, label, origin) of the linked
    classes. ``cosine`` is weighted; ``same`` is the share of the longer text's words that stand in
    the other in order.
    Null, empty and wordless texts and rows of other splits take part in nothing; repeated rows
    are members twice; columns other than those named are not read. An empty side gives no links.
    """
    spark = df.sparkSession
    origin = F.col(origin_col) if origin_col else F.lit(None).cast("string")
    side = split_side(F.col(split_col))
    rows = df.select(F.col(id_col).cast("string").alias("id"), side.alias("side"), F.lower(F.trim(split_col)).alias("label"), origin.alias("origin"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("side").isNotNull() & F.col("text").isNotNull())
    table = spark.sparkContext.broadcast(term_counts(rows))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = map_pandas(rows.select("side", "text"), partial(_lists, table=table, n_buckets=8 * n), "bucket int, side int, entries binary")
    pairs = map_pandas(lists.repartition(n, "bucket").sortWithinPartitions("bucket"), _pairs, "eval_class long, train_class long").distinct()
    pairs = checkpointed(pairs)
    wanted = pairs.select(F.explode(F.array("eval_class", "train_class")).alias("short")).distinct()
    schema = "id string, side int, label string, origin string, short long, k string, words string"
    if wanted.count() <= BROADCAST_ROWS:
        few = spark.sparkContext.broadcast(np.array([r[0] for r in wanted.collect()], np.int64))
        members = map_pandas(rows, partial(_members, wanted=few), schema)
    else:
        members = map_pandas(rows, partial(_members, wanted=None), schema).join(wanted, "short", "left_semi")
    members = checkpointed(members)
    texts = members.groupBy("k").agg(F.first("short").alias("short"), F.first("words").alias("words"), F.max((F.col("side") == EVAL).cast("int")).alias("is_eval"), F.max((F.col("side") == TRAIN).cast("int")).alias("is_train"))
    a = texts.where("is_eval = 1").select(F.col("short").alias("eval_class"), F.col("k").alias("a"), F.col("words").alias("a_words"))
    b = texts.where("is_train = 1").select(F.col("short").alias("train_class"), F.col("k").alias("b"), F.col("words").alias("b_words"))
    scored = pairs.join(a, "eval_class").join(b, "train_class").select("a", "b", "a_words", "b_words")
    links = map_pandas(scored, partial(_score, table=table), "a string, b string, cosine double, same double")
    return checkpointed(links.distinct()), members.select("k", "id", "side", "label", "origin")


def cross_split_pairs(df: DataFrame, id_col: str, text_col: str, split_col: str) -> DataFrame:
    """(id_a, id_b), the smaller first: every evaluation row with every training row it is linked to."""
    links, members = cross_split_links(df, id_col, text_col, split_col)
    e = members.where(F.col("side") == EVAL).select(F.col("k").alias("a"), F.col("id").alias("x")).distinct()
    t = members.where(F.col("side") == TRAIN).select(F.col("k").alias("b"), F.col("id").alias("y")).distinct()
    p = links.select("a", "b").join(e, "a").join(t, "b").where(F.col("x") != F.col("y"))
    return p.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def cross_split_report(df: DataFrame, id_col: str, text_col: str, split_col: str, origin_col: str) -> DataFrame:
    """Evaluation rows with a training counterpart, counted per split and origin."""
    links, members = cross_split_links(df, id_col, text_col, split_col, origin_col)
    exact = links.groupBy(F.col("a").alias("k")).agg(F.max((F.col("a") == F.col("b")).cast("int")).alias("exact"), F.countDistinct("b").alias("n_classes"))
    e = members.where(F.col("side") == EVAL).dropDuplicates(["id", "k"]).join(exact, "k")
    return e.groupBy(F.col("label").alias("split"), F.col("origin").alias("data_origin")).agg(
        F.countDistinct("id").alias("n_records"), F.countDistinct(F.when(F.col("exact") == 1, F.col("id"))).alias("n_with_copy"), F.sum("n_classes").alias("n_links")
    )
