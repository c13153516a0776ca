"""Problem 3: oversized texts cut into pieces at natural boundaries, with an overlap.

A hierarchy of separators: section, paragraph, line (list entry), sentence, clause, word, character.
A text over the limit is cut at the coarsest separator it has; parts that are still too large are
cut at the next finer one; then neighbouring parts are packed greedily up to the limit. Each piece
but the first begins with the last part of the piece before it: about ``overlap`` characters,
begun at a boundary where one lies near.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_pandas

LIMIT, OVERLAP, SLACK = 1200, 100, 60
# Abbreviations after which a full stop ends no sentence.
ABBREVIATIONS = "e.g i.e dr mr mrs ms prof approx vs cf fig figs no nr bzw ca z.b d.h p.ej sr sra etc st vol pp p.m a.m usw al".split()
_ABBR = "|".join(re.escape(a) for a in sorted(ABBREVIATIONS, key=len, reverse=True))

#: (name, pattern); a cut lies after the pattern's match, so separators stay with the part before
LEVELS = (
    ("section", re.compile(r"(?:\r?\n[ \t]*){3,}|\r?\n(?=[ \t]*(?:#{1,6} |={3,}|-{3,}[ \t]*\r?\n))|\f")),
    ("paragraph", re.compile(r"\r?\n[ \t]*\r?\n\s*")),
    ("line", re.compile(r"\r\n|[\n\r  \x85]")),
    ("sentence", re.compile(r"[.!?…]+[\"'»”’)\]]*\s+|[。！？｡؟۔।॥]+[」』）”]*\s*")),
    ("clause", re.compile(r"[;:,،、；，：]\s*(?<=\s)|[、；，：،]|\s[–—-]\s")),
    ("word", re.compile(r"\s+|​")),
)
_NO_END = re.compile(rf"(?:^|[\s(])(?:{_ABBR})\.\s+$", re.I)


def _boundaries(text: str, level: int, lo: int, hi: int) -> list[int]:
    """Places strictly inside (lo, hi) where the text may be cut at this level."""
    out = []
    for m in LEVELS[level][1].finditer(text, lo, hi):
        at = m.end()
        if lo < at < hi and not (level == 3 and text[m.start()] == "." and _NO_END.search(text, max(lo, m.start() - 12), at)):
            out.append(at)
    return out


def _character_cuts(text: str, lo: int, hi: int, size: int) -> list[int]:
    """Cuts every ``size`` characters, moved back so as not to part a mark from its letter."""
    import unicodedata

    out, at = [], lo + size
    while at < hi:
        cut = at
        while cut > lo + size // 2 and (unicodedata.combining(text[cut]) or text[cut] in "‍️" or text[cut - 1] == "‍"):
            cut -= 1
        out.append(cut)
        lo, at = cut, cut + size
    return out


def parts(text: str, size: int, lo: int = 0, hi: int | None = None, level: int = 0) -> list[tuple[int, int, int]]:
    """(start, end, level) parts of at most ``size`` characters, covering the text."""
    hi = len(text) if hi is None else hi
    out, todo = [], [(lo, hi, level)]
    while todo:
        a, b, k = todo.pop()
        if b - a <= size:
            out.append((a, b, k))
            continue
        if k == len(LEVELS):
            cuts = _character_cuts(text, a, b, size)
        else:
            cuts = _boundaries(text, k, a, b)
        ends = [a, *cuts, b]
        todo.extend((x, y, k + (k < len(LEVELS))) for x, y in reversed(list(zip(ends, ends[1:], strict=False))))
    return out


def _begin_of_overlap(text: str, lo: int, end: int, overlap: int) -> int:
    """Where the repeated tail of text[lo:end] begins: a boundary near end - overlap, finest last."""
    want = max(lo, end - overlap)
    if want <= lo:
        return lo
    a, b = max(lo, want - SLACK), min(end - 1, want + SLACK // 2)
    for level in (1, 2, 3, 5):
        near = _boundaries(text, level, max(lo, a - 20), min(end, b + 20))
        near = [x for x in near if a <= x <= b]
        if near:
            k = bisect_left(near, want)
            return min(near[max(0, k - 1) : k + 1], key=lambda x: abs(x - want))
    return want


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end, own start) of the pieces; text[start:own] repeats the piece before.

    The own ranges [own, end) follow one another and cover the text, so the text can be put
    together again; no piece is longer than ``limit``.
    """
    if len(text) <= limit:
        return [(0, len(text), 0)]
    room = limit - overlap - SLACK
    todo = parts(text, room)[::-1]
    pieces, start, own, end = [], 0, 0, 0
    while todo:
        a, b, k = todo.pop()
        if b - start <= limit:
            end = b
            continue
        # The finer boundaries of the next part may fill the piece, if it is less than half full.
        if end - start < limit // 2 and k < len(LEVELS):
            cuts = [a, *_boundaries(text, k, a, b), b]
            if len(cuts) > 2 or k + 1 < len(LEVELS):
                todo.extend((x, y, k + 1) for x, y in reversed(list(zip(cuts, cuts[1:], strict=False))))
                continue
        pieces.append((start, end, own))
        own = end
        start = _begin_of_overlap(text, pieces[-1][0], end, overlap)
        todo.append((a, b, k))
        if b - start > limit:  # cannot be: a part has at most ``room`` characters
            start = own
    pieces.append((start, end, own))
    return pieces


def _cut(it, limit: int, overlap: int):
    for pdf in it:
        rows = []
        for key, text in zip(pdf["id"], pdf["text"], strict=True):
            got = split(text, limit, overlap)
            rows.extend((key, k, len(got), a, b, own - a, text[a:b]) for k, (a, b, own) in enumerate(got))
        yield pd.DataFrame(rows, columns=["id", "piece_no", "n_pieces", "start_pos", "end_pos", "n_repeated", "piece"]).astype({c: "int32" for c in ("piece_no", "n_pieces", "start_pos", "end_pos", "n_repeated")})


def split_texts(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, whole: bool = True) -> DataFrame:
    """(id, piece_no, n_pieces, start_pos, end_pos, n_repeated, piece) for every text.

    Texts within the limit come out as one piece without passing through Python (or not at all with
    ``whole=False``). Null texts give no piece, an empty text one empty piece. Repeated rows give
    repeated pieces. Positions are code points. Columns other than the two named are not read.
    """
    if not 0 <= overlap + SLACK < limit // 2:
        raise ValueError("the overlap must leave half of the limit to new text")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    n = F.char_length("text")
    schema = f"id {dict(rows.dtypes)['id']}, piece_no int, n_pieces int, start_pos int, end_pos int, n_repeated int, piece string"
    cut = map_pandas(rows.where(n > limit), partial(_cut, limit=limit, overlap=overlap), schema)
    if not whole:
        return cut
    zero = F.lit(0)
    same = rows.where(n <= limit).select("id", zero.alias("piece_no"), F.lit(1).alias("n_pieces"), zero.alias("start_pos"), n.alias("end_pos"), zero.alias("n_repeated"), F.col("text").alias("piece"))
    return cut.unionByName(same)
