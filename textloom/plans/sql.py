"""Helpers for the SQL that queries are held against."""

from __future__ import annotations


def plain_trim(sql: str) -> str:
    """``trim(x)`` to ``trim(x, ' ')``: blanks only, as Spark's trim; other white space stays."""
    out, at = [], 0
    while (k := sql.find("trim(", at)) >= 0:
        depth, comma, end = 1, False, k + 5
        quote = False
        while depth:
            c = sql[end]
            if c == "'":
                quote = not quote
            elif not quote:
                depth += (c in "([") - (c in ")]")
                comma |= c == "," and depth == 1
            end += 1
        inner = sql[k + 5 : end - 1]
        out += [sql[at:k], "trim(", plain_trim(inner), "" if comma else ", ' '", ")"]
        at = end
    return "".join([*out, sql[at:]])
