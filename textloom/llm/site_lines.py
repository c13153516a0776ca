"""Problem 5: lines repeated across the documents of one site.

Pages of a line inside its site and outside are compared by a log-likelihood ratio, and the
excess lines are kept under a false discovery rate (Benjamini-Hochberg). All counts are distinct
pages; a line of a page is first reduced to its normal form, and (site, form, page) made distinct
by partial aggregation, so the rows of a large site are spread over the tasks by their forms.

Two points differ from the plain test. Outside pages count only where the line is not itself
repeated by its site: otherwise a notice that every site prints would be nobody's excess. And the
p-values of the ratio become q-values from a histogram of fixed size over all tests, so no task
sorts them all. A site without any pages outside it is compared with what an unrepeated line does,
which stands on one page of the site.

A line is removed if both hold: the test finds an excess, and it stands on the least number and
share of the site's pages that the definition asks for. A line as frequent on pages of other sites,
none of which repeats it, is no excess and stays.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

MIN_PAGES, MIN_SHARE, FDR = 4, 0.2, 0.05
BINS, BIN_WIDTH = 4096, 0.05  #: of the histogram of the ratio


def site_of(*urls: Column) -> Column:
    """Host of the first URL that has one: lower case, no user, port, or leading ``www.``."""

    def host(u: Column) -> Column:
        h = F.lower(F.regexp_extract(F.trim(u), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
        h = F.regexp_replace(h, r"^www\.", "")
        return F.when(h != "", h)

    return F.coalesce(*(host(u) for u in urls))


def line_form(line: Column) -> Column:
    """Lower case, digit runs ``#``, runs of anything but letters and ``#`` one space, trimmed."""
    x = F.regexp_replace(F.lower(line), "[0-9]+", "#")
    return F.trim(F.regexp_replace(x, r"[^\p{L}#]+", " "))


def _keyed(rows: DataFrame) -> DataFrame:
    """With the two 64-bit hashes that stand for (site, form) and form in shuffles."""
    return rows.withColumns({"sf": F.xxhash64("site", "form"), "f": F.xxhash64("form", F.lit(7))})


def page_lines(df: DataFrame, page_col: str, text_col: str, urls: list[str]) -> DataFrame:
    """(page, site, line_no, line, form, sf, f); lines split at ``\\n`` and numbered from 1, blank ones included.

    Null sites form one site of their own, with an empty name.
    """
    site = F.coalesce(site_of(*(F.col(u) for u in urls)), F.lit(""))
    rows = df.select(F.col(page_col).alias("page"), site.alias("site"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    rows = rows.select("page", "site", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return _keyed(rows.select("page", "site", (F.col("line_no") + 1).alias("line_no"), "line", line_form(F.col("line")).alias("form")))


def _ratio(k1, n1, k2, n2) -> Column:
    """Dunning's log-likelihood ratio for k1 of n1 against k2 of n2, zero unless k1 / n1 is larger; without n2 against one of n1."""

    def part(k, n, p):
        # a zero count adds nothing; p is then not looked at
        return F.when(k > 0, k * F.ln(F.when(k > 0, k / n / p))).otherwise(0.0)

    # nothing outside: against one page of the site, a known rate
    p = F.when(n2 > 0, (k1 + k2) / F.greatest(n1 + n2, F.lit(1))).otherwise(1 / F.greatest(n1, F.lit(1)))
    q = 1 - p
    g = 2 * (part(k1, n1, p) + part(n1 - k1, n1, q) + part(k2, n2, p) + part(n2 - k2, n2, q))
    return F.when((n2 > 0) & (k1 / n1 <= k2 / F.greatest(n2, F.lit(1))), 0.0).otherwise(F.coalesce(g, F.lit(0.0)))


def _threshold(tests: DataFrame, rate: float) -> float:
    """The smallest ratio accepted at this false discovery rate, from a histogram of fixed size."""
    bins = tests.groupBy(F.least(F.floor(F.col("ratio") / BIN_WIDTH), F.lit(BINS - 1)).cast("int").alias("bin")).count().collect()  # BINS rows at most
    n = np.zeros(BINS, np.int64)
    for r in bins:
        n[r["bin"]] = r["count"]
    total = n.sum()
    if not total:
        return float("inf")
    above = n[::-1].cumsum()[::-1]
    edge = np.arange(BINS) * BIN_WIDTH
    # one-sided p-value of a chi-square with one degree of freedom at the bin's lower edge
    from math import erfc, sqrt

    p = np.array([erfc(sqrt(x / 2)) / 2 for x in edge])
    ok = p * total <= rate * np.maximum(above, 1)
    return float(edge[ok].min()) if ok.any() else float("inf")


def line_excess(df: DataFrame, page_col: str, text_col: str, urls: list[str], min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, rate: float = FDR) -> tuple[DataFrame, DataFrame]:
    """(lines, excess): all lines, and (site, sf, f, pages, site_pages, outside, ratio, significant, repeated).

    ``excess`` has the forms with a letter that stand on ``min_pages`` pages of the site or more.
    ``repeated`` means also on ``min_share`` of the site's pages, ``outside`` are the pages of other
    sites that the test counts, ``significant`` is the test's answer.
    Pages without text count as pages of their site. Forms are named by two hashes of 64 bits each,
    so that no line's text is shuffled.
    """
    site = F.coalesce(site_of(*(F.col(u) for u in urls)), F.lit(""))
    sites = df.select(F.col(page_col).alias("page"), site.alias("site")).distinct().groupBy("site").agg(F.count("page").alias("site_pages"))
    sites = checkpointed(sites)
    lines = page_lines(df, page_col, text_col, urls)
    forms = lines.where(F.col("form").rlike(r"\p{L}")).select(F.xxhash64("site").alias("s"), "sf", "f", "page")
    # distinct pages of a (site, form): spread by page as well, then counted
    counts = forms.groupBy("s", "sf", "f", "page").agg(F.lit(1).alias("one")).groupBy("s", "sf", "f").agg(F.count("one").alias("pages"))
    counts = counts.join(sites.withColumn("s", F.xxhash64("site")), "s").drop("s")
    counts = checkpointed(counts)
    repeated = (F.col("pages") >= min_pages) & (F.col("pages") >= min_share * F.col("site_pages") - 1e-9)
    totals = counts.groupBy("f").agg(F.sum(F.when(~repeated, F.col("pages")).otherwise(0)).alias("stray"))
    all_pages = sites.agg(F.sum("site_pages")).first()[0] or 0
    tests = counts.where(F.col("pages") >= min_pages).join(totals, "f")
    inside, n_in = F.col("pages").cast("double"), F.col("site_pages").cast("double")
    own_stray = F.when(repeated, 0).otherwise(F.col("pages"))
    k_out, n_out = (F.col("stray") - own_stray).cast("double"), F.lit(float(all_pages)) - n_in
    tests = checkpointed(tests.select("site", "sf", "f", "pages", "site_pages", k_out.cast("long").alias("outside"), _ratio(inside, n_in, k_out, n_out).alias("ratio"), repeated.alias("repeated")))
    return lines, tests.withColumn("significant", F.col("ratio") >= F.lit(_threshold(tests, rate)))


def named(lines: DataFrame, excess: DataFrame) -> DataFrame:
    """``excess`` with the form's text."""
    text = lines.join(excess.select("sf", "f"), ["sf", "f"], "left_semi").groupBy("sf", "f").agg(F.first("form").alias("form"))
    return excess.join(text, ["sf", "f"])


def repeated_lines(df: DataFrame, page_col: str, text_col: str, urls: list[str], **kw) -> DataFrame:
    """(page, line_no, site, form): the lines to remove, each page's once.

    Empty and null texts have no lines to remove; a page fetched twice counts once, and its lines
    come out once per number.
    """
    lines, excess = line_excess(df, page_col, text_col, urls, **kw)
    bad = excess.where("significant and repeated").select("sf", "f")
    return lines.join(bad, ["sf", "f"], "left_semi").select("page", "line_no", "site", "form").distinct()


def without_repeated_lines(df: DataFrame, page_col: str, text_col: str, urls: list[str], **kw) -> DataFrame:
    """(page, text, n_removed): each distinct page text without its site's repeated lines, in order.

    The excess forms of a site are joined to the lines (anti-join) and the rest is put together by
    position. Null texts stay null. A page that was fetched with several texts has a row for each.
    """
    site = F.coalesce(site_of(*(F.col(u) for u in urls)), F.lit(""))
    pages = df.select(F.col(page_col).alias("page"), site.alias("site"), F.col(text_col).alias("text")).distinct()
    key = F.sha2(F.col("text"), 256)
    pages = pages.withColumn("key", key)
    _, excess = line_excess(df, page_col, text_col, urls, **kw)
    rows = pages.where("text is not null").select("page", "site", "key", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("form", line_form(F.col("line")))
    bad = excess.where("significant and repeated").select("sf", "f")
    kept = _keyed(rows).join(bad, ["sf", "f"], "left_anti").groupBy("page", "site", "key").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    kept = kept.select("page", "site", "key", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("kept"), F.size("l").alias("n_kept"))
    n = F.size(F.split("text", "\n"))
    out = pages.join(kept, ["page", "site", "key"], "left")
    return out.select("page", F.when(F.col("text").isNotNull(), F.coalesce("kept", F.lit(""))).alias("text"), F.when(F.col("text").isNotNull(), n - F.coalesce("n_kept", F.lit(0))).alias("n_removed"))
