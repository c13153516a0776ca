"""URL and page functions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_white, contains_any

# Parts of URLs that are never followed, and query parameters that a canonical URL keeps.
BLOCKED = ("mailto:", "javascript:", ".pdf", ".doc", ".docx", ".ppt", ".pptx", ".png", ".jpg", ".jpeg", ".gif", ".webp", ".css", ".js", ".xml", ".zip", ".json", "logout", "signin", "signup", "/search?", "&search=", "?search=", "?term=", "?q=", "?query=", "facebook.com", "twitter.com", "x.com", "linkedin.com")
KEPT_UTM = ("utm_medium", "utm_source", "utm_campaign")


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def netloc(url: Column) -> Column:
    """Host and port, lower case; '' where there is none. No error on odd URLs."""
    rest = F.substring_index(without_fragment(url), "://", -1)
    return F.lower(F.substring_index(F.substring_index(rest, "/", 1), "?", 1))


def domain(url: Column) -> Column:
    return F.replace(netloc(url), F.lit("www."), F.lit(""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def canonical(url: Column, kept: Sequence[str] = KEPT_UTM) -> Column:
    """Lower-case host, no fragment, no trailing slash but the root's, no utm parameters but ``kept``.

    The order of the parameters stays, and so does their spelling. What is no absolute URL stays as it is.
    """
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & (~p.startswith("utm_") | F.split(p, "=")[0].isin(*kept)))
    p = path(url)
    p = F.when((F.length(p) > 1) & p.endswith("/"), F.regexp_replace(p, "/$", "")).otherwise(p)
    q = F.array_join(pairs, "&")
    out = F.concat(scheme, F.lit("://"), netloc(url), p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.when((scheme == "") | (netloc(url) == ""), url).otherwise(out)


def blocked(url: Column, tokens: Sequence[str] = BLOCKED) -> Column:
    low = F.lower(url)
    return low.endswith("#") | contains_any(low, tokens)


def host_suffixes(host: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]: an allow-list of domains becomes an equi-join on these."""
    parts = F.split(F.replace(F.lower(host), F.lit("www."), F.lit("")), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def followable(host_ok: Column, url: Column, depth: Column, max_depth: int = 3, max_slashes: int = 8) -> Column:
    slashes = F.length(path(url)) - F.length(F.replace(path(url), F.lit("/"), F.lit("")))
    return host_ok & (depth >= 0) & (depth < max_depth) & (slashes <= max_slashes) & ~blocked(url)


# The entities that are put back, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def unescaped(c: Column) -> Column:
    for name, sign in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(sign))
    return c


def visible(html: Column) -> Column:
    """Markup without comments, scripts and styles, whose text is none of the page's."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|noscript)\b.*?</\1\s*>", "")


def html_title(html: Column, url: Column) -> Column:
    """The first heading's text, else the title's, else a stand-in with the URL."""
    shown = visible(html)
    h1, t = (F.nullif(collapse_white(unescaped(F.regexp_extract(shown, p, 1))), F.lit("")) for p in (r"(?is)<h1\b[^>]*>([^<]*)", r"(?is)<title\b[^>]*>([^<]*)"))
    return F.coalesce(h1, t, F.concat(F.lit("Crawled Page: "), url))


def html_language(html: Column) -> Column:
    found = F.regexp_extract(html, r"(?is)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z\-]+)", 1)
    return F.when(found == "", "en").otherwise(F.lower(F.substring(found, 1, 2)))


# Where a page says its date, in order.
DATE_PLACES = (
    r"(?is)<meta[^>]*name=[\"']citation_publication_date[\"'][^>]*content=[\"']([^\"']{4,})",
    r"(?is)<meta[^>]*property=[\"']article:published_time[\"'][^>]*content=[\"']([^\"']{4,})",
    r"(?is)<time[^>]*datetime=[\"']([^\"']{4,})",
    r"(?is)<meta[^>]*name=[\"']date[\"'][^>]*content=[\"']([^\"']{4,})",
    r"(?is)<meta[^>]*itemprop=[\"']dateModified[\"'][^>]*content=[\"']([^\"']{4,})",
)


def html_date(html: Column) -> Column:
    """The first of five places for a date that holds one of four characters or more, without its time."""
    return F.substring_index(F.coalesce(*(F.nullif(F.trim(F.regexp_extract(html, p, 1)), F.lit("")) for p in DATE_PLACES), F.lit("")), "T", 1)


def html_paragraphs(html: Column, least: int = 20) -> Column:
    """Direct text of the paragraphs that is longer than ``least`` characters."""
    found = F.regexp_extract_all(visible(html), F.lit(r"(?is)<p(?:\s[^>]*)?>([^<]*)"), F.lit(1))
    return F.filter(F.transform(found, lambda x: collapse_white(unescaped(x))), lambda x: F.length(x) > least)


def html_links(html: Column) -> Column:
    """href values of anchors in order, quoted or not, without mail and script links."""
    found = F.regexp_extract_all(visible(html), F.lit(r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]+\"|'[^']+'|[^\s\"'>]+)"), F.lit(1))
    return F.filter(F.transform(found, lambda x: unescaped(F.trim(x, F.lit("\"'")))), lambda x: ~F.lower(x).rlike("^(mailto|javascript):"))


def first_links(html: Column, url: Column, most: int = 25) -> Column:
    """The first ``most`` targets of a page's links that pass the filter of URLs, absolute, without fragments."""
    targets = F.transform(html_links(html), lambda x: without_fragment(absolute(x, url)))
    return F.slice(F.filter(targets, lambda x: ~blocked(x)), 1, most)


def absolute(link: Column, base: Column) -> Column:
    """A link against its page's URL: absolute, host-relative, path-relative and query-only forms."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    root = F.concat(scheme, F.lit("://"), netloc(base))
    folder = F.regexp_replace(path(base), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(root, path(base), link))
        .otherwise(F.concat(root, folder, F.regexp_replace(link, r"^\./", "")))
    )


def is_html(content_type: Column) -> Column:
    return F.contains(F.lower(content_type), F.lit("html"))


# Words in a URL that make a page worth reading, and path rules by domain.
PATH_KEYWORDS = ("women", "reproductive", "pregnancy", "menstrual", "period", "breast", "gyne", "fertility", "sexual", "health-topics", "reproductivehealth", "reproductive-health", "maternal", "menopause", "childbirth", "contraception", "ovulation", "ovulatory", "pcos", "endometriosis", "fibroid", "ovarian", "pid", "sti", "thyroid", "infertility", "amenorrhea", "bleeding", "postpartum", "breastfeeding", "dysmenorrhea", "pelvic", "pain", "uterine")
PATH_RULES = {
    "acog.org": (r"^/womens-health/faqs/",),
    "cdc.gov": (r"^/reproductivehealth/", r"^/contraception/", r"^/pid/", r"^/std/"),
    "womenshealth.gov": (r"^/menstrual-cycle/", r"^/pregnancy", r"^/menopause/", r"^/health-topics/"),
    "who.int": (r"^/health-topics/", r"^/news/item/"),
    "nhs.uk": (r"^/conditions/",),
    "nice.org.uk": (r"^/guidance/",),
    "nichd.nih.gov": (r"^/health/topics/",),
    "medlineplus.gov": (r"^reproductivehealth", r"^/conditions/"),
    "mayoclinic.org": (r"^/symptoms/", r"^/conditions/"),
}


def path_allowed(url: Column, rules: dict = PATH_RULES, keywords: Sequence[str] = PATH_KEYWORDS) -> Column:
    """A rule of the URL's domain fits its path, or the URL has one of the keywords."""
    host, low = domain(url), F.lower(path(url))
    hit = contains_any(F.lower(url), keywords)
    for name, patterns in rules.items():
        hit = hit | (((host == name) | host.endswith(f".{name}")) & low.rlike("|".join(patterns)))
    return hit


def search_hits(links: Column, kind: str, most: int) -> Column:
    """The first ``most`` distinct results among a search page's links: ``article`` (numeric last part) or ``wiki``."""
    pattern = {"article": r"/\d+/?$", "wiki": r"/wiki/(?!Special:)"}[kind]
    return F.slice(F.array_distinct(F.filter(links, lambda x: x.rlike(pattern))), 1, most)
