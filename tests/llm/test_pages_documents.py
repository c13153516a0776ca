"""Problems 3, 5, 7, 8, 9 and 10."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from textloom.llm import boilerplate as B
from textloom.llm import mixing as M
from textloom.llm import packing as K
from textloom.llm import personal as N
from textloom.llm import site_lines as L
from textloom.llm import splitting as S
from textloom.llm import tokens as T

# -- problem 3


def whole(text, limit, overlap):
    got = S.split(text, limit, overlap)
    assert "".join(text[own:end] for _, end, own in got) == text
    assert all(end - start <= limit and start <= own for start, end, own in got)
    for (_, end, _), (start, _, own) in zip(got, got[1:], strict=False):
        assert own == end and (overlap == 0 or own - start <= overlap + S.SLACK)
    return got


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. \n\r;é中́", max_size=3000), st.sampled_from([(400, 40), (500, 0), (1200, 100)]))
@example("x" * 5000, (400, 40))
@example(" " * 3000, (400, 40))
def test_pieces_put_together_are_the_text(text, size):
    whole(text, *size)


def test_cuts_lie_at_natural_boundaries():
    paragraph = "Rest helps many. " * 12
    text = "\n\n".join([paragraph.strip()] * 12)
    for _, end, _ in whole(text, 1200, 100)[:-1]:
        assert text[:end].endswith("\n\n")
    sentences = "Dr. Vale notes approx. 5 mg vs. 6 p.m. values here. " * 60
    for _, end, _ in whole(sentences, 1200, 100)[:-1]:
        assert sentences[:end].endswith("here. ")
    words = "word " * 900
    got = whole(words, 1200, 100)
    assert all(words[end - 1] == " " and (words[start - 1] == " " or start == 0) for start, end, _ in got[:-1])
    assert all(60 <= b[2] - b[0] <= 130 for b in got[1:])


def test_split_texts(spark):
    rows = [("a", "x" * 1200), ("b", "y " * 700), ("c", None), ("d", ""), ("b", "y " * 700)]
    df = spark.createDataFrame(rows, "id string, t string").selectExpr("*", "1 as piece", "2 as n_pieces")
    got = S.split_texts(df, "id", "t").collect()
    n = Counter(r["id"] for r in got)
    assert n["a"] == 1 and n["b"] >= 4 and n["c"] == 0 and n["d"] == 1
    assert {r["id"] for r in got if r["n_pieces"] > 1} == {"b"}
    assert S.split_texts(df.limit(0), "id", "t").count() == 0
    with pytest.raises(ValueError):
        S.split_texts(df, "id", "t", 100, 100)


# -- problem 5

LINES = ["Read our terms", "© 2021 Site", "© 2022 Site", "Share now!", "", "123", "Unique {k}", "Common text", "Ünïcode – line"]


def pages(n=60, sites=6, seed=1):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        site = rng.randint(0, sites - 1)
        lines = [rng.choice(LINES).format(k=k) for _ in range(rng.randint(0, 9))]
        url = rng.choice([f"https://WWW.site{site}.example:80/p{k}", f"http://site{site}.example/p{k}?a"])
        out.append((k, url if k % 3 else None, f"https://site{site}.example/x", "\n".join(lines) if k % 11 else None, f"Title {k}"))
    return out


def lettered(n):
    """A number in letters: digits are all one to the operator."""
    return "".join(chr(97 + int(c)) for c in str(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, canonical_url string, url string, content string, title string")


def form(line):
    import re

    return re.sub(r"[^\w#]+|_", " ", re.sub("[0-9]+", "#", line.lower())).strip()


def repeated(rows):
    import re

    site = {r[0]: re.sub(r"^www\.", "", re.sub(r":\d+$", "", re.search("//([^/?#]*)", r[1] or r[2])[1].lower())) for r in rows}
    members, at = defaultdict(set), defaultdict(set)
    for r in rows:
        members[site[r[0]]].add(r[0])
        for line in (r[3].split("\n") if r[3] is not None else ()):
            if re.search(r"[^\W\d_]", form(line)):
                at[site[r[0]], form(line)].add(r[0])
    bad = {k for k, v in at.items() if len(v) >= 4 and len(v) >= 0.2 * len(members[k[0]])}
    return {(r[0], n) for r in rows if r[3] is not None for n, line in enumerate(r[3].split("\n"), 1) if (site[r[0]], form(line)) in bad}


def test_repeated_lines_lie_within_the_definition(spark):
    rows = pages(300, 8)
    rows += rows[:20]
    got = {(r["page"], r["line_no"]) for r in L.repeated_lines(frame(spark, rows), "page_id", "content", ["canonical_url", "url"]).collect()}
    want = repeated(rows)
    assert got <= want and len(got) >= 0.9 * len(want)


def test_repeated_lines_of_clear_sites_are_all_found(spark):
    rows = [(s * 100 + k, f"https://s{s}.example/{k}", "", f"Notice of site {'abcdefgh'[s]}\nOwn text {chr(97 + k)} of page\nAll rights kept", "t") for s in range(8) for k in range(26)]
    got = {(r["page"], r["line_no"]) for r in L.repeated_lines(frame(spark, rows), "page_id", "content", ["canonical_url", "url"]).collect()}
    assert got == repeated(rows) == {(r[0], n) for r in rows for n in (1, 3)}
    clean = {r["page"]: (r["text"], r["n_removed"]) for r in L.without_repeated_lines(frame(spark, rows), "page_id", "content", ["canonical_url", "url"]).collect()}
    assert clean[305] == ("Own text f of page", 2)


def test_pages_without_content(spark):
    rows = [(1, None, None, "a\nb", "t"), (2, "x", "y", None, None), (3, None, "https://a.example", "", "t")]
    assert L.repeated_lines(frame(spark, rows), "page_id", "content", ["canonical_url", "url"]).count() == 0
    assert {r["page"]: r["text"] for r in L.without_repeated_lines(frame(spark, rows), "page_id", "content", ["canonical_url", "url"]).collect()} == {1: "a\nb", 2: None, 3: ""}
    assert L.repeated_lines(frame(spark, rows[:0]), "page_id", "content", ["canonical_url", "url"]).count() == 0


def test_the_ratio_rejects_lines_as_frequent_elsewhere(spark):
    """One line on a fifth of a site's pages and on nearly as many of thirty others, which do not repeat it; a notice beside it."""
    rows = []
    for s in range(31):
        for k in range(20):
            lines = [f"own {lettered(s)} q {lettered(k)} text"]
            lines += ["common heading"] if k < (4 if s == 0 else 3) else []
            lines += ["special notice"] if s == 0 and k < 4 else []
            rows.append((s * 100 + k, f"https://s{s}.example/{k}", None, "\n".join(lines), None))
    got = {r["form"] for r in L.repeated_lines(frame(spark, rows), "page_id", "content", ["canonical_url", "url"]).select("form").distinct().collect()}
    assert got == {"special notice"}
    _, excess = L.line_excess(frame(spark, rows), "page_id", "content", ["canonical_url", "url"])
    seen = {(r["pages"], r["outside"], r["repeated"], r["significant"]) for r in excess.collect()}
    assert seen == {(4, 90, True, False), (4, 0, True, True)}


def test_a_lone_site_is_compared_with_an_unrepeated_line(spark):
    rows = [(k, f"https://one.example/{k}", None, f"own {lettered(k)} line" + "\nnotice here" * (k < 5), None) for k in range(25)]
    got = L.repeated_lines(frame(spark, rows), "page_id", "content", ["canonical_url", "url"]).collect()
    assert {(r["page"], r["line_no"]) for r in got} == {(k, 2) for k in range(5)}


# -- problem 7


@pytest.mark.parametrize("seed", range(12))
def test_repeated_runs_equal_counting(seed):
    rng = random.Random(seed)
    lines, texts, owner = [], [], []
    for t in range(14):
        for _ in range(rng.randint(0, 30)):
            lines.append(rng.randint(1, 2 if seed % 2 else 5))
            texts.append(t)
            owner.append(t // 2)  # two texts of a page
    n = len(lines)
    for least in (2, 4, 8):
        want, length = np.zeros(n, int), 1
        while length <= n:
            seen = defaultdict(set)
            runs = [k for k in range(n - length + 1) if texts[k] == texts[k + length - 1]]
            for k in runs:
                seen[tuple(lines[k : k + length])].add(owner[k])
            for k in runs:
                if len(seen[tuple(lines[k : k + length])]) >= least:
                    want[k : k + length] = length
            length *= 2
        got = B.repeated_runs(np.array(lines, np.uint64), np.array(texts), np.array(owner), least)
        assert got.tolist() == want.tolist()


@pytest.mark.parametrize("size", [400, 20])
def test_repetition_removes_notices_of_any_wording(spark, monkeypatch, size):
    """Words that are in no list; on small and on cut hosts. Headings and copies of whole pages stay."""
    monkeypatch.setattr(B, "PAGES", size)
    rows = []
    for n in range(60):
        k = lettered(n)
        body = [f"Qualm v{k}a zorbt den w{k}b Falter mit x{k}c und y{k}d an jedem Abend im Tal.", f"Der z{k}e Falter ruht bei u{k}f und t{k}g bis zum Ende von Woche s{k}h im Nest."]
        text = ["Vornak tuli besam ord, ek lumi saran ti fel nakuro vessa danta.", "Zorbung", body[0], "Falterkunde", body[1], "Mirsa tolvan", "Kesta ulmo"]
        rows.append((n, f"https://falter.example/{k}", None, "\n".join(text), None))
    copy = "Ein einziger langer Satz, der auf vielen Seiten dieses Hauses steht.\nEin zweiter langer Satz, der auch auf vielen Seiten des Hauses steht."
    rows += [(100 + k, f"https://kopie.example/{k}", None, copy, None) for k in range(5)]
    got = {(r["page"], r["line_no"]) for r in B.page_furniture(frame(spark, rows), "page_id", "content", "title", ["canonical_url", "url"]).collect()}
    assert got == {(k, n) for k in range(60) for n in (1, 6, 7)}


def test_title_beginnings_and_ends(spark):
    titles = [(f"Tales of w{k} and v{k}",) for k in range(60)] + [(f"w{k}x v{k}: all there is",) for k in range(60)] + [("Other word here",)] * 2 + [(None,), ("",)]
    counts = B.title_counts(spark.createDataFrame(titles, "title string"))
    like = B.Titles(counts, int(counts[0].sum())).like
    assert like("tales of something new") and like("something new all there is") and not like("other word") and not like("tales") and not like("w1 word")


PAGE = """Accept all
Menu
Home › Sleep › {title}
{title}
Written by Ann Example
Sleep changes with the cycle, and many people notice it first in the evening hours.
What you can do
- Cookies and crackers may settle the stomach
- Menu ideas with iron for new mothers
Share this page
Warm drinks help some people fall asleep, although the effect differs from night to night.
Related articles
Living with tiredness – Some notes on how people cope with long days and short nights.
Understanding naps
3 comments
Reader 12: I tried this and it helped me for a week or so.
Privacy policy
© 2021 Quiet Nights. All rights reserved."""
FURNITURE = {1, 2, 3, 5, 10, 12, 13, 14, 15, 16, 17, 18}


def test_furniture_of_a_page_and_its_body(spark):
    rows = [(k, f"https://quiet-nights.example/{k}", None, PAGE.format(title=f"Sleep and the {w} moon"), f"Sleep and the {w} moon | Quiet Nights") for k, w in enumerate(["new", "full", "old", "red", "blue"])]
    rows += [rows[0], (90, None, None, "", "x"), (91, None, None, None, None), (92, "https://one.example/", None, "Just one line of text that is a sentence of its own here.", None)]
    found = B.page_furniture(frame(spark, rows), "page_id", "content", "title", ["canonical_url", "url"]).collect()
    lines = defaultdict(set)
    for r in found:
        lines[r["page"]].add(r["line_no"])
    assert all(lines[k] == FURNITURE for k in range(5)) and set(lines) == set(range(5))
    body = {r["page"]: r["text"] for r in B.main_body(frame(spark, rows), "page_id", "content", "title", ["canonical_url", "url"]).collect()}
    assert body[0].split("\n")[0] == "Sleep and the new moon" and "Reader" not in body[0] and body[91] is None and body[90] == ""
    assert B.page_furniture(frame(spark, rows[:0]), "page_id", "content", "title", ["canonical_url", "url"]).count() == 0


def test_furniture_does_not_depend_on_the_blocks_of_a_host(spark, monkeypatch):
    rows = []
    for k in range(200):
        n = lettered(k)
        body = f"Page w{n}a tells in its own v{n}b words how x{n}c and y{n}d came to be what they are."
        notice = "Zebra corner opens soon\nMenu\n" if k % 40 == 0 else f"Own q{n} start r{n} here\nMenu\n"
        link = f"Tale of moon m{lettered((k + 1) % 200)}x"
        title = f"Tale of moon m{n}x" if k % 2 else None
        rows.append((k, f"https://large.example/{k}", None, (f"{title}\n" if title else notice) + body + "\n" + link, title))
    rows += [(k, f"https://large.example/{k}", None, f"Other text {k} " * 9, None) for k in range(3)]
    want = None
    for size in (400, 40):
        monkeypatch.setattr(B, "PAGES", size)
        got = {tuple(r) for r in B.page_furniture(frame(spark, rows), "page_id", "content", "title", ["canonical_url", "url"]).select("page", "line_no", "kind").collect()}
        assert {k for k, n, _ in got if n == 1} == {k for k in range(0, 200, 40)}  # the notice on five pages
        assert {(k, 4 - k % 2, "related") for k in range(0, 200, 2)} <= got  # links to pages with a title
        assert want is None or got == want
        want = got


# -- problem 8


def sizes(spark, rows):
    return spark.createDataFrame(rows, "id long, n_tokens long")


def packs(spark, rows):
    return spark.createDataFrame(rows, "pack_name string, capacity_tokens int, separator_tokens int")


@pytest.mark.parametrize("shard", [20_000, 50])
def test_packing_is_whole_and_tight(spark, monkeypatch, shard):
    monkeypatch.setattr(K, "SHARD_ROWS", shard)
    monkeypatch.setattr(K, "FAN_IN", 3)
    rng = random.Random(6)
    rows = [(k, rng.choice([0, 1, 7, 128, 129, 256, 300, rng.randint(1, 90)])) for k in range(700)]
    rows += rows[:5] + [(None, 5)]
    spec = [("a", 128, 0), ("b", 128, 3), ("b", 128, 3)]
    out = K.pack_texts(sizes(spark, rows), packs(spark, spec))
    got = [r.asDict() for r in out.collect()]
    per, boxes = defaultdict(list), defaultdict(list)
    for r in got:
        per[r["pack_name"], r["id"]].append((r["part_no"], r["start_token"], r["n_tokens"]))
        boxes[r["pack_name"], r["container"]].append(r["n_tokens"])
    want = {i: n for i, n in rows if i is not None and n}
    assert {i for p, i in per if p == "a"} == {i for p, i in per if p == "b"} == set(want)
    for (_, i), parts in per.items():
        parts.sort()
        assert sum(n for *_, n in parts) == want[i] and [s for _, s, _ in parts] == [k * 128 for k in range(len(parts))]
        assert len(parts) == 1 or all(n == 128 for *_, n in parts[:-1])
    assert all(sum(v) + (len(v) - 1) * (3 if p == "b" else 0) <= 128 for (p, _), v in boxes.items())
    report = {r["pack_name"]: r for r in K.packing_report(out, packs(spark, spec)).collect()}
    assert report["a"]["n_containers"] <= report["a"]["least_containers"] * 1.03 + 2
    assert K.pack_texts(sizes(spark, rows[:0]), packs(spark, spec)).count() == 0


def test_sum_of_squares_takes_the_best_level():
    rng = random.Random(1)
    boxes, levels = K.SumOfSquares(20), []
    for _ in range(300):
        size = rng.randint(1, 20)
        before = Counter(v for v in levels if v < 20)

        def cost(c):
            return sum(n * n for v, n in c.items() if 0 < v < 20)

        options = {}
        for v in [0, *before]:
            if v + size <= 20:
                c = Counter(before)
                c[v] -= v > 0
                c[v + size] += 1
                options[v] = cost(c)
        box = boxes.place(size)
        if box == len(levels):
            levels.append(0)
        assert options[levels[box]] == min(options.values())
        levels[box] += size


def test_containers_nothing_fits_into_are_closed(spark, monkeypatch):
    """Texts of more than half a container: no open container of one shard reaches another."""
    monkeypatch.setattr(K, "SHARD_ROWS", 40)
    monkeypatch.setattr(K, "FAN_IN", 2)
    seen = []
    inner = K.checkpointed
    monkeypatch.setattr(K, "checkpointed", lambda df: seen.append(0) or inner(df))
    out = K.pack_texts(sizes(spark, [(k, 60 + k % 30) for k in range(500)]), packs(spark, [("a", 100, 0)]))
    assert out.select("container").distinct().count() == 500 and len(seen) == 2  # no round at all
    rng = random.Random(3)
    mixed = [(k, rng.choice([60, 61, 70, 5])) for k in range(500)]
    out = K.pack_texts(sizes(spark, mixed), packs(spark, [("a", 100, 0)]))
    least = sum(n > 50 for _, n in mixed)
    assert out.select("container").distinct().count() <= least + 1 and out.count() == 500


def test_after_a_round_at_most_two_containers_are_open():
    rng = random.Random(5)
    for capacity in (10, 100):
        boxes = K.FullestFirst(capacity)
        for n in sorted((rng.randint(1, capacity - 1) for _ in range(400)), reverse=True):
            boxes.place(n)
        used = np.array(boxes.used)
        assert (used <= capacity).all() and (2 * used <= capacity).sum() <= 1
        assert (~K.closed(used, capacity)).sum() <= 2


# -- problem 9


@pytest.mark.parametrize("chunk", [1 << 16, 100])
def test_schedule_is_even_from_the_start(spark, monkeypatch, chunk):
    monkeypatch.setattr(M, "CHUNK", chunk)
    shares = [0.5, 0.3, 0.15, 0.05]
    rows = M.schedule(spark, [("m", 4096, list("abcd"), shares), ("one", 1, ["a"], [1.0])]).collect()
    assert [(r["source"], r["nth"]) for r in rows if r["mix_name"] == "one"] == [("a", 0)]
    of = {r["slot"]: r["source"] for r in rows if r["mix_name"] == "m"}
    assert sorted(of) == list(range(4096))
    for n in (20, 100, 1000, 4096):
        for s, p in zip("abcd", shares, strict=True):
            assert abs(sum(of[k] == s for k in range(n)) - p * n) <= 4
    for s in "abcd":
        own = sorted((r["slot"], r["nth"]) for r in rows if r["mix_name"] == "m" and r["source"] == s)
        assert [n for _, n in own] == list(range(len(own)))


def test_slots_keep_their_size_as_a_mix_grows(spark):
    rows = spark.createDataFrame([(k, "ab"[k % 2], 10) for k in range(4000)], "id long, source string, n_tokens long")
    targets = spark.createDataFrame([("m", "a", 0.5, 1, 1.0), ("m", "b", 0.5, 1, 1.0)], "mix_name string, source string, target_share double, max_repeats int, total_fraction double")
    drawn, _ = M.mix_sources(rows, targets, slot_tokens=20, least_slots=10)
    per = Counter()
    for r in drawn.collect():
        per[r["slot"]] += r["n_tokens"]
    assert len(per) >= 1990 and max(per.values()) <= 30


def test_mix_reaches_its_shares_and_caps(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "a", "a", "b", "c"]), rng.randint(1, 40)) for k in range(3000)] + [(3000, None, 5), (None, "a", 5), (3001, "a", 0)]
    targets = [("m", "a", 0.5, 1, 0.5), ("m", "b", 0.3, 4, 0.5), ("m", "c", 0.1, 1, 0.5), ("m", "gone", 0.1, 3, 0.5), ("n", "c", 1.0, 2, 2.0)]
    schema = "mix_name string, source string, target_share double, max_repeats int, total_fraction double"
    drawn, report = M.mix_sources(spark.createDataFrame(rows, "id long, source string, n_tokens long"), spark.createDataFrame(targets, schema), least_slots=1000)
    used = Counter((r["mix_name"], r["source"], r["id"]) for r in drawn.collect())
    cap = {(m, s): c for m, s, _, c, _ in targets}
    assert all(n <= cap[m, s] for (m, s, _), n in used.items())
    r = {(x["mix_name"], x["source"]): x for x in report.collect()}
    for s in "abc":
        assert r["m", s]["tokens"] == pytest.approx(r["m", s]["target_tokens"], rel=0.05)
    assert r["m", "gone"]["tokens"] == 0 and not r["m", "gone"]["reached"]
    # a source too small for its share is used up to its cap, and no more
    assert r["n", "c"]["tokens"] == 2 * r["n", "c"]["available_tokens"] and not r["n", "c"]["reached"]
    again = M.mix_sources(spark.createDataFrame(rows[::-1], "id long, source string, n_tokens long"), spark.createDataFrame(targets, schema), least_slots=1000)[0]
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, again.collect()))


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, "a" * 50)], "id long, t string")
    got = {r["id"]: r["n_tokens"] for r in T.token_counts(df, "id", "t").collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 1
    part = T.PART
    try:
        T.PART = 64
        assert abs(T.count_tokens("some words here " * 40) - len(T.encoding(T.VOCABULARY).encode_ordinary("some words here " * 40))) <= 12
    finally:
        T.PART = part


# -- problem 10

NAMES = [("Zoe", "given"), ("Hope", "given"), ("April", "given"), ("Pavel", "given"), ("Vondbrendez", "family"), ("Kazeil", "family")]
TEXTS = [
    ("Write to info [at] rount [dot] example for it.", ["email:info [at] rount [dot] example"]),
    ("Mail A.B+c@MAIL.Example, or a at b dot example today", ["email:A.B+c@MAIL.Example", "email:a at b dot example"]),
    ("They were the busiest months @ the ward.", []),
    ("Call me on +44 7700 900 876 after six. Tel. (428) 555-0142", ["phone:+44 7700 900 876", "phone:(428) 555-0142"]),
    ("07700 900996, 01 99 00 80 73, 761-555-0169, 863.555.0184", ["phone:07700 900996", "phone:01 99 00 80 73", "phone:761-555-0169", "phone:863.555.0184"]),
    ("The trial ran from 2019-03-15 to 2021-08-24; readings of 118/78. Batch 00-2430-27, ISSN-like code 1635-3521.", []),
    ("ID no. QQ 94 99 77 B. Passport 0037 5970 3741, XH6417673 and 000 40 6021, 00854841-Z", ["id_number:QQ 94 99 77 B", "id_number:0037 5970 3741", "id_number:XH6417673", "id_number:000 40 6021", "id_number:00854841-Z"]),
    ("I live at Flat 8, 202 Priar Road, Treintcombe. Or P.O. Box 293, Driarkholm.", ["address:Flat 8, 202 Priar Road, Treintcombe", "address:P.O. Box 293, Driarkholm"]),
    ("Adresse: 19 rue de Gial, 00561 Flandton. Ich wohne in Branweg 197, 00184 Laexby.", ["address:19 rue de Gial, 00561 Flandton", "address:Branweg 197, 00184 Laexby"]),
    ("My name is Pavel Viacialez. Nurse Vondbrendez told us how the visit went.", ["name:Pavel Viacialez", "name:Vondbrendez"]),
    ("May brought rain, and hope returned. Until April, rest. A grace period.", []),
    ("Patient: KAZEIL, Zoe; seen twice. I saw B. Vondbrendez last week and felt heard.", ["name:KAZEIL, Zoe", "name:B. Vondbrendez"]),
    ("Text 891\u2009555\u20090168 to cancel, or +44\u00a07700\u00a0900\u00a0876.", ["phone:891\u2009555\u20090168", "phone:+44\u00a07700\u00a0900\u00a0876"]),
    ("I live at P.O. Box 803, Hiavgcombe Zoe H. Niskivova told us how it went.", ["address:P.O. Box 803, Hiavgcombe", "name:Zoe H. Niskivova"]),
    ("The Hisby sign and the Thaexton test are named after places.", []),
    ("", []),
]


@pytest.mark.parametrize(("text", "want"), TEXTS)
def test_found(text, want):
    got = [f"{k}:{text[a:b]}" for a, b, k in N.Finder(NAMES).find(text)]
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="0123456789ABCxyz -+.", max_size=24))
def test_numbers_are_permuted_within_their_format(text):
    key = b"k"
    new = N.permute_number(text, key)
    assert N.permute_number(new, key, back=True) == text
    assert [("d" if c.isdigit() else "U" if c.isupper() else "l" if c.islower() else c) for c in new] == [("d" if c.isdigit() else "U" if c.isupper() else "l" if c.islower() else c) for c in text]


def test_permutations_are_one_to_one():
    assert len({N.permute_number(f"{k:03d}", b"k") for k in range(1000)}) == 1000
    assert N.permute_number("123 456", b"k") != N.permute_number("123 456", b"other")
    day = N.permute_date("1985-04-12", b"k")
    assert N.permute_date(day, b"k", back=True) == "1985-04-12" and N.permute_date("2500-01-01", b"k") == "2500-01-01"


def test_placeholders(spark):
    rows = [(1, "Call 07700 900996 or mail a@b.example."), (2, "Her number is 07700 900996!"), (3, None), (4, ""), (2, "Her number is 07700 900996!"), (5, "x" * 100_000 + " a@b.example")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kind", "2 as value")
    names = spark.createDataFrame(NAMES, "name string, name_kind string")
    got = {r["id"]: (r["text"], r["n_replaced"]) for r in N.without_personal(df, "doc_id", "text", b"k", names).collect()}
    phone = got[2][0].removeprefix("Her number is ").removesuffix("!")
    assert phone.startswith("[PHONE ") and phone in got[1][0] and got[1][0].startswith("Call [PHONE") and got[1][0].endswith("].")
    assert got[1][1] == 2 and got[3] == (None, 0) and got[4] == ("", 0) and got[5][1] == 1
    spans = N.personal_spans(df, "doc_id", "text", names).collect()
    assert all(r["value"] and r["end_pos"] - r["start_pos"] == len(r["value"]) for r in spans) and len(spans) == 5
    assert N.personal_spans(df.limit(0), "doc_id", "text").count() == 0


def test_a_name_found_by_its_title_is_found_again():
    text = "We saw Dr Quillon in spring. Later Quillon said to rest, and Quillon's notes agree."
    assert [a for a, _, k in N.Finder([]).find(text) if k == "name"] == [m.start() for m in re.finditer("Quillon", text)]


@pytest.mark.parametrize(
    ("kind", "spellings"),
    [
        ("email", ["anna.k@mail.org", "Anna.K@MAIL.org", "anna.k [at] mail [dot] org", "anna.k (at) mail (dot) org", "anna.k at mail dot org", "anna.k＠mail.org"]),
        ("name", ["Pavel Viacialez", "VIACIALEZ, Pavel", "pavel  viacialez"]),
        ("address", ["202 Priar Road, Treintcombe", "202 Priar Rd Treintcombe", "202 PRIAR ROAD,\nTreintcombe"]),
    ],
)
def test_spellings_of_one_value_have_one_pseudonym(kind, spellings):
    assert len({N.pseudonym(kind, x, b"k") for x in spellings}) == 1
    assert len(N.pseudonym(kind, spellings[0], b"k")) == 32
    assert N.pseudonym(kind, spellings[0], b"k") != N.pseudonym(kind, spellings[0], b"other") != N.pseudonym(kind, "x" + spellings[0], b"other")


def test_a_telephone_number_is_linked_with_and_without_its_country_code():
    spelled = ["+44 7700 900 876", "07700 900876", "0044 7700900876", "+44 (0)7700 900876", "07700-900-876"]
    new = [N.pseudonym("phone", x, b"k") for x in spelled]
    tails = {re.sub(r"\D", "", x)[-10:] for x in new}
    assert len(tails) == 1 and tails != {"7700900876"}
    assert new[0].startswith("+44 ") and new[1].startswith("0") and [len(x) for x in new] == [len(x) for x in spelled]
    assert len({N.permute_phone(f"0{k}", b"k") for k in range(1000, 10000)}) == 9000


CHECKED = {"iban": "GB82 WEST 1234 5698 7654 32", "luhn": "4539 1488 0343 6467", "nhs": "943 476 5919", "dni": "12345678Z", "nir": "2 55 08 14 168 025 38"}


@pytest.mark.parametrize("kind", CHECKED)
def test_check_digits_hold_before_and_after(kind):
    text = CHECKED[kind]
    new = N.permute_identity(text, b"k")
    assert N.check_kind(text) == kind == N.check_kind(new) and new != text
    assert [c.isalnum() for c in new] == [c.isalnum() for c in text]
    last = "1" if text[-1] != "1" else "2"
    assert N.check_kind(text[:-1] + last) is None or kind == "nir"
    assert N.permute_identity(re.sub(r"\W", "", text), b"k") == re.sub(r"\W", "", new)


def test_checked_numbers_are_found_without_a_cue():
    text = "It was paid from GB82 WEST 1234 5698 7654 32 with 4539148803436467, not 4539148803436468."
    assert [(k, text[a:b]) for a, b, k in N.Finder([]).find(text)] == [("id_number", "GB82 WEST 1234 5698 7654 32"), ("id_number", "4539148803436467")]


def test_places_before_a_verb_are_no_persons():
    text = "The doctor in Flalstaelby wrote it down. Olumide Adeyemi told us so. Before that Brankova asked for help."
    assert [text[a:b] for a, b, k in N.Finder([]).find(text)] == ["Olumide Adeyemi", "Brankova"]
