"""Problems 1, 2 and 6."""

import random
import re

import numpy as np
import pandas as pd
import pytest

from textloom.llm import cross_split as X
from textloom.llm import eval_leaks as L
from textloom.llm import pairs as P
from textloom.llm.common import lcs_length, words

WORDS = [f"{a}{b}" for a in ("ba", "ke", "li", "mo", "nu", "pa", "re", "si") for b in ("ton", "ver", "lim", "dor", "kas", "pen", "rus", "tal", "mek", "fin")]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_words():
    assert words("Cafés​x, SO­FT 1½ Ａb_c") == ["cafésx", "soft", "11", "2", "ab", "c"]
    assert words(None) == words("") == words("​ ...") == []


def test_lcs_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert lcs_length(a, b) == lcs(a, b)


def corpus(rng, n):
    rows = []
    for k in range(n):
        size = rng.choice([3, 8, 21, 24, 26, 60, 90])
        rows.append((f"i{k}", rng.choice(["train", " Train", "safety_train", "test", "VALIDATION", None, "other"]), " ".join(rng.choice(WORDS) for _ in range(size))))
    for k in range(n):
        text = rng.choice(rows)[2].split()
        for _ in range(rng.randint(0, max(1, len(text) // 9))):
            at = rng.randrange(len(text))
            op = rng.random()
            text[at : at + 1] = [] if op < 0.3 else [rng.choice(WORDS)] if op < 0.7 else [text[at], rng.choice(WORDS)]
            text = text or ["x"]
        rows.append((f"n{k}", rng.choice(["train", "test", "validation"]), rng.choice([" ", ", "]).join(text).capitalize()))
    return rows


def brute(rows):
    out = set()
    side = {"train": 2, "safety_train": 2, "test": 1, "validation": 1}
    split = [(i, side.get((s or "").strip().lower()), words(t)) for i, s, t in rows]
    for i, s, a in split:
        for j, u, b in split:
            if s == 1 and u == 2 and a and b and i != j and lcs_length(a, b) >= 0.8 * max(len(a), len(b)) - 1e-9:
                out.add((min(i, j), max(i, j)))
    return out


def test_cross_split_equals_brute_force(spark):
    rows = corpus(random.Random(5), 150)
    rows += [("e1", "test", ""), ("e2", "train", None), ("e3", "test", "..."), rows[0], rows[0], ("i0", "test", rows[3][2])]
    rows += [("long1", "test", " ".join(WORDS * 60)), ("long2", "train", " ".join(WORDS * 60 + ["more"]))]
    df = spark.createDataFrame(rows, "id string, split string, text string")
    got = [tuple(r) for r in X.cross_split_pairs(df.selectExpr("*", "1 as words", "2 as side"), "id", "text", "split").collect()]
    assert len(got) == len(set(got))
    want = brute(rows)
    assert set(got) <= want
    # texts of up to SHORT words are covered without loss; longer ones by three-word shingles
    missed = want - set(got)
    assert len(missed) <= 0.02 * len(want), missed
    sizes = {i: len(words(t)) for i, _, t in rows}
    assert all(max(sizes[a], sizes[b]) > X.SHORT for a, b in missed)


def test_cross_split_of_one_hot_text(spark):
    rows = [(f"t{k}", "train", "one same text of seven words here") for k in range(60)] + [(f"e{k}", "test", "One same text of seven words, here!") for k in range(5)]
    df = spark.createDataFrame(rows, "id string, split string, text string")
    links, members = X.cross_split_links(df, "id", "text", "split")
    assert links.count() == 1 and members.count() == 65
    assert X.cross_split_pairs(df, "id", "text", "split").count() == 300
    assert X.cross_split_pairs(df.where("split = 'test'"), "id", "text", "split").count() == 0
    assert X.cross_split_pairs(df.limit(0), "id", "text", "split").count() == 0


def test_long_lists_are_cut_into_a_grid(spark, monkeypatch):
    rng = random.Random(8)
    rows = corpus(rng, 60)
    df = spark.createDataFrame(rows, "id string, split string, text string")
    want = {tuple(r) for r in X.cross_split_pairs(df, "id", "text", "split").collect()}

    class Table:
        value = np.full(X.TABLE, 3 * X.LIST, np.uint32)

    side = {"train": 2, "safety_train": 2, "test": 1, "validation": 1}
    pdf = pd.DataFrame([(side[(s or "").strip().lower()], t) for _, s, t in rows if (s or "").strip().lower() in side], columns=["side", "text"])
    lists = pd.concat(list(X._lists(iter([pdf]), Table, 5))).sort_values("bucket")
    pairs = {tuple(map(int, r)) for p in X._pairs(iter([lists])) for r in p.to_numpy()}
    key = {i: X.class_key(words(t))[0] >> 24 for i, _, t in rows if words(t)}
    where = {i: side.get((s or "").strip().lower()) for i, s, _ in rows}
    for a, b in want:
        e, t = (a, b) if where[a] == 1 else (b, a)
        assert (key[e], key[t]) in pairs


def edited_at_random(seed=20):
    """Pairs with exactly a fifth of the words changed, at random places, some of them of repeated passages."""
    rng = random.Random(seed)
    rows = []
    for n in (60, 100, 200):
        for k in range(25):
            text = [rng.choice(WORDS) for _ in range(n)] if k % 5 else [rng.choice(WORDS) for _ in range(n // 4)] * 4
            rows.append((f"e{n}_{k}", "test", " ".join(text)))
            for at in rng.sample(range(n), n // 5):
                text[at] = f"new{at}"
            rows.append((f"t{n}_{k}", "train", " ".join(text)))
    return rows


def test_a_fifth_changed_at_random_is_found(spark):
    rows = edited_at_random()
    df = spark.createDataFrame(rows, "id string, split string, text string")
    want = brute(rows)
    assert len(want) >= 75
    assert {tuple(r) for r in X.cross_split_pairs(df, "id", "text", "split").collect()} == want


def test_the_weighted_cosine_never_falls_below_its_bound():
    """For pairs of the definition, whatever the frequencies; and the prefix is where the residual norm says."""
    rng = random.Random(7)
    a, b = [], []
    for _ in range(300):
        n = rng.choice([3, 5, 10, 40, 90])
        x = [rng.choice(WORDS) + str(rng.randrange(3)) for _ in range(n)]
        y = list(x)
        for k in rng.sample(range(n), n - -(-4 * n // 5)):
            y[k] = f"new{rng.randrange(10**6)}"
        a.append(x)
        b.append(y)
    for seed in range(3):
        freq = np.minimum(np.random.default_rng(seed).zipf(1.3, X.TABLE), 10**6)
        cosine, least = X.cosines(a, b, freq, X.WordHashes())
        assert (cosine >= least - 1e-9).all() and least.min() < 0.8 < cosine.max()
        # by hand for one pair
        d, t, w, norm, rest = X._weighted(X._Texts(X.WordHashes(), a[:1]), freq, float(freq.sum()))
        missing = len(a[0]) - -(-4 * len(a[0]) // 5)
        assert rest[0] == pytest.approx(1 - np.sort(w)[::-1][:missing].sum() / w.sum())
        left = 1 - np.cumsum(np.sort(w)[::-1]) / w.sum()  # of the norm behind each term, by falling weight
        assert (left >= rest[0] - 1e-12).sum() == missing


def test_lists_as_matrices_lose_nothing(monkeypatch):
    monkeypatch.setattr(X, "DENSE", 1)
    monkeypatch.setattr(X, "TILE", 8)
    rows = edited_at_random(21) + corpus(random.Random(9), 60) + [("long1", "test", " ".join(WORDS * 60)), ("long2", "train", " ".join(WORDS * 60 + ["more"]))]

    class Table:
        value = np.full(X.TABLE, 3, np.uint32)

    side = {"train": 2, "safety_train": 2, "test": 1, "validation": 1}
    pdf = pd.DataFrame([(side[(s or "").strip().lower()], t) for _, s, t in rows if (s or "").strip().lower() in side], columns=["side", "text"])
    lists = pd.concat(list(X._lists(iter([pdf]), Table, 5))).sort_values("bucket")
    pairs = {tuple(map(int, r)) for p in X._pairs(iter([lists])) for r in p.to_numpy()}
    key = {i: X.class_key(words(t))[0] >> 24 for i, _, t in rows if words(t)}
    where = {i: side.get((s or "").strip().lower()) for i, s, _ in rows}
    for a, b in brute(rows):
        e, t = (a, b) if where[a] == 1 else (b, a)
        assert (key[e], key[t]) in pairs


def test_report_counts_records(spark):
    rows = [("a", "test", "x", "alpha beta gamma delta"), ("b", "train", "x", "alpha beta gamma delta"), ("c", "validation", "y", "Alpha, beta gamma delta"), ("d", "test", "y", "nothing like it at all")]
    df = spark.createDataFrame(rows, "id string, split string, origin string, text string")
    got = {tuple(r) for r in X.cross_split_report(df, "id", "text", "split", "origin").collect()}
    assert got == {("test", "x", 1, 1, 1), ("validation", "y", 1, 1, 1)}


# -- problem 6


def test_leaks_equal_brute_force(spark):
    rng = random.Random(2)
    items = [(f"b{k}", " ".join(rng.choice(WORDS) for _ in range(rng.choice([6, 12, 25])))) for k in range(12)] + [("empty", ""), ("null", None)]
    rows = []
    for k in range(120):
        text = [rng.choice(WORDS) for _ in range(rng.choice([5, 40, 120]))]
        src = rng.choice(items[:12])[1].split()
        n = rng.choice([0, 9, 10, 11, len(src)])
        at = rng.randint(0, max(0, len(src) - n))
        put = rng.randint(0, len(text))
        text[put:put] = src[at : at + n]
        rows.append((f"r{k}", " ".join(text).title() if k % 2 else None, None if k % 2 else ", ".join(text)))
    rows += rows[:3]
    got = L.item_leaks(spark.createDataFrame(rows, "id string, q string, a string"), "id", ["q", "a"], spark.createDataFrame(items, "b string, t string"), "b", "t").collect()
    found = {(r["id"], r["item"]) for r in got if r["run"] >= 10}
    want = set()
    for i, q, a in rows:
        for b, t in items:
            w = words(t)
            grams = {tuple(w[k : k + 10]) for k in range(len(w) - 9)}
            for f in (q, a):
                v = words(f)
                if any(tuple(v[k : k + 10]) in grams for k in range(len(v) - 9)):
                    want.add((i, b))
    assert found == want
    assert len(got) == len({(r["id"], r["field"], r["item"]) for r in got})


def edited(rng, w, n):
    """The words with ``n`` of them replaced, put in or left out."""
    w = list(w)
    for _ in range(n):
        at = rng.randrange(len(w))
        w[at : at + 1] = rng.choice([[f"new{rng.randrange(10**9)}"], [], [w[at], f"new{rng.randrange(10**9)}"]])
    return w


@pytest.mark.parametrize(("size", "edits"), [(10, 1), (10, 2), (5, 1), (8, 1)])
def test_recall_of_edited_windows(spark, size, edits):
    """Items of one window, so that no whole window survives the edits; all within the distance by brute force."""
    rng = random.Random(size * 10 + edits)
    items = [(f"b{k}", " ".join(f"{rng.choice(WORDS)}{rng.randrange(50)}" for _ in range(size))) for k in range(300)]
    rows = [(b, " ".join([rng.choice(WORDS) for _ in range(20)] + edited(rng, t.split(), edits) + [rng.choice(WORDS) for _ in range(20)])) for b, t in items]
    most = L.edits_allowed(size)
    want = set()
    for (b, t), (_, text) in zip(items, rows, strict=True):
        w, v = t.split(), text.split()
        if any(L.edit_distance(w, v[k : k + size], most) <= most for k in range(len(v) - size + 1)):
            want.add(b)
    got = L.item_leaks(spark.createDataFrame(rows, "id string, t string"), "id", ["t"], spark.createDataFrame(items, "b string, t string"), "b", "t").collect()
    found = {r["id"] for r in got if r["id"] == r["item"]}
    assert len(want) >= 100 and found <= want
    assert len(found) >= L.TARGET * len(want)


def test_short_items_are_found_inside_long_texts(spark):
    items = [("four", "rest for two days"), ("five", "pain after each night shift"), ("one", "zyx")]
    rows = [("a", "She wrote that pain after each night shift is worse, and that rest for two days did not help her."), ("b", "pain after every night shift was worse"), ("c", "rest for three days"), ("d", "zyx")]
    got = L.item_leaks(spark.createDataFrame(rows, "id string, t string"), "id", ["t"], spark.createDataFrame(items, "b string, t string"), "b", "t").collect()
    assert {(r["id"], r["item"], r["edits"]) for r in got} == {("a", "four", 0), ("a", "five", 0), ("b", "five", 1), ("d", "one", 0)}


def test_edit_of_long_items_leaves_no_whole_window(spark):
    """Every sixth word of 24 changed: all windows hold an edit."""
    rng = random.Random(4)
    items = [(f"b{k}", " ".join(f"{rng.choice(WORDS)}{rng.randrange(50)}" for _ in range(24))) for k in range(60)]
    rows = [(b, " ".join(f"new{k}" if k % 6 == 5 else x for k, x in enumerate(t.split()))) for b, t in items]
    got = L.item_leaks(spark.createDataFrame(rows, "id string, t string"), "id", ["t"], spark.createDataFrame(items, "b string, t string"), "b", "t").collect()
    assert len({r["id"] for r in got if r["id"] == r["item"]}) >= 0.95 * len(items)
    assert all(r["run"] == 5 for r in got if r["id"] == r["item"])


def test_leaks_of_nothing(spark):
    rows, items = spark.createDataFrame([("r", "a b c")], "id string, t string"), spark.createDataFrame([("b", "x y")], "b string, t string")
    assert L.item_leaks(rows, "id", ["t"], items.limit(0), "b", "t").count() == 0
    assert L.item_leaks(rows.limit(0), "id", ["t"], items, "b", "t").count() == 0


def test_equal_windows_have_equal_keys_anywhere():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 2**63, 60).astype(np.uint64)
    w[40:50] = w[5:15]
    for r in range(20):
        k = L.keys(w, np.array([5, 40]), 10, r)
        assert k[0] == k[1]


# -- problem 2

QUESTION = "I have had headaches since I turned 36, and coffee does not help. My sister told me this is usual. Is that right?"
ANSWER = "Headaches can follow a change in sleep. Please keep a note of the days with headaches until the visit. Rest and fluids help many people with this."


def many(n=300):
    rng = random.Random(9)
    topics = ["headaches", "cramps", "nausea", "tiredness", "spotting", "bleeding", "dizziness"]
    places = ["the clinic", "a nurse", "the ward", "a midwife"]
    other = {
        "fr": ("Depuis des jours, je dors mal à cause des {}. Est-ce que c'est normal pour une femme ?", "Les {} peuvent suivre un accouchement. Notez les jours avec des {} jusqu'à la visite chez le médecin. Le repos est utile pour vous."),
        "de": ("Ich habe seit Tagen {} und kann nicht schlafen. Ist das normal?", "Bei {} gehen Sie bitte zu der Praxis. Schreiben Sie die Tage mit {} bis dahin auf. Wärme kann auch helfen, und das ist nicht schlimm."),
    }
    rows = []
    for k in range(n):
        t, u, p = rng.choice(topics), rng.choice(topics), rng.choice(places)
        if k % 5 == 0:
            q, a = other[rng.choice(["fr", "de"])]
            rows.append((f"x{k}", q.format(t), a.format(t, u)))
        else:
            rows.append((f"x{k}", f"I have had {t} for {rng.randint(2, 40)} days and {u} since I moved. My sister told me that this is usual.", f"{t.capitalize()} can follow a change in {u}. Please keep a note of the {t} until the visit. Ask {p} about it within {rng.randint(2, 30)} days, and rest as much as you can."))
    return rows


CASES = [
    (ANSWER, None),
    (ANSWER + " Take care", None),
    (ANSWER + " Hope this helps 🌸", None),
    (ANSWER + "\n- keep warm and rest\n- note each day of headaches\n- see a nurse within 5 days", None),
    ("I cannot examine you here, but some points may help. " + ANSWER, None),
    ("You wrote: " + QUESTION + " " + ANSWER, None),
    (None, "empty"),
    ("", "empty"),
    ("​ \n", "empty"),
    ("N/A", "empty"),
    ("[no answer]", "empty"),
    ("...", "empty"),
    (QUESTION, "copied"),
    ("You asked: " + QUESTION.replace("I ", "you ").replace("My", "Your"), "copied"),
    (QUESTION + " " + QUESTION, "copied"),
    ("I'm sorry, but I can't help with that.", "refusal"),
    ("Unfortunately, I must decline this request. Please ask about something else.", "refusal"),
    ("Les céphalées peuvent suivre un accouchement. Notez les jours avec des crampes jusqu'à la visite chez le médecin.", "wrong_language"),
    ("Bei Schwindel gehen Sie bitte noch heute in die Praxis. Schreiben Sie die Tage mit Krämpfen bis dahin auf.", "wrong_language"),
    (ANSWER + " Please keep a note of the", "truncated"),
    (ANSWER + " Headaches can follow a chan", "truncated"),
    (ANSWER + " Ask a nurse (within", "truncated"),
]


@pytest.fixture(scope="module")
def defects(spark):
    rows = many() + [(f"case{k}", QUESTION, a) for k, (a, _) in enumerate(CASES)] + [("noq", None, ANSWER), ("case0", QUESTION, ANSWER), ("odd", "", None)]
    df = spark.createDataFrame(rows, "id string, q string, a string").selectExpr("*", "'x' as defect", "'y' as question")
    got = P.pair_defects(df, "id", "q", "a").collect()
    assert len(got) == len({r["id"] for r in got})
    return {r["id"]: r["defect"] for r in got}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_defects(defects, k):
    assert defects.get(f"case{k}") == CASES[k][1]


def test_sound_pairs_stay(defects):
    assert sum(i.startswith("x") for i in defects) <= 3
    assert "noq" not in defects and defects["odd"] == "empty"


def test_empty_table(spark):
    assert P.pair_defects(spark.createDataFrame([], "id string, q string, a string"), "id", "q", "a").count() == 0


def tables(texts):
    t = P.Tables()
    for (k, place), n in P.counted(texts).items():
        t.counts[k, place] += n
    return t


def test_held_out_tags():
    rows = [(q, a) for _, q, a in many(600)]
    reader = P.Reader(tables([a for _, a in rows[:400]]))

    def read(rows, seed):
        return [(reader.features(q, p, P.counted([a]) if a else None)[0], y) for q, p, y, a in P.examples(rows, seed=seed)]

    field = P.Field.fit(read(rows[:400], 7))
    test = read(rows[400:], 1)
    right = [np.array(y) == t for (_, y), t in zip(test, field.tag([x for x, _ in test]), strict=True)]
    assert np.concatenate(right).mean() >= 0.95


def test_tables_count_all_rows_as_a_dictionary_does(spark):
    rows = many(80) + [("n", None, None), ("e", "", " ")]
    df = spark.createDataFrame(rows, "id string, question string, answer string").repartition(5)
    got = P.learn_tables(df).counts
    assert (got == tables([t for _, q, a in rows for t in (q, a) if t]).counts).all()
    # by plain counting: words, and how often "visit" ends a sentence
    said = [re.split(r"(?<=[.?])\s+", t) for _, q, a in rows for t in (q, a) if t]
    words = [w.strip(P._MARKS).lower() for s in said for c in s if c.endswith((".", "?")) for w in c.split()]
    h = P._place(P._mixed(P.WordHashes()["headaches"]))
    assert got[2, h] >= words.count("headaches") > 0
    assert got[0].sum() + got[1].sum() == sum(max(0, n - k + 1) for s in said for c in s if c.endswith((".", "?")) for n in [len(P._masked(c))] for k in (1, 2, 3))
    assert got[3, P._beginning("heada")] >= words.count("headaches")


def test_clauses_keep_abbreviations_and_decimals():
    assert len(P.clauses("Use 3.5 mg, e.g. after meals. Then rest!\n- one\n- two")) == 4
    assert re.sub(r"\s", "", "".join(P.clauses("A b. C d?"))) == "Ab.Cd?"
