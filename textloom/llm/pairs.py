"""Problem 2: prompt and response pairs whose response is no usable reply.

The response is cut into clauses; a linear-chain conditional random field tags each clause as
answer, refusal, echo of the question, foreign (another language than the question) or
unfinished; the tags' coverage of the response, in words, decides the pair's defect.

How often words and groups of up to three words stand inside and at the end of sentences, which words
there are and which beginnings they have is counted over all questions and answers, by task, into
tables of fixed size that are then added up.

The field's weights alone are fitted on a bounded sample (``FIT_ROWS`` pairs, the smallest by a hash
of the id). No labels are needed: pairs that look sound are turned into each defect, and into sound
look-alikes, by known changes -- cutting the end off, pasting the own question, borrowing a reply in
another language, putting a refusal in place -- so every clause's tag is known. What a changed pair
itself added to the tables is taken off before its features are read, as a defective pair adds nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_pandas, ship
from .common import INVISIBLE, WordHashes, fold, mix, summed_tables, table_blocks

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)
FIT_ROWS = 2000
BITS = 20  #: of a place in the tables of sentence ends, words and beginnings
LETTERS = 32  #: of a word's beginning at most
OFTEN = 5  #: a beginning of words counts from this many on

# Common words by language, each in one list only.
FUNCTION_WORDS = {
    "en": "the and of for with after may you your is to by which are be this that it if can my i have was not will at they who should before from or as do how what when than",
    "es": "el los del con por para una se puede tras y que mi más como está cada sobre según sin cuando hay al lo muy pero usted si días noches unas cerca aunque esto",
    "fr": "le les des du et pour avec par peut vous votre au chez je j ai mes est une sur dans d c il ce pas aux qui ou mais cela jours sont après plus selon",
    "de": "der die das und mit nach ein eine von zu auf sie ich ist im den bei nicht am für einen mein dem oder wird kann gilt sind es seit ab aus bitte an auch",
}
# Person words that a repetition of a question may change.
SAME_PERSON = (
    "i you he she we they ich sie er wir du je j tu vous nous yo usted tú",
    "my your his her our mein meine meinen meinem meiner ihr ihre ihren ihrem ihrer dein deine mon ma mes votre vos ton ta tes mi mis su sus tu",
    "me him us them mich mir ihnen dich dir m moi te t le les se",
    "am are is m re was were bin sind ist war waren suis êtes est soy es estoy está",
    "have has had ve habe haben hat hatte hatten ai avez a avais aviez he ha tengo tiene",
)
# Declining phrases, and the polite phrases around them, by language.
DECLINE = (
    r"(?:can\s?not|can'?t|can not|unable to|not able to|won'?t|will not|not (?:allowed|permitted) to|must decline to|have to decline to|decline to|refuse to|not comfortable|don'?t feel comfortable|would rather not|prefer not to|not in a position to|isn'?t possible for me to|is not possible for me to|not possible to)\W+(?:\w+\W+){0,3}?(?:help|assist|answer|respond|responding|reply|replying|comply|discuss|discussing|comment|advise|provide|say|talk|speak|fulfil|support|give|offer|share)",
    r"(?:must|have to|need to|going to) (?:decline|refuse)", r"no (?:answer|reply|response|comment|advice) (?:can be|is) (?:given|possible|available)", r"i decline|i refuse", r"told not to|instructed not to|(?:falls?|lies|is|are) (?:outside|beyond) (?:of )?(?:what|my)|outside what i may",
    r"no (?:puedo|podemos|me es posible|me está permitido|estoy en condiciones de|soy capaz de|se me permite|deseo|quiero)\W+(?:\w+\W+){0,2}?(?:ayudar\w*|responder\w*|contestar\w*|opinar|hablar|comentar|atender|dar|ofrecer|asistir\w*|decir)", r"(?:debo|tengo que|prefiero) (?:rechazar|declinar|no (?:hablar|responder|opinar|contestar))", r"no es posible (?:responder|contestar|dar)", r"fuera de lo que|me han (?:pedido|dicho|indicado) (?:que )?no",
    r"(?:ne (?:peux|puis|pouvons|suis|sommes)) pas (?:\w+\W+){0,6}?(?:aider|répondre|traiter|commenter|parler|donner|dire|conseiller|autorisée?)", r"(?:dois|préfère|souhaite|refuse|refuser|décline|décliner)\W+(?:de |d')?(?:\w+\W+){0,2}?(?:ne pas|refuser|décliner|cette demande|répondre)", r"préfère ne pas", r"(?:il )?(?:ne )?m'est (?:pas )?(?:im)?possible de (?:répondre|vous aider)", r"aucune réponse (?:ne peut|n'est)", r"(?:sort|dépasse|hors) (?:du cadre|de ce que|ce que)|m'a(?: été)? demandé de ne pas",
    r"(?:kann|können|darf|dürfen|möchte|will|werde)\W+(?:\w+\W+){0,4}?(?:nicht|nichts|keine?)\W+(?:\w+\W+){0,3}?(?:helfen|antworten|beantworten|sagen|weiterhelfen|geben|äußern|unterstützen)", r"(?:muss|müssen|möchte)\W+(?:\w+\W+){0,4}?ablehnen", r"(?:antwort|hilfe|auskunft)\w*\W+(?:\w+\W+){0,2}?nicht möglich", r"lehne\W+(?:\w+\W+){0,4}?ab", r"außerhalb dessen|angewiesen,? (?:\w+\W+){0,4}?nicht",
)
POLITE = (
    r"i am sorry|i'm sorry|apologies|i apologi[sz]e|regrettably|unfortunately|thank you for asking|as an? (?:\w+ )?(?:assistant|ai|model)|ask about something else|anything else you|something else i can|i hope you understand|my guidelines|my rules|my policy",
    r"lo siento|lamentablemente|disculpe|pregunte otra cosa|otra cosa|mis normas|mis reglas|como asistente|gracias por preguntar",
    r"désolée?|malheureusement|je regrette|en tant qu'assistante?|autre question|autre chose|mes consignes|mes règles",
    r"tut mir leid|leider|als assistenz|als assistent|etwas anderes|meine vorgaben|meine regeln|entschuldigung|bedaure",
)
CAVEATS = ("I cannot examine you here, but some points may help.", "I can't give a diagnosis, but here is what is known.", "I am not able to see you, so please treat this as general advice.", "No puedo examinarla aquí, pero algunos puntos pueden servir.", "Je ne peux pas vous examiner ici, mais quelques points peuvent aider.", "Ich kann Sie hier nicht untersuchen, aber einige Punkte können helfen.")
REFUSALS = {
    "en": ("I can't help with that", "I'm unable to assist with health questions", "I must decline this request", "I am not able to answer this", "It isn't possible for me to respond to this", "I don't feel comfortable replying to that", "No answer can be given here", "I cannot discuss this topic"),
    "es": ("No puedo ayudar con eso", "Debo rechazar esta pregunta", "No me es posible opinar", "No puedo responder a eso"),
    "fr": ("Je ne peux pas vous aider", "Je ne suis pas en mesure de répondre", "Je préfère ne pas en parler", "Je dois refuser cette demande"),
    "de": ("Ich muss diese Anfrage ablehnen", "Eine Antwort ist mir nicht möglich", "Ich kann dabei nicht helfen", "Ich darf dazu nichts sagen"),
}
TAILS = {"en": ("Please ask about something else.", "Is there anything else you want to talk about?"), "es": ("Pregunte otra cosa.",), "fr": ("Posez une autre question.",), "de": ("Bitte fragen Sie etwas anderes.",)}
LEADS = {"en": ("I am sorry.", "Unfortunately, ", "As an assistant, ", "Thank you for asking, but "), "es": ("Lo siento, ",), "fr": ("Désolé, ", "Malheureusement, "), "de": ("Leider gilt: ", "Es tut mir leid, ")}
CLOSINGS = ("Take care", "Hope this helps 🌸", "Wishing you well", "Best wishes, the team", "(this holds for adults only)", "Mit freundlichen Grüßen", "Cordialement", "Un saludo", "All the best", "Get well soon")
# What stands where an answer is missing.
STAND_INS = {"n a", "na", "none", "null", "nil", "nan", "tbd", "todo", "tba", "no answer", "no response", "no reply", "empty", "blank", "missing", "undefined", "not available", "not answered", "unanswered", "pending", "placeholder", "answer", "response", "reply", "keine antwort", "keine", "sin respuesta", "ninguna", "aucune réponse", "sans réponse", "vide", "leer", "vacío", "error", "xxx", "unknown", "to do", "coming soon", "no data"}

_LANG = {}
for _k, (_name, _list) in enumerate(FUNCTION_WORDS.items()):
    for _w in _list.split():
        _LANG[_w] = -1 if _w in _LANG else _k
_LANG = {w: k for w, k in _LANG.items() if k >= 0}
_PERSON = {w: f"§{k}" for k, group in reversed(list(enumerate(SAME_PERSON))) for w in group.split()}
_DECLINE = re.compile("|".join(DECLINE))
#: one of these stands in whatever the patterns match: a quick test before them
_DECLINE_STEMS = ("not", "n't", "cant", "wont", "dont", "isnt", "no ", "unable", "declin", "refus", "rather", "outside", "beyond", "rechazar", "prefier", "fuera", " pas", "préfère", "souhait", "aucune", "sort ", "dépasse", "hors ", "possible", "m'a ", "nicht", "kein", "ablehn", "lehne", "möglich", "außerhalb", "angewiesen", "han ")
_POLITE = re.compile("|".join(POLITE))
_BUT = re.compile(r"\b(?:but|however|still|pero|sin embargo|mais|aber|jedoch|so please)\b(?=\W+\w+\W+\w+)")
_STOP = re.compile(r"[.!?…]+[\"'»”’)\]]*(?=\s|$)")
_SHORT = re.compile(r"(?:\b(?:e\.g|i\.e|dr|mr|mrs|ms|prof|approx|vs|cf|fig|no|nr|bzw|ca|z\.b|d\.h|p\.ej|sra?|etc|st)|^[ \t]*\d{1,2})\.$", re.I)
_TOKEN = re.compile(r"[^\W_]+")
_STOPPED = re.compile(r"(?<!\.\.)[.!?][\"'»”’)\]\s]*$")
_LIST = re.compile(r"^\s*(?:[-•*–—]|\d{1,2}[.)])\s+\S")
_DANGLING = re.compile(r"[,;:\-–—(\[«“]$|(?:\.\.\.|…)[\"'»”’)\]\s]*$|\s\"$")
_OPENERS = {")": "(", "]": "[", "»": "«", "”": "“"}
_CLOSING = re.compile(
    r"^\W*(?:(?:i )?hope (?:this|that|it)|(?:with )?(?:best|kind|warm|many|all the best)\b|wishing|take (?:good )?care|yours|regards|get well|good luck"
    r"|mit freundlichen|viele grüße|alles gute|gute besserung|cordialement|bien à vous|bon courage|bon rétablissement|en espérant|(?:un )?saludos?|atentamente|que se mejore|cuídese|espero que|suerte)|[\u2600-\u27bf\U0001f300-\U0001faff]\ufe0f?\s*$"
)

#: a remark in brackets that are closed
_REMARK = re.compile(r"^[(\[][^()\[\]]+[)\]]$")


def clauses(text: str) -> list[str]:
    """Sentences and lines; abbreviations, numbers of list entries and decimals do not end one."""
    out = []
    for line in text.split("\n"):
        at = 0
        for m in _STOP.finditer(line):
            end = m.end()
            if m[0] == "." and end < len(line) and _SHORT.search(line, max(0, end - 7), end):
                continue
            if c := line[at:end].strip():
                out.append(c)
            at = end
        if c := line[at:].strip():
            out.append(c)
    return out


def language(tokens) -> list[int]:
    """Common words of each language."""
    found = [_LANG[w] for w in tokens if w in _LANG]
    return [found.count(k) for k in range(4)]


def _open(text: str) -> bool:
    """A bracket, quotation or quotation mark is not closed."""
    stack = 0
    for close, opener in _OPENERS.items():
        stack += text.count(opener) > text.count(close)
    return stack > 0 or text.count('"') % 2 == 1


_MARKS = ".,;:!?()[]\"«»“”…"


_M64 = (1 << 64) - 1


def _mixed(x: int) -> int:
    """``mix`` of one number."""
    x = (x ^ (x >> 31)) * 0x9E3779B97F4A7C15 & _M64
    return x ^ (x >> 29)


def _place(h: int) -> int:
    return h >> (64 - BITS)


def _beginning(word: str) -> int:
    """The place of a beginning of words."""
    h = 0
    for c in word[:LETTERS]:
        h = _mixed((h * 0x100000001B3 + ord(c)) & _M64)
    return _place(h)


def _group(hashes: list[int]) -> int:
    """The hash of a group of words, its last word first."""
    h = len(hashes)
    for x in reversed(hashes):
        h = _mixed((h * 0x100000001B3 + x) & _M64)
    return h


def _masked(clause: str) -> list[str]:
    """Lower-case words without marks; numbers as ``#``, capitalised words but the first as ``X``."""
    out = []
    for w in clause.split():
        w = w.strip(_MARKS)
        if w:
            out.append("#" if w[0].isdigit() else "X" if out and w[0].isupper() else w.lower())
    return out


#: features of a clause, in order
FEATURES = ("bias", "declines", "declines_but", "polite", "echo>=.9", "echo>=.6", "echo>=.35", "short", "foreign", "foreign_much", "own", "last", "last_stopped", "last_list", "last_dangling", "last_open", "last_end_likely", "last_end_unlikely", "last_rare_word", "last_closing", "first", "last_short_list", "last_cut", "last_cut_rare", "last_cut_unseen", "last_cut_unseen3", "last_cut_prefix")
_F = {n: k for k, n in enumerate(FEATURES)}


class Tables:
    """Counts by place of a hash: word groups ``inside`` and at the ``end`` of stopped clauses, ``words``, and ``starts`` of words."""

    NAMES = ("inside", "end", "words", "starts")

    def __init__(self, counts: np.ndarray | None = None):
        self.counts = np.zeros((len(self.NAMES), 1 << BITS), np.int64) if counts is None else counts

    def get(self, name: str, place: int, less: Counter | None = None) -> int:
        k = self.NAMES.index(name)
        n = int(self.counts[k, place])
        return n - less[k, place] if less else n


class Learner:
    """Adds texts to tables; words are looked up once and remembered."""

    def __init__(self):
        self.hashes, self.known, self.raw = WordHashes(), {}, []
        self.seen: Counter = Counter()

    def _word(self, w: str) -> int:
        """Number of a word as it stands: its hashes as first word of a clause, within one, and plain."""
        w_ = w.strip(_MARKS)
        low = w_.lower()
        first = "#" if w_[:1].isdigit() else low
        rest = "X" if w_[:1].isupper() else first
        self.known[w] = len(self.raw)
        self.raw.append((self.hashes[first], self.hashes[rest], self.hashes[low], bool(w_), low))
        return self.known[w]

    def places(self, texts) -> list[np.ndarray]:
        """The places each table is to be counted up at, one per occurrence; beginnings come with ``starts``."""
        if len(self.known) > 500_000:
            self.known, self.raw = {}, []
        numbers, sizes = [], []
        for t in texts:
            for c in clauses(t):
                if _STOPPED.search(c):
                    found = [self.known[w] if w in self.known else self._word(w) for w in c.split()]
                    numbers += found
                    sizes.append(len(found))
        if not numbers:
            return [np.zeros(0, np.int64)] * 3
        used, numbers = np.unique(np.array(numbers, np.int64), return_inverse=True)
        table = [self.raw[k] for k in used.tolist()]
        first, rest, plain = (np.array([r[k] for r in table], np.uint64)[numbers] for k in range(3))
        real = np.array([r[3] for r in table])[numbers]
        for r, n in zip(table, np.bincount(numbers, minlength=len(table)).tolist(), strict=True):
            self.seen[r[4]] += n
        clause = np.repeat(np.arange(len(sizes)), sizes)[real]
        first, rest, plain = first[real], rest[real], plain[real]
        if not len(clause):
            return [np.zeros(0, np.int64)] * 3
        opens = np.concatenate(([True], clause[1:] != clause[:-1]))
        closes = np.concatenate((opens[1:], [True]))
        nth = np.arange(len(clause)) - np.maximum.accumulate(np.where(opens, np.arange(len(clause)), 0))
        h = np.where(opens, first, rest)
        inside, end = [], []
        for k in (1, 2, 3):
            at = np.flatnonzero(nth >= k - 1)
            g = np.full(len(at), k, np.uint64)
            for j in range(k):
                g = mix(g * np.uint64(0x100000001B3) + h[at - j])
            g = (g >> np.uint64(64 - BITS)).astype(np.int64)
            inside.append(g[~closes[at]])
            end.append(g[closes[at]])
        words = (mix(plain) >> np.uint64(64 - BITS)).astype(np.int64)
        return [np.concatenate(inside), np.concatenate(end), words]

    def starts(self):
        """(place, count) of the beginnings of the words seen since the last call."""
        words = [w for w in self.seen if len(w) > 3]
        n = np.fromiter((self.seen[w] for w in words), np.int64, len(words))
        self.seen.clear()
        size = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.array(words, f"U{LETTERS}").view(np.uint32).reshape(len(words), LETTERS).astype(np.uint64)
        h, place, times = np.zeros(len(words), np.uint64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(min(LETTERS, int(size.max(initial=0)) - 1)):
            h = mix(h * np.uint64(0x100000001B3) + letters[:, k])
            if k >= 2:
                at = size > k + 1
                place.append((h[at] >> np.uint64(64 - BITS)).astype(np.int64))
                times.append(n[at])
        return np.concatenate(place), np.concatenate(times)


def _learn(it):
    """The tables of a task, in compressed blocks."""
    learner, counts = Learner(), np.zeros((len(Tables.NAMES), 1 << BITS), np.int64)

    def add_starts():
        place, n = learner.starts()
        if len(place):
            counts[3] += np.bincount(place, weights=n, minlength=1 << BITS).astype(np.int64)

    for pdf in it:
        texts = [x for c in ("question", "answer") for x in pdf[c] if isinstance(x, str)]
        for k, places in enumerate(learner.places(texts)):
            if len(places):
                counts[k] += np.bincount(places, minlength=1 << BITS)
        if len(learner.seen) > 200_000:
            add_starts()
    add_starts()
    yield from table_blocks(counts.ravel())


def learn_tables(rows: DataFrame) -> Tables:
    """The tables over all rows (question, answer)."""
    return Tables(summed_tables(rows.select("question", "answer"), _learn, len(Tables.NAMES) << BITS).reshape(len(Tables.NAMES), -1))


def counted(texts: list[str]) -> Counter:
    """What a few texts add to the tables, by (table, place)."""
    learner, count = Learner(), Counter()
    for k, places in enumerate(learner.places(texts)):
        count.update((k, p) for p in places.tolist())
    place, n = learner.starts()
    for p, m in zip(place.tolist(), n.tolist(), strict=True):
        count[3, p] += m
    return count


class Reader:
    """Turns a pair into clause features, with the corpus' ``tables`` for the ends of sentences."""

    def __init__(self, tables: Tables | None = None):
        self.tables, self.hashes = tables, WordHashes()

    def question(self, q: str | None):
        tokens = _TOKEN.findall(fold(q)) if q else []
        same = [_PERSON.get(w, w) for w in tokens]
        lang = language(tokens)
        most = max(lang)
        return set(zip(same, same[1:], strict=False)), set(same), lang.index(most) if most >= 2 else -1

    def features(self, q: str | None, parts: list[str], less: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Features and words of each clause; ``less`` is taken off the tables."""
        pairs, single, own = self.question(q)
        x = np.zeros((len(parts), len(FEATURES)), np.float32)
        x[:, 0] = 1
        n = np.zeros(len(parts), np.int64)
        for j, raw in enumerate(parts):
            c = fold(raw)
            tokens = _TOKEN.findall(c)
            n[j] = len(tokens)
            f = x[j]
            if len(tokens) <= 3:
                f[7] = 1
            if tokens:
                same = [_PERSON.get(w, w) for w in tokens]
                hits = sum(w in single for w in same)
                if hits >= 0.35 * len(same):
                    two = list(zip(same, same[1:], strict=False))
                    share = sum(p in pairs for p in two) / len(two) if two else 1.0
                    f[4], f[5], f[6] = share >= 0.9, share >= 0.6, share >= 0.35
                if own >= 0:
                    lang = language(tokens)
                    other = max(lang[k] for k in range(4) if k != own)
                    f[8], f[9], f[10] = other > lang[own], other >= lang[own] + 2, lang[own] > other
            low = c.replace("’", "'")
            if any(t in low for t in _DECLINE_STEMS) and _DECLINE.search(low):
                f[1] = 1
                m = _BUT.search(low)
                if m and not _DECLINE.search(low, m.end()):
                    f[1], f[2] = 0, 1
            if _POLITE.search(low):
                f[3] = 1
        if len(parts):
            x[0, _F["first"]] = 1
            self._last(x[-1], parts, less)
        return x, n

    def _last(self, f, parts, less):
        raw = parts[-1]
        f[11] = 1
        f[12] = bool(_STOPPED.search(raw))
        f[13] = bool(_LIST.match(raw))
        f[14] = bool(_DANGLING.search(raw.rstrip()))
        f[15] = _open(raw)
        words = raw.split()
        if f[13] and len(words) <= 3:
            f[21] = 1
        low = [self.hashes[w] for w in _masked(raw)[-3:]]
        if self.tables is not None and low:
            get = self.tables.get
            place = [_place(_group(low[-k:])) if len(low) >= k else None for k in (1, 2, 3)]
            one, two, three = ((0, 0) if p is None else (get("inside", p, less), get("end", p, less)) for p in place)
            best = next((c for c in (three, two) if sum(c) >= 3), one)
            n, e = sum(best), best[1]
            f[16], f[17] = n > 0 and e >= 0.5 * n, n >= 3 and e < 0.05 * n
            f[24], f[25] = len(low) > 1 and not sum(two), len(low) > 2 and not sum(three)
            word = _place(_mixed(self.hashes[words[-1].strip(_MARKS).lower()]))
            known = get("words", word, less) > 0
            f[18] = words[-1][:1].islower() and not known
            f[26] = not known and get("starts", _beginning(words[-1].strip(_MARKS).lower()), less) >= OFTEN
        f[19] = bool(_CLOSING.search(fold(raw)) or _REMARK.search(raw))
        f[22] = not (f[12] or f[13] or f[19])
        f[23] = f[22] and f[18]
        f[24:27] *= f[22]


def _cut(rng, text: str) -> str | None:
    c = clauses(text)
    last = c[-1]
    words = last.split()
    if len(words) < 6:
        return None
    kind = max(0, int(rng.integers(-2, 6)))
    k = int(rng.integers(2, len(words) - 1))
    head = " ".join(words[:k])
    piece = words[k].strip(".,;")
    if kind == 0 and len(piece) > 4:
        head += " " + piece[: int(rng.integers(1, len(piece) - 1))]
    elif kind == 1:
        head = head.rstrip(".,;") + ","
    elif kind == 2:
        head = head.rstrip(".,;") + "…"
    elif kind == 3:
        head += " (" + piece
    elif kind == 4:
        return text.rstrip() + "\n- " + words[0].lower()
    elif kind == 5:
        head += ' "'
    if head.endswith("."):
        return None
    at = text.rfind(words[0], 0, text.rfind(last[-12:]) + 1)
    return text[: max(at, 0)] + head if at >= 0 else None


def _swap(text: str) -> str:
    for a, b in ((r"\bI am\b|\bI'm\b", "you are"), (r"\bI\b", "you"), (r"\bmy\b", "your"), (r"\bMy\b", "Your"), (r"\bme\b", "you")):
        text = re.sub(a, b, text)
    return text


def examples(sample: list[tuple[str, str]], seed: int = 7):
    """(question, clauses, tags, answer) made from pairs that look sound; the answer only where it is changed at its end."""
    rng = np.random.default_rng(seed)
    reader = Reader()
    sound: dict[int, list] = {}
    for q, a in sample:
        if not q or not a or not _STOPPED.search(a) or len(a) < 60:
            continue
        x, n = reader.features(q, clauses(a))
        own = reader.question(q)[2]
        if own < 0 or x[:, 1].any() or x[:, 5].any() or x[:, 8].mean() > 0.2:
            continue
        sound.setdefault(own, []).append((q, a))
    names = list(FUNCTION_WORDS)
    for own, rows in sound.items():
        others = [r for k, v in sound.items() if k != own for r in v]
        for q, a in rows:
            parts = clauses(a)
            yield q, parts, [ANSWER] * len(parts), None
            what = rng.integers(0, 11)
            if what in (0, 1, 9, 10):
                cut = _cut(rng, a)
                if cut:
                    p = clauses(cut)
                    yield q, p, [ANSWER] * (len(p) - 1) + [UNFINISHED], a
            elif what == 2 and rng.random() < 0.5:
                p = clauses(a.rstrip().rstrip(".!"))
                yield q, p, [ANSWER] * len(p), a
            elif what == 3:
                p = clauses(a.rstrip() + rng.choice([" ", "\n"]) + str(rng.choice(CLOSINGS)))
                yield q, p, [ANSWER] * len(p), None
                p = clauses(a.rstrip() + "\n- keep warm and rest\n- note each day of " + str(rng.choice(parts[0].split())).strip(".,").lower() + "\n- see a nurse within 5 days")
                yield q, p, [ANSWER] * len(p), None
            elif what == 4:
                echo = q if rng.random() < 0.5 else _swap(q)
                p = clauses(rng.choice(["", "You asked: ", "You wrote: ", "Your question was: "]) + echo)
                yield q, p, [ECHO] * len(p), None
                quoted = clauses("You wrote: " + echo)
                yield q, quoted + parts, [ECHO] * len(quoted) + [ANSWER] * len(parts), None
            elif what == 5 and others:
                p = clauses(others[int(rng.integers(len(others)))][1])
                yield q, p, [FOREIGN] * len(p), None
                yield q, parts + p[:1], [ANSWER] * len(parts) + [FOREIGN], None
                yield q, parts[:1] + p, [ANSWER] + [FOREIGN] * len(p), None
            elif what in (6, 7):
                k = names[own]
                p = [str(rng.choice(LEADS[k])) * (rng.random() < 0.6) + str(rng.choice(REFUSALS[k])) + str(rng.choice([".", "!", ""]))]
                if rng.random() < 0.4:
                    p.append(str(rng.choice(REFUSALS[k])) + ".")
                if rng.random() < 0.5:
                    p.append(str(rng.choice(TAILS[k])))
                p = clauses(" ".join(p))
                yield q, p, [REFUSAL] * len(p), None
            elif what == 8:
                p = clauses(str(rng.choice(CAVEATS))) + parts
                yield q, p, [ANSWER] * len(p), None


class Field:
    """A linear-chain conditional random field with dense clause features."""

    def __init__(self, w: np.ndarray, t: np.ndarray):
        self.w, self.t = w, t

    @staticmethod
    def _pad(seqs, width):
        n = np.array([len(s) for s in seqs])
        x = np.zeros((len(seqs), width, len(FEATURES)), np.float32)
        for k, s in enumerate(seqs):
            x[k, : len(s)] = s
        return x, n

    @classmethod
    def fit(cls, data, steps: int = 150, rate: float = 0.2, l2: float = 2e-5) -> Field:
        """Adam on the log-likelihood, all sequences at once; the same data give the same field."""
        data = [d for d in data if 0 < len(d[1]) <= 16]
        data.sort(key=lambda d: len(d[1]))  # sequences of like length together, so little is padded
        parts = []
        for k in range(0, len(data), -(-len(data) // 4)):
            some = data[k : k + -(-len(data) // 4)]
            width = len(some[-1][1])
            x, n = cls._pad([d[0] for d in some], width)
            y = np.zeros((len(some), width), np.int64)
            for j, (_, tags) in enumerate(some):
                y[j, : len(tags)] = tags
            live = np.arange(width)[None, :] < n[:, None]
            parts.append((x, live, np.eye(len(TAGS))[y] * live[:, :, None]))
        seen = sum(x.reshape(-1, len(FEATURES)).T @ one.reshape(-1, len(TAGS)) for x, _, one in parts)
        moves = sum((one[:, :-1, :, None] * one[:, 1:, None, :]).sum((0, 1)) for _, _, one in parts)
        w, t = np.zeros(seen.shape), np.zeros(moves.shape)
        mom = [np.zeros_like(w), np.zeros_like(t)]
        var = [np.zeros_like(w), np.zeros_like(t)]
        for i in range(1, steps + 1):
            gw, gt = seen - l2 * len(data) * w, moves - l2 * len(data) * t
            for x, live, _ in parts:
                ew, et = cls._expected(x, live, w, t)
                gw, gt = gw - ew, gt - et
            for k, (par, g) in enumerate(((w, gw / len(data)), (t, gt / len(data)))):
                mom[k] = 0.9 * mom[k] + 0.1 * g
                var[k] = 0.999 * var[k] + 0.001 * g * g
                par += rate * (mom[k] / (1 - 0.9**i)) / (np.sqrt(var[k] / (1 - 0.999**i)) + 1e-8)
        return cls(w, t)

    @staticmethod
    def _expected(x, live, w, t) -> tuple[np.ndarray, np.ndarray]:
        """Expected feature and transition counts, by the forward and backward recursions."""
        t = t.astype(np.float32)
        s = x @ w.astype(np.float32)
        width = s.shape[1]
        a, b = np.zeros_like(s), np.zeros_like(s)
        a[:, 0] = s[:, 0]
        for j in range(1, width):
            v = a[:, j - 1, :, None] + t
            m = v.max(1, keepdims=True)
            a[:, j] = np.where(live[:, j, None], s[:, j] + (m + np.log(np.exp(v - m).sum(1, keepdims=True)))[:, 0], a[:, j - 1])
        for j in range(width - 2, -1, -1):
            v = t + (s[:, j + 1] + b[:, j + 1])[:, None, :]
            m = v.max(2, keepdims=True)
            b[:, j] = np.where(live[:, j + 1, None], (m + np.log(np.exp(v - m).sum(2, keepdims=True)))[:, :, 0], 0)
        m = a[:, -1].max(1)
        z = m + np.log(np.exp(a[:, -1] - m[:, None]).sum(1))
        p = np.exp(np.minimum(a + b - z[:, None, None], 0)) * live[:, :, None]
        e = np.exp(np.minimum(a[:, :-1, :, None] + t + (s[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None], 0)) * live[:, 1:, None, None]
        return x.reshape(-1, len(FEATURES)).T @ p.reshape(-1, len(TAGS)), e.sum((0, 1))

    def tag(self, seqs: list[np.ndarray]) -> list[np.ndarray]:
        """The best tags of each sequence, sequences of like length together."""
        out: list = [np.zeros(0, np.int64)] * len(seqs)
        sizes = np.array([len(s) for s in seqs])
        for width in np.unique(sizes[sizes > 0]):
            at = np.flatnonzero(sizes == width)
            s = np.stack([seqs[k] for k in at]) @ self.w
            best, back = s[:, 0], []
            for l in range(1, width):
                v = best[:, :, None] + self.t
                back.append(v.argmax(1))
                best = v.max(1) + s[:, l]
            y = np.zeros((len(at), width), np.int64)
            y[:, -1] = best.argmax(1)
            for l in range(width - 2, -1, -1):
                y[:, l] = np.take_along_axis(back[l], y[:, l + 1, None], 1)[:, 0]
            for k, row in zip(at, y, strict=True):
                out[k] = row
        return out


_NOTHING = re.compile(f"[\\s{re.escape(INVISIBLE)}\\u3164\\u2800]+")


def is_empty(a: str | None) -> bool:
    """Null, nothing visible, only marks, or a stand-in for an answer."""
    if a is None or not isinstance(a, str):
        return True
    if len(a) > 60:
        return not _NOTHING.sub("", a)
    t = _TOKEN.findall(fold(a))
    return not t or " ".join(t) in STAND_INS or bool(re.fullmatch(r"\s*[\[<({]+[^\]>)}]{0,30}[\]>)}]+\s*", a))


def defect(tags: np.ndarray, n: np.ndarray, x: np.ndarray) -> str | None:
    """Clause coverage into the pair's defect; a foreign reply must also have more foreign than own words' clauses."""
    cover = np.bincount(tags, weights=n, minlength=len(TAGS))
    all_ = max(cover.sum(), 1)
    sound = cover[ANSWER]
    if cover[ECHO] >= 0.8 * all_ or (cover[ECHO] > 0 and sound <= 3 and cover[FOREIGN] == 0 and cover[REFUSAL] == 0 and cover[ECHO] >= 0.5 * all_):
        return "copied"
    if cover[REFUSAL] > 0 and sound + cover[FOREIGN] <= 0.25 * all_:
        return "refusal"
    if cover[FOREIGN] > 0.5 * all_ and n[x[:, _F["foreign"]] > 0].sum() > n[x[:, _F["own"]] > 0].sum():
        return "wrong_language"
    if len(tags) and tags[-1] == UNFINISHED:
        return "truncated"
    return None


def _flag(it, model):
    field, tables = model.value
    reader = Reader(tables)
    for pdf in it:
        found: list = [None] * len(pdf)
        held, seqs = [], []
        for k, (q, a) in enumerate(zip(pdf["question"], pdf["answer"], strict=True)):
            if is_empty(a):
                found[k] = "empty"
                continue
            parts = clauses(a)
            x, n = reader.features(q if isinstance(q, str) else None, parts)
            held.append((k, n, parts, x))
            seqs.append(x)
        for (k, n, parts, x), tags in zip(held, field.tag(seqs), strict=True):
            found[k] = defect(tags, n, x)
        rows = [r for r in zip(pdf["id"].tolist(), found, strict=True) if r[1]]
        if rows:
            yield pd.DataFrame(rows, columns=["id", "defect"])


def fit(rows: DataFrame) -> tuple[Field, Tables]:
    """The field and the tables for rows (id, question, answer).

    The tables count all rows. The field is fitted on FIT_ROWS pairs chosen by a hash of id and answer;
    large tables are first thinned by the hash to a few times FIT_ROWS, so that what the tasks send to
    the driver does not grow with their number.
    """
    tables = learn_tables(rows)
    n, h = rows.count(), F.xxhash64("id", "answer")
    some = rows.where("question is not null and answer is not null")
    if n > 8 * FIT_ROWS:
        some = some.where(F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * 4 * FIT_ROWS / n))
    some = some.orderBy(h, "id").limit(FIT_ROWS)
    return fit_field([(r["question"], r["answer"]) for r in some.select("question", "answer").collect()], tables), tables  # FIT_ROWS rows at most


def fit_field(sample: list[tuple[str, str]], tables: Tables) -> Field:
    reader = Reader(tables)
    data = [(reader.features(q, p, counted([a]) if a else None)[0], y) for q, p, y, a in examples(sample)]
    if not data:  # nothing to learn from: the seed sentences alone
        data = [(reader.features("is this usual for me and what can i do", clauses(t))[0], [k] * len(clauses(t))) for k, t in ((ANSWER, "Please rest for two days."), (REFUSAL, "I can't help with that."))]
    return Field.fit(data)


def pair_defects(df: DataFrame, id_col: str, question_col: str, answer_col: str, model: tuple[Field, Tables] | None = None) -> DataFrame:
    """(id, defect) of the pairs without a usable reply, one row per id.

    defect: empty, copied, refusal, wrong_language or truncated, the first that applies in this
    order. A null or empty question is no defect; with it, copied and wrong_language cannot occur.
    ``wrong_language`` knows the languages of FUNCTION_WORDS. Of several rows of one id the
    alphabetically first defect counts. Other columns are not read. ``model`` is what ``fit`` gave
    for these or other rows; without it, it is fitted on these.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(question_col).alias("question"), F.col(answer_col).alias("answer"))
    ship(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(model or fit(rows))
    flagged = map_pandas(rows, partial(_flag, model=model), f"id {dict(rows.dtypes)['id']}, defect string")
    return flagged.groupBy("id").agg(F.min("defect").alias("defect"))
