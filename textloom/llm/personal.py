"""Problem 10: personal information in running text, found and replaced.

E-mail addresses, telephone numbers, identity numbers, street addresses and names of persons are
found by their formats, by cues around them and by a given list of names; bank and card numbers
also by their check digits alone. Each is replaced by a typed placeholder that carries a pseudonym
of its normal form, so equal values stay linked however they are spelled: e-mail addresses with
``at`` and ``dot`` written out, telephone numbers with and without country code, names with the
surname first, identity numbers in any spacing.

Numbers are permuted within their own format by a keyed Feistel network over their digits and
letters (signs, spaces and lengths stay): one number has one pseudonym in all documents and no two
share one. A number whose check digits hold gets a pseudonym whose check digits hold: the rest is
permuted and the check digits are made anew. Other kinds carry a keyed tag of 128 bits, itself the
output of a Feistel network over a digest of the normal form.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_pandas, ship

ROUNDS = 8
MAX_NAMES = 200_000
KINDS = ("email", "phone", "id_number", "address", "name")

_L = r"A-Za-zÀ-ÖØ-öø-ÿ"
_CAP = rf"[A-ZÀ-ÖØ-Þ][{_L}'’]+"
_SUR = rf"{_CAP}(?:-{_CAP})*"

# -- e-mail: the at sign in any spelling, dots in any spelling
_AT = r"(?:\s?[\[({<]\s?(?:at|AT|@|arroba|aroba)\s?[\])}>]\s?|\s?[@＠﹫]\s?|\s(?:at|AT|arroba)\s)"
_DOT = r"(?:\s?[\[({]\s?(?:dot|DOT|punto|punkt|point|\.)\s?[\])}]\s?|\s(?:dot|DOT|punto|punkt|point)\s|[.．。])"
_ATOM = r"[A-Za-z0-9ａ-ｚＡ-Ｚ０-９À-ÿ](?:[A-Za-z0-9ａ-ｚＡ-Ｚ０-９À-ÿ_%+\-']*[A-Za-z0-9ａ-ｚＡ-Ｚ０-９À-ÿ])?"
EMAIL = re.compile(rf"(?<![\w.+%-]){_ATOM}(?:[.．_]{_ATOM}|{_DOT}(?=\S+{_AT}){_ATOM})*{_AT}(?:{_ATOM}{_DOT})+[A-Za-zａ-ｚＡ-Ｚ]{{2,24}}(?![\w@])")
#: what every address has: a quick test before the full pattern
_AT_SOME = re.compile(r"[@＠﹫]|[\[({<]\s?(?:at|AT|arroba|aroba)\b|\s(?:at|AT|arroba)\s[^\s.．。]+(?:[.．。]\w|\s?[\[({]?\s?(?:dot|DOT|punto|punkt|point)\b)")
_SPELLED = re.compile(r"\sat\s", re.I)

# -- numbers
PHONE = re.compile(
    r"(?<![\w./+(:-])(?=[\d(+])(?:"
    r"(?:\+|00)\d{1,3}[ .\-/]?\(?\d{1,5}\)?(?:[ .\-/]?\d{2,5}){1,4}"  # with a country code
    r"|\(0?\d{2,5}\)[ .\-/]?\d{3,4}[ .\-/]?\d{3,4}"  # area code in brackets
    r"|(?:1[ .\-])?[2-9]\d{2}([ .\-])\d{3}\1\d{4}"
    r"|0\d{4} ?\d{6}|0\d{3} \d{3} \d{4}|0\d{2} \d{4} \d{4}|0\d{1,4}[ \-/]\d{5,8}|0\d{9,10}"
    r"|0\d(?:([ .\-])\d\d)(?:\2\d\d){3}|[6789]\d{2}(?:[ .]\d{3}){2}|[6789]\d\d(?: \d\d){3}"
    r")(?![\w]|[-/.]\d)"
)
#: numbers that only their check digits give away
CHECKED = re.compile(r"(?<![\w+./-])(?=[A-Z]{2}\d\d|\d{4}[\d-])(?:[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|\d{13,19}|\d{4}(?:-\d{4}){3})(?![\w]|[-/]\d)")
ID = re.compile(
    r"(?<![\w+./-])(?=[-A-Z\d])(?:"
    r"[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-D A-Z](?<=[A-Z])"
    r"|[A-Z]{1,2}\d{6,9}[A-Z]?"
    r"|\d{3} \d\d \d{4}|\d{3}-\d\d-\d{4}"
    r"|\d{4} \d{4} \d{4}(?: \d{4})?"
    r"|[XYZ]?-?\d{7,8}[ -]?[A-Z]"
    r"|[12] \d\d \d\d \d\d \d{3} \d{3}(?: \d\d)?"
    r")(?![\w]|[-/]\d)"
)
# Words before an identity number, and words before other numbers.
ID_CUE = re.compile(r"(?:passport|pass(?:port)?nummer|reisepass|pasaporte|passeport|id(?: no| number| card)?|identity (?:number|card)|national (?:number|id)|insurance (?:number|no)|nhs (?:number|no)|social security(?: number| no)?|tax (?:id|number)|versichertennummer|versicherungsnummer|ausweisnummer(?: lautet)?|personalausweis|steuer-?id|carte(?: no| n°| nº)?|numéro d['’]identité(?: est)?|numéro de sécurité sociale|documento(?: es)?|dni|nie|nif|número de identidad|already carries|card no)\W{0,4}$", re.I)
NOT_A_NUMBER_CUE = re.compile(r"(?:issn|isbn|batch|lot|charge|lote|code|section|abschnitt|sección|readings?|dose|doi|ref(?:erence)?|order|invoice|version|serial|page|pages|vol|figure|table|catalogue|item|part|grant|registered body)(?:[\w-]*)[ .:#no°º]{0,6}(?:of |from |to |and )?$", re.I)

# -- addresses
# Kinds of streets.
_STREET = r"(?:Street|Str|St|Road|Rd|Avenue|Ave|Av|Lane|Ln|Row|Terrace|Terr|Close|Court|Ct|Drive|Dr|Crescent|Cres|Place|Pl|Square|Sq|Gardens|Gdns|Grove|Mews|Walk|Way|Hill|Parade|Quay|Boulevard|Blvd|Highway|Hwy|Parkway|Green|Rise|View|Yard|Wharf)"
_UNIT = r"(?:Flat|Apt\.?|Apartment|Unit|Suite|Room|House|Floor|Wohnung|Whg\.?|Appartement|Appt\.?|Piso|Bloque|Bât\.?|Bâtiment|Esc\.?)"
_NO = r"\d{1,5}(?: ?[A-Za-z](?![\w]))?(?:\s?[-/–]\s?\d{1,4}[A-Za-z]?)?"
_CITY = rf"(?:\d{{4,5}}\s+)?{_CAP}(?:[ -]{_CAP})?(?:,? [A-Z]{{2}} \d{{5}}| [A-Z]{{1,2}}\d[\dA-Z]? \d[A-Z]{{2}})?"
ADDRESS = re.compile(
    rf"(?<![\w])(?=[A-ZÀ-ÖØ-Þ\d])(?:"
    rf"(?:{_UNIT}\s?(?:no\.?\s?)?[\dA-Z]{{1,5}}[a-z]?\s?,?\s+)?{_NO},?\s+(?:{_CAP}\s+){{1,3}}{_STREET}\b\.?(?:,?\s+{_UNIT}\s?#?[\dA-Za-z]{{1,5}})?"
    rf"|(?:{_UNIT}\s?[\dA-Z]{{1,5}}\s?,?\s+)?{_NO},?\s+(?:bis |ter )?(?:[Rr]ue|[Aa]venue|[Bb]oulevard|[Aa]llée|[Pp]lace|[Cc]hemin|[Qq]uai|[Ii]mpasse|[Cc]ours|[Rr]oute)\s+(?:(?:de|du|des|la|le|les)\s+|d['’]|de l['’]|l['’])*{_CAP}"
    rf"|(?:Calle|C/|Avenida|Avda\.?|Plaza|Paseo|Camino|Carretera|Ronda|Travesía)\s?(?:(?:de|del|la|las|los|el)\s+)*{_CAP}(?:\s+{_CAP})?,?\s+(?:n\.?º\s?)?\d{{1,4}}[A-Za-z]?(?:,?\s+\d{{1,2}}\.?[ºª](?:\s?[A-Z](?![\w]))?)?"
    rf"|(?:{_CAP}(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|damm|ufer|steig|pfad|chaussee)|{_CAP}\s(?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee|Ring|Damm|Ufer))\s+{_NO}"
    rf"|(?:P\.?\s?O\.?\s?Box|Post(?:al)? Box|Postfach|Apartado(?: de [Cc]orreos)?|Boîte [Pp]ostale|B\.?P\.?|Casilla|Locked Bag)\s?(?:no\.?\s?)?\d{{1,6}}"
    rf")(?:\s?,\s+{_CITY}|\s?\n[ \t]*{_CITY})?"
)

# -- names
# Titles, lead-ins and what follows a name, in four languages.
TITLES = r"(?:Dr|Doctor|Doctora|Docteur|Docteure|Mr|Mrs|Ms|Miss|Mx|Prof|Professor|Nurse|Midwife|Sister|Matron|Sir|Dame|Rev|Frau|Herr|Hebamme|Schwester|Pfleger|Mme|Mlle|Madame|Monsieur|M|Sage-femme|Infirmière|Infirmier|Sra|Srta|Sr|Señora|Señor|Doña|Don|Matrona|Comadrona|Enfermera|Enfermero|Dra|Pharmacist|Surgeon|Consultant)\b\.?"
_LEADS = r"(?:[Mm]y name is|I am called|[Nn]ame\s?:|[Ss]igned(?: by)?\s?:?|[Pp]atient(?:in|e|a)?\s?:|From\s?:|To\s?:|Cc\s?:|[Aa]sk for|I (?:saw|met) |written by|[Rr]eviewed by|[Cc]ontact person\s?:|Ich heiße|[Mm]ein Name ist|[Ff]ragen Sie nach|Gezeichnet\s?:|Name\s?:|[Vv]on\s?:|Je m['’]appelle|[Mm]on nom est|[Dd]emandez|Signé\s?:|Nom\s?:|Me llamo|[Mm]i nombre es|[Pp]regunte por|Firmado\s?:|Nombre\s?:|[Pp]aciente\s?:|[Dd]ear|Liebe[r]?|Chère|Cher|Querid[ao]|(?:[Kk]ind|[Bb]est|[Ww]arm) regards,|[Yy]ours (?:sincerely|faithfully|truly),|[Ss]incerely,|Best wishes,|Many thanks,|Mit freundlichen Grüßen,?|Viele Grüße,?|Cordialement,|Bien à vous,|Atentamente,|Saludos,|Un saludo,)"
_AFTER = re.compile(r"[ ](?:told|said|says|wrote|writes|asked|replied|called|thanked|signed|explained|added|recalls?|erzählt|erzählte|sagte?|schrieb|fragte|meinte|hat uns|berichtete|a (?:raconté|dit|écrit|demandé|expliqué)|nous a|dit|écrit|contó|dijo|dice|escribió|preguntó|explicó|nos (?:contó|dijo|escribió))\b")
#: what stands before places, not before persons who do something
_PLACE_BEFORE = re.compile(r"\b(?:in|from|at|near|of|to|aus|nach|bei|um|à|en|de|desde|hacia)[ ]+$")
#: no part of a name though capitalised: words that begin sentences, months, days, nationalities
ORDINARY = set(
    "Later Today Yesterday Tomorrow Soon Finally Suddenly Meanwhile However Also Although Because Instead Perhaps Maybe Sometimes Often Usually Never Always Again Still Afterwards Next Once Everyone Everybody Nobody Somebody Someone Nothing The A An In On At By For With Without Until After Before During Since When While If As And But Or Nor So Yet Some Many Most Two Three Four Those These This That My Our Your His Her Their Its I We You He She They It Is Are Was Were Be Am Do Does Did Has Have Had Not No Yes Please Thanks Thank Hello Hi Dear Back Between Being Now Last Ever Just To From Of Off Out Up Down According Honestly Oddly Call Text Write Send Contact Phone Tel Address Passport Patient Signed Results Rest Keep Ask Avoid Seek Go Have Bleeding Tissue Tracking Guidance Leaflets Iron Warmth Hormone Breast Ultrasound Rose Readings Batch See Other People Women Athletes Teenagers Among About Outside Untreated Under Over Near Can Could Should Would Will May Might Must Who What Where Which Why How Then There Here Only Even Such Each Every All Any Both Few More Less Loss Pain Low Night Ovulation Mood Hot Back Hair Joint Leg Pelvic Early First Cycle Thyroid Smear Cyst Fibroid Postnatal Contraceptive Menopause Breastfeeding Discharge Diary "
    "January February March April May June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday Mondays Spanish French German English Flat Apt Box Street Road Lane Avenue Row Clinic Hospital Ward Department Institute Foundation Centre Center University College School Library "
    "Der Die Das Ein Eine Nach Mit Bei Seit Vor Von Zu Im In Am An Auf Aus Wenn Weil Und Oder Ich Sie Er Es Wir Ihr Mein Meine Laut Mehr Bitte Rufen Schreiben Fragen Allgemeinen Hier Neben Ehrlich Wie Fieber Myome Tel Le La Les Un Une Des Du De En Et Ou Je Tu Il Elle Nous Vous Ils Mon Ma Mes Selon Avec Sans Pour Par Sur Dans Depuis Après Avant Plus Merci Notez Bonjour Franchement Demandez Appelez Adresse Courriel Tél Carte Test El Los Las Una Unos Con Sin Por Para Desde Después Antes Según Tras Más Gracias Anote Me Mi Mis Su Sus Yo Usted Correo Teléfono Dirección Llame Escriba Pregunte Cerca Perder".split()
)
#: given names that are ordinary words as well; they need a surname, a title or a lead-in
AMBIGUOUS = set("April May June August Hope Faith Grace Dawn Ivy Rose Joy Summer Autumn Will Mark Bill Art Rich Violet Olive Pearl Ruby Amber Iris Lily Daisy Heather Holly Hazel Robin Jasmine Sage Angel Destiny Harmony Melody Penny Patience Charity Prudence Constance Chance Max Victor Frank Ernest Guy Gene Jack Dolores Pilar Consuelo Mercedes Rosa Alba Sol Luz Paz Clemence Aimé Reine Blanche Claire Pascal Noël Ernst Wolf Karl Clara Vera Mira Nora Celia Hana Amara Thea Tuva Noor".split()) - set("Karl Clara Vera Mira Nora Celia Hana Amara Thea Tuva Noor".split())
_CAPITAL = re.compile(rf"(?<![\w@.+'’-])(?:[A-Z]\.\s?)*{_SUR}(?![\w@]|\.\w)")
_ONE = rf"(?:(?:[A-Z]\.[ ]?){{1,2}}{_SUR}|{_CAP}(?:[ ](?:[A-Z]\.|(?:van|von|de|del|della|da|di|du|der|den|la|le|bin|al)))*[ ]{_SUR}|{_SUR},[ ]{_CAP}|{_CAP}[ ][A-Z]\.|{_SUR})"
LEAD_NAME = re.compile(rf"(?<!\w)(?=[AaBbCcDdFfGIJKkLMmNnPpQRrSsTUVvWwYy]){_LEADS}\s*(?:{TITLES}\s+)*({_ONE})")
TITLE_NAME = re.compile(rf"(?<![\w-])(?=[CDEFHIMNPRS]){TITLES}[ ]+(?:{TITLES}[ ]+)*({_ONE})")
AFTER_NAME = re.compile(rf"(?<![\w@.+-])(?:{TITLES}[ ]+)*({_ONE})$")
BLOCK_NAME = re.compile(rf"(?:(?<=\n)|(?<=[.!?)][ ])|^)(?:{TITLES}[ ]+)*({_ONE})[ \t]*\n[ \t]*$")
SLASH_NAME = re.compile(rf"(?:(?<=\n)|(?<=[.!?][ ])|^)(?:{TITLES}[ ]+)*({_ONE})(?=[ ]/[ ])", re.M)


# White space, hyphens and full-width forms of other scripts, one character for one.
_PLAIN = {ord(c): " " for c in "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"}
_PLAIN |= {ord(c): "-" for c in "\u2010\u2011\u2012\u2013\u2212\ufe58\ufe63\uff0d"}
_PLAIN |= {k: chr(k - 0xFEE0) for k in range(0xFF01, 0xFF5F) if k != 0xFF0D}


class Finder:
    """Spans (start, end, kind) of one text, in order and without overlap."""

    def __init__(self, names: list[tuple[str, str]]):
        self.given = {n.lower() for n, k in names if n and k == "given"}
        self.family = {n.lower() for n, k in names if n and k != "given"}

    def _person(self, part: str) -> bool:
        return any(p.lower() in self.given or p.lower() in self.family for p in re.split(r"[ ,\-]+", part))

    def find(self, text: str) -> list[tuple[int, int, str]]:
        taken: list[tuple[int, int, str]] = []
        if not text.isascii():
            text = text.translate(_PLAIN)  # same length, so places stay

        def free(a, b):
            return all(b <= x or y <= a for x, y, _ in taken)

        if _AT_SOME.search(text):
            for m in EMAIL.finditer(text):
                if _SPELLED.search(m[0]) and not any(c in m[0] for c in "@＠") and not re.search(r"\sdot\s|\.[A-Za-z]{2,}$|[\[(]\s?dot", m[0], re.I):
                    continue
                taken.append((m.start(), m.end(), "email"))
        for m in ADDRESS.finditer(text):
            a, b = m.span()
            while (w := re.search(rf" ({_CAP})$", text[a:b])) and (w[1] in ORDINARY or w[1].lower() in self.given or w[1].lower() in self.family):
                b -= len(w[0])  # the running text or a name goes on behind the place
            if free(a, b):
                taken.append((a, b, "address"))
        numbers = [(m.start(), m.end(), "id_number") for m in CHECKED.finditer(text) if check_kind(m[0]) in ("iban", "luhn")]
        for m in ID.finditer(text):
            before = text[max(0, m.start() - 40) : m.start()]
            if not NOT_A_NUMBER_CUE.search(before):
                numbers.append((m.start(), m.end(), "id_number"))
        for m in PHONE.finditer(text):
            before = text[max(0, m.start() - 40) : m.start()]
            if NOT_A_NUMBER_CUE.search(before):
                continue
            kind = "id_number" if ID_CUE.search(before) and m[0][0] not in "+(" else "phone"
            numbers.append((m.start(), m.end(), kind))
        # the same digits may fit both kinds: the longer match counts, then the identity number
        for a, b, k in sorted(numbers, key=lambda x: (x[0] - x[1], x[2])):
            if free(a, b):
                taken.append((a, b, k))
        blocks = []
        for a, _, kind in taken:
            # the line above an address is its addressee
            m = BLOCK_NAME.search(text, max(0, a - 80), a) if kind == "address" else None
            if m and (t := self._trim(text, *m.span(1))):
                blocks.append(t)
        for a, b in sorted({*blocks, *self._names(text)}, key=lambda x: (x[0], -x[1])):
            if free(a, b):
                taken.append((a, b, "name"))
        return sorted(taken)

    def _trim(self, text: str, a: int, b: int) -> tuple[int, int] | None:
        """A matched name without capitalised words of the running text at its ends."""
        part = text[a:b]
        words = part.split(" ")
        known = self.given | self.family
        while words and (w := words[0].strip(",")) in ORDINARY and not (w.lower() in known and len(words) > 1):
            a += len(words[0]) + 1
            words.pop(0)
        while len(words) > 1 and words[-1].strip(",") in ORDINARY and words[-1].lower() not in known:
            b -= len(words.pop()) + 1
        return (a, b) if words and b > a else None

    def _names(self, text: str):
        found = []
        cues = [m.span(1) for rx in (TITLE_NAME, LEAD_NAME) for m in rx.finditer(text)]
        for v in _AFTER.finditer(text):
            m = AFTER_NAME.search(text, max(0, v.start() - 60), v.start())
            if m and not _PLACE_BEFORE.search(text, max(0, m.start() - 12), m.start()):
                cues.append(m.span(1))
        if " / " in text:
            cues += [m.span(1) for m in SLASH_NAME.finditer(text)]
        found += [t for a, b in cues if (t := self._trim(text, a, b))]
        # surnames and whole names that a cue gave away count wherever else they stand
        known = set()
        for a, b in found:
            name = text[a:b]
            known |= {name, name.split(",")[0] if "," in name else name.rsplit(" ", 1)[-1]}
        known = {x for x in known if len(x) > 2 and not x.endswith(".") and x not in ORDINARY and x.title() not in AMBIGUOUS}
        if known:
            either = "|".join(map(re.escape, sorted(known, key=len, reverse=True)))
            found += [m.span() for m in re.finditer(rf"(?<![\w@.+'’-])(?:{either})(?![\w@-]|\.\w)", text)]
        for m in _CAPITAL.finditer(text):
            word = m[0]
            low = word.lower()
            last = low.rsplit(". ", 1)[-1]
            parts = last.split("-")
            is_given, is_family = last in self.given, any(p in self.family for p in parts)
            if not (is_given or is_family):
                continue
            a, b = m.span()
            rest = text[b : b + 60]
            if is_given and not (is_family and m.start()):
                n = re.match(rf"(?:[ ](?:[A-Z]\.))?[ ]({_SUR})|[ ][A-Z]\.", rest)
                if n and n[1] and n[1] in ORDINARY:
                    n = None
                if n:
                    b += n.end()
                elif word.title() in AMBIGUOUS:
                    continue
                found.append((a, b))
                continue
            # a family name: with what stands before it, or "FAMILY, Given"
            n = re.match(rf",[ ]({_CAP})", rest)
            if n and n[1] not in ORDINARY and (n[1].lower() in self.given or word.isupper()):
                found.append((a, b + n.end()))
                continue
            before = re.search(rf"(?<![\w@.+-])({_CAP})[ ](?:[A-Z]\.[ ])*$", text[max(0, a - 40) : a])
            if before and before[1] not in ORDINARY and not re.fullmatch(TITLES, before[1]):
                a -= len(before[0])
            found.append((a, b))
        # longest first at each place; overlapping parts belong to one name
        out: list[tuple[int, int]] = []
        for a, b in sorted(set(found), key=lambda x: (x[0], -x[1])):
            if out and a < out[-1][1]:
                continue
            out.append((a, b))
        return out


def _round(key: bytes, i: int, half: int, base: str) -> int:
    return int.from_bytes(hmac.new(key, f"{base}|{i}|{half}".encode(), hashlib.sha256).digest()[:16], "big")


def feistel(value: int, left: int, right: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0 .. left * right - 1: alternating unbalanced Feistel rounds."""
    a, b = divmod(value, right)
    rounds = range(ROUNDS)[::-1] if back else range(ROUNDS)
    for i in rounds:
        sign = -1 if back else 1
        if i % 2 == 0:
            a = (a + sign * _round(key, i, b, tweak)) % left
        else:
            b = (b + sign * _round(key, i, a, tweak)) % right
    return a * right + b


def permute_number(text: str, key: bytes, back: bool = False) -> str:
    """Digits stay digits and letters letters of their case, at their places; the tweak is the format."""
    chars = [c for c in text if c.isascii() and c.isalnum()]
    if not chars:
        return text
    bases = [10 if c.isdigit() else 26 for c in chars]
    half = len(chars) // 2
    left = right = 1
    for k, n in enumerate(bases):
        if k < half:
            left *= n
        else:
            right *= n
    value = 0
    for c, n in zip(chars, bases, strict=True):
        value = value * n + (int(c) if n == 10 else ord(c.upper()) - 65)
    shape = "".join("#" if n == 10 else "A" for n in bases)
    value = feistel(value, left, right, key, shape, back)
    out = []
    for c, n in zip(reversed(chars), reversed(bases), strict=True):
        value, d = divmod(value, n)
        out.append(str(d) if n == 10 else chr((65 if c.isupper() else 97) + d))
    new = iter(reversed(out))
    return "".join(next(new) if c.isascii() and c.isalnum() else c for c in text)


def permute_date(day: str, key: bytes, first: str = "1900-01-01", days: int = 73049, back: bool = False) -> str:
    """A date YYYY-MM-DD of the given range into another of the range."""
    from datetime import date, timedelta

    start = date.fromisoformat(first)
    k = (date.fromisoformat(day) - start).days
    if not 0 <= k < days:
        return day
    left = max(n for n in range(1, int(days**0.5) + 1) if days % n == 0)
    return str(start + timedelta(feistel(k, left, days // left, key, "date", back)))


# Check letters of Spanish numbers, and country codes that are read off telephone numbers.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
COUNTRY_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "351", "352", "353", "36", "39", "40", "41", "420", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "58", "61", "64", "81", "90", "91")
#: endings and streets as they are shortened
_SHORTENED = {"street": "st", "road": "rd", "avenue": "ave", "av": "ave", "lane": "ln", "close": "cl", "court": "ct", "drive": "dr", "square": "sq", "gardens": "gdns", "strasse": "str", "straße": "str", "apartment": "apt", "calle": "c", "avenida": "avda"}


def _luhn_digit(body: str) -> str:
    total = 0
    for k, c in enumerate(reversed(body)):
        n = int(c) * (2 - k % 2)
        total += n - 9 * (n > 9)
    return str(-total % 10)


def _iban_digits(country: str, rest: str) -> str:
    value = "".join(str(int(c, 36)) for c in rest + country)
    return f"{98 - int(value + '00') % 97:02d}"


def _nhs_digit(body: str) -> str:
    """The check digit; '' for bodies that have none."""
    n = -sum(int(c) * (10 - k) for k, c in enumerate(body)) % 11
    return "" if n == 10 else str(n)


def _nir_digits(body: str) -> str:
    return f"{97 - int(body) % 97:02d}"


def _signs(text: str) -> str:
    return "".join(c for c in text if c.isascii() and c.isalnum()).upper()


def check_kind(text: str) -> str | None:
    """Which check the number passes: iban, luhn (cards), nhs, nir or dni; the first that fits its form."""
    n = _signs(text)
    if len(n) > 14 and n[:2].isalpha() and n[2:4].isdigit():
        return "iban" if _iban_digits(n[:2], n[4:]) == n[2:4] else None
    if n.isdigit():
        if len(n) == 15 and n[0] in "12" and _nir_digits(n[:13]) == n[13:]:
            return "nir"
        if 13 <= len(n) <= 19 and len(set(n)) > 1 and _luhn_digit(n[:-1]) == n[-1]:
            return "luhn"
        if len(n) == 10 and len(set(n)) > 1 and _nhs_digit(n[:9]) == n[9]:
            return "nhs"
    elif len(n) == 9 and n[:8].isdigit() and n[8] == DNI_LETTERS[int(n[:8]) % 23]:
        return "dni"
    return None


def _put(text: str, signs: str) -> str:
    """The signs at the places of the text's letters and digits, letters in the case they had."""
    new = iter(signs)
    return "".join((lambda x: x.lower() if c.islower() else x)(next(new)) if c.isascii() and c.isalnum() else c for c in text)


def permute_identity(text: str, key: bytes, back: bool = False) -> str:
    """Within the format; where check digits hold the rest is permuted and they are made anew."""
    n, kind = _signs(text), check_kind(text)
    if kind == "luhn":
        body = permute_number(n[:-1], key, back)
        return _put(text, body + _luhn_digit(body))
    if kind == "iban":
        rest = permute_number(n[4:], key, back)
        return _put(text, n[:2] + _iban_digits(n[:2], rest) + rest)
    if kind == "nir":
        body = n[0] + permute_number(n[1:13], key, back)
        return _put(text, body + _nir_digits(body))
    if kind == "nhs":
        body = permute_number(n[:9], key, back)
        while not _nhs_digit(body):  # walk on along the permutation's cycle until a body that has a digit: still one to one
            body = permute_number(body, key, back)
        return _put(text, body + _nhs_digit(body))
    if kind == "dni":
        body = permute_number(n[:8], key, back)
        return _put(text, body + DNI_LETTERS[int(body) % 23])
    return permute_number(text, key, back)


_COUNTRY = re.compile(rf"(?:\+|00)[ .\-/]?({'|'.join(sorted(COUNTRY_CODES, key=len, reverse=True))})")


def permute_phone(text: str, key: bytes, back: bool = False) -> str:
    """The digits of the subscriber's number permuted; country code and leading zeros stay as they are written.

    A number has the same permuted digits with and without its country code.
    """
    m = _COUNTRY.match(text.lstrip("("))
    start = m.end() + len(text) - len(text.lstrip("(")) if m else 0
    while start < len(text) and (not text[start].isdigit() or text[start] == "0"):
        start += 1
    rest = text[start:]
    digits = "".join(c for c in rest if c.isascii() and c.isdigit())
    first = digits[:1]
    if not first:
        return text
    # a first digit stays one from 1 to 9, or it would be read as a leading zero: walk on along the cycle
    new = permute_number(digits, key, back)
    while new[0] == "0":
        new = permute_number(new, key, back)
    return text[:start] + _put(rest, new)


def normal_form(kind: str, text: str) -> str:
    """What spellings of one value have in common."""
    low = unicodedata.normalize("NFKC", text).lower()
    if kind == "email":
        low = re.sub(r"\s*[\[({<]?\s*(?:\bat\b|\barroba\b|\baroba\b|@)\s*[\])}>]?\s*", "@", low, count=1)
        low = re.sub(r"\s*[\[({]\s*(?:dot|punto|punkt|point|\.)\s*[\])}]\s*|\s+(?:dot|punto|punkt|point)\s+|。", ".", low)
        return re.sub(r"\s+", "", low)
    if kind == "name" and "," in low:
        family, given = low.split(",", 1)
        low = f"{given} {family}"
    words = re.sub(r"[\W_]+", " ", low).split()
    return " ".join(_SHORTENED.get(w, w) for w in words) if kind == "address" else " ".join(words)


def pseudonym(kind: str, text: str, key: bytes) -> str:
    if kind == "phone":
        return permute_phone(text, key)
    if kind == "id_number":
        return permute_identity(text, key)
    h = int.from_bytes(hashlib.sha256(f"{kind}|{normal_form(kind, text)}".encode()).digest()[:16], "big")
    return f"{feistel(h, 1 << 64, 1 << 64, key, kind):032x}"


def _spans(it, names):
    finder = Finder(names.value)
    for pdf in it:
        rows = [(key, k, a, b, t[a:b]) for key, t in zip(pdf["id"], pdf["text"], strict=True) if isinstance(t, str) for a, b, k in finder.find(t)]
        yield pd.DataFrame(rows, columns=["id", "kind", "start_pos", "end_pos", "value"]).astype({"start_pos": "int32", "end_pos": "int32"})


def _replace(it, names, key: bytes):
    finder = Finder(names.value)
    for pdf in it:
        texts, counts = [], []
        for t in pdf["text"]:
            if not isinstance(t, str):
                texts.append(None)
                counts.append(0)
                continue
            out, at, spans = [], 0, finder.find(t)
            for a, b, k in spans:
                out += [t[at:a], f"[{k.upper()} {pseudonym(k, t[a:b], key)}]"]
                at = b
            texts.append("".join([*out, t[at:]]))
            counts.append(len(spans))
        yield pd.DataFrame({"id": pdf["id"], "text": texts, "n_replaced": pd.Series(counts, dtype="int32")})


def _names(names: DataFrame | None, spark):
    if names is None:
        return spark.sparkContext.broadcast([])
    rows = names.select("name", "name_kind").where("name is not null").limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"the list of names is sent to every task and may have {MAX_NAMES} rows")
    return spark.sparkContext.broadcast([(r[0], r[1]) for r in rows])


def personal_spans(df: DataFrame, id_col: str, text_col: str, names: DataFrame | None = None) -> DataFrame:
    """(id, kind, start_pos, end_pos, value): every item found, positions in code points from 0.

    Null and empty texts have none. Repeated rows give repeated spans. Only the two columns are read.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {dict(rows.dtypes)['id']}, kind string, start_pos int, end_pos int, value string"
    return map_pandas(rows, partial(_spans, names=_names(names, df.sparkSession)), schema)


def without_personal(df: DataFrame, id_col: str, text_col: str, key: bytes, names: DataFrame | None = None) -> DataFrame:
    """(id, text, n_replaced): the texts with ``[KIND pseudonym]`` in place of each item; null stays null."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_pandas(rows, partial(_replace, names=_names(names, df.sparkSession), key=key), f"id {dict(rows.dtypes)['id']}, text string, n_replaced int")
