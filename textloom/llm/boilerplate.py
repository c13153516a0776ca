"""Problem 7: page furniture around the main body.

The pages of a host are laid end to end as a stream of lines (words of the folded line, digits as
``#``), and the suffixes that begin at a line are sorted by prefix doubling, which gives the runs of
lines that stand on several distinct pages, from one line to the longest. A line in such a run is
repeated; one in a run of two lines or more belongs to a repeated block. Repetition removes

* a repeated line that is worded as a sentence (a notice, a prompt), whatever it says -- unless most
  sentences of the page are repeated, which makes it a copy of other pages -- and
* a repeated block of lines that stands behind the page's last paragraph.

What repetition cannot tell: a repeated short line in the middle of the body may be a heading, and
a reader's comment, a byline or a teaser is furniture although it is unique, on a small host most
furniture is. There the page's layout decides -- lines before the title, behind a heading for
related links or comments, and behind the last paragraph are zones in which a line counts as
furniture -- and the wording of prompts, bylines and notices, or the site's own name. Links to other
pages are known by the titles of the host, or by beginnings and ends that titles have throughout
the table (counted over all titles).

A host of more than ``PAGES`` pages is cut into blocks by a hash of the page. What is counted is
counted over the whole host all the same: every block gives its lines and pairs of lines with their
numbers of pages, these are summed by host, and each block is told which of them stand on enough
pages (``LEAST_PAGES`` to ``MOST_PAGES``), in whatever block. A run of more lines is repeated only if
its pairs are, so pairs are enough. In the same way a block is told which of its lines are titles of
other pages of the host. The threshold knows nothing of blocks.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, ship
from .common import WordHashes, fold, mix, summed_tables, table_blocks
from .site_lines import site_of

PAGES = 400
MOST_COPIES = 64  #: deliveries of one page and text from which they are united before pages are grouped
LARGE_HOSTS = 200_000  #: hosts cut into blocks that are told to every task; 50 bytes each
#: a beginning or end of titles is a common one from these shares of all titles on
TITLE_BITS, BEGIN_SHARE, END_SHARE, LEAST_TITLES = 18, 0.0025, 0.01, 3
#: a run is repeated from this many pages on: a fiftieth of a small host's, never more than MOST_PAGES, so that what a large host prints on a small share of its pages is seen
LEAST_PAGES, MOST_PAGES = 3, 8

_MARK = re.compile(r"^\s*(?:[-–—•*»›▪◦·]|\d{1,2}[.)]|[a-z]\))\s+")
_SENTENCE = re.compile(r"[.!?…][\"'»”)\]]*$")

# What page furniture says, by kind, in four languages. Each is a whole line, folded.
NAVIGATION = """home|menu|search|search this site|skip to (?:main )?content|log ?in|sign in|log out|register|my account|services|our services|shop|store|news|contact|contact us|about|about us|donate|careers|jobs|research|press room|press|media|languages?|topics|topics a to z|a to z|find a clinic|for professionals|events|events near you|appointments|book an appointment|help|faq|close|open menu|back|next|previous|english|espanol|español|deutsch|français|blog|community|forum|resources|publications|locations|our team|get involved|volunteer
|startseite|suche|anmelden|abmelden|themen|themen von a bis z|aktuelles|angebote|spenden|über uns|kontakt|presse|termine|leistungen|mein konto|zum inhalt springen|sprachen?|karriere|hilfe|nachrichten|warenkorb
|accueil|rechercher|recherche|connexion|se connecter|thèmes|actualités|services|dons|faire un don|qui sommes nous|à propos|contact|boutique|mon compte|aller au contenu|langues?|presse|aide|rendez vous|emplois
|inicio|buscar|iniciar sesión|temas|noticias|servicios|donar|quiénes somos|sobre nosotros|contacto|tienda|mi cuenta|ir al contenido|saltar al contenido|idiomas?|prensa|ayuda|citas|empleo"""
CONSENT = r"""(?:accept|reject|allow|decline)(?: all| optional| necessary)*(?: cookies)?|manage (?:my )?(?:preferences|cookies|settings)|cookie (?:settings|policy|preferences)|.*\b(?:we|this (?:web)?site|this page) (?:use|uses|store|stores)\b.*\b(?:cookies|small files)\b.*|.*\bagree to our use of cookies.*|your choices are kept for .*|.*\bpartners process data about your visit.*|.*\bwithdraw consent\b.*
|(?:alle|nur notwendige)?\s*(?:annehmen|akzeptieren|ablehnen|zulassen)|alle (?:cookies )?(?:annehmen|akzeptieren|ablehnen)|.*\bverwenden cookies\b.*|(?:cookie |)einstellungen(?: für .*)?(?: verwalten)?
|tout (?:accepter|refuser)|(?:accepter|refuser)(?: tout)?|.*\butilisons des cookies\b.*|gérer (?:vos|mes) (?:préférences|cookies).*
|(?:aceptar|rechazar)(?: todo| todas)?|.*\b(?:usamos|utilizamos) cookies\b.*|configurar (?:las )?(?:preferencias|cookies).*"""
SHARING = r"""share|share (?:this|on|via)\b.*|copy (?:the )?link|save for later|print(?: this)?(?: page| article)?|email this.*|send (?:this )?to a friend|e mail this.*|tweet|was this (?:page|article|information) (?:helpful|useful).*|did you find this .*|tell us what you think|give (?:us )?(?:your )?feedback|rate this (?:page|article).*|take our .*survey|report a problem.*|(?:yes no)
|(?:seite |artikel )?(?:drucken|teilen)|(?:diese )?seite (?:drucken|teilen)|an eine? freund(?:in)? senden|link kopieren|war diese seite hilfreich.*|später lesen|ihre meinung.*|sagen sie uns .*meinung
|partager.*|imprimer(?: cette page)?|envoyer à une? amie?|copier le lien|cette page vous a t elle aidée.*|donnez votre avis|enregistrer pour plus tard
|compartir.*|imprimir(?: esta página)?|enviar a una? amig[ao]|copiar (?:el )?enlace|le sirvió esta página.*|díganos qué piensa|guardar para (?:más tarde|después)"""
BYLINES = r"""(?:medically )?(?:reviewed|written|checked|edited|authored) by (?:\w+[ .'’-]*){1,8}|(?:by|text|author|words|photo|photos|picture|pictures|editor) (?:\w+ ){1,6}\w+|page (?:checked|reviewed|updated) .*\d.*|(?:last )?(?:updated|reviewed|checked|modified|published|changed)(?: on)? (?:\w+ )?(?:\d|january|february|march|april|may|june|july|august|september|october|november|december).*|first published .*
|(?:medizinisch )?geprüft von .*|geschrieben von .*|(?:von|text|autorin|autor) \w+ \w+(?: für .*)?|stand (?:\d|januar|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember).*|(?:zuletzt )?(?:aktualisiert|geprüft|geändert)(?: am)? .*\d.*|letzte (?:aktualisierung|änderung|prüfung).*\d.*
|(?:relu|revu|écrit|rédigé|vérifié) par .*|par \w+ \w+(?: pour .*)?|(?:revu|relu|mis à jour|publié|vérifié)(?: en| le)? .*\d.*|dernière (?:mise à jour|révision|relecture).*
|(?:revisado|escrito|redactado|verificado) por .*|(?:por|texto) \w+ \w+(?: para .*)?|(?:actualizado|revisado|publicado)(?: en| el)? .*\d.*|última (?:revisión|actualización).*"""
ADVERTS = r"""advert(?:isement|ising)?|sponsored(?: content| by .*)?|ad|promoted|paid content|sign up for (?:our|the)\b.*|subscribe(?: to (?:our|the)\b.*| now| today)?|join \w+ (?:thousand |million )?(?:readers|members|others|women)\b.*|.*\b(?:newsletter|bulletin)\b.*(?:inbox|sign|subscribe|join|readers).*|get (?:our|the|tips)\b.*(?:inbox|letter|newsletter).*|download (?:the|our)\b.*\bapp\b.*|support (?!group|tights|belt|stockings)\w.*\b(?:gift|donation)\b.*|donate (?:now|today).*|every gift .*
|anzeige|werbung|gesponsert|erhalten sie .*(?:rundbrief|newsletter).*|(?:newsletter|rundbrief) (?:bestellen|abonnieren).*|unterstützen sie .*(?:spende|beitrag).*|laden sie .*\bapp\b.*
|publicité|annonce|sponsorisé|contenu sponsorisé|recevez (?:notre|la) (?:lettre|newsletter).*|abonnez vous.*|inscrivez vous à .*|soutenez .* don|téléchargez .*\bapp.*
|publicidad|anuncio|patrocinado|contenido patrocinado|reciba (?:nuestr[ao]|cada mes)\b.*|suscríbase.*|apoye a .* donativo|descargue .*\bapp.*"""
RELATED = r"""more on this (?:topic|subject)|more (?:like this|stories|articles|from .*)|related(?: articles| content| links| pages| topics| stories| posts)?|popular(?: this week| now| articles| pages| posts)?|most (?:read|popular|viewed)|you (?:may|might) (?:also )?(?:like|be interested in).*|see also(?: on .*)?|recommended(?: for you)?|further reading|trending(?: now)?|latest (?:news|articles|posts)|editors? picks|in this section|read next|keep reading
|ähnliche (?:beiträge|artikel|themen|seiten)|meistgelesen|meist gelesen|am meisten gelesen|das könnte sie (?:auch )?interessieren|mehr zum thema|weitere (?:beiträge|artikel|themen)|beliebt(?:e beiträge| diese woche)?|verwandte (?:themen|beiträge)|siehe auch.*
|articles? (?:liés?|associés?|similaires?|connexes?)|les plus lus|(?:à lire|lire) aussi|à voir aussi|sur le même (?:sujet|thème)|vous aimerez aussi|voir aussi.*|contenus? liés?|populaires?
|artículos relacionados|relacionados?|lo más (?:leído|visto)|más (?:leídos|sobre este tema)|también le puede interesar|te puede interesar|contenido relacionado|temas relacionados|ver también.*|véase también.*|populares"""
READ_MORE = r"(?:read more|see also|also read|more|related|lesen sie (?:auch|mehr)|mehr dazu|siehe auch|à lire aussi|lire aussi|voir aussi|lea también|leer más|vea también|ver también)\s*:\s*\S.*"
COMMENTS = r"""(?:reader )?comments?(?: \d+)?|\d+ comments?|leave a (?:reply|comment)|reader comments|(?:add|post|write) a comment|join the (?:discussion|conversation)|replies|\d+ replies|responses
|kommentare?|\d+ kommentare?|(?:einen )?kommentar(?:e)? (?:schreiben|hinterlassen|verfassen)|leserkommentare|ihr kommentar
|commentaires?|\d+ commentaires?|laisser un commentaire|vos commentaires|commentaires des lect(?:eurs|rices)|ajouter un commentaire
|comentarios?|\d+ comentarios?|dejar? un comentario|deje un comentario|comentarios de (?:lectores|lectoras)|escrib[ai]r? un comentario"""
SPEAKERS = r"(?:anonymous|visitor|guest|reader|user|member|besucher(?:in)?|gast|leser(?:in)?|nutzer(?:in)?|mitglied|visiteur|visiteuse|invitée?|lecteur|lectrice|membre|utilisat(?:eur|rice)|visitante|invitad[ao]|lectora?|usuari[ao]|miembro|anónim[ao]|anonym(?:e)?)"
LEGAL = r"""accessibility|site ?map|privacy(?: policy| notice)?|terms(?: of (?:use|service))?(?: and conditions)?|terms and conditions|complaints|follow us|back to top|disclaimer|legal(?: notice)?|copyright.*|imprint|(?:\(c\) |© ?).*|.*\ball rights reserved\b.*|.*\bregistered (?:body|charity|company|office|trademark)\b.*|funded by (?:the )?.*|if you think you may have an emergency.*|.*\bdoes not replace a (?:visit|consultation).*|.*\bnot (?:a )?substitute for (?:professional|medical).*|call (?:999|911|112) .*emergency.*|cookies?(?: policy)?
|datenschutz(?:erklärung)?|impressum|agb|nutzungsbedingungen|barrierefreiheit|nach oben|zum seitenanfang|folgen sie uns|seitenübersicht|.*\balle rechte vorbehalten\b.*|.*\bersetz(?:en|t) (?:keinen|nicht den) (?:arztbesuch|ärztlichen).*|gefördert (?:von|durch) .*|im notfall .*
|mentions légales|confidentialité|politique de confidentialité|conditions (?:générales )?d[' ]?utilisation|accessibilité|plan du site|haut de page|suivez nous|.*\btous droits réservés\b.*|.*\bne remplace(?:nt)? pas (?:un avis|une consultation).*|financé par .*|en cas d[' ]?urgence.*
|(?:aviso|nota) legal|(?:política de )?privacidad|política de (?:privacidad|cookies)|términos (?:de uso|y condiciones)|condiciones de uso|accesibilidad|mapa del sitio|volver arriba|síganos|.*\btodos los derechos reservados\b.*|.*\bno sustituye (?:la|una|a la) (?:consulta|visita).*|financiado por .*|en caso de emergencia.*"""

#: what lines hold that match a pattern beginning with anything: a quick test before those
_STEMS = ("cookie", "small files", "consent", "choices are", "your visit", "newsletter", "bulletin", "reserved", "registered", "replace", "substitute", "vorbehalten", "ersetz", "réservés", "remplace", "reservados", "sustituye")


def _alternatives(p: str) -> list[str]:
    """The alternatives of a pattern's outermost level."""
    out, depth = [""], 0
    for c in "|".join(x.strip("|") for x in p.split("\n")):
        depth += (c == "(") - (c == ")")
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def _rx(p: str) -> tuple[re.Pattern, re.Pattern | None]:
    """The alternatives that begin with something, and those that begin with anything."""
    each = _alternatives(p)
    free = [x for x in each if x.startswith(".*")]

    def whole(x):
        return re.compile("(?:" + "|".join(x) + r")\W*$")

    return whole([x for x in each if not x.startswith(".*")]), whole(free) if free else None


_FIXED = {"navigation": _rx(NAVIGATION), "consent": _rx(CONSENT), "sharing": _rx(SHARING), "byline": _rx(BYLINES), "advert": _rx(ADVERTS), "related": _rx(RELATED), "comments": _rx(COMMENTS), "legal": _rx(LEGAL)}
_READ_MORE = re.compile(READ_MORE)
_SPEAKER = re.compile(rf"{SPEAKERS}\s*\d*\s*(?:\([^)]*\))?\s*:\s*\S")
_HOME = re.compile(r"(?:home|startseite|accueil|inicio)\b\s*[›»>/|→·]")
_SEPARATOR = re.compile(r"\s*[|·•/→›»]\s*|\s{2,}|\t")
_DIGITS = re.compile(r"\d+")
_TITLE_END = re.compile(r"\s+(?:[|–—-]|::)\s+[^|–—]{2,60}$")


def _form(line: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", line))


def _distinct_pages(run: np.ndarray, pages: np.ndarray) -> np.ndarray:
    """The distinct pages of each place's run."""
    pairs = np.unique(np.stack((run, pages)), axis=1)
    name, count = np.unique(pairs[0], return_counts=True)
    return count[np.searchsorted(name, run)]


def repeated_runs(lines: np.ndarray, texts: np.ndarray, pages: np.ndarray, least: int) -> np.ndarray:
    """For each line the longest run of lines around it, in powers of two, that stands on ``least`` pages; 0 for none.

    Suffixes are ranked by their first 1, 2, 4, ... lines until no rank is left that is repeated.
    """
    n = len(lines)
    best, rank, length, at = np.zeros(n, np.int64), np.unique(lines, return_inverse=True)[1], 1, np.arange(n)
    while len(at):
        often = at[_distinct_pages(rank[at], pages[at]) >= least]
        if not len(often):
            break
        mark = np.zeros(n + 1, np.int64)
        np.add.at(mark, often, 1)
        np.add.at(mark, often + length, -1)
        best[np.cumsum(mark)[:n] > 0] = length
        # a longer run can only be repeated where both its halves are
        at = often[np.isin(often + length, often)]
        at = at[at + 2 * length <= n]
        at = at[texts[at] == texts[at + 2 * length - 1]]
        pair = np.unique(np.stack((rank[at], rank[at + length])), axis=1, return_inverse=True)[1].ravel()
        rank = np.full(n, -1, np.int64)
        rank[at] = pair
        length *= 2
    return best


class _Stream:
    """The lines of a block end to end: hash, text and page of each."""

    def __init__(self, texts: list[str], names: list):
        of, known = {}, {}
        self.lines, hashes, pages = [], [], []
        for p, t in enumerate(texts):
            page = of.setdefault(names[p], len(of))
            for k, line in enumerate(t.split("\n")):
                h = known.get(line)
                if h is None:
                    form = _DIGITS.sub("#", _form(fold(line)))
                    h = known[line] = xxhash.xxh3_64_intdigest(form) if form else 0
                if h:
                    self.lines.append((p, k))
                    hashes.append(h)
                    pages.append(page)
        self.sizes = [t.count("\n") + 1 for t in texts]
        self.line = np.array(hashes, np.uint64)
        self.text = np.array([p for p, _ in self.lines], np.int64)
        self.page = np.array(pages, np.int64)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where two lines of a text follow one another, and the pairs' hashes."""
        at = np.flatnonzero(self.text[:-1] == self.text[1:]) if len(self.line) else np.zeros(0, np.int64)
        return at, mix(self.line[at] * np.uint64(0x100000001B3) + mix(self.line[at + 1])) if len(at) else np.zeros(0, np.uint64)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """(key, pages) of the lines and pairs of lines."""
        at, pair = self.pairs()
        key, page = np.concatenate((self.line, pair)), np.concatenate((self.page, self.page[at]))
        once = np.unique(np.stack((key, page.astype(np.uint64))), axis=1)
        name, count = np.unique(once[0], return_counts=True)
        return name.view(np.int64), count

    def told(self, known: np.ndarray) -> np.ndarray:
        """``repeated_runs`` from the keys that stand on enough pages of the host; 2 for all longer runs."""
        best = np.isin(self.line.view(np.int64), known).astype(np.int64)
        at, pair = self.pairs()
        at = at[np.isin(pair.view(np.int64), known)]
        best[at], best[at + 1] = 2, 2
        return best

    def flags(self, best: np.ndarray) -> list[np.ndarray]:
        """The runs line by line of each text."""
        out = [np.zeros(n, np.int64) for n in self.sizes]
        for (p, k), b in zip(self.lines, best.tolist(), strict=True):
            out[p][k] = b
        return out


class Titles:
    """How often words begin and end the titles of all pages: first two, last two, last, and any place."""

    def __init__(self, counts: np.ndarray, n: int):
        self.counts, self.hashes = counts, WordHashes()
        self.begin, self.end = max(LEAST_TITLES, BEGIN_SHARE * n), max(LEAST_TITLES, END_SHARE * n)

    @staticmethod
    def places(hashes: WordHashes, form: str) -> tuple[list[int], list[int], list[int], list[int]]:
        w = form.split(" ")
        at = [[" ".join(w[:2])], [" ".join(w[-2:])], w[-1:], w]
        return tuple([hashes[f"{k} {x}"] >> (64 - TITLE_BITS) for x in xs] for k, xs in enumerate(at))

    def like(self, form: str) -> bool:
        """The line begins as many titles do, or ends as many do in a word that stands nowhere else."""
        if " " not in form:
            return False
        first, last2, last, any_ = (self.counts[k][at[-1]] for k, at in enumerate(self.places(self.hashes, _DIGITS.sub("#", form))))
        # topics stand anywhere in titles, what only ends them does not
        return first >= self.begin or (last >= 0.95 * any_ and max(last, last2) >= 2 * self.end)


def _count_titles(it):
    hashes, counts = WordHashes(), np.zeros((4, 1 << TITLE_BITS), np.int64)
    for pdf in it:
        for t in pdf["title"]:
            form = _DIGITS.sub("#", _form(fold(_TITLE_END.sub("", t)))) if isinstance(t, str) else ""
            if " " in form:
                for k, at in enumerate(Titles.places(hashes, form)):
                    for x in at:
                        counts[k, x] += 1
    yield from table_blocks(counts.ravel())


def title_counts(rows: DataFrame) -> np.ndarray:
    """The counts of ``Titles`` over all rows (title)."""
    return summed_tables(rows.select("title").where("title is not null"), _count_titles, 4 << TITLE_BITS).reshape(4, -1)


def _kind(line: str) -> str | None:
    """The furniture a whole line is worded as; short lines recur and are remembered."""
    return _kind_of_short(line) if len(line) <= 100 else _kind_of(line)


def _kind_of(line: str) -> str | None:
    free = any(x in line for x in _STEMS)
    for name, (rx, rx_free) in _FIXED.items():
        if rx.match(line) or (free and rx_free and rx_free.match(line)):
            return name
    if _READ_MORE.match(line):
        return "related"
    if _SPEAKER.match(line):
        return "comments"
    if _HOME.match(line):
        return "navigation"
    return None


_kind_of_short = lru_cache(maxsize=100_000)(_kind_of)


def _low(line: str) -> str:
    return re.sub(r"\s+", " ", _MARK.sub("", fold(line))).strip().replace("’", "'")


def _head(low: str) -> str:
    return low.split(" – ")[0]


def furniture(text: str, title: str | None, run: np.ndarray, site: str, titles: set[str], like_title=lambda form: False) -> list[tuple[int, str]]:
    """(line number from 1, kind) of the lines of a page that are not its main body.

    ``run`` has the lengths of the repeated runs the lines lie in, ``titles`` the host's titles.
    """
    repeated = run > 0
    raw = [x.replace("\r", "") for x in text.split("\n")]
    marked = [bool(_MARK.match(x)) for x in raw]
    low = [_low(x) for x in raw]
    plain = [_form(x) for x in low]
    name = _form(fold(re.split(r"\.", site)[0]))
    own = {_form(fold(title)), _form(fold(_TITLE_END.sub("", title)))} - {""} if title else set()
    kinds: list[str | None] = []
    for x, y, w in zip(raw, low, plain, strict=True):
        k = None
        if w:
            k = _kind(y) or _kind(w)
            if not k and w not in own:
                pieces = [z for z in _SEPARATOR.split(fold(_MARK.sub("", x)).strip()) if _form(z)]
                if len(pieces) > 1:
                    said = [_kind(re.sub(r"\s+", " ", z)) or _kind(_form(z)) or ("legal" if name and name in _form(z) else None) for z in pieces]
                    if all(said) or (len(said) > 2 and sum(map(bool, said)) >= 0.6 * len(said)):
                        k = said[0] or "navigation"
            if not k and len(name) > 5 and f" {name} " in f" {w} " and w not in own and (repeated[len(kinds)] or not (len(y) >= 50 and _SENTENCE.search(y))):
                k = "legal"
        kinds.append(k)
    n = len(raw)
    # sentences that the host repeats are notices, unless most of the page's are: then it is a copy of others
    said = [k for k in range(n) if kinds[k] is None and len(low[k]) >= 50 and plain[k] not in own and _SENTENCE.search(low[k])]
    if sum(repeated[k] for k in said) <= len(said) / 2:
        for k in said:
            if repeated[k]:
                kinds[k] = "notice"
    at = next((k for k in range(n) if plain[k] in own and not marked[k]), next((k for k in range(n) if plain[k] in own), None))
    paragraph = [bool(w) and k is None and bool(_SENTENCE.search(y)) and len(y) >= 50 and " – " not in y[:90] for y, w, k in zip(low, plain, kinds, strict=True)]
    first = at if at is not None else next((k for k in range(n) if paragraph[k]), n)
    start = next((k for k in range(n) if paragraph[k]), n)
    if at is not None and at > start and sum(paragraph[:at]) > 1:
        first, at = start, None  # the title only stands further down, as a link
    # related links and comments run on until something of another kind
    zone = None
    for k in range(n):
        if not plain[k]:
            continue
        if kinds[k] in ("related", "comments") and not _READ_MORE.match(low[k]) and k > first:
            zone = kinds[k]
        elif kinds[k] in ("legal", "sharing", "advert", "byline", "consent", "navigation", "notice"):
            zone = zone if kinds[k] in ("sharing", "advert", "notice") else None
        elif zone and paragraph[k] and not (zone == "comments"):
            zone = None
        elif zone and kinds[k] is None:
            kinds[k] = zone
    if at is not None:
        for k in range(at):
            if plain[k] and kinds[k] is None:
                kinds[k] = "navigation"
    else:
        for k in range(first):
            if kinds[k] is None and plain[k] and repeated[k] and any(kinds[j] for j in range(k + 1, first)):
                kinds[k] = "navigation"
    # behind the last paragraph: links are headlines of other pages, or repeated on the host
    last = max((k for k in range(n) if paragraph[k] and kinds[k] is None), default=first)
    for k in range(last + 1, n):
        if plain[k] and kinds[k] is None and k != at:
            head = _head(low[k])
            if _form(head) in titles - own or (not head.endswith(":") and like_title(_form(head))) or (repeated[k] and not marked[k] and not low[k].endswith(":") and (run[k] > 1 or _between(kinds, plain, k, n))):
                kinds[k] = "related"
            elif " – " in low[k] and _SENTENCE.search(low[k]):
                kinds[k] = "related"
    # a list of links is closed: what stands between two of its lines is one as well; before its first
    # line so do lines that the host repeats, and lines without a mark behind a list with marks
    tail = [k for k in range(last + 1, n) if plain[k]]
    at_tail, i = {k: j for j, k in enumerate(tail)}, 0
    while i < len(tail):
        j = i
        while j < len(tail) and kinds[tail[j]] is None and tail[j] != at and not low[tail[j]].endswith(":") and not paragraph[tail[j]]:
            j += 1
        if j == i:
            i += 1
            continue
        # a single "read more" inside the body opens or closes no list
        before, after = (("end" if m == len(tail) else None) if not 0 <= m < len(tail) else "sharing" if _READ_MORE.match(low[tail[m]]) else kinds[tail[m]] for m in (i - 1, j))
        if before == "related" and after in ("related", "legal", "comments", "end"):
            for k in tail[i:j]:
                kinds[k] = "related"
        elif after == "related" and not (_FIXED["related"][0].match(low[tail[j]]) or _FIXED["related"][0].match(plain[tail[j]])):
            listed = next((m for m in range(j - 1, -1, -1) if kinds[tail[m]] is None and marked[tail[m]]), None)
            for k in reversed(tail[i:j]):
                if marked[k] or not (repeated[k] or (listed is not None and at_tail[k] > listed)):
                    break
                kinds[k] = "related"
        i = j
    return [(k + 1, kinds[k]) for k in range(n) if plain[k] and kinds[k]]


def _between(kinds, plain, k: int, n: int) -> bool:
    """Both neighbours that are not blank are furniture (or the page ends)."""
    after = next((kinds[j] for j in range(k + 1, n) if plain[j]), "end")
    before = next((kinds[j] for j in range(k - 1, -1, -1) if plain[j]), None)
    return bool(after) and bool(before)


def _title_key(form: str) -> int:
    return xxhash.xxh3_64_intdigest("title " + form) - (1 << 63)


def _titles(pdf: pd.DataFrame) -> set[str]:
    return {_form(fold(_TITLE_END.sub("", t))) for t in pdf["title"] if isinstance(t, str)} - {""}


def _heads(texts: list[str]) -> set[str]:
    return {_form(_head(_low(x.replace("\r", "")))) for x in {x for t in texts for x in t.split("\n")}} - {""}


def _once(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.drop_duplicates(["page", "text"])


def _block_keys(pdf: pd.DataFrame) -> pd.DataFrame:
    """The lines and pairs of a block with their pages; its titles, which always count, and the lines that may be titles of others."""
    pdf = _once(pdf)
    texts = pdf["text"].tolist()
    titles = _titles(pdf)
    key, pages = _Stream(texts, pdf["page"].tolist()).counted()
    told = {_title_key(t): MOST_PAGES * (t in titles) for t in titles | _heads(texts)}
    key = np.concatenate((key, np.fromiter(told, np.int64, len(told))))
    pages = np.concatenate((pages, np.fromiter(told.values(), np.int64, len(told))))
    return pd.DataFrame({"site": pdf["site"].iat[0], "block": pdf["block"].iat[0], "least": pdf["least"].iat[0], "key": key, "pages": pages})


def least_pages(n: int) -> int:
    return max(LEAST_PAGES, min(MOST_PAGES, n // 50))


def _pages(pdf: pd.DataFrame, told: pd.DataFrame | None = None, like_title=lambda form: False) -> pd.DataFrame:
    """The furniture of a host, or of a block of a larger host with the keys that count on the host."""
    pdf = _once(pdf)
    texts, names = pdf["text"].tolist(), pdf["page"].tolist()
    stream = _Stream(texts, names)
    if told is None or pd.isna(pdf["n"].iat[0]):
        run, titles = repeated_runs(stream.line, stream.text, stream.page, least_pages(len(texts))), _titles(pdf)
    else:
        known = told["key"].to_numpy(np.int64)
        own = set(known.tolist())
        run, titles = stream.told(known), {h for h in _heads(texts) if _title_key(h) in own}
    rows = []
    for p, t, title, site, f in zip(names, texts, pdf["title"], pdf["site"], stream.flags(run), strict=True):
        key = hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
        rows.extend((p, key, k, kind) for k, kind in furniture(t, title if isinstance(title, str) else None, f, site or "", titles, like_title))
    return pd.DataFrame(rows, columns=["page", "text_key", "line_no", "kind"]).astype({"line_no": "int32"})


def page_furniture(df: DataFrame, page_col: str, text_col: str, title_col: str, urls: list[str]) -> DataFrame:
    """(page, text_key, line_no, kind): the lines that are not main body; lines split at ``\\n``, from 1.

    Null and empty pages have none; blank lines and lines without a letter or digit are no cases. A
    page fetched with several texts has the lines of each, told apart by the text's SHA-256. Pages without a host form a host of their
    own. Repeated rows are read once. Columns other than those named are not read.
    """
    spark = df.sparkSession
    ship(spark)
    site = F.coalesce(site_of(*(F.col(u) for u in urls)), F.lit(""))
    rows = df.select(F.col(page_col).alias("page"), site.alias("site"), F.col(title_col).alias("title"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("text").isNotNull() & (F.col("text") != ""))
    titles = title_counts(rows)
    like = spark.sparkContext.broadcast((titles.astype(np.int32), int(titles[0].sum())))
    # page texts of a host, and how often one was delivered; no text is shuffled for that
    seen = rows.groupBy("site", "page", F.xxhash64("text").alias("h")).agg(F.count(F.lit(1)).alias("copies")).groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("copies"))
    seen = checkpointed(seen)
    large = seen.where(F.col("n") > PAGES).select("site", "n")
    facts = seen.agg(F.max("copies").alias("copies"), F.count_if(F.col("n") > PAGES).alias("large")).first()
    if (facts["copies"] or 0) > MOST_COPIES:
        rows = rows.dropDuplicates(["page", "text"])
    rows = rows.join(F.broadcast(large) if facts["large"] <= LARGE_HOSTS else large, "site", "left")
    least = F.greatest(F.lit(LEAST_PAGES), F.least(F.lit(MOST_PAGES), F.floor(F.col("n") / 50))).cast("int")
    rows = rows.withColumn("least", least).withColumn("block", F.coalesce(F.pmod(F.xxhash64("page"), F.ceil(F.col("n") / PAGES)), F.lit(0)))
    keys = rows.where("n is not null").groupBy("site", "block").applyInPandas(_block_keys, "site string, block long, least int, key long, pages long")
    told = keys.withColumn("pages", F.sum("pages").over(Window.partitionBy("site", "key"))).where(F.col("pages") >= F.col("least")).select("site", "block", "key")

    def pages(block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        return _pages(block, known, Titles(*like.value).like) if len(block) else pd.DataFrame({"page": [], "text_key": [], "line_no": [], "kind": []})

    schema = f"page {dict(rows.dtypes)['page']}, text_key string, line_no int, kind string"
    return rows.groupBy("site", "block").cogroup(told.groupBy("site", "block")).applyInPandas(pages, schema).distinct()


def _join(it):
    for pdf in it:
        out = []
        for t, drop in zip(pdf["text"], pdf["drop"], strict=True):
            gone = set() if drop is None else set(np.asarray(drop).tolist())
            out.append("\n".join(x for k, x in enumerate(t.split("\n"), 1) if k not in gone) if isinstance(t, str) else None)
        yield pd.DataFrame({"page": pdf["page"], "text": out})


def main_body(df: DataFrame, page_col: str, text_col: str, title_col: str, urls: list[str]) -> DataFrame:
    """(page, text): each distinct page text reduced to its main body; null stays null."""
    bad = page_furniture(df, page_col, text_col, title_col, urls).groupBy("page", "text_key").agg(F.collect_set("line_no").alias("drop"))
    rows = df.select(F.col(page_col).alias("page"), F.col(text_col).alias("text")).distinct()
    rows = rows.withColumn("text_key", F.sha2("text", 256)).join(bad, ["page", "text_key"], "left")
    return rows.mapInPandas(_join, f"page {dict(rows.dtypes)['page']}, text string")
