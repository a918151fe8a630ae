"""Labels for the training pages of the page model: lines that are page furniture by well-known phrases and list shapes.

The tables have no labelled pages, so the bounded sample of pages that the model is trained on is labelled by these rules. No
rule and no phrase here is a feature of the model, and nothing here is used when pages are judged.
"""

from __future__ import annotations

import re

from loamstone.llm.boilerplate import _SPLIT, _WORD, kind_of

#: Phrases of page furniture, in English, German, French and Spanish.
FURNITURE = [
    "cookie", "trackers", "small text files", "small files on your device", "analytics identifiers", "privacy matters", "process device information",
    "traceurs", "dépôt de fichiers", "speicherung für", "almacenamiento durante", "accept all", "ok to all", "reject optional", "essential only", "allow all", "manage settings",
    "alle akzeptieren", "tout accepter", "tout refuser", "aceptar todo", "rechazar", "skip to main content", "skip to content", "back to top", "return to start", "nach oben", "haut de ",
    "volver arriba", "terms of use", "privacy terms", "modern slavery", "impressum", "datenschutz", "mentions légales", "données personnelles", "aviso legal", "privacidad",
    "all rights reserved", "alle rechte vorbehalten", "tous droits réservés", "todos los derechos", "copyright", "©", "powered by", "site by", "registered office", "company number",
    "call centre", "calls may be recorded", "ohne gewähr", "accepts no liability", "do not constitute advice", "haftet nicht", "décline toute responsabilité", "no se hace responsable",
    "select language", "sprache wählen", "choisir la langue", "you are here", "sie sind hier", "vous êtes ici", "está aquí", "read more", "follow us", "stay in touch", "newsletter", "weekly letter", "monthly digest", "morning note",
    "never miss", "enter your address", "our briefing", "abonnieren", "abonnez-vous", "suscríbase", "get alerts", "sign up for", "log in or", "free articles left", "views left", "reads left",
    "download our app", "rate this", "was this", "diese seite hilfreich", "hilfreich? ja nein", "vous a-t-elle été utile", "le ha sido útil", "leave a reply", "comments are closed", "will not be published",
    "reading time", "est. read", "text size", "lesezeit", "temps de lecture", "tiempo de lectura", "share this", "share on", "send this", "forward on", "forward this", "pass on", "copy link", "seite teilen", "partager", "compartir", "imprimir", "drucken merken",
    "advert", "promoted content", "sponsored", "continue reading below", "anzeige", "werbung", "publicité", "publicidad", "patrocinado", "session will time out", "javascript is", "report a problem", "previous next", "next page", "next article", "next entry", "next document", "página siguiente", "nächste seite", "page suivante",
    "join in for", "register for the", "you permit the storing", "you consent to the storing", "you agree to the storing",
]
#: Whole lines of page furniture.
LINES = {"top", "share", "print", "ad", "teilen", "drucken", "oben", "haut", "arriba"}
#: First words of search boxes.
SEARCH = ("search ", "suche ", "rechercher ", "buscar ")
#: Words with which a notice speaks to its reader.
_ADDRESS = set("we our us you your accept wir uns unsere sie ihre ihnen nous notre nos vous votre vos nosotros nuestro nuestra nuestros usted su sus utilizamos usamos".split())
#: Headings over lists of other pages.
TEASERS = [
    "elsewhere on this site", "most read", "trending now", "related articles", "you may also like", "latest from the blog", "more on this topic", "related", "see also", "read next", "recommended",
    "mehr zum thema", "das könnte sie auch interessieren", "meistgelesen", "weitere artikel", "à lire aussi", "les plus lus", "sur le même sujet", "artículos relacionados", "lo más leído", "también le puede interesar", "promoted content",
]
#: Entries of menus.
MENU = {
    w for w in """home|about us|about|contact|help|faq|search|news|newsroom|press room|press|media gallery|multimedia|videos|podcasts|blog|events|calendar|careers|procurement|publications|research|working papers|statistics|data portal|markets|banknotes|payments|supervision|regulation|legal framework|speeches|archive|glossary|education|annual report|investor relations|topics|site map|sitemap|subscribe|register|log in|login|my account|privacy|terms|cookies|accessibility
startseite|über uns|kontakt|hilfe|suche|presse|veröffentlichungen|forschung|statistik|märkte|bargeld|zahlungsverkehr|aufsicht|reden|termine|archiv|glossar|bildung|karriere|impressum|mediathek|themen
accueil|qui sommes-nous|nous contacter|presse|publications|recherche|statistiques|marchés|paiements|supervision|discours|agenda|carrières|plan du site
inicio|quiénes somos|contacto|prensa|publicaciones|estudios|estadísticas|mercados|pagos|supervisión|discursos|agenda|empleo|mapa web|mapa del sitio""".replace("\n", "|").split("|")
}
#: Words that also head sections of articles, and do not make a menu alone.
_PLAIN = {"data", "statistics", "research", "publications", "topics", "regulation", "supervision", "markets", "payments"}

_COUNTER = re.compile(r"^\d+ (?:shares?|comments?|likes?|views?|reads?|replies|reactions?|kommentare?|mal geteilt|partages?|commentaires?|vues?|comentarios?|vistas|veces compartido)$")
def _phrases():
    """Counts the furniture phrases in a text."""
    try:
        import ahocorasick
    except ImportError:
        found = re.compile("|".join(map(re.escape, FURNITURE)))
        return lambda text: len(found.findall(text))
    found = ahocorasick.Automaton()
    for x in FURNITURE:
        found.add_word(x, len(x))
    found.make_automaton()
    return lambda text: sum(1 for _ in found.iter(text))


phrases = _phrases()


def labelled(site: str, title: str, lines: list[tuple[int, str, bool]]) -> list[int]:
    """1 for each line that the fixed phrases and list shapes call boilerplate, else 0: labels for training."""
    words = [_WORD.findall(t.lower()) for _, t, _ in lines]
    kinds = [kind_of(t, len(w)) for (_, t, _), w in zip(lines, words, strict=True)]
    low = [t.lower() for _, t, _ in lines]
    named = next((i for i, x in enumerate(low) if title and x.startswith(title.lower()) and len(x) < len(title) + 12), None)
    first = next((i for i, k in enumerate(kinds) if k in ("para",) or k == "sent" and len(words[i]) >= 10 and phrases(low[i]) < 1), len(lines))
    out = [0] * len(lines)
    teaser = ""  # what the list under a teaser heading is made of
    for i, (text, kind) in enumerate(zip(low, kinds, strict=True)):
        entries = [x.strip() for x in _SPLIT.split(text) if x.strip()]
        menu = sum(x in MENU for x in entries)
        if text in TEASERS:
            out[i], teaser = 1, "open"
            continue
        if i == named:
            teaser = ""
            continue
        hits = phrases(text)
        if hits and "cookie" in text and len(words[i]) > 12 and not _ADDRESS.intersection(words[i]):
            hits -= 1  # a notice speaks to its reader; this sentence speaks of cookies
        if hits > 1 or hits > 0 and len(text) < 260:
            out[i] = 1
            continue
        if text.startswith(SEARCH) and len(words[i]) <= 6 or _COUNTER.match(text) or text in LINES:
            out[i] = 1
            continue
        if menu * 2 >= len(entries) and (len(entries) > 1 or text not in _PLAIN or (out[i - 1] if i else 1) or i < (named or first)):
            out[i] = 1
            continue
        tokens = {*text.replace("/", " ").split()}
        if kind in ("title", "long") and len(tokens) >= 4 and all(w in _MENU_WORDS for w in tokens):
            out[i] = 1
            continue
        if teaser:
            if kind in ("item", "numbered") and teaser in ("open", "list"):
                out[i], teaser = 1, "list"
                continue
            if kind == "title" and teaser in ("open", "titles", "title", "sentence"):
                out[i], teaser = 1, "titles" if teaser in ("titles", "title") else "title"
                continue
            # a list has a sentence under every title or under none
            if kind == "sent" and teaser == "title" and text[0] not in "“\"«„":
                out[i], teaser = 1, "sentence"
                continue
            teaser = ""
        if kind == "item":
            out[i] = 1
    return out


_MENU_WORDS = {w for entry in MENU for w in entry.split()} | {"terms", "sitemap", "|", "·"}
