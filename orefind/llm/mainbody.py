"""The main body of web pages, told from menus, notices, teasers and footers line by line.

Each line is a text block. What is measured of it and of the blocks around it is its words, its link density (the share
of its words in pieces such as links have: short, without the end of a sentence), whether it ends a sentence, how many of
its pairs of words are those of boilerplate, whether the page's address names it, how far the nearest running text is, on
what share of the site's pages it stands, and on what share of their pages other sites that have it repeat it. A decision
tree, grown from a small table of labelled pages, sorts the lines by that.

The labelled pages are invented, and no line of them is one of the test tables'; what is usual wording there, the tree
learns from the two shares of repetition alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefind.sources.shared import written

# The labelled table. Of each page its address, then its lines: + main body, - boilerplate, = boilerplate that the site repeats,
# ~ boilerplate, such as titles of other pages, whose words say nothing.
LABELLED = """\
https://www.harbour.example/journal/repairing-an-old-bicycle-482.html
=Main menu
=Homepage
=Shop
=Our team
=Gallery
=Weather
=Topics
=Opinion
=Sign in
=Create an account
=Shopping cart
=Investors
=Help & FAQ
=This website uses cookies to give you the best experience.
=Accept cookies
=Reject all cookies
=Cookie preferences
=Save my choices
-Homepage > Workshop > Repairing an old bicycle
+Repairing an old bicycle
+My neighbour found the frame behind a shed in March. The chain had rusted through, and two of the spokes were missing. She asked me whether it was worth the trouble.
+What you need
-Sponsored content
-Your email
+A set of spanners, some oil and an afternoon are enough for most of the work. Patience helps as well.
-Sponsored content
+Beginning
+Take off the wheels before anything else. If the axle is bent, no amount of grease will make it turn again, as the mechanic in Lower Dunford told us.
+Tools
-Continue reading: How we built a tandem
+The list is short:
+Spanners and tyre levers;
+A clean rag.
+Brake cables, cheap ones.
+Costs
-Advertiser's choice: pumps and lamps
+In the end the repair took three evenings and cost less than a ticket to the coast.
-Share on Facebook
-Share via email
-Print this article
-Copy the address
-Save for later
-14 replies
-Add a comment
-Views: 310
-5 people like this
-Recommended for you
~Painting in cold weather
~Lanterns along the canal
~Dunford: the ferry returns
-Join our mailing list
-Your email
-One message a week, and you may unsubscribe whenever you like
=Follow Harbour on social media
=Copyright 2011-2019 Harbour Media
=Harbour Media Inc., 9 Main Street, Dunford
=Company number 482913
=Terms and conditions | Privacy policy | Legal notice | Contact us
=Sitemap
=Back to the beginning of the page
=Website by Dunford Studio
=The views expressed here are those of the authors and need not be the position of Harbour.
=Harbour is not responsible for what external sites contain.
=Support independent reporting and give to Harbour today.
http://blog.saltmarsh.example/2017/notes-on-baking-rye-bread/
=Skip navigation
=Close menu
=World
=Sports
=Video
=Podcasts
=Jobs - Developers - Services - Solutions - Advertise - Archive
=Search this site
=We and our partners use technologies such as cookies to personalise content and ads.
=I agree
=Manage options
=More information
=Switch language
-Popular this week
~The lighthouse keeper's dog
~Fences, hedges, ditches
+Notes on baking rye bread
+Rye dough is sticky, and beginners add far too much flour. On 3 May 2016 I weighed every loaf for a week to see what difference a warm kitchen makes.
-Paid post
+Failures
-Sponsored by the guild
+A sour starter needs time. Did the last loaf collapse because the oven was cold? Probably not: the crumb was already wet at noon.
+The newsletter of the bakers' guild printed the same advice in 1987, and readers wrote in to disagree.
+Cookies and rolls from the same oven came out well.
-Read next
+What I would change
+Less water, a longer rest and a hotter stone. Everything else can stay as it is.
-Tweet
-Email this to a friend
-Comments (8)
-Log in to post a comment
-Previous article: Hedges in winter
-Next article: A week without salt
-Related stories
~Ditches after the flood
~Saltmarsh 12: geese on the lawn
-Sign up for our daily letter
=Privacy notice - Conditions of use - Do not sell my personal information
=Copyright 2017 Saltmarsh
=Reproduction without written permission is prohibited.
=Nothing on this site is medical or financial advice, and Saltmarsh accepts no liability for errors.
=Proudly hosted by Saltmarsh Servers
https://m.kornfeld.example/ratgeber/ein-garten-ohne-torf-91.html
=Navigation überspringen
=Hauptmenü
=Unternehmen
=Leistungen
=Aktuelles
=Konto anlegen
=Merkzettel
=Sprache wechseln
=Diese Website verwendet Cookies, um Ihnen den bestmöglichen Service zu bieten.
=Cookies akzeptieren
=Alle Cookies ablehnen
=Datenschutzeinstellungen
=Auswahl speichern
=Mehr erfahren
-Sie sind hier: Ratgeber / Beete / Ein Garten ohne Torf
+Ein Garten ohne Torf
+Wer im Frühjahr Erde kauft, achtet selten auf den Torf. Dabei geht es auch ohne, wie Frau Lenz aus Oberried seit neun Jahren zeigt.
+Boden
+Kompost, Rindenhumus und etwas Sand reichen für die meisten Beete. Am 4. Mai 2015 wurde das Gemisch zum ersten Mal gewogen.
-Werbung
+Erste Erfahrungen
-Lesen Sie mehr: Moor und Torf
-Werbung
+Die Tomaten wuchsen langsamer. Im August war davon nichts mehr zu sehen, sagte der Nachbar.
-Lesen Sie mehr: Hecken richtig schneiden
+Fazit
+Kurz gesagt:
+Kompost aus dem eigenen Garten;
+Sand, fein gesiebt.
+Zum Schluss wird gewässert, und zwar reichlich.
-Auf Facebook teilen
-Artikel drucken
-Als Nachricht versenden
-Link kopieren
-4 Antworten
-Kommentar schreiben
-Zuletzt geändert vor 3 Tagen
-Beliebte Beiträge
~Hecken nach dem Frost
~Oberried: Störche kehren zurück
-Mehr zum Thema
~Sand, Lehm, Ton
-Vorheriger Beitrag
-Nächster Beitrag
-Unser Newsletter: jede Woche neu
-Ihre Mailadresse
-Sie können sich jederzeit abmelden
=Copyright 2016 Kornfeld Verlag
=Kornfeld Verlag AG, Marktplatz 4, Oberried
=Amtsgericht Oberried, HRB 4711
=Datenschutzerklärung | Impressum und Kontakt | Nutzungsbedingungen
=Alle Rechte liegen beim Verlag.
=Seitenanfang
=Für externe Links übernehmen wir keine Haftung.
=Alle Angaben ohne Gewähr; sie ersetzen keine Beratung, und Kornfeld haftet nicht für Verluste.
https://www.rivage.example/articles/un-phare-sans-gardien-77
=Menu principal
=Boutique
=Actualités
=Nos services
=Se connecter
=Créer un compte
=Aide et contact
=Ce site utilise des cookies pour vous offrir la meilleure expérience.
=Accepter les cookies
=Refuser les cookies
=Paramétrer mes choix
=En savoir plus
-Vous êtes ici : Articles / Côte / Un phare sans gardien
+Un phare sans gardien
+Le dernier gardien a quitté le phare en novembre. Depuis, une horloge allume la lampe, et personne ne monte plus les cent marches.
+Histoire
+La tour date de 1864. Les habitants de Port-Mazan l'ont payée eux-mêmes, pierre après pierre.
-Contenu sponsorisé
-Lire la suite : les bouées de la rade
+Que faire de la maison ?
-Contenu sponsorisé
+On parle d'un musée, d'un gîte, parfois d'une démolition. Le maire ne dit rien.
+Les projets
+Trois idées reviennent :
+Un musée de la mer;
+Un gîte pour les marcheurs.
+Rien n'est décidé, et l'hiver approche.
-Partager sur Facebook
-Imprimer cet article
-Envoyer à un ami
-Copier l'adresse
-Laisser une réponse
-8 réponses
-Lu par 320 personnes
-Sur le même sujet
~Les bouées sous la neige
~Port-Mazan: un bac pour les îles
-Article précédent
-Article suivant
-Inscrivez-vous à notre infolettre
-Votre adresse de messagerie
-Vous pouvez vous désabonner quand vous voulez
=Politique de confidentialité | Conditions générales | Nous contacter
=Copyright 2015 Rivage
=Rivage SA, 12 avenue de la Gare, Port-Mazan
=RCS Port-Mazan 482 913 077
=Toute reproduction est interdite sans accord écrit.
=Retour en haut
=Rivage n'est pas responsable du contenu des sites externes.
=Les informations de ce site ne remplacent pas un conseil, et Rivage décline toute responsabilité.
http://ladera.example/reportajes/el-ultimo-tren-de-la-sierra-5.html
=Menú principal
=Tienda
=Noticias
=Servicios
=Iniciar sesión
=Crear cuenta
=Esta web utiliza cookies para ofrecerle la mejor experiencia.
=Aceptar cookies
=Rechazar cookies
=Preferencias
=Más información
-Está en: Reportajes / Sierra / El último tren de la sierra
+El último tren de la sierra
+El tren subió por última vez en abril. Llevaba doce viajeros, dos perros y un saco de harina.
+Por qué se cerró
+La vía costaba más de lo que daba. En 2009, según el alcalde de Valdemora, nadie quiso pagar el puente.
-Contenido patrocinado
-Siga leyendo: las minas de plata
+Restos
+Quedan las traviesas, un reloj parado y la cantina. Los domingos abre todavía.
+Planes
-Contenido patrocinado
+Dos planes hay:
+Una vía verde;
+Un museo pequeño.
-Comparta en Facebook
-Imprima el artículo
-Copiar la dirección
-Deje una respuesta
-6 respuestas
-Leído por 120 personas
-Lo más visto
~Las minas bajo el hielo
~Valdemora: vuelven las cigüeñas
-Artículo anterior
-Artículo siguiente
-Reciba nuestras noticias
-Su dirección
-Puede darse de baja cuando quiera
=Política de privacidad | Condiciones de uso | Contáctenos
=Copyright 2014 Ladera
=Ladera S.A., avenida Mayor 4, Valdemora
=Prohibida la reproducción sin permiso escrito.
=Arriba
=Ladera no responde de lo que digan otros sitios.
=Lo publicado aquí no sustituye un consejo, y Ladera no asume responsabilidad alguna.
https://brzeg.example/porady/jak-naprawic-stary-rower-3.html
=Menu główne
=Sklep
=Wiadomości
=Zaloguj się
=Ta strona używa plików cookie, aby działać lepiej.
=Zgadzam się
=Odrzuć wszystkie
+Jak naprawić stary rower
+Rama leżała za szopą od wiosny. Łańcuch zardzewiał, a dwóch szprych brakowało.
+Co jest potrzebne
+Wystarczą klucze, trochę oleju i jedno popołudnie.
-Reklama
+Na koniec trzeba sprawdzić hamulce.
-Udostępnij
-Drukuj
-Dodaj komentarz
-Podobne artykuły
~Latarnie nad kanałem
-Zapisz się do newslettera
=Polityka prywatności | Regulamin | Napisz do nas
=Wszelkie prawa zastrzeżone
http://bereg.example/sovety/star-yj-velosiped-8.html
=Главное меню
=Магазин
=Новости
=Войти
=Сайт использует файлы cookie, чтобы работать лучше.
=Согласен
=Отклонить
+Старый велосипед
+Рама лежала за сараем с весны. Цепь заржавела, двух спиц не хватало.
+Что понадобится
+Хватит ключей, масла и одного вечера.
-Реклама
+В конце нужно проверить тормоза.
-Поделиться
-Распечатать
-Добавить комментарий
-Похожие статьи
~Фонари вдоль канала
-Подписаться на рассылку
=Политика конфиденциальности | Условия | Контакты
=Все права защищены
http://www.meadow.example/a/otters-in-the-upper-valley
+Otters in the upper valley
+The first otter was seen at dusk by two anglers. Nobody believed them until the tracks froze in the mud below the weir.
+Since then the wardens have counted eleven animals, most of them young. They fish at night and sleep under the roots of the alders.
-5 replies
https://meadow.example/b/ladders-and-apple-trees-9.html
=Meadow
=Sections
=Account
+Ladders and apple trees
+A ladder with three legs stands on any slope. The pickers of Ashcombe have used nothing else since 1932, and they say that a fourth leg only gets in the way.
+Making
+Ash for the rungs, larch for the rails. It lasts thirty years if it is kept dry.
+Safety
-5 replies
+Never lean out further than your belt. Did anyone fall last year? One man did, into the nettles.
-Ladders in other seasons
~Pears on a south wall
-Our letter on Sundays
http://quarry.example/n/1
+The quarry closed at noon and nobody said why. The whistle blew twice.
http://quarry.example/n/2
+Nobody came to the auction, so the crane still stands there.
http://quarry.example/n/3
+The pumps run again. The water is clear.
http://pond.example/notes/2
+Skaters came from three villages, and the ice held until dusk.
+By nightfall there were fires along the shore, and someone had brought a fiddle.
http://news.pond.example/notes/3.html?x=1
-Pond
+What the divers found under the ice in March was a sledge, two boots and a bell.
"""

# The most widespread lines whose repetition on other sites is known to all executors: a bound on what is broadcast. That of the
# others is joined to the pages that hold them.
KNOWN_LINES = 1 << 16
# A site with more than this share of all pages is worked on in several parts; there are at most so many of them.
PARTS = 4096
_PIECES = re.compile(r"\s*[|·•›»>]\s*|\s+[/-]\s+|\s{2,}")
_SENTENCE_END = re.compile(r"[.?!:;…]$")
_FOLD = re.compile(r"[^\w]+")
_DIGITS = re.compile("[0-9]+")
_BLANKS = " \t\r"
_MANY, _FAR, _LONG, _REPEATED = 15, 12, 40, 0.2
_FEATURES = (
    "words", "words_before", "words_behind", "links", "links_before", "links_behind", "ends", "ends_before", "ends_behind", "cue", "cue_before", "cue_behind", "named", "titled", "text_before", "text_behind", "running",
    "known", "known_before", "known_behind", "pieces", "colon",
)
_TRIM = "� “”\"'»)]–…"


def _pairs(piece: str) -> list[tuple[str, str]]:
    """Neighbouring words of a piece, its ends included; numbers are alike."""
    words = [_DIGITS.sub("9", f) for w in piece.lower().replace("©", " copyright ").replace("-", " ").replace("'", " ").replace("’", " ").split() if (f := _FOLD.sub("", w))]
    return list(zip(["^", *words], [*words, "$"], strict=True)) if words else []


def _one(line: str, cues: frozenset[tuple[str, str]]) -> tuple[float, ...]:
    """Of a line by itself: words, link density, whether it ends a sentence, share of pairs of words that are cues, pieces, whether it ends in a colon."""
    count = line.count(" ") + 1
    if count > _LONG and _SENTENCE_END.search(line.rstrip(_TRIM)):  # running text, whatever it says
        return _MANY, 0.0, 1.0, 0.0, 1, 0.0
    pieces = [p for p in _PIECES.split(line) if p]
    sizes = [len(p.split()) for p in pieces]
    ends = [bool(_SENTENCE_END.search(p.rstrip(_TRIM)) or p.endswith("…") and n > 6) for p, n in zip(pieces, sizes, strict=True)]
    linked = sum(n for n, e in zip(sizes, ends, strict=True) if n <= 8 and not e)
    pairs = [x for p in pieces for x in _pairs(p)]
    met = [x for x in pairs if x in cues]
    if len(met) == 1 and len(pairs) > 4 or 4 * len(met) < len(pairs):
        met = []  # by chance
    last = line.rstrip()[-1:]
    return min(_MANY, sum(sizes)), linked / max(1, sum(sizes)), float(bool(ends) and ends[-1]), len(met) / max(1, len(pairs)), min(8, len(pieces)), float(last in (":", "："))


def _slug(text: str) -> str:
    return "-".join(re.findall(r"[^\W_]+", text.lower()))


def site_of(url: str | None) -> str | None:
    """The host of a page's address without the parts that sites use for their sections; null where it isn't a web page."""
    m = re.match(r"\s*https?://([^/?#:\s]+)", url or "", re.I)
    return re.sub(r"^(?:www|m|news|blog)\.(?=.*\..)", "", m.group(1).lower()) if m else None


def _features(lines: list[str], url: str, own_of, repeated: list[float]) -> np.ndarray:
    """A row for each line; all lines hold something. ``own_of`` gives what a line is by itself, ``repeated`` on what share of pages it stands."""
    count = len(lines)
    own = np.array([own_of(line) for line in lines], dtype=float)
    known = np.array(repeated)
    out = np.zeros((count, len(_FEATURES)))
    at = np.arange(count)
    path = _slug(url.split("://", 1)[-1])
    for i, line in enumerate(lines):
        if own[i, 0] < _MANY and own[i, 4] == 1:
            name = _slug(line).split("-")[:4]
            out[i, 12] = len("".join(name)) > 3 and "-".join(name) in path
    for column, of in ((0, 0), (3, 1), (6, 2), (9, 3)):
        out[:, column] = own[:, of]
        out[1:, column + 1] = own[:-1, of]
        out[:-1, column + 2] = own[1:, of]
    # behind the line that the address names, if there is one: 1, before it: -1
    titles = np.flatnonzero(out[:, 12])
    if len(titles):
        out[:, 13] = np.where(at >= titles[0], 1, -1)
    # running text that isn't repeated, and the lines from one such line to the next
    running = (own[:, 0] >= 8) & (own[:, 2] > 0) & (own[:, 1] < 0.5) & (known < _REPEATED) & (own[:, 3] == 0)
    before = np.maximum.accumulate(np.where(running, at, -_FAR))
    behind = np.minimum.accumulate(np.where(running, at, count + _FAR)[::-1])[::-1]
    out[1:, 14], out[0, 14] = np.minimum(at[1:] - before[:-1], _FAR), _FAR
    out[:-1, 15], out[-1, 15] = np.minimum(behind[1:] - at[:-1], _FAR), _FAR
    out[:, 16], out[:, 17] = running, known
    out[1:, 18], out[:-1, 19] = known[:-1], known[1:]
    out[:, 20], out[:, 21] = own[:, 4], own[:, 5]
    return out


def _repeated(pages: int, whole: int, elsewhere: float | None) -> float:
    """The share of a site's other pages on which a line of one page stands, by the line's ``pages`` of the site's ``whole``; small
    sites say little. For a line of other sites, it is at least the share of those."""
    if elsewhere is None:
        return (pages - 1) / (whole + 1)
    return max(elsewhere, (pages - 1) / (whole + 9))


class Tree:
    """A decision tree on numbers, grown by Gini impurity to at most ``depth`` levels and leaves of ``least`` rows; ties go to the first feature and the smaller cut."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 6) -> None:
        self.feature, self.cut, self.low, self.high, self.share = [], [], [], [], []
        self._grow(x, y, depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        node = len(self.feature)
        for values, value in ((self.feature, -1), (self.cut, 0.0), (self.low, 0), (self.high, 0), (self.share, float(y.mean()))):
            values.append(value)
        if depth and 0 < y.mean() < 1:
            best = (0.0, -1, 0.0)
            whole = 2 * y.mean() * (1 - y.mean()) * len(y)
            for f in range(x.shape[1]):
                order = np.argsort(x[:, f], kind="stable")
                v, t = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(y))
                cuts = np.flatnonzero(v[1:] > v[:-1])
                cuts = cuts[(n[cuts] >= least) & (n[cuts] <= len(y) - least)]
                if not len(cuts):
                    continue
                p, q = t[cuts] / n[cuts], (t[-1] - t[cuts]) / (len(y) - n[cuts])
                gain = whole - 2 * (p * (1 - p) * n[cuts] + q * (1 - q) * (len(y) - n[cuts]))
                k = int(np.argmax(gain))
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), f, float(v[cuts[k]] + v[cuts[k] + 1]) / 2)
            if best[1] >= 0:
                low = x[:, best[1]] <= best[2]
                self.feature[node], self.cut[node] = best[1], best[2]
                self.low[node] = self._grow(x[low], y[low], depth - 1, least)
                self.high[node] = self._grow(x[~low], y[~low], depth - 1, least)
        return node

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The share of the positive class in the leaf that each row falls into."""
        feature, cut, low, high = map(np.array, (self.feature, self.cut, self.low, self.high))
        at = np.zeros(len(x), dtype=int)
        while (inner := feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            goes = x[rows, feature[at[rows]]] <= cut[at[rows]]
            at[rows] = np.where(goes, low[at[rows]], high[at[rows]])
        return np.array(self.share)[at]


# Invented names of the labelled table, which say nothing about other pages.
_NAMES = frozenset("harbour dunford saltmarsh kornfeld oberried rivage mazan ladera valdemora brzeg bereg meadow ashcombe facebook".split())
# Views of the labelled table that the tree is grown on.
_VIEWS = 24


@lru_cache(4)
def trained(table: str = LABELLED) -> tuple[Tree, frozenset[tuple[str, str]]]:
    """The tree, and the pairs of words that in the labelled table stand in boilerplate alone.

    The tree is grown on views of the table in which some of what short lines teach about words is hidden, as no table has all wordings,
    and sites repeat their lines in some measure or, being small, not at all. What an eighth of the views tells less well, a leaf leaves.
    """
    pages: list[tuple[str, list[tuple[str, str]]]] = []
    for line in table.splitlines():
        if line.startswith("http"):
            pages.append((line, []))
        else:
            pages[-1][1].append((line[0], line[1:]))
    rows = [x for _, lines in pages for x in lines]

    def learned(keep: np.ndarray) -> frozenset[tuple[str, str]]:
        kinds: dict[bool, set] = {True: set(), False: set()}
        for (kind, text), kept in zip(rows, keep, strict=True):
            if kind != "~" and (kept or kind == "+"):
                kinds[kind == "+"].update(x for piece in _PIECES.split(text) for x in _pairs(piece))
        return frozenset(x for x in kinds[False] - kinds[True] if not _NAMES.intersection(x) and not {"^", "$", "9"}.issuperset(x))

    draw = np.random.default_rng(0)
    x, y = [], []
    for view in range(_VIEWS):
        hidden = (0.0, 0.3, 0.6, 0.9)[view % 4]
        cues = learned(draw.random(len(rows)) >= hidden)
        for url, lines in pages:
            large, heard = draw.random() < 0.7, draw.random() < 0.85  # the site is large enough to repeat lines; other sites have said theirs
            repeated = []
            for kind, text in lines:
                often, low, high = {"=": (0.97 * large, 0.4, 1.0), "-": (0.9 * heard, 0.25, 0.9), "~": (0.05, 0.0, 0.1), "+": (0.6 if len(text) < 40 else 0.0, 0.0, 0.15)}[kind]
                repeated.append(draw.uniform(low, high) if draw.random() < often else 0.0)
            x.append(_features([t for _, t in lines], url, lambda line, cues=cues: _one(line, cues), repeated))
            y.append(np.array([k != "+" for k, _ in lines], dtype=float))
    return Tree(np.concatenate(x), np.concatenate(y), least=_VIEWS // 3), learned(np.ones(len(rows), bool))


def _key(line: str) -> int:
    """A line without surrounding blanks and with all numbers alike, as the number that Spark's hash of it is."""
    h = xxhash.xxh64_intdigest(_DIGITS.sub("9", line.strip(_BLANKS)), 42)
    return h - (1 << 64) if h >> 63 else h


def _keys(text: Column) -> Column:
    """The keys of a text's lines that aren't blank, each once."""
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(_BLANKS))), lambda x: x != "")
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(F.regexp_replace(x, "[0-9]+", "9"))))


def site_lines(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of pages (site, text): (site, line, pages) of each key of a line, and (site, whole), a site's number of pages. Equal texts of a
    site are one page, so a page delivered again repeats nothing; of a text only the keys of its lines are moved."""
    keyed = pages.select("site", F.xxhash64("text", F.length("text")).alias("print"), _keys(F.col("text")).alias("keys")).dropDuplicates(["site", "print"])
    counts = keyed.select("site", F.explode(F.concat(F.col("keys"), F.array(F.lit(None).cast("bigint")))).alias("line")).groupBy("site", "line").agg(F.count("*").alias("pages"))
    counts = written(counts, "site-lines")
    return counts.filter("line is not null"), counts.filter("line is null").select("site", F.col("pages").alias("whole"))


def lines_elsewhere(counts: DataFrame, whole: DataFrame, least_sites: int = 3) -> DataFrame:
    """line, sites, share: of each line of ``least_sites`` sites or more, on what share of a site's other pages it stands, given that one
    page has it; the mean of its sites, large ones counting more, up to 21 pages."""
    weight = F.when(F.col("whole") > 1, F.least(F.col("whole") - 1, F.lit(20)))
    own = counts.join(whole, "site").withColumn("weight", weight)
    sums = own.groupBy("line").agg(F.count("*").alias("sites"), F.sum(F.col("weight") * (F.col("pages") - 1) / (F.col("whole") - 1)).alias("met"), F.sum("weight").alias("weight"))
    return sums.filter((F.col("sites") >= least_sites) & F.col("weight").isNotNull()).select("line", "sites", (F.col("met") / (F.col("weight") + 2)).alias("share"))


def _less_known(pages: DataFrame, spread: DataFrame, last: pa.Table) -> DataFrame:
    """(print, known): the shares of those lines of each text that come behind the ``last`` one known to all, which a text has at most as many of as lines."""
    sites, line = (last.column(c)[0].as_py() for c in ("sites", "line"))
    rest = spread.filter((F.col("sites") < sites) | ((F.col("sites") == sites) & (F.col("line") > line))).select("line", "share")
    lines = pages.select(_print(), _keys(F.col("text")).alias("keys")).dropDuplicates(["print"]).select("print", F.explode("keys").alias("line"))
    return lines.join(rest, "line").groupBy("print").agg(F.collect_list(F.struct("line", "share")).alias("known"))


def _print() -> Column:
    return F.xxhash64("text", F.length("text")).alias("print")


def _sorted_lines(elsewhere, as_text: bool):
    """Rows of a partition sorted by site and part: first what a site repeats, then its pages, before those of a text what is known of its less widespread lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, cues = trained()
        own_of = lru_cache(1 << 16)(lambda line: _one(line, cues))
        key_of = lru_cache(1 << 16)(_key)
        known, site, counted, whole, noted, less = elsewhere.value, None, {}, 1, None, {}
        for batch in batches:
            of, sizes, numbers, kept, rows = [], [], [], [], []
            for i, (at, text, url, repeats, n, of_text, shares) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("site", "text", "url", "repeats", "whole", "print", "known")), strict=True)):
                if n is not None:  # what a site repeats
                    site, whole, counted = at, n, {x["line"]: x["pages"] for x in repeats or ()}
                    continue
                if shares is not None:
                    noted, less = of_text, {x["line"]: x["share"] for x in shares}
                    continue
                if at != site:
                    site, whole, counted = at, 1, {}
                raw = text.split("\n")
                lines = [(n, t) for n, line in enumerate(raw, 1) if (t := line.strip())]
                if not lines:
                    continue
                keys = [key_of(raw[n - 1]) for n, _ in lines]
                share_of = (lambda k: known.get(k, less.get(k))) if less and of_text == noted else known.get
                rows.append(_features([t for _, t in lines], url, own_of, [_repeated(counted.get(k, 1), whole, share_of(k)) for k in keys]))
                of.append(i)
                sizes.append(len(lines))
                numbers += [n for n, _ in lines]
                if as_text:
                    kept.append([t for _, t in lines])
            if not of:
                continue
            body = tree(np.concatenate(rows)) <= 0.5
            if as_text:
                ends = np.cumsum(sizes)
                texts = ["\n".join(t for t, b in zip(lines, body[e - len(lines) : e], strict=True) if b) or None for lines, e in zip(kept, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("__id").take(pa.array(of)), pa.array(texts, pa.string())], ["__id", "text"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("__id").take(pa.array(np.repeat(of, sizes))), pa.array(numbers, pa.int32()), pa.array(body)], ["__id", "line_no", "body"])

    return run


def _judged(df: DataFrame, id_col: str, text_col: str, url_col: str, as_text: bool, least_share: float) -> DataFrame:
    kind = dict(df.dtypes)[id_col]
    pages = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{url_col}`").cast("string").alias("url"))
    pages = pages.withColumn("site", _site(F.col("url"))).filter(F.col("site").isNotNull() & F.col("text").isNotNull())
    counts, whole = site_lines(pages)
    spread = written(lines_elsewhere(counts, whole), "spread-lines")
    known = spread.orderBy(F.desc("sites"), "line").limit(KNOWN_LINES).toArrow()
    elsewhere = df.sparkSession.sparkContext.broadcast(dict(zip(known.column("line").to_pylist(), known.column("share").to_pylist(), strict=True)))
    # sites with a large share of all pages are worked on in parts: less than PARTS sites
    every = whole.agg(F.sum("whole").alias("every"))
    large = whole.join(F.broadcast(every), F.col("whole") * PARTS > F.col("every")).select("site", F.ceil(F.col("whole") * PARTS / F.col("every")).cast("int").alias("parts"))
    repeats = counts.filter("pages > 1").join(whole, "site").filter(F.col("pages") >= least_share * F.col("whole"))
    repeats = repeats.groupBy("site").agg(F.collect_list(F.struct("line", "pages")).alias("repeats"), F.max("whole").alias("whole"))
    parts = F.coalesce("parts", F.lit(1))
    heads = repeats.join(F.broadcast(large), "site", "left").select("site", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(None).cast(kind).alias("__id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("url"), "repeats", "whole")
    placed = pages.join(F.broadcast(large), "site", "left").withColumn("part", F.pmod(F.xxhash64("__id", "url", F.length("text")), parts).cast("int"))
    no_text, none_known = F.lit(None).cast("bigint").alias("print"), F.lit(None).cast("array<struct<line: bigint, share: double>>").alias("known")
    if known.num_rows < KNOWN_LINES:
        rows = heads.unionByName(placed.drop("parts"), allowMissingColumns=True).select("*", no_text, none_known)
        rows = rows.repartition("site", "part").sortWithinPartitions("site", "part", F.col("whole").desc_nulls_last())
    else:
        placed = placed.drop("parts").select("*", _print())
        less = placed.select("site", "part", "print").distinct().join(_less_known(pages, spread, known.slice(known.num_rows - 1)), "print")
        rows = heads.unionByName(placed, allowMissingColumns=True).select("*", none_known).unionByName(less, allowMissingColumns=True)
        rows = rows.repartition("site", "part").sortWithinPartitions("site", "part", F.col("whole").desc_nulls_last(), "print", F.col("known").isNull())
    schema = f"__id {kind}, text string" if as_text else f"__id {kind}, line_no int, body boolean"
    return rows.select("__id", "site", "text", "url", "repeats", "whole", "print", "known").mapInArrow(_sorted_lines(elsewhere, as_text), schema).withColumnRenamed("__id", id_col)


def page_lines(df: DataFrame, id_col: str, text_col: str, url_col: str, least_share: float = 0.05) -> DataFrame:
    """``id_col``, line_no (from 1) and body (boolean) of each line of each web page; blank lines have no row.

    Rows whose address is null or doesn't start with http, and null, empty and blank texts, give no row. Equal rows
    come out as often as they go in. A page that is the only one of its site is judged by what other sites repeat. Of a site, lines on
    at least ``least_share`` of its pages are looked up, so what a partition holds of it is at most 1 / ``least_share`` times the lines
    of a page; sites with more than 1 / PARTS of all pages are split. Columns besides the three are not used.
    """
    return _judged(df, id_col, text_col, url_col, False, least_share)


def main_body(df: DataFrame, id_col: str, text_col: str, url_col: str, least_share: float = 0.05) -> DataFrame:
    """``id_col`` and text of each web page, only the lines of its main body kept, without surrounding blanks; null where no line is
    left. Blank and null texts give no row; equal rows, and rows of equal ids, come out as often as they go in. As page_lines otherwise, in one pass."""
    return _judged(df, id_col, text_col, url_col, True, least_share)


def _site(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"(?i)^\s*https?://([^/?#:\s]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^(?:www|m|news|blog)\.(?=.*\..)", ""), F.lit(""))
