"""Labelled pages that the extraction model is trained on: html in which main blocks begin with ``MARK``.

Pages are put together by rule from a fixed seed: an article in one of several layouts (semantic
elements, named or nameless ``div``s, tables), in one of several languages, with paragraphs, lists,
quotations, figures and tables, among menus, headers, notices, adverts, forms, sidebars, reader
comments and footers, each of which may or may not be named.
"""

from __future__ import annotations

from random import Random

#: A character that no page uses.
MARK = "\ue000"
PAGES, SEED = 480, 11

SENTENCES = {
    "en": [
        "The river rose two metres during the night, and by morning the lower road was closed to all traffic.",
        "Residents were asked to move their cars to higher ground, and most of them did so before eight o'clock.",
        "Nobody was hurt, the council said, although three cellars near the bridge were flooded.",
        "We have not seen water this high since the bridge was built, said one resident.", "It rained.", "The school stays closed.",
        "Engineers measured the piers twice and found no damage, but they want to look again when the water has gone down.",
    ],
    "de": [
        "Der Fluss stieg in der Nacht um zwei Meter, und am Morgen war die untere Straße für den Verkehr gesperrt.",
        "Die Anwohner wurden gebeten, ihre Autos auf höher gelegene Plätze zu fahren, was die meisten auch taten.",
        "Verletzt wurde niemand, wie die Gemeinde mitteilte, doch drei Keller an der Brücke liefen voll.", "Es regnete.",
        "So hoch stand das Wasser seit dem Bau der Brücke nicht mehr, sagte eine Bewohnerin.",
    ],
    "fr": [
        "La rivière est montée de deux mètres pendant la nuit, et au matin la route basse était fermée à la circulation.",
        "Les habitants ont été priés de garer leurs voitures plus haut, ce que la plupart ont fait avant huit heures.",
        "Personne n'a été blessé, selon la mairie, mais trois caves proches du pont ont été inondées.", "Il pleuvait.",
    ],
    "es": [
        "El río subió dos metros durante la noche y por la mañana la carretera baja estaba cerrada al tráfico.",
        "Se pidió a los vecinos que llevaran sus coches a un lugar más alto, y casi todos lo hicieron antes de las ocho.",
        "Nadie resultó herido, según el ayuntamiento, aunque se inundaron tres sótanos cerca del puente.", "Llovía.",
    ],
}
TITLES = {
    "en": ["River closes the lower road", "What happens next", "How the bridge was saved"],
    "de": ["Fluss sperrt die untere Straße", "Wie es weitergeht", "Die Rettung der Brücke"],
    "fr": ["La rivière ferme la route basse", "La suite", "Comment le pont fut sauvé"],
    "es": ["El río cierra la carretera baja", "Lo que viene", "Cómo se salvó el puente"],
}
LINKS = {
    "en": ["Home", "News", "Sport", "About us", "Contact", "Weather", "Archive"],
    "de": ["Start", "Nachrichten", "Sport", "Über uns", "Kontakt", "Wetter", "Archiv"],
    "fr": ["Accueil", "Actualités", "Sport", "À propos", "Contact", "Météo", "Archives"],
    "es": ["Inicio", "Noticias", "Deportes", "Sobre nosotros", "Contacto", "Tiempo", "Archivo"],
}
COMMENTS = {
    "en": ["comments", "3 comments", "Reader comments", "Responses", "2 responses", "Discussion", "Replies", "What our readers say", "Join the conversation"],
    "de": ["Kommentare", "3 Kommentare", "Leserkommentare", "Diskussion", "Antworten"],
    "fr": ["Commentaires", "3 commentaires", "Réactions", "Discussion", "Réponses"],
    "es": ["Comentarios", "3 comentarios", "Opiniones", "Respuestas"],
}
ADVERTS = {
    "en": ["Buy one umbrella and get one free.", "Advertisement", "Boots for all weathers, now at half price. Order today and pay later.", "Sponsored: see the new boats."],
    "de": ["Anzeige", "Gummistiefel für jedes Wetter, jetzt zum halben Preis. Heute bestellen, später bezahlen.", "Neue Boote ansehen."],
    "fr": ["Publicité", "Des bottes pour tous les temps, à moitié prix. Commandez aujourd'hui, payez plus tard."],
    "es": ["Publicidad", "Botas para todo tiempo, ahora a mitad de precio. Pida hoy y pague después."],
}
NOTICES = {
    "en": ["We use cookies to make this site better. By reading on you agree to our rules.", "Get the news by e-mail every morning.", "Our office is closed on Monday."],
    "de": ["Wir verwenden Cookies, um diese Seite zu verbessern. Wer weiterliest, stimmt zu.", "Die Nachrichten jeden Morgen per E-Mail."],
    "fr": ["Nous utilisons des cookies pour améliorer ce site. En continuant, vous acceptez nos règles."],
    "es": ["Usamos cookies para mejorar este sitio. Si continúa, acepta nuestras reglas."],
}
ASIDES = {
    "en": ["Most read", "Read also", "Related", "Popular", "Latest"], "de": ["Meistgelesen", "Lesen Sie auch", "Mehr zum Thema"],
    "fr": ["Les plus lus", "À lire aussi"], "es": ["Lo más leído", "Lea también"],
}
FOOTERS = ["&copy; 2020 The Valley Post. All rights reserved.", "Imprint | Privacy | Terms", "Copyright The Valley Post &middot; Valley Street 1, Valley.", "Impressum &middot; Datenschutz"]
NAMES = {
    "content": "content article article-body post entry story text main page-content post-body".split(),
    "nav": "nav menu navbar topnav navigation breadcrumb links".split(),
    "header": "header masthead top site-header branding".split(),
    "aside": "sidebar aside related widget rail right popular recommended".split(),
    "ad": "ad ads advert advertisement sponsored promo banner".split(),
    "notice": "cookie notice consent alert popup modal newsletter subscribe".split(),
    "comments": "comments comment-list responses discussion replies feedback disqus reactions".split(),
    "footer": "footer site-footer bottom legal copyright".split(),
}
SEMANTIC = {"nav": "nav", "header": "header", "aside": "aside", "footer": "footer", "content": "article", "comments": "section"}


class _Page:
    """One page under construction."""

    def __init__(self, rng: Random):
        self.rng, self.lang = rng, rng.choice(sorted(SENTENCES))

    def pick(self, table: dict[str, list[str]]) -> str:
        return self.rng.choice(table[self.lang])

    def prose(self, least: int, most: int) -> str:
        return " ".join(self.pick(SENTENCES) for _ in range(self.rng.randint(least, most)))

    def fragment(self) -> str:
        """A few words, with or without an end."""
        words = self.prose(1, 1).split()
        at = self.rng.randrange(len(words))
        text = " ".join(words[at : at + self.rng.randint(1, 8)])
        return self.rng.choice([text, text.rstrip(".,") + ".", " | ".join(text.split())])

    def other(self, table: dict[str, list[str]]) -> str:
        """A text outside the article: what such places say, or words that an article could have as well."""
        kind = self.rng.random()
        return self.pick(table) if kind < 0.5 else self.prose(1, 2) if kind < 0.8 else self.fragment()

    def own(self, text: str) -> str:
        return MARK + text

    def box(self, role: str, inner: str, named: bool = False) -> str:
        """``inner`` in an element of its role, in a named ``div``, or in a nameless one."""
        kind = self.rng.random() * (0.75 if named else 1.0)
        if role in SEMANTIC and kind < 0.4:
            return f"<{SEMANTIC[role]}>{inner}</{SEMANTIC[role]}>"
        if kind < 0.75:
            name = self.rng.choice(NAMES[role])
            return f'<div {self.rng.choice(["class", "id"])}="{name}">{inner}</div>'
        return f"<div>{inner}</div>"

    def links(self, n: int) -> str:
        found = [f'<a href="/{k}">{self.pick(LINKS)}</a>' for k in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in found) + "</ul>" if self.rng.random() < 0.6 else " ".join(found)

    def aside(self) -> str:
        head = self.rng.choice(["h2", "h3", "h4"])
        body = self.links(self.rng.randint(2, 5)) if self.rng.random() < 0.6 else f"<p>{self.prose(1, 2)}</p>"
        return self.box("aside", f"<{head}>{self.pick(ASIDES)}</{head}>{body}")

    def form(self) -> str:
        return f"<form action='/s'><p>{self.other(NOTICES)}</p><label>E-mail</label><input name=q><button>OK</button></form>"

    def comments(self) -> str:
        head = self.rng.choice(["h2", "h3", "h4"])
        items = []
        for _ in range(self.rng.randint(1, 5)):
            said = f"<p>{self.prose(1, 3)}</p>"
            who = f"<div>{self.rng.choice(['Anna K.', 'jan_82', 'M. Dupont', 'Reader'])}, 12:{self.rng.randint(10, 59)}</div>" if self.rng.random() < 0.6 else ""
            items.append(self.rng.choice(["<div>{}</div>", "<li>{}</li>", '<div class="comment">{}</div>']).format(who + said))
        if self.rng.random() < 0.3:
            return f'<div {self.rng.choice(["class", "id"])}="{self.rng.choice(NAMES["comments"])}">{self.rng.choice(["", "<div>"])}{"".join(items)}</div>'
        # A nameless box of comments is told by its heading alone.
        return self.box("comments", f"<{head}>{self.pick(COMMENTS)}</{head}>{''.join(items)}")

    def part(self) -> str:
        """A part of the article."""
        kind = self.rng.random()
        own = self.own
        if kind < 0.62:
            text = own(self.fragment() if self.rng.random() < 0.3 else self.prose(1, 5))
            if self.rng.random() < 0.1:
                first, second = text.split(" ", 1) if " " in text else (text, "")
                return f"<p><b>{first}</b> {second}" + ("<br>" if self.rng.random() < 0.5 else "</p>")
            return f"<p>{text}</p>" if self.rng.random() < 0.9 else f"<div>{text}</div>"
        if kind < 0.70:
            return f"<h2>{own(self.pick(TITLES))}</h2><p>{own(self.prose(1, 3))}</p>"
        if kind < 0.78:
            tag = self.rng.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{own(self.prose(1, 1))}</li>" for _ in range(self.rng.randint(2, 4))) + f"</{tag}>"
        if kind < 0.84:
            return f"<blockquote>{own(self.prose(1, 2))}</blockquote>"
        if kind < 0.88:
            return f"<figure><img src=x><figcaption>{own(self.prose(1, 1))}</figcaption></figure>"
        if kind < 0.92:
            cells = "".join(f"<tr><td>{own(self.pick(LINKS))}</td><td>{own(str(self.rng.randint(1, 99)))}</td></tr>" for _ in range(2))
            return f"<table>{cells}</table>"
        if kind < 0.95:
            return f"<pre>{own(self.prose(1, 1))}</pre>"
        return self.box("ad", f"<p>{self.other(ADVERTS)}</p>", named=True) if kind < 0.98 else self.form()

    def article(self) -> str:
        head = f"<h1>{self.own(self.pick(TITLES))}</h1>"
        if self.rng.random() < 0.2:
            head = f"<header>{head}</header>"
        if self.rng.random() < 0.3:
            # Little or no running text: its element or its name must tell that it is an article.
            parts = [f"<p>{self.own(self.fragment() if self.rng.random() < 0.7 else self.prose(1, 2))}</p>" for _ in range(self.rng.randint(1, 5))]
            return self.box("content", head + "".join(parts), named=True)
        parts = [self.part() for _ in range(self.rng.randint(2, 9))]
        parts.insert(self.rng.randrange(len(parts)), f"<p>{self.own(self.prose(2, 4))}</p>")
        kind = self.rng.random()
        if kind < 0.12:
            inner = head + "<div>" + "".join(parts) + "</div>"
            return self.box("content", inner)
        if kind < 0.22:
            return f"<main>{head}{''.join(parts)}</main>"
        if kind < 0.32:
            menu = f"<td>{self.links(self.rng.randint(2, 6))}</td>" if self.rng.random() < 0.6 else ""
            return f"<table><tr>{menu}<td>{head}{''.join(parts)}</td></tr></table>"
        return self.box("content", head + "".join(parts))

    def plain_article(self) -> str:
        """An article without a name: bare blocks below a heading, text parted by line breaks, or a short text in its element."""
        rng, own = self.rng, self.own
        head = rng.choice(["", f"<h1>{own(self.pick(TITLES))}</h1>", f"<h2>{own(self.pick(TITLES))}</h2>"])
        kind = rng.random()
        if kind < 0.35:
            tag = rng.choice(["div", "div", "p", "section"])
            parts = [f"<{tag}>{own(self.prose(1, 4))}</{tag}>" for _ in range(rng.randint(1, 6))]
            if rng.random() < 0.4:
                parts.insert(rng.randrange(1, len(parts) + 1), f"<h2>{own(self.pick(TITLES))}</h2>")
            inner = head + "".join(parts)
            return rng.choice([inner, f"<div>{inner}</div>", f"<div><div>{inner}</div></div>"])
        if kind < 0.6:
            return head + own(rng.choice(["<br><br>", "<br/>\n<br/>", "<br>"]).join(self.prose(1, 4) for _ in range(rng.randint(1, 5)))) + "<hr>"
        text = own(rng.choice([self.fragment(), self.prose(1, 1), self.prose(1, 3)]))
        inner = head + rng.choice([text, f"<p>{text}</p>"])
        tag = rng.choice(["main", "article", "main", "article", "div class='content'", "body"])
        return f"<{tag}>{inner}</{tag.split()[0]}>"

    def build(self) -> str:
        rng = self.rng
        article = self.article() if rng.random() < 0.7 else self.plain_article()
        if rng.random() < 0.06:
            return article
        out = [f"<html><head><title>{self.pick(TITLES)}</title><style>p{{}}</style><script>var a='<p>x</p>';</script></head><body>" if rng.random() < 0.8 else "<body>"]
        if rng.random() < 0.4:
            out.append(self.box("notice", f"<p>{self.other(NOTICES)}</p>" + ("<button>OK</button>" if rng.random() < 0.5 else "")))
        if rng.random() < 0.5:
            out.append(self.box("header", f'<a href="/">The Valley Post</a>' if rng.random() < 0.5 else "<h2>The Valley Post</h2><p>News from the valley since 1901.</p>"))
        if rng.random() < 0.9:
            out.append(self.box("nav", self.links(rng.randint(2, 6))))
        if rng.random() < 0.5:
            out.append("<!-- ad 1 -->" + self.box("ad", self.other(ADVERTS)))
        aside = self.aside() if rng.random() < 0.5 else ""
        comments = self.comments() if rng.random() < 0.5 else ""
        before = rng.random() < 0.3
        inside = comments and rng.random() < 0.3 and article.endswith(("</article>", "</div>"))
        if inside:
            end = article.rindex("</")
            article = article[:end] + comments + article[end:]
        out += [aside if before else "", article, "" if inside else comments, "" if before else aside]
        if rng.random() < 0.3:
            out.append(self.form())
        if rng.random() < 0.3:
            out.append(self.box("notice", f"<p>{self.other(NOTICES)}</p>"))
        if rng.random() < 0.9:
            foot = rng.choice(FOOTERS)
            out.append(self.box("footer", foot if rng.random() < 0.6 else f"{foot} {self.prose(1, 1)}" if rng.random() < 0.5 else f"<p>{foot}</p><p>{self.prose(1, 1)}</p>"))
        return "".join(out) + ("</body></html>" if rng.random() < 0.8 else "")


def pages(n: int = PAGES, seed: int = SEED) -> list[str]:
    """``n`` labelled pages; another seed gives others."""
    rng = Random(seed)
    return [_Page(rng).build() for _ in range(n)]
