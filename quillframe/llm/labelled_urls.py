"""Labelled URLs that the URL filter is trained on, put together by rule from a fixed seed.

URLs to block advertise games of chance, sexual content, unlicensed medicine, cracked software, bad
credit and the like in host or path; all others are of ordinary sites, or of hosts without meaning.
"""

from __future__ import annotations

from random import Random

ROWS, SEED = 5000, 5

#: Words that sites to block use in hosts and paths, by what they sell.
BLOCKED = {
    "chance": "casino poker slots roulette jackpot bet betting bingo blackjack lottery bonus spins odds wager gamble bets win wins winner gaming".split(),
    "sex": "porn xxx x sex adult adults cams escort nude milf hentai webcam erotic hookup camgirls nsfw".split(),
    "medicine": "viagra cialis pills pharmacy rx tramadol steroids xanax weightloss dietpills kamagra levitra".split(),
    "cracks": "warez crack keygen torrent cracked nulled serial activator patch fullmovie freedownload hacked".split(),
    "credit": "payday loan loans fastcash cashadvance crypto doubler forex invest profit richquick giveaway claim prize winner".split(),
    "fakes": "replica replicas fake watches cheap outlet discount essay essays backlinks seo linkfarm farm".split(),
    "spam": "spam spammer spamfarm bulk mailblast ads ad adserver adclick track tracker tracking popunder banner clicks affiliate affid".split(),
}
ORDINARY = (
    "news library museum docs wiki blog school university city weather recipes travel sport health music science journal forum archive garden history theatre "
    "river bridge council market books movies photos maps data open code python kernel physics maths biology climate energy housing transport airport hotel "
    "restaurant bakery bicycle football tennis chess orchestra gallery poetry grammar dictionary encyclopedia parliament court police hospital clinic nurse "
    # Words that hold some of the words above.
    "alphabet better betterhomes between betty tibet essex sussex middlesex analysis therapist window winter winery wine farmhouse farming cocktail addison adelaide "
    "trackfield soundtrack racetrack classics cheapside freedom freeport proxy pixel saxony pillow pillar spinner loanword bestseller topology onlinelibrary "
    "farm forest mountain island harbour station parcel post bank insurance tax pension career jobs charity church festival"
).split()
PATHS = "articles article en de fr es it posts category page item thread tag author about contact guide tutorial help events products collection catalogue search index".split()
ENDINGS = ["com", "org", "net", "info", "io", "co", "example", "de", "fr", "example.com", "example.org", "example.net"]
SYLLABLES = "an ba co de en er fi ga he in ka la ma no on pe ra re sa ti to un ve wa".split()


def _nonsense(rng: Random) -> str:
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4)))


def _host(rng: Random, words: list[str]) -> str:
    name = rng.choice(["-", "-", "", "."]).join(words)
    return rng.choice(["", "", "www.", "m.", f"{rng.choice(PATHS)}."]) + name + rng.choice(["", str(rng.randint(1, 999))]) + "." + rng.choice(ENDINGS)


def _ordinary_path(rng: Random) -> str:
    if rng.random() < 0.4:
        return f"/{rng.choice(['en', 'de', 'fr', 'es', 'news', 'p'])}/{rng.randint(1, 9999)}" + rng.choice(["", "/", ".html"])
    parts = [rng.choice([rng.choice(PATHS), rng.choice(ORDINARY), _nonsense(rng), str(rng.randint(1, 9999)), f"{rng.randint(1990, 2024)}/{rng.randint(1, 12):02d}"]) for _ in range(rng.randint(0, 4))]
    return "/" + "/".join(parts) + rng.choice(["", "", ".html", "/", ".php"])


def _blocked_path(rng: Random, words: list[str]) -> str:
    parts = [rng.choice([rng.choice(words), f"{rng.choice(words)}-{rng.choice(words)}", f"buy-{rng.choice(words)}", f"free-{rng.choice(words)}", str(rng.randint(1, 99))]) for _ in range(rng.randint(1, 3))]
    return "/" + "/".join(parts) + rng.choice(["", "", ".html", ".php"])


def urls(n: int = ROWS, seed: int = SEED) -> list[tuple[str, int]]:
    """``n`` rows (URL, 1 to block or 0), half of each; another seed gives others."""
    rng = Random(seed)
    found = []
    for k in range(n):
        scheme = rng.choice(["http://", "https://"])
        query = rng.choice(["", "", f"?id={rng.randint(1, 999)}", "?utm_source=feed", "#top"])
        if k % 2:
            words = BLOCKED[rng.choice(sorted(BLOCKED))]
            kind = rng.random()
            if kind < 0.15:  # host and path tell
                host, path = _host(rng, [rng.choice(words) for _ in range(rng.randint(1, 2))] + [_nonsense(rng)] * (rng.random() < 0.3)), _blocked_path(rng, words)
            elif kind < 0.9:  # the host alone
                host, path = _host(rng, [rng.choice(words), rng.choice([rng.choice(words), rng.choice(words), _nonsense(rng), "best", "top", "free", "cheap", "online"])]), _ordinary_path(rng)
            else:  # the path alone
                host, path = _host(rng, [_nonsense(rng)]), _blocked_path(rng, words) + "/" + rng.choice(words)
        else:
            host = _host(rng, [rng.choice([rng.choice(ORDINARY), _nonsense(rng)]) for _ in range(rng.randint(1, 2))])
            path = _ordinary_path(rng)
        found.append((f"{scheme}{host}{path}{query}", k % 2))
    return found
