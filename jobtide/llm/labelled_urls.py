"""The labelled URL table: hosts and paths that one would block or keep, in many shapes.

Names to block join two terms of the trades that a crawl leaves out (betting, adult, quack
medicine, quick loans, tracking, link farms, pirated goods); names to keep are ordinary words
of several languages, alone or in pairs, and pronounceable names that mean nothing.  Names are
put under many kinds of hosts, subdomains and paths, so that these say nothing by themselves.
"""

from __future__ import annotations

import random

BLOCK_TERMS = """
    casino casinos poker bet bets betting gambling slots jackpot lottery roulette blackjack bingo
    porn porno xxx sex adult nude escort cams webcam hentai milf dating-hot singles erotic
    viagra cialis pills meds pharma steroids weightloss detox kratom
    loans payday credit-fast cash-now quickcash forex-signals crypto-double
    spam clicks click adserver ads tracker track popunder doubleclick banners linkfarm backlinks seo-links
    warez torrent keygen cracked pirated free-movies replica fake-watches
""".split()
BLOCK_FILLERS = """
    free best top hot big win online now cheap fast easy lucky royal mega instant club world bonus shop store farm
    network mail king live vip max pro 24 247 deals promo spins tube films video videos chat links hub zone
""".split()
KEEP_WORDS = """
    academy archive architecture astronomy atlas bakery bank-holiday beach bicycle biology blog botany bread bridge
    castle cathedral chemistry children cinema city climate coffee college community concert cooking council country
    culture dance daily dictionary doctor earth economy education energy engineering farmers festival film-review
    forest forum garden geology gazette government harbour health history hospital hotel house insurance island
    journal kindergarten kitchen laboratory lake language law library lighthouse literature magazine maps market
    mathematics meadow medicine meteorology mountain museum music nation nature network-theory news north observatory
    ocean opera orchestra painting paper parish parliament park philosophy photography physics poetry politics press
    psychology publishing radio railway recipe research review river school science singing society software sports
    station statistics street sunday surgery swimming teacher technology telegraph textile theatre theology times
    tourism town-hall tradition translation transport travel university valley village vineyard water weather
    wikipedia wildlife window winter wood workshop writing youth zoo adultery-law sextant essex-council middlesex
    better alphabet diabetes betterment classics expansion assessment trackside clickstream-research creditunion
    buecher schule verein bibliothek gemeinde zeitung wetter kirche musik garten bahnhof rathaus
    ecole mairie journal-local recettes musee voyage bibliotheque sciences eglise quartier
    escuela ciudad biblioteca periodico cocina universidad ayuntamiento cultura viajes salud
""".split()
SYLLABLES = [c + v + e for c in "bcdfghklmnprstvw" for v in "aeiou" for e in ("", "", "n", "r", "s", "l", "t", "nd", "th")]
HOSTS = """
    {}.com www.{}.com {}.org www.{}.org {}.net blog.{}.net m.{}.com {}.info {}.co.uk www.{}.de {}.fr {}.es {}.io
    www.{}.example.com {}.example.org blog.{}.example.net m.{}.example.com shop.{}.biz news.{}.eu {}.blogspot.com
""".split()
PATHS = """
    / /{n} /en/{n} /de/{n} /fr/{n}/ /es/{n} /en/{n}.html /index.php /{w}/{n} /{w}/{w}.html /blog/2019/{n}/{w} /wiki/{w}
    /p/{n} /category/{w}/page/{n} /{w}-{w}-{n}
""".split()


def _word(rng: random.Random) -> str:
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4)))


def labelled_names(seed: int = 1) -> list[tuple[str, float]]:
    """Names with their labels (1: block), in an order that mixes both."""
    rng = random.Random(seed)
    found: dict[str, float] = {}
    for term in BLOCK_TERMS:
        others = [*rng.sample(BLOCK_FILLERS, 7), *rng.sample(BLOCK_TERMS, 3)]
        for other in others:
            parts = [term, other] if rng.random() < 0.5 else [other, term]
            found[rng.choice(("-", "-", "")).join(parts)] = 1.0
        found[term] = 1.0
    for word in KEEP_WORDS:
        for _ in range(2):
            parts = rng.choice(([word], [word, rng.choice(KEEP_WORDS)], [rng.choice(("the", "my", "old", "new", "east")), word]))
            found.setdefault(rng.choice(("-", "-", "")).join(parts), 0.0)
        for _ in range(4):
            found.setdefault(_word(rng), 0.0)
    names = sorted(found.items())
    rng.shuffle(names)
    return names


def labelled_urls(seed: int = 1) -> list[tuple[str, str, str, float]]:
    """``(name, host, path, label)``: every name under two hosts."""
    rng = random.Random(seed)
    out = []
    for name, label in labelled_names(seed):
        for host in rng.sample(HOSTS, 2):
            path = rng.choice(PATHS)
            while "{w}" in path:
                path = path.replace("{w}", _word(rng), 1)
            out.append((name, host.format(name), path.replace("{n}", str(rng.randint(1, 9999))), label))
    return out
