"""The labelled URL table the filter learns from, several hundred invented sites made from word lists by a rule.

A site's name is two words of its kind; every name comes with several hosts and paths. Paths that say
something of their kind stand beside plain ones, so neither part of a URL decides alone. No name is taken from
data the filter is measured on.
"""

_UNWANTED = (
    "poker", "slots", "roulette", "jackpot", "lottery", "viagra", "steroid", "pharma", "painkiller", "slimming",
    "porn", "escort", "webcam", "nude", "hookup", "payday", "loans", "forex", "bitcoins", "replica",
    "knockoff", "warez", "torrent", "keygen", "clickbait", "popunder", "banner", "backlink", "doorway", "phishing",
)
_UNWANTED_BESIDE = ("24", "online", "deal", "bonus", "hot", "king", "promo", "discount", "xxx", "easy", "sexy", "vip")
_UNWANTED_PATHS = ("/bonus/{}", "/buy-now/{}.php", "/promo/click{}", "/go.php", "/xxx/{}/", "/order-now/{}")

_ORDINARY = (
    "news", "library", "university", "weather", "recipes", "history", "garden", "museum", "council", "science",
    "books", "travel", "station", "mountain", "river", "music", "town", "theatre", "chess", "botany",
    "physics", "archive", "parish", "school", "railway", "poetry", "cycling", "astronomy", "harbour", "pottery",
)
_ORDINARY_BESIDE = ("club", "guide", "society", "notes", "review", "forum", "house", "atlas", "daily", "institute", "group", "trust")
_ORDINARY_PATHS = ("/articles/{}", "/about/{}.html", "/2021/05/{}", "/docs/chapter{}/", "/people/{}", "/events/{}.html")

_PLAIN_PATHS = ("/en/{}", "/fr/{}", "/de/{}.html", "/es/{}/", "/")
_HOSTS = (
    "https://www.{}.example.com", "http://{}.example.net", "https://m.{}.example.org", "https://blog.{}.example.com",
    "http://{}.com", "https://{}.info",
)


def _urls(words: tuple[str, ...], beside: tuple[str, ...], paths: tuple[str, ...]) -> tuple[str, ...]:
    """Twelve URLs a word: three names of it, each with four hosts, every second one with a path of its kind."""
    out = []
    for i, word in enumerate(words):
        for j in range(3):
            other = beside[(i + 4 * j) % len(beside)]
            name = f"{word}-{other}" if (i + j) % 2 else f"{other}{word}"
            for k in range(4):
                at = i + 5 * j + k
                path = paths[at % len(paths)] if k % 2 else _PLAIN_PATHS[(at + j) % len(_PLAIN_PATHS)]
                out.append(_HOSTS[at % len(_HOSTS)].format(name) + path.format(17 * at % 991))
    return tuple(out)


BLOCKED = _urls(_UNWANTED, _UNWANTED_BESIDE, _UNWANTED_PATHS)
ALLOWED = _urls(_ORDINARY, _ORDINARY_BESIDE, _ORDINARY_PATHS)
