"""Kinds of lines of an extracted page, from the line itself, the site's name and the headlines of the corpus."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection
from dataclasses import dataclass, field

import pandas as pd

BLANK, SITE, PROSE, GRID, SHORT = range(5)
#: Least shares of the titles, for a word to stay in a headline's shape and for a shape to be kept.
WORD_SHARE, SHAPE_SHARE = 0.04, 0.0004
#: ASCII letters and digits, as bytes; what ASCII words are split at; all but that as one letter.
ALNUM = bytes(x for x in range(128) if chr(x).isalnum())
BLANKS = bytes(x for x in range(128) if chr(x).isspace())
_SOLID = bytes(x if x in BLANKS else 120 for x in range(256))
#: Characters of a word that is code rather than language.
CODE = 40
#: Tags that a sign of page furniture counts for.
MARK = 14

#: fixed values: function words of the languages that occur
FUNCTION = frozenset(
    "the of and in for to a an that its it with as at by is are was were be been has have had from this these those his her their or but not on which who will would said so while after before into than more because if when where what how"
    " der die das und den dem des von mit ein eine einer einen im zu zum zur auf für ist sind wird nach vor bei wegen ohne als auch nicht"
    " le la les des du de un une et en au aux par pour dans sur avec est sont que qui ne pas ses son sa sans après avant"
    " el los las del una y por con para en al es son su sus se lo sin tras ante"
    " het een van te op aan met voor bij niet zijn naar uit door tegen"
    " il gli di della che per con non da nel os as do dos da das em no na com um uma ao".split()
)
#: fixed values: abbreviations of company forms, which end in a point without ending a sentence
_FORMS = ("inc.", "co.", "corp.", "ltd.", "no.")
_FORM_WORDS = frozenset("plc inc co corp ltd llc ag sa nv gmbh".split())

_LEAD = re.compile(r"^(?:[-*•·–—>#+]+|\(?\d{1,3}[.)])\s+")

#: fixed values: wording of page furniture, on lower-case text with straight quotes and single spaces
_START = re.compile(
    r"^(?:\(c\)|©|copyright\b|reading time|\d+ min(?:ute)?s? read|\d[\d,.]* (?:comments?|shares?|views?|likes?)\b|back to (?:the )?top|skip to|loading\b|advertisements?\b|sponsored\b|"
    r"(?:tags?|topics?|keywords?|categories|filed under|related|see also|read (?:also|more|next)|recommended)\s*:|(?:most (?:read|popular|viewed|shared)|trending|more (?:from|on|stories|news)|read (?:more|next)|related (?:stories|articles|news)|you may also like|recommended for you|latest (?:news|stories)|editor'?s picks?)\b(?=.{0,60}$)|"
    r"(?:story|article) continues|continue reading|(?:subscribe|sign (?:in|up)|log in|register|create an? (?:free )?account) (?:to|for|now|here|today)\b|(?:join|follow|get) (?:our|us|the|\d|more)\b|join [\d,.]+|follow the|"
    r"(?:send|share|print|email|save|tweet|bookmark) this\b|share (?:on|via)\b|(?:liked?|enjoyed?) this|pass it on|by (?:staying|continuing|using|visiting) |we (?:and|use|value|store)\b(?=.*(?:cookie|partner|device|data|privacy))|this (?:site|website|page|material|content) (?:uses|stores|is (?:offered|provided|for))|"
    r"(?:accept|reject|manage) (?:all|optional|cookies|preferences)|(?:published|updated|posted|last updated)\s*(?::|on\b|at\b)?\s*[\w ,.]{0,20}\d)"
)
_INSIDE = re.compile(
    r"(?:small files|cookies) (?:on|to|in) (?:your|this)|on your (?:device|browser)\b|partners process|partner storage|your (?:consent|cookie|privacy) |accept all\b|reject optional|all rights (?:reserved|kept)|\bissn\b|"
    r"(?:read|taken|construed|relied on) as (?:financial |investment |legal )?advice|not (?:an? )?(?:invitation|offer|investment advice|financial advice|recommendation)\b.{0,30}(?:trade|buy|sell|invest)?|no warranty|without (?:prior )?written (?:consent|permission)|may hold positions|may lag by|"
    r"\(\d+ (?:min(?:ute)?s?(?: read)?|shares?|comments?|views?)\)$|\b(?:markets|filings|news|business|economy|politics|city|energy|company|companies) desk, \S+$|stays free thanks|delayed by (?:at least )?\d+ minutes"
)
#: fixed values: a part of every wording that may stand within a line, to pass over lines that have none
_INSIDE_PARTS = ("small files", "cookies", "your device", "your browser", "partner", "your consent", "your cookie", "your privacy", "accept all", "reject optional", "all rights", "issn", "advice", "not a", "not invitation", "not offer", "not investment", "not financial", "not recommendation", "no warranty", "permission", "consent", "may hold", "may lag", " desk,", "stays free", "delayed by")
_BYLINE = re.compile(r"^(?:by|written by|reported by|von|par|por|door)(?: [^\s\d,.;:]+){2,4}(?:,? (?:for|in|at|für|pour|para|voor)(?: [^\s\d.;:]+){1,3})?$")
_NAV_SPLIT = re.compile(r"\s*(?:\||>|»|›|·|•| / )\s*")


def plain(line: str) -> str:
    """The line without its bullet or number, lower case, straight quotes, single spaces."""
    return _plain(line.lower().split())[0]


def _plain(words: list[str]) -> tuple[str, list[str]]:
    """As ``plain``, of a line's words in lower case; and the words that are left."""
    s = text = " ".join(words)
    if not s.isascii():
        text = text.replace("’", "'").replace("“", '"').replace("”", '"')
    if not text[:1].isalpha():
        text = _LEAD.sub("", text)
    return text, words if text == s else text.split()


def row_words(body: str) -> list[list[str]]:
    """The words of each line, in lower case."""
    return [r.split() for r in body.lower().split("\n")]


def has_run(body: str, n: int) -> bool:
    """Whether any word has ``n`` characters or more."""
    if body.isascii():
        return b"x" * n in body.encode().translate(_SOLID)
    return max(map(len, body.split()), default=0) >= n


@dataclass
class Headlines:
    """Shapes of headlines: ``kept`` are words that stay in a shape, ``shapes`` those seen often enough."""

    kept: frozenset = frozenset()
    shapes: frozenset = frozenset()
    longest: int = 0  # words of the longest title
    tree: dict = field(init=False, compare=False, repr=False)  # of the shapes' tokens; None where a shape ends

    def __post_init__(self) -> None:
        self.tree = {}
        for shape in self.shapes:
            node = self.tree
            for token in shape.split(" "):
                node = node.setdefault(token, {})
            node[None] = {}

    def _token(self, word: str) -> tuple[str, str]:
        """What a word stands for in a shape, and the mark that follows it."""
        core = word.strip("\"'()[]")
        end = core[-1:] if core[-1:] in ",:;?" else ""
        core = core.rstrip(".,:;?!'\"")
        return core if core in self.kept else "0" if core[:1].isdigit() or core[:1] in "$€£" else "w", end

    def shape(self, text: str) -> str:
        out: list[str] = []
        for w in text.split():
            token, end = self._token(w)
            if not (token == "w" and out and out[-1] == "w"):
                out.append(token)
            if end:
                out.append(end)
        return " ".join(out)

    def fits(self, text: str) -> bool:
        """Whether ``shape`` is one of ``shapes``, read no further than any of them agrees."""
        node, last = self.tree, ""
        for w in text.split():
            token, end = self._token(w)
            if not token == last == "w":
                node = node.get(token)
                if node is None:
                    return False
            if end:
                node = node.get(end)
                if node is None:
                    return False
            last = end or token
        return None in node


def title_words(title: str) -> set[str]:
    """The words of a title that may stay in a shape."""
    return {w for w in (x.strip("\"'()[].,:;?!") for x in title.split()) if w and w.islower() and w not in _FORM_WORDS}


def learn_headlines(counts: list[tuple[str, int]], word_share: float = WORD_SHARE, shape_share: float = SHAPE_SHARE) -> Headlines:
    """Shapes from (title, count) pairs; words in at least ``word_share`` of the titles stay in a shape."""
    n = sum(c for _, c in counts) or 1
    df: Counter = Counter()
    for t, c in counts:
        for w in title_words(t):
            df[w] += c
    model = Headlines(frozenset(w for w, c in df.items() if c >= max(2, word_share * n)))
    shapes: Counter = Counter()
    for t, c in counts:
        shapes[model.shape(plain(t))] += c
    return Headlines(model.kept, frozenset(s for s, c in shapes.items() if c >= max(2, shape_share * n) and len(s) > 1), max((len(t.split()) for t, _ in counts), default=0))


def site_name(domain: str | None) -> str:
    """The label of a domain that a site uses as its name, or nothing if it is too short to mean it."""
    parts = [p for p in (domain or "").lower().split(".") if p not in ("www", "com", "net", "org", "co", "uk", "example")]
    return max(parts, key=len, default="") if parts and len(max(parts, key=len)) >= 5 else ""


@dataclass(slots=True)
class Line:
    kind: int
    text: str = ""
    words: int = 0
    chars: int = 0
    ends: bool = False
    tags: int = 0  # that signs of links and of page furniture count for
    phrase: bool = False  # has function words


def _grid(s: str, text: str, words: int, function: bool, code: bool) -> bool:
    """Table rows, labels in a row, encoded or unreadable characters, heaps of words."""
    n = len(s)
    blanks = s.count(" ") + s.count("\t")
    symbols = len(s.encode().translate(None, ALNUM)) - blanks if s.isascii() else n - blanks - sum(map(str.isalpha, s)) - sum(map(str.isdigit, s))
    if symbols > 0.4 * (n - blanks):
        return True
    if code and n > CODE and max(map(len, s.split())) >= CODE and "://" not in s:
        return True
    if function:
        return False
    digits = sum(map(s.count, "0123456789"))
    if digits >= 0.3 * n and n >= 3:
        return True
    if s.count(",") >= 4 or s.count(";") >= 2 or "\t" in s or "|" in s and digits:
        return True
    return words >= 3 and text[-1:] not in ".!?"


def finder(parts: tuple[str, ...]):
    """A function that gives those of ``parts`` which a text has, in one scan."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for x in parts:
        machine.add_word(x, x)
    machine.make_automaton()
    return lambda text: {x for _, x in machine.iter(text)}


_inside = finder(_INSIDE_PARTS)


def parts_in(body: str) -> set[str]:
    """Those pieces of the wording within lines that a body has at all."""
    return _inside((" ".join(body.split()) if "  " in body or "\t" in body else body).lower())


def _marks(s: str, text: str, words: list[str], site: str, headlines: Headlines, parts: Collection[str]) -> int:
    """Tags that a line's signs of being furniture or a link count for; a line has no bound of length, it only outweighs them."""
    bare = text.rstrip(".!")
    tags = 0
    if site and (site in text or site in text.replace(" ", "")):
        tags += MARK
    if _START.match(bare):
        tags += MARK
    if (bare.endswith(")") or parts and any(x in bare for x in parts)) and _INSIDE.search(bare):
        tags += MARK
    if bare[:1] in "bwrvp" and _BYLINE.match(bare):
        tags += MARK
    if "|" in s or ">" in s or " / " in s or not s.isascii() and ("»" in s or "·" in s or "•" in s or "›" in s):
        pieces = [p for p in _NAV_SPLIT.split(s) if p]
        if len(pieces) >= 3 and not any(map(str.isdigit, s)) and sum(map(str.isalpha, s)) > 0.6 * len("".join(words)) and len(words) <= 5 * len(pieces):
            tags += len(words) + len(pieces)
    if len(words) <= headlines.longest and headlines.fits(bare):
        tags += MARK
    return tags


def read_line(line: str, site: str, headlines: Headlines, parts: Collection[str] = _INSIDE_PARTS, words: list[str] | None = None, code: bool = True) -> Line:
    """What a line is by itself: prose, part of a grid, or too short to tell, and how many tags its signs of furniture count for; SITE if they outweigh it.

    ``parts`` are those of ``parts_in`` its body, ``words`` those of ``row_words``; without ``code`` its body has no word of ``CODE`` characters."""
    s = line.strip()
    if not s:
        return Line(BLANK)
    text, words = _plain(s.lower().split() if words is None else words)
    n = len(words)
    chars = len(text)
    function = not FUNCTION.isdisjoint(words) or not FUNCTION.isdisjoint(w.strip(".,;:!?\"'()") for w in words)
    stop = text[-1:] in '.!?"…:' and not text.endswith("...")
    tags = _marks(s, text, words, site, headlines, parts)
    if tags * 20 > chars:
        kind = SITE
    elif _grid(s, text, n, function, code) or not s.isascii() and sum(1 for c in s if c > "\u007f" and not c.isalpha() and c not in "’‘“”„–—…•·«·»°€£©") > 0.08 * len(s):
        kind = GRID  # or wrongly decoded
    elif n >= 6 and function and (stop or n >= 12 or text.endswith(_FORMS)):
        kind = PROSE
    else:
        kind = SHORT
    return Line(kind, text, n, chars, stop, tags, function)


def headlines_of(articles, most: int | None = None) -> Headlines:
    """Shapes learnt as by ``learn_headlines`` from all titles of ``articles``, or from the ``most`` least hashes of their ids.

    Titles are counted where they lie; only words and shapes above the cut-offs, some thousands at most, reach the driver.
    """
    from pyspark.sql import functions as F

    titled = articles.filter("title IS NOT NULL")
    if most is not None:
        titled = titled.orderBy(F.xxhash64("id"), "title").limit(most)
    titled = titled.select("title")
    size = titled.agg(F.count("*").alias("n"), F.max(F.size(F.split(F.trim("title"), r"\s+"))).alias("longest")).first()
    n, longest = size["n"] or 1, size["longest"] or 0

    def often(tokens, least: float) -> list[str]:
        def run(batches):
            for pdf in batches:
                seen = Counter(t for title in pdf["title"] for t in tokens(title))
                yield pd.DataFrame({"token": list(seen.keys()), "c": list(seen.values())}).astype({"token": object, "c": "int64"})

        counts = titled.mapInPandas(run, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))
        return [r["token"] for r in counts.filter(F.col("c") >= F.lit(least)).collect()]

    kept = Headlines(frozenset(often(title_words, max(2, WORD_SHARE * n))))
    return Headlines(kept.kept, frozenset(s for s in often(lambda title: [kept.shape(plain(title))], max(2, SHAPE_SHARE * n)) if len(s) > 1), longest)
