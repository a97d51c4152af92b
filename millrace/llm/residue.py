"""Problem 3: bodies that are, or contain, template residue, filler, error pages or script notices.

A body's fingerprint is taken from its words without figures and without the name of its site, so that one server's
page is near the next one's. Wording that standards or template languages fix makes a few bodies trusted; the label of
a trusted page runs along near-duplicates, hop by hop, until its components are covered. A hop looks texts up in
partitioned SimHash tables, keeps those within a Hamming distance, and checks the share of five-word shingles on the
texts themselves. As tables miss some pairs at just that share, texts not reached are then looked up by their least shingle
hashes, of which two texts so alike always share one.
A body that has residue within an article keeps its label to itself, as its near-duplicates may lack just that line.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import kernels as K
from millrace.llm import lines as L
from millrace.session import materialize, small_enough

#: Words of a shingle; least share of equal shingles; most differing bits of two fingerprints (at that share 10 on average, 3 standard deviations more).
SHINGLE, SIMILAR, HAMMING = 5, 0.8, 20
#: SimHash tables; bits of a key.
TABLES, KEY_BITS = 48, 14
#: Texts of a hop whose keys (about 100 of 30 bytes each) may be broadcast; beyond that both sides are shuffled by key.
BROADCAST_TEXTS = 10_000
#: Pairs whose ids (16 bytes a pair) may be broadcast.
VERIFIED_PAIRS = 500_000
#: Words of a sentence that no page of residue alone has.
STORY_WORDS = 12

#: fixed values: unfilled placeholders of template languages
_PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]{1,200}\}\}|\{%-?[^%{}\n]{1,200}%\}|<%[=-]?[^%<>\n]{1,200}%>|</?#[a-z]+(?: [^<>\n]{1,200})?>|\[\[[^\[\]\n]{1,200}\]\]|#\{[a-z][^{}\n]{1,200}\}|\$\{[a-z][^{}\n]{1,200}\}|(?<!\w)__[a-z][a-z0-9_.]{1,80}__(?!\w)|@@[a-z][a-z0-9_.]{1,80}@@|"
    r"(?<![\w{$#])\{[a-z][a-z0-9]*(?:[_.][a-z0-9]+)*\}(?![\w}])|\[(?:insert|add|enter|placeholder|todo|tbd|tk)\b[^\]\n]{0,200}\]|(?<=\bdear )\[[^\]\n]{1,200}\]|(?<!\w)%%?[a-z]+(?:_[a-z]+)+%%?(?!\w)|<(?:insert|your|enter)\b[^<>\n]{1,200}>",
    re.IGNORECASE,
)
#: the characters that a placeholder may begin with; the pattern itself is tried only there
_OPENS = re.compile(r"[{\[<_@%$#]")
#: fixed values: editors' stand-ins, unset values printed as text, error reports of programs
_STAND_IN = re.compile(
    r"\btktk\b|(?:^|\n)\W*tk\s*[:\-–]|\btk\s*:\s|\b(?:text|copy|quote|headline|photo|caption|details|story) (?:to come|tk|to follow)\b|\blorem ipsum\b|\bdolor sit amet\b|\bplaceholder (?:text|copy)\b|\b(?:dummy|sample) (?:text|copy)\b|"
    r"\b(?:undefined|null|nan|none)\s?%|[$€£]\s?(?:undefined|null|nan|none)\b|\[object object\]|\bundefined\b[^\n]{0,80}\b(?:nan|null|undefined)\b|\bnan\b[^\n]{0,80}\b(?:null|undefined|nan)\b|"
    r"(?:^|\n)\W*traceback\s*[:(]|\btraceback \(most recent|\b(?:key|type|value|attribute|name|index|syntax|reference)error\b\s*[:'(\"]|\bnullpointerexception\b|\bstack trace:|\bfatal error:|\bphp (?:warning|notice|deprecated):|\bundefined (?:variable|index|method|property)|\berr_[a-z]+_[a-z_]+\b",
    re.IGNORECASE,
)
#: fixed values: lines of error pages and of pages without scripts, from the status codes of HTTP and the usual names of scripts
_NOTICE = re.compile(
    r"^(?:(?:error |http )?(?:4\d\d|5\d\d)(?:\s*[-:]?\s*(?:error|not found|page not found|forbidden|gone|bad gateway|unauthorized|service unavailable|internal server error|gateway time-?out))?|http status\b.*|"
    r"(?:page|file|article|story) not found|(?:internal )?server error|bad gateway|gateway time-?out|service (?:temporarily )?unavailable|access denied|forbidden|request timed? ?out|.*\(error \d{3}\).*|oops\b.*|"
    r"sorry,? .*\b(?:could not|couldn't|cannot|can't|unable to) (?:find|load|display|show|open)\b.*|.*\brequested url\b.*\bnot found\b.*|.*\b(?:story|page|article|content) is no longer available|we are (?:performing|undergoing|down for) (?:scheduled )?maintenance\b.*|your session has (?:expired|timed out)\b.*|"
    r"(?:please )?(?:enable|turn on|switch on|activate|allow) (?:java ?scripts?|js|scripts?|scripting)\b.*|\S+(?: \S+){0,4} (?:needs?|requires?) (?:java ?scripts?|js|scripts?|scripting)\b.*|(?:java ?scripts?|js|scripts?) (?:is|are|must be|needs? to be) (?:required|disabled|needed|enabled|switched|turned|off|blocked)\b.*|"
    r".*\byour browser (?:blocks|does not|doesn't|cannot|can't)\b.*\b(?:them|scripts?|java ?scripts?)\b.*|you (?:need to|must) (?:turn on|enable|switch on|allow|activate) (?:java ?scripts?|js|scripts?|scripting)\b.*|you (?:need to|must) have (?:java ?scripts?|js|scripts?) .*)$"
)
#: fixed values: a part of every wording above, to pass over texts and lines that have none
_STAND_IN_PARTS = ("tk", "to come", "to follow", "lorem", "dolor sit", "placeholder", "dummy", "sample", "undefined", "null", " nan", "nan%", "none%", "none %", "$none", "[object", "traceback", "error", "exception", "stack trace", "php ", "err_")
_NOTICE_PARTS = ("not found", "sorry", "error", "gateway", "unavailable", "denied", "forbidden", "timed", "oops", "no longer", "maintenance", "expired", "script", "http", " js")
#: stand-ins with "error", from a letter on that no other letter equals when case is ignored
_ERROR_PARTS = ("keyerror", "typeerror", "valueerror", "buteerror", "nameerror", "dexerror", "taxerror", "renceerror", "fatal error")
_parts = L.finder(_STAND_IN_PARTS + _NOTICE_PARTS)
_LATIN = re.compile(r"^[^\W\d_]+$")


def _filler(line: str) -> bool:
    """Sentences of made-up words: points and capitals as in prose, but no function word of any language and no figure."""
    if not L.FUNCTION.isdisjoint(line.lower().split()):
        return False
    words = line.split()
    if len(words) < 8 or line.rstrip()[-1:] not in ".!?" or any(c.isdigit() for c in line) or "," in line and line.count(",") > len(words) / 4:
        return False
    bare = [w.strip(".,;:!?\"'()-*•").lower() for w in words]
    if any(w in L.FUNCTION for w in bare) or not all(_LATIN.match(w) for w in bare if w):
        return False
    # a list of names has capitals throughout; sentences have few
    if line.upper() == line:
        return len(set(bare)) < len(bare)
    return sum(w[:1].isupper() for w in words) <= 0.34 * len(words)


def residue_kind(body: str, site: str = "") -> str:
    """The kind of residue that a body shows by its wording, or nothing: ``placeholder``, ``stand_in``, ``filler``, ``notice``."""
    if ("{" in body or "[" in body or "__" in body or "@@" in body or "_" in body and "%" in body or "<" in body) and any(_PLACEHOLDER.match(body, m.start()) for m in _OPENS.finditer(body)):
        return "placeholder"
    low = body.lower()
    have = _parts(low)
    worded = have.intersection(_STAND_IN_PARTS)
    if worded and (worded != {"error"} or any(x in low for x in _ERROR_PARTS)) and _STAND_IN.search(body):
        return "stand_in"
    rows = low.split("\n")
    parts = have.intersection(_NOTICE_PARTS)
    codes = "40" in low or "41" in low or "50" in low
    if parts or codes:
        first = True
        for line in rows:
            if len(line) < 3:
                continue
            code = codes and len(line) < 60 and ("40" in line or "41" in line or "50" in line)
            if (code or any(x in line for x in parts)) and _NOTICE.match(said := L.plain(line).rstrip(".! ")):
                # a number alone is a status where it heads the page; further down it's a figure of the article
                if first or not said.isdigit():
                    return "notice"
            first = first and not line.strip()
    for line, said in zip(body.split("\n"), rows):
        if len(line) > 40 and not (" the " in said or " and " in said or " of " in said or " in " in said) and _filler(line.strip()):
            return "filler"
    return ""


def whole_page(body: str, site: str) -> bool:
    """Whether a body with residue is nothing else: no line without residue is a sentence as long as those of a story."""
    furniture = L.Headlines()
    for row in body.split("\n"):
        if row.count(" ") >= STORY_WORDS and not residue_kind(row, site):
            x = L.read_line(row, site, furniture)
            if x.kind == L.PROSE and x.words > STORY_WORDS:
                return False
    return True


def masked(body: str, site: str) -> str:
    """Lower case without the name of the site; fingerprints pass over figures as well."""
    low = body.lower()
    return low.replace(site, " ") if site else low


#: the bits of each SimHash table's key: fixed shuffles of the 64 bits, each cut into four
_KEYS = np.concatenate([np.random.default_rng(k).permutation(64)[: 4 * KEY_BITS].reshape(4, KEY_BITS) for k in range(TABLES // 4)])


def _band(n_shingles: np.ndarray) -> np.ndarray:
    """Texts with ``SIMILAR`` equal shingles are in the same band of sizes or in neighbours."""
    return np.floor(np.log(np.maximum(n_shingles, 1)) / -np.log(SIMILAR) + 1e-9).astype(np.int32)


def _keys(sim: np.ndarray, band: np.ndarray) -> list[np.ndarray]:
    """The table, band and key bits of each fingerprint, in one number per table."""
    bits = np.unpackbits(sim.view(np.uint8).reshape(-1, 8), axis=1)[:, _KEYS]
    key = np.packbits(bits, axis=2).astype(np.int32)
    key = key[..., 0] << 8 | key[..., 1]
    return list((np.arange(TABLES, dtype=np.int32) << 25)[None, :] | (band[:, None] << 16) | key)


LABELS = "id long, kind string, trusted boolean, sim long, n_words int, text long, n_shingles int, band int, keys array<int>, least array<int>"
#: further columns of a body that a caller reads in the same pass: (bodies, sites) -> columns
Reader = Callable[[list[str], list[str]], dict[str, list]]


def labels(articles: DataFrame, reader: Reader | None = None, extra: str = "") -> DataFrame:
    """A row per non-blank body: its residue by wording, whether it is nothing else, fingerprint, hash of its words, number and least
    hashes of its shingles, and the columns ``extra`` that ``reader`` gives."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[pdf["body_text"].notna()]
            pdf = pdf[pdf["body_text"].str.strip() != ""]
            if not len(pdf):
                continue
            bodies = pdf["body_text"].tolist()
            sites = [L.site_name(d) for d in pdf["source_domain"]]
            kinds = [residue_kind(b, s) for b, s in zip(bodies, sites)]
            prints = K.prints([masked(b, s) for b, s in zip(bodies, sites)], SHINGLE, SIMILAR, False)
            band = _band(prints["n_shingles"])
            trusted = [bool(k) and whole_page(b, s) for k, b, s in zip(kinds, bodies, sites)]
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "kind": kinds, "trusted": trusted, **prints, "band": band, "keys": _keys(prints["sim"], band), **(reader(bodies, sites) if reader else {})})

    return articles.select("id", "body_text", "source_domain").mapInPandas(run, LABELS + (", " + extra if extra else ""))


def _same_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        both = zip(pdf["text_a"], pdf["site_a"], pdf["text_b"], pdf["site_b"])
        keep = [K.shared_shingles(masked(x, L.site_name(p)), masked(y, L.site_name(q)), SHINGLE, False) >= SIMILAR for x, p, y, q in both]
        yield pdf.loc[np.array(keep, dtype=bool), ["a", "b"]]


def verified(pairs: DataFrame, articles: DataFrame) -> DataFrame:
    """``pairs`` (stored) whose bodies share at least ``SIMILAR`` of their shingles. Only bodies of the pairs are moved; few ids are broadcast."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    few = F.broadcast if small_enough(pairs, VERIFIED_PAIRS) else lambda x: x
    texts = articles.select("id", "body_text", "source_domain").filter("body_text IS NOT NULL").join(few(ids), "id", "left_semi").dropDuplicates(["id"])
    side = lambda x: texts.select(F.col("id").alias(x), F.col("body_text").alias(f"text_{x}"), F.col("source_domain").alias(f"site_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(_same_text, "a long, b long")


def table_pairs(rest: DataFrame, asked: DataFrame, hint: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """(a, b, bits): texts ``a`` of ``rest`` and ``b`` of ``asked`` that share a key of a SimHash table and differ in at most ``HAMMING`` bits."""
    near = F.array(*[F.col("key") + F.lit(d << 16) for d in (-1, 0, 1)])
    known = asked.select(F.col("id").alias("b"), F.col("sim").alias("o"), F.explode("keys").alias("key")).select("b", "o", F.explode(near).alias("key"))
    bits = F.bit_count(F.col("sim").bitwiseXOR(F.col("o")))
    return rest.select(F.col("id").alias("a"), "sim", F.explode("keys").alias("key")).join(hint(known), "key").select("a", "b", bits.alias("bits")).filter(F.col("bits") <= HAMMING)


def least_pairs(rest: DataFrame, asked: DataFrame, hint: Callable[[DataFrame], DataFrame] = lambda x: x) -> DataFrame:
    """(a, b): texts of ``rest`` and ``asked`` that share one of their least shingle hashes and are of like size: none at ``SIMILAR`` is missed."""
    known = asked.select(F.col("id").alias("b"), F.col("n_shingles").alias("m"), F.explode("least").alias("h"), "band")
    known = known.select("b", "m", "h", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"))
    size = (F.col("m") >= F.col("n") * F.lit(SIMILAR) - F.lit(1e-6)) & (F.col("n") >= F.col("m") * F.lit(SIMILAR) - F.lit(1e-6))
    mine = rest.select(F.col("id").alias("a"), F.col("n_shingles").alias("n"), F.explode("least").alias("h"), "band")
    return mine.join(hint(known), ["h", "band"]).filter(size).select("a", "b").distinct()


def hop(rest: DataFrame, asked: DataFrame, articles: DataFrame) -> DataFrame:
    """(id): texts of ``rest`` near a text of ``asked``.

    Each text is first compared to the nearest of those that it meets in the tables, and only if that isn't near enough to the
    others. Keys of few texts are broadcast, so that ``rest`` isn't shuffled.
    """
    hint = F.broadcast if small_enough(asked, BROADCAST_TEXTS) else lambda x: x
    bands = asked.select(F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band")).distinct()
    rest = rest.join(F.broadcast(bands), "band", "left_semi")  # a few dozen sizes at most
    nearest = materialize(table_pairs(rest, asked, hint).groupBy("a").agg(F.min_by("b", F.struct("bits", "b")).alias("b")), "nearest")
    met = materialize(verified(nearest, articles).select(F.col("a").alias("id")), "met")
    left = materialize(least_pairs(rest.join(met, "id", "left_anti"), asked, hint), "least")
    if left.isEmpty():
        return met
    return met.unionByName(materialize(verified(left, articles).select(F.col("a").alias("id")).distinct(), "more"))


def reach(texts: DataFrame, articles: DataFrame, seeds: DataFrame) -> DataFrame:
    """(id): ``seeds`` (id) and all of ``texts`` that a chain of near-duplicates leads to: the seeds' components."""
    reached = frontier = seeds
    while True:
        asked = materialize(texts.join(frontier, "id", "left_semi"), "asked")
        new = materialize(hop(texts.join(reached, "id", "left_anti"), asked, articles), "reached")
        if new.isEmpty():
            return reached
        frontier, reached = new, reached.unionByName(new)


def excluded(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """(id, by): of stored ``labels``, the bodies to exclude, by their own ``wording`` or by ``link``; copies share their text's label."""
    # copies of one text are one node, so that a text under very many ids is no bucket; a text without words has no neighbours
    own = [F.first(c).alias(c) for c in ("sim", "n_shingles", "band", "keys", "least")]
    texts = materialize(rows.filter("n_words > 0").groupBy("text", "n_words").agg(F.min("id").alias("id"), *own, F.max("trusted").alias("trusted")), "texts")
    seeds = materialize(texts.filter("trusted").select("id"), "seeds")
    alike = rows.join(texts.join(reach(texts, articles, seeds), "id", "left_semi").select("text", "n_words"), ["text", "n_words"], "left_semi")
    by = F.when(F.max("worded"), F.lit("wording")).otherwise(F.lit("link"))
    both = rows.filter("kind <> ''").select("id", F.lit(True).alias("worded")).unionByName(alike.select("id", F.lit(False).alias("worded")))
    return both.groupBy("id").agg(by.alias("by"))


def found(articles: DataFrame) -> DataFrame:
    """(id): articles to exclude. Null and blank bodies are no case; repeated rows of an id give it once."""
    return excluded(materialize(labels(articles), "labels"), articles).select("id")
