"""Problem 7: personal information inside free text.

Method (information-theoretic sanitisation): candidate terms are found by
shape alone (addresses of mail, runs of digits, mixed codes, postal lines,
capitalised words). Over all rows it is counted how often the words around a
candidate (its cues) and the candidate's own parts (the words of a name, the
host of an address, the form of an identity number) stand with terms known to be protected
(seeds: lexicon names, mail addresses made of them, whole postal addresses,
unmistakable numbers) and with terms that are not. From these co-occurrences
follows how much information, in bits, cues and parts give about the kind; a
candidate of any kind whose form, cues and parts together exceed the disclosure
threshold is replaced by a placeholder of its kind, the rest stays. So a surname
that no lexicon has is known by the names it stands beside elsewhere, and a
common word by the many rows in which it stands beside none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_by_group, materialize

FIELDS = ("title", "description")
KINDS = ("name", "email", "phone", "id_number", "address")
PLACEHOLDER = {"name": "<NAME>", "email": "<EMAIL>", "phone": "<PHONE>", "id_number": "<ID_NUMBER>", "address": "<ADDRESS>"}
#: Bits of evidence from which a candidate is held to disclose an entity of its kind.
DISCLOSURE = 1.0
#: Sightings of a cue before it counts.
SEEN = 3
#: Most bits that parts add or take, and bits that a single unknown capitalised word starts from.
PART_GAIN, PART_LOSS, UNKNOWN_WORD = 4.0, 2.0, -4.5
#: Distinct cues and parts a task counts before it hands its counts on.
HELD_CUES = 500_000

#: Mailboxes of a function (fixed values).
FUNCTION_BOX = frozenset("security noreply no-reply donotreply info support admin abuse postmaster webmaster hello contact sales help team press bugs bounty disclosure psirt git root hostmaster notifications notification mailer-daemon billing office jobs legal privacy dev ops service services alerts".split())
EMAIL = re.compile(r"(?<![\w.+/@-])(?:mailto:)?([A-Za-z0-9][\w.+'-]*)\s?(?:@|\s?[(\[]\s?at\s?[)\]]\s?|\sat\s)\s?((?:[A-Za-z0-9-]+(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?|\sdot\s))+[A-Za-z]{2,})(?![\w@])", re.I)
#: Words that make "x at y dot z" an ordinary phrase (fixed values).
_AT_WORD = frozenset("calls node look looks looked available runs located stored served build line".split())

NUMBER = re.compile(r"(?<![\w.#/+-])(?P<cc>\+|00)?(?:\(0?\d{1,4}\)|\d)[\d ().\-/]{4,20}\d(?:\s?(?:ext\.?|x)\s?\d{1,5})?(?![\w-]|\.\d)")
CODE = re.compile(r"(?<![\w./#+-])(?:[A-Z]{1,3} ?\d{2}(?: ?\d{2}){2,3} ?[A-Z]?|[A-Z]{1,2}\d{4}/\d{4,6}|[A-Z]{1,2}\d{6,9}|\d{7,9}-?[A-Z]|[A-Z]\d{2}[A-Z]\d{2}[A-Z]\d{2}|\d{3}-\d{2}-\d{4}|\d{6}[+-]\d{3,4}[0-9A-Z]?|\d{9,12})(?![\w-])")

#: Names of numbers that authorities give to persons, right before the number (fixed values).
ID_WORD = re.compile(r"(?i)(?:passport|social security|(?:national )?insurance|\bssn|\bnino|\bdni|\bnie|\bnif|\bpesel|\bcpf|\bbsn|\bsin|\bnhs|tax(?:payer)? id|\btin|identity card|id card|identity number|driving licen[cs]e|driver'?s licen[cs]e|driver licen[cs]e|personalausweis|reisepass|steuer-?id|sozialversicherung\w*|carte d.identit. |num.ro de s.curit. sociale|aadhaar|residence permit|voter id)(?:'s)?(?: (?:no|nr|number|num|id|card)\b\.?)?[ :#]*(?:is )?$")
#: Words for streets (fixed values).
STREET = r"(?:Street|St\.?|Avenue|Ave\.?|Road|Rd\.?|Lane|Ln\.?|Drive|Dr\.?|Court|Ct\.?|Way|Blvd\.?|Boulevard|Place|Pl\.?|Square|Terrace|Row|Rise|Close|Crescent|Hill|Walk|Grove|Mews|Parade|Quay|Circle|Trail|Parkway|Alley)"
STREET_TAIL = r"(?:weg|straße|strasse|str\.|gasse|allee|platz|zeile|ufer|damm|steig|stieg)"
STREET_HEAD = r"(?:rue|avenue|av\.|boulevard|chemin|allée|impasse|place|route|quai|calle|avenida|plaza|paseo|via|viale|piazza|corso|rua|travessa|ulica|ul\.|aleja)"
_W = r"[A-ZÀ-Ý][\wÀ-ÿ'’-]+"
_TOWN = rf"{_W}(?:[ -](?:[a-zà-ÿ]{{1,3}}[ -])?{_W})*"
ADDRESS = re.compile(
    rf"(?:(?:Apt|Apartment|Flat|Unit|Suite)\.? \d+\w?,? )?\b\d{{1,5}}[a-z]? (?:{_W} ){{1,3}}{STREET}(?! mode)\b(?: (?:N|S|E|W|NE|NW|SE|SW|Street))?(?:,? ?\n? ?{_TOWN}(?:,? [A-Z]{{2}})?(?: \d{{4,6}}(?:-\d{{4}})?)?)?"
    rf"|(?<![\wÀ-ÿ])(?:{_W}[ -])?[A-ZÀ-Ý][a-zà-ÿ'’-]*(?:{STREET_TAIL})\b \d{{1,4}}[a-z]?(?:,? ?\n? ?\d{{4,6}} {_TOWN})?"
    rf"|\b(?:Am|An der|Auf der|Zum|Zur|Im|In den|Krumme|Alte[rn]?|Lange|Hohe|Neue)(?: {_W}){{1,2}} \d{{1,4}}[a-z]?,? ?\n? ?\d{{4,6}} {_TOWN}"
    rf"|\b(?:\d{{1,4}}(?: ?bis)?,? )?{STREET_HEAD} (?:d[eu]s? |de l[ae’'] ?|del |d['’])?(?:la |l['’])?{_W}(?: {_W})*(?: \d{{1,4}})?,? ?\n? ?\d{{4,6}} {_TOWN}"
    rf"|\bP\.? ?O\.? ?Box \d+(?:,? ?\n? ?{_TOWN}(?: \d{{4,6}})?)?"
    rf"|\bPostfach \d[\d ]*,? \d{{4,6}} {_TOWN}"
    rf"|\b{_W}(?: {_W})? \d{{1,4}}[a-z]?, \d{{5}} {_TOWN}"
)

#: Pieces of which every postal line of ADDRESS has one, or a postal code before a town.
STREET_HINTS = tuple("Street,St ,St.,Avenue,Ave,Road,Rd,Lane,Ln,Drive,Dr ,Dr.,Court,Ct,Way,Blvd,Boulevard,Place,Pl ,Pl.,Square,Terrace,Row,Rise,Close,Crescent,Hill,Walk,Grove,Mews,Parade,Quay,Circle,Trail,Parkway,Alley,weg ,straße,strasse,str.,gasse,allee,platz,zeile,ufer,damm,steig,stieg,Box ,Postfach".split(","))
TOWN_HINT = re.compile(r"\d{4,6} [A-ZÀ-Ý]")

POSTAL_END = re.compile(r"[ \n]\d{4,6}(?:-\d{4})?$")
#: Bits of a candidate that is none and only counts against its cues.
NEVER = -99.0

HONORIFIC = r"(?:Mrs?|Ms|Miss|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?"
_PART = rf"(?:{HONORIFIC}(?= )|[A-ZÀ-Ý][a-zà-ÿ'’-]+|[A-ZÀ-Ý]{{2,}}|[A-ZÀ-Ý]\.)"
NAME = re.compile(rf"(?<![\w@/.#-]){_PART}(?:,? {_PART}){{0,4}}(?![\w@/])")
NAME_PART = re.compile(_PART)
IS_HONORIFIC = re.compile(HONORIFIC)
LETTERS = re.compile(r"(?<![\w@/.#-])([a-zà-ÿ'’-]{3,}),? (?=([a-zà-ÿ'’-]{3,})(?![\w@/]))")
CUE_WORD = re.compile(r"[A-Za-z]+|\d+|[^\w\s]")
#: Function words of English, with which no name begins (fixed values).
COMMON = frozenset(
    """a an the and or but nor if then so as at by for from in into of off on onto out over per to under up via with without about above after again against all also any because been before being below
    between both can could did do does during each few had has have having he her here his how i is it its may me might more most must my no not now only other our own same she should some such than that
    their them there these they this those through too until very was we were what when where which while who why will would you your""".split()
)


@lru_cache(maxsize=50_000)
def _shape(word: str) -> str:
    return word.lower().strip(".,'’")


class Names:
    """Known name words, and how much the end of a word tells that it is one."""

    def __init__(self, lexicon: list[tuple[str, str]]):
        self.kind: dict[str, str] = {}
        for w, k in lexicon:
            if w:
                self.kind.setdefault(w.strip().lower(), (k or "").strip().lower())
        ends: dict[str, int] = {}
        starts: dict[str, int] = {}
        for w in self.kind:
            for n in (3, 4, 5, 6):
                if len(w) > n:
                    ends[w[-n:]] = ends.get(w[-n:], 0) + 1
            for n in (2, 3, 4, 5):
                if len(w) > n + 1:
                    starts[w[:n]] = starts.get(w[:n], 0) + 1
        #: word ends and beginnings that at least three known words share
        self.ends = {e for e, n in ends.items() if n >= 3}
        self.starts = {s for s, n in starts.items() if n >= 3}

    def strength(self, word: str) -> int:
        """2 known, 1 made like known ones, 0 neither."""
        w = _shape(word)
        if w in self.kind:
            return 2
        if w in COMMON or len(w) < 4:
            return 0
        for n in (6, 5, 4, 3):
            if len(w) > n and w[-n:] in self.ends and any(w[:k] in self.starts and k + n >= len(w) - 1 for k in (5, 4, 3, 2) if k < len(w)):
                return 1
        return 0


def _cues(text: str, a: int, b: int) -> list[str]:
    """What stands before and after a candidate: the last one and two words before, the first two after."""
    before = CUE_WORD.findall(text[max(0, a - 40) : a].rsplit("\n", 1)[-1].lower())
    after = CUE_WORD.findall(text[b : b + 30].split("\n", 1)[0].lower())
    norm = ["0" if w.isdigit() else w for w in before[-3:]]
    out = []
    if norm:
        out.append("<1 " + norm[-1])
    else:
        out.append("<1 ^")
    if len(norm) > 1:
        out.append("<2 " + " ".join(norm[-2:]))
    if len(norm) > 2:
        out.append("<3 " + " ".join(norm[-3:]))
    nxt = ["0" if w.isdigit() else w for w in after[:2]]
    if len(nxt) > 1:
        out.append(">2 " + " ".join(nxt))
    return out


def parts_of(kind: str, term: str) -> list[str]:
    """What a term consists of: words of a name, host of a mail address, last word of a postal one, form of an identity number."""
    if kind == "name":
        return ["=" + w for w in dict.fromkeys(_shape(x.group()) for x in NAME_PART.finditer(term.title() if term.islower() or term.isupper() else term) if len(x.group()) > 2 and not IS_HONORIFIC.fullmatch(x.group()))]
    if kind == "email":
        return ["=" + re.split(r"@|\sat\s|[(\[]at[)\]]", term.lower())[-1].strip()]
    if kind == "address":
        return ["=" + (re.findall(r"[^\W\d_]+", term.lower()) or [""])[-1]]
    if kind == "id_number":
        return ["=" + re.sub(r"[A-Za-z]", "a", re.sub(r"\d", "0", term))]
    return []  # phone numbers are seeds by their form, which so tells nothing more


#: Where a sentence, line or item begins, whose first word has a capital for that reason.
_OPENS = re.compile(r"(?:^|[.!?\n][\s\"'(*_#>-]*|[-*#>]\s)\Z")


def _name_spans(text: str, names: Names) -> Iterator[tuple[int, int, int, bool]]:
    """(start, end, strong words, well formed) of capitalised runs that may be names."""
    for m in NAME.finditer(text):
        words = [(x.start() + m.start(), x.end() + m.start(), x.group()) for x in NAME_PART.finditer(m.group())]
        # cut words of no name off both ends
        hon = [bool(IS_HONORIFIC.fullmatch(w)) for _, _, w in words]
        strong = [names.strength(w) if not h else 0 for (_, _, w), h in zip(words, hon)]
        initial = [len(w.strip(".")) == 1 for _, _, w in words]
        idx = [i for i, s in enumerate(strong) if s]
        if idx:
            lo, hi = idx[0], idx[-1]
            while lo > 0 and (hon[lo - 1] or initial[lo - 1]) and text[words[lo - 1][1] : words[lo][0]].strip() in ("", "."):
                lo -= 1
            while hi + 1 < len(words) and not hon[hi + 1] and _shape(words[hi + 1][2]) not in COMMON and text[words[hi][1] : words[hi + 1][0]] == " " and hi + 1 - lo < 4 and words[hi + 1][2][:1].isupper() and len(words[hi + 1][2]) > 2:
                hi += 1
            n = sum(1 for s in strong[lo : hi + 1] if s)
            formed = n >= 2 if text.isupper() else n >= 2 or (n == 1 and (any(hon[lo:hi]) or any(initial[lo : hi + 1]) or hi > lo))
            yield words[lo][0], words[hi][1], 2 * n + sum(s == 2 for s in strong[lo : hi + 1]), formed
        elif all(_shape(w) not in COMMON for _, _, w in words):
            if len(words) >= 2:
                yield words[0][0], words[-1][1], 0, any(hon)
            elif len(words[0][2]) >= 4 and words[0][2][1:].islower() and not _OPENS.search(text, max(0, words[0][0] - 4), words[0][0]):
                yield words[0][0], words[0][1], -1, False


_PHONE_FORM = re.compile(r"^(?:\+\d{1,3}[ .-]?(?:\(0?\d+\)[ .-]?)?\d[\d .()/-]{5,}\d|00\d{2}[ (]\(?\d[\d .()/-]{5,}\d|\(\d{3}\) ?\d{3}-\d{4}|0\d{4} \d{6}|0\d{2,4}/\d{4,}(?:-\d+)?)(?:\s?(?:ext\.?|x)\s?\d+)?$")
_PHONE_SHAPE = re.compile(r"^(?:\+?1[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[.-]\d{4}(?:\s?(?:ext\.?|x)\s?\d+)?$|^\+\d{8,15}$")


def candidates(text: str, names: Names) -> list[tuple[int, int, str, float, bool]]:
    """(start, end, kind, bits from the form alone, seed) of every term that may be protected; no two overlap."""
    out: list[tuple[int, int, str, float, bool]] = []
    taken: list[tuple[int, int]] = []

    def free(a: int, b: int) -> bool:
        return not any(a < y and x < b for x, y in taken)

    def add(a: int, b: int, kind: str, bits: float, seed: bool) -> None:
        if free(a, b):
            out.append((a, b, kind, bits, seed))
            taken.append((a, b))

    if "@" in text or " at " in text or "(at)" in text or "[at]" in text or " AT " in text:
        for m in EMAIL.finditer(text):
            sep = text[m.end(1) : m.start(2)]
            host = m.group(2)
            if "@" not in sep and ("dot" not in host.lower() and "." not in host or m.group(1).lower() in _AT_WORD or (sep.strip().lower() == "at" and "dot" not in host.lower())):
                continue
            box = m.group(1).lower()
            before, after = text[max(0, m.start() - 1) : m.start()], text[m.end() : m.end() + 1]
            if box in FUNCTION_BOX or box.split("+")[0].split(".")[0] in FUNCTION_BOX or (after == ":" and text[m.end() + 1 : m.end() + 2].isalnum()) or after == "/" or before in ("/", "@"):
                add(m.start(), m.end(), "email", NEVER, False)  # a function's mailbox or a remote: what stands around it speaks against
                continue
            parts = re.split(r"[._+-]|\d+", m.group(1).lower())
            add(m.start(), m.end(), "email", 4.0, any(names.strength(x) for x in parts))
    if any(map(str.isdigit, text)):
        for m in ADDRESS.finditer(text) if any(h in text for h in STREET_HINTS) or TOWN_HINT.search(text) else ():
            add(m.start(), m.end(), "address", 4.0, bool(TOWN_HINT.search(m.group())) or bool(POSTAL_END.search(m.group())))
        for m in CODE.finditer(text):
            add(m.start(), m.end(), "id_number", -1.0, bool(ID_WORD.search(text, max(0, m.start() - 40), m.start())))
        for m in NUMBER.finditer(text):
            g = m.group()
            n = sum(map(str.isdigit, g))
            if n < 7 or n > 17 or re.fullmatch(r"\d+(?:\.\d+){2,}", g) and not re.fullmatch(r"\d{3}\.\d{3}\.\d{4}", g) or not re.search(r"[ ().\-/+]", g) and not g.startswith(("+", "0")):
                continue
            if _PHONE_FORM.match(g):
                add(m.start(), m.end(), "phone", 3.0, True)
            elif _PHONE_SHAPE.match(g):
                add(m.start(), m.end(), "phone", 1.0, False)
            else:
                add(m.start(), m.end(), "phone", -2.0, False)
    if text.islower():
        # text without capitals: two known words one after the other
        for m in LETTERS.finditer(text):
            if names.strength(m.group(1)) and names.strength(m.group(2)) and names.strength(m.group(1)) + names.strength(m.group(2)) >= 3:
                add(m.start(), m.end(2), "name", 2.5, False)
    for a, b, strong, formed in _name_spans(text, names):
        bits = UNKNOWN_WORD if strong < 0 else -3.0 if not strong else (2.0 if formed else -0.5) + 0.5 * strong - 1.5
        add(a, b, "name", bits, strong >= 5 and formed)
    return sorted(out)


_SCHEMA = pa.schema([("kind", pa.int8()), ("id", pa.string()), ("field_name", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("pii_kind", pa.string()), ("term", pa.string()), ("bits", pa.float64()), ("cue", pa.string()), ("cues", pa.list_(pa.string())), ("parts", pa.list_(pa.string())), ("n", pa.int64()), ("seeds", pa.int64())])
_OUT = "kind byte, id string, field_name string, start int, stop int, pii_kind string, term string, bits double, cue string, cues array<string>, parts array<string>, n long, seeds long"


def _scanner(lexicon: list[tuple[str, str]]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """kind 0: a candidate; kind 1: how often a cue or part stands with candidates of a kind, and with seeds of it."""
        names = Names(lexicon)
        counts: dict[tuple[str, str], list[int]] = {}

        def told() -> pa.RecordBatch:
            n = len(counts)
            cols = {"kind": [1] * n, "pii_kind": [k for k, _ in counts], "cue": [c for _, c in counts], "n": [v[0] for v in counts.values()], "seeds": [v[1] for v in counts.values()]}
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)

        for b in batches:
            cols: dict[str, list] = {f.name: [] for f in _SCHEMA}
            for field in FIELDS:
                for i, text in zip(b.column("id").to_pylist(), b.column(field).to_pylist()):
                    if text is None or text.strip().lower() in ("", "nan"):
                        continue
                    for a, z, kind, bits, seed in candidates(text, names):
                        cues, parts = _cues(text, a, z), parts_of(kind, text[a:z])
                        # a word beside a known name word is seen with a protected term, though the run is none itself
                        beside = seed or (kind == "name" and bits >= 2.0 and len(parts) > 1)
                        for c in (*cues, *parts):
                            n = counts.setdefault((kind, c), [0, 0])
                            n[0] += 1
                            n[1] += beside
                        if bits > NEVER:
                            for k, v in zip(cols, (0, i, field, a, z, kind, text[a:z], bits, None, cues, parts, None, None)):
                                cols[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in _SCHEMA], schema=_SCHEMA)
            if len(counts) > HELD_CUES:
                yield told()
        if counts:
            yield told()

    return scan


def personal_items(vulns: DataFrame, lexicon: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(id, field_name, pii_kind, start, stop, term, bits) of every item that discloses a person.

    The lexicon is a parameter table of known name words. Null, blank and
    ``nan`` values hold nothing; a null id stays null; repeated rows give
    repeated items; an empty table or lexicon gives what shapes alone tell.
    """
    words = [(r["name_word"], r["name_kind"]) for r in lexicon.select("name_word", "name_kind").filter("name_word is not null").collect()]
    found = materialize(vulns.select(F.col("id").cast("string").alias("id"), *FIELDS).mapInArrow(_scanner(words), _OUT), "candidates")
    counts = found.filter("kind = 1").groupBy("pii_kind", "cue").agg(F.sum("n").alias("n"), F.sum("seeds").alias("seeds"))
    base = counts.filter(F.col("cue").startswith("<1")).groupBy("pii_kind").agg(F.sum("n").alias("all_n"), F.sum("seeds").alias("all_seeds"))  # one row per kind
    prior = (F.col("all_seeds") + 1) / (F.col("all_n") + 2)
    given = F.greatest((F.col("seeds") + 2 * prior) / (F.col("n") + 2), F.lit(1e-6))
    odds, lift = F.log2(given / F.greatest(1 - given, F.lit(1e-6))), F.log2(given / prior)
    weighed = counts.join(F.broadcast(base), "pii_kind").select(F.concat_ws(" ", "pii_kind", "cue").alias("key"), "cue", "n", F.when(F.col("cue").startswith("="), F.greatest(lift, F.when(odds > 0, odds)) * F.col("n") / (F.col("n") + SEEN)).otherwise(odds).alias("told"))
    rows = found.filter("kind = 0").withColumn("rid", F.monotonically_increasing_id())
    rows = materialize(rows.select("rid", "id", "field_name", "start", "stop", "pii_kind", "term", "bits", "cues", "parts"), "numbered")
    asked = rows.select("rid", F.explode(F.concat("cues", "parts")).alias("cue"), "pii_kind").select("rid", F.concat_ws(" ", "pii_kind", "cue").alias("key"))
    # a cue may stand with a third of all candidates
    met = join_by_group(asked, materialize(weighed.filter((F.col("n") >= SEEN) | F.col("cue").startswith("=")), "cues"), "key", "n")
    # the longest cue before and the one after that were seen often enough speak, and all parts
    side, length = F.substring("cue", 1, 1), F.substring("cue", 2, 1)
    spoken = met.groupBy("rid").agg(F.max(F.when(side == "<", F.struct(length.alias("l"), F.col("told").alias("o")))).alias("left"), F.max(F.when(side == ">", F.col("told"))).alias("right"), F.avg(F.when(side == "=", F.col("told"))).alias("own"))
    x = rows.join(spoken, "rid", "left")
    around = F.greatest(F.coalesce(F.col("left.o"), F.lit(-2.0)), F.coalesce(F.col("right"), F.lit(-4.0)))
    around = F.greatest(F.lit(-4.0), F.least(F.lit(6.0), around))
    own = F.greatest(F.lit(-PART_LOSS), F.least(F.lit(PART_GAIN), F.coalesce("own", F.lit(0.0))))
    x = x.withColumn("total", F.col("bits") + around + own)
    return x.filter(F.col("total") >= disclosure).select("id", "field_name", "pii_kind", "start", "stop", "term", F.col("total").alias("bits"))


def sanitised(vulns: DataFrame, lexicon: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(id, title, description): the fields of every row, items replaced by placeholders."""
    items = personal_items(vulns, lexicon, disclosure).groupBy("id").agg(F.collect_set(F.struct("field_name", "pii_kind", "start", "stop")).alias("items"))
    rows = vulns.select(F.col("id").cast("string").alias("id"), *FIELDS).join(items, "id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fields: dict[str, list] = {f: [] for f in FIELDS}
            for title, description, found in zip(*[b.column(c).to_pylist() for c in (*FIELDS, "items")]):
                for f, text in zip(FIELDS, (title, description)):
                    for x in sorted((x for x in found or [] if x["field_name"] == f), key=lambda x: -x["start"]) if text is not None else []:
                        text = text[: x["start"]] + PLACEHOLDER[x["pii_kind"]] + text[x["stop"] :]
                    fields[f].append(text)
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(fields[f], pa.string()) for f in FIELDS]], names=["id", *FIELDS])

    return rows.mapInArrow(run, "id string, title string, description string")
