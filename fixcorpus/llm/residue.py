"""Problem 5: fields that were never written, or hold an error, login, wait or scripts-required page.

Method: labelled exemplars of residue, and of real sentences about such things,
stand in an inverted index from their words. Passage windows of a field retrieve
the exemplars they share words with, and the share of a window's TF-IDF weight
that one exemplar covers decides: high coverage is residue, unless a real
exemplar speaks for the sentence. There are three kinds of windows, each with
its exemplars: sentences and lines (which an exemplar must cover nearly whole),
the nearest words around a slot or a word of filler text (residue may stand
inside a sentence that is otherwise real), and a field with headings as a whole
(a form of which nothing but its own headings, prompts and empty items is left).
An unfilled slot is the word SLOT, weighed like any other word. Inverse document
frequencies are counted over all windows of all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_by_group, materialize

FIELDS = ("title", "description")
#: Least share of a window's weight that one exemplar covers, and least share of the exemplar's weight.
WINDOW_COVER, EXEMPLAR_COVER = 0.74, 0.5
#: Share of the weight of the words around a slot or filler word that an inline exemplar covers, and words to each side.
INLINE_COVER, AROUND = 0.4, 1
#: Share of an inline exemplar's weight that stands there.
INLINE_EXEMPLAR = 0.55
#: Distinct words a task counts before it hands its counts on.
HELD_WORDS = 500_000
#: Share of a form's weight that headings, prompts and empty items cover.
FORM_COVER = 0.9
#: Share of words (not weighed) that a window must share with the exemplars to be weighed at all.
RETRIEVE = 0.55
#: Share of a real exemplar's weight in a sentence from which the sentence counts as real.
REAL_COVER = 0.6

#: Labelled exemplars (fixed values). SLOT stands for an unfilled placeholder, 0 for numbers.
RESIDUE = """
your text here
your description here
enter your description here
enter text here
write your description here
insert description here
issue title goes here
title goes here
description goes here
enter a title
untitled
no title
no description provided
no description given
no description
no details provided
description not provided
new pull request
new issue
test title please ignore
test description please ignore
please ignore
asdf
asdf asdf
test
test test
test test test
testing
qwerty
xxx
foo bar baz
foo bar
tbd
tba
todo
todo title
todo write description
todo add description
todo describe
fixme
description to be added
to be written
to be filled in
placeholder text
placeholder title
placeholder
sample description replace me
sample title
replace this text
replace me
text goes here
please include a summary of the change
please include a summary of the changes and the related issue
please describe your changes
please provide a description
describe your change
describe your changes in detail
describe the bug
a clear and concise description of what the bug is
a clear and concise description of what you expected to happen
what and why
what does this change do
steps to reproduce the behavior
add any other context about the problem here
if applicable add screenshots to help explain your problem
list the steps
explain what this fixes
provide a general summary of the issue in the title above
lorem ipsum dolor sit amet consectetur adipiscing elit
sed do eiusmod tempor incididunt ut labore et dolore magna aliqua
page not found
0 not found
0 bad gateway
0 internal server error
0 service temporarily unavailable
0 service unavailable
0 too many requests
0 forbidden
0 unauthorized
0 gateway timeout
0 bad request
0 gone
not found
bad gateway
internal server error
service unavailable
forbidden
too many requests
error 0
error 0 not found
error 0 forbidden
error 0 bad gateway
error 0 internal server error
error 0 too many requests
error 0 service unavailable
error 0 gateway timeout
error 0 unauthorized
http error 0
request id 0
the page you requested could not be found 0
the page you are looking for does not exist
the requested url was not found on this server
this page could not be found
gateway timeout after 0 s
gateway time out
upstream connect error or disconnect before headers code 0
upstream request timeout
no healthy upstream
server error
message server error status 0 documentation_url URL
message bad credentials status 0 documentation_url URL
message not found status 0 documentation_url URL
message forbidden status 0 documentation_url URL
message internal server error status 0 documentation_url URL
message too many requests status 0 documentation_url URL
message api rate limit exceeded status 0 documentation_url URL
message bad gateway status 0 documentation_url URL
message service unavailable status 0 documentation_url URL
message unauthorized status 0 documentation_url URL
api rate limit exceeded
rate limit exceeded
try again in 0 minutes
try again later
please try again later
too many requests please slow down
oops something went wrong on our side
something went wrong
an unexpected error occurred
an error occurred while processing your request
this repository is temporarily unavailable
this page is temporarily unavailable
we are down for maintenance back in about 0 minutes
the site is down for maintenance
scheduled maintenance
access denied
access denied your address has been logged under 0
permission denied
you do not have permission to view this page
you are not authorized to view this page
attention required blocked ticket 0
blocked ticket 0
sign in
sign in to continue
please sign in
please sign in to view this page
log in to continue
please log in
you must be logged in to view this page
your session has expired log in again
session expired
login required
checking your browser before accessing the forge
checking your browser
ray 0
reference 0
just a moment
one moment while we verify that you are human
verify that you are human
please complete the captcha
please wait
please wait while we check your browser
redirecting
you are being redirected
loading
content is loading
loading please wait
please enable javascript
please enable cookies
please enable javascript and cookies to continue
please turn javascript on and reload the page
enable javascript to continue
javascript is required
javascript is required to view this page
javascript is disabled
this site requires javascript
this page requires javascript
this page needs scripts
this page needs javascript to run
enable scripts in your browser settings to continue
you need to enable javascript to run this app
your browser does not run scripts so this thread cannot be shown
your browser does not support javascript
scripts are blocked
scripts are disabled
activate them to view this issue
cookies and scripts must be allowed to read this report
habilite javascript para continuar
active javascript para continuar
activez javascript pour continuer
veuillez activer javascript
veuillez activer javascript pour continuer
javascript est désactivé
javascript ist deaktiviert
bitte aktivieren sie skripte
bitte aktivieren sie javascript
bitte javascript einschalten
abilita javascript per continuare
włącz javascript aby kontynuować
включите javascript
ative o javascript para continuar
""".strip().split("\n")

#: Exemplars of what may stand inside a real sentence: slots as forms and generators leave them, filler text.
INLINE = """
SLOT
in SLOT the SLOT
a vulnerability in SLOT allows SLOT
a flaw in SLOT before SLOT
upgrade SLOT to SLOT
update SLOT to use SLOT
see SLOT for details
fix SLOT in SLOT
fixes SLOT and SLOT
closes SLOT
add SLOT to SLOT
remove SLOT from SLOT
call SLOT with SLOT
run SLOT for SLOT minutes
trigger SLOT 0 times
SLOT fails when SLOT
SLOT returns SLOT
SLOT is affected by SLOT
allows SLOT to SLOT via SLOT
reported by SLOT on SLOT
before SLOT a SLOT could SLOT
since SLOT NAME SLOT
hi SLOT thanks SLOT
dear SLOT
lorem ipsum
lorem ipsum dolor sit amet
dolor sit amet consectetur
""".strip().split("\n")

#: Headings, prompts and empty items that forms are made of.
FORM = """
summary description details overview motivation context background what why how
test plan tests testing how has this been tested docs documentation changelog checklist
steps to reproduce reproduction expected actual behavior behaviour result results
environment version versions platform browser os screenshots logs additional information
related issue issues type of change bug fix feature breaking change notes impact severity
0 label bug none n a yes no todo tbd
please include a summary of the change describe your changes here what does this do
""".split()

#: Real sentences about pages, placeholders and filler, by what is typical of them (general knowledge, no sentence of any table).
REAL = """
escape SLOT
escapes SLOT before rendering
placeholders such as SLOT
the placeholder SLOT is replaced
the template variable SLOT is not escaped
substitute SLOT with the value
the literal text SLOT is shown
interpolate SLOT into the query
unescaped SLOT leads to injection
the format string SLOT is parsed
names like SLOT in templates
""".strip().split("\n")

#: Words that slots are named with (fixed values).
SLOT_WORDS = frozenset(
    """title description summary body component components module module_name package pkg name function function_name func fn method class file filename file_name path
    version versions impact attacker vector actor issue issue_key key vuln vuln_type type advisory link url number n date author product project repo repository
    severity cve id user username email details detail steps text content placeholder value insert your here what does why how to from reason cause vulnerability affected fixed
    branch commit tag release ticket team owner app application service feature bug problem""".split()
)
SLOT = re.compile(
    r"\{\{[^{}\n]{0,60}\}\}|\$\{[^{}\n]{1,60}\}|<%=?[^%\n]{1,60}%>|__[A-Z][A-Z_]*__|%[A-Z][A-Z_]{2,}%|\{(?P<brace>[a-z_ ]{1,30}|\d)\}|\[(?P<square>[A-Z][A-Z_ ]{2,30})\]|(?<![\w@])<(?P<angle>[A-Za-z][A-Za-z_ /?-]{0,40})>|\$(?P<dollar>[A-Z][A-Z_]{2,30})\b|%[sd]\b"
)
HTML_TAGS = frozenset("html head title body h1 h2 h3 hr br p div span a b i em strong ul ol li table tr td th pre code img details summary noscript script style meta doctype center kbd sub sup".split())
#: A field that is nothing but the name of a field in angle brackets.
WHOLE_SLOT = re.compile(r"^\s*<(?:title|body|summary|details?|description|text|name|subject)>\s*$", re.I)
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?/?>|<!DOCTYPE[^>]*>", re.I)
URL = re.compile(r"https?://[^\s\"'<>)]+")
FENCE = re.compile(r"```.*?(?:```|\Z)", re.S)
HEADING = re.compile(r"^\s{0,3}(?:#{1,6}\s+\S.*|\*\*[^*]+\*\*:?)\s*$")
SENTENCE = re.compile(r"(?<=[.!?])[\s\"')\]]+|\n+|(?<=\})\s+")
WORD = re.compile(r"§(?:slot|url|name)§|[^\W\d_][^\W_]*(?:[_'’][^\W_]+)*|\d[\w.]*")


def _slot(m: re.Match[str]) -> str:
    if m.group() in ("%s", "%d"):
        return " §slot§ "
    for g in ("brace", "square", "angle", "dollar"):
        inner = m.group(g)
        if inner is None:
            continue
        words = [w for w in re.split(r"[\s_/?.-]+", inner.lower()) if w]
        if g == "angle" and len(words) == 1 and words[0] in HTML_TAGS and inner.islower():
            return m.group()
        if g == "brace" and inner.isdigit():
            return " §slot§ "
        known = sum(w in SLOT_WORDS for w in words)
        return " §slot§ " if words and known >= 1 and 2 * known >= len(words) or inner.endswith("?") else m.group()
    return " §slot§ "


def tokens(window: str) -> list[str]:
    """Words of a window in lower case; numbers are 0, addresses URL, slots SLOT, code names NAME."""
    out = []
    for w in WORD.findall(window):
        if w == "§slot§":
            out.append("SLOT")
        elif w == "§url§":
            out.append("URL")
        elif w == "§name§":
            out.append("NAME")
        elif w[0].isdigit() or (len(w) >= 6 and re.fullmatch(r"[0-9a-f]+", w) and re.search(r"\d", w)):
            out.append("0")
        else:
            out.append(w.lower())
    return out


_CODE_NAME = re.compile(r"\b[\w.-]*[a-z][A-Z]\w*\b|(?<![\w<])[\w-]+(?:/[\w.-]+)+")


def windows(text: str) -> tuple[list[str], str]:
    """Sentences and lines of a field, and where it has headings the whole of it ('' else)."""
    if WHOLE_SLOT.match(text):
        return ["§slot§"], ""
    plain = COMMENT.sub("\n", text)
    body = FENCE.sub("\n", plain)
    form = ""
    if "#" in body or "**" in body:
        lines = body.split("\n")
        if any(HEADING.match(x) for x in lines):
            form = body
            body = "\n".join(x for x in lines if not HEADING.match(x))
    elif not plain.strip() and text.strip():
        form = "none"  # nothing but a comment of the form
    body = TAG.sub(lambda m: "\n" if (m.group(1) or "html").lower() in HTML_TAGS else m.group(), SLOT.sub(_slot, body)) if "<" in body or "{" in body or "[" in body or "%" in body or "$" in body or "__" in body else body
    body = _CODE_NAME.sub(" §name§ ", URL.sub(" §url§ ", body))
    return [w for w in SENTENCE.split(body) if w and w.strip()], form


def _parse(exemplar: str) -> list[str]:
    return ["0" if w == "0" else w if w in ("SLOT", "URL", "NAME") else w.lower() for w in exemplar.split()]


#: Words that tell nothing of what a sentence is about (fixed values).
_FUNCTION_WORDS = frozenset("SLOT NAME URL 0 a an the in on of to by is are was were and or for from with at it as that so no not now when after before".split())
_RESIDUE = [Counter(_parse(x)) for x in RESIDUE]
_INLINE = [Counter(_parse(x)) for x in INLINE]
_REAL = [Counter(_parse(x)) for x in REAL]
_FORM = frozenset(_parse(" ".join(FORM)))
_VOCABULARY = frozenset(t for c in (*_RESIDUE, *_INLINE, *_REAL) for t in c) | _FORM
#: Words around which an inline window is taken: those of the inline exemplars that tell something, and SLOT.
_ANCHORS = frozenset({"SLOT", "lorem", "ipsum", "consectetur", "adipiscing"})
#: Inverted index: word -> residue exemplars with it.
_INDEX: dict[str, list[int]] = {}
for _i, _c in enumerate(_RESIDUE):
    for _t in _c:
        _INDEX.setdefault(_t, []).append(_i)


def retrieve(words: list[str]) -> list[int]:
    """Residue exemplars that share enough words with a window to be weighed."""
    hits: Counter[int] = Counter()
    for t in set(words):
        for i in _INDEX.get(t, ()):
            hits[i] += 1
    n = len(set(words))
    return [i for i, h in hits.items() if h >= RETRIEVE * n]


SENTENCE_WINDOW, INLINE_WINDOW, FORM_WINDOW = 0, 1, 2
_SCHEMA = pa.schema([("kind", pa.int8()), ("id", pa.string()), ("field_name", pa.string()), ("window_kind", pa.int8()), ("words", pa.list_(pa.string())), ("sentence", pa.list_(pa.string())), ("word", pa.string()), ("n", pa.int64())])
_OUT = "kind byte, id string, field_name string, window_kind byte, words array<string>, sentence array<string>, word string, n long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: a window to weigh; kind 1: windows with a word ('' counts all windows)."""
    df: Counter[str] = Counter()

    def counts() -> pa.RecordBatch:
        n = len(df)
        cols = {"kind": [1] * n, "word": list(df), "n": list(df.values())}
        df.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)

    for b in batches:
        cols: dict[str, list] = {f.name: [] for f in _SCHEMA}

        def put(i: str, field: str, kind: int, words: list[str], sentence: list[str] | None) -> None:
            for c, v in zip(cols, (0, i, field, kind, words, sentence, None, None)):
                cols[c].append(v)

        for field in FIELDS:
            for i, text in zip(b.column("id").to_pylist(), b.column(field).to_pylist()):
                if text is None or text.strip().lower() in ("", "nan"):
                    continue
                parts, form = windows(text)
                if form:
                    words = tokens(_CODE_NAME.sub(" §name§ ", URL.sub(" §url§ ", form)))
                    if sum(t in _FORM for t in words) >= RETRIEVE * len(words):
                        put(i, field, FORM_WINDOW, words, None)
                for part in parts:
                    words = tokens(part)
                    if not words:
                        continue
                    distinct = set(words)
                    df[""] += 1
                    df.update(distinct)
                    known = distinct & _VOCABULARY
                    if len(known) >= RETRIEVE * len(distinct) and retrieve(words):
                        put(i, field, SENTENCE_WINDOW, words, None)
                    if not _ANCHORS.isdisjoint(known):
                        for at, t in enumerate(words):
                            if t in _ANCHORS:
                                put(i, field, INLINE_WINDOW, words[max(0, at - AROUND) : at + AROUND + 1], words)
        yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in _SCHEMA], schema=_SCHEMA)
        if len(df) > HELD_WORDS:
            yield counts()
    if df:
        yield counts()


class Weigher:
    """Judges windows by the weights of their words."""

    def __init__(self, df: dict[str, int]):
        self.n = max(1, df.get("", 1))
        self.idf = {t: self.rarity(df.get(t, 0)) for t in _VOCABULARY}
        self.residue = [(c, self._weight(c)) for c in _RESIDUE]
        self.inline = [(c, self._weight(c)) for c in _INLINE]
        self.real = [(c, self._weight(c)) for c in _REAL]

    def rarity(self, seen: int) -> float:
        return math.log((1 + self.n) / (1 + seen)) + 0.1

    def _weight(self, c: Counter[str]) -> float:
        return sum(self.idf[t] * k for t, k in c.items())

    def _shared(self, a: Counter[str], b: Counter[str]) -> float:
        return sum(self.idf[t] * min(k, b[t]) for t, k in a.items() if t in b)

    def speaks_of(self, words: list[str]) -> bool:
        """Whether a real exemplar covers what a sentence says of such things."""
        c = Counter(words)
        return any((set(x) & set(c)) - _FUNCTION_WORDS and self._shared(x, c) >= REAL_COVER * w for x, w in self.real)

    def covered(self, kind: int, words: list[str], sentence: list[str] | None = None, others: dict[str, int] | None = None) -> tuple[float, str]:
        """Share of a window that the best exemplar of its kind covers, as a part of what the kind asks for (1 and more is residue), and the exemplar.

        ``others`` has the number of windows with each word that no exemplar has.
        """
        c = Counter(words)
        others = others or {}
        total = sum((self.idf[t] if t in self.idf else self.rarity(others.get(t, 0))) * k for t, k in c.items()) or 1.0
        if kind == FORM_WINDOW:
            return sum(self.idf[t] * k for t, k in c.items() if t in _FORM) / total / FORM_COVER, "form"
        inline = kind == INLINE_WINDOW
        if inline and self.speaks_of(sentence or words):
            return 0.0, ""
        best, name = 0.0, ""
        for i in range(len(_INLINE)) if inline else retrieve(words):
            x, w = self.inline[i] if inline else self.residue[i]
            s = sum(self.idf[t] * k for t, k in c.items() if t in x) / total / (INLINE_COVER if inline else WINDOW_COVER)
            if s > best and self._shared(x, c) >= (INLINE_EXEMPLAR if inline else EXEMPLAR_COVER) * w:
                best, name = s, (INLINE if inline else RESIDUE)[i]
        return best, name

    def is_residue(self, text: str) -> bool:
        """Whether any window of a text is residue."""
        parts, form = windows(text)
        found = [(FORM_WINDOW, tokens(form), None)] if form else []
        for words in map(tokens, parts):
            found += [(SENTENCE_WINDOW, words, None)] if words else []
            found += [(INLINE_WINDOW, words[max(0, i - AROUND) : i + AROUND + 1], words) for i, t in enumerate(words) if t in _ANCHORS]
        return any(self.covered(*x)[0] >= 1 for x in found)


def residue_fields(vulns: DataFrame) -> DataFrame:
    """(id, field_name, window, exemplar, cover) of every window that is residue; cover is 1 where it just suffices.

    Null, blank and ``nan`` values are no case; comments and fenced code are no
    text; a null id stays null; repeated rows give repeated windows; an empty
    table gives an empty result.
    """
    found = materialize(vulns.select(F.col("id").cast("string").alias("id"), *FIELDS).mapInArrow(_scan, _OUT), "windows")
    counts = materialize(found.filter("kind = 1").groupBy("word").agg(F.sum("n").alias("n")), "words")
    # at most the words of the exemplars
    df = {r["word"]: r["n"] for r in counts.filter(F.col("word").isin("", *sorted(_VOCABULARY))).collect()}
    asked = materialize(found.filter("kind = 0").withColumn("rid", F.monotonically_increasing_id()), "asked")
    # counts of the other words, joined by word; a word may stand in a third of all windows
    each = asked.select("rid", F.explode(F.array_except("words", F.array(*[F.lit(t) for t in sorted(_VOCABULARY)]))).alias("word"))
    rows = each.groupBy("word").agg(F.count("*").alias("rows")).join(counts, "word")
    known = join_by_group(each, materialize(rows, "asked-words"), "word", "rows").groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("others"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = Weigher(df)
        for b in batches:
            out: dict[str, list] = {"id": [], "field_name": [], "window": [], "exemplar": [], "cover": []}
            for i, field, kind, words, sentence, others in zip(*[b.column(c).to_pylist() for c in ("id", "field_name", "window_kind", "words", "sentence", "others")]):
                cover, name = weigher.covered(kind, words, sentence, dict(others or ()))
                if cover >= 1:
                    for k, v in zip(out, (i, field, " ".join(words), name, cover)):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays([*[pa.array(out[k], pa.string()) for k in ("id", "field_name", "window", "exemplar")], pa.array(out["cover"], pa.float64())], names=list(out))

    return asked.join(known, "rid", "left").mapInArrow(run, "id string, field_name string, window string, exemplar string, cover double")


def without_residue(vulns: DataFrame) -> DataFrame:
    """(id, title, description): the fields of every row, null where residue is left out."""
    bad = residue_fields(vulns).groupBy("id").agg(*[F.max((F.col("field_name") == f).cast("int")).alias(f"_{f}") for f in FIELDS])
    x = vulns.select(F.col("id").cast("string").alias("id"), *FIELDS).join(bad, "id", "left")
    return x.select("id", *[F.when(F.coalesce(F.col(f"_{f}"), F.lit(0)) == 0, F.col(f)).alias(f) for f in FIELDS])
