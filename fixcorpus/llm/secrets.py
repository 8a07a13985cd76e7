"""Problem 1: working credentials in source code.

Method: logistic regression on character Markov likelihood, surrounding
identifiers and path features, trained on weakly labelled pattern matches;
values with a high calibrated score are masked.

One pass over the code emits every value-like piece (quoted texts, assigned
values, element texts, user:password pairs, long tokens, key blocks, byte lists,
word runs) with what stands around it, and the character transitions of the code
itself, which are counted over all rows. Pieces that a pattern knows as secret
or as harmless get weak labels, together with the name of the pattern. The
patterns are no features: the regression sees how likely a value's characters
follow one another, which kinds of characters it has, the words in it, the
identifiers before it and its path. It is fitted on at most ``SAMPLE`` labelled
pieces per label and kind (smallest hash first) and on ``seed_pieces``,
calibrated on the pieces held out, and scores all pieces, labelled or not.
``hidden_patterns`` measures how it does on patterns it was not shown.

Masking goes by position: the places of the pieces found are carried from the
decoded code to the stored text, so that quotes, escapes, the JSON and names
that happen to contain a value stay as they were.
"""

from __future__ import annotations

import binascii
import json
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import materialize

FIELDS = ("pre_fix_code", "post_fix_code")
#: Labelled pieces per label and kind of piece that the regression is fitted on.
SAMPLE = 2000
THRESHOLD = 0.5
MASK = "XXXXXXX"
#: Hashed features, and how many one piece may have.
HASHED, FEATURES = 4096, 48
#: Characters before a value in which its surrounding identifiers are looked for.
CONTEXT = 80
ALPHABET = 96  # printable ASCII and one for the rest

#: Names under which secrets stand, and names that make the same words harmless (fixed values).
SECRET_NAME = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|pw|secret|api[_-]?key|access[_-]?key|private[_-]?key|signing[_-]?key|hmac[_-]?key|auth(?:orization|[_-]?token)?|token|credential|mnemonic|seed(?:[_-]?phrase)?|recovery[_-]?phrase|bearer|client[_-]?secret|wif|xprv|priv|maps[_-]?key|pay[_-]?key|signer[_-]?(?:pem|key))$", re.I
)
KEY_NAME = re.compile(r"(?i)(?<!public)(?<!pub)(?<!public[_-])(?<!pub[_-])(?:key|pk|sk)$")
RAW_KEY = re.compile(r"^(?:0x)?[0-9a-fA-F]{64}$")
HARMLESS_NAME = re.compile(r"(?:hint|ref|file|path|name|url|uri|label|address|commit|sha\d*|hash|digest|integrity|checksum|version|id|uuid|ttl|length|size|count|type|kind|region|title|issue|public[_-]?key|pub|xpub|account|placeholder|example)$", re.I)
STAND_IN = re.compile(r"(?i)^(?:(?:process\.)?env\.\w+|[a-z_]\w*(?:\.[a-z_]\w*)+|x{4,}|\*{3,}|\.{3,}|<[^>]*>|\$\{[^}]*\}|\$[A-Z_]+|\{\{.*\}\}|%\w+%|(?:your|my|insert|enter|replace|example|sample|dummy|test|fake|todo|redacted|changeme|change[_-]me|none|null|undefined|true|false|placeholder)[\w -]*|REDACTED|\[[^\]]*\]|0+|1234\d*|abc\w{0,3})$")
PREFIXES = re.compile(
    r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_\w{20,}|xox[abprs]-[\w-]{10,}|SG\.[\w-]{16,}\.[\w-]{16,}|(?:sk|rk|pk)_(?:live|test)_[A-Za-z0-9]{10,}|sk-[A-Za-z0-9-]{16,}|npm_[A-Za-z0-9]{20,}|AIza[\w-]{30,}|glpat-[\w-]{16,}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,}|[xyztuv]prv[1-9A-HJ-NP-Za-km-z]{60,}|[5KLc9][1-9A-HJ-NP-Za-km-z]{50,51}|hf_[A-Za-z0-9]{20,}|dop_v1_[0-9a-f]{40,}|ya29\.[\w-]{20,})$"
)
PUBLIC_VALUE = re.compile(r"^(?:[xyztuv]pub[1-9A-HJ-NP-Za-km-z]{40,}|sha\d{3}-[A-Za-z0-9+/=]+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|0x[0-9a-fA-F]{40}|v?\d+(?:\.\d+)+[\w.-]*|https?://[^\s:@]+(?::\d+)?(?:/[^\s@?]*)?|\d+)$")

_PEM = r"-----BEGIN (?P<pem>[A-Z ]*)-----(?P<pembody>.*?)(?:-----END [A-Z ]*-----|\Z)"
#: Where values stand. Groups: v*, the value; n*, the name before it.
PIECE = re.compile(
    _PEM
    + r"|(?P<words>\b[a-z]{3,8}+(?:[ \t]++[a-z]{3,8}+){11,24}+\b)"
    + r"|(?P<bytes>\[\s*(?:0x[0-9a-fA-F]{1,2}|\d{1,3})(?:\s*,\s*(?:0x[0-9a-fA-F]{1,2}|\d{1,3})){15,}\s*,?\s*\])"
    + r"|://[^\s:/@\"']*:(?P<vurl>[^\s/@\"']{3,})@"
    + r"|\s-u\s+[\w.-]+:(?P<vu>\S{3,})"
    + r"|(?i:basic|bearer)\s+(?P<vauth>[A-Za-z0-9+/=_.~-]{8,})"
    + r"|(?<![A-Za-z])(?P<ncomment>(?i:password|passwd|pwd|pw|passphrase|login is [\w.-]+ /|secret|pin))(?:\s+is|:|\s*=)?\s+(?P<vcomment>[^\s\"'=:;,(){}]{6,})(?=\s|$)"
    + r"|(?P<nparam>\b(?i:password|passwd|pwd|token|api_?key|access_token|secret|key|sig|auth))=(?P<vparam>[^\s\"'&;,)<>]{4,})"
    + r"|<(?P<nxml>[A-Za-z][\w.-]*)>(?P<vxml>[^<>\s]{4,})</"
    + r"|(?P<q>[\"'`])(?P<vq>(?:(?!(?P=q))[^\\\n]|\\.){4,}?)(?P=q)"
    + r"|(?<![\w.-])(?P<nbare>[\w.-]++)[ \t]*+(?::=|=>|[:=])[ \t]*(?P<vbare>[^\s\"'`,;(){}\[\]]{4,})"
    + r"|(?P<vlong>(?<![\w/+=.-])[A-Za-z0-9+/_=~.-]{20,}(?![\w/+=-]))",
    re.S,
)
#: What may stand inside a quoted text.
INNER = re.compile(_PEM + r"|(?P<words>\b[a-z]{3,8}(?:[ \t]+[a-z]{3,8}){11,24}\b)|://[^\s:/@\"']*:(?P<vurl>[^\s/@\"']{3,})@|(?i:basic|bearer)\s+(?P<vauth>[A-Za-z0-9+/=_.~-]{8,})|(?P<nparam>\b(?i:password|passwd|pwd|token|api_?key|access_token|secret|key|sig|auth))=(?P<vparam>[^\s\"'&;,)<>]{4,})", re.S)
WORDS = re.compile(r"[a-z]{3,8}(?:[ \t]+[a-z]{3,8}){11,24}\b")
JOINED = re.compile(r"([\"'])([^\"'\n]+)\1(?:\s*\+\s*\n?\s*([\"'])([^\"'\n]+)\3)+")
QUOTED = re.compile(r"[\"']([^\"'\n]*)[\"']")
WRAPPER = re.compile(r"(?:\[\]byte\(|(\w+)\(|\{)\s*$")
ASSIGNED = re.compile(r"([A-Za-z_][\w.-]*)[\"'\]]*\s*(?::\s*[\w\[\]; <>&]+?\s*)?(?::=|=>|=|:)\s*$")
LAST_NAME = re.compile(r"([A-Za-z_][\w.-]*)\s*$")
PAIR_KEY = re.compile(r"[\"']([A-Za-z_][\w.-]*)[\"']\s*,\s*[\"'`]$")
ATTRIBUTE_KEY = re.compile(r"key=[\"']([\w.-]+)[\"']\s+value=[\"']$")
IDENTIFIER = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")
ENTRY = re.compile(r'"file"\s*:\s*"((?:[^"\\]|\\.)*)"')
CODE = re.compile(r'"code"\s*:\s*"((?:[^"\\]|\\.)*)')


def entries(value: str) -> list[tuple[str | None, str]]:
    """(file, code) of every entry of a code field; a broken document gives what can be read, plain text one entry without a file."""
    s = value.strip()
    if s[:1] in "[{":
        try:
            doc = json.loads(s)
            out = []
            for e in doc if isinstance(doc, list) else [doc]:
                if isinstance(e, dict):
                    codes = [h["code"] for h in e.get("hunks") or [] if isinstance(h, dict) and isinstance(h.get("code"), str)]
                    out.append((e.get("file") if isinstance(e.get("file"), str) else None, "\n".join(codes)))
            return out
        except ValueError:
            marks = [(m.start(), m.group(1)) for m in ENTRY.finditer(s)]
            out = []
            for k, (at, f) in enumerate(marks):
                until = marks[k + 1][0] if k + 1 < len(marks) else len(s)
                codes = [_unescape(m.group(1)) for m in CODE.finditer(s, at, until)]
                out.append((_unescape(f), "\n".join(codes)))
            return out
    return [(None, value)] if s and s.lower() != "nan" else []


def _unescape(s: str) -> str:
    try:
        return json.loads(f'"{s}"')
    except ValueError:
        return s.replace("\\n", "\n").replace("\\t", "\t").replace('\\"', '"').rstrip("\\")


def _name(code: str, at: int) -> str:
    """The name that a value at this place is given to."""
    before = code[max(0, at - CONTEXT) : at]
    line = before.rsplit("\n", 1)[-1]
    if not line.strip(" \t\"'`") and (above := before[: len(before) - len(line)].rstrip())[-1:] in ("=", ":", "("):
        # an assignment left open on the line above
        line = above.rsplit("\n", 1)[-1] + line
    if m := PAIR_KEY.search(line):
        return m.group(1)
    if m := ATTRIBUTE_KEY.search(line):
        return m.group(1)
    line = line.rstrip(" \t\"'`")
    call = WRAPPER.search(line)
    if m := ASSIGNED.search(line[: call.start()] if call else line):
        return m.group(1)
    if call and call.group(1):
        return call.group(1)
    m = LAST_NAME.search(line)
    return m.group(1) if m else ""


_HAS_DIGIT = re.compile(r"\d")
_SECRET_WORD = re.compile(r"(?i)pass(?:word|wd|phrase|code)?$|pwd$|pw$|secret$|token$|key$|pem$|authorization$|credentials?$|mnemonic$|seed$|phrase$|wif$|priv$|auth$|cred$|pk$|sk$|login$|pin$")


@lru_cache(maxsize=100_000)
def _may_name(name: str) -> bool:
    return bool(_SECRET_WORD.search(name.rstrip("0123456789_-.")))


def worth(piece: str, name: str, value: str) -> bool:
    """Whether a loose value is scored: all values under a name that secrets have, of others the long ones that are not of letters only."""
    if piece not in ("quoted", "vbare", "vlong", "vxml"):
        return True
    if _may_name(name):
        return True
    return len(value) >= 12 and bool(_HAS_DIGIT.search(value)) and " " not in value and not _DULL.match(value) and not _CAMEL.match(value)


Span = tuple[int, int]
_NAMED_BY = {"vcomment": "ncomment", "vparam": "nparam", "vxml": "nxml"}
USER_URL = re.compile(r"\w+://[^\s:/@\"']*:(?P<v>[^\s/@\"']{3,})@")
QUERY = re.compile(r"[?&](?P<n>\w+)=(?P<v>[^\s&\"']{4,})")


def _key_body(text: str) -> str:
    return re.sub(r"\\n|\s", "", text)


def pieces(code: str) -> Iterator[tuple[str, str, str, str, list[Span]]]:
    """(kind, name, value, text before, places) of every value-like piece of a code."""
    if '" +' in code or "' +" in code:
        for m in JOINED.finditer(code):
            parts = list(QUOTED.finditer(code, m.start(), m.end()))
            yield "joined", _name(code, m.start() + 1), "".join(x.group(1) for x in parts), code[max(0, m.start() - CONTEXT) : m.start()], [x.span(1) for x in parts]
    at, end = 0, len(code)
    while m := PIECE.search(code, at, end):
        k = m.lastgroup or ""  # the group of the value, which is the last one of each alternative
        value, start = m.group(k), m.start(k)
        at = m.end()
        before = code[max(0, m.start() - CONTEXT) : m.start()]
        if k == "pembody":
            yield "pem", m.group("pem"), _key_body(value), before, [m.span(k)]
        elif k in ("words", "bytes"):
            yield k, _name(code, m.start()), value, before, [m.span(k)]
        elif k == "vq":
            inner = False
            for x in INNER.finditer(value) if len(value) > 8 else ():
                inner = True
                j = x.lastgroup or ""
                a, z = x.span(j)
                if j == "pembody":
                    yield "pem", x.group("pem"), _key_body(x.group(j)), before, [(start + a, start + z)]
                else:
                    yield j, x.group("nparam") or _name(code, start), x.group(j), before, [(start + a, start + z)]
            if not inner:
                yield "quoted", _name(code, start), value, before, [m.span(k)]
        elif k != "vbare":
            named = _NAMED_BY.get(k)
            yield k, m.group(named) if named else _name(code, start), value, before, [m.span(k)]
        elif run := WORDS.match(code, start):
            at = run.end()
            yield "words", m.group("nbare"), run.group(), before, [run.span()]
        elif code[m.end() : m.end() + 1] in ("(", "["):
            pass  # a call or an element, read elsewhere at run time
        elif "://" in value or m.group("nbare").lower() in ("http", "https"):
            # a URL: look into it
            if u := USER_URL.match(code, start):
                yield "vurl", m.group("nbare"), u.group("v"), before, [u.span("v")]
                at = u.end()
            elif u := QUERY.search(value):
                yield "vparam", u.group("n"), u.group("v"), before, [(start + u.start("v"), start + u.end("v"))]
        else:
            yield k, m.group("nbare"), value, before, [m.span(k)]


def _entropy(s: str) -> float:
    n = len(s)
    counts: dict[str, int] = {}
    for c in s:
        counts[c] = counts.get(c, 0) + 1
    return -sum(c / n * math.log2(c / n) for c in counts.values()) if n else 0.0


_SYMBOL = re.compile(r"[^\w\s]")
_CAMEL = re.compile(r"^[a-z]+(?:[A-Z][a-z]+)+(?:V\d)?$")


def weak_label(kind: str, name: str, value: str, before: str) -> tuple[int | None, str]:
    """(1 secret, 0 harmless by a known pattern or None unknown, the pattern)."""
    v = value.strip()
    if kind == "pem":
        return int("PRIVATE" in name and len(v) >= 32), "key block"
    if kind == "words":
        words = v.split()
        near = (before[-60:] + " " + name).lower()
        return int(len(words) in (12, 15, 18, 21, 24) and bool(re.search(r"seed|mnemonic|phrase|recovery|words", near))), "word run"
    if kind == "bytes":
        return int(bool(re.search(r"(?i)seed|key|secret|priv", name)) and not re.search(r"(?i)pub|hash|digest", name)), "byte list"
    if PREFIXES.match(v):
        return 1, "provider's form"
    if STAND_IN.match(v):
        return 0, "stand-in"
    if PUBLIC_VALUE.match(v):
        return 0, "public value"
    if _CAMEL.match(v) or " " in v:
        return 0, "words"
    tail = re.sub(r"[\d_.-]+$", "", name)
    secret, harmless = kind in ("vcomment", "vparam") or bool(SECRET_NAME.search(tail)), bool(HARMLESS_NAME.search(tail))
    if kind in ("vurl", "vu"):
        return (0 if re.match(r"^\d+$", v) or v.startswith(("$", "{")) else 1), "password in an address"
    if kind == "vauth":
        return int(len(v) >= 12), "header"
    if secret and not harmless:
        if re.search(r"[\[(/]|^\w+$", v) and not re.search(r"\d", v) and kind == "vbare":
            return 0, "expression"
        mixed = sum(bool(re.search(p, v)) for p in (r"[a-z]", r"[A-Z]", r"\d", r"[^\w]"))
        if len(v) >= 8 and mixed >= 2 and (_entropy(v) > 2.7):
            return 1, "mixed under a secret name"
        return (0 if mixed < 2 else None), "plain under a secret name"
    if RAW_KEY.match(v):
        return int(secret or bool(KEY_NAME.search(tail))), "64 hex digits"
    if harmless:
        return 0, "harmless name"
    if re.fullmatch(r"[a-z][\w./-]*", v) and not re.search(r"\d{2}", v):
        return 0, "lower-case name"
    return None, ""


def _transition_index(s: str) -> np.ndarray:
    b = np.frombuffer(s.encode("latin-1", "replace"), np.uint8).astype(np.int64) - 32
    b = np.where((b < 0) | (b >= ALPHABET - 1), ALPHABET - 1, b)
    return b[:-1] * ALPHABET + b[1:]


def context_words(name: str, before: str) -> list[str]:
    line = before.rsplit("\n", 1)[-1]
    named = [w.lower() for w in IDENTIFIER.findall(name)]
    return named + ["last:" + w for w in named[-1:]] + ["pair:" + "_".join(named[-2:])] + ["~" + w.lower() for w in IDENTIFIER.findall(line)[-4:]]


def features(kind: str, name: str, value: str, before: str, path: str, log_p: np.ndarray) -> tuple[list[float], list[str]]:
    """Dense features of the characters, and words: identifiers around, words and form of the value, path, kind."""
    v = value.strip()
    n = max(1, len(v))
    t = _transition_index(v) if len(v) > 1 else np.zeros(0, np.int64)
    like = float(log_p[t].mean()) if len(t) else -4.0
    low = float(np.sort(log_p[t])[len(t) // 5]) if len(t) else -6.0
    digits, upper, lower = sum(c.isdigit() for c in v) / n, sum(c.isupper() for c in v) / n, sum(c.islower() for c in v) / n
    symbol = len(_SYMBOL.findall(v)) / n
    runs = sum(1 for a, b in zip(v, v[1:]) if (a.isdigit() != b.isdigit()) or (a.isupper() != b.isupper())) / n
    distinct = len(set(v)) / n
    classes = (digits > 0) + (upper > 0) + (lower > 0) + (symbol > 0)
    dense = [like, low, math.log(n), math.log(n) ** 2, _entropy(v) / 4, digits, upper, lower, symbol, runs, distinct, v.count(" ") / n, like * math.log(n), float(classes), float(classes >= 2) * math.log(n)]
    form = re.sub(r"(.)\1+", r"\1", re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", v[:64]))))
    inside = [w.lower() for w in IDENTIFIER.findall(v)] if n <= 120 else []
    words = context_words(name, before)
    words += ["kind:" + kind, "ext:" + path.rsplit(".", 1)[-1].lower(), "dir:" + path.split("/", 1)[0].lower(), "in:" + v[:3], "in:" + v[:1], "end:" + v[-1:], "form:" + form[:6], "length:" + str(n) if n < 100 else "long", "classes:" + str(classes), "hex" if not re.search(r"[^0-9a-f]", v.lower().removeprefix("0x")) else "no hex"]
    words += ["w:" + w for w in inside if len(w) > 2]
    if kind == "words":
        words.append("run:" + str(len(v.split())))
    if kind == "pem":
        words += ["pem:" + w for w in name.split()]
    # names and forms count more for each other than alone
    last = next((w for w in words if w.startswith("last:")), "")
    words += [f"{last} {kind}", f"{last} {classes}"]
    return dense, words[:FEATURES]


def seed_pieces() -> tuple[list[tuple[str, str, str, str, str]], list[int]]:
    """Made-up labelled pieces of general knowledge, so that both labels are there on any table: (kind, name, value, before, path), labels."""
    rng = np.random.default_rng(11)
    chars = np.array(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"))
    signs = np.array(list("!$%&#*?-_."))
    word = np.array("river engine stone canvas lemon tower silver copper window garden".split())
    rows, y = [], []

    def put(label: int, kind: str, name: str, value: str, before: str, path: str = "src/app.py") -> None:
        rows.append((kind, name, value, before, path))
        y.append(label)

    for i in range(60):
        token = "".join(rng.choice(chars, 12 + i % 25))
        phrase = str(rng.choice(word)).capitalize() + str(rng.choice(signs)) + str(rng.choice(word)) + str(10 + i)
        name = ["password", "db_password", "apiKey", "API_TOKEN", "secret", "clientSecret", "auth_token", "passphrase"][i % 8]
        put(1, "quoted", name, token if i % 2 else phrase, f"{name} = ", ["src/app.py", "config/prod.yml", "lib/a.ts", ".env"][i % 4])
        put(1, "vbare", name, phrase if i % 2 else token, f"{name}=", ".env")
        stand = ["your-token-here", "changeme", "xxxxxxxxxxxx", "<YOUR_KEY>", "process.env.TOKEN", "${SECRET}", "example", "REDACTED", "config.apiKey", "none"][i % 10]
        put(0, "quoted" if i % 2 else "vbare", name, stand, f"{name} = ")
        harmless = ["commit", "version", "sha256", "label", "url", "file", "title", "address"][i % 8]
        plain = [token.lower(), f"{i}.{i + 1}.0", "".join(rng.choice(np.array(list("0123456789abcdef")), 40)), "readSessionKey", "https://host.example/a", f"src/{word[i % 10]}.ts", str(word[i % 10]), "0x" + "".join(rng.choice(np.array(list("0123456789abcdef")), 40))][i % 8]
        put(0, "quoted", harmless, plain, f"{harmless}: ")
    return rows, y


_OUT = "kind byte, id string, field_name string, file_path string, piece string, name string, value string, before string, label int, pattern string, k int, n long"
_SCHEMA = pa.schema([("kind", pa.int8()), ("id", pa.string()), ("field_name", pa.string()), ("file_path", pa.string()), ("piece", pa.string()), ("name", pa.string()), ("value", pa.string()), ("before", pa.string()), ("label", pa.int32()), ("pattern", pa.string()), ("k", pa.int32()), ("n", pa.int64())])

#: A piece worth scoring: not a plain number or short word.
_DULL = re.compile(r"^(?:[\d.,:%-]+|[A-Za-z]{1,7}|[\w./-]+\.(?:ts|js|py|rs|go|sol|c|kt|swift|json|md|tsx?))$")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: a piece; kind 1: how often character k / ALPHABET is followed by k % ALPHABET."""
    counts = np.zeros(ALPHABET * ALPHABET, np.int64)
    for b in batches:
        ids = b.column("id").to_pylist()
        cols: dict[str, list] = {f.name: [] for f in _SCHEMA}
        for field in FIELDS:
            for i, v in zip(ids, b.column(field).to_pylist()):
                if not v or v == "[]":
                    continue
                seen = set()
                for path, code in entries(v):
                    if len(code) > 1:
                        counts += np.bincount(_transition_index(code), minlength=len(counts))
                    for piece, name, value, before, _ in pieces(code):
                        if not worth(piece, name, value):
                            continue
                        key = (path, name, value)
                        if key in seen:
                            continue
                        seen.add(key)
                        for c, x in zip(cols, (0, i, field, path, piece, name, value, before, *weak_label(piece, name, value, before), None, None)):
                            cols[c].append(x)
        if cols["kind"]:
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in _SCHEMA], schema=_SCHEMA)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), np.int8)), *[pa.nulls(len(at), f.type) for f in list(_SCHEMA)[1:10]], pa.array(at.astype(np.int32)), pa.array(counts[at])], schema=_SCHEMA)


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    c = counts.reshape(ALPHABET, ALPHABET) + 0.5
    return np.log(c / c.sum(axis=1, keepdims=True)).reshape(-1)


Piece = tuple[str, str, str, str, str]


class Model:
    """Logistic regression over dense and hashed features, calibrated by a second fit on held-out scores."""

    def __init__(self, log_p: np.ndarray):
        self.log_p = log_p
        self.w: np.ndarray | None = None

    def arrays(self, rows: list[Piece]) -> tuple[np.ndarray, np.ndarray]:
        """Dense features, and places of hashed ones (HASHED stands for none)."""
        dense, at = [], np.full((len(rows), FEATURES), HASHED, np.int32)
        for i, r in enumerate(rows):
            d, words = features(*r, self.log_p)
            dense.append(d)
            at[i, : len(words)] = [binascii.crc32(w.encode("utf-8", "replace")) % HASHED for w in words]
        return np.array(dense, float).reshape(len(rows), -1), at

    def _times(self, z: np.ndarray, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        k = z.shape[1]
        return z @ w[:k] + w[k] + np.append(w[k + 1 :], 0.0)[at].sum(axis=1)

    def _back(self, z: np.ndarray, at: np.ndarray, r: np.ndarray) -> np.ndarray:
        hashed = np.bincount(at.ravel(), np.repeat(r, at.shape[1]), HASHED + 1)[:HASHED]
        return np.concatenate([z.T @ r, [r.sum()], hashed])

    def _fit(self, z: np.ndarray, at: np.ndarray, y: np.ndarray, l2: float, steps: int = 25) -> np.ndarray:
        """Newton steps by conjugate gradients on the penalised likelihood; both labels weigh the same."""
        w = np.zeros(z.shape[1] + 1 + HASHED)
        pos = max(1.0, y.sum())
        weight = np.where(y == 1, len(y) / (2 * pos), len(y) / (2 * max(1.0, len(y) - pos)))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(self._times(z, at, w), -30, 30)))
            g = self._back(z, at, weight * (p - y)) + l2 * w
            h = weight * p * (1 - p)
            d, r = np.zeros_like(w), g.copy()
            q, rr = r.copy(), float(r @ r)
            for _ in range(60):
                hq = self._back(z, at, h * self._times(z, at, q)) + l2 * q
                a = rr / max(float(q @ hq), 1e-300)
                d += a * q
                r -= a * hq
                new = float(r @ r)
                if new < 1e-8 * float(g @ g) or new < 1e-18:
                    break
                q, rr = r + new / rr * q, new
            # damped where a full step is too long
            w = w - d * min(1.0, 8.0 / max(np.abs(d).max(), 1e-9))
            if np.abs(d).max() < 1e-3:
                break
        return w

    def fit(self, rows: list[Piece], y: np.ndarray, held_out: np.ndarray) -> Model:
        dense, at = self.arrays(rows)
        self.mean, self.std = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6)
        z = (dense - self.mean) / self.std
        self.w = self._fit(z[~held_out], at[~held_out], y[~held_out], 1.0)
        s = self._times(z[held_out], at[held_out], self.w)
        self.a, self.b = 1.0, 0.0
        if held_out.any() and 0 < y[held_out].sum() < held_out.sum():
            self.a, self.b = calibration(s, y[held_out])
        return self

    def score(self, rows: list[Piece]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        dense, at = self.arrays(rows)
        z = (dense - self.mean) / self.std
        return 1 / (1 + np.exp(-np.clip(self.a * self._times(z, at, self.w) + self.b, -30, 30)))


def calibration(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn held-out scores into probabilities (Newton steps on smoothed targets, slope kept positive)."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
        g = np.array([((p - t) * s).sum() + 1e-3 * (a - 1), (p - t).sum()])
        h = p * (1 - p)
        m = np.array([[(h * s * s).sum() + 1e-3, (h * s).sum()], [(h * s).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        a, b = max(0.05, a - step[0]), b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return a, b


def _labelled_sample(found: DataFrame, sample: int) -> list[Row]:
    """At most ``sample`` labelled pieces per label and kind, smallest hash first."""
    labelled = found.filter("kind = 0 and label is not null").select("label", "pattern", "piece", "name", "value", "before", F.coalesce("file_path", F.lit("")).alias("path"))
    draw = labelled.groupBy("label", "piece").agg(F.count("*").alias("m"))
    share = {(r["label"], r["piece"]): min(1.0, 3 * sample / r["m"]) for r in draw.collect()}  # at most two labels of each kind
    if not share:
        return []
    keep = F.create_map(*[x for (lab, p), s in share.items() for x in (F.lit(f"{lab}{p}"), F.lit(s))])[F.concat(F.col("label").cast("string"), F.col("piece"))]
    hashed = F.pmod(F.xxhash64("value", "name", "before"), F.lit(1 << 40))
    few = labelled.withColumn("draw", hashed).filter(F.col("draw") / F.lit(float(1 << 40)) <= keep).dropDuplicates(["label", "piece", "name", "value", "before"])
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("label", "piece").orderBy("draw", "value", "name", "before", "path"))).filter(F.col("r") <= sample)
    return few.orderBy("label", "piece", "r").collect()


def _transitions(found: DataFrame) -> np.ndarray:
    counts = np.zeros(ALPHABET * ALPHABET, np.int64)
    for r in found.filter("kind = 1").groupBy("k").agg(F.sum("n").alias("n")).collect():  # at most ALPHABET^2 rows
        counts[r["k"]] = r["n"]
    return log_likelihoods(counts)


def _piece(r: Row) -> Piece:
    return r["piece"], r["name"], r["value"], r["before"], r["path"]


def train(found: DataFrame, sample: int = SAMPLE) -> Model:
    rows = _labelled_sample(found, sample)
    seeds, y = seed_pieces()
    held = np.array([r["draw"] % 5 == 0 for r in rows] + [i % 5 == 0 for i in range(len(seeds))])
    return Model(_transitions(found)).fit([*map(_piece, rows), *seeds], np.array([float(r["label"]) for r in rows] + y, float), held)


def hidden_patterns(found: DataFrame, sample: int = SAMPLE) -> dict[str, tuple[int, float]]:
    """pattern -> (pieces, share judged as the pattern says) by a regression that was shown no piece of that pattern."""
    rows = _labelled_sample(found, sample)
    log_p = _transitions(found)
    seeds, seed_y = seed_pieces()
    out = {}
    for pattern in sorted({r["pattern"] for r in rows}):
        shown, hidden = [r for r in rows if r["pattern"] != pattern], [r for r in rows if r["pattern"] == pattern]
        held = np.array([r["draw"] % 5 == 0 for r in shown] + [False] * len(seeds))
        model = Model(log_p).fit([*map(_piece, shown), *seeds], np.array([float(r["label"]) for r in shown] + seed_y, float), held)
        right = (model.score([_piece(r) for r in hidden]) >= THRESHOLD) == np.array([r["label"] == 1 for r in hidden])
        out[pattern] = (len(hidden), float(right.mean()))
    return out


def scanned(vulns: DataFrame) -> DataFrame:
    """Pieces and character transitions of all code, written once."""
    return materialize(vulns.select(F.col("id").cast("string").alias("id"), *FIELDS).mapInArrow(_scan, _OUT), "pieces")


def secret_values(vulns: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(id, field_name, file_path, piece, value, score) of every piece whose calibrated score reaches the threshold.

    Null, empty, ``[]`` and plain-text fields are allowed: plain text gives
    pieces without a file, a broken document what can be read of it. A null id
    stays null; repeated rows give repeated pieces; an empty table gives an
    empty result.
    """
    found = scanned(vulns)
    shared = vulns.sparkSession.sparkContext.broadcast(train(found, sample))  # weights and transitions: of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            score = m.score(list(zip(*[b.column(c).to_pylist() for c in ("piece", "name", "value", "before", "path")])))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("id", "field_name", "file_path", "piece", "name", "value")], pa.array(score, pa.float64())], names=["id", "field_name", "file_path", "piece", "name", "value", "score"])

    pieces_ = found.filter("kind = 0").select("id", "field_name", "file_path", "piece", "name", "value", "before", F.coalesce("file_path", F.lit("")).alias("path"))
    scored = pieces_.mapInArrow(run, "id string, field_name string, file_path string, piece string, name string, value string, score double")
    return scored.filter(F.col("score") >= threshold)


_ESCAPE = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f", "/": "/", "\\": "\\", '"': '"'}


def decoded(raw: str) -> tuple[str, list[int]]:
    """A JSON string's text, and where each of its characters begins in the stored form (and where the last one ends)."""
    out, at, i = [], [], 0
    while i < len(raw):
        at.append(i)
        if raw[i] == "\\" and i + 1 < len(raw):
            if raw[i + 1] == "u" and re.fullmatch("[0-9a-fA-F]{4}", raw[i + 2 : i + 6]):
                c, i = chr(int(raw[i + 2 : i + 6], 16)), i + 6
                if "\ud800" <= c <= "\udbff" and re.fullmatch(r"\\u[dD][c-fC-F][0-9a-fA-F]{2}", raw[i : i + 6]):
                    c, i = chr(0x10000 + ((ord(c) - 0xD800) << 10) + int(raw[i + 2 : i + 6], 16) - 0xDC00), i + 6
                out.append(c)
            else:
                out.append(_ESCAPE.get(raw[i + 1], raw[i + 1]))
                i += 2
        else:
            out.append(raw[i])
            i += 1
    return "".join(out), [*at, len(raw)]


_STRING = re.compile(r'"((?:[^"\\]|\\.)*)(?:"|\Z)', re.S)


def _literals(value: str) -> list[tuple[str | None, list[tuple[int, int]]]]:
    """(file, stored places of its codes) of every entry of a code field; plain text is one code."""
    s = value.lstrip()
    shift = len(value) - len(s)
    if s[:1] not in ("[", "{"):
        return [(None, [(0, len(value))])]
    out: list[tuple[str | None, list[tuple[int, int]]]] = []
    key = ""
    for m in _STRING.finditer(s):
        if s[m.end() :].lstrip()[:1] == ":" if len(s) - m.end() < 64 else re.compile(r"\s*:").match(s, m.end()):
            key = m.group(1)
            continue
        if key == "file":
            out.append((_unescape(m.group(1)), []))
        elif key == "code":
            if not out:
                out.append((None, []))
            out[-1][1].append((shift + m.start(1), shift + m.end(1)))
        key = ""
    return out


def _cover(kind: str, text: str) -> str:
    """What stands in place of a piece: numbers of a byte list become 0, the lines of a key block are masked one by one, all else is MASK."""
    if kind == "bytes":
        return re.sub(r"0x[0-9a-fA-F]+|\d+", lambda m: "0x00" if m.group().startswith("0x") else "0", text)
    if kind == "pem":
        return re.sub(r"(\\[nrt])|[A-Za-z0-9+/=]+", lambda m: m.group(1) or MASK, text)
    return MASK


def masked(value: str, is_secret: Callable[[list[Piece]], np.ndarray]) -> tuple[str, int]:
    """(a code field with its secrets masked in place, how many pieces). Everything else stays, byte for byte.

    A value found once is also masked where it stands in another place of the
    same entry's code as a word of its own (values of 8 characters and more).
    """
    edits: list[tuple[int, int, str]] = []
    n = 0
    plain = value.lstrip()[:1] not in ("[", "{")
    for path, places in _literals(value):
        texts = [(value[a:z], list(range(z - a + 1))) if plain else decoded(value[a:z]) for a, z in places]
        code = "\n".join(t for t, _ in texts)
        here = [x for x in pieces(code) if worth(*x[:3])]
        if not here:
            continue
        hit = is_secret([(k, name, v, before, path or "") for k, name, v, before, _ in here])
        spans: list[tuple[int, int, str]] = []
        for (k, _, v, _, where), yes in zip(here, hit):
            if yes:
                n += 1
                spans += [(a, z, k) for a, z in where]
                if len(v) >= 8 and k not in ("pem", "bytes", "words", "joined"):
                    spans += [(m.start(), m.end(), k) for m in re.finditer(rf"(?<!\w){re.escape(v)}(?!\w)", code)]
        first = 0
        for (a, _), (text, at) in zip(places, texts):
            last: tuple[int, int] | None = None
            for x, y, k in sorted({(max(x, first), min(y, first + len(text)), k) for x, y, k in spans if x < first + len(text) and y > first}):
                if last and x < last[1]:
                    continue  # inside what is masked already
                last = (x, y)
                cover = _cover(k, text[x - first : y - first])
                edits.append((a + at[x - first], a + at[y - first], cover if plain else json.dumps(cover, ensure_ascii=False)[1:-1]))
            first += len(text) + 1
    for a, z, cover in sorted(edits, reverse=True):
        value = value[:a] + cover + value[z:]
    return value, n


def redact_code(vulns: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(id, pre_fix_code, post_fix_code, n_masked): the rows with a secret, their code masked.

    Rows are masked where they lie, by the trained regression: no join brings
    the findings to the code. Nulls stay null.
    """
    shared = vulns.sparkSession.sparkContext.broadcast(train(scanned(vulns), sample))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("id", *FIELDS, "n_masked")}
            for i, *codes in zip(*[b.column(c).to_pylist() for c in ("id", *FIELDS)]):
                done = [(v, 0) if not v or v == "[]" else masked(v, lambda rows: m.score(rows) >= threshold) for v in codes]
                if n := sum(k for _, k in done):
                    for c, x in zip(out, (i, *[v for v, _ in done], n)):
                        out[c].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out["id"], pa.string()), *[pa.array(out[f], pa.string()) for f in FIELDS], pa.array(out["n_masked"], pa.int32())], names=list(out))

    rows = vulns.select(F.col("id").cast("string").alias("id"), *FIELDS)
    return rows.mapInArrow(run, "id string, pre_fix_code string, post_fix_code string, n_masked int")
