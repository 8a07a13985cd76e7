"""Problem 6: text values that lost their end.

Method: the length of every distinct value is recomputed under other encodings
(UTF-8 bytes, UTF-16 units), with entities or JSON escapes in place, and with
CR LF line ends; values are grouped by each length, and a length that far more
of them share than its neighbours exposes a storage limit. The endings of the
values at a limit are then inspected, and those whose last words more likely go
on than end, that stop inside a word or document or at a mark are cut. Values at
no limit may have lost their end in transfer, at any length: of them only those
are cut whose ending leaves little doubt.

How likely words go on is counted over all rows: after the last 1, 2, 3 and 5
words, how often a text goes on, how often a sentence or line ends, and how
often a text stops. Each share is smoothed by that of fewer words (worth
``PRIOR`` sightings), so that little evidence decides little and no number of
rows switches a rule on or off. Texts that stop after the same words count once
per title, the value's own left out: one fix filed again, or copied however
often, is no evidence about itself, while a form's last line stands under many
titles. Titles are told apart by one minwise hash of their words.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_by_group, materialize, norm, release
from .nearedit import _string_bytes, mix

FIELDS = ("description", "pre_fix_code", "post_fix_code")
#: Share of ends after the same words up to which an end counts as unusual: anywhere, and at a storage limit.
RARE_END, RARE_END_AT_LIMIT = 0.04, 0.5
#: Values that stop after the same words without an end, per time that these words go on, up to which stopping counts as a cut.
STOPS, STOPS_AT_LIMIT = 0.3, 1.0
#: Sightings that the share after fewer words is worth where that after more words is estimated.
PRIOR = 4.0
#: Share of a word's sightings on its own, among those inside longer words, up to which it counts as a part of one, and what is added for words never seen on their own.
PART_OF_WORD, PART_PRIOR = 0.02, 0.08
#: A length is a limit if SPIKE_TIMES as many values have it as its neighbours within SPIKE_NEAR, and more than chance gives (SPIKE_Z deviations).
SPIKE_TIMES, SPIKE_NEAR, SPIKE_Z = 5.0, 12, 11.0
#: Distinct keys a task holds before it hands its counts on.
HELD_KEYS, HELD_WORDS = 2_000_000, 500_000
BLANK = ("", "nan")

#: What is written where the rest is missing (fixed values); dots alone are judged by the words before them.
CUT_MARK = re.compile(
    r"(?:\[(?:\.{3}|…)\]|\[(?:truncated|cut|snip|clipped|more)\]|\((?:more|cut|truncated|continued|snip)\)|<(?:snip|cut|truncated)>|(?:…|\.{3})\s*read more|read more(?:…|\.{3})|(?:#|//|--)?\s*(?:output|text|message|diff|file) (?:was )?(?:truncated|cut off)|�)\s*$",
    re.I,
)
DOTS = re.compile(r"(?:…|\.{3,})\s*$")
LAST_WORD = re.compile(r"(?<![A-Za-z0-9])([A-Z]?[a-z]*|[A-Z]+)$")
LONE_LETTER = re.compile(r"(?<=[A-Za-z,;:]) (?![aiAI]$)[A-Za-z]$")
ENDED = re.compile(r"[.!?。！？][\"'”’»)\]*_`]*\s*$")

#: Numbers of last tokens whose continuation is counted; the longest seen often enough decides.
ORDERS = (1, 2, 3, 5)
MEASURES = ("chars", "utf8", "utf16", "entities", "json", "crlf", "crlf_utf8")


def lengths(text: str) -> list[int]:
    """Length of a value under each of MEASURES."""
    n, b = len(text), len(text.encode("utf-8", "surrogatepass"))
    lines = text.count("\n") - text.count("\r\n")
    wide = sum(c > "￿" for c in text) if b > n + 2 else 0
    ent = 4 * text.count("&") + 3 * (text.count("<") + text.count(">")) + 5 * text.count('"') + 4 * text.count("'")
    esc = text.count("\\") + text.count('"') + text.count("\n") + text.count("\r") + text.count("\t")
    return [n, b, n + wide, n + ent, n + esc, n + lines, b + lines]


def last_code(value: str) -> tuple[bool, list[str]]:
    """(whole JSON, codes of all hunks in order) of a code field; plain text is one code."""
    s = value.strip()
    if not s.startswith("["):
        return True, [value]
    try:
        doc = json.loads(s)
        codes = []
        for e in doc if isinstance(doc, list) else []:
            for h in (e.get("hunks") or []) if isinstance(e, dict) else []:
                if isinstance(h, dict) and isinstance(h.get("code"), str):
                    codes.append(h["code"])
        return True, codes
    except ValueError:
        return False, []


_CLS = np.full(256, 3, np.uint8)
_CLS[[9, 32, 11, 12, 13]] = 0
_CLS[10] = 1
_CLS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 2
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_POW = np.cumprod(np.full(64, np.uint64(0x100000001B3), np.uint64))
_NUMBER, _NAME = np.uint64(0x11), np.uint64(0x12)


def token_contexts(texts: pa.Array, code: bool) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Of the tokens of all texts: row, hashes of the last ORDERS tokens, and what follows: 0 more, 1 an end (full stop, line end), 2 nothing.

    Words with digits and mixed-case names count as one word each. Last come
    the bytes at which each token begins and ends, equal where it is no word of
    letters only.
    """
    data, off = _string_bytes(texts)
    n = len(data)
    if not n:
        z = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), [z] * len(ORDERS), np.zeros(0, np.int8), (z, z)
    cls = _CLS[data]
    digits = _DIGIT[data]
    cls[1:-1][(data[1:-1] == 46) & digits[:-2] & digits[2:]] = 2  # 1.20.3 is one word
    starts_row = np.zeros(n + 1, bool)
    starts_row[off] = True
    word = cls == 2
    start = np.zeros(n, bool)
    start[cls == 3] = True
    start |= word & (np.concatenate([[True], ~word[:-1]]) | starts_row[:-1])
    s = np.flatnonzero(start)
    if not len(s):
        z = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), [z] * len(ORDERS), np.zeros(0, np.int8), (z, z)
    used = np.flatnonzero(cls >= 2)
    of = np.searchsorted(s, used, "right") - 1
    b = data[used]
    pos = used - s[of]
    first = np.searchsorted(of, np.arange(len(s)))
    h = mix(np.add.reduceat(_LOW[b].astype(np.uint64) * _POW[pos & 63], first))
    digit = np.logical_or.reduceat(_DIGIT[b], first)
    hump = np.concatenate([[False], _UPPER[b][1:] & _LOWER[b][:-1] & (of[1:] == of[:-1])])
    name = np.logical_or.reduceat(hump, first)
    h = np.where(digit, _NUMBER, np.where(name, _NAME, h))
    row = np.searchsorted(off, s, "right") - 1
    end = s + np.diff(np.concatenate([first, [len(b)]]))
    # what follows: end of row, a line end before the next token, or a full stop
    line = np.cumsum(cls == 1)
    nxt = np.concatenate([s[1:], [n]])
    last = np.concatenate([row[1:] != row[:-1], [True]])
    ends = np.zeros(len(s), bool)
    ends |= line[np.minimum(nxt, n - 1)] - line[np.minimum(end, n) - 1] > 0
    ends &= ~last
    if not code:
        stop = np.isin(data[np.minimum(nxt, n - 1)], [46, 33, 63]) & ~last
        after = np.minimum(nxt + 1, n - 1)
        ends |= stop & ((cls[after] != 2) | starts_row[np.minimum(nxt + 1, n)])
    h2 = mix(h + mix(np.concatenate([[np.uint64(1)], np.where(row[1:] == row[:-1], h[:-1], np.uint64(1))])))
    def before(k: int) -> np.ndarray:
        return np.concatenate([np.full(min(k, len(h)), np.uint64(1)), np.where(row[k:] == row[:-k], h[:-k], np.uint64(1))])[: len(h)]

    h3 = mix(h2 ^ mix(before(2) + np.uint64(3)))
    h5 = mix(mix(h3 + mix(before(3) + np.uint64(5))) ^ mix(before(4) + np.uint64(7)))
    plain = ~digit & ~name & (cls[s] == 2) & (data[s] < 128)
    return row, [h, h2, h3, h5], np.where(last, 2, ends.astype(np.int8)), (s, np.where(plain, end, s))


def _keys(hashes: list[np.ndarray], code: bool) -> list[np.ndarray]:
    salt = np.uint64(7 if code else 5)
    return [mix(h + salt * np.uint64(2 * k + 1)) for h, k in zip(hashes, ORDERS)]


_OUT = "kind byte, id string, field_name string, value long, title_key long, mark boolean, k1 long, k2 long, k3 long, k5 long, word string, lens array<int>, n long, ends long, stops long"


def _ending(text: str, words: int = 8) -> str:
    """The end of a text that holds its last words, however long they are."""
    parts = text.rsplit(None, words)
    return text[len(text) - len(text.lstrip()) :] if len(parts) <= words else text[text.index(parts[1], len(parts[0])) :]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: a value whose end must be judged; kind 1: lengths of a value the partition has not met; kind 2: context counts (k1); kind 3: counts of words inside texts.

    Words are counted once per value (under one title) and partition.
    """
    schema = pa.schema([("kind", pa.int8()), ("id", pa.string()), ("field_name", pa.string()), ("value", pa.int64()), ("title_key", pa.int64()), ("mark", pa.bool_()), ("k1", pa.int64()), ("k2", pa.int64()), ("k3", pa.int64()), ("k5", pa.int64()), ("word", pa.string()), ("lens", pa.list_(pa.int32())), ("n", pa.int64()), ("ends", pa.int64()), ("stops", pa.int64())])
    contexts: list[tuple[np.ndarray, ...]] = []
    words: Counter[str] = Counter()

    def batch(rows_n: int, **cols) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(rows_n, f.type) for f in schema], schema=schema)

    def merged() -> None:
        if contexts:
            k = np.concatenate([c[0] for c in contexts])
            u, inv = np.unique(k, return_inverse=True)
            contexts[:] = [(u, *(np.bincount(inv, np.concatenate([c[j] for c in contexts])) for j in (1, 2, 3)))]

    def counts() -> Iterator[pa.RecordBatch]:
        """What was counted so far, which then starts anew."""
        merged()
        for u, n, e, x in contexts:
            for i in range(0, len(u), 100_000):
                m = len(u[i : i + 100_000])
                yield batch(m, kind=np.full(m, 2, np.int8), k1=u[i : i + m], n=n[i : i + m].astype(np.int64), ends=e[i : i + m].astype(np.int64), stops=x[i : i + m].astype(np.int64))
        if words:
            yield batch(len(words), kind=np.full(len(words), 3, np.int8), word=list(words), n=list(words.values()))
        contexts.clear()
        words.clear()

    seen: set[tuple[int, int]] = set()
    for b in batches:
        ids, title_keys = b.column("id").to_pylist(), b.column("title_key").to_pylist()
        for f, field in enumerate(FIELDS):
            code = f > 0
            rows, texts, flags, lens, bodies, ends_in = [], [], [], [], [], []
            values, titles, every = [], [], []
            names = b.column(f"h_{field}").to_pylist()
            for i, (v, title) in enumerate(zip(b.column(field).to_pylist(), title_keys)):
                if v is None or v.strip().lower() in BLANK:
                    continue
                new = (f, names[i]) not in seen
                if new:
                    seen.add((f, names[i]))
                    every.append((names[i], lengths(v)))
                stripped = v.rstrip()
                if code:
                    whole, codes = last_code(v)
                    if not whole:
                        rows.append(i)
                        values.append(names[i])
                        titles.append(title)
                        texts.append("")
                        flags.append(True)
                        lens.append(lengths(v))
                        ends_in.append(None)
                        continue
                    if not codes:
                        continue
                    stripped = codes[-1].rstrip()
                    if new:
                        bodies.append("\n".join(codes))
                elif new:
                    bodies.append(v)
                stripped = _ending(stripped)
                mark = bool(CUT_MARK.search(stripped))
                tail = stripped
                if not mark and (m := DOTS.search(stripped[-8:])):
                    tail = stripped[: len(stripped) - len(m.group())].rstrip() if stripped.endswith("…") or code else stripped
                    if tail is stripped and not ENDED.search(tail[:-3]):
                        tail = stripped[:-3].rstrip(".")
                elif not mark and not code and ENDED.search(stripped[-8:]):
                    tail = ""
                letter = LONE_LETTER.search(tail) if tail and not mark else None
                if letter:
                    # one letter is the start of a word: what stands before it is judged
                    tail = tail[: letter.start()]
                if tail or mark:
                    ends_in.append(letter.group().strip().lower() if letter else None)
                    rows.append(i)
                    values.append(names[i])
                    titles.append(title)
                    texts.append("" if mark else tail)
                    flags.append(mark)
                    lens.append(lengths(v))
            if every:
                yield batch(len(every), kind=np.ones(len(every), np.int8), field_name=[field] * len(every), value=[h for h, _ in every], lens=[x for _, x in every])
            if bodies:
                whole = pa.array(bodies)
                row, hashes, next_, (begin, end) = token_contexts(whole, code)
                for k in _keys(hashes, code):
                    u, inv = np.unique(k.view(np.int64), return_inverse=True)
                    contexts.append((u, np.bincount(inv), np.bincount(inv, next_ == 1), np.bincount(inv, next_ == 2)))
                if sum(len(c[0]) for c in contexts) > 2 * HELD_KEYS:
                    merged()
                data, _ = _string_bytes(whole)
                letters = np.flatnonzero((end > begin) & (next_ != 2))
                u, at, n = np.unique(hashes[0][letters], return_index=True, return_counts=True)
                for i, c in zip(letters[at].tolist(), n.tolist()):
                    words[data[begin[i] : end[i]].tobytes().decode("utf-8", "replace").lower()] += c
            if rows:
                # the contexts of the last token of each value to judge
                row, hashes, _, _ = token_contexts(pa.array(texts), code)
                last = np.full(len(rows), -1)
                last[row] = np.arange(len(row))
                k1, k2, k3, k5 = (np.where(last >= 0, k[last].view(np.int64), 0) if len(k) else np.zeros(len(rows), np.int64) for k in _keys(hashes, code))
                last_words = [e or (m.group(1).lower() if (m := LAST_WORD.search(t)) else None) for t, e in zip(texts, ends_in)]
                yield batch(len(rows), kind=np.zeros(len(rows), np.int8), id=[ids[i] for i in rows], field_name=[field] * len(rows), value=values, title_key=titles, mark=flags, k1=k1, k2=k2, k3=k3, k5=k5, word=last_words, lens=lens)
        if sum(len(c[0]) for c in contexts) > HELD_KEYS or len(words) > HELD_WORDS:
            yield from counts()
    yield from counts()


def length_limits(counts: DataFrame) -> DataFrame:
    """(field_name, measure, length, n): lengths that far more distinct values share than their neighbours."""
    near = counts.select("field_name", "measure", F.explode(F.sequence(F.col("length") - SPIKE_NEAR, F.col("length") + SPIKE_NEAR)).alias("length"), F.col("n").alias("m"), F.col("length").alias("at"))
    around = near.filter("at <> length").groupBy("field_name", "measure", "length").agg(F.sum("m").alias("around"))
    x = counts.join(around, ["field_name", "measure", "length"], "left").withColumn("usual", F.coalesce("around", F.lit(0)) / (2 * SPIKE_NEAR))
    chance = (F.col("n") - F.col("usual")) >= SPIKE_Z * F.sqrt(F.greatest(F.col("usual"), F.lit(1.0)))
    return x.filter((F.col("length") > 64) & chance & (F.col("n") >= SPIKE_TIMES * F.col("usual"))).select("field_name", "measure", "length", "n")


def cut_values(vulns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cut, limits): (id, field_name, reason) of values that lost their end; the storage limits found.

    Null, blank and ``nan`` values are no case; a null id gives null; repeated
    rows give repeated cases; an empty table gives empty results.
    """
    words = F.array_min(F.transform(F.split(F.lower(F.coalesce("title", F.lit(""))), "[^a-z0-9]+"), lambda w: F.when(w != "", F.xxhash64(w))))
    texts = vulns.select(F.col("id").cast("string").alias("id"), *FIELDS, words.alias("title_key"), *[F.xxhash64(words, f).alias(f"h_{f}") for f in FIELDS])
    out = materialize(texts.mapInArrow(_scan, _OUT), "ends")
    values = out.filter("kind = 1").select("field_name", "value", "lens").dropDuplicates(["field_name", "value"])
    counts = values.select("field_name", F.posexplode("lens").alias("measure", "length")).groupBy("field_name", "measure", "length").agg(F.count("*").alias("n"))
    limits = materialize(length_limits(materialize(counts, "lengths")), "limits")
    asked = materialize(out.filter("kind = 0").withColumn("rid", F.monotonically_increasing_id()), "asked")
    keys = asked.select("rid", F.coalesce("title_key", "value").alias("title_key"), F.posexplode(F.array("k1", "k2", "k3", "k5")).alias("order", "key"))
    wanted = keys.select("key").distinct()
    every = out.filter("kind = 2").select(F.col("k1").alias("key"), "n", "ends", "stops")
    stats = every.join(wanted, "key", "left_semi").groupBy("key").agg(F.sum("ends").alias("ends"), F.sum(F.col("n") - F.col("ends") - F.col("stops")).alias("on"))
    titles = keys.groupBy("key", "title_key").agg(F.count("*").alias("rows")).groupBy("key").agg(F.sum("rows").alias("rows"), (F.count("*") - 1).alias("stops"))
    stats = materialize(titles.join(stats, "key", "left").select("key", "rows", "stops", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("on", "ends")]), "stats")
    # a last word may end a third of all values; such keys are few
    met = join_by_group(keys, stats, "key", "rows")
    judged = met.groupBy("rid").agg(*[F.sum(F.when(F.col("order") == i, F.col(c))).alias(f"{c}{i}") for i in range(len(ORDERS)) for c in ("on", "ends", "stops")])
    known = out.filter("kind = 3").groupBy("word").agg(F.sum("n").alias("n"))
    asked_words = asked.filter("word is not null and word <> ''").select("word").distinct()
    prefixes = known.select("n", "word", F.explode(F.expr("transform(sequence(1, length(word)), i -> substring(word, 1, i))")).alias("prefix")).join(asked_words.withColumnRenamed("word", "prefix"), "prefix", "left_semi")
    own, longer = (F.max(F.when(c, F.col("n")).otherwise(0)) for c in (F.col("word") == F.col("prefix"), F.col("word") != F.col("prefix")))
    inside = prefixes.groupBy("prefix").agg(own.alias("alone"), longer.alias("longer")).filter(F.col("alone") + PART_PRIOR <= PART_OF_WORD * (F.col("alone") + F.col("longer") + 1)).select(F.col("prefix").alias("word"), F.lit(True).alias("inside_word"))
    at = asked.select("rid", "field_name", F.posexplode("lens").alias("measure", "length")).join(limits.select("field_name", "measure", "length"), ["field_name", "measure", "length"]).select("rid").distinct().withColumn("at_limit", F.lit(True))
    x = asked.join(judged, "rid", "left").join(at, "rid", "left").join(inside, "word", "left")
    ends, stops = goes_on_shares()
    x = x.withColumn("ends", ends).withColumn("stops", stops)

    def goes_on(rare: float, stop: float) -> Column:
        return F.coalesce(F.col("on0") > 0, F.lit(False)) & (F.col("ends") <= rare) & (F.col("stops") <= stop / (1 + stop))

    at_limit, unknown = F.coalesce("at_limit", F.lit(False)), F.col("on0").isNull() | (F.col("on0") + F.col("ends0") + F.col("stops0") == 0)
    broken = F.col("mark") & (F.col("k1") == 0) & (F.col("field_name") != "description")
    reason = (
        F.when(at_limit & (F.col("mark") | F.col("inside_word") | goes_on(RARE_END_AT_LIMIT, STOPS_AT_LIMIT) | unknown), "at a storage limit")
        .when(broken, "broken document or mark")
        .when(F.col("mark"), "mark")
        .when(F.col("inside_word"), "inside a word")
        .when(goes_on(RARE_END, STOPS), "words that go on elsewhere")
    )
    found = materialize(x.select("id", "field_name", reason.alias("reason")).filter("reason is not null"), "reasons")
    release(out, asked, stats)
    return found, limits


def goes_on_shares() -> tuple[Column, Column]:
    """(share of ends, share of stops) after the last words: those of one word, moved by those of more as far as these were seen."""
    ends, stops = F.lit(0.1), F.lit(0.1)
    for i in range(len(ORDERS)):
        on, e, x = (F.coalesce(F.col(f"{c}{i}"), F.lit(0)) for c in ("on", "ends", "stops"))
        ends = (e + PRIOR * ends) / (e + on + PRIOR)
        stops = (x + PRIOR * stops) / (x + on + PRIOR)
    return ends, stops


def cut_rates(vulns: DataFrame) -> DataFrame:
    """(source_platform, field_name, n_values, n_cut, cut_rate) per platform, over non-blank values."""
    cut, _ = cut_values(vulns)
    per_id = cut.groupBy("id", "field_name").agg(F.lit(1).alias("cut"))
    long = vulns.select("id", norm(F.col("source_platform")).alias("source_platform"), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), (F.col(f).isNotNull() & ~norm(F.col(f)).isin(*BLANK)).alias("filled")) for f in FIELDS])).alias("x")).select("id", "source_platform", "x.field_name", "x.filled").filter("filled")
    both = long.join(per_id, ["id", "field_name"], "left")
    return both.groupBy("source_platform", "field_name").agg(F.count("*").alias("n_values"), F.count("cut").alias("n_cut")).withColumn("cut_rate", F.round(F.col("n_cut") / F.col("n_values"), 6))
