"""Problem 10: text read in a wrong character set.

Method: for the words beyond ASCII of every line, all chains of (written in one
set, read in another) that could have produced them are undone; every candidate
is compressed with zstandard under the dictionary of every language, and the
chain with the smallest description (compressed bytes plus the chain's cost)
wins. If nothing beats the line as it stands, it is left unchanged. Characters
that no chain can bring back (replacement characters, control characters) count
as lost: a line that is described in less without them is garbled all the same,
and stays as it is.

Dictionaries are made from counts over the whole texts of all documents: how often
every pair of characters stands in lines without signs of a wrong set, and in how
many documents every word stands in those of them without words that a step turns
into ones of more common pairs. A dictionary holds the words beyond ASCII seen in
most documents, as many as it has room for. Those of several documents that no
chain shortens need not be tried again and again: they are in a dictionary whole,
and no candidate of them can save more than a chain costs.
"""

from __future__ import annotations

import codecs
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DICTIONARY_BYTES = 48 * 1024
#: Search by binary trees: faster ones miss some of the matches, and then compare what they happen to find.
MATCHER = {"strategy": zstandard.STRATEGY_BTLAZY2, "window_log": 17, "search_log": 3, "min_match": 4, "target_length": 12}
#: Text that the code lengths of a dictionary are made of.
TRAINING_BYTES = 8 * DICTIONARY_BYTES
#: Different words that a batch of counts holds before it is passed on.
COUNTS_EACH = 200_000
#: Bytes that a step costs by how common it is (UTF-8 read in a Western set; in another set; other pairs; rare sets), and that a replacement character costs.
STEP_COST, OTHER_SET_COST, PAIR_COST, RARE_COST, LOST_COST = 2, 3, 6, 8, 2
#: Bytes that a step from a set of two-byte characters costs, which merges pairs of characters by chance.
WIDE_COST = 10
#: Bytes that a letter costs of a script that none of the languages has (Armenian to Phonetic Extensions).
FOREIGN_COST = 3
_FOREIGN = re.compile("[\u0530-\u1dff]")
#: Characters that cost more than their bytes.
_DEAR = re.compile("[\x80-\x9f\u0530-\u1dff\ufffd]")
RARE = ("cp1254", "iso8859-15", "mac_cyrillic", "iso8859-5")
MAX_STEPS = 3
#: Documents in which a word must stand to be known.
KNOWN_IN = 2
#: Languages of which dictionaries are trained (fixed values).
LANGUAGES = ("en", "de", "fr", "es", "pt", "pl", "ru", "ja")

#: Single-byte sets that bytes may have been read in (fixed values).
READ_AS = ("cp1252", "latin-1", "cp437", "cp850", "mac_roman", "cp866", "cp1251", "koi8-r", "cp1250", "iso8859-2", "cp1254", "iso8859-15", "mac_cyrillic", "iso8859-5", "halfwidth")
#: (read as, written in) pairs beside UTF-8 (fixed values).
OTHER_PAIRS = (
    ("cp1252", "cp1251"), ("cp1252", "koi8-r"), ("cp1252", "cp866"), ("cp1252", "cp1250"), ("cp1252", "iso8859-2"), ("cp1252", "cp932"), ("cp1252", "euc_jp"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "iso8859-5"),
    ("latin-1", "cp1251"), ("latin-1", "koi8-r"), ("latin-1", "iso8859-2"), ("latin-1", "cp1250"), ("latin-1", "cp932"), ("latin-1", "euc_jp"), ("latin-1", "iso8859-5"),
    ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("mac_cyrillic", "cp1251"), ("cp1251", "mac_cyrillic"), ("iso8859-5", "cp1251"), ("cp1251", "iso8859-5"), ("cp1251", "cp1252"), ("cp1250", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("mac_roman", "cp1252"), ("iso8859-2", "cp1252"),
    ("cp932", "euc_jp"), ("cp437", "cp932"), ("halfwidth", "euc_jp"),
)


def _table(codec: str) -> dict[int, int]:
    """Character -> byte of a single-byte set; bytes the set leaves open stand for themselves, as readers let them."""
    out: dict[int, int] = {}
    for b in range(256):
        try:
            c = bytes([b]).decode("latin-1" if codec == "halfwidth" else codec)
        except UnicodeDecodeError:
            c = chr(b)
        if codec == "halfwidth" and 0xA1 <= b <= 0xDF:
            c = chr(0xFF61 + b - 0xA1)
        out.setdefault(ord(c), b)
    for b in range(0x80, 0xA0):
        out.setdefault(b, b)
    if codec == "halfwidth":
        for b in range(0xA1, 0xE0):
            out.setdefault(b, b)
    return out


_TABLES = {c: _table(c) for c in READ_AS}
_CHARACTERS = {c: frozenset(map(chr, t)) for c, t in _TABLES.items()}
class _Same(dict):
    """Characters that are not in it stand for themselves."""

    def __missing__(self, c: int) -> int:
        self[c] = c
        return c


#: Characters of single-byte sets whose UTF-8 form has three bytes, moved to where it has two: all characters of such sets cost the same before compression.
_PACKED = _Same({c: 0x0590 + i for i, c in enumerate(sorted({c for t in _TABLES.values() for c in t if c > 0x7FF}))})


_BEYOND = re.compile("[\u0800-\U0010ffff]")


def packed(text: str) -> bytes:
    if _BEYOND.search(text):
        text = text.translate(_PACKED)
    return text.encode("utf-8", "surrogatepass")


def _utf8_shape(codec: str) -> re.Pattern[str]:
    """Characters that a UTF-8 sequence beyond ASCII becomes when it is read in a set."""
    by_byte: dict[int, str] = {}
    for c, b in _TABLES[codec].items():
        by_byte[b] = by_byte.get(b, "") + re.escape(chr(c))

    def any_of(lo: int, hi: int) -> str:
        return "[" + "".join(by_byte.get(b, "") for b in range(lo, hi)) + "]"

    more = any_of(0x80, 0xC0)
    return re.compile(f"{any_of(0xC2, 0xE0)}{more}|{any_of(0xE0, 0xF0)}{more}{{2}}|{any_of(0xF0, 0xF5)}{more}{{3}}")


_SHAPES = {c: _utf8_shape(c) for c in READ_AS}
_CYRILLIC_SETS = ("cp1251", "koi8-r", "cp866", "mac_cyrillic", "iso8859-5")


def _bytes(word: str, codec: str) -> bytes | None:
    if codec == "cp932":
        try:
            return word.encode("cp932")
        except UnicodeEncodeError:
            return None
    return codecs.charmap_encode(word, "strict", _TABLES[codec])[0] if _CHARACTERS[codec].issuperset(word) else None


_CONTROL, _PRIVATE = re.compile("[\x80-\x9f]"), re.compile("[\ue000-\uf8ff]")


#: Sets that bytes were read in -> sets that they may have been written in beside UTF-8.
_WRITTEN: dict[str, list[str]] = {}
for _read, _set in OTHER_PAIRS:
    _WRITTEN.setdefault(_read, []).append(_set)

#: (set read as, sets that may have been written) in the order that they are tried in.
_TRIED = [(read, (("utf-8",) if read in READ_AS else ()) + tuple(_WRITTEN.get(read, ()))) for read in dict.fromkeys((*READ_AS, *_WRITTEN))]


def _price(read: str, written: str) -> int:
    if written == "utf-8":
        return RARE_COST if read in RARE else STEP_COST if read in READ_AS[:2] else OTHER_SET_COST
    return RARE_COST if read in RARE or written in RARE else WIDE_COST if written in ("cp932", "euc_jp") else PAIR_COST


#: (step, its price, whether it is from UTF-8) by number.
_STEPS = [(f"{read}>{written}", _price(read, written), written == "utf-8") for read, sets in _TRIED for written in sets]


def _undo(word: str) -> dict[int, str]:
    """Numbers of the steps that a word can come from -> the word as it was written."""
    out: dict[int, str] = {}
    if word.isascii():
        return out
    control = bool(_CONTROL.search(word))
    decoded: dict[tuple[bytes, str], str] = {}  # most sets agree in most bytes
    n = 0
    for read, sets in _TRIED:
        stored = _bytes(word, read)
        if stored:
            for i, written in enumerate(sets, n):
                d = decoded.get((stored, written))
                if d is None:
                    try:
                        d = stored.decode(written)
                    except UnicodeDecodeError:
                        d = word
                    if not control and _CONTROL.search(d):
                        d = word
                    decoded[stored, written] = d
                if d != word:
                    out[i] = d
        n += len(sets)
    return out


#: Long words come back less often, and take more room.
_undo_short, _undo_long, _SHORT = lru_cache(maxsize=20_000)(_undo), lru_cache(maxsize=100)(_undo), 24


def _undone(word: str) -> dict[int, str]:
    return _undo_short(word) if len(word) <= _SHORT else _undo_long(word)


def steps(words: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(words with one step undone, step, its price) of every pair of sets that changes any."""
    by_word = [_undone(w) for w in words]
    for i in sorted(set().union(*by_word)):
        label, price, utf8 = _STEPS[i]
        x = tuple([u.get(i, w) for u, w in zip(by_word, words)])
        if utf8 or not _PRIVATE.search(" ".join(x)):
            yield x, label, price


class _Bounds:
    """What a text takes at least under every dictionary, so that most need not be compressed.

    Holds for what zstandard writes: frame and block headers take 9 bytes, a block
    that isn't raw at least 2 more. A match has four bytes at least (``min_match``),
    and all sequences of four in it stand in the dictionary or earlier in the text.
    What no match can cover is written out: in bits no fewer than its entropy, and in
    whole bytes where no byte value occurs more than four times, which zstandard takes
    for incompressible. Sequences are looked up by hash: a collision can but lower a bound.
    """

    BITS, EARLIER_BITS = 22, 18
    #: Bytes of a text from which it may be split into blocks, and so has no bound, and of the texts looked at together.
    LONGEST, TOGETHER = 1 << 16, 1 << 18

    def __init__(self, dictionaries: list[bytes]):
        #: bits of the dictionaries, and which of them have a sequence, by its hash
        kind = np.min_scalar_type((1 << len(dictionaries)) - 1)
        self.bits = [kind.type(1 << i) for i in range(len(dictionaries))]
        self.all = kind.type((1 << len(dictionaries)) - 1)
        self.having = np.zeros(1 << self.BITS, kind)
        for bit, d in zip(self.bits, dictionaries):
            self.having[self._hash(self._fours(np.frombuffer(d, np.uint8)), self.BITS)] |= bit
        #: where a sequence stands first, by its hash (what an earlier call left there isn't read)
        self.first = np.zeros(1 << self.EARLIER_BITS, np.int32)
        self.n_log_n = np.zeros(1)
        #: a match can go on from the end of such a dictionary into the text
        self.open_end = [i for i, d in enumerate(dictionaries) if not d.endswith(b" ")]

    @staticmethod
    def _fours(b: np.ndarray) -> np.ndarray:
        x = b.astype(np.uint32)
        return x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24

    @staticmethod
    def _hash(fours: np.ndarray, bits: int) -> np.ndarray:
        return fours * np.uint32(2654435761) >> np.uint32(32 - bits)

    def of(self, texts: list[bytes]) -> np.ndarray:
        """A row per text (which begins and ends with a space), a column per dictionary; 0 where there is no bound."""
        out = np.zeros((len(texts), len(self.bits)), np.int64)
        part: list[int] = []
        size = 0
        for i, x in enumerate(texts):
            if len(x) < self.LONGEST and b"  " not in x:
                part.append(i)
                size += len(x)
            if size >= self.TOGETHER:
                out[part] = self._of([texts[j] for j in part])
                part, size = [], 0
        if part:
            out[part] = self._of([texts[j] for j in part])
        out[:, self.open_end] = 0
        return out

    def _of(self, texts: list[bytes]) -> np.ndarray:
        count = len(texts)
        b = np.frombuffer(b"".join(texts) + b"\0\0\0", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, count)
        ends = sizes.cumsum()
        text = np.arange(count).repeat(sizes)
        fours = self._fours(b)
        b = b[:-3]
        having = self.having[self._hash(fours, self.BITS)]
        place = self._hash(fours + text.astype(np.uint32) * np.uint32(0x9E3779B1), self.EARLIER_BITS)
        at = np.arange(len(b), dtype=np.int32)
        self.first[place[::-1]] = at[::-1]  # the last one written stays: the first of the texts
        having[self.first[place] < at] = self.all
        for i in (1, 2, 3):  # no sequence of four begins there
            having[ends - i] = 0
        covered = having.copy()
        for i in (1, 2, 3):
            covered[i:] |= having[:-i]
        # one cell per text and byte value that it has
        row = text * 256 + b
        often = np.bincount(row, minlength=count * 256)
        has = often > 0
        starts = has.reshape(count, 256).sum(1).cumsum()
        cell = (has.cumsum() - 1)[row]
        n_cells = int(starts[-1])
        starts = np.concatenate(([0], starts[:-1]))
        cells = np.stack([np.bincount(cell[(covered & bit) == 0], minlength=n_cells) for bit in self.bits])
        if len(self.n_log_n) <= (largest := int(sizes.max())):
            k = np.arange(2 * largest, dtype=float)
            self.n_log_n = k * np.log2(np.maximum(k, 1))
        literals = np.add.reduceat(cells, starts, 1)
        entropy = (self.n_log_n[literals] - np.add.reduceat(self.n_log_n[cells], starts, 1)) / 8
        whole = np.maximum.reduceat(often[has], starts) <= 4
        return np.minimum(np.where(whole, literals, np.ceil(entropy - 1e-6)) + 11, sizes + 9).T


class Restorer:
    """Judges lines with the dictionaries of all languages. Pure: the verdict on a line depends on nothing but the line."""

    def __init__(self, dictionaries: dict[str, bytes], known: frozenset[str] = frozenset()):
        self.known = known
        self.by_language: dict[str, zstandard.ZstdCompressor] = {}
        for lang in sorted(dictionaries):
            d = zstandard.ZstdCompressionDict(dictionaries[lang])
            bits = max(8, len(dictionaries[lang]).bit_length())
            params = zstandard.ZstdCompressionParameters(hash_log=bits, chain_log=bits + 1, write_content_size=False, write_checksum=False, write_dict_id=False, **MATCHER)
            self.by_language[lang] = zstandard.ZstdCompressor(dict_data=d, compression_params=params)
        self.compressors = list(self.by_language.values())
        self.bounds = _Bounds([dictionaries[lang] for lang in self.by_language])
        self.judge = lru_cache(maxsize=200_000)(self._judge)

    def _least(self, texts: list[str]) -> list[tuple[int, bytes, int, list[tuple[int, int]]]]:
        """(the least it can cost, as bytes, cost of its characters, what dictionaries give at least) of texts."""
        b = [packed(f" {x} ") for x in texts]
        more = [LOST_COST * (x.count("�") + len(_CONTROL.findall(x))) + FOREIGN_COST * len(_FOREIGN.findall(x)) if _DEAR.search(x) else 0 for x in texts]
        if not self.compressors:
            return [(len(x) + m, x, m, []) for x, m in zip(b, more)]
        bounds = self.bounds.of(b)
        order = bounds.argsort(1, kind="stable")
        bounds = np.take_along_axis(bounds, order, 1)
        return [(o[0] + m, x, m, list(zip(o, l))) for x, m, o, l in zip(b, more, bounds.tolist(), order.tolist())]

    def _cost(self, b: bytes, more: int, bounds: list[tuple[int, int]], limit: float) -> int:
        """Bytes under the best dictionary and the cost of characters; where that is more than the limit, any number above it."""
        if not bounds:
            return len(b) + more
        best = bounds[-1][0] + 2 * len(b) + 64
        for least, language in bounds:
            if least >= best or least + more > limit:
                break
            best = min(best, len(self.compressors[language].compress(b)))
        return best + more

    def size(self, text: str) -> int:
        _, b, more, bounds = self._least([text])[0]
        return self._cost(b, more, bounds, float("inf"))

    def _judge(self, words: tuple[str, ...]) -> tuple[tuple[str, ...], str]:
        best, name, cost = words, "", 0
        level: list[tuple[tuple[str, ...], str, int, int]] = [(words, "", 0, 0)]
        seen = {words}
        for depth in range(MAX_STEPS):
            tried: list[tuple[tuple[str, ...], str, int, int | None]] = []  # with the cost that a usual one must stay below
            for at, chain, before, spent in level:
                for cand, label, price in steps(at):
                    if cand not in seen:
                        seen.add(cand)
                        tried.append((cand, f"{chain}, {label}" if chain else label, spent + price, before if price == STEP_COST else None))
            if not tried:
                break
            least = self._least([" ".join(x[0]) for x in tried] if depth else [" ".join(words), *(" ".join(x[0]) for x in tried)])
            if not depth:
                cost = self._cost(*least.pop(0)[1:], float("inf"))
                tried = [(*x[:3], None if x[3] is None else cost) for x in tried]
            # the most promising first; what can't come near the best by its bound isn't compressed
            totals = [0] * len(tried)
            first = len(tried)
            for i in sorted(range(len(tried)), key=lambda i: least[i][0] + tried[i][2]):
                spent, before = tried[i][2:]
                limit = cost if depth == MAX_STEPS - 1 else cost + STEP_COST
                if before is not None:
                    limit = max(limit, before - 1)
                totals[i] = total = self._cost(*least[i][1:], limit - spent) + spent
                if total < cost or (total == cost and i < first < len(tried)):
                    first, cost = i, total
            if first < len(tried):
                best, name = tried[first][:2]
            # a step that lengthens the description beyond the best by more than the cheapest step costs undoes nothing, but for the usual ones that shorten what they undo
            usual, others = [], []
            for (cand, chain, spent, before), total in zip(tried, totals):
                if before is not None and total < before:
                    usual.append((cand, chain, total, spent))
                elif total <= cost + STEP_COST:
                    others.append((cand, chain, total, spent))
            level = usual + others
            if not level:
                break
        return best, name

    def lost(self, line: str) -> bool:
        """Whether a line is described in less without characters that stand for lost ones."""
        return bool(LOST.search(line)) and self.size(LOST.sub("", line)) + STEP_COST < self.size(line)

    def line(self, line: str) -> tuple[str, str]:
        """The line restored, and the chains undone ('' if unchanged); parts garbled more often than others are undone in turn."""
        chains: list[str] = []
        for _ in range(MAX_STEPS):
            line, chain = self._once(line)
            if not chain:
                break
            chains.append(chain)
        return line, ", then ".join(chains)

    def _once(self, line: str) -> tuple[str, str]:
        parts = line.split(" ")
        at = [i for i, w in enumerate(parts) if not w.isascii() and w not in self.known]
        if not at:
            return line, ""
        words = tuple(parts[i] for i in at)
        fixed, chain = self.judge(words)
        if not chain and len(words) > 1:
            # parts of a line may be garbled, the rest not
            chains = set()
            fixed = list(words)
            for j, w in enumerate(words):
                (f,), c = self.judge((w,))
                if c:
                    fixed[j] = f
                    chains.add(c)
            chain = "; ".join(sorted(chains))
        if not chain:
            return line, ""
        for i, w in zip(at, fixed):
            parts[i] = w
        return " ".join(parts), chain

    def text(self, text: str) -> tuple[str, str, bool]:
        """(restored text, chains, shows signs of a wrong set)."""
        if text.isascii():
            return text, "", False
        lines, chains, lost = [], [], False
        for line in text.split("\n"):
            if line.isascii():
                lines.append(line)
                continue
            fixed, chain = self.line(line)
            lines.append(fixed)
            if chain and chain not in chains:
                chains.append(chain)
            lost = lost or self.lost(line)
        return "\n".join(lines), "; ".join(chains), bool(chains) or lost


#: A replacement character, or control characters that only bytes read in a wrong set leave behind.
LOST = re.compile("�|[\x80-\x84\x86-\x9f]")
#: What never stands in a line for the dictionaries.
_SUSPECT = re.compile("[\x80-\x9f�╨╤Ã]|Ð.|Ñ.|â€|Ð|[РС][^а-яА-ЯёЁ\\s.,:;!?)]|[Ѐ-Џѐ-џ]|[ÂÃ][\x80-ÿ]|Σ|√|≈|∂|┬|[ｦ-ﾟ]|[а-я][А-Я]|¤|¥|[À-ÿ]{4}|Ĺ|Ă|Ä[^n-ü]|–[а-яА-Я∞∫∏]")
#: Runs of other characters with the hiragana behind them: words of a script that writes no spaces.
_PIECES = re.compile("[^\u3040-\u309f]+[\u3040-\u309f]*|[\u3040-\u309f]+")


#: Shapes that count as signs, and what any two characters of them look like: none is searched for without.
_SIGNS = [_SHAPES[c] for c in READ_AS if c not in _CYRILLIC_SETS]
_TWO = re.compile("[{}][{}]".format(*("".join(sorted({re.escape(chr(c)) for s in READ_AS if s not in _CYRILLIC_SETS for c, b in _TABLES[s].items() if lo <= b < hi})) for lo, hi in ((0xC2, 0xF5), (0x80, 0xC0)))))


def _clean(word: str) -> bool:
    """Whether a word shows no sign of a wrong set (a space stands behind it)."""
    return not _SUSPECT.search(word + " ") and not (_TWO.search(word) and any(x.search(word) for x in _SIGNS))


_is_clean = lru_cache(maxsize=200_000)(_clean)


def _pairs(word: str) -> set[str]:
    """Pairs of characters of a word and the spaces around it, of which one at least is beyond ASCII."""
    w = f" {word} "
    return {w[i : i + 2] for i in range(len(w) - 1) if not (w[i] + w[i + 1]).isascii()}


class _Doubt:
    """Words that a step turns into one whose rarest pair of characters is seen more often than theirs."""

    def __init__(self, seen: dict[str, int]):
        self.seen = seen
        self.has = lru_cache(maxsize=200_000)(self._has)

    def rarest(self, word: str) -> int:
        return min((self.seen.get(x, 0) for x in _pairs(word)), default=0)

    def _above(self, word: str, n: int) -> bool:
        """Whether the rarest is seen more than n times."""
        if word.isascii():
            return False
        last = " "
        for c in word + " ":
            pair = last + c
            if not pair.isascii() and self.seen.get(pair, 0) <= n:
                return False
            last = c
        return True

    def _has(self, word: str) -> bool:
        n = self.rarest(word)
        return any(self._above(c, n) and _clean(c) for (c,), _, _ in steps((word,)))


def _words(text: str, doubt: _Doubt | None = None) -> set[str]:
    """Words of the lines of a text in which all words beyond ASCII are clean and none is doubtful."""
    out: set[str] = set()
    for line in text.split("\n"):
        if not line.isascii():
            words = line.split(" ")
            for x in words:
                if not x.isascii() and (not _is_clean(x) or (doubt and doubt.has(x))):
                    break
            else:
                out.update(words)
    out.discard("")
    return out


def _words_beyond(text: str) -> set[str]:
    """Those of them beyond ASCII, doubtful or not."""
    return {x for x in _words(text) if not x.isascii()}


def _pieces(words: set[str]) -> set[str]:
    """Words, those in a script that writes no spaces in pieces."""
    return {p for x in words for p in ((x,) if x.isascii() else _PIECES.findall(x))}


def _seen(words: Counter[str]) -> Counter[str]:
    """How often pairs of characters stand in words of given numbers of documents."""
    out: Counter[str] = Counter()
    for x, n in words.items():
        for p in _pairs(x):
            out[p] += n
    return out


def _vocabulary(ranked: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The first (piece, documents) pairs that a dictionary has room for."""
    out, room = [], DICTIONARY_BYTES
    for x, n in ranked:
        b = len(packed(x)) + 1
        if b <= room:
            out.append((x, n))
            room -= b
    return out


def _training_lines(pairs: list[tuple[str, int]]) -> list[str]:
    """Lines of about TRAINING_BYTES in which every piece stands in proportion to its documents, but once at least."""
    each = TRAINING_BYTES / max(1, sum(n * (len(packed(x)) + 1) for x, n in pairs))
    left = [(x, max(1, round(n * each))) for x, n in pairs]
    out, done = [], 0
    while left:
        out += [" ".join(x for x, _ in left[i : i + 8]) for i in range(0, len(left), 8)]
        done += 1
        left = [c for c in left if c[1] > done]
    return out


def _model(ranked: dict[str, list[tuple[str, int]]], doubt: _Doubt) -> tuple[dict[str, bytes], frozenset[str]]:
    """Dictionaries and known words of the (piece, documents) pairs of every language, most documents first."""
    out: dict[str, bytes] = {}
    docs: Counter[str] = Counter()
    for lang, pairs in sorted(ranked.items()):
        beyond = _vocabulary([x for x in pairs if not x[0].isascii()])
        if beyond:
            plain = _vocabulary([x for x in pairs if x[0].isascii()])
            # what is nearest to the end costs least
            content = packed(" " + " ".join(x for x, _ in reversed(beyond)) + " ")
            out[lang] = _dictionary(_training_lines(sorted(beyond + plain, key=lambda x: (-x[1], x[0]))), content)
            docs.update(dict(beyond))
    judge = Restorer(out)
    return out, frozenset(x for x, n in docs.items() if n >= KNOWN_IN and not doubt.has(x) and not judge.judge((x,))[1])


def _rank(pairs: Counter[str]) -> list[tuple[str, int]]:
    return sorted(pairs.items(), key=lambda x: (-x[1], x[0]))


def _dictionaries(texts: list[tuple[str, str]]) -> tuple[dict[str, bytes], frozenset[str]]:
    """What ``train`` gives, of (language, text) pairs in memory."""
    words = Counter(x for _, t in texts for x in _words_beyond(t))
    doubt = _Doubt(_seen(words))
    pieces: dict[str, Counter[str]] = {}
    for lang, t in texts:
        pieces.setdefault(lang, Counter()).update(_pieces(_words(t, doubt)))
    return _model({lang: _rank(c) for lang, c in pieces.items()}, doubt)


def _counted(docs: DataFrame, of: Callable[[str], set[str]], turn: Callable[[Counter[str]], Counter[str]] = lambda x: x) -> DataFrame:
    """(lang, word, n): in how many documents of a language every word that ``of`` finds in a text stands; ``turn`` makes other counts of those of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[str]] = {}

        def all_of_them() -> Iterator[pa.RecordBatch]:
            for lang, c in counts.items():
                c = turn(c)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])
            counts.clear()

        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts.setdefault(lang, Counter()).update(of(t))
            if sum(map(len, counts.values())) >= COUNTS_EACH:
                yield from all_of_them()
        yield from all_of_them()

    parts = docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[dict[str, bytes], frozenset[str]]:
    """A zstandard dictionary per language, and words known from several documents; counted over the whole texts of all documents of the languages."""
    texts = docs.filter(F.col("lang").isin(*LANGUAGES) & (F.octet_length("text") > F.length("text")))
    pairs = _counted(texts, _words_beyond, _seen).groupBy("word").agg(F.sum("n").alias("n"))
    seen = {r["word"]: r["n"] for r in pairs.collect()}  # bounded by the pairs of characters that are written
    if not seen:
        return {}, frozenset()
    shared = docs.sparkSession.sparkContext.broadcast(seen)
    doubt: list[_Doubt] = []  # one per worker, made there

    def pieces(text: str) -> set[str]:
        if not doubt:
            doubt.append(_Doubt(shared.value))
        return _pieces(_words(text, doubt[0]))

    # a piece takes two bytes at least: no more of them have room
    w = Window.partitionBy("lang", F.octet_length("word") > F.length("word")).orderBy(F.desc("n"), "word")
    first = _counted(texts, pieces).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= DICTIONARY_BYTES // 2)
    ranked: dict[str, list[tuple[str, int]]] = {}
    for r in first.orderBy("lang", F.desc("n"), "word").collect():
        ranked.setdefault(r["lang"], []).append((r["word"], r["n"]))
    return _model(ranked, _Doubt(seen))


#: Offsets that end the code lengths at the head of a trained dictionary.
_HEAD_END = b"\1\0\0\0\4\0\0\0\10\0\0\0"


def _dictionary(lines: list[str], content: bytes | None = None) -> bytes:
    """A dictionary with the code lengths of lines, and the content that is given, or else what zstandard takes out of the lines."""
    samples = [packed(x) for x in lines]
    try:
        how = {} if content is None else {"k": 256, "d": 8}  # what it takes out of the lines is replaced: no search for the best way
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, **how).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-DICTIONARY_BYTES:] if content is None else content
    if content is None:
        return trained
    at = trained.find(_HEAD_END, 8)
    return trained[: at + len(_HEAD_END)] + content if at > 0 else content


def restore(docs: DataFrame) -> DataFrame:
    """(doc_id, garbled, chains, text): every document whose text shows a wrong character set, with its text given back.

    ``text`` is the text as it was written as far as chains can be undone (and
    unchanged where they can't, as when characters were lost). Null and empty
    texts and texts of ASCII only are no case and give no row; repeated rows
    give repeated rows; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))  # bounded by what dictionaries hold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Restorer(*shared.value)
        for b in batches:
            ids, chains, texts = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fixed, chain, garbled = r.text(t)
                if garbled:
                    ids.append(i)
                    chains.append(chain)
                    texts.append(fixed)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(chains, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "chains", "text"])

    beyond_ascii = F.octet_length("text") > F.length("text")
    return docs.filter(beyond_ascii).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, chains string, text string")
