"""Toxicity through a noisy channel: restore disguised words, then score the restored text.

Writers hide words by look-alike characters (``1d10t``), by spacing (``i d i o t``,
``i.d.i.o.t``) and by repetition (``idioot``).  A token that may be disguised (any look-alike, edges
included, or two equal characters in a row) is read as it stands and also becomes a
character lattice: every observed character offers the letters it can stand for, or
nothing, each at a channel cost.  Viterbi decoding under a character trigram model takes the
cheapest path; no state is pruned.  The trigram model is counted over all texts.

Scores come from the restored words and, for words too rare to be proven by themselves, their
beginnings (4 to 6 letters, so that inflected forms count together).  Before anything is decoded, the
lattice and a trie of the model's features are walked together: only parts of a token with a reading that
can have a weight are decoded, wherever the marks around them are cut.  Fitting reads a bounded sample of labelled rows: at most ``max_train`` rows
(the smallest id hashes), of which near copies (``COPIES`` of ``COORDS`` min-hashes of 3-word
windows agree, connected groups) count once for each label, as a copied document is one piece of evidence.  A feature speaks for
toxicity when documents with it are toxic more often than chance allows, given how many features
were tried (a likelihood ratio over twice the logarithm of their number) and at least
``MIN_WEIGHT`` of them are; its weight is its smoothed share of toxic documents.  A document's score is its highest
weight; features without that proof can raise a score only below ``THRESHOLD``.

Scale: counting the trigrams is one map-side combined aggregate with at most (alphabet
size)^3 keys.  The labelled sample is bounded, so joining it broadcasts; the texts are
never shuffled.  Scoring is map-only; caches of a task are cleared at ``CACHE`` entries.

Defined results: null and empty texts score ``FLOOR``; a text of any length is read whole, and a token of any
length in time linear in it but for the parts that are decoded; repeated rows score alike; rows without
``doc_id`` are scored and are not held out; labels that are null are ignored, several labels of one
document count as toxic if one is; without labels, or without toxic ones, all scores are ``FLOOR``;
other columns are ignored (``rejected_removed`` keeps them).
"""

from __future__ import annotations

import math
import re
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlab.llm.common import cut, slices, trimmed

MAX_TRAIN = 40_000
THRESHOLD, FLOOR = 0.3, 0.01
PRIOR = 2.0  # pseudo-documents at the base rate
CACHE = 100_000
PREFIXES = (6, 5, 4)
MIN_WEIGHT = 0.7

# The model's alphabet: word boundary, letters, and one symbol for all other letters.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýßœ"
A = len(LETTERS) + 2
OTHER = A - 1
_CODE = np.full(0x180, 0, np.int64)
for _i, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _i + 1
CODE = {c: i + 1 for i, c in enumerate(LETTERS)} | {" ": 0}

# What a character can stand for besides itself, and channel costs in bits.
LOOKALIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
SUBSTITUTED, DROPPED_MARK, DROPPED_LETTER, HIDDEN, UNKNOWN, PARTED = 1.0, 2.0, 1.5, 4.0, 16.0, 1.0
ANY = "*"
BRANCHES = 8  # from so many characters with a choice on, decoding works on arrays (a cost choice)
CHUNK = 1024  # steps whose ways back are held at once
EDGE_RUNS = 8  # in fitting, a word with decoration is looked for in so many runs of edge marks

_EDGES = ".,;:?!\"'()[]{}<>|&%#*$~^_-/\\=+`…“”„«»‘’"
_MARKS = "".join(c for c in _EDGES if c not in LOOKALIKE and c not in ANY)  # edges that stand for no letter
_RUN = re.compile(r"(.)\1\1")
_LONG_RUN = re.compile(r"([^*])\1{3,}")  # a star may hide a letter
_TWICE = re.compile(r"(.)\1")
_TWICE_MARK = re.compile(r"([@$!|+(€£¡])\1")
_CLOSED = re.compile(r"[.,;:?!…]\W*$")
_WORDS = re.compile(r"[^\W\d_]+")


# -- character model -----------------------------------------------------------------------

def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    known = _CODE[np.minimum(points, len(_CODE) - 1)]
    rest = points >= 0xC0  # a letter outside the alphabet; other characters are boundaries
    return np.where((known == 0) & rest & (points != 0xD7) & (points != 0xF7), OTHER, known)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``code, n`` over all texts; a text is padded with two boundaries on each side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(A ** 3, np.int64)
        for b in batches:
            texts, held = [], 0
            for t in [*b.column(0).to_pylist(), None]:
                if t:
                    texts.append(t)
                    held += len(t)
                if texts and (t is None or held > 2_000_000):
                    c = _codes("  " + "  ".join(texts) + "  ")
                    total += np.bincount(c[:-2] * A * A + c[1:-1] * A + c[2:], minlength=A ** 3)
                    texts, held = [], 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    return docs.select("text").mapInArrow(trimmed(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def char_costs(counts: DataFrame) -> np.ndarray:
    """Bits of every trigram: interpolation of trigram, bigram and letter shares.  At most
    (alphabet size)^3 numbers, whatever the corpus."""
    tri = np.zeros(A ** 3)
    for row in counts.toLocalIterator():
        tri[row["code"]] = row["n"]
    tri = tri.reshape(A, A, A)
    tri[0, 0, 0] = 0
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p1 = (uni + 1) / (uni.sum() + A)
    p2 = (bi + 5 * p1[None, :]) / (bi.sum(1, keepdims=True) + 5)
    p3 = (tri + 3 * p2[None, :, :]) / (tri.sum(2, keepdims=True) + 3)
    return -np.log2(p3).astype(np.float32)


# -- restoring -----------------------------------------------------------------------------

def lattice(token: str, pairs: bool = False) -> list[list[tuple[str, float]]]:
    """Per observed character what it may stand for: (letter or nothing, cost).  With ``pairs`` two
    equal marks are two letters (``@$$``), else rather one (``id!!ot``)."""
    out: list[list[tuple[str, float]]] = []
    run = 0
    for i, c in enumerate(token):
        run = run + 1 if i and token[i - 1] == c else 1
        options: list[tuple[str, float]] = []
        if run == 1 and c in CODE:
            options.append((c, 0.0))
        elif c.isalpha():
            options.append((c, 0.0 if run < 3 else 3.0))
            if run > 1:
                options.append(("", DROPPED_LETTER if run > 2 or token[i + 1:i + 2] == c else 5.0))
        elif c == ANY:
            options += [(x, HIDDEN + 4.0) for x in LETTERS[:26]]
            options.append(("", HIDDEN))
        else:
            options += [(x, SUBSTITUTED) for x in LOOKALIKE.get(c, "")]
            options.append(("", UNKNOWN if c.isdigit() or c in LOOKALIKE and (run < 2 and 0 < i < len(token) - 1 or pairs and run < 3) else DROPPED_MARK))
        out.append(options)
    return out


Steps = list[list[tuple[str, float]]]


def decode(token: str, costs: np.ndarray, pairs: bool = False) -> str:
    """The cheapest reading of a token: exact Viterbi over the last two letters, linear in its length."""
    return cheapest(lattice(token, pairs), costs)


def cheapest(steps: Steps, costs: np.ndarray) -> str:
    # What can only be dropped costs every reading the same.
    steps = [o for o in steps if len(o) > 1 or o[0][0]]
    if all(len(o) == 1 for o in steps):
        return "".join(o[0][0] for o in steps)
    wide = any(len(o) > 9 for o in steps) or sum(len(o) > 1 for o in steps) > BRANCHES
    return (_on_arrays if wide else _on_states)(steps, costs)


def _on_states(steps: Steps, costs: np.ndarray) -> str:
    cost_of, square = costs.item, A * A
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for options in steps:
        nxt: dict[int, tuple[float, tuple | None]] = {}
        if len(options) == 1 and len(states) == 1:
            (letter, price), = options
            (key, (cost, path)), = states.items()
            at = key * A + CODE.get(letter, OTHER)
            states = {at % square: (cost + price + cost_of(at), (path, letter))}
            continue
        for key, (cost, path) in states.items():
            for letter, price in options:
                if letter:
                    at = key * A + CODE.get(letter, OTHER)
                    to, total, new = at % square, cost + price + cost_of(at), (path, letter)
                else:
                    to, total, new = key, cost + price, path
                if to not in nxt or total < nxt[to][0]:
                    nxt[to] = (total, new)
        states = nxt
    path = min(((cost + cost_of(key * A), n, path) for n, (key, (cost, path)) in enumerate(states.items())))[2]
    out = []
    while path:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def _on_arrays(steps: Steps, costs: np.ndarray) -> str:
    """The same on a table of all (last two letters) states over the letters that occur."""
    codes = sorted({0, *(CODE.get(x, OTHER) for o in steps for x, _ in o if x)})
    place = {c: i for i, c in enumerate(codes)}
    table = costs[np.ix_(codes, codes, codes)].astype(np.float64)
    size = len(codes)

    def run(best: np.ndarray, part: Steps, back: list | None) -> np.ndarray:
        for options in part:
            nxt, way = np.full((size, size), np.inf), np.full((size, size), -1, np.int8)  # -1: dropped
            names = {}
            for letter, price in options:
                if not letter:
                    np.minimum(nxt, best + price, out=nxt)
            letters = [(place[CODE.get(x, OTHER)], x, price) for x, price in options if x]
            if len(letters) == 1:
                (i, x, price), = letters
                total = best + table[:, :, i]
                value = total.min(0) + price
                better = value < nxt[:, i]
                nxt[better, i] = value[better]
                way[better, i] = total.argmin(0)[better]
                names = {i: x}
            elif letters:
                at = [i for i, _, _ in letters]
                total = best[:, :, None] + table[:, :, at]
                first = total.argmin(0)
                value = np.take_along_axis(total, first[None], 0)[0] + np.array([p for _, _, p in letters])
                better = value < nxt[:, at]
                nxt[:, at] = np.where(better, value, nxt[:, at])
                way[:, at] = np.where(better, first, -1)
                names = {i: x for i, x, _ in letters}
            if back is not None:
                back.append((way, names))
            best = nxt
        return best

    best = np.full((size, size), np.inf)
    best[0, 0] = 0.0
    parts = [steps[i:i + CHUNK] for i in range(0, len(steps), CHUNK)]
    before, back = [], []
    for n, part in enumerate(parts):
        before.append(best)
        best = run(best, part, back if n == len(parts) - 1 else None)
    a, b = divmod(int((best + table[:, :, 0]).argmin()), size)
    out = []
    for n in range(len(parts) - 1, -1, -1):
        if n < len(parts) - 1:
            run(before[n], parts[n], back := [])
        for way, names in reversed(back):
            if way[a, b] >= 0:
                out.append(names[b])
                a, b = int(way[a, b]), a
    return "".join(reversed(out))


def suspicious(core: str) -> bool:
    """May be disguised: two equal characters in a row, or something besides letters that can be read."""
    return any(c.isalpha() or c in LOOKALIKE for c in core) if not core.isalpha() else _TWICE.search(core) is not None


def _bounds(marks: str) -> list[int]:
    """Where runs of one character begin, and the end."""
    return [*(i for i, c in enumerate(marks) if not i or marks[i - 1] != c), len(marks)] if marks else [0]


def _cores(token: str) -> list[str]:
    """The token with none, some or all of its runs of edge marks, the longest first: a mark at an
    edge is a letter (``+rash``, ``dumb@$$``) or decoration (``the$$$``).  Edges of more than
    ``EDGE_RUNS`` runs are taken as a whole, or cut in the ``EDGE_RUNS`` runs nearest to the word.
    For fitting, where no feature is known yet; scoring asks ``Readings``, which cuts anywhere."""
    core = token.strip(_MARKS)
    if not core or core[0].isalnum() and core[-1].isalnum():
        return [core]
    first, end = _word_place(core)
    starts, ends = _bounds(core[:first]), _bounds(core[end:])
    if end:
        starts, ends = [0, *starts[1:][-EDGE_RUNS:]], [*ends[:-1][:EDGE_RUNS], ends[-1]]
    else:
        starts, ends = starts[:EDGE_RUNS], ends[-EDGE_RUNS:]
    found = dict.fromkeys(core[a:end + b].strip(_MARKS) for a in starts for b in reversed(ends) if a < end + b)
    return list(found)


def _word_place(core: str) -> tuple[int, int]:
    """First letter or digit and the place after the last; without any, the end and 0."""
    inner = [i for i, c in enumerate(core) if c.isalnum()]
    return (inner[0], inner[-1] + 1) if inner else (len(core), 0)


class Readings:
    """Which parts of a token have a reading with a feature in ``weights``: the character lattice and a
    trie of the features are walked together, so nothing is decoded that can have no weight, and no
    reading that can have one is left out, however many marks surround it."""

    def __init__(self, weights: Iterable[str]) -> None:
        self.root: dict = {}  # letter -> node; "" in a node: a word ends; "^": a beginning is complete
        for f in weights:
            node = self.root
            for c in f.removeprefix("^"):
                node = node.setdefault(c, {})
            node["^" if f[0] == "^" else ""] = {}

    def may(self, core: str) -> bool:
        """Whether the whole core has a reading with a feature."""
        states, last = [self.root], ""
        for c in core:
            again, last = c == last, c
            if c.isalpha():
                nxt = [s[c] for s in states if c in s]
                if again:
                    nxt += states
            elif letters := _letters(c):
                nxt = states + [s[x] for s in states for x in letters if x in s]
            else:
                continue
            if not nxt:
                return False
            states = nxt if len(nxt) < 4 else list({id(s): s for s in nxt}.values())
            for s in states:
                if "^" in s:
                    return True
        return any("" in s for s in states)

    def windows(self, core: str, entries: Container[int], exits: Container[int]) -> Iterator[tuple[int, int]]:
        """The shortest parts from an entry to an exit that have a reading with a feature, one for every
        start.  One walk: every node of the trie keeps the latest entry that leads to it."""
        states: dict[int, tuple[int, dict]] = {}
        begun = told = -1
        last = ""
        for i, c in enumerate(core):
            if i in entries:
                states[id(self.root)] = (i, self.root)
            again, last = c == last, c
            letters = c if c.isalpha() else _letters(c)
            nxt = dict(states) if again or not c.isalpha() else {}
            for entry, node in states.values():
                for x in letters:
                    if (to := node.get(x)) is not None and nxt.get(id(to), (-1, to))[0] < entry:
                        nxt[id(to)] = (entry, to)
            states = nxt
            begun = max((e for e, node in states.values() if "^" in node), default=begun)
            if i + 1 in exits:
                found = max((e for e, node in states.values() if "" in node), default=-1)
                if max(found, begun) > told:
                    yield (told := max(found, begun)), i + 1

    def cores(self, token: str) -> list[str]:
        """The token without edge marks, with all of them, and the shortest parts between runs of edge
        marks, as far as they have a reading with a feature."""
        core = token.strip(_MARKS)
        if not core or core[0].isalnum() and core[-1].isalnum():
            return [core] if core and self.may(core) else []
        first, end = _word_place(core)
        entries = set(_bounds(core[:first]))
        exits = {end + b for b in _bounds(core[end:])} if end else entries
        found = [core[a:b].strip(_MARKS) for a, b in self.windows(core, entries, exits)]
        return list(dict.fromkeys(x for x in (core, core[first:end], *found) if x and self.may(x))) if found else []

    def inside(self, text: str) -> bool:
        """Whether a feature can be read anywhere in the text."""
        return next(self.windows(text, range(len(text)), range(len(text) + 1)), None) is not None


def _letters(mark: str) -> str:
    return LETTERS[:26] if mark == ANY else LOOKALIKE.get(mark, "")


def read_token(token: str, costs: np.ndarray, readings: Readings | None = None) -> list[str]:
    """The words of a lower-cased token: as it stands, and restored if it may be disguised.  With ``readings``
    those that can have no weight are left out."""
    plain = token.strip(_EDGES)
    if plain.isalpha():
        words = [plain]
        if plain == token.strip(_MARKS) and not _TWICE.search(plain):
            return words
    else:
        words = _WORDS.findall(plain)
    short = _LONG_RUN.sub(r"\1\1\1", token)
    for core in _cores(short) if readings is None else readings.cores(short):
        if suspicious(core):
            words.append(decode(core, costs))
            if _TWICE_MARK.search(core):
                words.append(decode(core, costs, pairs=True))
    return words


def _unit(token: str) -> str:
    """The only character of a token besides edge marks, or nothing."""
    if len(token) == 1:
        return token
    core = token.strip(_EDGES) or token.strip(_MARKS)
    return core if len(core) == 1 else ""


def _spaced_runs(tokens: list[str]) -> Iterator[tuple[int, list[str]]]:
    """First token and characters of every run of three single characters or more."""
    run: list[str] = []
    for i, token in enumerate([*tokens, ""]):
        unit = _unit(token) if token and (len(token) < 2 or not (token[0].isalnum() and token[-1].isalnum())) else ""
        if unit:
            run.append(unit)
        elif run:
            if len(run) > 2 and any(c.isalpha() or c in LOOKALIKE for c in run):
                yield i - len(run), run
            run = []


def _parted(units: list[str], costs: np.ndarray) -> str:
    """The cheapest reading with word boundaries between any two characters."""
    steps: Steps = []
    for i, options in enumerate(lattice("".join(units))):
        if i:
            steps.append([("", 0.0), (" ", PARTED)])
        steps.append(options)
    return " ".join(cheapest(steps, costs).split())


def spaced_words(text: str, costs: np.ndarray, readings: Readings | None = None) -> list[str]:
    """Readings of runs of single characters: with word boundaries anywhere; as one word, also without
    the first or last character (``a i d i o t``); and the parts that punctuation closes as one word each.
    With ``readings`` those that can have no weight are left out."""
    words: list[str] = []
    tokens = text.split()
    for first, units in _spaced_runs(tokens):
        joined = "".join(units)
        if readings and not readings.inside(joined):
            continue
        words += _parted(units, costs).split()
        ends = [0, *(i + 1 for i in range(len(units)) if _CLOSED.search(tokens[first + i][1:])), len(units)]
        parts = [joined[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        for part in dict.fromkeys([joined, joined[1:], joined[:-1], joined[1:-1], *parts]):
            if len(part) > 2 and (readings is None or readings.may(part)):
                words.append(decode(part, costs))
    return words


def restored_text(text: str, costs: np.ndarray) -> str:
    """The text with disguised tokens replaced by their readings."""
    found = list(re.finditer(r"\S+", text))
    out, done = [], 0
    for first, units in _spaced_runs([m.group().lower() for m in found]):
        if any(map(str.isalpha, units)):
            head, tail = found[first], found[first + len(units) - 1]
            start, end = head.start() + head.group().lower().find(units[0]), tail.start() + tail.group().lower().rfind(units[-1]) + 1
            out += [text[done:start], _parted(units, costs)]
            done = end
    text = "".join([*out, text[done:]])

    def one(m: re.Match) -> str:
        # One reading only: words and numbers stay as they stand.
        token = m.group().lower()
        plain = token.strip(_EDGES)
        if plain.isalpha() and not _RUN.search(plain) or not any(map(str.isalpha, token)):
            return m.group()
        return (read_token(token, costs) or [m.group()])[-1] if suspicious(token) else m.group()

    return re.sub(r"\S+", one, text)


def features(word: str) -> list[str]:
    """A restored word and its beginnings."""
    return [word, *["^" + word[:n] for n in PREFIXES if len(word) > n]] if len(word) > 2 else []


# -- fitting -------------------------------------------------------------------------------

# Two documents are near copies when COPIES of COORDS coordinates agree; then at most
# COORDS - COPIES bands of BAND differ, and as there are more bands, one at least agrees.
COORDS, COPIES, BAND = 64, 33, 2
_MULTIPLIERS = np.random.default_rng(20240301).integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

@dataclass
class Model:
    costs: np.ndarray
    weights: dict[str, float]
    sampled: int = 0  # labelled documents read
    used: int = 0  # of these, without near copies


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _signature(words: list[str]) -> bytes:
    """``COORDS`` min-hash coordinates (32 bits each) of the 3-word windows."""
    h = np.array([hash_word(w) for w in words], np.uint64)
    if len(h) > 2:
        h = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    h = np.unique(_mixed(h))
    least = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(h), 2048):
        np.minimum(least, np.multiply.outer(h[a:a + 2048], _MULTIPLIERS).min(axis=0), out=least)
    return (_mixed(least) >> np.uint64(32)).astype("<u4").tobytes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def hash_word(word: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def training_rows(docs: DataFrame, labels: DataFrame, costs: np.ndarray, max_train: int) -> DataFrame:
    """``doc_id, toxic, words, m`` (signature) of the sampled labelled documents, each once."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Bounded by max_train rows of two numbers, so the join below may broadcast it.
    sample = cut(known.filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train), "toxic-sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, list[str]] = {}
        for b in (part for whole in batches for part in slices(whole, 1)):
            ids, texts, toxic = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            words, hashes = [], []
            for t in texts:
                low = (t or "").lower()
                tokens = low.split()
                if len(cache) > CACHE:
                    cache.clear()
                seen: set[str] = set()
                for token in set(tokens):
                    if token not in cache:
                        cache[token] = read_token(token, costs)
                    seen.update(cache[token])
                seen.update(spaced_words(low, costs))
                words.append(sorted(seen))
                hashes.append(_signature(tokens))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(toxic, pa.int64()), pa.array(words, pa.list_(pa.string())),
                                              pa.array(hashes, pa.binary())], ["doc_id", "toxic", "words", "m"])

    return rows.select("doc_id", "text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(
        trimmed(run), "doc_id long, toxic long, words array<string>, m binary").dropDuplicates(["doc_id"])


def near_copies(signatures: np.ndarray) -> np.ndarray:
    """A group number per row: rows are connected where ``COPIES`` coordinates agree."""
    parent = np.arange(len(signatures))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = int(parent[i])
        return i

    for a in range(0, COORDS - BAND + 1, BAND):
        key = np.zeros(len(signatures), np.uint64)
        for j in range(a, a + BAND):
            key = _mixed(key + signatures[:, j])
        order = np.argsort(key, kind="stable")
        for bucket in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            # Every row of the bucket looks at those that no row has reached yet, unless they are in one group.
            left = bucket if len(bucket) > 1 and len({root(i) for i in bucket.tolist()}) > 1 else bucket[:0]
            while len(left) > 1:
                reach, left = [int(left[0])], left[1:]
                while reach and len(left):
                    i = reach.pop()
                    near = (signatures[left] == signatures[i]).sum(1) >= COPIES
                    for j in left[near].tolist():
                        parent[root(j)] = root(i)
                    reach += left[near].tolist()
                    left = left[~near]
    return np.array([root(i) for i in range(len(parent))], np.int64)


def one_of_each(rows: DataFrame) -> DataFrame:
    """Of every connected group of near copies the smallest id of each label.  The driver takes a number, a
    label and a signature of the sampled rows, at most ``max_train``."""
    ids, toxic, m = [], [], bytearray()
    for r in rows.select("doc_id", (F.col("toxic") > 0).alias("toxic"), "m").toLocalIterator():
        ids.append(r["doc_id"])
        toxic.append(r["toxic"])
        m += r["m"]
    order = np.argsort(np.array(ids, np.int64))
    group = near_copies(np.frombuffer(bytes(m), "<u4").reshape(-1, COORDS))
    seen: dict[tuple[int, bool], int] = {}
    for i in order.tolist():
        seen.setdefault((int(group[i]), toxic[i]), ids[i])
    keep = rows.sparkSession.createDataFrame([(i,) for i in seen.values()], "doc_id long")
    return rows.join(F.broadcast(keep), "doc_id", "left_semi")


def _evidence(counts: DataFrame, base: float) -> DataFrame:
    """``counts`` (``n`` documents with a feature, ``t`` toxic ones) with ``gain`` (likelihood ratio
    against the base rate) and ``weight`` (smoothed share of toxic documents), over-represented only."""
    n, t = F.col("n").cast("double"), F.col("t").cast("double")
    clean = n - t
    gain = 2 * (t * F.log(t / (n * base)) + F.when(clean > 0, clean * F.log(clean / (n * (1 - min(base, 1 - 1e-9))))).otherwise(0.0))
    return counts.filter((F.col("t") > 1) & (F.col("t") > F.col("n") * base)).withColumn("gain", gain).withColumn(
        "weight", (t + PRIOR * base) / (n + PRIOR))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    costs = char_costs(trigram_counts(docs))
    sampled = cut(training_rows(docs, labels, costs, max_train), "toxic-words")
    rows = cut(one_of_each(sampled), "toxic-train")
    total, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") > 0).cast("long")), F.lit(0))).first()
    if not toxic:
        return Model(costs, {}, sampled.count(), total)
    base, sides = toxic / total, (F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("t"))
    each = rows.select("doc_id", "toxic", F.explode("words").alias("word")).filter(F.length("word") > 2)
    words = cut(each.groupBy("word").agg(*sides), "toxic-features")
    proof = 2 * math.log(max(words.filter("n > 1").count(), 2))
    proven = (F.col("gain") >= proof) & (F.col("weight") >= MIN_WEIGHT)
    found = cut(_evidence(words, base).filter(F.col("gain") >= proof / 3).withColumn("proven", proven), "toxic-found")
    # Beginnings speak for words that are too rare to be proven by themselves, longest first.
    rest = words.join(found.filter("proven"), "word", "left_anti")
    candidates = None
    for size in PREFIXES:
        start = F.substring("word", 1, size)
        sums = rest.filter(F.length("word") > size).groupBy(start.alias("start")).agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
        good = cut(_evidence(sums, base).filter(proven).select("start"), "toxic-starts")
        candidates = good if candidates is None else candidates.unionByName(good)
        rest = rest.withColumn("start", start).join(good, "start", "left_anti").drop("start")
    # The sums count a document once for every word; here once for every beginning.
    unproven = each.join(found.filter("proven"), "word", "left_anti")
    starts = unproven.select("doc_id", "toxic", F.explode(F.array(*[
        F.when(F.length("word") > size, F.substring("word", 1, size)) for size in PREFIXES])).alias("start"))
    per_doc = starts.join(candidates, "start", "left_semi").distinct()
    checked = _evidence(per_doc.groupBy("start").agg(*sides), base).filter(proven)
    # Both tables come from the bounded sample; a few thousand rows in practice.
    weights = {r["word"]: float(r["weight"] if r["proven"] else min(r["weight"], THRESHOLD - 0.01))
               for r in found.select("word", "weight", "proven").toLocalIterator()}
    weights |= {"^" + r["start"]: float(r["weight"]) for r in checked.select("start", "weight").toLocalIterator()}
    return Model(costs, weights, sampled.count(), total)


# -- scoring -------------------------------------------------------------------------------

def _score_texts(texts: pa.Array, model: Model, cache: dict[str, float]) -> list[float]:
    weights, costs, readings = model.weights.get, model.costs, Readings(model.weights)

    def of(words: list[str]) -> float:
        return max((weights(f, 0.0) for w in words for f in features(w)), default=0.0)

    scores = []
    for t in texts:
        low = (t.as_py() or "").lower()
        if len(cache) > CACHE:
            cache.clear()
        best = FLOOR
        for token in set(low.split()):
            s = cache.get(token)
            if s is None:
                # A token of letters has its own word among its readings.
                may = not token.isalpha() or readings.may(token)
                s = cache[token] = of(read_token(token, costs, readings)) if may else 0.0
            if s > best:
                best = s
        if spaced := spaced_words(low, costs, readings):
            best = max(best, of(spaced))
        scores.append(best)
    return scores


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for b in batches:
            scores = _score_texts(b.column(1), model, cache)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, score double")


def restored(docs: DataFrame, costs: np.ndarray) -> DataFrame:
    """``doc_id, restored``: every whole text with disguised words restored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if t is None else restored_text(t, costs) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "restored"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, restored string")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    s = scored(docs, fit(docs, labels))
    return s.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def rejected_removed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that score ``THRESHOLD`` or more, columns unchanged."""
    model = fit(docs, labels)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for whole in batches:
            for b in slices(whole, names.index("text")):
                scores = _score_texts(b.column(names.index("text")), model, cache)
                yield b.filter(pa.array(np.array(scores) < THRESHOLD))

    return docs.mapInArrow(trimmed(run), docs.schema)
