"""BPE encoding and decoding by batched numpy merge rounds.

A word-end BPE vocabulary (a ``tokenizers`` JSON file whose path is a parameter) is applied
to whole texts.  The distinct words of an Arrow batch that the task has not met yet lie as
symbols of one flat array.  Each round packs neighbouring symbols of the same word into
64-bit keys, finds their ranks by binary search over the sorted keys of the merge table,
takes every word's lowest rank, and merges that pair wherever it stands in the word
(leftmost first).  Words without a mergeable pair leave the array; the rounds end when it
is empty.  Merging all places of a pair at once equals merging one place at a time because
no merge of a token ranks below the merge that makes it; where a vocabulary breaks that
rule (checked on loading) a round merges only the leftmost place.

Words are cut from the text as the vocabulary's normalizer and splitter do.  Texts made of
``PLAIN`` characters take a fast path (lower-casing, NFC where needed, one pattern); texts
with any other character go through the library's own normalizer and pre-tokenizer, so
rules for rare scripts are never re-stated here.  Special tokens standing in a text become
their ids, as in the library.

Scale: a map-only job, one Arrow batch at a time, no shuffle.  The word cache of a task is
cleared at ``CACHE_WORDS`` entries and holds no word over ``LONG_WORD`` characters; the vocabulary (under 50,000 entries) is loaded once a
Python worker.  A lost executor only repeats its tasks.

Defined results: null and empty texts have no tokens and decode to the empty text; a text
of white space alone likewise; repeated rows repeat; other columns are ignored by
``digests`` and kept by ``encoded``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loadlab.llm.common import slices, trimmed

CACHE_WORDS = 150_000
LONG_WORD = 2_000  # characters; such a word is merged alone and not cached
# ASCII, Latin-1 and Latin Extended-A, dashes and quotes, currency signs: no case rule depends on neighbours.
PLAIN = re.compile("[\x00-\x1b\x20-\x7e\xa1-\xac\xae-įı-ňŊ-ž‐-‧‰-⁞₠-₿]*")
NONE = np.int64(1) << np.int64(62)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_characters() -> list[str]:
    """The printable stand-in of every byte: printable Latin-1 stands for itself, the others
    take the characters from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


class WordBpe:
    """One vocabulary: splitting, merging, ids and tokens."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in [*vocab.items(), *special.items()]:
            self.tokens[i] = token
        self.special = {k: np.array([v], "<u4").tobytes() for k, v in special.items()}
        self.special_pattern = re.compile("(" + "|".join(sorted(map(re.escape, special), key=len, reverse=True)) + ")") if special else None
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split).findall
        self.byte_chars = byte_characters()
        self.char_byte = {c: b for b, c in enumerate(self.byte_chars)}
        # First symbols: one per byte, the last byte of a word with the word-end suffix.
        self.inner = np.array([vocab[c] for c in self.byte_chars], np.int64)
        self.final = np.array([vocab[c + end] for c in self.byte_chars], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.width = np.int64(len(self.tokens))
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        born = np.full(len(self.tokens), -1, np.int64)
        np.maximum.at(born, made, np.arange(len(made)))
        self.all_places = bool((born[left] < np.arange(len(made))).all() and (born[right] < np.arange(len(made))).all())
        self.cache: dict[str, bytes] = {}

    # -- words ---------------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """The words of a text, as text (normalized; special tokens as they are)."""
        if self.special_pattern is None or "<|" not in text:
            return self._split(text)
        out: list[str] = []
        for i, part in enumerate(self.special_pattern.split(text)):
            out += [part] if i % 2 else self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return self.words(text.lower())
        if not text:
            return []
        stand_ins = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(map(self.char_byte.__getitem__, w)).decode("utf-8") for w, _ in stand_ins]

    # -- merging -------------------------------------------------------------------------

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of many words at once, each as little-endian unsigned 32-bit integers."""
        raw = [w.encode("utf-8") for w in words]
        sizes = np.array([len(b) for b in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[data[last]]
        owner = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            key = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (owner[:-1] == owner[1:]), self.ranks[at], NONE)
            rank = np.append(rank, NONE)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(owner)))
            open_ = np.repeat(lowest < NONE, lengths)
            if not open_.all():
                done.append((owner[~open_], symbols[~open_]))
                rank, symbols, owner = rank[open_], symbols[open_], owner[open_]
                lengths, lowest = lengths[lowest < NONE], lowest[lowest < NONE]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, lengths))
            # Overlapping places (a a a): every second one of a run counts, from the left.
            new_run = np.append(True, (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]]))
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
            if not self.all_places:
                hit = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])]
            symbols[hit] = self.made[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owners = np.concatenate([o for o, _ in done])
        ids = np.concatenate([s for _, s in done])
        order = np.argsort(owners, kind="stable")
        ids, bounds = ids[order].astype("<u4"), np.searchsorted(owners[order], np.arange(len(words) + 1))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def merge_long(self, word: str) -> bytes:
        """One very long word (a run of letters without a break): rounds over the whole array
        would cost its length times the number of rounds, so its pairs wait in a heap by
        (rank, place) and only the neighbours of a merge are looked up again."""
        raw = np.frombuffer(word.encode("utf-8"), np.uint8)
        start = self.inner[raw]
        start[-1] = self.final[raw[-1]]
        ids, n = start.tolist(), len(start)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, width = self._rank_of, int(self.width)
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of.get(ids[i] * width + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of.get(ids[i] * width + ids[k])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := rank_of.get(ids[h] * width + ids[i])) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    @cached_property
    def _rank_of(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))

    # -- texts ---------------------------------------------------------------------------

    def encode_batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of every text, packed."""
        split = [self.split(t) if t else [] for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        if not self.cache:
            self.cache.update(self.special)
        long = {w for words in split for w in words if len(w) > LONG_WORD}
        fresh = list({w for words in split for w in words if w not in self.cache} - long)
        for a in range(0, len(fresh), 50_000):
            part = fresh[a:a + 50_000]
            self.cache.update(zip(part, self.merge_words(part), strict=True))
        known = self.cache.__getitem__
        merged = {w: self.merge_long(w) for w in long}
        for words in split:
            if long and not long.isdisjoint(words):
                yield b"".join([merged[w] if w in merged else known(w) for w in words])
            else:
                yield b"".join(map(known, words))

    def decode(self, packed: bytes) -> str:
        """The library's text of ids for a vocabulary without a decoder: tokens joined by blanks."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


def encoded(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``token_ids`` (array of int) and ``decoded`` (string) appended."""
    from pyspark.sql import types as T

    kept = [f for f in df.schema.fields if f.name.lower() not in ("token_ids", "decoded")]
    schema = T.StructType([*kept, T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for whole in batches:
            for b in slices(whole, names.index(text)):
                packed = list(bpe.encode_batch(b.column(names.index(text)).to_pylist()))
                ids = pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in packed], pa.list_(pa.int32()))
                cols = [*b.columns, ids, pa.array([bpe.decode(p) for p in packed], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, [*names, "token_ids", "decoded"])

    return df.select(*names).mapInArrow(trimmed(run), schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of tokens, digest of the ids, digest of the decoded text."""
    path = path or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for whole in batches:
            for b in slices(whole, 1):
                packed = list(bpe.encode_batch(b.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([
                    b.column(0),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(bpe.decode(p).encode("utf-8")).hexdigest() for p in packed]),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        trimmed(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


