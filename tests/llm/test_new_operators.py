"""Merkle manifest, SimHash fingerprints and spelling variants against plain versions, and their edge cases."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loadlab.llm import merkle, simhash, spelling
from loadlab.llm.common import table
from .test_edge_cases import BASE, LONG, SCHEMA, _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("operator", [merkle.verified, simhash.edited_likeness, spelling.variants])
def test_empty_table(operator, empty):
    assert operator(empty).collect() == []


# Merkle manifest


def _sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _plain_leaf(r, text):
    return _sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])


def _plain_tree(nodes):
    """Root, and each leaf's (left, right) siblings from the bottom up."""
    steps, level, spans = [[] for _ in nodes], list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        ups, up_spans = [], []
        for at in range(0, len(level), 3):
            run = level[at:at + 3]
            for s in range(len(run)):
                for leaf in spans[at + s]:
                    steps[leaf].append(("".join(run[:s]), "".join(run[s + 1:])))
            ups.append(_sha(*run))
            up_spans.append(list(itertools.chain(*spans[at:at + 3])))
        level, spans = ups, up_spans
    return level[0], steps


def _plain_manifest(rows):
    trees = collections.defaultdict(list)
    for r in rows:
        h = _plain_leaf(r, r.text)
        odd = r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 2
        changed = h if odd else _plain_leaf(r, r.text and r.text.replace("\n", ""))
        trees[b"" if r.source is None else b"s" + r.source.encode()].append(((r.doc_id is not None, r.doc_id or 0, h), r.doc_id, h, changed))
    names = sorted(trees)
    below = {name: _plain_tree([x[2] for x in sorted(trees[name])]) for name in names}
    root, above = _plain_tree([below[name][0] for name in names])
    out = []
    for name, high in zip(names, above, strict=True):
        for (_, doc_id, h, changed), low in zip(sorted(trees[name]), below[name][1], strict=True):
            acc = changed
            for left, right in low + high:
                acc = _sha(left, acc, right)
            out.append((doc_id, h, below[name][0], root, _sha(*itertools.chain(*(low + high))), acc, acc == root))
    return out


def _same_rows(df, want):
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_manifest_of_odd_rows(docs):
    _same_rows(merkle.verified(docs), _plain_manifest(docs.collect()))


def test_manifest_of_one_row_and_of_one_source(spark, docs):
    one = docs.filter("doc_id = 9")
    _same_rows(merkle.verified(one), _plain_manifest(one.collect()))
    single = docs.withColumn("source", F.lit("x"))
    _same_rows(merkle.verified(single), _plain_manifest(single.collect()))
    every = docs.withColumn("source", F.concat(F.lit("é"), F.col("doc_id").cast("string")))
    _same_rows(merkle.verified(every), _plain_manifest(every.collect()))


def test_only_changed_rows_fail(spark):
    d = table(spark, SF, "documents")
    out = {r.doc_id: r.verified for r in merkle.verified(d).collect()}
    changed = {r.doc_id for r in d.collect() if "\n" in (r.text or "") and zlib.crc32(str(r.doc_id).encode()) % 2 == 0}
    assert changed and {i for i, ok in out.items() if not ok} == changed


# SimHash


def _chained(*values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v, seed=seed).intdigest()
    return seed


def _plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    votes, n = [0] * 128, 0
    for a, b in zip(["\x02", *words], [*words, "\x03"], strict=True):
        hi = _chained(a.encode(), b.encode())
        lo = _chained(hi.to_bytes(8, "little"), (1).to_bytes(4, "little"))
        n += 1
        for k in range(128):
            votes[k] += (hi << 64 | lo) >> k & 1
    return sum(1 << k for k in range(128) if 2 * votes[k] > n)


def _plain_edits(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), _signed(_chained((r[1] or "").encode()))))
    texts = [r[1] or "" for r in ordered]
    prints = [_plain_print(t) for t in texts]
    out = []
    for k, (doc_id, _) in enumerate(ordered):
        after = (k + 1) % len(ordered)
        half = len(texts[k]) // 2
        edited = texts[k][:len(texts[k]) - half] + texts[after][:half]
        own, changed = prints[k], _plain_print(edited)
        like = lambda x, own=own: 1 - (own ^ x).bit_count() / 128
        out.append((doc_id, len(texts[k]), hashlib.sha256(edited.encode()).hexdigest(), f"{own:032x}", f"{changed:032x}", like(changed), like(prints[after])))
    return out


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_of_odd_rows(docs):
    _same_rows(simhash.edited_likeness(docs), _plain_edits([(r.doc_id, r.text) for r in docs.collect()]))


def test_fingerprints_of_documents(spark):
    d = table(spark, SF, "documents")
    want = _plain_edits([(r.doc_id, r.text) for r in d.collect()])
    _same_rows(simhash.edited_likeness(d), want)
    assert np.mean([r[5] > r[6] for r in want]) > 0.95


def test_one_document_and_null_ids(spark):
    for rows in ([(7, "a b c")], [(None, "x y"), (None, "z")], [(1 << 62, "a"), ((1 << 62) + 1, "b"), ((1 << 62) + 2, "c")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        _same_rows(simhash.edited_likeness(df), _plain_edits(rows))


def test_all_fingerprints_within_the_radius(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(128) for _ in range(20)]
    prints = [c ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(0, 9))) for c in centres for _ in range(30)] + centres * 2
    split = lambda x: (_signed(x >> 64), _signed(x & (1 << 64) - 1))
    df = spark.createDataFrame([(split(p),) for p in prints], "own struct<hi:bigint,lo:bigint>")
    asked = spark.createDataFrame([(i, split(c)) for i, c in enumerate(centres)], "query_id long, own struct<hi:bigint,lo:bigint>")
    count = collections.Counter(prints)
    want = [(i, split(p), n, (c ^ p).bit_count()) for i, c in enumerate(centres) for p, n in count.items() if (c ^ p).bit_count() <= simhash.RADIUS]
    got = [(r.query_id, tuple(r.own), r.n, r.bits) for r in simhash.within(asked, df).collect()]
    assert sorted(got) == sorted(want) and len(want) > 300


# Spelling variants


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _plain_variants(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if _one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return rows


def _plain_words(rows):
    count = collections.Counter()
    for doc_id, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            count[run if h % 199 else run[:at] + run[at + 1:]] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def _variant_rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("cell", [2048, 40])
def test_variants_of_documents(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "LEAST_SAMPLED", 8)
    d = table(spark, SF, "documents")
    want = _plain_variants(_plain_words([(r.doc_id, r.text) for r in d.collect()]))
    assert sorted(_variant_rows(spelling.variants(d)), key=str) == sorted(want, key=str)


def _planted(seed=3):
    rng = random.Random(seed)
    letters = "abcdeéàÿ×ü"
    words = {"".join(rng.choices(letters, k=rng.randrange(6, 9))): rng.choice([5, 5, 6, 30, 200, 4000]) for _ in range(150)}
    for w in list(words):
        for _ in range(6):
            at, c = rng.randrange(len(w)), rng.choice(letters)
            words.setdefault(rng.choice([w[:at] + c + w[at:], w[:at] + c + w[at + 1:], (w[:at] + w[at + 1:]).ljust(6, "q")]), rng.choice([5, 7, 30, 200]))
    # Anagrams share a vector: a cell that cannot be split.
    words |= {"".join(rng.sample("abcdefgh", 8)): 5 for _ in range(200)}
    return words | {"y" * 3000: 9, "y" * 3001: 50, "y" * 2999 + "z": 5}


@pytest.mark.parametrize("cell,sample", [(2048, 50_000), (16, 50_000), (16, 300)])
def test_near_words_in_cells_and_blocks(spark, monkeypatch, cell, sample):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "SAMPLE", sample)
    monkeypatch.setattr(spelling, "LEAST_SAMPLED", 4)
    words = _planted()
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    near = spelling.near_words(df)
    is_form = F.col("near_n") >= 5 * F.col("n")
    forms = near.select("word", F.when(is_form, F.col("near")).alias("form"), "n", "n_near", F.when(is_form, F.col("near_n")).alias("form_n"))
    got = spelling.rooted(forms).select("word", "form", "root", "n", "n_near", "form_n")
    want = _plain_variants(words)
    assert sorted(_variant_rows(got), key=str) == sorted(want, key=str)
    assert any(r[1] and r[1] != r[2] for r in want)


def test_words_of_odd_rows(docs):
    repeated = docs.unionByName(docs).unionByName(docs).withColumn("text", F.concat_ws(" ", "text", F.lit("Äpfel ÄPFEL birnen BIRNEN")))
    want = _plain_variants(_plain_words([(r.doc_id, r.text) for r in repeated.collect()]))
    assert sorted(_variant_rows(spelling.variants(repeated)), key=str) == sorted(want, key=str) and want
    assert BASE and LONG
