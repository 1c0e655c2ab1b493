"""Grouping of spelling variants: words one edit apart, found by K-d trees over letter counts.

A word's vector counts its letters in ``DIMS`` dimensions (code points modulo ``DIMS``).  An inserted or deleted
letter changes the vector by 1 in L1 distance, a replaced one by at most 2, so the words near a given one
lie in a small ball of its own length, the next shorter and the next longer one.  Each length has a tree;
a range search goes down only where a node's box is within reach, and candidates are verified letter by
letter.  A word's form is its commonest near word, if that is ``MIN_RATIO`` times as common; its root follows the forms.

The trees have two parts.  The upper part deals the words of a length into cells of about ``CELL`` words; it
is fitted on the driver from ``max(SAMPLE, words // 256)`` word vectors (hash-chosen; all words while there are
no more), which moves only the borders of cells: every word is a member of one cell and asks every
cell within reach.  A cell that cannot be split (equal vectors) is dealt over blocks by hash, which its askers
all visit.  The lower part is built over a cell's members in the task that holds them.

Scale: texts are read once; runs are counted with map-side combination, so a word with a third of all
runs costs one row a task.  Only words that are common enough (``MIN_N``) go on.  A task holds one
cell and the words that ask it; no pairs leave a task, only the number of near words and the best one, which bounded
alphabets and lengths keep small.  Forms get at least ``MIN_RATIO`` times commoner at each step, so roots take a few
rounds of pointer doubling, each written.

Defined results: null and empty texts have no words; a very long run is a word like any other; a null doc_id counts
as the empty string in the hash that damages runs; repeated rows count again; ties of the commonest near word go
to the smallest in code-point order; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlab.llm.common import cut

DAMAGE, MIN_LENGTH, MIN_N, MIN_RATIO = 199, 6, 5, 5
DIMS = 32
CELL, LEAF, SAMPLE, LEAST_SAMPLED = 2048, 16, 50_000, 32
_FAR = np.int32(1 << 30)
_PAIR_BYTES = 4_000_000


def counted(docs: DataFrame) -> DataFrame:
    """``word``, ``n``: the words of all texts, some runs damaged by a deleted letter, with their occurrences."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    run = F.explode(F.split(lower, "[^a-zÀ-ÿ]+", -1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    # A deletion never makes a run longer.
    runs = runs.withColumn("length", F.length("run")).filter(F.col("length") >= MIN_LENGTH)
    h = F.crc32(F.concat_ws(":", "id", "run"))
    at = (h % F.col("length")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.col("length")))
    words = runs.select(F.when(h % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_N))


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in one array, and the words' lengths."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return codes, np.fromiter(map(len, words), dtype=np.int64, count=len(words))


def letter_counts(words: list[str]) -> np.ndarray:
    codes, sizes = code_points(words)
    at = np.repeat(np.arange(len(words), dtype=np.int64), sizes) * DIMS + codes % DIMS
    return np.bincount(at, minlength=len(words) * DIMS).reshape(len(words), DIMS).astype(np.int32)


class Tree:
    """A K-d tree: nodes split on one dimension (at most ``border`` to the left), leaves are numbered.

    With ``tight`` a node's box bounds its own vectors, else it is the node's whole region, which holds
    whatever is placed there later.
    """

    def __init__(self, vectors: np.ndarray, leaf: int, tight: bool):
        self.lo, self.hi, self.split, self.members = [], [], [], []
        self.n_leaves = 0
        region = (np.zeros(DIMS, np.int32), np.full(DIMS, _FAR, np.int32))
        self._grow(vectors, np.arange(len(vectors)), leaf, tight, *region)
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _grow(self, vectors, idx, leaf, tight, lo, hi) -> int:
        node = len(self.split)
        own = vectors[idx]
        if tight and len(idx):
            lo, hi = own.min(0), own.max(0)
        self.lo.append(lo)
        self.hi.append(hi)
        self.split.append(None)
        self.members.append(None)
        best = None
        if len(idx) > leaf:
            # The border in each dimension that deals the vectors most evenly.
            ordered = np.sort(own, axis=0)
            middle = ordered[(len(idx) - 1) // 2]
            for border in (middle, middle - 1):
                left = (own <= border).sum(0)
                even = np.minimum(left, len(idx) - left)
                dim = int(even.argmax())
                if even[dim] and (best is None or even[dim] > best[0]):
                    best = (int(even[dim]), dim, int(border[dim]))
        if best is None:
            self.split[node] = (-1, self.n_leaves, 0, 0)
            self.members[node] = idx
            self.n_leaves += 1
            return node
        _, dim, border = best
        goes_left = own[:, dim] <= border
        left_hi, right_lo = hi.copy(), lo.copy()
        left_hi[dim], right_lo[dim] = border, border + 1
        left = self._grow(vectors, idx[goes_left], leaf, tight, lo, left_hi)
        right = self._grow(vectors, idx[~goes_left], leaf, tight, right_lo, hi)
        self.split[node] = (dim, border, left, right)
        return node

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, idx = todo.pop()
            dim, border, left, right = self.split[node]
            if dim < 0:
                out[idx] = border
            elif len(idx):
                goes_left = vectors[idx, dim] <= border
                todo += [(left, idx[goes_left]), (right, idx[~goes_left])]
        return out

    def reached(self, vectors: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, its members, the vectors that it is within ``reach`` of) for every leaf with such vectors."""
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, idx = todo.pop()
            v = vectors[idx]
            away = np.maximum(self.lo[node] - v, 0).sum(1) + np.maximum(v - self.hi[node], 0).sum(1)
            idx = idx[away <= reach]
            if not len(idx):
                continue
            dim, border, left, right = self.split[node]
            if dim < 0:
                yield border, self.members[node], idx
            else:
                todo += [(left, idx), (right, idx)]


def reach_of(size: int, other: int) -> int:
    return 2 if size == other else 1


def near_pairs(asks: list[str], members: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (ask, member) exactly one edit apart; members have one length, asks one that differs by at most 1."""
    none = np.zeros(0, np.int64)
    if not asks or not members:
        return none, none
    size, other = len(members[0]), len(asks[0])
    a, m = letter_counts(asks), letter_counts(members)
    reach = reach_of(size, other)
    found_a, found_m = [], []
    for _, own, idx in Tree(m, LEAF, tight=True).reached(a, reach):
        step = max(1, _PAIR_BYTES // (4 * DIMS * len(own)))
        for at in range(0, len(idx), step):
            part = idx[at:at + step]
            i, j = np.nonzero(np.abs(a[part][:, None, :] - m[own][None, :, :]).sum(2) <= reach)
            found_a.append(part[i])
            found_m.append(own[j])
    if not found_a:
        return none, none
    ia, im = np.concatenate(found_a), np.concatenate(found_m)
    ca = code_points(asks)[0].reshape(len(asks), other)
    cm = code_points(members)[0].reshape(len(members), size)
    near = np.zeros(len(ia), bool)
    step = max(1, _PAIR_BYTES // (4 * size))
    for at in range(0, len(ia), step):
        x, y = ca[ia[at:at + step]], cm[im[at:at + step]]
        if size == other:
            near[at:at + step] = (x != y).sum(1) == 1
        else:
            short, long = (x, y) if other < size else (y, x)
            head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
            tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
            near[at:at + step] = head + tail >= short.shape[1]
    return ia[near], im[near]


def fitted(words: DataFrame) -> dict[int, tuple[Tree, list[int]]]:
    """Per length with more than a cell of words: its upper tree, and the blocks of each cell."""
    total = words.count()
    size = max(SAMPLE, total // 256)
    chosen = words
    if total > size:
        chosen = words.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 31)) < int((1 << 31) * (size / total)))

    def vectors(batches):
        for b in batches:
            texts = b.column("word").to_pylist()
            yield pa.RecordBatch.from_pydict({"length": pa.array(list(map(len, texts)), pa.int64()),
                                              "v": pa.array([v.tobytes() for v in letter_counts(texts)], pa.binary())})

    sample = chosen.select("word").mapInArrow(vectors, "length long, v binary").toArrow()
    lengths = np.asarray(sample.column("length"))
    v = np.frombuffer(b"".join(sample.column("v").to_pylist()), np.int32).reshape(-1, DIMS)
    share = max(1.0, total / max(1, len(v)))
    trees = {}
    for length in sorted(set(lengths.tolist())):
        own = v[lengths == length]
        if len(own) * share > CELL:
            tree = Tree(own, max(LEAST_SAMPLED, int(CELL / share)), tight=False)
            cells = [idx for idx in tree.members if idx is not None]
            tree.members = [None if idx is None else np.zeros(0, np.int64) for idx in tree.members]
            trees[length] = tree, [max(1, int(len(idx) * share / (2 * CELL))) for idx in cells]
    return trees


_ROUTED = "length long, cell long, block long, word string, n long"


def _routes(trees: dict[int, tuple[Tree, list[int]]], asking: bool):
    """Rows (length, cell, block, word, n): each word's own place, or all places that it asks."""
    def route(batches):
        for b in batches:
            words = np.array(b.column("word").to_pylist(), dtype=object)
            if not len(words):
                continue
            ns = np.asarray(b.column("n"))
            v, sizes = letter_counts(list(words)), np.fromiter(map(len, words), np.int64, len(words))
            spread = np.asarray(b.column("h"))
            out = []
            for size in set(sizes.tolist()):
                mine = np.nonzero(sizes == size)[0]
                for length in (size - 1, size, size + 1) if asking else (size,):
                    if length < MIN_LENGTH:
                        continue
                    if length not in trees:
                        out.append((mine, np.full(len(mine), length), np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64)))
                        continue
                    tree, blocks = trees[length]
                    if not asking:
                        cell = tree.placed(v[mine])
                        out.append((mine, np.full(len(mine), length), cell, spread[mine] % np.array(blocks)[cell]))
                        continue
                    for cell, _, idx in tree.reached(v[mine], reach_of(length, size)):
                        for block in range(blocks[cell]):
                            out.append((mine[idx], np.full(len(idx), length), np.full(len(idx), cell), np.full(len(idx), block)))
            idx, length, cell, block = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array(cell, pa.int64()), pa.array(block, pa.int64()),
                                              pa.array(words[idx], pa.string()), pa.array(ns[idx], pa.int64())], ["length", "cell", "block", "word", "n"])
    return route


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def search(asks: pa.Table, members: pa.Table) -> pa.Table:
    """Per asking word with near words among the members: how many, and the commonest."""
    words, ns = members.column("word").to_pylist(), members.column("n").to_pylist()
    order = sorted(range(len(words)), key=lambda i: (-ns[i], words[i]))
    words, ns = [words[i] for i in order], [ns[i] for i in order]
    texts = asks.column("word").to_pylist()
    out = {name: [] for name in _FOUND.names}
    for size in sorted(set(map(len, texts))):
        own = [t for t in texts if len(t) == size]
        ia, im = near_pairs(own, words)
        if len(ia):
            count = np.bincount(ia, minlength=len(own))
            best = np.full(len(own), len(words), np.int64)
            np.minimum.at(best, ia, im)
            for i in np.nonzero(count)[0]:
                for name, value in zip(_FOUND.names, (own[i], int(count[i]), ns[best[i]], words[best[i]]), strict=True):
                    out[name].append(value)
    return pa.Table.from_pydict(out, schema=_FOUND)


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, and ``near``, ``near_n``: the commonest near word (null without one)."""
    trees = fitted(words)
    rows = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 31)).alias("h"))
    place = ["length", "cell", "block"]
    members, asks = (rows.mapInArrow(_routes(trees, asking), _ROUTED).groupBy(*place) for asking in (False, True))
    found = asks.cogroup(members).applyInArrow(search, "word string, n_near long, near_n long, near string")
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("rank"), F.col("near"))))
    nothing = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("near_n"), F.lit(None).cast("string").alias("near"))
    every = nothing.unionByName(found.select("word", F.lit(None).cast("long").alias("n"), "n_near", "near_n", "near"))
    out = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    return out.select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.rank")).alias("near_n"))


def rooted(forms: DataFrame) -> DataFrame:
    """``forms`` (``word``, ``form``) with ``root``: the last word of the chain of forms that starts at the word."""
    steps = cut(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        steps = cut(steps.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"),
                                                              F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
        if steps.filter("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return forms.join(steps.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """Per word of the texts: its form (null without one), root, occurrences, near words, and the form's occurrences."""
    words = cut(counted(docs), "spelling-words")
    near = near_words(words)
    is_form = F.col("near_n") >= MIN_RATIO * F.col("n")
    forms = cut(near.select("word", F.when(is_form, F.col("near")).alias("form"), "n", "n_near", F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-forms")
    return rooted(forms).select("word", "form", "root", "n", "n_near", "form_n")


_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_BYTES = "flatten(list_transform(string_split({0}, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))"
_CRC = """xor(list_reduce(list_prepend(4294967295, {0}), lambda c, b:
  list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END)), 4294967295)"""

VARIANTS_SQL = f"""
WITH RECURSIVE runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents),
per AS (SELECT id, run, count(*) AS m FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
hashed AS (SELECT *, {_CRC.format(_BYTES.format("id || ':' || run"))} AS h FROM per),
words AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word,
  CAST(sum(m) AS BIGINT) AS n FROM hashed GROUP BY 1),
w AS (SELECT * FROM words WHERE length(word) >= {MIN_LENGTH} AND n >= {MIN_N}),
del AS (SELECT word, length(word) AS size, i, left(word, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
one AS (SELECT a.word, b.word AS near FROM del a JOIN del b ON a.size = b.size AND a.i = b.i AND a.rest = b.rest AND a.word <> b.word),
two AS (SELECT DISTINCT d.word, w.word AS near FROM del d JOIN w ON d.rest = w.word),
near AS (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT near, word FROM two),
best AS (SELECT near.word, count(*) AS n_near, first(near.near ORDER BY w.n DESC, near.near) AS near, max(w.n) AS near_n FROM near JOIN w ON w.word = near.near GROUP BY 1),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {MIN_RATIO} * w.n THEN near END AS form,
  CASE WHEN near_n >= {MIN_RATIO} * w.n THEN near_n END AS form_n FROM w LEFT JOIN best USING (word)),
chain(word, last_, lvl) AS (SELECT word, word, 0 FROM forms UNION ALL SELECT c.word, f.form, c.lvl + 1 FROM chain c JOIN forms f ON f.word = c.last_ WHERE f.form IS NOT NULL)
SELECT word, form, max_by(last_, lvl) AS root, n, n_near, form_n FROM forms JOIN chain USING (word) GROUP BY ALL
"""
