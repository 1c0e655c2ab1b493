"""Near-duplicate documents: min-hash signatures joined through their coordinates.

Documents are sets of distinct 5-word shingles (64-bit hashes).  Equal sets form a class with one
representative; only representatives go on.  A signature has ``COORDS`` min-hash
coordinates, the first ``POSTED`` of which are posted: (coordinate, value) -> documents.

* Prefix merging.  Documents at the threshold agree in at least ``MIN_LIVE`` of the posted
  coordinates (but for a chance of 1.5e-6), so a document with fewer postings that anyone
  shares is done, and of ``L`` shared postings the ``L - MIN_LIVE + 1`` rarest must contain a common one.
  Only these lists are merged.
* Skip merging.  The longer lists and the coordinates that are not posted are never
  merged; a pair found in a list is looked up in both signatures, its collisions
  are counted there, and it stays if at least ``MATCH`` of ``COORDS`` agree (a pair at the threshold
  does not with a chance of 1.2e-6, with the prefix 2.7e-6).  A pair is taken up only
  in the first list that both prefixes share.
* Every pair that stays is confirmed on the full shingle sets
  (100 * intersection >= 75 * union).

No list is expanded into all its pairs.  Round one takes, for every document of a list
(in chunks of ``CHUNK``), its two best partners; confirmed links give provisional
components.  Round two compares only documents of different provisional components: a list
inside one component is finished, and in long lists chunks of one
component are never paired with each other.  Components come from repeated minimum labels with pointer
jumping, on tables.

Scale: the work per document is fixed (one signature, ``POSTED`` postings).  Shuffles carry
hashes, not texts; full sets are built only for documents in a live prefix (a
bitmap of ``BITMAP`` bits, whatever the input, keeps most others from being shingled again; the
exact filter is a join).  A task holds two chunks at most.  Long lists are spread over many tasks.  All
intermediate tables are written to the shared folder.

Defined results: null or empty texts, and texts without words, have no shingles, are their own component and are kept;
fewer than five words are one shingle; rows without ``doc_id`` are linked with nothing and
kept, with a null component; rows repeating a ``doc_id`` are the same document and are
kept or dropped together; other columns are ignored by ``components`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlab.llm.common import cut, trimmed, unused

WORDS, PERCENT = 5, 75
COORDS, POSTED = 128, 32
MIN_LIVE, MATCH = 12, 72
CHUNK = 512
BITMAP = 1 << 22
WORD_CACHE = 200_000

_rng = np.random.default_rng(20240229)
_MULTIPLIERS = _rng.integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = [np.uint64(x | 1) for x in _rng.integers(1 << 62, 1 << 63, WORDS + 2, dtype=np.uint64).tolist()]
_OFFSETS = _rng.integers(1, 1 << 63, POSTED, dtype=np.uint64)


# -- sets and signatures -------------------------------------------------------------------

class _Words(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[WORDS]
    h = (h ^ (h >> np.uint64(29))) * _MIX[WORDS + 1]
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, known: _Words) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles.  ``bytes.lower`` and ``bytes.split`` touch
    exactly A-Z and the six separators."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > WORD_CACHE:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(len(h), WORDS)
    n = len(h) - size + 1
    total = np.full(n, size, np.uint64)
    for j in range(size):
        total = (total ^ (total >> np.uint64(31))) * _MIX[j] + h[j:j + n]
    return np.unique(_finish(total))


def signature(s: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The posted keys (one per posted coordinate) and the packed signature: 32 bits of each
    posted coordinate, 16 bits of the others."""
    least = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 2048):
        np.minimum(least, np.multiply.outer(s[a:a + 2048], _MULTIPLIERS).min(axis=0), out=least)
    keys = _finish(least[:POSTED] + _OFFSETS)
    mixed = _finish(least)
    return keys.view(np.int64), (mixed[:POSTED] >> np.uint64(32)).astype("<u4").tobytes() + (mixed[POSTED:] >> np.uint64(48)).astype("<u2").tobytes()


def profiles(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_shingles``, digest of the set, posted keys, packed signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for b in batches:
            n, d1, d2, posts, sigs = [], [], [], [], []
            for t in b.column(1):
                s = shingles(t.as_py(), known)
                n.append(len(s))
                if len(s):
                    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    d1.append(int.from_bytes(digest[:8], "little", signed=True))
                    d2.append(int.from_bytes(digest[8:], "little", signed=True))
                    keys, sig = signature(s)
                    posts.append(keys)
                    sigs.append(sig)
                else:
                    for x in (d1, d2, posts, sigs):
                        x.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(posts, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "d1", "d2", "posts", "sig"])

    return docs.select("doc_id", "text").mapInArrow(
        trimmed(run), "doc_id long, n_shingles long, d1 long, d2 long, posts array<long>, sig binary")


# -- posting lists -------------------------------------------------------------------------

def prefix_postings(reps: DataFrame) -> DataFrame:
    """``key, node, coord, mask, n``: the rarest shared postings of every document that has
    enough of them; ``mask`` has a bit for each coordinate of the prefix, ``n`` is the list's length."""
    posts = reps.select("node", F.posexplode("posts").alias("coord", "key"))
    shared = cut(posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-keys")
    live = posts.join(shared, "key").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("n", "coord", "key"))).alias("live"))  # at most POSTED entries
    live = live.filter(F.size("live") >= MIN_LIVE).select("node", F.slice(
        "live", F.lit(1), F.size("live") - (MIN_LIVE - 1)).alias("prefix"))
    mask = F.aggregate("prefix", F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x["coord"])))
    lists = cut(live.withColumn("mask", mask).select("node", "mask", F.inline("prefix")).select("key", "node", "coord", "mask"), "near-prefix")
    lengths = cut(lists.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-lengths")
    return cut(lists.join(lengths, "key"), "near-lists")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal (key, part) from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        key, part = b.column("key").to_numpy(), b.column("part").to_numpy()
        edges = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        if held and b.num_rows and (held[-1].column("key")[-1].as_py(), held[-1].column("part")[-1].as_py()) != (int(key[0]), int(part[0])):
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for e in edges.tolist():
            yield pa.Table.from_batches([*held, b.slice(start, e - start)])
            held, start = [], e
        if start < b.num_rows:
            held.append(b.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _matches(nodes, labels, sides, masks, coord, sig) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per row of a group: later rows that match it here, and their collisions."""
    wide = sig[:, :4 * POSTED].copy().view("<u4")
    narrow = sig[:, 4 * POSTED:].copy().view("<u2")
    bits = ((masks[:, None] >> np.arange(POSTED)) & 1).astype(bool)
    n = len(nodes)
    two_sides = sides.min() != sides.max()
    for a in range(0, n, 32):
        b = min(a + 32, n)
        same = wide[a:b, None, :] == wide[None, a:, :]
        hits = same.sum(2, dtype=np.int16) + (narrow[a:b, None, :] == narrow[None, a:, :]).sum(2, dtype=np.int16)
        ok = (hits >= MATCH) & (labels[a:b, None] != labels[None, a:]) & (nodes[a:b, None] != nodes[None, a:])
        ok &= np.arange(a, b)[:, None] < np.arange(a, n)[None, :]
        if two_sides:
            ok &= sides[a:b, None] != sides[None, a:]
        for i, j in zip(*np.nonzero(ok), strict=True):
            ok[i, j] = int(np.argmax(same[i, j] & bits[a + i] & bits[a + j])) == coord
        for i in np.flatnonzero(ok.any(1)):
            at = np.flatnonzero(ok[i])
            yield a + int(i), a + at, hits[i, at]


def _candidates(rows: DataFrame, best: int | None) -> DataFrame:
    """Rows ``key, part, node, label, side, mask, coord, sig`` -> per group the matching documents
    (``others`` empty) and their partners.  ``best``: as many partners of a document at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            names = ("key", "part", "node", "label", "others", "hits")
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)

        for g in _groups(batches):
            if g.num_rows < 2:
                continue
            col = {c: g.column(c).to_numpy() for c in ("node", "label", "side", "mask")}
            sig = np.frombuffer(b"".join(g.column("sig").to_pylist()), np.uint8).reshape(g.num_rows, -1)
            found: dict[int, list[tuple[int, int]]] = {}
            for i, js, hits in _matches(col["node"], col["label"], col["side"], col["mask"], g.column("coord")[0].as_py(), sig):
                for j, h in zip(js.tolist(), hits.tolist(), strict=True):
                    found.setdefault(i, []).append((h, j))
                    if best:
                        found.setdefault(j, []).append((h, i))
            if not found:
                continue
            key, part = g.column("key")[0].as_py(), g.column("part")[0].as_py()
            used: set[int] = set()
            for i, partners in found.items():
                if best:
                    partners = sorted(partners, key=lambda x: (-x[0], col["node"][x[1]]))[:best]
                used.update([i, *(j for _, j in partners)])
                out.append((key, part, int(col["node"][i]), int(col["label"][i]), [int(col["node"][j]) for _, j in partners], [h for h, _ in partners]))
            out += [(key, part, int(col["node"][i]), int(col["label"][i]), [], []) for i in sorted(used)]
            if len(out) > 5000:
                yield flush()
                out = []
        yield flush()

    dealt = rows.repartition("key", "part").sortWithinPartitions("key", "part")
    return dealt.select("key", "part", "node", "label", "side", "mask", "coord", "sig").mapInArrow(
        trimmed(run), "key long, part long, node long, label long, others array<long>, hits array<long>")


def _confirmed(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a, b`` between labels, confirmed on full sets; a link that would join what the group has
    already joined is not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _groups(batches):
            nodes, labels = g.column("node").to_pylist(), g.column("label").to_pylist()
            own = dict(zip(nodes, labels, strict=True))
            full = {n: np.frombuffer(s, np.uint64) for n, s in zip(nodes, g.column("shingles").to_pylist(), strict=True) if s is not None}
            pairs = sorted(((h, n, o) for n, others, hits in zip(nodes, g.column("others").to_pylist(), g.column("hits").to_pylist(), strict=True)
                            for o, h in zip(others or [], hits or [], strict=True)), reverse=True)
            root: dict[int, int] = {}

            def find(x: int, root: dict[int, int] = root) -> int:
                while root.get(x, x) != x:
                    root[x] = root.get(root[x], root[x])
                    x = root[x]
                return x

            links: list[tuple[int, int]] = []
            for _h, x, y in pairs:
                a, b = find(own[x]), find(own[y])
                if a == b:
                    continue
                p, q = full[x], full[y]
                if 100 * min(len(p), len(q)) < PERCENT * max(len(p), len(q)):
                    continue
                common = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * common >= PERCENT * (len(p) + len(q) - common):
                    root[max(a, b)] = min(a, b)
                    links.append((min(a, b), max(a, b)))
            if links:
                # Point every label at the smallest of its group, so that chains stay short.
                stars = sorted({(find(x), x) for x in {v for e in links for v in e} if find(x) != x})
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in stars], pa.int64()), pa.array([x for _, x in stars], pa.int64())], ["a", "b"])

    members = candidates.filter(F.size("others") == 0).join(sets, "node")
    pairs = candidates.filter(F.size("others") > 0).withColumn("shingles", F.lit(None).cast("binary"))
    cols = ["key", "part", "node", "label", "others", "hits", "shingles"]
    rows = members.select(*cols).unionByName(pairs.select(*cols))
    dealt = rows.repartition("key", "part").sortWithinPartitions("key", "part")
    return dealt.mapInArrow(trimmed(run), "a long, b long").distinct()


def minimum_labels(links: DataFrame) -> DataFrame:
    """``node, label``: smallest node reachable, for every node in ``links`` (``a, b``)."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-links")
    labels = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "near-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        step = cut(step, "near-step")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = step.join(jump, "label").select("node", "was", F.least("label", "far").alias("label"))
        labels = cut(jumped, "near-labels")
        if not labels.filter("was <> label").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


# -- full sets -----------------------------------------------------------------------------

def _bit(col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(col)), F.lit(BITMAP))


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, shingles`` (packed) of the given documents, from their texts."""
    words = nodes.select(_bit("node").alias("bit")).groupBy(F.floor(F.col("bit") / 32).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 32).cast("int"))).alias("v"))
    bitmap = np.zeros(BITMAP // 32, np.uint32)
    for r in words.toLocalIterator():  # BITMAP / 32 rows at most
        bitmap[r["w"]] = r["v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for b in batches:
            bit = b.column(2).to_numpy()
            hit = np.flatnonzero((bitmap[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1)
            for a in range(0, len(hit), 256):
                part = b.take(pa.array(hit[a:a + 256]))
                sets = [shingles(t.as_py(), known).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    rows = docs.filter("doc_id is not null").select("doc_id", "text", _bit("doc_id").alias("bit"))
    return rows.mapInArrow(trimmed(run), "node long, shingles binary").join(nodes, "node", "left_semi").dropDuplicates(["node"])


# -- the operator --------------------------------------------------------------------------

def _chunked(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of lists that still hold several labels, dealt to pairs of chunks ``part``; ``side`` tells the chunk."""
    own = cut(lists.join(labels.select("node", F.col("label").alias("l")), "node", "left").select(
        "key", "node", "coord", "mask", F.coalesce("l", "node").alias("label")), "near-own")
    counts = cut(own.groupBy("key", "label").agg(F.count(F.lit(1)).alias("m")), "near-counts")
    keys = cut(counts.groupBy("key").agg(F.count(F.lit(1)).alias("n_labels"), F.sum("m").alias("n"),
                                         F.sum(F.when(F.col("m") <= CHUNK // 2, F.col("m")).otherwise(0)).alias("mixed"))
               .filter("n_labels > 1 and n > 2"), "near-open")
    short = own.join(keys.filter(F.col("n") <= CHUNK).select("key"), "key").select(
        "*", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("side"))
    long = keys.filter(F.col("n") > CHUNK)
    # Chunks of a long list: of one big label each, or of small labels together (label null).
    big = counts.filter(F.col("m") > CHUNK // 2).join(long.select("key"), "key").select(
        "key", "label", F.ceil(F.col("m") / CHUNK).cast("int").alias("k"))
    mixed = long.filter("mixed > 0").select("key", F.lit(None).cast("long").alias("label"), F.ceil(F.col("mixed") / CHUNK).cast("int").alias("k"))
    pieces = big.unionByName(mixed).select("key", "label", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"))
    table = pieces.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("label", "i"))).alias("chunks"))
    table = cut(table, "near-chunks")
    rows = own.join(cut(big, "near-big").withColumnRenamed("k", "kb"), ["key", "label"], "left").join(table, "key").join(
        long.select("key", F.ceil(F.col("mixed") / CHUNK).cast("int").alias("km")), "key")
    label = F.when(F.col("kb").isNotNull(), F.col("label"))
    index = F.pmod(F.xxhash64("node"), F.coalesce("kb", F.greatest("km", F.lit(1)))).cast("int")
    rows = rows.withColumn("own", F.struct(label.alias("label"), index.alias("i")))
    at = F.filter(F.transform("chunks", lambda c, i: F.struct(c.alias("c"), i.alias("i"))), lambda x: x["c"].eqNullSafe(F.col("own")))
    rows = rows.withColumn("side", F.get(at, F.lit(0))["i"].cast("long"))
    partners = F.filter(F.transform("chunks", lambda c, i: F.struct(c["label"].alias("label"), i.cast("long").alias("i"))),
                        lambda x: x["label"].isNull() | F.col("own.label").isNull() | (x["label"] != F.col("own.label")))
    rows = rows.select("key", "node", "coord", "mask", "label", "side", F.explode(partners).alias("p"))
    shift = F.lit(1 << 24).cast("long")
    part = F.least("side", F.col("p.i")) * shift + F.greatest("side", F.col("p.i"))
    return short.unionByName(rows.select("key", "node", "coord", "mask", "label", part.alias("part"), "side"))


def components(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id``."""
    rows = cut(profiles(docs), "near-profiles")
    classes = cut(rows.filter("doc_id is not null and d1 is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "near-classes")
    reps = rows.join(classes.select("d1", "d2", F.col("node").alias("doc_id")), ["doc_id", "d1", "d2"], "left_semi").select(
        F.col("doc_id").alias("node"), "posts", "sig")
    reps = cut(reps, "near-reps")
    lists = prefix_postings(reps)
    linked = cut(lists.select("node").distinct(), "near-nodes")
    sets = cut(full_sets(docs, linked), "near-sets")
    sigs = cut(reps.join(linked, "node", "left_semi").select("node", "sig").dropDuplicates(["node"]), "near-sigs")

    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / CHUNK)).cast("long")
    first = lists.join(sigs, "node").select("key", chunk.alias("part"), "node", F.col("node").alias("label"),
                                            F.lit(0).cast("long").alias("side"), "mask", "coord", "sig")
    links = cut(_confirmed(cut(_candidates(first, 2), "near-first"), sets), "near-links-first")
    labels = minimum_labels(links)

    second = _chunked(lists, labels).join(sigs, "node")
    more = cut(_confirmed(cut(_candidates(second, None), "near-second"), sets), "near-links-second")
    merged = minimum_labels(more).select(F.col("node").alias("label"), F.col("label").alias("final"))
    # Labels of round one that round two joined, and nodes that only round two linked.
    final = labels.join(merged, "label", "left").select("node", F.coalesce("final", "label").alias("component"))
    alone = merged.join(labels.select(F.col("node").alias("label")), "label", "left_anti").select(F.col("label").alias("node"), F.col("final").alias("component"))
    final = cut(final.unionByName(alone), "near-final")
    by_class = cut(classes.join(final, "node", "left").select("d1", "d2", F.coalesce("component", "node").alias("component")), "near-by-class")
    own = rows.select("doc_id", "n_shingles", "d1", "d2")
    named = own.filter("doc_id is not null and d1 is not null").join(by_class, ["d1", "d2"], "left").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    return named.unionByName(own.filter("doc_id is null or d1 is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def marked(docs: DataFrame) -> DataFrame:
    return components(docs).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that another document of their component stands for."""
    name = unused(docs, "__gone")
    gone = cut(marked(docs).filter("not kept").select(F.col("doc_id").alias(name)).distinct(), "near-gone")
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
