"""Merkle manifest of a table of documents: a tree of digests for each source, one over the sources.

A row's leaf is the digest of its fields.  ``FANOUT`` consecutive nodes have one parent, built by
a slot pivot: conditional aggregates spread the children of a parent into ``FANOUT`` columns;
the columns concatenated are hashed to the parent's digest, and the columns without a child's own are
that child's siblings.  ``proofs`` walks down again: each parent hands its path to its children with
their siblings in front, so a leaf arrives with all siblings from its own level to the root.
``folded`` recomputes the root from a leaf and its path, which is how a changed row is found
without reading any other.

Scale: texts are read once and leave as digests.  Positions come from a range partitioning by
(source, doc_id, leaf) and counts per (source, partition); no window covers a source's rows, and a
source with a third of all rows is dealt over as many tasks as its share.  A level has a third of the rows
of the one below, is written (lineage ends there) and is grouped and joined on (source, position), a key of
at most ``FANOUT`` rows; all levels together shuffle a small multiple of the leaves.  The driver sees only the
row count of the largest source, which gives the number of levels.  Native DataFrame operations only.

Defined results: each null field enters its leaf as ``-``; null ``source`` is a source of its own, first in
order; a null ``doc_id`` comes first in its source and is never tampered with; an empty text is ``0:``; texts of any
length are hashed whole.  Rows that share a doc_id are leaves of their own, ordered by leaf; equal rows
are equal leaves at neighbouring positions.  A source of one row has that leaf as its subroot, a table of one
source its subroot as root.  An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlab.llm.common import cut

FANOUT = 3
WALK = 4  # levels walked down in one job
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts concatenated; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf(text: Column) -> Column:
    """Digest of a row's fields, with ``text`` for the text; each field says its length."""
    fields = [(text if f == "text" else F.col(f)).cast("string") for f in FIELDS]
    return digest(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in fields])


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (``tree``, ``order``, ``h``, ...) with ``idx``, the position by (order, h) in the row's tree, and
    ``n``, the rows of that tree."""
    keys = ["tree", "order", "h"]
    place = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", place)
    placed = cut(placed.withColumn("part", F.shiftright("place", 33)), f"merkle-{name}-order")
    here = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = cut(here.select("tree", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"),
                            F.sum("rows").over(tree).alias("n")), f"merkle-{name}-spans")
    return placed.join(spans, ["tree", "part"]).withColumn("idx", F.col("place") + F.col("shift")).drop("place", "part", "shift", "order")


def pivoted(nodes: DataFrame) -> DataFrame:
    """Parents of ``nodes`` (``tree``, ``idx``, ``n``, ``h`` and perhaps ``item``): a column for each slot, and ``h``."""
    slot = F.col("idx") % FANOUT
    spread = lambda c: [F.max(F.when(slot == s, F.col(c))).alias(f"{c}{s}") for s in range(FANOUT)]
    items = spread("item") if "item" in nodes.columns else []
    up = lambda c: F.floor((F.col(c) + FANOUT - 1) / FANOUT) if c == "n" else F.floor(F.col(c) / FANOUT)
    parents = nodes.groupBy("tree", up("idx").alias("idx"), up("n").alias("n")).agg(*spread("h"), *items)
    return parents.withColumn("h", digest(*[F.col(f"h{s}") for s in range(FANOUT)]))


def built(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels over ``leaves`` (``tree``, ``order``, ``h``, ``item``), the leaves first, and the trees' roots
    (``tree``, ``h``, ``depth``)."""
    nodes = cut(numbered(leaves, name), f"merkle-{name}-0")
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels = [nodes]
    while FANOUT ** (len(levels) - 1) < largest:
        parents = pivoted(levels[-1].filter("n > 1"))
        levels.append(cut(parents, f"merkle-{name}-{len(levels)}"))
    roots = None
    for depth, level in enumerate(levels):
        ended = level.filter("n = 1").select("tree", "h", F.lit(depth).alias("depth"))
        roots = ended if roots is None else roots.unionByName(ended)
    return levels, roots


def proofs(levels: list[DataFrame], start: DataFrame) -> DataFrame:
    """The leaves with what ``start`` (``tree``, ``depth``, ``path``, ...) says of their tree, ``path`` lengthened:
    (left, right) siblings of the leaf, of its parent, and so on up."""
    at = lambda depth: start.filter(F.col("depth") == depth).drop("depth").withColumn("idx", F.lit(0).cast("long"))
    carried = [c for c in start.columns if c not in ("tree", "depth", "path")]
    paths = at(len(levels) - 1)
    for depth in range(len(levels) - 1, 0, -1):
        family = levels[depth].drop("h", "n").join(paths, ["tree", "idx"])
        others = lambda r: F.concat_ws("", *[F.col(f"h{s}") for s in r])
        members = []
        for s in range(FANOUT):
            fields = [(F.col("idx") * FANOUT + s).alias("idx"), F.col(f"h{s}").alias("h"),
                      F.struct(others(range(s)).alias("left"), others(range(s + 1, FANOUT)).alias("right")).alias("step")]
            if depth == 1:
                fields.append(F.col(f"item{s}").alias("item"))
            members.append(F.struct(*fields))
        each = F.explode(F.filter(F.array(*members), lambda m: m["h"].isNotNull()))
        below = family.select("tree", "path", *carried, each.alias("child"))
        below = below.select("tree", "child.*", *carried, F.concat(F.array("child.step"), "path").alias("path")).drop("step")
        if depth > 1:
            paths = below.drop("h").unionByName(at(depth - 1))
            if depth % WALK == 0:  # a job of its own: plans stay small, and the levels above are not walked again
                paths = cut(paths, "merkle-paths")
        else:
            paths = below
    alone = levels[0].filter("n = 1").drop("n", "idx").join(at(0).drop("idx"), "tree")
    if len(levels) == 1:
        return alone
    return paths.drop("idx").unionByName(alone)


def folded(h: Column, path: Column) -> Column:
    """The root that follows from a node's digest and its path."""
    return F.aggregate(path, h, lambda acc, step: digest(step["left"], acc, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot`` of its source, ``root``, its ``path``, and ``tampered_leaf`` (the leaf
    without the text's line feeds where 2 divides crc32(doc_id), else null)."""
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, leaf(F.replace("text", F.lit("\n"), F.lit(""))))
    rows = docs.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("tree"), F.col("doc_id").alias("order"),
                       leaf(F.col("text")).alias("h"), F.struct("doc_id", changed.alias("tampered_leaf")).alias("item"))
    levels, roots = built(cut(rows, "merkle-leaves"), "leaves")
    roots = cut(roots, "merkle-subroots")
    sources = roots.select(F.lit("").alias("tree"), F.col("tree").alias("order"), "h",
                           F.struct(F.col("tree"), F.col("h").alias("subroot"), "depth").alias("item"))
    upper, top = built(sources, "sources")
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    start = proofs(upper, top.select("tree", "depth", F.col("h").alias("root"), no_path.alias("path")))
    start = cut(start.select("item.*", "root", "path"), "merkle-source-paths")
    out = proofs(levels, start)
    return out.select("item.doc_id", F.col("h").alias("leaf"), "subroot", "root", "path", "item.tampered_leaf")


def verified(docs: DataFrame) -> DataFrame:
    """Per row: digests, proof, and whether the perhaps tampered row still leads to the root."""
    d = manifest(docs).withColumn("folded_root", folded(F.coalesce("tampered_leaf", "leaf"), F.col("path")))
    return d.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f) for f in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "{text}")) + ")"
# crc32 of a string of ASCII characters, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b:
  list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END)), 4294967295)"""

MANIFEST_SQL = f"""
WITH RECURSIVE rows_ AS (SELECT doc_id, coalesce('s' || source, '') AS tree, {_LEAF.format(text='text')} AS h,
    CASE WHEN {_CRC.format('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")} END AS t FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM rows_),
up(lvl, tree, idx, n, h) AS (SELECT 0, tree, i, n, h FROM leaves
  UNION ALL SELECT lvl + 1, tree, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lvl, tree, idx // 3, n),
sub AS (SELECT tree, h, lvl AS depth, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
top(lvl, idx, n, h) AS (SELECT 0, i, n, h FROM sub
  UNION ALL SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n),
low AS (SELECT l.tree, l.i, u.lvl,
    coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx < l.i // CAST(pow(3, u.lvl) AS BIGINT)), '') AS a,
    coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx > l.i // CAST(pow(3, u.lvl) AS BIGINT)), '') AS b
  FROM leaves l JOIN up u ON u.tree = l.tree AND u.n > 1 AND u.idx // 3 = l.i // CAST(pow(3, u.lvl + 1) AS BIGINT) GROUP BY ALL),
high AS (SELECT s.tree, s.depth + u.lvl AS lvl,
    coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx < s.i // CAST(pow(3, u.lvl) AS BIGINT)), '') AS a,
    coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx > s.i // CAST(pow(3, u.lvl) AS BIGINT)), '') AS b
  FROM sub s JOIN top u ON u.n > 1 AND u.idx // 3 = s.i // CAST(pow(3, u.lvl + 1) AS BIGINT) GROUP BY ALL),
steps AS (SELECT tree, i, lvl, a, b FROM low UNION ALL SELECT l.tree, l.i, h.lvl, h.a, h.b FROM leaves l JOIN high h USING (tree)),
fold(tree, i, lvl, h) AS (SELECT tree, i, 0, coalesce(t, h) FROM leaves
  UNION ALL SELECT f.tree, f.i, f.lvl + 1, sha256(s.a || f.h || s.b) FROM fold f JOIN steps s ON s.tree = f.tree AND s.i = f.i AND s.lvl = f.lvl),
ends AS (SELECT tree, i, max_by(h, lvl) AS folded_root FROM fold GROUP BY ALL),
proof AS (SELECT tree, i, string_agg(a || b, '' ORDER BY lvl) AS p FROM steps GROUP BY ALL)
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, e.folded_root,
  e.folded_root = r.h AS verified
FROM leaves l JOIN sub s USING (tree) JOIN (SELECT h FROM top WHERE n = 1) r ON true JOIN ends e ON e.tree = l.tree AND e.i = l.i
LEFT JOIN proof p ON p.tree = l.tree AND p.i = l.i
"""
