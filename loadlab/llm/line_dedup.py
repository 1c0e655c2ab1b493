"""Line deduplication over levelled sorted runs of line keys.

A line's key is the line without white space at its ends, A-Z lower-cased; keys travel as
two 64-bit hashes.  Documents arrive in batches.  The store is a list of runs, each written
sorted by key hash within its files, in levels: a batch adds one run to level 0, and as soon as
a level holds ``FANOUT`` runs they are merged into one run of the next level, so a key is
rewritten at most once a level and a batch meets few runs.

A batch is first aggregated to one row per key (documents holding it, largest document).
It is merge-anti-joined with the runs: keys the store lacks are added as new; keys it knows
are added as repeats.  At the end
the repeats are added to the runs' counts, and the keys to drop are joined back to the lines.

Scale: the lines are hashed once and written as narrow rows (no text); a batch is a folder
of that table.  Counting combines on the map side, so a line found in a third of all documents
costs one row a task.  The join that brings dropped keys back to the lines reads both sides from
tables, so AQE can split the partition of a hot key.  Texts are touched twice: to hash the lines
and to rebuild documents that lose lines, which are joined by ``doc_id``.  Native
DataFrame operations throughout.

Defined results: null or empty text is one empty line; a key is counted once per document
however often it stands there; rows repeating a ``doc_id`` are one document for the counts, whatever their
texts, and each row loses the lines of its own text; ties cannot arise (the largest id keeps its lines, in
every row that has the id); texts and lines of any length are read whole; rows without ``doc_id``
keep all lines and count for nothing; an empty table gives no rows; other columns are kept by
``deduplicate`` (working columns take names that the input does not have).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlab.llm.common import WHITE_CHARS, cut, text_or_empty, unused

MIN_CHARS, MIN_DOCS = 20, 3
BATCHES, FANOUT = 4, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.trim(line, F.lit(WHITE_CHARS)), UPPER, LOWER)


def _hashes(docs: DataFrame, min_chars: int) -> Column:
    """Per line of the text: its key's hashes, null for keys that are too short."""
    def one(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.length(key) >= min_chars, F.struct(
            F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")))
    return F.transform(F.split(text_or_empty(), "\n", -1), one)


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """``doc_id, version, spot, h1, h2, batch``: one row per line with a key long enough and its 0-based
    position; ``version`` tells different texts of one id apart."""
    lines = docs.filter("doc_id is not null").select(
        "doc_id", F.xxhash64("text").alias("version"), F.posexplode(_hashes(docs, min_chars)).alias("spot", "h")).filter("h is not null")
    return lines.select("doc_id", "version", "spot", "h.h1", "h.h2", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"))


def merge_runs(runs: list[DataFrame]) -> DataFrame:
    """One row per key: sums of counts, largest document, number of times it was added as new."""
    rows = runs[0]
    for r in runs[1:]:
        rows = rows.unionByName(r)
    return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))


class RunStore:
    """Levelled runs of ``h1, h2, n_docs, last_doc``."""

    def __init__(self, fanout: int = FANOUT) -> None:
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.repeats: list[DataFrame] = []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def _sorted(self, rows: DataFrame, name: str) -> DataFrame:
        return cut(rows.sortWithinPartitions("h1", "h2"), name)

    def add(self, batch: DataFrame) -> None:
        """Add a batch of ``doc_id, h1, h2`` rows (one per document and key at least)."""
        own = batch.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(
            F.count("one").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        own = self._sorted(own, "lines-run")
        if self.levels:
            fresh = own
            for run in self.runs():
                fresh = fresh.join(run.hint("merge"), ["h1", "h2"], "left_anti")
            fresh = self._sorted(fresh, "lines-fresh")
            repeated = own.join(fresh.hint("merge"), ["h1", "h2"], "left_anti")
            self.repeats.append(self._sorted(repeated, "lines-repeat"))
            self._push(0, fresh)
        else:
            self._push(0, own)

    def _push(self, level: int, run: DataFrame) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._sorted(merge_runs(self.levels[level]), "lines-level")
            self.levels[level] = []
            self._push(level + 1, merged)

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys held by at least ``min_docs`` documents, with their largest document."""
        first = self.runs()
        if not self.repeats:
            return merge_runs(first).filter(F.col("n_docs") >= min_docs)
        again = merge_runs(self.repeats)
        # The batch that brought a key first is in exactly one run; all later ones are in the repeats.
        seen = first[0]
        for r in first[1:]:
            seen = seen.unionByName(r)
        r = again.select("h1", "h2", F.col("n_docs").alias("r_docs"), F.col("last_doc").alias("r_last"))
        both = seen.join(r, ["h1", "h2"], "left")
        return both.select("h1", "h2", (F.col("n_docs") + F.coalesce("r_docs", F.lit(0))).alias("n_docs"),
                           F.greatest("last_doc", F.coalesce("r_last", "last_doc")).alias("last_doc")).filter(
                               F.col("n_docs") >= min_docs)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, version, spots``: positions of the lines each text loses (only texts that lose some)."""
    lines = cut(hashed_lines(docs, min_chars, batches), "lines")
    store = RunStore(fanout)
    for b in range(batches):
        store.add(lines.filter(F.col("batch") == b).select("doc_id", "h1", "h2"))
    frequent = cut(store.frequent(min_docs).select("h1", "h2", "last_doc"), "lines-frequent")
    lost = lines.join(frequent, ["h1", "h2"]).filter(F.col("doc_id") < F.col("last_doc"))
    return lost.select("doc_id", "version", "spot").groupBy("doc_id", "version").agg(F.collect_set("spot").alias("spots"))


def _deduplicated(docs: DataFrame, info: str, **options: int) -> DataFrame:
    doc, version, spots = unused(docs, "__doc"), unused(docs, "__version"), unused(docs, "__spots")
    lost = dropped_lines(docs, **options).select(F.col("doc_id").alias(doc), F.col("version").alias(version), F.col("spots").alias(spots))
    lines = F.split(text_or_empty(), "\n", -1)
    # Rows without an id lose nothing; kept out of the join, they cannot pile up on one key.
    named, unnamed = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
    same = (F.col("doc_id") == F.col(doc)) & (F.xxhash64("text") == F.col(version))
    joined = named.join(lost, same, "left").drop(doc, version).unionByName(
        unnamed.withColumn(spots, F.lit(None).cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(spots))
    kept = F.transform(stay, lambda i: F.get(lines, i))
    text = F.when(F.col(spots).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    counts = F.struct(F.size(lines).cast("long").alias("n_lines"),
                      F.coalesce(F.size(F.col(spots)), F.lit(0)).cast("long").alias("n_dropped"))
    return joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns], counts.alias(info))


def deduplicate(docs: DataFrame, **options: int) -> DataFrame:
    """``docs`` with ``text`` without the dropped lines; a null text stays null."""
    info = unused(docs, "line_dedup")
    return _deduplicated(docs, info, **options).drop(info)


def line_digests(docs: DataFrame) -> DataFrame:
    out = _deduplicated(docs.select("doc_id", "text"), "line_dedup")
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
                      F.sha2(text_or_empty().cast("binary"), 256).alias("kept_sha256"))


LINES_SQL = """
WITH l AS (SELECT doc_id, row_number() OVER () AS row_, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
e AS (SELECT row_, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM l),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
f AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(k.doc_id < f.last_doc, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT max(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY row_
"""
