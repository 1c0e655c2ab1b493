"""Quality rules by distribution divergence.

Two histograms of a document are compared with references of its language by the
Jensen-Shannon distance (base 2, square root, so 0 to 1): its character classes, and its
common words (the language's ``COMMON`` most frequent words, and all others).  A document
passes when both distances stay under their thresholds.  Guards: a histogram of a short text says
little, so the character distance counts from ``MIN_CHARS`` characters and the word
distance from ``MIN_WORDS`` words; a language with less than ``MIN_REFERENCE`` words in
the corpus is compared with the pooled reference of all languages.

References are sums over all documents.  Before that come base rules: too few words, or too many
words inside repeated 3-word windows.

Scale: document counts are row-local.  Repeats are found by sorting the hashes of a text's
windows inside its row (n log n, no shuffle).  Reference words are counted with one
map-side combined aggregate over (language, word): a hot word or language costs one row a
task.  The reference table has one row per language and is joined by the planner's size
check.  Native DataFrame operations only.

Defined results: null text is the empty text; null ``lang`` is a language of its own;
repeated rows repeat (and weigh in the references); an empty table gives no rows; other columns
are ignored.  ``lang`` picks the reference; nothing else but the text is looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlab.llm.common import WHITE, cut, text_or_empty

BASE_WORDS, BASE_REPEAT_PERCENT = 50, 50
COMMON = 16
MIN_CHARS, MIN_WORDS, MIN_REFERENCE = 200, 50, 2000
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.22, 0.32
# Character classes besides lower-case ASCII letters and white space, in order; the rest are symbols.
CLASSES = (("upper", r"\p{Lu}"), ("other_letter", r"\p{L}"), ("digit", r"\p{N}"), ("stop", r".,;:'\"()\-"), ("mark", "!?"))
N_CLASSES = len(CLASSES) + 3


def _without(col: Column, chars: str) -> Column:
    return F.regexp_replace(col, F.lit(f"[{chars}]+"), F.lit(""))


def measured(docs: DataFrame) -> DataFrame:
    """Per row: counts, class histogram and words of the whole text."""
    d = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("\x00")).alias("lang"), text_or_empty().alias("text"))
    # Lower-case ASCII letters and blanks are most of a text; the other classes are counted in what is left.
    d = d.withColumn("rest", _without(F.col("text"), "a-z "))
    d = d.withColumn("solid", _without(F.col("rest"), WHITE))
    sizes, col = [F.length("solid")], F.col("solid")
    for _name, chars in CLASSES:
        col = _without(col, chars)
        sizes.append(F.length(col))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{WHITE}]"))
    words = F.filter(F.split("text", f"[{WHITE}]+", -1), lambda w: w != "")
    blanks = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    d = d.select("doc_id", "lang", F.length("text").alias("chars"), (blanks + F.length("rest") - F.length("solid")).alias("white"),
                 (F.length("text") - blanks - F.length("rest")).alias("lower"), F.array(*sizes).alias("left"),
                 (F.length("solid") - F.length(_without(F.col("solid"), r"#*$%&|<>"))).cast("long").alias("n_symbols"),
                 lines.alias("lines"), words.alias("words"))
    counts = F.array(F.col("lower").cast("double"), F.col("white").cast("double"),
                     *[(F.get("left", F.lit(i)) - F.get("left", F.lit(i + 1))).cast("double") for i in range(len(CLASSES))],
                     F.get("left", F.lit(len(CLASSES))).cast("double"))
    return d.select("doc_id", "lang", counts.alias("classes"), (F.col("chars") - F.col("white")).cast("long").alias("word_chars"),
                    "n_symbols", "words", F.size("words").cast("long").alias("n_words"),
                    (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))


def with_repeats(d: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside 3-word windows that stand twice or more in the text."""
    n = F.size("words")
    window = F.transform(F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
                         lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    d = d.withColumn("windows", window)
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn("ordered", F.when(some, F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>")))
    h = lambda i: F.get("ordered", i)["h"]
    again = F.filter("ordered", lambda x, i: F.coalesce(x["h"] == h(i - 1), F.lit(False)) | F.coalesce(x["h"] == h(i + 1), F.lit(False)))
    d = d.withColumn("starts", F.sort_array(F.transform(again, lambda x: x["i"])))
    # A window covers three words, or as many as lie before the next repeated window.
    covered = F.aggregate(F.transform("starts", lambda s, i: F.least(
        F.lit(3), F.coalesce(F.get("starts", i + 1) - s, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", covered).drop("windows", "ordered", "starts")


def references(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """Per language: ``common`` words, reference shares of classes and of common words."""
    d, classes = measured(docs), N_CLASSES
    sums = d.groupBy("lang").agg(F.array(*[F.sum(F.get("classes", F.lit(i))) for i in range(classes)]).alias("classes"))
    words = docs.select(F.coalesce(F.col("lang"), F.lit("\x00")).alias("lang"), F.explode(
        F.split(F.lower(text_or_empty()), f"[{WHITE}]+", -1)).alias("word")).filter("word <> ''")
    counts = cut(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "quality-words")
    sums = sums.join(counts.groupBy("lang").agg(F.sum("n").alias("n_words")), "lang", "left").na.fill(0, ["n_words"])
    pooled = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit("\x01").alias("lang"), "word", "n")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.unionByName(pooled).withColumn("rank", rank).filter(F.col("rank") <= common).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    all_sums = sums.groupBy(F.lit("\x01").alias("lang")).agg(F.sum("n_words").alias("n_words"), F.array(
        *[F.sum(F.get("classes", F.lit(i))) for i in range(classes)]).alias("classes"))
    both = sums.unionByName(all_sums).join(top, "lang", "left")
    shares = lambda a, total: F.transform(a, lambda x: x.cast("double") / total)
    total = F.aggregate("classes", F.lit(0.0), lambda a, x: a + x)
    ref = both.select("lang", "n_words", F.coalesce("top.word", F.array().cast("array<string>")).alias("common"),
                      shares(F.col("classes"), F.greatest(total, F.lit(1.0))).alias("class_ref"),
                      shares(F.coalesce("top.n", F.array().cast("array<bigint>")), F.greatest("n_words", F.lit(1))).alias("word_ref"))
    ref = cut(ref, "quality-references")
    pool = ref.filter(F.col("lang") == "\x01").select(
        F.col("common").alias("p_common"), F.col("class_ref").alias("p_class"), F.col("word_ref").alias("p_word"), F.lit(1).alias("one"))
    # The pooled row replaces languages without enough words.
    rich = F.col("n_words") >= MIN_REFERENCE
    out = ref.filter(F.col("lang") != "\x01").withColumn("one", F.lit(1)).join(F.broadcast(pool), "one", "left")
    return out.select("lang", F.when(rich, F.col("common")).otherwise(F.col("p_common")).alias("common"),
                      F.when(rich, F.col("class_ref")).otherwise(F.col("p_class")).alias("class_ref"),
                      F.when(rich, F.col("word_ref")).otherwise(F.col("p_word")).alias("word_ref"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares."""
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    parts = F.zip_with(p, q, lambda x, y: term(x, (x + y) / 2) + term(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _with_rest(shares: Column) -> Column:
    return F.concat(shares, F.array(F.greatest(F.lit(1.0) - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))))


def judged(docs: DataFrame, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Per row: the base counts, both distances (null under their guard), ``base_failed``, ``kept``."""
    d = with_repeats(measured(docs))
    ref = references(docs)
    longest = F.coalesce(F.array_max(F.transform("common", lambda c: F.octet_length(c))), F.lit(0))
    ref = cut(ref.withColumn("longest", longest), "quality-reference")
    j = d.join(ref, "lang")
    found = F.filter("words", lambda w: (F.octet_length(w) <= F.col("longest")) & F.array_contains("common", F.lower(w)))
    j = j.withColumn("found", F.transform(found, lambda w: F.lower(w)))
    share = lambda n: n / F.greatest(F.col("n_words"), F.lit(1))
    hits = F.transform("common", lambda c: share(F.size(F.filter("found", lambda w: w == c)).cast("double")))
    n_chars = F.aggregate("classes", F.lit(0.0), lambda a, x: a + x)
    # ``found`` is read twice, so the optimizer computes it once instead of inside the function over ``common``.
    j = j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_ref", "word_ref", "classes",
                 n_chars.alias("n_chars"), F.concat(hits, F.array(share(F.col("n_words") - F.size("found")))).alias("word_own"))
    j = j.withColumn("class_own", F.transform("classes", lambda x: x / F.greatest(F.col("n_chars"), F.lit(1.0))))
    class_distance = F.when(F.col("n_chars") >= MIN_CHARS, js_distance(F.col("class_own"), F.col("class_ref")))
    word_distance = F.when(F.col("n_words") >= MIN_WORDS, js_distance(F.col("word_own"), _with_rest(F.col("word_ref"))))
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))
    j = j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 class_distance.alias("class_distance"), word_distance.alias("word_distance"), failed.alias("base_failed"))
    fits = (F.coalesce("class_distance", F.lit(0.0)) <= max_class) & (F.coalesce("word_distance", F.lit(0.0)) <= max_word)
    return j.withColumn("kept", ~F.col("base_failed") & fits)


def verdicts(docs: DataFrame) -> DataFrame:
    return judged(docs).drop("class_distance", "word_distance")


_JS = "CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END"

QUALITY_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce('l' || lang, 'n') AS lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, len(regexp_extract_all(text, '[a-z]')) AS lo,
    len(regexp_extract_all(text, '[\\x20\\x09-\\x0D]')) AS ws, len(regexp_extract_all(text, '\\p{{Lu}}')) AS up,
    len(regexp_extract_all(text, '\\p{{L}}')) AS le, len(regexp_extract_all(text, '\\p{{N}}')) AS di,
    len(regexp_extract_all(text, '[.,;:''"()\\-]')) AS st, len(regexp_extract_all(text, '[!?]')) AS ma,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
c AS (SELECT *, len(words) AS n_words, length(text) AS chars,
    [lo, ws, up, le - lo - up, di, st, ma, length(text) - ws - le - di - st - ma] AS cl FROM w),
e AS (SELECT r, lang, unnest(words) AS word FROM c),
counts AS (SELECT lang, lower(word) AS word, count(*) AS n FROM e GROUP BY 1, 2),
both_ AS (SELECT * FROM counts UNION ALL SELECT 'pool', word, sum(n) FROM counts GROUP BY word),
sums AS (SELECT lang, sum(n) AS n FROM both_ GROUP BY lang),
top AS (SELECT b.lang, word, rank_, b.n / s.n AS q FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank_ FROM both_) b JOIN sums s USING (lang) WHERE rank_ <= {COMMON}),
u AS (SELECT c.*, CASE WHEN coalesce(s.n, 0) >= {MIN_REFERENCE} THEN c.lang ELSE 'pool' END AS el FROM c LEFT JOIN sums s USING (lang)),
k AS (SELECT lang, i, sum(x) AS x FROM (SELECT lang, unnest(cl) AS x, generate_subscripts(cl, 1) AS i FROM c) GROUP BY ALL),
kb AS (SELECT * FROM k UNION ALL SELECT 'pool', i, sum(x) FROM k GROUP BY i),
ks AS (SELECT lang, i, x / sum(x) OVER (PARTITION BY lang) AS q FROM kb),
cd AS (SELECT r, sqrt(greatest(sum({_JS.format(p='p', q='q')}) / 2, 0)) AS class_distance FROM (
  SELECT r, el, unnest(cl) / greatest(chars, 1) AS p, generate_subscripts(cl, 1) AS i FROM u) x JOIN ks ON ks.lang = x.el AND ks.i = x.i GROUP BY r),
hit AS (SELECT u.r, top.word, count(*) AS n FROM e JOIN u ON u.r = e.r JOIN top ON top.lang = u.el AND top.word = lower(e.word) GROUP BY ALL),
bins AS (SELECT u.r, coalesce(h.n, 0) / greatest(u.n_words, 1) AS p, top.q FROM u JOIN top ON top.lang = u.el LEFT JOIN hit h ON h.r = u.r AND h.word = top.word),
rest AS (SELECT u.r, (u.n_words - coalesce(h.n, 0)) / greatest(u.n_words, 1) AS p, greatest(1 - q.q, 0) AS q FROM u
  JOIN (SELECT lang, sum(q) AS q FROM top GROUP BY lang) q ON q.lang = u.el LEFT JOIN (SELECT r, sum(n) AS n FROM hit GROUP BY r) h ON h.r = u.r),
wd AS (SELECT r, sqrt(greatest(sum({_JS.format(p='p', q='q')}) / 2, 0)) AS word_distance FROM (SELECT * FROM bins UNION ALL SELECT * FROM rest) GROUP BY r),
win AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS x FROM (
  SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM c WHERE len(words) >= 3)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (
  SELECT r, unnest([i, i + 1, i + 2]) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, x) AS m FROM win) WHERE m > 1) GROUP BY r),
j AS (SELECT u.doc_id, u.n_words, chars - ws AS word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, u.n_words < {BASE_WORDS} OR 100 * coalesce(rep.n, 0) > {BASE_REPEAT_PERCENT} * u.n_words AS base_failed,
  CASE WHEN chars >= {MIN_CHARS} THEN class_distance ELSE 0 END AS class_distance,
  CASE WHEN u.n_words >= {MIN_WORDS} THEN word_distance ELSE 0 END AS word_distance
  FROM u LEFT JOIN rep USING (r) LEFT JOIN cd USING (r) LEFT JOIN wd USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND coalesce(class_distance, 0) <= {MAX_CLASS_DISTANCE} AND coalesce(word_distance, 0) <= {MAX_WORD_DISTANCE} AS kept FROM j
"""
