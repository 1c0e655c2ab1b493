"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib

import pytest

import corpus_pipeline
from loadlab.llm import bpe, chat, line_dedup, mixing, neardup, quality, sharding, token_counts, topk, toxicity

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, __copy int, __source string, __spots string, "
          "line_dedup int, __gone int, shard string, slot string, label int, node int, key string, n int, words string, size int, target int")
LONG = " ".join(f"w{i % 7919}x{i % 13}" for i in range(40_000))
BASE = " ".join(f"word{i}" for i in range(60))


def _rows():
    texts = [None, "", " \t\n\x0b\x0c\r", "one two", BASE, BASE, BASE.replace("word59", "other"), LONG, LONG + " end",
             "a line that is long enough to count\nshort\nx" + "y" * 30, "A Line that is long enough to count  \nz", "a line that is long enough to count",
             "x" * 50_000, "née Ünïcode 中文 😀 <|endoftext|> end", "</s>[INST] &lt; [/INST]"]
    rows = [(i, t, ["en", None, "de"][i % 3], [None, "a", "b"][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows.append((None, BASE, None, None, 3))
    rows.append((None, None, "en", "a", None))
    rows.append(rows[4])
    return [(*r, 1, "s", "p", 2, 3, "sh", "sl", 4, 5, "k", 6, "w", 7, 8) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(10)] + [(None, 1, 1), (3, None, None), (4, 1, 1)],
                                 "doc_id long, quality int, toxic int")


OPERATORS = {
    "sharding": sharding.placed_documents, "token_counts": token_counts.lengths, "near_dedup": neardup.marked,
    "line_dedup": line_dedup.line_digests, "quality": quality.verdicts, "mixing": mixing.taken_words, "bpe": bpe.digests,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(name, docs, empty):
    out = OPERATORS[name](docs).collect()
    assert len(out) == docs.count()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
    assert OPERATORS[name](empty).count() == 0


def test_token_table(docs, empty):
    rows = token_counts.document_lengths(docs).collect()
    counted = [r.n_tokens for r in token_counts.lengths(docs).collect()]
    assert sum(r.n_docs for r in rows) == len(counted) and counted.count(0) == next(r.n_docs for r in rows if r.n_tokens == 0)
    assert token_counts.document_lengths(empty).count() == 0


def test_toxicity(docs, empty, labels):
    out = toxicity.judged(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id: r.held_out for r in out}[None] is False
    assert toxicity.judged(empty, labels).count() == 0
    none = toxicity.judged(docs, labels.filter("false")).collect()
    assert {r.score for r in none} == {toxicity.FLOOR}


def test_null_text_and_defined_results(docs):
    near = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in neardup.marked(docs).collect()}
    assert near[(0, 0)] == (0, True) and near[(2, 0)] == (2, True)
    assert near[(5, 56)] == (4, False) and near[(6, 56)] == (4, False) and near[(None, 56)] == (None, True)
    lines = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.line_digests(docs).collect() if r.doc_id is not None}
    assert lines[0] == (1, 0) and lines[9] == (3, 1) and lines[10] == (2, 1) and lines[11] == (1, 0)
    base = {r.doc_id: r for r in quality.verdicts(docs).collect()}
    assert base[0].n_words == 0 and base[0].base_failed and base[12].word_chars == 50_000
    # The pipeline's stages keep the columns, whatever they are called.
    for stage in (line_dedup.deduplicate, neardup.one_of_each, mixing.mix):
        assert stage(docs).columns == docs.columns
    assert {r.text for r in line_dedup.deduplicate(docs).filter("doc_id = 0").collect()} == {None}


def test_mix_agrees_with_its_ledger(docs):
    want = sorted((str(r.doc_id), r.copies) for r in mixing.ledger(docs).collect())
    got = mixing.mix(docs).groupBy("doc_id", "text").count().collect()
    assert sum(r["count"] for r in got) == sum(c for _, c in want) and max(c for _, c in want) <= 3


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, extra int, rendered string"
    rows = [(1, 1, "user", None, 1, "r"), (1, 1, "user", None, 1, "r"), (1, None, None, "&lt;", 1, "r"), (None, 0, "assistant", "x" * 300_000, 1, "r"),
            (2, 0, "assistant", "</s>[INST] ok [/INST]&amp;&&lt", 1, "r"), (2, 0, "[INST]", "", 1, "r"), (3, 5, "assistant", "é😀", 1, "r")]
    out = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, schema)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(out) == {-1, 1, 2, 3, None}
    assert out[1].turns_sha256 == sha("\n&lt;\n" + "user\n\n" * 2) and out[1].loss_chars == 0
    assert out[2].loss_sha256 == sha("</s>[INST] ok [/INST]&amp;&&lt") and out[3].loss_chars == 2
    assert [r.conv_id for r in chat.digests(spark.createDataFrame([], schema)).collect()] == [-1]
    spans = {r.conv_id: r for r in chat.formatted(spark.createDataFrame(rows, schema)).collect()}
    for r in spans.values():
        own = "".join(t.text for t in r.turns if t.role == chat.ASSISTANT)
        got = "".join(r.formatted[s.start:s.start + s.length] for s in r.loss_spans)
        for plain, code in reversed(chat.ESCAPES):
            got = got.replace(code, plain)
        assert got == own


def test_vectors_of_one_id_count_once(spark):
    rows = [(0, [1.0, 0.0])] + [(1, [9.0, i / 64]) for i in range(300)] + [(i, [1.0 + i / 64, 0.0]) for i in range(2, 100)]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    out = topk.search(vectors, vectors.filter("vec_id = 0"), k=5).collect()
    assert [r.vec_id for r in sorted(out, key=lambda r: r["rank"])] == [1, 99, 98, 97, 96]


def test_vectors_of_one_id_are_dealt_over_blocks(spark):
    vectors = topk.quantised(spark.createDataFrame([(7, [float(i)]) for i in range(400)], "vec_id long, embedding array<double>"))
    index = topk.build_index(vectors, 4 * topk.BLOCK).collect()
    assert len(index) == 4 and max(len(r.ids) // 8 for r in index) < 200


def test_vectors(spark):
    schema = "vec_id long, embedding array<float>, block int, q string"
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.5], 1, "q"), (0, [1.0, 0.5], 1, "q"), (1, [0.5], 1, "q"), (2, [inf, 1.0], 1, "q"), (3, [nan], 1, "q"), (4, None, 1, "q"),
            (5, [None, 1.0], 1, "q"), (6, [], 1, "q"), (7, [-1.0, 0.25, 2.0], 1, "q"), (8, [0.5], 1, "q"), (None, [1.0], 1, "q"), (50, [3e38, 1.0], 1, "q")]
    out = topk.nearest(spark.createDataFrame(rows, schema), k=5).collect()
    first = sorted((r["rank"], r.vec_id, r.score) for r in out if r.query_id == 0)
    assert [v for _, v, _ in first] == [50, 1, 8, 6, 7] and [s for _, _, s in first][1:] == [256 * 128, 256 * 128, 0, -256 * 256 + 128 * 64]
    assert first[0][2] == (1 << 63) - 1 and {r.query_id for r in out} == {0, 50}
    assert topk.nearest(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_on_nasty_rows(spark, docs, labels, tmp_path):
    for t, df in (("documents", docs), ("labels", labels)):
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
    assert len(corpus_pipeline.STAGES) == 5


def test_lines_of_an_id_with_different_texts(spark):
    """Equal to the query's SQL, which works by row, and lines go only from the text that holds them."""
    import duckdb

    common = "a line that stands in many documents"
    rows = [(1, common + "\nb"), (1, "short b stays\nc"), (1, "c\n" + common), (1, common + "\nb"), (2, common), (3, common.upper() + " "), (3, None),
            (3, "z\n" + common), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, line_dedup.line_digests(docs).collect()))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert got == sorted(con.execute(line_dedup.LINES_SQL).fetchall())
    texts = sorted((r.doc_id, r.text or "") for r in line_dedup.deduplicate(docs).collect())
    assert texts == [(1, "b"), (1, "b"), (1, "c"), (1, "short b stays\nc"), (2, ""), (3, ""), (3, common.upper() + " "), (3, "z\n" + common), (4, "")]


def test_result_names_in_another_case(spark):
    df = spark.createDataFrame([(1, "one two", "x", "y", 1)], "doc_id long, text string, Slot string, SHARD string, Decoded int")
    placed = sharding.place(df, ["doc_id"], sharding.shard_names())
    assert sorted(placed.columns) == ["Decoded", "doc_id", "shard", "slot", "text"] and placed.count() == 1
    out = bpe.encoded(df, bpe.default_vocabulary())
    assert out.columns == ["doc_id", "text", "Slot", "SHARD", "token_ids", "decoded"]
    assert out.select("decoded").first()[0]


def test_loss_mask_is_read_from_the_output(spark):
    rows = spark.createDataFrame([(7, 0, "user", "q <s>"), (7, 1, "assistant", "é [INST] &lt;"), (7, 2, "assistant", "😀"), (-1, 5, "assistant", "x")],
                                 "conv_id long, turn long, role string, text string")
    out = chat.formatted(rows).select("conv_id", chat.masked(chat.F.col("formatted"), chat.F.col("loss_spans")).alias("m"))
    assert {r.conv_id: r.m for r in out.collect()} == {7: ["é [INST] &lt;", "😀"], -1: ["x"]}
    # Rows that already have the id -1 join the added conversation.
    assert {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.digests(rows).collect()} == {7: (3, 14), -1: (3, 22)}
