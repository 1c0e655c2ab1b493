"""Results against DuckDB SQL or, where SQL has no form, against plain versions and held-out labels."""

import collections
import itertools
import math
import os
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from loadlab.llm import bpe, line_dedup, mixing, neardup, sharding, token_counts, toxicity
from loadlab.llm.common import cut, table
from loadlab.llm.queries import QUERIES
from . import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql(spark, name):
    query, sql = QUERIES[name]
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF, t)}.parquet'")
    df = query(spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_shards_move_little():
    names = sharding.shard_names()
    before, after = sharding.fill(names), sharding.fill(names[:-1])
    share = collections.Counter(before)
    assert max(share.values()) - min(share.values()) <= 1
    stayed = sum(a == b for a, b in zip(before, after, strict=True))
    assert stayed >= 0.8 * len(before)


def test_toxic_held_out(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    out = QUERIES["op2_toxicity"][0](spark, "/root/testdata/sf0.1").collect()
    held = [(labels[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in labels]
    toxic, clean = [p for t, p in held if t], [p for t, p in held if not t]
    assert np.mean(toxic) >= 0.8 and np.mean(clean) <= 0.03


def test_disguises_are_restored(spark):
    words = ["idiot", "stupid", "moron", "pathetic", "trash"]
    plain = " ".join(random.Random(1).choices([*words, "the", "and", "of", "with", "that", "from", "thing"], k=5000))
    costs = toxicity.char_costs(toxicity.trigram_counts(spark.createDataFrame([(plain,)], "text string")))
    for token, want in [("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooot", "idiot"), ("st*pid", "stupid"), ("m0r0n", "moron"),
                        ("p@thetic", "pathetic"), ("tr4sh!", "trash"), ("7rash", "trash"), ("stuuupid", "stupid")]:
        assert want in toxicity.read_token(token, costs), token
    assert toxicity.restored_text("an i d i o t with M0R0N", costs) == "an idiot with moron"
    assert toxicity.read_token("the&&&", costs) == ["the"]


@pytest.fixture(scope="module")
def tox_costs(spark):
    words = ["idiot", "stupid", "moron", "pathetic", "trash", "mutant", "dumbass", "ass"]
    plain = " ".join(random.Random(1).choices([*words, "you", "are", "a", "the", "and", "of", "with", "that", "from", "thing", "rash", "seen"], k=5000))
    return toxicity.char_costs(toxicity.trigram_counts(spark.createDataFrame([(plain,)], "text string")))


@pytest.mark.parametrize("token,plain,want", [
    ("idioot", "idioot", "idiot"), ("stuupid", "stuupid", "stupid"), ("+rash", "rash", "trash"), ("mutan+", "mutan", "mutant"),
    ("(+rash)", "rash", "trash"), ("!!+rash!!!", "rash", "trash"), ("@$$", None, "ass"), ("455", None, "ass"), ("@$$!!!", None, "ass"), ("dumb@$$", "dumb", "dumbass"),
    ("dumb@$$!!!", "dumb", "dumbass"), ("$tup1d!!!", None, "stupid"), ("id!!ot", None, "idiot")])
def test_every_disguise_is_read_beside_the_plain_word(tox_costs, token, plain, want):
    words = toxicity.read_token(token, tox_costs)
    assert want in words and (plain is None or plain in words), words


@pytest.mark.parametrize("text,want", [
    ("you are a i d i o t", {"idiot"}), ("an i d i o t.", {"idiot"}), ("an i d i o t!", {"idiot"}), ('an "i d i o t!!!" here', {"idiot"}),
    ("s t u p i d i d i o t", {"stupid", "idiot"}), ("a s t u p i d i d i o t!", {"stupid", "idiot"}), ("an a s s here", {"ass"}), ("an @ $ $ here", {"ass"}),
    ("an i  d  i  o  t", {"idiot"}), ("i\u00a0d\u00a0i\u2003o\u00a0t", {"idiot"}), ("i d i o t. s t u p i d.", {"idiot", "stupid"}),
    ("i " * 30 + "d i o t", {"idiot"}), ("i. d. i. o. t.", {"idiot"})])
def test_spaced_words_are_read(tox_costs, text, want):
    words = toxicity.spaced_words(text, tox_costs)
    assert want <= set(words), words


@pytest.mark.parametrize("token", ["idi" + "o" * 40 + "t", "i" + "-_" * 20 + "d10t", "1d10t" + "!" * 90])
def test_long_tokens_are_decoded(tox_costs, token):
    words = toxicity.read_token(token, tox_costs)
    assert {"idiot", "stupid"} & set(words), words


def test_decoding_is_exact():
    rng = np.random.default_rng(5)
    costs = rng.uniform(0, 9, (toxicity.A,) * 3)

    def price(word):
        c = [0, 0, *(toxicity.CODE[x] for x in word), 0]
        return sum(costs[tuple(c[i:i + 3])] for i in range(len(c) - 2))

    # The beam of 32 states read the third and fourth at a higher price.
    for token in ("**", "a**", "f**qt", "r**kt", "b1*6", "1!|0$1!|0"):
        steps = toxicity.lattice(token)
        best = min(sum(p for _, p in path) + price("".join(x for x, _ in path)) for path in itertools.product(*steps))
        for how in (toxicity._on_states, toxicity._on_arrays):
            word = how([o for o in steps if len(o) > 1 or o[0][0]], costs)
            assert min(sum(p for _, p in path) for path in itertools.product(*steps) if "".join(x for x, _ in path) == word) + price(word) == pytest.approx(best)
        assert toxicity.decode(token, costs) == word
    long = "1d" * 2000
    steps = [o for o in toxicity.lattice(long) if len(o) > 1 or o[0][0]]
    assert toxicity._on_states(steps, costs) == toxicity._on_arrays(steps, costs)


def test_readings_left_out_have_no_weight(tox_costs):
    weights = {"idiot": 0.9, "stupid": 0.8, "ass": 0.7, "^dumba": 0.9, "^mooro": 0.8}
    rng, counts = random.Random(8), toxicity.Readings(weights)

    def score(words):
        return max((weights.get(f, 0.0) for w in words for f in toxicity.features(w)), default=0.0)

    found = 0
    for _ in range(4000):
        token = "".join(c * rng.choice((1, 1, 2, 4)) + rng.choice(("", "", "", "-", ".", "!")) for c in rng.choice(("idiot", "stupid", "as", "dumbas", "moron", "1d10t", "thing")))
        full = score(toxicity.read_token(token, tox_costs))
        assert score(toxicity.read_token(token, tox_costs, counts)) == full, token
        found += full > 0
    assert found > 500


def test_features_in_a_lattice_are_all_found():
    """The walk of lattice and trie against all paths of the lattice, for whole cores and for parts of marks."""
    weights = {"ass": 0.9, "aas": 0.9, "sil": 0.8, "^asis": 0.8}
    readings, rng = toxicity.Readings(weights), random.Random(4)

    def brute_may(core):
        paths = ("".join(x for x, _ in p) for p in itertools.product(*toxicity.lattice(core)))
        return any(w in weights or "^" + w[:4] in weights for w in paths)

    found = 0
    for _ in range(4000):
        core = "".join(rng.choices("@$!aas|-é", k=rng.randint(1, 8)))
        assert readings.may(core) == brute_may(core), core
        borders = toxicity._bounds(core)
        parts = {(a, b) for a in borders for b in borders if a < b and brute_may(core[a:b])}
        shortest = {(a, b) for a, b in parts if not any((c, d) != (a, b) and a <= c and d <= b for c, d in parts)}
        got = set(readings.windows(core, set(borders), set(borders)))
        assert shortest <= got <= parts, core
        found += len(got)
    assert found > 500


@pytest.mark.parametrize("token", ["!?!?!?!?!?@$$", "@$$" + "!?" * 200, "!?" * 200 + "@$$" + "?!" * 200, "=-" * 3000 + "@$$", "a" + "*" * 50 + "-@$$"])
def test_no_mark_is_too_far_from_a_word(tox_costs, token):
    words = toxicity.read_token(token, tox_costs, toxicity.Readings({"ass": 0.9}))
    assert any("ass" in w for w in words), words


def test_scores_like_the_plain_version(spark, docs, rows):
    """Every score again without tries, caches or skipping: all readings of all tokens of all texts."""
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    want = brute.toxic_scores([r[:2] for r in rows], model.weights, model.costs)
    assert got == pytest.approx(want)
    assert sum(s >= toxicity.THRESHOLD for s in want.values()) > 0


def test_only_near_copies_count_once(spark):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(40)]
    own = [" ".join([*passage, *(f"w{rng.randrange(10 ** 6)}" for _ in range(60))]) for _ in range(200)]
    long = [f"c{i}" for i in range(200)]
    chain = [" ".join([*long[8 * j:], *(f"d{j}x{i}" for i in range(8 * j))]) for j in range(5)]  # neighbours are near copies, the ends are not
    texts = [*own, *chain, *chain[:1] * 3]
    ids = {i: int(i % 2 or 200 <= i < 205) for i in range(len(texts))}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(ids.items()), "doc_id long, toxic int")
    costs = np.ones((toxicity.A,) * 3, np.float32)
    rows = cut(toxicity.training_rows(docs, labels, costs, 1000), "test-copies")
    there = {r.doc_id for r in rows.select("doc_id").collect()}
    kept = {r.doc_id for r in toxicity.one_of_each(rows).collect()}
    assert {i for i in there if i < 200} <= kept  # a shared passage removes nobody
    copies = {i for i in there if i >= 200}
    groups = toxicity.near_copies(np.array([np.frombuffer(toxicity._signature(texts[i].split()), "<u4") for i in sorted(copies)]))
    want = {min(i for i, g in zip(sorted(copies), groups, strict=True) if g == x and ids[i] == y) for x, y in
            {(g, ids[i]) for i, g in zip(sorted(copies), groups, strict=True)}}
    assert kept - set(range(200)) == want and len(want) < len(copies)


def test_near_copies_are_all_connected():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 32, (30, toxicity.COORDS), dtype=np.uint32)
    rows = []
    for b in base:
        for n in (0, 5, 31, 32):
            r = b.copy()
            r[rng.choice(toxicity.COORDS, n, replace=False)] += 1
            rows.append(r)
    rows = np.array(rows)
    group = toxicity.near_copies(rows)
    near = (rows[:, None] == rows[None]).sum(2) >= toxicity.COPIES
    reach = np.linalg.matrix_power(near.astype(float), 8) > 0
    assert ((group[:, None] == group[None]) == reach).all()


def test_pairs_at_the_threshold_are_rarely_lost():
    def below(least, n, p=neardup.PERCENT / 100):
        return sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(least))

    lost = below(neardup.MIN_LIVE, neardup.POSTED), below(neardup.MATCH, neardup.COORDS)
    assert sum(lost) < 2.8e-6


def test_lengths(spark, docs, rows):
    encode = token_counts.encoding(token_counts.default_ranks()).encode_ordinary
    lengths = [len(encode(t or "")) for _, t, _ in rows]
    out = token_counts.document_lengths(docs)
    for r in out.collect():
        over = [n for n in lengths if n > r.n_tokens]
        assert r.n_docs == lengths.count(r.n_tokens) and r.docs_cut == len(over) and r.total_tokens == sum(lengths)
        assert r.tokens_lost == sum(n - r.n_tokens for n in over) and r.docs_from == r.n_docs + len(over)
    limits = {r.context: r for r in token_counts.at_limits(out, [1, 100, 777, 10 ** 6]).collect()}
    assert {c: r.tokens_kept for c, r in limits.items()} == {c: sum(min(n, c) for n in lengths) for c in (1, 100, 777, 10 ** 6)}
    ordered = sorted(lengths)
    assert {r.p: r.n_tokens for r in token_counts.quantiles(out, [0.5, 0.99]).collect()} == {
        p: ordered[int(np.ceil(p * len(ordered))) - 1] for p in (0.5, 0.99)}


def test_components(docs, rows):
    want = brute.components([r[:2] for r in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.marked(docs).collect()}
    assert got == want


def test_components_of_one_large_group(spark, monkeypatch):
    """Many versions of one text (some too far from it, some far from each other), in lists longer than a chunk."""
    monkeypatch.setattr(neardup, "CHUNK", 32)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(150)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    rows += [(300 + i, " ".join(f"z{rng.randrange(40)}" for _ in range(3))) for i in range(100)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.marked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.components(rows)


def test_lines(docs, rows):
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(docs).collect()}
    assert got == brute.dedup_lines([r[:2] for r in rows])


def test_runs_are_levelled(spark):
    store = line_dedup.RunStore(fanout=2)
    held = collections.defaultdict(set)
    for b in range(7):
        lines = [(b * 10 + d, k % (9 + b), -k % 3) for d in range(10) for k in range(d, 40, 7)]
        for d, h1, h2 in lines:
            held[h1, h2].add(d)
        store.add(spark.createDataFrame(lines, "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in store.levels] == [1, 1, 1]
    got = {(r.h1, r.h2): (r.n_docs, r.last_doc) for r in store.frequent(3).collect()}
    assert got == {k: (len(v), max(v)) for k, v in held.items() if len(v) >= 3}


def test_encodings(docs, rows):
    path = bpe.default_vocabulary()
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(docs).collect()}
    assert got == dict(zip((r[0] for r in rows), brute.encodings((r[1] for r in rows), path), strict=True))


def test_words_like_the_library():
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    own, lib, rng = bpe.WordBpe(path), Tokenizer.from_file(path), random.Random(3)
    alphabet = [*map(chr, range(0x3000)), *"😀中文ﬁ'sre", "<|endoftext|>", *"aaabbb   " * 300]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "".join(rng.choices("abcdefgh", k=4000)), "aaaa" * 200]
    for t, packed in zip(texts, own.encode_batch(texts), strict=True):
        ids = lib.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == ids and own.decode(packed) == lib.decode(ids, skip_special_tokens=False)
    own.all_places = False
    fresh = [w for w in own.cache if w not in own.special][:3000]
    assert own.merge_words(fresh) == [own.cache[w] for w in fresh]


def test_pipeline(spark, docs, rows):
    """Every stage against its plain version on what the stage before has kept."""
    kept = cut(corpus_pipeline.remove_toxic(spark, docs, SF), "test-toxic")
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    scores = dict(zip((r[0] for r in rows), toxicity._score_texts([_Text(r[1]) for r in rows], model, {}), strict=True))
    left = [r for r in rows if scores[r[0]] < toxicity.THRESHOLD]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in left)
    lines = brute.dedup_lines([r[:2] for r in left])
    left = [(i, lines[i], s) for i, _, s in left]
    comps = brute.components([r[:2] for r in left])
    left = [r for r in left if comps[r[0]][1] == r[0]]
    times = brute.copies(left)
    want = collections.Counter()
    for (i, _, _), enc in zip(left, brute.encodings((r[1] for r in left), bpe.default_vocabulary()), strict=True):
        if times[i]:
            want[(i, *enc)] = times[i]
    assert collections.Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want
    assert mixing.DRAWS == 8


class _Text:
    def __init__(self, text):
        self.text = text

    def as_py(self):
        return self.text
