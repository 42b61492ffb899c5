"""Collocations, fingerprints and spelling variants against plain Python versions."""

import os
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import QUERIES, collocations, fingerprints, spelling

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")
COLUMNS = "doc_id long, text string, lang string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=60):
    """Few words, so phrases repeat; a boilerplate line; every separator; other letters."""
    rng = random.Random(seed)
    vocabulary = ["The", "the", "of", "été", "naïve", "a-b", "x1", "Ä", "日本", "[it]"]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(vocabulary))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", " \t ", ".", ", ", "\n", "\x0b", ";", "?! "]))
        text = "".join(parts) + rng.choice(["", " this licence holds for all copies of the work as it is", "go go go go go go go go"])
        rows.append((k, text, rng.choice(["en", "fr", None, "und"])))
    return rows + [(None, None, "en"), (90, "", None), (91, "one", "en"), rows[0], rows[0]]


# --- collocations


@pytest.mark.parametrize("order,least,share,seed", [(5, 3, 100, 1), (3, 3, 60, 2), (2, 3, 100, 3)])
def test_collocations(spark, order, least, share, seed):
    rows = corpus(seed)
    documents = spark.createDataFrame(rows, COLUMNS).withColumns({"n": F.lit("x"), "phrase": F.lit(1), "key": F.lit(2)})
    found = collocations.top_collocations(documents.repartition(5), order=order, min_count=least, share=share, top=7)
    expected = brute.collocations([(t, x) for _, t, x in rows], order, least, 7, share)
    assert expected
    assert rows_of(found) == sorted(expected, key=repr)


def test_flows_are_the_counts_of_all_frequent_phrases(spark):
    rows = corpus(9)
    graph = collocations.build_graph(spark.createDataFrame(rows, COLUMNS).repartition(4), min_count=3)
    counts, totals = brute.phrase_counts([(t, x) for _, t, x in rows], 5)
    for size in range(2, 6):
        expected = {(x, " ".join(p)): n for (x, p), n in counts.items() if n >= 3 and len(p) == size}
        assert {(r.lang, r.phrase): r.n for r in graph.phrases(size).collect()} == expected
    assert {r.lang: r.n for r in graph.totals.collect()} == totals


def test_paths_are_whole_passages(spark):
    passage = "all of this text may be used by anyone for any end at all"
    texts = [f"{passage}. {k} other {k} words" for k in range(6)]
    texts += ["r1 r2 r3 r4 r5 r1 r2 r3 r4 r5 r1 r2 r3 r4 r5 r1 r2 r3 r4"] * 3  # a ring
    texts += ["one two three four five six left", "one two three four five six right"] * 4  # a fork
    documents = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], COLUMNS)
    graph = collocations.build_graph(documents, min_count=3)
    paths = collocations.compact(graph)
    found = {r.passage: r.n for r in paths.collect()}
    assert found[passage] == 6
    assert found["one two three four five six"] == 8
    assert found["three four five six left"] == found["three four five six right"] == 4
    # every edge lies in one path
    edges = sorted(r.phrase for r in graph.phrases(5).collect())
    windows = [" ".join(p.split()[k : k + 5]) for p in found for k in range(len(p.split()) - 4)]
    assert sorted(windows) == edges
    inner = {r.phrase for r in collocations.inner_nodes(paths).collect()}
    assert "of this text may" in inner and "three four five six" not in inner and "all of this text" not in inner


def test_score_beyond_64_bits(spark):
    graph = collocations.Graph(
        spark.createDataFrame([("en", "a", 10**12), ("en", "b", 3)], "lang string, word string, n long"),
        spark.createDataFrame([("en", 10**13 + 1)], "lang string, n long"),
        {2: spark.createDataFrame([("en", "a b", 10**12 - 1)], "lang string, phrase string, n long")},
        1,
    )
    scored = collocations.score_phrases(graph, None).first()
    assert scored.score == 1000 * (10**12 - 1) * (10**13 + 1) // (3 * 10**12)


def test_collocations_of_an_empty_table(spark):
    assert collocations.top_collocations(spark.createDataFrame([], COLUMNS)).collect() == []
    assert collocations.top_collocations(spark.createDataFrame([(1, None, None), (2, "a b", None)], COLUMNS)).collect() == []


def test_long_piece(spark):
    """A text of one piece, larger than a chunk."""
    text = "alpha beta gamma delta " * 120_000
    found = collocations.top_collocations(spark.createDataFrame([(1, text, "en")], COLUMNS), top=50).collect()
    n = 480_000
    assert {(r.phrase, r.a, r.n) for r in found if len(r.phrase.split()) == 5 and r.phrase.startswith("alpha")} == {
        ("alpha beta gamma delta alpha", 119_999, n)
    }


# --- fingerprints


def digest(text):
    return fingerprints._digests_of([text])[0]


@pytest.mark.parametrize("text", ["", "a", "ab", "abc", "The end of the tale. " * 9, "日本語のテキスト" * 40, "x" * 5000])
def test_digest(text):
    assert digest(text)[1:].tolist() == brute.quartile_digest(text, fingerprints.BUCKETS)
    whole = fingerprints.encoded(digest(text)[None])[0]
    assert (fingerprints.decoded(whole) == digest(text)).all()


def test_digests_of_a_chunk_do_not_mix():
    texts = ["", "one text", None, "another, longer text " * 50, "", "x"]
    import pyarrow as pa

    from tallyframe.llm import arrow_text as at

    together = fingerprints.digests(*at.flat(pa.array(texts, pa.string())))
    assert (together == np.stack([digest(t or "") for t in texts])).all()


def test_slices_add_up(monkeypatch):
    text = "".join(random.Random(1).choices("abcdefgh ", k=3000))
    whole = digest(text)
    monkeypatch.setattr(fingerprints, "SLICE", 7)
    assert (digest(text) == whole).all()


def test_likeness_is_bounded():
    texts = ["", "a", "short text", "short texts", "other words entirely " * 30, "other words entirely " * 31]
    codes = np.stack([digest(t) for t in texts])
    for k in range(len(texts)):
        near = fingerprints.likeness(codes, np.repeat(codes[k][None], len(texts), 0))
        assert near[k] == 1 and (near >= 0).all() and (near <= 1).all()
    assert fingerprints.likeness(codes[4:5], codes[5:6])[0] > 0.8 > 0.3 > fingerprints.likeness(codes[4:5], codes[3:4])[0]


def expected_pairs(rows):
    """Rows in order, each with the next text."""
    for k, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        yield doc, len(text), brute.sha(text[: len(text) - half] + following[:half]), following


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next_documents(spark, parts):
    rng = random.Random(parts)
    rows = [(k, "".join(rng.choices("abcé日 \n", k=rng.choice([0, 1, 2, 7, 300])))) for k in range(0, 120, 2)]
    rows = [(None, "no id"), *rows, (500, None), (501, "the last one")]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    documents = spark.createDataFrame(shuffled, "doc_id int, text string").withColumns(
        {"part": F.lit(1), "edge": F.lit("a"), "tie": F.lit(2), "fingerprint": F.lit("z"), "following": F.lit(3)}
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = {r.doc_id: r for r in fingerprints.compare_with_next(documents.repartition(3)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == len(rows)
    texts = dict(rows)
    for doc, n, sha, following in expected_pairs(rows):
        r = found[doc]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        own = digest(texts[doc] or "")
        changed = digest(fingerprints.edited(texts[doc] or "", following))
        assert r.fingerprint == fingerprints.encoded(own[None])[0]
        assert r.edited_fingerprint == fingerprints.encoded(changed[None])[0]
        assert r.near_edited == fingerprints.likeness(own[None], changed[None])[0]
        assert r.near_next == fingerprints.likeness(own[None], digest(following)[None])[0]


def test_repeated_rows_and_small_tables(spark):
    schema = "doc_id string, text string"
    assert fingerprints.compare_with_next(spark.createDataFrame([], schema)).collect() == []
    one = fingerprints.compare_with_next(spark.createDataFrame([("a", "abcdef")], schema)).collect()
    assert [(r.n_chars, r.edited_sha256, r.near_next) for r in one] == [(6, brute.sha("abcabc"), 1.0)]
    same = spark.createDataFrame([("a", "abcd")] * 500 + [("b", "xyz")], schema).repartition(8)
    found = fingerprints.compare_with_next(same).collect()
    assert len(found) == 501
    assert sorted({r.edited_sha256 for r in found}) == sorted({brute.sha("abab"), brute.sha("abxy"), brute.sha("xya")})
    assert sum(r.near_next < 1 for r in found) == 2


def test_fingerprint_column(spark):
    documents = spark.createDataFrame([(1, "some text", "old"), (2, None, None)], "id int, body string, fingerprint string")
    found = {r.id: r.fingerprint for r in fingerprints.fingerprint(documents, "body").collect()}
    assert found == {1: fingerprints.encoded(digest("some text")[None])[0], 2: fingerprints.encoded(digest("")[None])[0]}


@needs_tables
def test_edited_texts_are_nearer_than_the_next(spark):
    rows = QUERIES["op12_quartile_fingerprints"](spark, "/root/testdata/sf0.01").collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 1000
    assert sum(r.near_edited > r.near_next for r in rows) > 0.98 * len(rows)


# --- spelling variants


def found_variants(spark, rows, **more):
    documents = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("a"), "word": F.lit(1)})
    return sorted((tuple(r) for r in spelling.spelling_variants(documents.repartition(3), **more).collect()), key=lambda r: r[0])


@pytest.mark.parametrize("seed,min_length,min_count", [(1, 6, 5), (2, 1, 1)])
def test_spelling_variants(spark, seed, min_length, min_count):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abéÿ", k=rng.randint(1, 8))) for _ in range(30)]
    rows = []
    for k in range(150):
        w = [rng.choice(stems[: rng.randint(1, 30)]) for _ in range(12)]
        w.append('beyÿab' + rng.choice(['', '', '', '', 'a', 'b', 'é']))
        if rng.random() < 0.5:
            i = rng.randrange(len(w[0]))
            w[0] = w[0][:i] + rng.choice(["", "a", "ÿÿ", "b" + w[0][i]]) + w[0][i + 1 :]
        rows.append((k, rng.choice([" ", "-", "1", "日", "Ā"]).join(w).replace("a", rng.choice("aA"), 2)))
    rows += [(None, "abababé " * 9), (900, None), (901, ""), (3, rows[3][1]), (3, rows[3][1]), (902, "Öä" * 3000)]
    found = found_variants(spark, rows, min_length=min_length, min_count=min_count, deleted=7)
    assert found == brute.spelling(rows, min_length, min_count, 5, 7)
    assert any(r[1] for r in found) and any(r[4] > 1 for r in found)


def test_forms_follow_to_the_last(spark):
    counts = [("aaaaaa", 1), ("aaaaab", 5), ("aaaabb", 25), ("aaabbb", 125), ("aabbbb", 625), ("abbbbb", 3125), ("bbbbbb", 3126)]
    words = spark.createDataFrame(counts + [("zzzzzz", 9)], "word string, n long")
    found = {r.word: r for r in spelling.group_variants(words).collect()}
    assert {found[w].root for w, _ in counts[:6]} == {"abbbbb"}
    assert found["aabbbb"].form == "abbbbb" and found["abbbbb"].form is None and found["abbbbb"].n_near == 2
    assert tuple(found["zzzzzz"]) == ("zzzzzz", None, "zzzzzz", 9, 0, None)


def test_ties_take_the_smallest_form(spark):
    words = spark.createDataFrame([("aaaaaa", 1), ("aaaaaz", 9), ("aaaaaé", 9), ("aaaaac", 9)], "word string, n long")
    assert {r.word: r.form for r in spelling.group_variants(words).collect()}["aaaaaa"] == "aaaaac"


def test_near_words_of_shared_beginnings_and_ends(spark):
    """Long words that differ at either end, runs of one letter, and a word inside another."""
    words = {"x" * n for n in (6, 7, 8, 10)} | {"station" * 2 + e for e in ("", "s", "t", "ss")} | {"y" + "x" * 6, "x" * 6 + "y", "x" * 3 + "y" + "x" * 3}
    table = spark.createDataFrame([(w,) for w in sorted(words)] + [(None,), ("xxxxxx",)], "word string")
    found = {(r.word, r.near) for r in spelling.near_words(table).collect()}
    assert found == {(w, x) for w in words for x in brute.neighbours(w, dict.fromkeys(words))}


def test_variants_of_an_empty_table(spark):
    assert found_variants(spark, []) == []
    assert found_variants(spark, [(1, None), (2, "short ones only")]) == []


@needs_tables
def test_spelling_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = sorted((tuple(r) for r in QUERIES["op13_spelling_variants"](spark, FOLDER).collect()), key=lambda r: r[0])
    assert found == brute.spelling(rows) and found
