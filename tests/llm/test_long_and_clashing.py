"""Very long words and texts, clashing column names, empty tables of the pipeline."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import riskloom.llm.language_id as L
from riskloom.llm.line_dedup import dedup_lines
from riskloom.llm.ngram_join import keep_one_of_each
from riskloom.llm.pii import propose


def plain_sums(word, vocab, p):
    """Forward logs by definition, column by column."""
    number = {v: i for i, v in enumerate(vocab)}
    out = []
    for lang in range(p.shape[1]):
        alpha = [0.0] + [-math.inf] * len(word)
        for e in range(1, len(word) + 1):
            terms = [alpha[s] + math.log(p[number[word[s:e]], lang]) for s in range(max(0, e - 8), e) if word[s:e] in number]
            top = max(terms, default=-math.inf)
            alpha[e] = top + math.log(sum(math.exp(t - top) for t in terms)) if top > -math.inf else top
        out.append(alpha[-1])
    return out


@pytest.mark.parametrize("n", [31, 33, 200, 10_000])
def test_words_are_never_cut(n, monkeypatch):
    monkeypatch.setattr(L, "STRETCH", 512)
    vocab = [b" ", b"a", b"b", b"ab", b" a", b"ba", b"aba", "é".encode(), b"\xc3", b"\xa9", "éa".encode(), b"12", b"X"]
    rng = random.Random(n)
    p = np.vstack([np.random.default_rng(1).random((len(vocab), 3)) / 10, np.zeros(3)])
    lattice = L.Lattice(vocab)
    word = (" " + "".join(rng.choice("abé") for _ in range(n))).encode()
    assert lattice.log_likelihoods([word, b" ab"], p)[0] == pytest.approx(plain_sums(word, vocab, p), rel=1e-10)
    # expected uses: pieces cover the word exactly, whatever the segmentation
    used = lattice.expected_counts([word], np.array([1]), np.array([2.0]), p)
    assert used[:, [0, 2]].sum() == 0 and sum(u * len(v) for u, v in zip(used[:, 1], vocab)) == pytest.approx(2 * len(word))
    if n == 31:
        return
    monkeypatch.setattr(L, "GROUPED_WORD", 1 << 20)
    if n < 300:  # both ways agree
        assert lattice.log_likelihoods([word], p)[0] == pytest.approx(plain_sums(word, vocab, p), rel=1e-10)
        assert np.allclose(lattice.expected_counts([word], np.array([1]), np.array([2.0]), p), used)


def test_word_without_a_segmentation():
    lattice = L.Lattice([b"a", b" "])
    p = np.vstack([np.full((2, 2), 0.5), np.zeros(2)])
    got = lattice.log_likelihoods([b" ab", b" " + b"ab" * 40, b" aa"], p)
    assert (got[:2] < -600).all() and np.allclose(got[2], 3 * math.log(0.5))
    assert lattice.expected_counts([b" " + b"ab" * 40], np.array([0]), np.array([1.0]), p).sum() == 0


def test_texts_without_spaces(make_docs):
    """A script without spaces: one word of 30,000 bytes; the language is still told."""
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("的一是不了人我在有他") for _ in range(200)), "zh") for i in range(12)]
    rows += [(100 + i, "".join(rng.choice("のはをにがでとてもした") for _ in range(200)), "ja") for i in range(12)]
    rows += [(300, "".join(rng.choice("的一是不了人我在有他") for _ in range(10_000)), None)]
    got = {r.doc_id: r.lang_pred for r in L.identify_languages(make_docs(rows)).collect()}
    assert got[300] == "zh" and all(got[i] == lang for i, _, lang in rows if lang)


def test_names_of_other_columns(make_docs):
    docs = make_docs([(1, "one two three four five\nsome other line of words"), (2, "one two three four five\nand more"), (3, None), (4, "")])
    docs = docs.withColumns({"removed by": F.lit("x"), "removed id": F.lit(1), "removed lines": F.lit(2), "column 0": F.lit(3), "n_lines": F.lit("old")})
    got = dedup_lines(docs)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed, r["removed by"]) for r in got.collect()} == {
        1: ("one two three four five\nsome other line of words", 2, 0, "x"), 2: ("and more", 2, 1, "x"), 3: (None, 0, 0, "x"), 4: ("", 0, 0, "x")}
    text = "a b c d e f g h i j k l m n o p"
    docs = make_docs([(1, text), (2, text), (2, text), (3, "other"), (4, None)]).withColumns(
        {"set digest": F.lit("x"), "gone id": F.lit(1), "gone digest": F.lit(2), "digest": F.lit(3), "node": F.lit(4), "column 1": F.lit(5)})
    got = keep_one_of_each(docs)
    assert got.columns == docs.columns and Counter(r.doc_id for r in got.collect()) == Counter([1, 3, 4])


def test_pipeline_of_odd_rows_and_of_none(spark, make_docs, write_tables):
    bench = spark.createDataFrame([(1, "a passage of the benchmark that has more than ten words in it")], "item_id long, text string")
    words = "the cat and a dog sat on this mat with his old hat near that red house".split()
    rows = [(i, " ".join(random.Random(i).choices(words, k=60)), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100, None, "en", None), (101, "", None, "s0"), (102, "123 ...", "en", "s1"), (None, rows[0][1], "en", "s0"),
             (103, rows[1][1], "en", "s1"), (1, rows[1][1], "en", "s1"), (1, rows[1][1], "en", "s1"),
             (104, rows[2][1] + " a passage of the benchmark that has more than ten words in it", "en", "s2")]
    got = corpus_pipeline.run(spark, write_tables(documents=make_docs(rows), benchmark=bench)).collect()
    ids = {r.doc_id for r in got}
    assert ids and not ids & {100, 101, 102, 103, 104} and ids <= set(range(40)) | {None}
    assert sorted((r.shard, r.slot) for r in got) == sorted((s, k) for s in range(16) for k in range(sum(r.shard == s for r in got)))
    assert corpus_pipeline.run(spark, write_tables(documents=make_docs([]), benchmark=bench)).count() == 0


@pytest.mark.parametrize("kind", ["address", "number"])
def test_spans_of_a_long_text_take_linear_time(make_docs, kind):
    one = {"address": "write to name{}@host.example.org now. ", "number": "call +1 202 555 {:04d} or 10.0.0.{}. "}[kind]
    took = []
    for n in (200, 8000):
        text = "".join(one.format(i % 250, i % 250) for i in range(n))
        docs = make_docs([(1, text)], 1).cache()
        docs.count()
        began = time.time()
        row = propose(docs, "doc_id", "text").collect()[0]
        took.append(time.time() - began)
        base = sorted((c.start, c.end) for c in row.candidates if c.base and c.kind == (0 if kind == "address" else 3))
        assert len(base) == n and all(text[s:e] == text[base[0][0]:base[0][1]].replace("0000", f"{i % 250:04d}").replace("name0@", f"name{i % 250}@")
                                      for i, (s, e) in enumerate(base))
    assert took[1] < 60  # forty times the text: quadratic work would take minutes
