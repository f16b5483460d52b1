"""op13: against brute force; summaries keep what is frequent; nulls, odd texts, repeats, empty tables, clashing names."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import riskloom.llm.phrases as phrases
from riskloom.llm.phrases import MisraGries, Words, mine_collocations, summed

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold, longest=5, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= threshold}
    dropped = {(lang, p[i:j]) for (lang, p), a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
               if j - i < len(p) and a >= f[lang, p[i:j]]}
    out = defaultdict(list)
    for (lang, p), a in candidates.items():
        if (lang, p) not in dropped:
            s, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                    for k in range(1, len(p)))
            out[lang].append((-s, -a, " ".join(p).encode(), left, right))
    return Counter((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                   for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def mined(docs, **given):
    return Counter(tuple(r) for r in mine_collocations(docs, **given).collect())


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(1)
    stream = np.concatenate([rng.integers(0, 1 << 60, 20_000), np.repeat(rng.integers(0, 1 << 60, 40), 120)]).astype(np.uint64)
    rng.shuffle(stream)
    threshold = 100
    summaries = []
    for part in np.array_split(stream, 7):  # summaries of parts, merged by way of a tree
        own = MisraGries(len(stream) // threshold + 1)
        for step in np.array_split(part, 5):
            own.merge([summed(step, np.ones(len(step), np.int64))])
        summaries.append(own)
    total = MisraGries(len(stream) // threshold + 1)
    for own in summaries:
        total.merge([(own.h, own.n)], own.error)
    true = dict(zip(*(x.tolist() for x in summed(stream, np.ones(len(stream), np.int64)))))
    assert {h for h, n in true.items() if n >= threshold} <= set(total.at_least(threshold).tolist())
    assert len(total.h) <= total.capacity and 0 < total.error < threshold
    assert all(n <= true[h] <= n + total.error for h, n in zip(total.h.tolist(), total.n.tolist()))


def test_words_of_whole_texts():
    texts = ["Ab cD.é\tx", "", "  ", "a b,c;d:e!f?g\nh\x0bi\x0cj\rk \tl", "y", " z\x00 ."]
    words = Words(pa.array(texts), ["en"] * 5 + ["fr"])
    spelled = [words.spelled[i].decode() for i in words.number]
    assert spelled == ["ab", "cd", "é", "x", *"abcdefghijkl", "y", " z\x00"]
    pieces = [spelled[s:e] for s, e in zip(*(lambda c: (np.append(0, c), np.append(c, len(spelled))))(np.flatnonzero(np.diff(words.piece)) + 1))]
    assert pieces == [["ab", "cd"], ["é", "x"], ["a", "b"], *[[x] for x in "cdefghij"], ["k", "l"], ["y"], [" z\x00"]]
    assert [words.langs[i] for i in words.lang] == ["en"] * (len(spelled) - 1) + ["fr"]


def test_brute_on_random_texts(make_docs):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)] + ["The", "the", "of", "é", "É", "a b", "x.y", "x, y", "new york city hall", "New York", "\t"]
    rows = []
    for i in range(400):
        rows.append((i, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", ". ", "\n"]) for _ in range(rng.randint(0, 60))),
                     rng.choice(["en", "de", None, "und"])))
    rows += [(1000 + i, "ha " * rng.randint(3, 9), "fr") for i in range(60)] + [(2000, None, "en"), (2001, "", None), (2002, "z " * 5000, "en")]
    rows += [(7, "same row of words, same row", "en")] * 40 + [(None, "same row of words", "en")] * 3
    docs = make_docs(rows, 6).withColumns({"phrase": F.lit("x"), "k": F.lit(1), "n": F.lit(2), "part": F.lit(0)})
    want = brute([(t, lang) for _, t, lang in rows], 5)
    got = mined(docs, threshold=5)
    assert got == want and len(want) > 50
    assert {r[0] for r in got} == {"en", "de", "fr", "und"}
    assert mined(docs, threshold=5, top=7) == brute([(t, lang) for _, t, lang in rows], 5, top=7)
    assert mined(docs, threshold=10, longest=2) == brute([(t, lang) for _, t, lang in rows], 10, longest=2)


def test_many_hand_overs_and_small_maps(make_docs, monkeypatch):
    """Steps of a few texts, runs handed over often and a map of survivors too small for them change nothing."""
    monkeypatch.setattr(phrases, "MOST_BITS", 16)
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "STEP_BYTES", 4000)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefghij") * rng.randint(1, 2) for _ in range(80)), "en") for i in range(150)]
    assert mined(make_docs(rows, 5), threshold=30) == brute([(t, lang) for _, t, lang in rows], 30)


def test_equal_hashes_are_told_apart(make_docs, monkeypatch):
    """Phrases that share a hash are counted by their words."""
    words = Words(pa.array(["a b c d a b c d"] * 3), ["en"] * 3)
    at = np.array([0, 1, 2, 4, 8, 9])
    first, n = phrases._grouped(words, 2, at, np.zeros(len(at), np.uint64))
    spelled = {tuple(words.spelled[words.number[i + j]] for j in range(2)): c for i, c in zip(first.tolist(), n.tolist())}
    assert spelled == {(b"a", b"b"): 3, (b"b", b"c"): 2, (b"c", b"d"): 1}


def test_exact_beyond_64_bits(spark):
    """Scores are computed in decimals wide enough for 1000 * a * n of large corpora."""
    a, n = 10 ** 15, 10 ** 16
    got = spark.range(1).select(F.call_function("div", phrases._exact(F.lit(1000) * phrases._exact(F.lit(a), 18), 21) * phrases._exact(F.lit(n), 17),
                                                phrases._exact(F.lit(a + 1), 19) * phrases._exact(F.lit(a + 2), 19)).alias("s")).first().s
    assert got == 1000 * a * n // ((a + 1) * (a + 2))


def test_nothing_to_find(make_docs):
    assert mine_collocations(make_docs([])).count() == 0
    assert mine_collocations(make_docs([(1, None), (2, " . "), (3, "one two")])).count() == 0


def test_a_third_is_one_row(make_docs):
    rows = [(1, "very common line of words", "en")] * 300 + [(i, f"text number {i} of its own", "en") for i in range(600)]
    assert mined(make_docs(rows, 9)) == brute([(t, lang) for _, t, lang in rows], 100)
