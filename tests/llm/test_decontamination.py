"""op2: suffix arrays, longest matches and windows against brute force; blocks; edge rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import decontamination as D

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w, hit, found = _words(text), set(), []
        for item, t in items:
            b = _words(t)
            k = min(window, len(b))
            wins = {tuple(b[s:s + k]) for s in range(len(b) - k + 1)} if b else set()
            at = [s for s in range(len(w) - k + 1) if tuple(w[s:s + k]) in wins] if wins else []
            hit |= {s + j for s in at for j in range(k)}
            found += [str(item) if item is not None else "null"] * bool(at)
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return Counter(out)


def _corpus(seed=4):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ünï", "the"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([3, 9, 10, 11, 25, 40])))) for i in range(30)]
    items += [(30, None), (31, " . , "), (32, items[0][1]), (33, "Passage, shared; by many documents: it has more than ten words in it")]
    docs = []
    for i in range(120):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.4:
            part = _words(rng.choice(items)[1])
            cut = rng.randint(0, max(0, len(part) - 10))
            at = rng.randint(0, len(words))
            words[at:at] = part[cut:cut + rng.choice([5, 9, 10, 12, 40])]
        docs.append((i, ", ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    docs += [(500 + i, "x " + items[-1][1].upper()) for i in range(50)]
    return docs + [(900, None), (901, ""), (902, "... !"), (903, docs[0][1]), (903, docs[0][1]), (None, items[3][1])], items


def test_windows_match_brute_force(spark, make_docs, monkeypatch):
    docs, items = _corpus()
    frame = make_docs(docs).withColumns({"n_words": F.lit("x"), "items": F.lit(1), "row": F.lit(2), "item": F.lit(3)})
    bench = spark.createDataFrame(items, ITEMS).withColumn("spans", F.lit(1))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = _brute(docs, items)
    got = D.find_contamination(frame, bench)
    assert Counter(map(tuple, got.select(*columns).collect())) == want
    assert sum(r[5] for r in want) > 60
    assert all(r.n_hit == sum(e - s for s, e in r.spans) for r in got.collect())
    blocks = D.find_contamination(frame, bench, block_bytes=300)  # the same in many blocks
    assert Counter(map(tuple, blocks.select(*columns).collect())) == want
    assert Counter((r.doc_id, str(r.spans), str(r.items)) for r in blocks.collect()) == Counter(
        (r.doc_id, str(r.spans), str(r.items)) for r in got.collect())
    clean = D.remove_contaminated(frame, bench)
    assert clean.columns == frame.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r[0] for r, n in want.items() for _ in range(n) if not r[5])


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    got = D.find_contamination(make_docs([(1, "a b c"), (2, None)]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in sorted(got)] == [(3, 0, False), (0, 0, False)]
    assert D.find_contamination(make_docs([]), spark.createDataFrame([(1, "a b")], ITEMS)).count() == 0


def test_suffix_array_and_longest_matches(spark, make_docs):
    rng = np.random.default_rng(0)
    for vocab, n in ((2, 300), (5, 1000), (3_000_000, 200), (1, 50)):
        ids = rng.integers(0, vocab + 1, n)
        order = D.suffix_array(ids, n)
        assert order.tolist() == sorted(range(n), key=lambda i: ids[i:].tolist())
    docs, items = _corpus(9)
    got = {(r.item, r.start): r.length for r in D.longest_matches(make_docs(docs), spark.createDataFrame(items, ITEMS)).collect()}
    texts = [" ".join(["", *_words(t), ""]) for _, t in docs]
    for item, t in items:
        w = _words(t)
        for s in range(len(w)):
            n = 0
            while s + n < len(w) and any(" " + " ".join(w[s:s + n + 1]) + " " in x for x in texts):
                n += 1
            assert got[str(item), s] == n
