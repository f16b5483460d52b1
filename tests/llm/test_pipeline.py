"""The pipeline's stages and rows against what each stage's own input demands."""

import re
from collections import Counter

import corpus_pipeline as P
from conftest import SF_SMALL


def test_stages(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, held = docs.columns, [docs]
    for number, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, held[-1], SF_SMALL)
        out.write.parquet(f"{tmp_dir}/{number}")
        held.append(spark.read.parquet(f"{tmp_dir}/{number}"))
        if number < len(P.STAGES) - 1:
            assert out.columns == columns
    source, known, single, clean, mixed, sharded = [[r.asDict() for r in x.collect()] for x in held]
    assert [r["doc_id"] for r in known if not re.search(r"[^\W\d_]", r["text"])] == [] and len(known) >= 0.98 * len(source)

    def shingles(text):
        w = text.encode().lower().split()
        return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3)))

    sets = {r["doc_id"]: shingles(r["text"]) for r in known}
    up = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = a, b
                while up[x] != x:
                    x = up[x]
                while up[y] != y:
                    y = up[y]
                up[max(x, y)] = min(x, y)
    assert Counter(r["doc_id"] for r in single) == Counter(i for i in sets if up[i] == i)

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        w = word.findall(r["text"].encode().lower().decode())
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))}

    def leaks(text):
        w = word.findall(text.encode().lower().decode())
        return any(tuple(w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    assert Counter(r["doc_id"] for r in clean) == Counter(r["doc_id"] for r in single if not leaks(r["text"]))

    size = lambda r: len(r["text"].encode().split())
    taken, sizes = Counter(), Counter()
    for r in clean:
        sizes[r["source"]] += size(r)
    for r in mixed:
        taken[r["source"]] += size(r)
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    largest = max(map(size, clean))
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= largest * len(sizes)
    assert all(taken[s] <= 2 * sizes[s] for s in sizes)
    assert Counter(r["doc_id"] for r in sharded) == Counter(r["doc_id"] for r in mixed)
    assert {r["shard"] for r in sharded} <= set(range(16))


def test_run_is_the_stages(spark):
    assert [n for n, _ in P.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination",
                                       "mixing sources to target weights", "sharding"]
    assert P.ORACLE_SQL is None
    assert P.run(spark, SF_SMALL).columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
