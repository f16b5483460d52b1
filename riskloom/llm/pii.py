"""Personal data: candidate spans, boosted trees, calibrated thresholds (DataFrame functions only).

Generators with high recall propose spans, which may overlap: the base patterns, and looser
or tighter forms of each kind.  Base spans that pass their format check always stay.  Of the
others, gradient-boosted trees over format and context score each, and those above their
kind's threshold are added.  Trees are fitted on candidates whose label the formats settle
(checked base spans against failed ones; spelled-out addresses by the address they stand for)
and compiled to SQL expressions, so scoring is a projection without shuffle, Python or row ids.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch

#: Fixed order: spans at the same start are listed by it.
KINDS = ("email", "ip", "card", "phone")
#: Base patterns.  Look-behinds and possessive parts only spare repeated scans: the leftmost non-overlapping matches of
#: at least 12 digits (card), or of any length (the others), are those of the plain patterns.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further proposals: spelled-out addresses, and well-formed numbers within longer or other runs.
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9])(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])|(?<![0-9])[0-9]{16}(?![0-9])",
    "phone": r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
}
#: What a text must hold for a kind's patterns to be tried at all.
HINT = {"email": r"@|[\[(](?:at|AT)[\])]", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.|$)){4}$"
#: Spelled-out signs of an address, and the last label of a well-formed one.
SPELLED = ((r"\x20?[\[(](?:at|AT)[\])]\x20?", "@"), (r"\x20?[\[(](?:dot|DOT)[\])]\x20?", "."))
LAST_LABEL = r"\.(?:[a-z]{2,}|[A-Z]{2,})$"
CONTEXT = 16  # characters on either side
BLOCK = 256  # matches whose offsets are summed in one go
FEATURES = ("kind", "digits", "length", "marks", "letters", "plus", "paren", "checksum", "octets", "dots",
            "before", "after", "digits_before", "named_other", "named_kind", "tail", "tail_lower", "tail_upper")
#: Trees and the folds that calibrate thresholds; all labelled candidates serve for both.
FOLDS, TREES, DEPTH, PRECISION, SEED = 3, 12, 3, 0.99, 7
CELLS = 50_000  # different labelled candidates of one partition


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body (or a lambda in it) refers to it."""
    return F.transform(F.array(value), body)[0]


def _matches(text: Column, pattern: str, kind: int, base: bool) -> Column:
    """Leftmost non-overlapping matches as structs; offsets are code points.

    The parts between the matches give the offsets: a match begins behind all parts and
    matches before it.  These sums run over BLOCK matches at a time, then over the blocks, so that
    the arrays which grow on the way stay short and a text costs as many steps as it has matches.
    ``hit`` is the match itself, or the address that a spelled-out one stands for.
    """
    def address(hit):
        for sign, plain in SPELLED if KINDS[kind] == "email" and not base else ():
            hit = F.regexp_replace(hit, sign, plain)
        return hit

    def measured(found):
        """Matches with the parts on either side and the code points that they take together."""
        return F.transform(found["hits"], lambda h, i: F.struct(
            h.alias("h"), found["parts"][i].alias("part"), F.left(found["parts"][i + 1], F.lit(CONTEXT)).alias("after"),
            (F.char_length(found["parts"][i]) + F.char_length(h)).alias("n")))

    def blocks(rows):
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int")), lambda b: F.slice(rows, b * BLOCK + 1, F.lit(BLOCK)))
        return _once(cut, lambda own: F.zip_with(own, ends_of(F.transform(own, lambda x: F.aggregate(x, F.lit(0), lambda a, r: a + r["n"]))),
                                                 lambda x, end: F.struct(x.alias("rows"), end["start"].alias("start"))))

    def ends_of(lengths):
        """(start, end) of stretches of these lengths, one behind the other."""
        none = F.array().cast("array<struct<start:int,end:int>>")
        def step(acc, n):
            return F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + n).alias("end")))).alias("out"))
        return F.aggregate(lengths, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def spans(block):
        placed = F.zip_with(block["rows"], ends_of(F.transform(block["rows"], lambda r: r["n"])), lambda r, e: F.struct(r.alias("r"), (block["start"] + e["end"]).alias("end")))
        return F.transform(placed, lambda p: F.struct(
            F.lit(kind).alias("kind"), F.lit(base).alias("base"), (p["end"] - F.char_length(p["r"]["h"])).alias("start"), p["end"].alias("end"),
            address(p["r"]["h"]).alias("hit"), F.right(p["r"]["part"], F.lit(CONTEXT)).alias("before"), p["r"]["after"].alias("after")))

    none = F.array().cast("array<struct<kind:int,base:boolean,start:int,end:int,hit:string,before:string,after:string>>")
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("parts"))
    return _once(found, lambda m: F.when(F.size(m["hits"]) == 0, none).otherwise(
        F.flatten(F.transform(_once(measured(m), blocks), spans))))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    digits = F.reverse(_digits(hit))
    n = F.char_length(digits)

    def value(k):
        d = digits.substr(k, F.lit(1)).cast("int")
        return F.when(k % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda a, k: a + value(k))
    return F.when(n.between(12, 19), total % 10 == 0).otherwise(False)


def _passes(kind: Column, hit: Column) -> Column:
    """The format check of a kind."""
    n = F.char_length(_digits(hit))
    return (F.when(kind == 0, hit.contains("@")).when(kind == 1, hit.rlike(IP_PARTS)).when(kind == 2, _luhn(hit))
            .otherwise(n.between(9, 15) & hit.startswith("+")))


def _well_formed(kind: Column, hit: Column) -> Column:
    """The label of a candidate: the format check, and for an address (all have an @) its last label."""
    return F.when(kind == 0, hit.rlike(LAST_LABEL)).otherwise(_passes(kind, hit))


def _features(c: Column) -> list[Column]:
    hit, before, after = c["hit"], c["before"], c["after"]
    digits = F.char_length(_digits(hit))
    kind_of = lambda ch: (F.when(ch == "", 0).when(ch.rlike("[0-9]"), 1).when(ch.rlike(r"\p{L}"), 2)
                          .when(ch.rlike(r"\s"), 3).otherwise(4))
    named, tail = F.lower(before), F.substring_index(hit, ".", -1)
    return [x.cast("double") for x in (
        c["kind"], digits, F.char_length(hit), F.char_length(F.regexp_replace(hit, r"[A-Za-z0-9]", "")),
        F.char_length(F.regexp_replace(hit, r"[^A-Za-z]", "")), hit.startswith("+"), hit.contains("("), _luhn(hit),
        hit.rlike(IP_PARTS), F.char_length(F.regexp_replace(hit, r"[^.]", "")), kind_of(F.right(before, F.lit(1))),
        kind_of(F.left(after, F.lit(1))), F.char_length(_digits(before)),
        named.rlike(r"token|key|hash|order|serial|version|isbn|invoice|ticket"),
        named.rlike(r"mail|contact|tel|phone|call|fax|card|visa|pay|host|addr|ip"), F.char_length(tail),
        F.char_length(F.regexp_replace(tail, "[^a-z]", "")), F.char_length(F.regexp_replace(tail, "[^A-Z]", "")))]


def propose(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, candidates) by row; a candidate is (kind, base, start, end, passes, well, x)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = []
    for k, kind in enumerate(KINDS):
        both = F.concat(_matches(text, BASE[kind], k, True), _matches(text, MORE[kind], k, False))
        found.append(F.when(text.rlike(HINT[kind]), both).otherwise(F.slice(both, 1, 0)))
    described = F.transform(F.col("raw"), lambda c: F.struct(
        c["kind"].alias("kind"), c["base"].alias("base"), c["start"].alias("start"), c["end"].alias("end"),
        _passes(c["kind"], c["hit"]).alias("passes"), _well_formed(c["kind"], c["hit"]).alias("well"), F.array(*_features(c)).alias("x")))
    return docs.select(F.col(id_col).alias("id"), F.concat(*found).alias("raw")).select("id", described.alias("candidates"))


class Trees:
    """Boosted trees as a Column over an array of features, and a threshold for each kind."""

    def __init__(self, roots: list[tuple[float, dict]], thresholds: dict[int, float]):
        self.roots, self.thresholds = roots, thresholds

    def score(self, x: Column) -> Column:
        def walk(node):
            if "value" in node:
                return F.lit(node["value"])
            return F.when(x[node["feature"]] <= node["at"], walk(node["low"])).otherwise(walk(node["high"]))

        margin = F.lit(0.0)
        for weight, root in self.roots:
            margin = margin + F.lit(weight) * walk(root)
        return 1 / (1 + F.exp(-2 * margin))

    def accepts(self, kind: Column, score: Column) -> Column:
        limit = F.lit(2.0)
        for k, t in self.thresholds.items():
            limit = F.when(kind == k, t).otherwise(limit)
        return score >= limit


def parse_tree(text: str) -> dict:
    """The nodes of a fitted tree from its printed form."""
    lines = [x.strip() for x in text.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]

    def node(at):
        if m := re.match(r"Predict: (\S+)", lines[at]):
            return {"value": float(m[1])}, at + 1
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        low, at = node(at + 1)
        high, at = node(at + 1)  # behind its Else
        return {"feature": int(m[1]), "at": float(m[2]), "low": low, "high": high}, at

    return node(0)[0]


def _boosted(train: DataFrame) -> Trees:
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64, weightCol="n").fit(train)
    return Trees([(float(w), parse_tree(t.toDebugString)) for w, t in zip(model.treeWeights, model.trees)], {})


def fit_trees(candidates: DataFrame, precision: float = PRECISION) -> Trees | None:
    """From (id, start, end, kind, base, well, x): labels are the format checks; None without labelled candidates.

    Candidates that agree in kind, features and label are one row with their number as weight, so
    the trees are fitted on all of them.  Every candidate calibrates, too: it is scored by trees that
    were fitted without its fold, and a kind's threshold is the lowest score at or above which
    these reach ``precision``, at least 0.5; a kind with none to calibrate accepts nothing.
    """
    fold = F.pmod(F.xxhash64(F.lit(SEED), "id", "start", "end", "kind", "base"), F.lit(FOLDS)).cast("int")
    by = ["kind", "x", "label", "part"]
    cells = candidates.select("kind", "x", F.col("well").cast("double").alias("label"), fold.alias("part"))
    cells = cells.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("n")).persist()
    sizes = {r["part"]: r["count"] for r in cells.groupBy("part").count().collect()}
    if not sizes:
        cells.unpersist()
        return None
    order = F.xxhash64(*by)
    laid = cells.repartition(-(-sum(sizes.values()) // CELLS), order).sortWithinPartitions(order, *by)
    laid = laid.withColumn("features", array_to_vector("x")).persist()
    trees = _boosted(laid)
    cells.unpersist()
    steps = []
    for part in sizes:
        without = _boosted(laid.filter(F.col("part") != part)) if len(sizes) > 1 else trees
        held = laid.filter(F.col("part") == part).select("kind", F.round(without.score(F.col("x")), 3).alias("score"), "label", "n")
        steps += held.groupBy("kind", "score").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()  # 1,001 scores a kind
    laid.unpersist()
    for kind in range(len(KINDS)):
        right = n = 0
        own = sorted((r for r in steps if r["kind"] == kind and r["score"] >= 0.5), key=lambda r: -r["score"])
        for i, r in enumerate(own):
            right, n = right + r["right"], n + r["n"]
            if (i + 1 == len(own) or own[i + 1]["score"] < r["score"]) and right >= precision * n:
                trees.thresholds[kind] = max(0.5, r["score"] - 0.0005)
    return trees


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and base_sha256 are of the base spans that pass their check; ``spans`` lists these and
    the added ones.  An added span never overlaps a base span, and of overlapping added spans
    the better score stays.  Null and empty texts have no spans; with no candidate anywhere
    nothing is added; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = Scratch(spark, "pii").table(propose(docs, id_col, text_col), "candidates")
    each = rows.select("id", F.explode("candidates").alias("c")).select("id", "c.*")
    # a looser or tighter number that passes is what the trees are to judge, so it gives no label; spelled-out addresses
    # are labelled like plain ones, by their last label, of which the trees see only letters and length
    trees = fit_trees(each.filter("base or kind = 0 or not well"))
    overlaps = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    base = F.transform(F.filter("candidates", lambda c: c["base"] & c["passes"]),
                       lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    out = rows.withColumn("base", base)
    if trees is None:
        out = out.withColumn("added", F.slice("base", 1, 0))
    else:
        free = F.filter("candidates", lambda c: ~(c["base"] & c["passes"]) & ~F.exists("base", lambda b: overlaps(b, c)))
        scored = F.transform(free, lambda c: F.struct(
            c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), trees.score(c["x"]).alias("score")))
        out = out.withColumn("scored", F.array_distinct(F.filter(scored, lambda s: trees.accepts(s["kind"], s["score"]))))
        rank = lambda s: F.struct(-s["score"], s["start"], s["kind"], s["end"])
        out = out.withColumn("added", F.filter("scored", lambda s: ~F.exists(
            "scored", lambda o: overlaps(o, s) & (rank(o) < rank(s)))))
        out = out.withColumn("added", F.transform("added", lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return out.select(F.col("id").alias(id_col), *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      _listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
