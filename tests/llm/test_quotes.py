"""op1: nested quotes, threads and positions against the SQL form on planted conversations; edge rows."""

import random
from collections import Counter

import duckdb
from pyspark.sql import types as T

from riskloom.llm.queries import ORACLE_SQL
from riskloom.llm.quotes import link_quotations

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def _thread(conv, rng, turns):
    own, rows = [], []
    for t in range(turns):
        lines = []
        if t and rng.random() < 0.8:
            src = rng.randrange(t)
            for line in own[src][: rng.randint(1, 3)]:
                lines.append(rng.choice(["> ", ">", " > "]) + line.upper().replace(" ", "  "))
            if src and rng.random() < 0.5:
                lines.append(">> " + rng.choice(own[rng.randrange(src)]))
        lines += [""] * rng.randint(0, 1)
        own.append([f"text {conv} {t} {k}" if rng.random() < 0.8 else "yes" for k in range(rng.randint(1, 4))])
        rows.append((conv, t, rng.choice(["user", "assistant"]), "\n".join(lines + own[-1])))
    return rows


def _duck(rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    rel = con.sql(ORACLE_SQL["op1_quotes"])
    return rel.columns, rel.fetchall()


def test_threads_match_sql(spark):
    rng = random.Random(11)
    rows = [r for c in range(25) for r in _thread(c, rng, rng.randint(1, 12))] + _thread(99, rng, 120)
    got = link_quotations(spark.createDataFrame(rows, SCHEMA).repartition(4))
    columns, want = _duck(rows)
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want)
    assert got.filter("n_linked > 0").count() > 50 and got.filter("quote_depth > 1").count() > 5
    assert got.filter("own_text like '%>%'").count() == 0


def test_reply_order_puts_parents_first(spark):
    rows = [(1, 0, "user", "root a"), (1, 1, "user", "root b"), (1, 2, "user", "> root a\nreply a"),
            (1, 3, "user", "> root b\nreply b"), (1, 4, "user", "> reply a\n>> root a\ndeep"), (1, 5, "user", "> nobody said this\nx")]
    got = {r.turn: r for r in link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[t].parent_turn for t in range(6)] == [None, None, 0, 1, 2, None]
    assert [t for t in sorted(got, key=lambda t: got[t].position)] == [0, 2, 4, 1, 3, 5]
    assert got[4].thread_depth == 2 and got[4].own_text == "deep" and (got[5].n_quoted, got[5].n_linked) == (1, 0)


def test_edge_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "user", ""), (None, 0, "user", "alone"), (None, 1, "user", "> ALONE\n"), (2, None, "user", "no turn"),
            (2, 0, "user", "> no turn"), (2, 1, "user", ">>> > \n>\n"), (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "user", "other"),
            (3, 1, "user", "> other\n> same"), (4, 0, "user", "long " * 50_000), (4, 1, "user", "> " + "long " * 50_000)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as level", "'x' as normal", "2 as origin")
    got = link_quotations(frame).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[None, 1].parent_turn == 0 and by[4, 1].parent_turn == 0 and by[3, 1].n_linked == 2
    assert by[2, 0].parent_turn is None and by[2, None].position == 0 and by[2, 1].quote_depth == 4
    assert sorted(r.position for r in got if r.conv_id == 3) == [0, 1, 2, 3]
    assert link_quotations(spark.createDataFrame([], SCHEMA)).count() == 0
