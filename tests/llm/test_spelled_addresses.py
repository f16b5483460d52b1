"""op7: spelled-out addresses are found among false ones, and well-formed IPs within longer runs."""

import pytest

from riskloom.llm import pii as P

REAL = ["jane.roe{i} [at] mail-host{i} [dot] org", "box{i}(at)example.com", "j_r{i} [AT] uni{i} [DOT] edu [DOT] au", "info{i} (at) firm (dot) net"]
FALSE = ["items{i} (at) 9.99", "gate{i} [at] 10.30", "kg{i} [at] 3 [dot] 50", "run{i}(at)v2.7.1"]


@pytest.mark.parametrize("plain", [True, False])
def test_spelled_out_addresses(spark, make_docs, plain):
    rows, want = [], {}
    for i in range(800):
        real = i % 2 == 0
        spelled = (REAL if real else FALSE)[i // 2 % 4].format(i=i)
        text = f"Write 𝒳 to {spelled} please"
        want[i] = f"email:11:{11 + len(spelled)}" if real else ""
        rows.append((i, text + (f", or to a{i}@b.org, host 10.0.{i % 250}.7 or 300.1.{i}.2" if plain else "")))
    got = {r.doc_id: r for r in P.find_personal_data(make_docs(rows)).collect()}
    assert {i: ",".join(s for s in r.spans.split(",") if s.startswith("email:11:")) for i, r in got.items()} == want
    assert all(r.n_email == plain for r in got.values())


def test_ip_within_a_longer_run(spark, make_docs):
    rows = [(i, f"host 10.{i % 200}.0.7 and 300.1.{i}.2 end") for i in range(400)] + [(1000, "host 300.10.20.30.40 end")]
    got = {r.doc_id: r.spans for r in P.find_personal_data(make_docs(rows)).collect()}
    assert got[1000] == "ip:9:20"
