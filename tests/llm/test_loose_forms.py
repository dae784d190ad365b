"""Loose forms of personal data are found whatever look-alikes the input holds."""

import random

from tidelog.llm import pii

PROBES = {
    1000: ("please write to bob (at) example (dot) com today", ["bob (at) example (dot) com"]),
    1001: ("the host 10 . 20 . 30 . 40 is up", ["10 . 20 . 30 . 40"]),
    1002: ("paid with 4111.1111.1111.1111 then", ["4111.1111.1111.1111"]),
    1003: ("or call (504) 555-2652 now", ["(504) 555-2652"]),
    1004: ("we met at home. Then 1, 2, 3, 4 on 2024-05-17, row 4111.1111.1111.1112", []),
    1005: (None, []),
}


def texts():
    """Base matches of every kind in prose, without a single malformed one."""
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("lor", "an", "tem", "or") for b in ("in", "ea", "ul", "ost")]

    def digits(n):
        return "".join(rng.choices("123456789", k=n))

    def card():
        while not pii.luhn(number := digits(16)):
            pass
        return number

    out = []
    for _ in range(40):
        found = [
            f"{rng.choice(words)}.{rng.choice(words)}@{rng.choice(words)}.example.org",
            ".".join(str(rng.randrange(256)) for _ in range(4)),
            card(),
            f"+1 {digits(3)} {digits(3)} {digits(4)}",
        ]
        out.append(" ".join(w for x in found for w in (*rng.choices(words, k=8), x)) + " left at last. End")
    return out


def test_all_kinds_have_a_model(spark):
    rows = [*enumerate(texts()), *((i, t) for i, (t, _) in PROBES.items())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    text = dict(rows)
    found = {r.doc_id: [text[r.doc_id][s.begin : s.end] for s in r.added] for r in pii.personal_data(docs).collect()}
    assert {i: found[i] for i in PROBES} == {i: spans for i, (_, spans) in PROBES.items()}
    assert not any(found[i] for i in range(40))
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_addresses_side_by_side():
    for text, wanted in (
        ("bob (at) example (dot) com or amy (at) host (dot) org", ["bob (at) example (dot) com", "amy (at) host (dot) org"]),
        ("mail a.b@c.example.org, amy [at] host [dot] org", ["a.b@c.example.org", "amy [at] host [dot] org"]),
        ("look at bob at example dot com, amy @ host.org(at)", ["bob at example dot com", "amy @ host.org"]),
        ("x" * 100 + "@host.org", ["x" * 64 + "@host.org"]),
        ("(at) @ at host.org", []),
    ):
        assert [text[b:e] for _, b, e in pii.proposals(text, ("email",))] == wanted
