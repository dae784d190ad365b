"""The parse of reference blocks, and revisits with repeated times, odd ids and extra columns."""

import random

import numpy as np

from tidelog.llm import revisits
from tidelog.llm.substring_duplicates import PASSAGE, REACH, WINDOW, ReferenceBlock


def test_parse_against_brute_force():
    rng = random.Random(2)
    for _ in range(30):
        base = [rng.randrange(1, 4) for _ in range(PASSAGE)]
        keys, lefts, passages = [], [], []
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(PASSAGE)] = rng.randrange(1, 4)
            low, high = rng.randrange(REACH + 1), rng.randrange(WINDOW, PASSAGE + 1)
            keys.append(rng.randrange(2)), lefts.append(REACH - low), passages.append(words[low : max(high, low + 8)])
        sizes = np.array([len(p) for p in passages])
        block = ReferenceBlock(np.array(keys), np.array(lefts), sizes, np.array(sum(passages, []), np.uint64))

        def window(row, column):
            begin = column - (REACH - lefts[row])
            return passages[row][begin : begin + WINDOW] if 0 <= begin <= len(passages[row]) - WINDOW else None

        for row, mask in enumerate(block.repeated_windows().tolist()):
            for column in range(REACH + 1):
                own = window(row, column)
                others = [window(r, column) for r in range(len(keys)) if r != row and keys[r] == keys[row]]
                assert bool(mask >> column & 1) == (own is not None and own in others)


def test_odd_revisits(spark):
    head = 'HTTP/1.1 200 OK\r\nETag: "{}"\r\n\r\n'
    seen = 'HTTP/1.1 304 Not Modified\r\nETag: "b"\r\n\r\n'
    rows = [
        (1, "response", "http://a.org/x", 10, 200, head.format("a"), "d1", "z"),
        (2, "response", "http://a.org/x", 10, 200, head.format("b"), "d2", "z"),
        (None, "response", "http://a.org/x", 10, 200, head.format("c"), "d3", None),
        (3, "revisit", "http://a.org/x", 20, 304, seen, None, None),
        (None, "revisit", "http://a.org/x", 20, 304, seen, None, "z"),
        (4, "revisit", "http://a.org/x", None, 304, seen, None, None),
        (5, "request", "http://a.org/x", 20, None, None, None, None),
    ]
    schema = "record_id bigint, kind string, target_uri string, ts bigint, status int, http string, payload_digest string, found string"
    got = {r.record_id: (r.outcome, r.response_id) for r in revisits.resolve(spark.createDataFrame(rows, schema)).collect()}
    assert got == {3: ("resolved", 2), None: ("resolved", 2), 4: ("no-earlier-response", None)}


def test_captures(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "x"), (None, "http://b.org", "y"), (2, None, None)], "page_id bigint, url string, html string")
    records = revisits.captures_of(pages)
    assert records.count() == 9 and records.where("kind = 'revisit'").count() == 3
    assert {r.record_id: r.outcome for r in revisits.resolve(records).collect()} == {
        6: "resolved", 10: "no-earlier-response", None: "no-earlier-response"
    }
