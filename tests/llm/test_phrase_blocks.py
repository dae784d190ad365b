"""op6 over many small blocks of phrases gives what one block gives, and what brute force gives."""

import pytest

from tidelog.llm import decontaminate

ITEMS = [
    ("i1", " ".join(f"w{k}" for k in range(60))),
    ("i2", "Short Item here"),
    ("i3", " ".join(f"w{k}" for k in range(20, 45))),
    (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"),
    ("i4", None),
    ("i5", "..."),
]
TEXTS = [
    (1, "clean text of no interest"),
    (2, "before " + " ".join(f"W{k}" for k in range(5, 40)) + " after"),
    (2, "a SHORT, item; here it is"),
    (None, "x w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 y"),
    (3, None),
    (4, ""),
    (5, " ".join(f"w{k}" for k in range(60)) + " middle " + " ".join(f"w{k}" for k in range(12, 33))),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None if t is None else len(t), 7) for i, t in TEXTS], "doc_id bigint, text string, n_chars bigint, spans int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


def brute():
    out = []
    for doc_id, text in TEXTS:
        words, hit, items = decontaminate.words_of((text or "").encode()), set(), set()
        for item, phrase in ITEMS:
            own = decontaminate.words_of((phrase or "").encode())
            size = min(len(own), decontaminate.WINDOW)
            for begin in range(len(own) - size + 1 if own else 0):
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == own[begin : begin + size]:
                        hit.update(range(at, at + size))
                        items.add(item or "")
        out.append((str(doc_id), len(words), len(hit), sorted(items)))
    return sorted(out)


def rows_of(found):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, sorted(r["items"])) for r in found.collect())


def cleaned_of(docs, benchmark):
    found = decontaminate.decontaminate(docs, benchmark)
    assert found.columns == docs.columns
    return sorted(map(str, found.collect()))


def test_blocks(docs, benchmark, monkeypatch):
    whole, cleaned = rows_of(decontaminate.contamination(docs, benchmark)), cleaned_of(docs, benchmark)
    assert whole == brute()
    live, most = set(), []
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    send = decontaminate.phrase_blocks

    def watched(table):
        blocks, one = send(table)
        assert blocks > 4

        def sent(block):
            out = one(block)
            live.add(block)
            most.append(len(live))
            destroy = out.destroy
            out.destroy = lambda: (live.discard(block), destroy())
            return out

        return blocks, sent

    monkeypatch.setattr(decontaminate, "phrase_blocks", watched)
    assert rows_of(decontaminate.contamination(docs, benchmark)) == whole
    assert cleaned_of(docs, benchmark) == cleaned
    # One block at a time.
    assert set(most) == {1} and not live


def test_pieces_hold_every_phrase(spark, benchmark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE", 7)
    found = decontaminate.pieces(benchmark).collect()
    assert max(r.n for r in found) <= 7 + decontaminate.WINDOW - 1
    for item, text in ITEMS:
        words = decontaminate.words_of((text or "").encode())
        size = min(len(words), decontaminate.WINDOW)
        for begin in range(len(words) - size + 1 if words else 0):
            phrase = b" ".join(words[begin : begin + size]).decode()
            assert any(f" {phrase} " in f" {r.words} " for r in found if r["item"] == (item or ""))
