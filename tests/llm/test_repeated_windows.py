"""Repeated windows beside a plain version that compares all of them."""

import hashlib
import random

import pytest

import edge
from edge import edge_docs, no_docs  # noqa: F401  fixtures
from shelfwise.llm import cover_anchors as ca
from shelfwise.llm import queries

LAST = 2 ** 63 - 1


def plain(docs, window):
    """Sorted (id, words, removed, kept text) of (id, text) pairs."""
    split = [(i, (t or "").encode("utf-8", "surrogatepass").split()) for i, t in docs]
    least = {}
    for i, words in split:
        for at in range(len(words) - window + 1):
            key = tuple(words[at:at + window])
            least[key] = min(least.get(key, LAST), LAST if i is None else i)
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            if least[tuple(words[at:at + window])] < (LAST if i is None else i):
                gone |= set(range(at, at + window))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.id, r.n_words, r.n_removed, r.text) for r in df.collect()), key=str)


@pytest.mark.parametrize("v", sorted(ca.COVERS))
def test_covers(v):
    cover = ca.COVERS[v]
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert len(cover) * (len(cover) - 1) == v - 1


def test_every_window_holds_an_aligned_anchor():
    v = ca.period(50)
    places = set(ca.anchor_places(200, 50).tolist())
    for i in range(v):
        for j in range(v):
            assert any(i + s in places and j + s in places for s in range(v))


@pytest.mark.parametrize("window", [4, 12, 50])
def test_awkward_rows(spark, edge_docs, window):
    docs = [(r[0], r[1]) for r in edge.documents()]
    assert got(ca.without_repeats(edge_docs, window=window)) == plain(docs, window)


def test_small_alphabet_matches_at_all_offsets(spark):
    rng = random.Random(9)
    pool = [[rng.choice("abcdef") for _ in range(60)] for _ in range(6)]
    docs = []
    for i in range(120):  # pieces of a few passages at any offset, overlapping, with a changed word now and then
        words = []
        for _ in range(rng.randrange(6)):
            p = rng.choice(pool)
            a = rng.randrange(40)
            words += p[a:a + rng.randrange(5, 40)] + ([rng.choice("xyz")] if rng.random() < 0.4 else [])
        docs.append((rng.choice([i, i, i // 2, None]) if i % 7 == 0 else i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for window in (7, 13):
        want = plain(docs, window)
        assert sum(r[2] for r in want) > 500 and got(ca.without_repeats(df, window=window)) == want


def test_the_smallest_document_of_an_anchor_need_not_hold_the_window(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    middle, left, right = ([word() for _ in range(n)] for n in (30, 40, 40))
    docs = [(0, " ".join(middle))] + [(1, " ".join(left + middle + right)), (2, " ".join([word()] + left + middle))]
    docs += [(3, " ".join(middle + right)), (4, " ".join([word() for _ in range(60)]))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(ca.without_repeats(df)) == plain(docs, 50)
    assert [r[2] for r in plain(docs, 50)] == [0, 0, 70, 70, 0]


def test_query_and_spans(monkeypatch, spark, edge_docs):
    monkeypatch.setattr(queries, "table", lambda *a: edge_docs)
    rows = sorted((tuple(r) for r in queries.op12_cover_anchors(spark, "").collect()), key=str)
    assert rows == sorted(((i, n, gone, hashlib.sha256(t.encode()).hexdigest())
                           for i, n, gone, t in plain([(r[0], r[1]) for r in edge.documents()], 50)), key=str)
    for r in ca.without_repeats(edge_docs).collect():
        assert sum(s["end"] - s["begin"] for s in r.spans) == r.n_removed


def test_empty_table(spark, no_docs):
    assert got(ca.without_repeats(no_docs)) == []
