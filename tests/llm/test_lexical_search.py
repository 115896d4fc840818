"""Ranked search against plain scoring of every document; the bounds must not lose one."""

import math
import random
import re
from collections import Counter

import pytest

from claimledger.llm import lexical_search

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def plain_search(documents, items, top=10):
    docs = [(i, Counter(plain_terms(t))) for i, t in documents]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, held = sum(n for _, _, n in docs), Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in set(items):
        scored = []
        for doc_id, own, n in docs:
            m = 25 + 75 * n * len(docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * held[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 8 * m))
                for t in plain_terms(text)
                if t in own
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def benchmark(spark):
    return lambda rows: spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, score int")


def texts(seed, count, words):
    """Texts of uneven lengths over words of uneven frequency."""
    draw = random.Random(seed)
    names = [f"w{i}" for i in range(words)]
    return [" ".join(names[int(words * draw.random() ** 3)] for _ in range(int(1 + 300 * draw.random() ** 4))) for _ in range(count)]


@pytest.mark.parametrize("rounds", [lexical_search.ROUNDS, (1.0,), (0.3, 0.6, 1.0)])
def test_search_equals_plain_scoring(documents, benchmark, monkeypatch, rounds):
    monkeypatch.setattr(lexical_search, "ROUNDS", rounds)
    rows = list(enumerate(texts(1, 700, 300)))
    rows += [(1000 + i, rows[5][1]) for i in range(25)]  # copies: ties by id
    items = list(enumerate(texts(2, 40, 330))) + [(90, "w1 w1 w1 w250"), (91, "nowhere"), (92, "W5, w7.w9")]
    got = lexical_search.search(documents(rows), benchmark(items)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_search(rows, items)


def test_odd_rows(documents, benchmark, odd):
    rows = [*odd, (20, "É é straße 日本"), (21, "A-b_c a1 B"), (None, "a b"), (22, "a"), (22, "a"), (23, "x" * 50_000 + " a")]
    items = [(1, "a"), (1, "a"), (1, "b"), (None, "é A"), (2, None), (3, ""), (4, "日本 id"), (5, "c")]
    got = lexical_search.search(documents(rows), benchmark(items)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_search(rows, items)
    for d, b in ((rows, []), ([], items), ([(1, None)], items), ([], [])):
        assert lexical_search.search(documents(d), benchmark(b)).count() == 0


def test_queries_in_blocks(documents, benchmark, monkeypatch):
    rows, items = list(enumerate(texts(3, 120, 50))), list(enumerate(texts(4, 12, 50)))
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", 1500)
    got = lexical_search.search(documents(rows), benchmark(items), top=3).collect()
    assert sorted(map(tuple, got), key=repr) == plain_search(rows, items, 3)


def test_buckets_are_skipped():
    """With a threshold that only the first bucket meets, the others are not scored."""
    import numpy as np
    import pyarrow as pa

    def bucket(ids, impact):
        lists = [[0, 1]] * len(ids)
        length = [math.hypot(impact, impact)] * len(ids)
        columns = [pa.array(ids), pa.array(length), pa.array(lists, pa.list_(pa.int32())), pa.array([[impact] * 2] * len(ids))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "length", "terms", "impacts"])

    search = lexical_search.Search([(np.array([0, 1]), np.array([3, 4]))], [1], top=2)
    search.bucket(bucket([5, 4, 3], 100))
    assert search.least == [700]
    added = []
    search._add = lambda *hits: added.append(hits)
    search.bucket(bucket([1, 2], 99))
    assert not added
    search.bucket(bucket([1], 100))
    assert added
