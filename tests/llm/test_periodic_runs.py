"""Periodic runs against a plain scan over all periods, and what the query plants and digests."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from claimledger.llm import periodic_runs
from claimledger.llm.common import table
from claimledger.llm.queries import QUERIES, planted
from tests.conftest import SMALL


def plain_runs(words):
    """For each period in turn, the longest stretches in which words that far apart are equal."""
    out = []
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if length >= max(24, 3 * q) and not any(
                words[at : at + length - p] == words[at + p : at + length] for p in range(1, q)
            ):
                out.append((at, length, q))
            at = end + 1
    return sorted(out, key=lambda run: (run[0], run[2]))


def plain_kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def periodic_texts(seed, count):
    draw = random.Random(seed)
    for _ in range(count):
        words, goal = [], draw.randint(0, 160)
        while len(words) < goal:
            base = [str(draw.randrange(draw.choice([1, 2, 3, 40]))) for _ in range(draw.randint(1, 13))]
            words += (base * draw.randint(1, 30))[: draw.randint(1, 90)]
        yield words


def test_runs_equal_a_plain_scan():
    found = 0
    for words in periodic_texts(1, 1500):
        runs = periodic_runs.runs_of(periodic_runs.numbered([w.encode() for w in words])) if words else []
        assert runs == plain_runs(words)
        assert not runs or periodic_runs.suspects([" ".join(words).encode()])[0]
        found += len(runs)
    assert found > 1000


@pytest.mark.parametrize("period", [1, 2, 7, 8, 9, 500])
def test_limits_of_length(period):
    base = [f"w{i}" for i in range(period)]
    least = max(24, 3 * period)
    for length, wanted in ((least - 1, []), (least, [(2, least, period)])):
        words = ["x", "y", *(base * (length // period + 1))[:length], "z"]
        assert periodic_runs.runs_of(periodic_runs.numbered([w.encode() for w in words])) == wanted


def test_positions_keep_order():
    draw = random.Random(4)
    values = draw.sample(range(10**6), 5000)
    have = periodic_runs.Positions(values[0])
    for at, value in enumerate(values[1:], 1):
        if at % 50 == 0:
            known = sorted(values[:at])
            below, above = have.around(value)
            place = int(np.searchsorted(known, value))
            assert below == (known[place - 1] if place else None)
            assert above == (known[place] if place < len(known) else None)
        have.add(value)
    assert list(have) == sorted(values) and have.size == len(values) and len(have.chunks) > 4


def test_strongest_is_exact():
    # 3 + 1/3 is less than 3 + 334/1000; as doubles far apart periods may tie
    runs = [(5, 10**15 + 1, 3), (4, 10**15 + 2, 3), (9, 10**15 + 2, 3)]
    assert periodic_runs.strongest(runs) == (4, 10**15 + 2, 3)
    assert periodic_runs.strongest([(7, 48, 4), (7, 24, 2)]) == (7, 24, 2)
    assert periodic_runs.strongest([]) is None


def test_odd_rows(documents, odd):
    long_run = " ".join(f"w{i % 7000}" for i in range(21_000))
    rows = [*odd, (7, long_run), (8, long_run + " end"), (9, "日本 é " * 20), (10, "a\vb c " * 30)]
    got = periodic_runs.find_runs(documents(rows)).collect()
    assert len(got) == len(rows)
    for row in got:
        words = (row.text or "").encode().split()
        assert row.n_words == len(words)
        if row.doc_id not in (4, 7, 8):
            runs = plain_runs(words)
            assert [tuple(r) for r in row.runs] == runs
            assert row.collapsed.encode() == b" ".join(plain_kept(words, runs))
    by_id = {row.doc_id: row for row in got}
    assert [tuple(r) for r in by_id[4].runs] == [(0, 30_000, 1)] and by_id[4].collapsed == "word"
    assert tuple(by_id[7].strongest) == (0, 21_000, 7000) and by_id[8].collapsed.endswith("w6999 end")
    assert by_id[1].strongest is None and by_id[1].collapsed == "" and by_id[10].n_words == 60
    assert periodic_runs.find_runs(documents([])).count() == 0


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    rows = table(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    some = 0
    for doc_id, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            continue
        runs, row = plain_runs(words), got[doc_id]
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        told = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(b" ".join(plain_kept(words, runs))).hexdigest()
        some += bool(runs)
    assert some >= 5


def test_planting_takes_odd_rows(documents):
    rows = [(i, t) for i in range(60) for t in (None, "", " ", "a", "a b c d e")]
    made = planted(documents(rows)).collect()
    assert len(made) == len(rows) and all(len((r.text or "").split()) in (0, 1, 5) for r in made)
