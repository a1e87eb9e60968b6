import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ledgerlake.llm import runs as rn


def brute_runs(w, least=6, exponent=4):
    """For every period, the maximal stretches in which words that far apart are equal; kept if no smaller period fits."""
    found, n = {}, len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            stretch = (start, i + q - start)
            if stretch[1] >= max(least, exponent * q) and not any(q % p == 0 and a <= start and start + stretch[1] <= a + m for (a, p), m in found.items()):
                found[start, q] = stretch[1]
    return sorted((s, n, q) for (s, q), n in found.items())


def brute(doc_id, text, prepare=True):
    w = (text or "").encode().split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if prepare and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a, = [g % n]
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


def texts(seed, n, most=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        alphabet, w = "abcde"[:rng.randint(1, 5)], []
        while len(w) < rng.randint(0, most):
            if rng.random() < 0.4:
                w += [rng.choice(alphabet) for _ in range(rng.randint(1, 5))] * rng.randint(1, 9)
            else:
                w += [rng.choice(alphabet) for _ in range(rng.randint(1, 9))]
        out.append(w)
    return out


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (1, 2), (3, 3), (10, 2)])
def test_runs_equal_brute_force(least, exponent):
    words = texts(3, 400)
    got = rn.runs_of([np.array([ord(x) for x in w], np.int64) for w in words], least, exponent)
    assert got == [sorted(brute_runs(w, least, exponent), key=lambda r: (r[0], r[2])) for w in words]
    assert any(len(r) > 2 for r in got)


def test_shortest_is_what_any_run_needs():
    for least in range(1, 12):
        for exponent in range(2, 6):
            assert rn.shortest(least, exponent) == min(max(least, exponent * q) - q for q in range(1, 50))


def test_strongest_compares_exactly_and_by_start():
    big = 10**15
    assert rn.strongest([(5, 4 * big + 1, big), (9, 4 * (big + 1) + 1, big + 1)]) == (5, 4 * big + 1, big)
    assert rn.strongest([(0, 8, 2), (7, 12, 3)]) == (0, 8, 2) and rn.strongest([]) is None


@pytest.mark.parametrize("at_once", [1, 50, 1 << 20])
def test_rows_equal_brute_force_at_any_batch(spark, docs_of, awkward, monkeypatch, at_once):
    monkeypatch.setattr(rn, "WORDS_AT_ONCE", at_once)
    docs = [(k, " \t".join(w)) for k, w in enumerate(texts(9, 150))] + [r for r in awkward if len(r[1] or "") < 100_000]
    got = rn.periodic_runs(docs_of(docs), prepare=rn.with_tail).drop("runs").collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute(*d) for d in docs), key=str)


def test_one_word_many_times_and_long_periods(spark, docs_of):
    rng = random.Random(1)
    stretch = [str(rng.randrange(10**6)) for _ in range(2000)]
    docs = [(1, "word " * 30_000), (2, " ".join(["x"] + stretch * 5 + ["y"])), (4, "a b " * 3 + "c " + "d e f " * 40)]
    got = {r["doc_id"]: r for r in rn.periodic_runs(docs_of(docs)).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 30_000, 1)] and got[1]["exponent_milli"] == 30_000_000
    assert [tuple(x) for x in got[2]["runs"]] == [(1, 10_000, 2000)]
    assert [tuple(x) for x in got[4]["runs"]] == [(7, 120, 3)]
    assert got[4]["collapsed_sha256"] == hashlib.sha256(b"a b a b a b c d e f").hexdigest()


def test_awkward_rows_and_empty_table(spark, docs_of, awkward):
    got = rn.periodic_runs(docs_of(awkward)).collect()
    assert len(got) == len(awkward) and docs_of([]).transform(rn.periodic_runs).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r["n_runs"], r["start"], r["runs_sha256"], r["collapsed_sha256"]) == (0, None, empty, empty) for r in got if r["doc_id"] in (1, 2, 3))
