import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlake.llm import near_dup as nd
from ledgerlake.llm.phrase_index import words


def shingle_counts(text):
    w = words(text or "")
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def similarity(x, y):
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def brute(docs):
    """Least id of the component of each row."""
    parent = list(range(len(docs)))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    counts = [shingle_counts(t) for _, t in docs]
    for i in range(len(docs)):
        for j in range(i):
            same = words(docs[i][1] or "") == words(docs[j][1] or "") and (counts[i] or (docs[i][1] or "") == (docs[j][1] or ""))
            if same or (counts[i] and similarity(counts[i], counts[j]) >= 0.8):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for k in range(len(docs)):
        groups[find(k)].append(docs[k][0])
    return sorted(((docs[k][0], min((i for i in groups[find(k)] if i is not None), default=None), len(groups[find(k)])) for k in range(len(docs))), key=str)


def run(docs):
    return sorted(((r["doc_id"], r["class_id"], r["class_size"]) for r in nd.near_duplicates(docs).collect()), key=str)


def corpus(seed, n_bases=12, copies=12):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    out = []
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for b in range(n_bases):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 120, 300]))]
        if b % 3 == 0:
            base = base[:20] * 3 + base  # repeated shingles
        if b % 4 == 0:
            base = base[:len(base) // 2] + passage + base[len(base) // 2:]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            out.append(" ".join(text))
    return [(k, t) for k, t in enumerate(out)]


def test_similarity_equals_its_definition():
    rng = random.Random(1)
    for _ in range(200):
        x, y = (Counter(rng.choices(range(8), k=rng.randint(1, 20))) for _ in range(2))
        pair = [(np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)], float)) for c in (x, y)]
        assert nd.probability_jaccard(*pair) == pytest.approx(similarity(x, y))


def test_registers_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(2)
    a = rng.integers(1, 1 << 60, 300).astype(np.uint64)
    b = np.concatenate((a[:240], a[:40], rng.integers(1, 1 << 60, 60).astype(np.uint64)))
    want = similarity(Counter(a.tolist()), Counter(b.tolist()))
    got = np.mean([np.mean(np.equal(*nd.registers([a + np.uint64(k), b + np.uint64(k)]))) for k in range(20)])
    assert got == pytest.approx(want, abs=0.03)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_classes_equal_brute_force(docs_of, seed):
    docs = corpus(seed)
    assert run(docs_of(docs)) == brute(docs)


def test_large_hubs_are_cut_into_tiles(docs_of, monkeypatch):
    monkeypatch.setattr(nd, "TILE_TEXTS", 5)
    docs = corpus(4, n_bases=3, copies=40)
    assert run(docs_of(docs)) == brute(docs)


def test_keep_one_row_of_each_class(docs_of):
    docs = corpus(5) + [(703, "alpha beta gamma"), (703, "alpha beta gamma"), (900, "ALPHA, beta gamma!")]
    table = docs_of(docs)
    kept = nd.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c, _ in brute(docs)})


def test_long_chains_end_in_one_class(docs_of):
    words_ = [f"v{k}" for k in range(400)]
    docs = [(k, " ".join(words_[k * 4:k * 4 + 100])) for k in range(40)]
    assert run(docs_of(docs)) == brute(docs)


def test_awkward_and_empty_tables(docs_of, awkward):
    assert run(docs_of(awkward)) == brute(awkward)
    assert nd.keep_one(docs_of(awkward)).count() == len({tuple(words(t or "") or [t or ""]) for _, t in awkward})
    assert run(docs_of([])) == []
    assert nd.keep_one(docs_of([])).count() == 0
