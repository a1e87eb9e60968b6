import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import substring_dedup as sd
from ledgerlake.llm.suffix_groups import suffix_arrays


def brute(docs):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[k:k + 200] for t in texts for k in range(len(t) - 199))
    out = []
    for (doc_id, _), t in zip(docs, texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if seen[t[k:k + 200]] > 1:
                gone[k:k + 200] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        edges = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        out.append((doc_id, len(t), int(gone.sum()), int((edges > 0).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs):
    return sorted((tuple(r)[:5] for r in sd.remove_repeats(docs).collect()), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    say = lambda k: "".join(rng.choice("abcdefgh é\n") for _ in range(k))
    shared = [say(k) for k in (150, 199, 200, 201, 260, 400, 900)]
    docs = []
    for k in range(n):
        kind = rng.randrange(6)
        if kind == 0:
            text = say(rng.randint(0, 600))
        elif kind == 1:
            text = say(rng.randint(0, 300)) + rng.choice(shared) + say(rng.randint(0, 300)) + rng.choice(shared)
        elif kind == 2 and docs:
            text = rng.choice(docs)[1]
        elif kind == 3 and docs:
            text = list(rng.choice(docs)[1])
            for _ in range(rng.randint(1, 6)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice("xyz")
            text = "".join(text)
        elif kind == 4:
            text = say(7) * rng.randint(1, 120)
        else:
            text = rng.choice(["a", "ab", "é"]) * rng.randint(1, 700)
        docs.append((k, text))
    return docs


def test_suffix_arrays_of_many_strings_at_once():
    rng = random.Random(1)
    for _ in range(150):
        strings = []
        for j in range(rng.randint(1, 6)):
            k = rng.choice([1, 2, 3])
            body = [rng.randint(50, 50 + k) for _ in range(rng.randint(0, 60))]
            strings.append(body + [0] if rng.random() < 0.5 else body + [0] + body + [1])
        got = suffix_arrays(np.concatenate([np.array(s) for s in strings]), np.array([len(s) for s in strings]))
        at = 0
        for s in strings:
            assert got[at:at + len(s)].tolist() == [at + k for k in sorted(range(len(s)), key=lambda k: s[k:])]
            at += len(s)


def test_equal_windows_have_equal_seeds():
    rng = random.Random(2)
    common = bytes(rng.choice(b"abc") for _ in range(700))
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) + common + b"tail" * 30 for n in (0, 13, 500)]
    found = sd.seeds(texts)
    per_text = []
    for t in range(3):
        shift = len(texts[t]) - 120 - 700
        windows = {x - shift: (h, p - x) for h, k, p, a, b in zip(*(found[c].tolist() for c in ("hash", "text", "at", "low", "high"))) if k == t for x in range(a, b + 1)}
        assert sorted(windows) == list(range(-shift, len(texts[t]) - 199 - shift))
        per_text.append([windows[x] for x in range(501)])
    assert per_text[0] == per_text[1] == per_text[2]


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_removed_bytes_equal_brute_force(docs_of, monkeypatch, seed):
    monkeypatch.setattr(sd, "BLOCK_BYTES", 5000)
    monkeypatch.setattr(sd, "PIECE", 300)
    monkeypatch.setattr(sd, "PER_BUCKET", 20)
    docs = corpus(seed)
    assert run(docs_of(docs)) == brute(docs)


@pytest.mark.parametrize("tile, hot", [(3, 20_000), (96, 2), (2, 4)])
def test_a_line_that_many_texts_hold(docs_of, monkeypatch, tile, hot):
    monkeypatch.setattr(sd, "BLOCK_BYTES", 8000)
    monkeypatch.setattr(sd, "TILE", tile)
    monkeypatch.setattr(sd, "HOT", hot)
    rng = random.Random(9)
    say = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    docs = []
    for size in (150, 190, 199, 200, 203, 230):
        line = say(size)
        docs += [(len(docs) + k, say(rng.randint(0, 80)) + line + say(rng.randint(0, 80))) for k in range(12)]
    docs += [(900, docs[30][1]), (901, docs[40][1])]
    assert run(docs_of(docs)) == brute(docs)


def test_strings_of_a_seed_are_compared_by_one_window_of_each_class(monkeypatch):
    """Many contexts of one seed in strings of three: the same marks as with all of them in one string."""
    rng = np.random.default_rng(5)
    before, windows, data = [], [], []
    for _ in range(40):
        n = int(rng.integers(1, sd.REACH + 1))
        windows.append(n)
        before.append(sd.REACH - 1 if n == sd.REACH else int(rng.integers(n - 1, sd.REACH)))
        data.append(rng.integers(97, 99, n + sd.REACH - 2) if rng.random() < 0.4 else np.full(n + sd.REACH - 2, 97))
    seed = np.repeat(np.array([3, 8], "u8"), 20)
    args = seed, np.array(before), np.array(windows), np.concatenate(data)
    at_once = sd.equal_windows(*args)
    held, marks = Counter(), []
    for s, b, n, d in zip(seed.tolist(), before, windows, data):
        own = [(s, b - x, tuple(d[x:x + sd.REACH - 1].tolist())) for x in range(n)]
        held.update(own)
        marks += own
    assert at_once.tolist() == [held[w] > 1 for w in marks] and 0 < at_once.sum() < len(at_once)
    monkeypatch.setattr(sd, "TILE", 3)
    assert sd.equal_windows(*args).tolist() == at_once.tolist()


def test_no_task_gathers_the_contexts_of_a_hot_seed(spark, docs_of, monkeypatch, tmp_path):
    """A line in each text: its contexts are dealt by their own hash, and no group holds more of a seed than HOT."""
    monkeypatch.setattr(sd, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(sd, "HOT", 10)
    rng = random.Random(12)
    say = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    line = say(190)
    docs = [(k, say(60) + line + say(60)) for k in range(60)] + [(100 + k, say(40) + say(160) * 2) for k in range(10)]
    docs += [(200, docs[0][1]), (201, docs[0][1])]
    dealt = []
    plain = sd.deal
    monkeypatch.setattr(sd, "deal", lambda rows, bits: dealt.append(plain(rows, bits)) or dealt[-1])
    assert run(docs_of(docs)) == brute(docs)
    groups = {}
    for r in dealt[0].collect():
        groups.setdefault((r["what"], r["dealt"]), []).extend(np.frombuffer(r["keys"], "<u8").tolist())
    assert max(max(Counter(k).values(), default=0) for (what, _), k in groups.items() if what == "seed") <= 10
    assert sum(len(k) for (what, _), k in groups.items() if what == "context") > 60
    assert sum(what == "context" for what, _ in groups) > 1


def test_kept_text_and_spans(docs_of):
    line = "".join(random.Random(4).choice("abcdefgh") for _ in range(250))
    docs = [(1, "one " + line + " end"), (2, line + "two")]
    got = {r["doc_id"]: r for r in sd.remove_repeats(docs_of(docs)).collect()}
    assert bytes(got[1]["kept"]) == b"one  end" and [tuple(s) for s in got[1]["spans"]] == [(4, 254)]
    assert bytes(got[2]["kept"]) == b"two"


def test_awkward_and_empty_tables(docs_of, awkward):
    assert run(docs_of(awkward)) == brute(awkward)
    assert run(docs_of([])) == []
    assert run(docs_of([(1, None), (2, "")])) == brute([(1, None), (2, "")])
