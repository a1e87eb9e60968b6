import random
import re
import zlib
from collections import Counter, defaultdict
from math import exp, lgamma, log, log10

import numpy as np
import pytest

from ledgerlake.llm import context_tree as ct

TRAIN_IDS = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 7 != 2]
HELD_IDS = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 7 == 2]


class Tree:
    """Context-tree weighting, node by node."""

    def __init__(self, texts, depth):
        self.depth, self.nodes, self.children = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for text in texts:
            for context, prefix, bit in self.bits(text):
                for node in self.path(context, prefix):
                    self.nodes[node][bit] += 1
        for d, context, prefix in self.nodes:
            if d:
                self.children[d - 1, context[1:], prefix].add((d, context, prefix))
        self.weighted = {}
        for node in sorted(self.nodes, key=lambda n: -n[0]):
            own = self.kt(*self.nodes[node])
            below = sum(self.weighted[c] for c in self.children[node])
            self.weighted[node] = own if node[0] == depth else np.logaddexp(own, below) + log(0.5)

    def bits(self, text):
        padded = bytes(self.depth) + text + b"\0"
        for k in range(self.depth, len(padded)):
            prefix = 1
            for b in range(7, -1, -1):
                bit = padded[k] >> b & 1
                yield padded[k - self.depth:k], prefix, bit
                prefix = 2 * prefix + bit

    def path(self, context, prefix):
        return [(d, context[len(context) - d:], prefix) for d in range(self.depth + 1)]

    @staticmethod
    def kt(a, b):
        return lgamma(a + 0.5) + lgamma(b + 0.5) - 2 * lgamma(0.5) - lgamma(a + b + 1)

    def one(self, context, prefix):
        q = None
        for node in reversed(self.path(context, prefix)):
            a, b = self.nodes.get(node, (0, 0))
            own = (b + 0.5) / (a + b + 1)
            if q is None:
                q = own
            else:
                kt = self.kt(a, b)
                w = exp(kt - np.logaddexp(kt, sum(self.weighted[c] for c in self.children.get(node, ()))))
                q = w * own + (1 - w) * q
        return q

    def score(self, text):
        return sum(log10(q if bit else 1 - q) for context, prefix, bit in self.bits(text) for q in [self.one(context, prefix)])


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, depth):
    train = [lower(t) for i, t in docs if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    tree = Tree([t.encode() for t in train], depth)
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in docs:
        w = tokens(t)
        out.append((i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), n,
                    round(sum(log10((counts[x] + 1) / (n + v + 1)) for x in w), 4), round(tree.score(lower(t).encode()), 3)))
    return sorted(out, key=str)


def run(docs, depth):
    rows = ct.score(docs, depth).collect()
    return sorted(((*tuple(r)[:5], round(r["base_score"], 4), round(r["score"], 3)) for r in rows), key=str)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(ct, "BLOCK_BYTES", 150)
    monkeypatch.setattr(ct, "AT_ONCE", 40)
    monkeypatch.setattr(ct, "FAN_IN", 2)


@pytest.mark.parametrize("depth", [3, 5, 6])
def test_scores_equal_the_tree_node_by_node(docs_of, small, depth):
    rng = random.Random(depth)
    say = lambda: "".join(rng.choice("abC  é") for _ in range(rng.randint(0, 40)))
    docs = [(i, say()) for i in TRAIN_IDS[:25]] + [(i, say() + "zq") for i in HELD_IDS[:6]]
    assert run(docs_of(docs).repartition(3), depth) == brute(docs, depth)


def test_probabilities_of_all_bytes_add_up():
    texts = [b"abcabcabd", b"abd"]
    tree = Tree(texts, 3)
    total = 0.0
    for byte in range(256):
        p, prefix = 1.0, 1
        for b in range(7, -1, -1):
            bit, q = byte >> b & 1, tree.one(b"abc", prefix)
            p, prefix = p * (q if bit else 1 - q), 2 * prefix + bit
        total += p
    assert total == pytest.approx(1)


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.25, 1e3, 1e9])
    assert ct.log_gamma(x) == pytest.approx([lgamma(v) for v in x], rel=1e-12, abs=1e-12)


def test_seen_text_costs_less_than_unseen(docs_of):
    docs = [(i, "the cat sat on the mat and the dog sat on the rug") for i in TRAIN_IDS[:30]]
    docs += [(HELD_IDS[0], "the cat sat on the rug"), (HELD_IDS[1], "xqz vvj kkpw qq zzjx k")]
    got = {r["doc_id"]: r["score"] / r["n_bytes"] for r in ct.score(docs_of(docs)).collect()}
    assert got[HELD_IDS[0]] > 5 * got[HELD_IDS[1]]


def test_the_model_is_moved_once_however_many_blocks_ask(docs_of, small, monkeypatch):
    """Each key of the model is in one part, parts are about even, and none is copied for a group of blocks."""
    rng = random.Random(3)
    docs = [(i, "".join(rng.choice("abcdef ") for _ in range(60))) for i in TRAIN_IDS[:60]]
    moved, plain = [], ct.in_parts
    monkeypatch.setattr(ct, "in_parts", lambda rows, parts, depth: moved.append((parts, plain(rows, parts, depth))) or moved[-1][1])
    got = run(docs_of(docs).repartition(4), 3)
    assert got == brute(docs, 3)
    (parts, asked), (_, offered) = moved
    assert parts > 5
    model = [(r["kind"], r["bucket"], r["part"], k) for r in offered.collect() for k in ct.unpack(r["kind"], r["keys"], 3).tolist()]
    assert len(model) == len({(kind, bucket, k) for kind, bucket, _, k in model}) and {m[2] for m in model} == set(range(parts))
    wanted = {(r["kind"], r["bucket"], r["part"], k) for r in asked.collect() for k in ct.unpack(r["kind"], r["keys"], 3).tolist()}
    assert wanted == set(model)


def test_awkward_and_empty_tables(docs_of, awkward):
    short = [(i, t if t is None or len(t) < 1000 else t[:200]) for i, t in awkward]
    assert run(docs_of(short), 3) == brute(short, 3)
    assert ct.score(docs_of([])).collect() == []
    held = [(HELD_IDS[0], "no training text at all")]
    got = ct.score(docs_of(held)).collect()[0]
    assert got["base_score"] == 0 and got["score"] == pytest.approx(-8 * 24 * log10(2))
