"""Periodic runs of words, by Kruskal over suffix classes in descending order of their common prefix.

A run is a maximal stretch of words with smallest period q and a length of at least `exponent` * q. Each text is
turned into numbers; suffixes are ranked by doubling, for many texts at once. A run of period q starts at two suffixes
q apart whose common prefix is its length less q, so where only runs of at least `exponent` periods and `least` words are
asked for, suffixes that share fewer than a known number of words with any other take no part (`shortest`).

What is left is united by falling common prefix: each class of suffixes is an ordered set of positions (union-find,
the smaller set goes into the larger). Two positions that become neighbours in a set at a common prefix of l words,
p <= l apart, seed a run of period p that ends l words after the second one: nothing lies between them in the class,
hence no smaller period. All first positions of a run are met this way, so the least one is its start, exactly.

Texts are independent, so nothing is shuffled. A batch of texts is bounded in words; a longer text is a batch of its own.

Defined cases: null and blank texts have no words and no runs; the longest exponent wins with ties to the least start,
then the least period; rows repeated with one doc_id are each answered; an empty table gives no rows.
"""
from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

#: A run has at least so many words, and at least so many periods.
LEAST, EXPONENT = 6, 4
#: Words that are ranked at once.
WORDS_AT_ONCE = 1 << 20


def shortest(least: int, exponent: int) -> int:
    """The least common prefix that the first two periods' suffixes of any run asked for can have."""
    return min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1))


def suffix_order(words: np.ndarray, sizes: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share `shared` words or more with another one of their text, sorted; common prefixes with the one before.

    `words` are the texts' words one after the other, as numbers. A common prefix below `shared` is given as 0.
    """
    n = len(words)
    text = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    # Ranks of single words are told apart by text, so that classes never hold positions of two texts.
    key = text * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(key)
    key = key[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1]))[:n], np.arange(n), 0))
    levels, span = [], 1
    active = np.arange(n)
    while len(active):
        # Of each class of more than one position, by the next `span` words. A suffix that ends there comes first.
        count = np.bincount(rank[active], minlength=n)
        active = active[count[rank[active]] > 1]
        if not len(active):
            break
        levels.append((span, active, rank[active]))
        ahead = active + span
        inside = ahead < end[active]
        follow = np.where(inside, rank[np.minimum(ahead, n - 1)], -1)
        order = np.argsort(rank[active] * (n + 1) + follow + 1)  # a class and what follows as one number
        o, f = rank[active][order], follow[order]
        new_class = np.ones(len(order), bool)
        new_class[1:] = o[1:] != o[:-1]
        new = new_class.copy()
        new[1:] |= f[1:] != f[:-1]
        at = np.arange(len(order))
        within = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(new_class, at, 0))
        rank[active[order]] = o + within
        span *= 2
    # Suffixes in order, and by how many words neighbours agree: from the longest span down, add it where both are in one class.
    held = [where for span, where, _ in levels if span <= shared < 2 * span]
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = held[0]
    order = held[np.argsort(rank[held], kind="stable")]
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(left), np.int64)
    for span, where, ranks in reversed(levels):
        table_ = np.full(n + 1, -1, np.int64)
        table_[where] = ranks
        a, b = table_[np.minimum(left + common, n)], table_[np.minimum(right + common, n)]
        # Positions behind a text's end belong to the next text, whose classes are its own.
        common += np.where((a == b) & (a >= 0), span, 0)
    common = np.concatenate(([0], common))
    common[common < shared] = 0
    keep = (common > 0) | np.concatenate((common[1:] > 0, [False]))
    return order[keep], common[keep]


def united(order: np.ndarray, common: np.ndarray, exponent: int) -> dict[tuple[int, int], int]:
    """(period, end) -> start of every run of at least `exponent` periods among the suffixes given."""
    found: dict[tuple[int, int], int] = {}
    sets: list[list[int]] = [[p] for p in order.tolist()]
    parent = list(range(len(sets)))
    p_end = int(order.max(initial=0)) + 1
    edges = np.nonzero(common)[0]
    edges = edges[np.argsort(-common[edges], kind="stable")]
    for k, l in zip(edges.tolist(), common[edges].tolist()):
        a = k
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        b = k - 1
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        small, large = sets[a], sets[b]
        if len(small) > len(large):
            small, large, a, b = large, small, b, a
        parent[a] = b
        reach = l // (exponent - 1)  # two positions further apart seed no run of so many periods
        at = 0  # behind the last one put in
        for p, following in zip(small, [*small[1:], p_end]):
            last, at = at - 1, bisect_left(large, p, at)
            if at < len(large) and large[at] - p <= reach and large[at] < following:
                key = (large[at] - p, large[at] + l)
                if found.get(key, p_end) > p:
                    found[key] = p
            if at and at - 1 != last and p - large[at - 1] <= reach:
                before = large[at - 1]
                key = (p - before, p + l)
                if found.get(key, p_end) > before:
                    found[key] = before
            large.insert(at, p)
            at += 1
        sets[a] = []
    return found


def runs_of(texts: list[np.ndarray], least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text (its words as numbers), by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    words = np.concatenate(texts) if len(texts) else np.zeros(0, np.int64)
    order, common = suffix_order(words, sizes, shortest(least, exponent))
    ends = np.cumsum(sizes)
    for (period, end), start in united(order, common, exponent).items():
        if end - start >= max(least, exponent * period):
            k = int(np.searchsorted(ends, start, side="right"))
            begin = int(ends[k] - sizes[k])
            out[k].append((start - begin, end - start, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, compared as integers; ties: the least start, then period."""
    best = None
    for run in runs:  # by start, then period: only a greater exponent replaces
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    kept, upto = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in runs):
        if end > upto:
            kept += words[upto:max(begin, upto)]
            upto = end
    return kept + words[upto:]


def with_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """One text in ten, by the hash of its id, ends in a repeated stretch of its own."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a:a + p]
    return words[:a] + (stretch * (-(-(n - a) // p)))[:n - a]


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT, prepare=None) -> DataFrame:
    """One row per row of `docs` (doc_id, text): its runs, the strongest one, digests of the runs and of the text without repeats.

    `prepare(words, doc_id)` may change a text's words first.
    """
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def answer(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        numbers = [np.fromiter((known.setdefault(w, len(known)) for w in t), np.int64, len(t)) for t in texts]
        rows = {c: [] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs")}
        for doc_id, words, runs in zip(ids, texts, runs_of(numbers, least, exponent)):
            start, length, period = strongest(runs) or (None, None, None)
            listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            row = (doc_id, len(runs), start, length, period, None if start is None else 1000 * length // period,
                   hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
                   [{"start": s, "length": n, "period": p} for s, n, p in runs])
            for c, v in zip(rows, row):
                rows[c].append(v)
        kinds = [*[pa.int64()] * 6, pa.string(), pa.string(), pa.list_(struct)]
        return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(rows.values(), kinds)], names=list(rows))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()  # bytes split at the six ASCII blanks only
                if prepare:
                    words = prepare(words, doc_id)
                if ids and size + len(words) > WORDS_AT_ONCE:
                    yield answer(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
        if ids:
            yield answer(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, SCHEMA)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), prepare=with_tail).drop("runs")
