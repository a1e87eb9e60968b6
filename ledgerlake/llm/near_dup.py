"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A text is the multiset of its five-word shingles; the similarity of two texts is the probability Jaccard
    J_P(x, y) = sum over common d of 1 / sum over d' of max(x[d'] / x[d], y[d'] / y[d]),
which for texts without repeated shingles is the Jaccard coefficient. Texts of `THRESHOLD` or more are linked;
classes are the connected components.

1. Each shingle is a Poisson process whose rate is its multiplicity; every arrival goes to one of BANDS * ROWS
   registers, which keep their earliest arrival. Arrivals of a text end as soon as none can be early enough.
   A register of two texts agrees with probability J_P.
2. Texts with the same words are one from here on. Registers are cut into bands; texts that agree in a whole band
   share a bucket. At 0.8, all 48 bands of 7 miss a pair with a probability of 1.3e-5.
3. All texts of a bucket meet under the bucket's least text, its hub: a text goes to each of its hubs once, however
   many buckets it shares with it. Large hubs are cut into tiles, and every pair of tiles meets in a task of its own.
4. There, one matrix product bounds J_P from above for all pairs (by the mass of either text that the other covers),
   and pairs above the bound are measured exactly. Of the links found only a spanning star per component leaves
   the task, so a group of n copies gives n rows, not n * n.
5. Components by propagating the least text and jumping to the label's label, on written tables.

Defined cases: null counts as empty; texts without words are alike if equal; texts of fewer than five words are one
shingle of all; words are compared without case and punctuation; repeated rows are members like others; a null
doc_id is a member, and represents its class only if all ids there are null; other columns are not looked at.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import clean_text, saved, scratch, table, word_hashes
from .phrase_index import words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 48, 7
REGISTERS = BANDS * ROWS
#: A tile of a hub holds about so many texts, or bytes if that is less.
TILE_TEXTS, TILE_BYTES = 768, 4 << 20
#: Shingles that are hashed at once.
AT_ONCE = 300_000

U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (finalizer of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(tokens: list[bytes]) -> np.ndarray:
    """Hashes of all shingles, in order."""
    h = word_hashes(tokens)
    size = min(SHINGLE, len(h))
    if not size:
        return h
    out = np.zeros(len(h) - size + 1, U)
    for k in range(size):
        out = _mix(out + h[k:len(h) - size + 1 + k] + U(k + 1))
    return out


def multisets(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, shingle and multiplicity, ordered, of all texts' different shingles."""
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    h = np.concatenate(parts) if parts else np.zeros(0, U)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.nonzero(first)[0]
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def registers(parts: list[np.ndarray]) -> np.ndarray:
    """ProbMinHash registers of each text: the shingle with the earliest arrival."""
    doc, h, weight = multisets(parts)
    time, best = np.full(len(parts) * REGISTERS, np.inf), np.zeros(len(parts) * REGISTERS, U)
    now, seed, weight = np.zeros(len(h)), h.copy(), weight.astype(float)
    keep = np.arange(len(h))
    while len(keep):
        seed[keep] = draw = _mix(seed[keep] + U(0x9E3779B97F4A7C15))
        now[keep] += -np.log1p(-(draw >> U(11)).astype(float) * 2.0**-53) / weight[keep]
        at = doc[keep] * REGISTERS + (_mix(draw ^ U(0xD6E8FEB86659FD93)) % U(REGISTERS)).astype("i8")
        np.minimum.at(time, at, now[keep])
        won = time[at] == now[keep]
        best[at[won]] = h[keep[won]]
        last = time.reshape(-1, REGISTERS).max(axis=1)
        keep = keep[now[keep] < last[doc[keep]]]  # later arrivals of the others can win no register
    return best.reshape(-1, REGISTERS)


def band_keys(best: np.ndarray) -> np.ndarray:
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), (len(best), BANDS)).copy()
    for k in range(ROWS):
        key = _mix(key + best.reshape(len(best), BANDS, ROWS)[:, :, k])
    return key


def text_key(text: str, tokens: list[bytes]) -> bytes:
    """Equal for texts of the same words."""
    return hashlib.blake2b(b" ".join(tokens) if tokens else b"\n" + text.encode(), digest_size=16).digest()


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and its digest: id and digest tell rows apart, but for repeated ones."""
    text = clean_text(F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, digest, key, n_bytes, bands of each row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = 0
            texts = batch.column(1).to_pylist()
            while k < len(texts):
                part, keys, sizes, total, start = [], [], [], 0, k
                while k < len(texts) and total < AT_ONCE:
                    tokens = words(texts[k])
                    part.append(shingles(tokens))
                    keys.append(text_key(texts[k], tokens))
                    sizes.append(len(texts[k]))
                    total, k = total + len(tokens), k + 1
                bands = band_keys(registers(part)).view("i8")
                bands = [b if len(p) else [] for b, p in zip(bands, part)]
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c).slice(start, k - start) for c in (0, 2)],
                    pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "digest", "key", "n_bytes", "bands"])

    return saved(_rows(docs).mapInArrow(sign, "doc_id long, digest binary, key binary, n_bytes long, bands array<long>"), "signatures")


def different_texts(signed: DataFrame) -> DataFrame:
    """t (a number), key, n_bytes, bands, and the row that brings the text (doc_id, digest), of all different texts."""
    row = F.struct("doc_id", "digest", "n_bytes", "bands")
    texts = signed.groupBy("key").agg(F.min(row).alias("r")).select("key", "r.*")
    return saved(texts.withColumn("t", F.monotonically_increasing_id()), "texts")


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """J_P of two weighted sets (sorted elements, weights).

    With the ratios r = y / x in order, the inner sum for a common d is, over x[d]: the x of elements whose ratio is
    at most r[d], plus the y of the others over y[d].
    """
    every = np.union1d(a[0], b[0])
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a[0])], y[np.searchsorted(every, b[0])] = a[1], b[1]
    with np.errstate(divide="ignore"):
        ratio = np.where(x > 0, y / np.where(x > 0, x, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    ratio, x, y = ratio[order], x[order], y[order]
    below, above = np.cumsum(x), y.sum() - np.cumsum(y)
    # equal ratios: x over x[d] and y over y[d] are the same there, so where the cut falls does not matter
    common = (x > 0) & (y > 0)
    return float((1 / (below[common] / x[common] + above[common] / y[common])).sum())


def links(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Spanning stars over the linked pairs among `left`, or between `left` and `right` if given; texts are numbered through."""
    parts = [shingles(words(t)) for t in (*left, *right)]
    n, cut = len(parts), len(left) if right else 0
    doc, h, weight = multisets(parts)
    mass = np.bincount(doc, weight, n)
    sizes = np.bincount(doc, minlength=n)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    plain = np.array([mass[k] == sizes[k] for k in range(n)])
    _, column, counts = np.unique(h, return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    columns = np.cumsum(counts > 1) - 1
    d, c, w = doc[shared], columns[column[shared]], weight[shared]
    rows, cols = (np.arange(cut), np.arange(cut, n)) if right else (np.arange(n), np.arange(n))
    covered, covers = np.zeros((len(rows), len(cols)), np.float32), np.zeros((len(rows), len(cols)), np.float32)
    by = np.argsort(c, kind="stable")
    d, c, w = d[by], c[by], w[by]
    block = max(256, (8 << 20) // max(1, n))
    for k in range(0, int(c[-1]) + 1 if len(c) else 0, block):
        low, high = np.searchsorted(c, (k, k + block))
        has = np.zeros((n, min(block, int(c[-1]) + 1 - k)), np.float32)
        share = has.copy()
        has[d[low:high], c[low:high] - k] = 1
        share[d[low:high], c[low:high] - k] = w[low:high] / mass[d[low:high]]
        covered += share[rows] @ has[cols].T  # mass of the row's text that the column's holds
        covers += has[rows] @ share[cols].T
    possible = np.minimum(covered, covers) >= THRESHOLD - 1e-4
    parent = list(range(n))

    def find(v: int) -> int:
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    for i, j in zip(*np.nonzero(possible)):
        a, b = int(rows[i]), int(cols[j])
        if a == b or (not right and b < a) or find(a) == find(b):
            continue
        if plain[a] and plain[b]:
            common = round(float(covered[i, j]) * sizes[a])
            alike = common / (sizes[a] + sizes[b] - common)
        else:
            alike = probability_jaccard(*((h[ends[v]:ends[v + 1]], weight[ends[v]:ends[v + 1]].astype(float)) for v in (a, b)))
        if alike >= THRESHOLD - 1e-9:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return [(find(v), v) for v in range(n) if find(v) != v]


def candidates(texts: DataFrame) -> DataFrame:
    """hub, t, tile, tiles: every text once for each hub that it shares a bucket with; hubs themselves too."""
    buckets = texts.select("t", "n_bytes", F.explode("bands").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("t").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "hub")
    members = saved(buckets.join(hubs, "bucket").select("hub", "t", "n_bytes").distinct(), "hub-members")
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes"))
    tiles = F.ceil(F.greatest(F.col("n") / TILE_TEXTS, F.col("bytes") / TILE_BYTES))
    # written, so that the members of a large hub are not dealt by hub for the sum, and the join may split them
    placed = members.join(saved(sizes.select("hub", tiles.alias("tiles")), "hub-sizes"), "hub")
    return placed.select("hub", "t", F.pmod(F.xxhash64("t"), F.col("tiles")).alias("tile"), "tiles")


def same_row(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on id and digest; a null id equals a null id."""
    right = right.withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    return left.join(right, left["doc_id"].eqNullSafe(right["_id"]) & (left["digest"] == right["_digest"]), how).drop("_id", "_digest")


def linked(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b (numbers of texts): stars that span the linked texts of every group."""
    hubs = candidates(texts).groupBy("t").agg(F.collect_list(F.struct("hub", "tile", "tiles")).alias("hubs"))  # a hub per band at most
    wanted = texts.select("t", "doc_id", "digest").join(hubs, "t")
    at = same_row(_rows(docs), wanted).dropDuplicates(["doc_id", "digest"])
    at = at.select("t", "text", F.explode("hubs").alias("p")).select("t", "text", "p.*")
    at = at.select("t", "text", "hub", "tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other"))
    group = [F.col("hub"), F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")]
    at = at.select(*group, (F.col("tile") > F.col("other")).alias("right"), "t", "text")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list) -> pa.RecordBatch:
            crossing = held[0][0][1] != held[0][0][2]
            left, right = ([r for r in held if r[1] == side] for side in (False, True))
            keys = [r[2] for r in (*left, *right)]
            found = links([r[3] for r in left], [r[3] for r in right]) if left and (right or not crossing) else []
            return pa.RecordBatch.from_arrays([pa.array([keys[x[k]] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        held: list = []
        for batch in batches:
            for *where, right, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != where:
                    yield done(held)
                    held = []
                held.append((where, right, key, text))
        if held:
            yield done(held)

    met = at.repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high")
    return met.mapInArrow(meet, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """t, label: the least number of every component that has an edge.

    Each pass takes the least label among a text and its neighbours, then that label's own label. Stars stay
    stars, so that few passes are needed; every pass is written, so that a lost executor costs one read.
    """
    edges = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = saved(both.groupBy(F.col("a").alias("t")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        offered = both.join(labels.withColumnRenamed("t", "b"), "b").select(F.col("a").alias("t"), "label")
        least = labels.unionByName(offered).groupBy("t").agg(F.min("label").alias("label"))
        jumped = labels.select(F.col("t").alias("label"), F.col("label").alias("further"))
        after = least.join(jumped, "label").select("t", F.least("label", "further").alias("label"))
        after = saved(after.join(labels.withColumnRenamed("label", "was"), "t"), "labels")
        changed = after.where(F.col("label") != F.col("was")).limit(1).count()
        labels = after.select("t", "label")
        if not changed:
            return labels


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, digest, label (a number of the class) of each row of `docs`."""
    with scratch(docs.sparkSession):
        signed = signatures(docs)
        texts = different_texts(signed)
        labels = components(linked(docs, texts))
        named = texts.select("key", "t").join(labels, "t", "left").select("key", F.coalesce("label", "t").alias("label"))
        return saved(signed.select("doc_id", "digest", "key").join(named, "key").select("doc_id", "digest", "label"), "classes", keep=True)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), class_size, kept (it is that id) of each row of `docs`."""
    rows = classes(docs)
    heads = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(heads, "label").select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, with the columns of `docs`: one of the least id (null last), and there of the least digest."""
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("h")
    heads = classes(docs).groupBy("label").agg(head).select("h.doc_id", "h.digest")
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]).alias("_row"), F.col("doc_id"), F.col("text"))
    text = clean_text(F.col("text"))
    whole = whole.select("_row", F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))
    kept = same_row(whole, heads).dropDuplicates(["doc_id", "digest"])
    return kept.select(*[F.col(f"_row.c{k}").alias(c) for k, c in enumerate(names)])


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
