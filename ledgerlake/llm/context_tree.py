"""Language-model scores by context-tree weighting.

A byte is eight binary decisions, each a node of the tree of byte prefixes. For every such node there is a binary
context tree over the `DEPTH` bytes before, whose nodes count zeros and ones. A node's block probability is the
Krichevsky-Trofimov estimate, or, half to half, the product of its children's; that mixes the estimates of all
depths. Given the training counts, the probability of a next bit is, from the leaf up,
    q(node) = w * KT(node) + (1 - w) * q(child on the path),   w = P_KT / (P_KT + product of the children's P).

Steps: texts are cut into blocks of bounded size, kept as files. A block gives its different byte n-grams and words
with their counts in training texts, packed by bucket: the last two bytes of the context, or the first bits of the
word's hash. Equal buckets of up to `FAN_IN` blocks are added up, in rounds, until one is left of each. A gram bucket
is then a subtree of the model: it is weighed by itself, and the top (256 * 256 nodes) from the sums of the subtrees.
That gives a log probability for every n-gram that occurs anywhere. Each block is handed the values of its own
n-grams and words, and adds them up per text. For that a bucket is dealt into one part for every `FAN_IN` blocks,
the values as well as what the blocks ask for: the model is moved once, however many blocks there are. No task holds
the model or the vocabulary; a task holds a block, a bucket of `FAN_IN` blocks, or a part of a bucket of all blocks.

Texts are lower-cased (A-Z), start after `DEPTH` zero bytes, and end with a zero byte that is coded too.
The base is the unigram model of words and end marks with add-one smoothing. Words are told apart by 64 bits of
BLAKE2b.

Defined cases: null counts as empty (the end alone); without training texts every bit has probability 1/2 and the
base is log10(1 / 1) per token; rows repeated with one doc_id are each scored and each learnt from; an empty table
gives no rows; other columns are not looked at.
"""
from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import clean_text, cogrouped, id_remainder, new_path, saved, table

HELD_OUT = (7, 2)
#: Bytes of context; up to 7.
DEPTH = 5
#: Bytes of context above the subtrees.
TOP = 2
#: A block is closed once its texts have so many bytes.
BLOCK_BYTES = 32 << 20
#: Bytes whose n-grams are sorted at once.
AT_ONCE = 2 << 20
#: Blocks that meet in a task, by bucket.
FAN_IN = 64
GRAM, WORD = 0, 1
WORD_BITS = 11
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

FILES = "block long, path string, n_train long"
PACKED = "kind int, bucket int, keys binary, counts binary"
U = np.uint64


def grams(texts: list[bytes], depth: int = DEPTH) -> np.ndarray:
    """All n-grams of the texts, each with its end mark, in order: the last two context bytes, the others, the byte."""
    start = bytes(depth)
    joined = np.frombuffer(b"".join(x for t in texts for x in (start, t, b"\0")), np.uint8).astype(U)
    n = len(joined) - depth
    out = np.zeros(n, U)
    for k in (*range(depth - TOP, depth), *range(depth - TOP), depth):
        out <<= U(8)
        out |= joined[k:n + k]
    # what begins behind a text's last context reaches into the next text
    ends = np.cumsum([len(t) + 1 + depth for t in texts])[:-1]
    keep = np.ones(n, bool)
    keep[(ends[:, None] - 1 - np.arange(depth)[None, :]).ravel()] = False
    return out[keep]


def in_order(bucket: int, keys: np.ndarray, depth: int) -> np.ndarray:
    """The n-grams of a bucket with their bytes as in the text."""
    keys = keys.astype("i8")
    return (keys >> 8) << 8 * (TOP + 1) | bucket << 8 | keys & 0xFF


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and the sums of their counts."""
    u, place = np.unique(np.concatenate(keys), return_inverse=True)
    out = np.zeros(len(u), "i8")
    np.add.at(out, place, np.concatenate(counts))
    return u, out


def packed(kind: int, keys: np.ndarray, counts: np.ndarray, shift: int, wide: bool, *more: int) -> pa.RecordBatch:
    """A row per bucket (the bits from `shift` on) of sorted keys."""
    bucket = (keys >> U(shift)).astype("i8")
    cuts = np.concatenate(([0], np.nonzero(np.diff(bucket))[0] + 1, [len(keys)])) if len(keys) else np.zeros(1, "i8")
    low = (keys & U((1 << shift) - 1)).astype("<u8" if wide else "<u4")
    pairs = list(zip(cuts, cuts[1:]))
    columns = [pa.array(np.full(len(pairs), v)) for v in more]
    return pa.RecordBatch.from_arrays([
        *columns, pa.array(np.full(len(pairs), kind, "i4")), pa.array(bucket[cuts[:-1]].astype("i4")),
        pa.array([low[a:b].tobytes() for a, b in pairs], pa.binary()), pa.array([counts[a:b].astype("<i8").tobytes() for a, b in pairs], pa.binary()),
    ], names=[f"m{k}" for k in range(len(more))] + ["kind", "bucket", "keys", "counts"])


def unpack(kind: int, data: bytes, depth: int) -> np.ndarray:
    return np.frombuffer(data, "<u4" if kind == GRAM and depth <= 5 else "<u8")


class Block:
    """Texts of one block: their file, and their n-grams and words with training counts."""

    def __init__(self, number: int, out: str, depth: int):
        where, root = pafs.FileSystem.from_uri(out)
        name = f"block-{number}-{uuid.uuid4().hex}"
        self.number, self.path, self.depth = number, f"{out}/{name}", depth
        self.schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary())])
        self.file = where.open_output_stream(f"{root}/{name}")
        self.stream = pa.ipc.new_stream(self.file, self.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
        self.size, self.keys, self.counts, self.words, self.n_train = 0, [], [], Counter(), 0

    def add(self, ids: list, held: list[bool], texts: list[bytes]) -> None:
        for side in (False, True):
            own = [t for t, o in zip(texts, held) if o is side]
            if own:
                u, n = np.unique(grams(own, self.depth), return_counts=True)
                self.keys.append(u)
                self.counts.append(n * (not side))
            for t in own:
                if side:
                    for w in set(t.split()):
                        if w not in self.words:
                            self.words[w] = 0
                else:
                    self.words.update(t.split())
            self.n_train += len(own) * (not side)
        if sum(map(len, self.keys)) > 3_000_000:
            self.keys, self.counts = ([x] for x in added(self.keys, self.counts))
        self.stream.write_batch(pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(texts, pa.binary())], schema=self.schema))
        self.size += sum(map(len, texts))

    def write_keys(self, columns: dict[str, pa.Array]) -> None:
        where, name = pafs.FileSystem.from_uri(self.path)
        for column, values in columns.items():
            with where.open_output_stream(f"{name}.{column}") as f, pa.ipc.new_stream(f, pa.schema([(column, values.type)]), options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_batch(pa.RecordBatch.from_arrays([values], names=[column]))

    def close(self) -> Iterator[pa.RecordBatch]:
        self.stream.close()
        self.file.close()
        u, n = added(self.keys, self.counts)
        parts = [packed(GRAM, u, n, 8 * (self.depth + 1 - TOP), self.depth > 5)]
        held = list(self.words)
        hashes = np.frombuffer(b"".join(blake2b(w, digest_size=8).digest() for w in held), "<u8")
        order = np.argsort(hashes, kind="stable")
        w, n = added([hashes], [np.fromiter(self.words.values(), "i8", len(held))])
        parts.append(packed(WORD, w, n, 64 - WORD_BITS, True))
        # n-grams and words in the order that their values will come in
        self.write_keys({"gram": pa.array(u), "word": pa.array([held[k] for k in order], pa.binary()), "place": pa.array(np.searchsorted(w, hashes[order]))})
        yield block_rows([self.number], [self.path], [self.n_train])
        for p in parts:
            yield block_rows([self.number] * p.num_rows, None, None, p)


BLOCK_ROWS = "block long, path string, n_train long, kind int, bucket int, keys binary, counts binary"


def block_rows(numbers: list[int], paths, n_train, part: pa.RecordBatch | None = None) -> pa.RecordBatch:
    size = len(numbers)
    columns = [pa.array(numbers, pa.int64()), pa.array(paths or [None] * size, pa.string()), pa.array(n_train or [None] * size, pa.int64())]
    rest = part.columns if part is not None else [pa.nulls(size, k) for k in (pa.int32(), pa.int32(), pa.binary(), pa.binary())]
    return pa.RecordBatch.from_arrays([*columns, *rest], names=[f.split()[0] for f in BLOCK_ROWS.split(", ")])


def blocks(docs: DataFrame, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """The blocks' files (block, path, n_train) and packed counts (block, kind, bucket, keys, counts)."""
    spark = docs.sparkSession
    out, (n, held_out) = new_path(spark, "texts"), HELD_OUT
    where, root = pafs.FileSystem.from_uri(out)
    where.create_dir(root, recursive=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 24, None
        part: tuple[list, list, list] = ([], [], [])
        size = 0
        for batch in batches:
            for doc_id, is_out, text in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2)):
                text = text.as_py().encode().translate(LOWER)
                for held, value in zip(part, (doc_id, is_out, text)):
                    held.append(value)
                size += len(text)
                if size >= AT_ONCE:
                    block = block or Block(number, out, depth)
                    block.add(*part)
                    part, size = ([], [], []), 0
                    if block.size >= BLOCK_BYTES:
                        yield from block.close()
                        number, block = number + 1, None
        if part[0]:
            block = block or Block(number, out, depth)
            block.add(*part)
        if block:
            yield from block.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_remainder(F.col("doc_id"), n) == held_out).alias("held_out"), clean_text(F.col("text")).alias("text"))
    made = saved(rows.mapInArrow(cut, BLOCK_ROWS), "blocks")
    return made.where("path IS NOT NULL").select("block", "path", "n_train"), made.where("path IS NULL").drop("path", "n_train")


def merge(rows: DataFrame, n_blocks: int, depth: int) -> DataFrame:
    """One row per kind and bucket, with the counts of all blocks."""
    def add(key: tuple, part: pa.Table) -> pa.Table:
        kind, bucket = key[0].as_py(), key[1].as_py()
        u, n = added([unpack(kind, d, depth) for d in part["keys"].to_pylist()], [np.frombuffer(d, "<i8") for d in part["counts"].to_pylist()])
        out = {"kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int32()), "keys": pa.array([u.tobytes()], pa.binary()), "counts": pa.array([n.tobytes()], pa.binary())}
        if len(key) > 2:
            out["block"] = pa.array([key[2].as_py()], pa.int64())
        return pa.table(out)

    while n_blocks > FAN_IN:
        n_blocks = -(-n_blocks // FAN_IN)
        rows = rows.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(n_blocks))).groupBy("kind", "bucket", "block").applyInArrow(add, PACKED + ", block long")
    return rows.groupBy("kind", "bucket").applyInArrow(add, PACKED)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after stepping up by eight."""
    x = np.asarray(x, float)
    shift = np.log(np.prod([x + k for k in range(8)], axis=0))
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) + 1 / (1188 * z**9)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def kt_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1.0)


class Subtree:
    """All context trees below one context of `top` bytes, for the decisions of every bit level."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, depth: int, top: int):
        self.gram, byte = gram, gram & 0xFF
        context = gram >> 8
        self.levels = []  # per bit level: the bit, and per depth from top to leaf: place of each n-gram's node, counts, log P, log w
        for level in range(8):
            bit = byte >> (7 - level) & 1
            prefix = byte >> (8 - level) | 1 << level
            steps = []
            for d in range(depth, top - 1, -1):
                node = (context & (1 << 8 * d) - 1) << 8 | prefix
                u, place = np.unique(node, return_inverse=True)
                first = np.zeros(len(u), "i8")
                first[place] = np.arange(len(place))  # some n-gram of each node
                ones = np.bincount(place, n * bit, len(u))
                zeros = np.bincount(place, n * (1 - bit), len(u))
                own = log_kt(zeros, ones)
                log_p, log_w = own, np.zeros(len(u))
                if steps:  # a node's children lie where its n-grams' nodes of the next depth do
                    below = np.bincount(place[steps[-1][6]], steps[-1][3], len(u))
                    both = np.logaddexp(own, below)
                    log_p, log_w = both + np.log(0.5), own - both
                steps.append((place, zeros, ones, log_p, log_w, u, first))
            self.levels.append((bit, steps))

    def roots(self) -> pd.DataFrame:
        """prefix, zeros, ones, log_p of the decisions at the subtree's root."""
        out = []
        for _, steps in self.levels:
            _, zeros, ones, log_p, _, node, _ = steps[-1]
            out.append(pd.DataFrame({"prefix": (node & 0xFF).astype("i4"), "zeros": zeros, "ones": ones, "log_p": log_p}))
        return pd.concat(out)

    def log10(self, above) -> np.ndarray:
        """log10 probability of each n-gram's byte; `above` mixes what the subtree says with the top of the tree."""
        total = np.zeros(len(self.gram))
        for bit, steps in self.levels:
            q = None
            for place, zeros, ones, _, log_w, _, _ in steps:
                kt = kt_one(zeros, ones)[place]
                if q is None:
                    q = kt
                else:
                    w = np.exp(log_w)[place]
                    q = w * kt + (1 - w) * q
            q = above((steps[-1][5] & 0xFF)[steps[-1][0]], q)
            total += np.log10(np.where(bit == 1, q, 1 - q))
        return total


class Top:
    """The root and its children: at most 256 * 256 nodes, from sums over the subtrees."""

    def __init__(self, sums: pd.DataFrame):
        self.zeros, self.ones, log_p = (np.zeros((256, 256)) for _ in range(3))
        at = sums["last"].to_numpy("i8"), sums["prefix"].to_numpy("i8")
        self.zeros[at], self.ones[at], log_p[at] = (sums[c].to_numpy(float) for c in ("zeros", "ones", "log_p"))
        own = log_kt(self.zeros, self.ones)
        both = np.logaddexp(own, log_p)
        self.w, below = np.exp(own - both), (both + np.log(0.5)).sum(axis=0)  # 0 where nothing was seen
        self.root = self.zeros.sum(axis=0), self.ones.sum(axis=0)
        own = log_kt(*self.root)
        self.root_w = np.exp(own - np.logaddexp(own, below))

    def above(self, last: int):
        def mix(prefix: np.ndarray, q: np.ndarray) -> np.ndarray:
            w = self.w[last, prefix]
            q = w * kt_one(self.zeros[last, prefix], self.ones[last, prefix]) + (1 - w) * q
            w = self.root_w[prefix]
            return w * kt_one(self.root[0][prefix], self.root[1][prefix]) + (1 - w) * q
        return mix


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in zip(*batch.columns):
            yield tuple(v.as_py() for v in row)


def values(merged: DataFrame, n_blocks: int, depth: int = DEPTH) -> DataFrame:
    """kind, bucket, keys, found: for each key the log10 probability of its byte (32 bit), or the word's count (64 bit)."""
    merged = merged.repartition(max(8, n_blocks))  # few bytes, much work

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, keys, counts in _each(batches):
            tree = Subtree(in_order(bucket, unpack(GRAM, keys, depth), depth), np.frombuffer(counts, "<i8"), depth, TOP)
            yield pa.RecordBatch.from_pandas(tree.roots().assign(last=bucket & 0xFF)[["prefix", "zeros", "ones", "log_p", "last"]], preserve_index=False)

    parts = merged.where(F.col("kind") == GRAM).select("bucket", "keys", "counts").mapInArrow(roots, "prefix int, zeros double, ones double, log_p double, last long")
    top = Top(parts.groupBy("last", "prefix").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "log_p")]).toPandas())  # 65,536 rows at most

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, bucket, keys, counts in _each(batches):
            found = counts
            if kind == GRAM:
                tree = Subtree(in_order(bucket, unpack(GRAM, keys, depth), depth), np.frombuffer(counts, "<i8"), depth, TOP)
                found = tree.log10(top.above(bucket & 0xFF)).astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), pa.array([keys], pa.binary()), pa.array([found], pa.binary())], names=["kind", "bucket", "keys", "found"])

    return merged.mapInArrow(weigh, "kind int, bucket int, keys binary, found binary")


def part_of(kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    """Which part of its bucket a key goes to. Words, which are hashes, go by range, so that parts follow their order."""
    if kind == WORD:
        return (keys >> U(64 - WORD_BITS - 32)) * U(parts) >> U(32)
    return (keys.astype("u8") * U(0x9E3779B97F4A7C15) >> U(33)) % U(parts)


IN_PARTS = "block long, kind int, bucket int, part int, keys binary, found binary"


def in_parts(rows: DataFrame, parts: int, depth: int) -> DataFrame:
    """Rows of block, kind, bucket, keys, found with the keys of each part in a row of their own; without block the model's."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, kind, bucket, data, found in _each(batches):
            keys = unpack(kind, data, depth)
            value = None if found is None else np.frombuffer(found, "<f4" if kind == GRAM else "<i8")
            part = part_of(kind, keys, parts)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            held = [(p, order[a:b]) for p, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * len(held), pa.int64()), pa.array([kind] * len(held), pa.int32()), pa.array([bucket] * len(held), pa.int32()),
                pa.array([p for p, _ in held], pa.int32()), pa.array([keys[at].tobytes() for _, at in held], pa.binary()),
                pa.array([None if value is None else value[at].tobytes() for _, at in held], pa.binary()),
            ], names=[f.split()[0] for f in IN_PARTS.split(", ")])

    if parts == 1:
        return rows.select("block", "kind", "bucket", F.lit(0).alias("part"), "keys", "found")
    return rows.select("block", "kind", "bucket", "keys", "found").mapInArrow(deal, IN_PARTS)


def hand_out(rows: DataFrame, found: DataFrame, parts: int, depth: int) -> DataFrame:
    """block, kind, place, found: the values of each block's own keys, in the order of bucket, part and key."""
    asked = in_parts(rows.withColumn("found", F.lit(None).cast("binary")), parts, depth).drop("found")
    offered = in_parts(found.withColumn("block", F.lit(None).cast("long")), parts, depth).drop("block")

    def look(key: tuple, own: pa.Table, model: pa.Table) -> pa.Table:
        kind, bucket, part = (k.as_py() for k in key)
        out = []
        if own.num_rows:
            keys = unpack(kind, model["keys"][0].as_py(), depth)
            value = np.frombuffer(model["found"][0].as_py(), "<f4" if kind == GRAM else "<i8")
            out = [value[np.searchsorted(keys, unpack(kind, d, depth))].tobytes() for d in own["keys"].to_pylist()]
        n = len(out)
        return pa.table({"block": own["block"].cast(pa.int64()), "kind": pa.array([kind] * n, pa.int32()), "place": pa.array([bucket * parts + part] * n, pa.int64()), "found": pa.array(out, pa.binary())})

    return cogrouped(asked, offered, ["kind", "bucket", "part"], look, "block long, kind int, place long, found binary")


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long"


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes of each row of `docs`."""
    files, rows = blocks(docs, depth)
    n_blocks, ends = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_train"), F.lit(0))).first()
    merged = saved(merge(rows, n_blocks, depth), "counts")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.frombuffer(data, "<i8") for data, in _each(batches)]
        yield pa.RecordBatch.from_arrays([pa.array([int(sum(c.sum() for c in counts))]), pa.array([int(sum((c > 0).sum() for c in counts))])], names=["n", "v"])

    tokens, different = merged.where(F.col("kind") == WORD).select("counts").mapInArrow(totals, "n long, v long").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "v")]).first()
    tokens, different = tokens + ends, different + (ends > 0)
    rest = tokens + different + 1
    parts, shift = -(-max(1, n_blocks) // FAN_IN), 8 * (depth + 1 - TOP)
    handed = hand_out(rows, values(merged, n_blocks, depth), parts, depth)
    columns = [f.split()[0] for f in RESULT.split(", ")]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]

    def sums(key: tuple, file: pa.Table, found: pa.Table) -> pa.Table:
        where, name = pafs.FileSystem.from_uri(file["path"][0].as_py())

        def read(column: str) -> pa.ChunkedArray:
            with where.open_input_file(f"{name}.{column}") as f:
                return pa.ipc.open_stream(f).read_all()[column]

        with where.open_input_file(name) as f:
            held = pa.ipc.open_stream(f).read_all().combine_chunks()
        texts = held["text"].to_pylist()
        found = found.sort_by([("kind", "ascending"), ("place", "ascending")])
        kind = found["kind"].to_numpy()
        data = found["found"].to_pylist()
        value = np.frombuffer(b"".join(d for k, d in zip(kind, data) if k == GRAM), "<f4")
        counts = np.frombuffer(b"".join(d for k, d in zip(kind, data) if k == WORD), "<i8")
        unique = read("gram").to_numpy()
        if parts > 1:
            by_key = value.copy()
            by_key[np.lexsort((part_of(GRAM, unique & U((1 << shift) - 1), parts), unique >> U(shift)))] = value
            value = by_key
        pieces, size, start = [], 0, 0
        for k, t in enumerate(texts, 1):
            size += len(t)
            if size >= AT_ONCE or k == len(texts):
                pieces.append((start, k))
                start, size = k, 0
        scores = []
        for a, b in pieces:
            own = grams(texts[a:b], depth)
            order = np.argsort(own)
            logs = np.empty(len(own))
            logs[order] = value[np.searchsorted(unique, own[order])]
            ends_at = np.cumsum([len(t) + 1 for t in texts[a:b]])
            scores.append(np.add.reduceat(logs, np.concatenate(([0], ends_at[:-1]))))
        scores = np.concatenate(scores)
        known = dict(zip(read("word").to_pylist(), counts[read("place").to_numpy()].astype(float)))
        out = []
        for doc_id, is_out, text, s in zip(held["doc_id"].to_pylist(), held["held_out"].to_pylist(), texts, scores):
            own = text.split()
            c = np.fromiter(map(known.__getitem__, own), float, len(own))
            c = np.append(c, ends)
            out.append((doc_id, is_out, len(c), int((c > 0).sum()), tokens, float(np.log10((c + 1) / rest).sum()), float(s), len(text)))
        return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=columns)

    # What is shuffled is small beside the texts that a task then reads, so a task gets about one block.
    n = max(1, n_blocks)
    files = files.select(F.col("block").alias("of_block"), "path").repartition(n, "of_block")
    return files.groupBy("of_block").cogroup(handed.repartition(n, "block").groupBy("block")).applyInArrow(sums, RESULT)


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
