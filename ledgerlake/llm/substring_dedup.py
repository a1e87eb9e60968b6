"""Remove every byte that a repeated string of `WINDOW` bytes covers, by suffix arrays of the places that can repeat.

1. Seeds: of the SEED-byte strings inside a window the one with the least hash (the last of equals) is its seed. Equal
   windows have equal seeds at equal places, so only windows whose seed occurs twice can repeat. Neighbouring windows
   share seeds; a seed with the windows it stands for is a context.
2. Seeds are counted by hash (each block of texts sends its different ones once). Contexts of repeated seeds are
   counted by 128 bits: equal contexts repeat as a whole, and one of them goes on for all; contexts that no other
   shares a seed with are done. Blocks say first how many different contexts they hold of each seed; a seed with
   more than `HOT` (a line that a large share of texts hold) is hot, and its contexts are dealt by their own hash
   instead of the seed's, so that no task ever holds more than `HOT` contexts of one seed.
3. What is left differs from all others of its seed somewhere. The contexts of a seed, each with the seed itself as
   one symbol, are put into one string, and their suffix array is built by linear grouping (suffix_groups): suffixes
   that agree in WINDOW - SEED + 1 symbols, seed included, are equal windows, and stand next to each other. Seeds with
   many contexts are cut into strings of `TILE` contexts, and one window of each class of a string is compared with
   those of the seed's other strings. Contexts of hot seeds are not gathered: their windows are counted by 128 bits,
   as contexts were.
4. Each block adds up its repeated windows and cuts.

Texts are kept in files, one per block of bounded size; only hashes, contexts and marks are shuffled, packed by bucket
of the hash. Buckets grow in number with the input.

Defined cases: null counts as empty; texts of fewer than WINDOW bytes are kept; a window may repeat within its own
text and may overlap its twin; rows repeated (with one id or several) are each other's repeats; bytes are cut even
inside a character, so what is kept is binary; an empty table gives no rows; other columns are not looked at.
"""
from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import clean_text, new_path, saved, table
from .suffix_groups import suffix_arrays

WINDOW = 200
SEED = 144
#: Window starts that have a given place in common, and symbols of a window whose seed is one symbol.
REACH = WINDOW - SEED + 1
BLOCK_BYTES = 16 << 20
#: Bytes of texts that are hashed at once; longer texts are taken in overlapping pieces.
PIECE = 1 << 20
PER_BUCKET = 50_000
TILE, HOT = 96, 20_000
SYMBOLS_AT_ONCE = 600_000
PLACE_BITS = 28

U = np.uint64
TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])
BLOCK_ROWS = "block long, path string, bucket int, keys binary, more binary, twice binary"
MARKS = "block long, kind int, bucket long, marks binary"


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(29))


def rolling(data: bytes) -> np.ndarray:
    """A 64-bit hash of every SEED-byte string: a polynomial over its 8-byte words, scrambled."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).astype("u8")
    part, size, factor, out, done = _scramble(words), 8, 0x9E3779B97F4A7C15, None, 0
    left = SEED // 8
    while True:
        if left & 1:
            if out is None:
                out, done = part, size
            else:
                n = len(data) - done - size + 1
                out, done = out[:n] * U(factor) + part[done:done + n], done + size
        left >>= 1
        if not left:
            return _scramble(out)
        n = len(part) - size
        part = part[:n] * U(factor) + part[size:]
        size, factor = 2 * size, factor * factor & 0xFFFFFFFFFFFFFFFF


def _least(key: np.ndarray) -> np.ndarray:
    """Least of every REACH neighbours."""
    part, size = key, 1
    while 2 * size <= REACH:
        part, size = np.minimum(part[:-size], part[size:]), 2 * size
    n = len(key) - REACH + 1
    return np.minimum(part[:n], part[REACH - size:REACH - size + n])


def seeds(texts: list[bytes]) -> dict[str, np.ndarray]:
    """hash, text, at (place of the seed), low and high (first and last window) of every context."""
    pieces = [(k, a) for k, t in enumerate(texts) for a in range(0, len(t) - WINDOW + 1, PIECE)]
    out: dict[str, list[np.ndarray]] = {c: [] for c in ("hash", "text", "at", "low", "high")}
    turn = 0
    while turn < len(pieces):
        held, size = [], 0
        while turn < len(pieces) and (not held or size < PIECE):
            k, a = pieces[turn]
            held.append((k, a, texts[k][a:a + PIECE + WINDOW - 1]))
            size += len(held[-1][2])
            turn += 1
        data = b"".join(x for _, _, x in held)
        starts = np.concatenate(([0], np.cumsum([len(x) for _, _, x in held])))
        h = rolling(data)
        mask = U((1 << PLACE_BITS) - 1)
        least = _least(h & ~mask | (mask - np.arange(len(h), dtype="u8")))
        windows = np.concatenate([np.arange(s, e - WINDOW + 1) for s, e in zip(starts, starts[1:])])
        at = (mask - (least[windows] & mask)).astype("i8")
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
        first = np.nonzero(new)[0]
        last = np.append(first[1:], len(at)) - 1
        piece = np.searchsorted(starts, windows[first], side="right") - 1
        shift = np.array([a for _, a, _ in held])[piece] - starts[piece]
        out["hash"].append(h[at[first]])
        out["text"].append(np.array([k for k, _, _ in held])[piece])
        for name, value in (("at", at[first]), ("low", windows[first]), ("high", windows[last])):
            out[name].append(value + shift)
    kinds = {"hash": "u8"}
    return {c: np.concatenate(v) if v else np.zeros(0, kinds.get(c, "i8")) for c, v in out.items()}


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def _classes(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by `keys`, the rows in it that begin a class of equal ones, and the class of each row."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    for n, key in enumerate(keys):
        differs = key[order][1:] != key[order][:-1]
        new[1:] = differs if not n else new[1:] | differs
    klass = np.empty(len(order), "i8")
    klass[order] = np.cumsum(new) - 1
    return order, new, klass


class Files:
    """Files of a job in the shared folder, under names of their own attempt."""

    def __init__(self, out: str):
        self.out = out
        self.where, self.root = pafs.FileSystem.from_uri(out)

    def put(self, arrays: dict[str, np.ndarray]) -> str:
        name, held = uuid.uuid4().hex, io.BytesIO()
        np.savez_compressed(held, **arrays)
        with self.where.open_output_stream(f"{self.root}/{name}") as f:
            f.write(held.getvalue())
        return f"{self.out}/{name}"

    @staticmethod
    def get(path: str) -> dict[str, np.ndarray]:
        where, name = pafs.FileSystem.from_uri(path)
        with where.open_input_stream(name) as f:
            with np.load(io.BytesIO(f.read())) as held:
                return dict(held)


def read_texts(path: str) -> tuple[list, list[bytes]]:
    where, name = pafs.FileSystem.from_uri(path)
    with where.open_input_stream(name) as f:
        held = pa.ipc.open_stream(f).read_all()
    return held["doc_id"].to_pylist(), held["text"].to_pylist()


def by_bucket(keys: np.ndarray, bits: int) -> list[tuple[int, slice]]:
    """Buckets (the first bits) of sorted keys and where they lie."""
    bucket = (keys >> U(64 - bits)).astype("i8")
    cuts = np.concatenate(([0], np.nonzero(np.diff(bucket))[0] + 1, [len(keys)])) if len(keys) else [0]
    return [(int(bucket[a]), slice(int(a), int(b))) for a, b in zip(cuts, cuts[1:])]


def block_rows(block: int, path: str, keys: np.ndarray, twice: np.ndarray, bits: int, more: np.ndarray | None = None) -> pa.RecordBatch:
    """A row for the block itself and one for each bucket of its sorted keys."""
    parts = by_bucket(keys, bits)
    blob = lambda x, kind: pa.array([None] + [x[s].astype(kind).tobytes() for _, s in parts], pa.binary())
    return pa.RecordBatch.from_arrays([
        pa.array([block] * (len(parts) + 1), pa.int64()), pa.array([path] + [None] * len(parts), pa.string()), pa.array([None] + [b for b, _ in parts], pa.int32()),
        blob(keys, "<u8"), blob(keys if more is None else more, "<u8"), blob(twice, "u1"),
    ], names=[f.split()[0] for f in BLOCK_ROWS.split(", ")])


def cut(docs: DataFrame, out: str, bits: int) -> DataFrame:
    """Blocks of texts, as files, and the different seeds of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, number, size, ids, texts = Files(out), TaskContext.get().partitionId() << 24, 0, [], []

        def close() -> pa.RecordBatch:
            name = uuid.uuid4().hex
            with files.where.open_output_stream(f"{files.root}/{name}") as f, pa.ipc.new_stream(f, TEXTS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                for k in range(0, len(ids), 1000):
                    stream.write_batch(pa.RecordBatch.from_arrays([pa.array(ids[k:k + 1000], pa.int64()), pa.array(texts[k:k + 1000], pa.binary())], schema=TEXTS))
            u, n = np.unique(seeds(texts)["hash"], return_counts=True)
            return block_rows(number, f"{out}/{name}", u, n > 1, bits)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py().encode())
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    yield close()
                    number, size, ids, texts = number + 1, 0, [], []
        if ids:
            yield close()

    return saved(docs.mapInArrow(run, BLOCK_ROWS), "seeds")


def _blobs(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _marks(part: pa.Table, kind: int, bucket: int, marks: list[np.ndarray]) -> pa.Table:
    n = part.num_rows
    return pa.table({"block": part["block"], "kind": pa.array([kind] * n, pa.int32()), "bucket": pa.array([bucket] * n, pa.int64()), "marks": pa.array([m.astype("u1").tobytes() for m in marks], pa.binary())})


def repeated(rows: DataFrame, kind: int, halves: tuple[str, ...] = ("keys",)) -> DataFrame:
    """Per block and bucket, which of its keys (in one or two halves) occur in another block too, or twice in the block."""
    def count(key: tuple, part: pa.Table) -> pa.Table:
        keys, twice = [_blobs(part[c], "<u8") for c in halves], _blobs(part["twice"], "u1")
        sizes = np.cumsum([len(k) for k in keys[0]])[:-1]
        place = _classes(*map(np.concatenate, keys))[2]
        n = np.bincount(place) + (np.bincount(place, np.concatenate(twice)) > 0)
        return _marks(part, kind, key[0].as_py(), np.split(n[place] > 1, sizes))

    return rows.where("bucket IS NOT NULL").select("block", "bucket", *halves, "twice").groupBy("bucket").applyInArrow(count, MARKS)


def _each_block(left: DataFrame, right: DataFrame, run, schema: str) -> DataFrame:
    """Give each block its file and its marks, in bucket order by kind."""
    def meet(key: tuple, own: pa.Table, marks: pa.Table) -> pa.Table:
        marks = marks.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        kinds = marks["kind"].to_numpy()
        blobs = marks["marks"].to_pylist()
        found = {k: np.frombuffer(b"".join(b for x, b in zip(kinds, blobs) if x == k), "u1") for k in range(5)}
        return pa.Table.from_batches([run(own.to_pylist()[0], found)])

    # What is shuffled is small beside the texts that a task then reads, so a task gets about one block.
    n = max(1, left.count())
    left = left.withColumnRenamed("block", "of_block").repartition(n, "of_block")
    return left.groupBy("of_block").cogroup(right.repartition(n, "block").groupBy("block")).applyInArrow(meet, schema)


def contexts(files: DataFrame, marks: DataFrame, out: str, bits: int) -> DataFrame:
    """The different contexts of each block's repeated seeds: hash of the seed (keys) and of the context (more)."""
    def run(own: dict, found: dict) -> pa.RecordBatch:
        _, texts = read_texts(own["path"])
        s = seeds(texts)
        _, place = np.unique(s["hash"], return_inverse=True)
        held = {c: v[found[0][place] > 0] if len(place) else v for c, v in s.items()}
        own_hash = np.array([_hash(texts[t][a:b + WINDOW] + bytes([p - a])) for t, p, a, b in zip(*(held[c].tolist() for c in ("text", "at", "low", "high")))], "u8")
        order, new, which = _classes(held["hash"], own_hash)
        h, c = held["hash"][order], own_hash[order]
        first = np.nonzero(new)[0]
        n = np.diff(np.append(first, len(h)))
        state = {k: held[k].astype("u4") for k in ("text", "at", "low", "high")} | {"which": which.astype("u4"), "one": order[first].astype("u4"), "hash": h[first], "dealt": (c[first] >> U(64 - bits)).astype("u4"), "texts": np.array([own["path"]])}
        return block_rows(own["of_block"], Files(out).put(state), h[first], n > 1, bits, c[first])

    return saved(_each_block(files, marks, run, BLOCK_ROWS), "contexts")


ALONE, WHOLE, OPEN, SOURCE, HOT_OPEN, HOT_SOURCE, HOT_ASKED = range(7)


def hot_seeds(rows: DataFrame) -> DataFrame:
    """bucket, hot: the sorted hot seeds of the buckets that have any, from the number of contexts in each block."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [np.unique(np.frombuffer(k, "<u8"), return_counts=True) for k in batch.column(1).to_pylist()]
            blobs = [pa.array([x[j].astype(kind).tobytes() for x in counted], pa.binary()) for j, kind in enumerate(("<u8", "<u4"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *blobs], names=["bucket", "keys", "counts"])

    def total(key: tuple, part: pa.Table) -> pa.Table:
        keys, place = np.unique(np.concatenate(_blobs(part["keys"], "<u8")), return_inverse=True)
        hot = keys[np.bincount(place, np.concatenate(_blobs(part["counts"], "<u4"))) > HOT]
        return pa.table({"bucket": pa.array([key[0].as_py()][:len(hot)], pa.int32()), "hot": pa.array([hot.astype("<u8").tobytes()][:len(hot)], pa.binary())})

    counted = rows.mapInArrow(own, "bucket int, keys binary, counts binary")
    return saved(counted.groupBy("bucket").applyInArrow(total, "bucket int, hot binary"), "hot-seeds")


DEALT = "what string, dealt int, block long, bucket int, keys binary, more binary, twice binary, asked binary"


def deal(rows: DataFrame, bits: int) -> DataFrame:
    """Contexts by bucket of the seed, those of hot seeds by bucket of their own hash; `asked` tells the hot ones of a row."""
    names = [f.split()[0] for f in DEALT.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block, bucket, keys, more, twice, hot in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "keys", "more", "twice", "hot"))):
                h, c, t = np.frombuffer(keys, "<u8"), np.frombuffer(more, "<u8"), np.frombuffer(twice, "u1")
                asked = np.isin(h, np.frombuffer(hot or b"", "<u8"))
                out.append(("seed", bucket, block, bucket, h[~asked].tobytes(), c[~asked].tobytes(), t[~asked].tobytes(), asked.tobytes()))
                at = np.nonzero(asked)[0]
                at = at[np.argsort(c[at] >> U(64 - bits), kind="stable")]
                for part, where in by_bucket(c[at], bits):
                    out.append(("context", part, block, bucket, *(x[at[where]].tobytes() for x in (h, c, t)), None))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)

    return rows.mapInArrow(run, DEALT)


def verdicts(rows: DataFrame, bits: int) -> DataFrame:
    """Per block and bucket, what is known of each context from the hashes alone.

    Marks of kind 1 are in the order of the seeds; contexts of hot seeds are HOT_ASKED there, and have marks of kind 4
    in the order of their own bucket, then of the seeds.
    """
    def judge(key: tuple, part: pa.Table) -> pa.Table:
        hot = key[0].as_py() == "context"
        keys, more, twice = _blobs(part["keys"], "<u8"), _blobs(part["more"], "<u8"), _blobs(part["twice"], "u1")
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        h, c, twice = np.concatenate(keys), np.concatenate(more), np.concatenate(twice)
        row = np.repeat(part["block"].to_numpy(), [len(k) for k in keys])
        by_row = np.argsort(row, kind="stable")  # the first block with a context stands for it
        order, new, klass = _classes(h[by_row], c[by_row])
        order, back = by_row[order], np.empty(len(h), "i8")
        back[by_row] = klass
        n = np.bincount(back, minlength=1) + (np.bincount(back, twice, minlength=1) > 0)
        first = np.zeros(len(h), bool)
        first[order[new]] = True
        again = n[back] > 1
        if hot:
            code = np.where(again, np.where(first, HOT_SOURCE, WHOLE), HOT_OPEN)
        else:
            _, seed, others = np.unique(h[order][new], return_inverse=True, return_counts=True)
            several = others[seed][back] > 1 if len(h) else again
            code = np.where(again, np.where(several & first, SOURCE, WHOLE), np.where(several, OPEN, ALONE))
        own = np.split(code, cuts)
        if hot:
            place = [(key[1].as_py() << 30) + b for b in part["bucket"].to_pylist()]
        else:
            place, asked = part["bucket"].to_pylist(), _blobs(part["asked"], "?")
            for k, (a, codes) in enumerate(zip(asked, own)):
                own[k] = np.full(len(a), HOT_ASKED)
                own[k][~a] = codes
        marks = _marks(part, 4 if hot else 1, 0, own)
        return marks.set_column(2, "bucket", pa.array(place, pa.int64()))

    rows = rows.where("bucket IS NOT NULL").select("block", "bucket", "keys", "more", "twice")
    # Hot seeds are at most one in HOT contexts; Spark broadcasts them where they are few.
    rows = rows.join(hot_seeds(rows.select("bucket", "keys")), "bucket", "left")
    return deal(rows, bits).groupBy("what", "dealt").applyInArrow(judge, MARKS)


def codes_of(state: dict, found: dict) -> np.ndarray:
    """The verdict on each context of a block, in the order of its seeds."""
    code = found[1].copy()
    asked = np.nonzero(code == HOT_ASKED)[0]
    code[asked[np.argsort(state["dealt"][asked], kind="stable")]] = found[4]
    return code


OPEN_ROWS = "block long, what string, bucket int, keys binary, more binary, twice binary, before binary, windows binary, bytes binary"


def _context(state: dict, s: int, texts: list[bytes]) -> tuple[bytes, int, int, int]:
    """Text, place of the seed, first and last window."""
    t, p, a, b = (int(state[c][s]) for c in ("text", "at", "low", "high"))
    return texts[t], p, a, b


def bring(files: DataFrame, marks: DataFrame, bits: int) -> DataFrame:
    """Contexts that have to be compared, by bucket of the seed; and the hashed windows of those of hot seeds."""
    names = [f.split()[0] for f in OPEN_ROWS.split(", ")]

    def run(own: dict, found: dict) -> pa.RecordBatch:
        state = Files.get(own["path"])
        _, texts = read_texts(str(state["texts"][0]))
        code, out = codes_of(state, found), []
        for bucket, part in by_bucket(state["hash"], bits):
            ids = np.nonzero((code[part] == OPEN) | (code[part] == SOURCE))[0] + part.start
            before, windows, pieces = [], [], []
            for k in ids:
                text, p, a, b = _context(state, state["one"][k], texts)
                before.append(p - a)
                windows.append(b - a + 1)
                pieces.append(text[a:p] + text[p + SEED:b + WINDOW])
            if len(ids):
                out.append((own["of_block"], "contexts", bucket, state["hash"][ids].tobytes(), None, None, np.array(before, "u1").tobytes(), np.array(windows, "u1").tobytes(), b"".join(pieces)))
        keys, more = hot_windows(state, code, texts)[0]
        order, new, _ = _classes(keys, more)
        first = np.nonzero(new)[0]
        u, v, n = keys[order][first], more[order][first], np.diff(np.append(first, len(order)))
        for bucket, part in by_bucket(u, bits):
            out.append((own["of_block"], "hot", bucket, u[part].tobytes(), v[part].tobytes(), (n[part] > 1).astype("u1").tobytes(), None, None, None))
        kinds = [pa.int64(), pa.string(), pa.int32()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)

    return saved(_each_block(files, marks, run, OPEN_ROWS), "open-contexts")


def hot_windows(state: dict, code: np.ndarray, texts: list[bytes]) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    """Both halves of the hash, context and number in the context of every window of the hot contexts."""
    h, of, number = [], [], []
    for k in np.nonzero((code == HOT_OPEN) | (code == HOT_SOURCE))[0]:
        text, _, a, b = _context(state, state["one"][k], texts)
        own = [hashlib.blake2b(text[x:x + WINDOW], digest_size=16).digest() for x in range(a, b + 1)]
        # one that stands for all its equals counts twice
        for _ in range(2 if code[k] == HOT_SOURCE else 1):
            h += own
            of += [k] * len(own)
            number += range(len(own))
    both = np.frombuffer(b"".join(h), "<u8").reshape(-1, 2)
    return (both[:, 0], both[:, 1]), np.array(of, "i8"), np.array(number, "i8")


def equal_windows(seed: np.ndarray, before: np.ndarray, windows: np.ndarray, data: np.ndarray) -> np.ndarray:
    """For every window of every context, whether another context of the same seed (there, sorted) holds it too.

    `data`: the bytes before and after the seed, context by context: windows + REACH - 2 of them each.
    """
    size = windows + REACH - 2
    starts = np.cumsum(size) - size
    marks = np.zeros(int(windows.sum()), bool)
    first_mark = np.cumsum(windows) - windows
    # One string per tile of a seed's contexts: bytes before, the seed as one symbol, bytes after, a last symbol of its own.
    new = np.ones(len(seed), bool)
    new[1:] = seed[1:] != seed[:-1]
    run_start = np.maximum.accumulate(np.where(new, np.arange(len(seed)), 0))
    tile = (np.arange(len(seed)) - run_start) // TILE
    new_tile = new.copy()
    new_tile[1:] |= tile[1:] != tile[:-1]
    tiles = np.nonzero(new_tile)[0]
    tile_ends = np.append(tiles[1:], len(seed))
    tile_sizes = np.add.reduceat(size + 2, tiles) if len(tiles) else np.zeros(0, "i8")
    leads: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    order = np.argsort(-tile_sizes, kind="stable")  # strings of like size take their steps together
    k = 0
    while k < len(order):
        batch, total = [], 0
        while k < len(order) and (not batch or total + tile_sizes[order[k]] <= SYMBOLS_AT_ONCE):
            batch.append(order[k])
            total += tile_sizes[order[k]]
            k += 1
        which = np.concatenate([np.arange(tiles[t], tile_ends[t]) for t in batch])
        own = size[which] + 2
        offset = np.cumsum(own) - own
        symbols = np.empty(int(own.sum()), "i8")
        inner = np.arange(len(symbols)) - np.repeat(offset, own)
        of = np.repeat(np.arange(len(which)), own)
        at_seed, at_end = inner == before[which][of], inner == own[of] - 1
        plain = ~(at_seed | at_end)
        symbols[plain] = data[np.concatenate([np.arange(s, s + n) for s, n in zip(starts[which], size[which])])] + TILE
        symbols[at_seed] = TILE + 256
        symbols[at_end] = which - tiles[np.searchsorted(tiles, which, side="right") - 1]
        array = suffix_arrays(symbols, tile_sizes[batch])
        window = array[inner[array] < windows[which][of[array]]]  # windows only, in the order of their suffixes
        same = np.zeros(len(window), bool)
        if len(window) > 1:
            string = np.searchsorted(np.cumsum(tile_sizes[batch]), window, side="right")
            at = np.nonzero(string[1:] == string[:-1])[0]
            for step in range(REACH):
                at = at[symbols[window[at] + step] == symbols[window[at + 1] + step]]
            same[at + 1] = True
        klass = np.cumsum(~same) - 1
        several = np.bincount(klass, minlength=1) > 1
        place = first_mark[which][of[window]] + inner[window]
        marks[place] = several[klass]
        # Seeds with several tiles: one window of each class is compared with those of the other tiles.
        cut_up = np.isin(seed[which][of[window]], seed[tile > 0]) if (tile > 0).any() else np.zeros(len(window), bool)
        if cut_up.any():
            lead = window[cut_up & ~same]
            rows = symbols[lead[:, None] + np.arange(REACH)].astype("<i2")
            leads.append((seed[which][of[lead]], rows, place[cut_up], np.bincount(klass[cut_up])[klass[cut_up & ~same]]))
    if leads:
        s, rows, place, members = (np.concatenate([x[j] for x in leads]) for j in range(4))
        whole = np.hstack([s.view("u1").reshape(len(s), 8), rows.view("u1").reshape(len(s), -1)])
        _, klass, n = np.unique(_digests(whole), return_inverse=True, return_counts=True)
        marks[place] |= np.repeat(n[klass] > 1, members)
    return marks


def _digests(rows: np.ndarray) -> np.ndarray:
    """128 bits of every row."""
    data, size = rows.tobytes(), rows.shape[1]
    found = b"".join(hashlib.blake2b(data[k:k + size], digest_size=16).digest() for k in range(0, len(data), size))
    return np.frombuffer(found, [("a", "<u8"), ("b", "<u8")])


def compare(rows: DataFrame, bits: int) -> DataFrame:
    """Per block and bucket, which windows of its open contexts repeat."""
    def run(key: tuple, part: pa.Table) -> pa.Table:
        seed, before, windows = ([np.frombuffer(x, kind) for x in part[c].to_pylist()] for c, kind in (("keys", "<u8"), ("before", "u1"), ("windows", "u1")))
        data = [np.frombuffer(x, "u1") for x in part["bytes"].to_pylist()]
        per_row = [int(w.astype("i8").sum()) for w in windows]
        s, b, w = np.concatenate(seed), np.concatenate(before).astype("i8"), np.concatenate(windows).astype("i8")
        d = np.concatenate(data).astype("i8")
        order = np.argsort(s, kind="stable")
        size = w + REACH - 2
        at = np.cumsum(size) - size
        d = d[np.concatenate([np.arange(x, x + n) for x, n in zip(at[order], size[order])])]
        found = equal_windows(s[order], b[order], w[order], d)
        marks = np.empty(len(found), bool)
        first = np.cumsum(w) - w
        marks[np.concatenate([np.arange(x, x + n) for x, n in zip(first[order], w[order])])] = found
        return _marks(part, 2, key[0].as_py(), np.split(marks, np.cumsum(per_row)[:-1]))

    return rows.where("what = 'contexts'").select("block", "bucket", "keys", "before", "windows", "bytes").repartition(max(8, 1 << bits >> 3), "bucket").groupBy("bucket").applyInArrow(run, MARKS)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin: long, end: long>>, kept binary"


def finish(files: DataFrame, marks: DataFrame, with_text: bool) -> DataFrame:
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64()] * 4 + [pa.string(), span, pa.binary()]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]

    def run(own: dict, found: dict) -> pa.RecordBatch:
        state = Files.get(own["path"])
        ids, texts = read_texts(str(state["texts"][0]))
        code, which = codes_of(state, found), state["which"].astype("i8")
        starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        low, high = (starts[state["text"]] + state[c] for c in ("low", "high"))
        edge = np.zeros(int(starts[-1]) + 1, "i4")
        own_code = code[which] if len(which) else which
        whole = np.isin(own_code, (WHOLE, SOURCE, HOT_SOURCE))
        np.add.at(edge, low[whole], 1)
        np.add.at(edge, high[whole] + WINDOW, -1)
        # open contexts occur once in all texts, so each has its one place
        brought = np.nonzero((code == OPEN) | (code == SOURCE))[0]
        seed_of = state["one"][brought].astype("i8")
        n = high[seed_of] - low[seed_of] + 1
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[seed_of], n)
        at = at[found[2] > 0] if len(at) else at
        hot, of, number = hot_windows(state, code, texts)
        if len(of):
            again = found[3][_classes(*hot)[2]] > 0
            at = np.concatenate((at, low[state["one"][of[again]]] + number[again]))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
        gone = np.cumsum(edge[:-1]) > 0
        rows = []
        for k, (doc_id, text) in enumerate(zip(ids, texts)):
            mask = gone[starts[k]:starts[k + 1]]
            if not mask.any():
                rows.append((doc_id, len(text), 0, 0, hashlib.sha256(text).hexdigest(), [], text if with_text else None))
                continue
            kept = np.frombuffer(text, "u1")[~mask].tobytes()
            turns = np.flatnonzero(np.diff(np.concatenate(([0], mask.view("i1"), [0]))))
            spans = [{"begin": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])]
            rows.append((doc_id, len(text), int(mask.sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans, kept if with_text else None))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return _each_block(files, marks, run, RESULT)


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte ranges removed), kept (the rest) of each row of `docs`."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text(F.col("text")).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(3, min(30, int(np.ceil(np.log2(1 + 2 * total / (REACH + 1) / PER_BUCKET)))))
    out = new_path(spark, "texts")
    where, root = pafs.FileSystem.from_uri(out)
    where.create_dir(root, recursive=True)
    blocks = cut(rows, out, bits)
    files = lambda t: t.where("bucket IS NULL").select("block", "path")
    found = contexts(files(blocks), repeated(blocks, 0), out, bits)
    known = saved(verdicts(found, bits), "verdicts")
    open_ = bring(files(found), known, bits)
    marks = known.unionByName(compare(open_, bits)).unionByName(repeated(open_.where("what = 'hot'"), 3, ("keys", "more")))
    return finish(files(found), marks, with_text)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
