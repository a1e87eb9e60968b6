"""Token ids in length-delimited binary record files, with an offset index beside each file.

A record is: length of the payload (unsigned 64 bit), masked checksum of those 8 bytes (32 bit), payload,
masked checksum of the payload (32 bit), all little-endian. The checksum is CRC-32, masked by a rotation by
15 bits and a constant, so that a stored checksum of data holding checksums is no fixed point. The payload
is one document's ids, 2 bytes each where the vocabulary allows it, else 4. The index holds id, offset and
number of tokens of every record, so that a reader can visit records in any order.

Documents are range-partitioned by id; each task writes one shard in id order, under a name of its own
attempt. Only the shards that tasks report are read, so a lost executor leaves at most an orphan file.

Defined cases: null and empty texts give the end id alone; a null id sorts first; rows repeated with one id
are all written, in order of their texts; an empty table gives no shard and no row; columns other than id
and text are not looked at.
"""
from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import clean_text, new_path, table

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Bytes of encoded pieces, and of runs, that a Python worker remembers before it starts anew.
CACHE_BYTES = 48 << 20
#: Characters that are encoded at once.
PORTION = 6 << 20
MASK_DELTA = 0xA282EAD8
INDEX_HEAD = "<8sIQ"
INDEX_MAGIC = b"TOKIDX01"

SHARD_SCHEMA = "shard long, records string, index string, n_docs long, n_tokens long, n_bytes long"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies: itself, or the next from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class WordEncoder:
    """Ids of texts as bytes, for vocabularies that lower-case, drop white space and merge within words.

    No piece between ASCII white space takes ids from another, so each different piece is encoded once. Most pieces
    are a run of plain letters and a run of signs, which such vocabularies split anyway; runs are encoded once too.
    Other pieces (digits, apostrophes, letters that change when normalised) go through the whole tokenizer.
    """

    #: Letters that are their own composed form in either case, then signs but the apostrophe.
    PLAIN = re.compile(r"([A-Za-zß-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)").fullmatch
    NORMALIZERS, SPLITS = ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        kinds = [[x["type"] for x in (parts[part] or {}).get(steps, [])] for part, steps in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if kinds != [self.NORMALIZERS, self.SPLITS]:
            raise ValueError(f"{path} is not of the kind that lower-cases and drops white space")
        self.merge, self.kind, self.letters = self.tokenizer.model.tokenize, "H" if width == 2 else "I", byte_letters()
        self.pieces, self.runs, self.run_bytes = Pieces(self.piece), {"": b""}, 0

    def run(self, letters: str) -> bytes:
        ids = self.runs.get(letters)
        if ids is None:
            visible = letters if letters.isascii() else "".join([self.letters[b] for b in letters.encode()])
            ids = self.runs[letters] = array(self.kind, [t.id for t in self.merge(visible)]).tobytes()
            self.run_bytes += len(letters) + len(ids) + 100
        return ids

    def piece(self, piece: bytes) -> bytes:
        plain = self.PLAIN(text := piece.decode())
        if plain is None:
            return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        letters, signs = plain.groups()
        return self.run(letters.lower()) + self.run(signs)

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        if self.pieces.size > CACHE_BYTES:
            self.pieces = Pieces(self.piece)
        if self.run_bytes > CACHE_BYTES:
            self.runs, self.run_bytes = {"": b""}, 0
        for text in texts:
            yield b"".join(map(self.pieces.__getitem__, text.encode().split()))


class Pieces(dict):
    """Ids by piece, found when first asked for."""

    def __init__(self, find):
        super().__init__()
        self.find, self.size = find, 0

    def __missing__(self, piece: bytes) -> bytes:
        ids = self[piece] = self.find(piece)
        self.size += len(piece) + len(ids) + 100
        return ids


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, width: int) -> WordEncoder:
    """One per Python worker."""
    if (path, width) not in _ENCODERS:
        _ENCODERS[path, width] = WordEncoder(path, width)
    return _ENCODERS[path, width]


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of about `PORTION` characters at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= PORTION:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def id_width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def write(docs: DataFrame, vocabulary: str, end_id: int = END_ID, out: str | None = None) -> list[dict]:
    """Write all documents in ascending id order; returns one entry per shard, in that order."""
    spark = docs.sparkSession
    out, width = out or new_path(spark, "tokens"), id_width(vocabulary)
    pafs.FileSystem.from_uri(out)[0].create_dir(pafs.FileSystem.from_uri(out)[1], recursive=True)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = pafs.FileSystem.from_uri(out)
        number, encode, end = TaskContext.get().partitionId(), encoder(vocabulary, width), np.array([end_id], f"<u{width}").tobytes()
        name, at, stream, ids, offsets, tokens = f"shard-{number:06d}-{uuid.uuid4().hex}", 0, None, [], [], []
        for held_ids, texts in portions(batches):
            frames = []
            for doc_id, payload in zip(held_ids, encode(texts)):
                payload += end
                head = struct.pack("<Q", len(payload))
                frames += (head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload)))
                ids.append(doc_id)
                offsets.append(at)
                tokens.append(len(payload) // width)
                at += len(payload) + 16
            stream = stream or where.open_output_stream(f"{root}/{name}.rec")
            stream.write(b"".join(frames))
        if stream is None:
            return
        stream.close()
        body = b"".join((
            np.array([x is None for x in ids], "u1").tobytes(), np.array([x or 0 for x in ids], "<i8").tobytes(),
            np.array(offsets, "<u8").tobytes(), np.array(tokens, "<u8").tobytes(),
        ))
        with where.open_output_stream(f"{root}/{name}.idx") as index:
            index.write(struct.pack(INDEX_HEAD, INDEX_MAGIC, width, len(ids)) + body + struct.pack("<I", masked(body)))
        yield pa.RecordBatch.from_pydict({
            "shard": [number], "records": [f"{out}/{name}.rec"], "index": [f"{out}/{name}.idx"],
            "n_docs": [len(ids)], "n_tokens": [sum(tokens)], "n_bytes": [at],
        })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text(F.col("text")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    done = rows.mapInArrow(shard, SHARD_SCHEMA).collect()  # a row for each shard
    return [r.asDict() for r in sorted(done, key=lambda r: r["shard"])]


def read_index(path: str) -> tuple[int, list, np.ndarray, np.ndarray]:
    """Width of an id, document ids, offsets and numbers of tokens of one shard."""
    where, name = pafs.FileSystem.from_uri(path)
    with where.open_input_stream(name) as stream:
        data = stream.read()
    magic, width, n = struct.unpack_from(INDEX_HEAD, data)
    body = data[struct.calcsize(INDEX_HEAD):-4]
    if magic != INDEX_MAGIC or struct.unpack("<I", data[-4:])[0] != masked(body):
        raise ValueError(f"damaged index {path}")
    null = np.frombuffer(body, "u1", n)
    doc_ids, offsets, tokens = (np.frombuffer(body, kind, n, n + 8 * n * k) for k, kind in enumerate(("<i8", "<u8", "<u8")))
    return width, [None if x else int(d) for x, d in zip(null, doc_ids)], offsets, tokens


def read_record(stream, where: str) -> bytes:
    head = stream.read(12)
    n, crc = struct.unpack("<QI", head)
    if crc != masked(head[:8]):
        raise ValueError(f"damaged length in {where}")
    body = stream.read(n + 4)
    if len(body) != n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
        raise ValueError(f"damaged record in {where}")
    return body[:n]


def _shards(spark: SparkSession, shards: list[dict]) -> DataFrame:
    start, rows = 0, []
    for s in shards:
        rows.append((s["records"], s["index"], start))
        start += s["n_tokens"]
    return spark.createDataFrame(rows, "records string, index string, start long").repartition(max(1, len(rows)))


def digests(spark: SparkSession, shards: list[dict]) -> DataFrame:
    """What the files hold, per document: place among all ids, number of ids and their CRC-32 as 32-bit integers."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            where, name = pafs.FileSystem.from_uri(row["records"])
            width, doc_ids, _, tokens = read_index(row["index"])
            starts = row["start"] + np.concatenate(([0], np.cumsum(tokens[:-1]))).astype("i8") if len(tokens) else []
            with where.open_input_stream(name, buffer_size=1 << 20) as stream:
                for k in range(0, len(doc_ids), 4096):
                    crc, counts = [], []
                    for _ in doc_ids[k:k + 4096]:
                        ids = np.frombuffer(read_record(stream, row["records"]), f"<u{width}")
                        counts.append(len(ids))
                        crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[k:k + 4096], pa.int64()), pa.array(starts[k:k + 4096], pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _shards(spark, shards).mapInArrow(read, READ_SCHEMA)


def shuffled(spark: SparkSession, shards: list[dict], seed: int) -> DataFrame:
    """doc_id, place and ids of every record; shards in a seeded order, and each shard's records in one, by the index."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            where, name = pafs.FileSystem.from_uri(row["records"])
            width, doc_ids, offsets, _ = read_index(row["index"])
            order = np.random.default_rng([seed, zlib.crc32(str(row["start"]).encode())]).permutation(len(doc_ids))
            with where.open_input_file(name) as stream:
                for k in range(0, len(order), 256):
                    ids = []
                    for j in order[k:k + 256]:
                        stream.seek(int(offsets[j]))
                        ids.append(np.frombuffer(read_record(stream, row["records"]), f"<u{width}").astype("i4"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_ids[j] for j in order[k:k + 256]], pa.int64()), pa.array(order[k:k + 256], pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                        names=["doc_id", "place", "ids"])

    order = np.random.default_rng(seed).permutation(len(shards))
    rows = _shards(spark, shards)
    ranked = spark.createDataFrame([(s["records"], int(k)) for s, k in zip(shards, order)], "records string, turn long")
    rows = rows.join(ranked, "records").repartitionByRange(max(1, len(shards)), "turn").sortWithinPartitions("turn")
    return rows.select("records", "index", "start").mapInArrow(read, "doc_id long, place long, ids array<int>")


def encode_and_read(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return digests(docs.sparkSession, write(docs, public_tokenizers.path(VOCABULARY)))


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read(table(spark, sf_dir, "documents"))
