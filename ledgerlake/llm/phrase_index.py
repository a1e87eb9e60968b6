"""Benchmark decontamination by a positional inverted index of the training words.

Documents are cut into segments of bounded size. Per segment and term the index stores the term's word positions
(one number line per segment, with a gap between documents, so that no phrase spans two). A test phrase is looked
up by its rarest term in the corpus: only segments that hold it are visited, and there the lists of its terms,
shifted by their place in the phrase, are intersected from the rarest on. What is left are exact occurrences.
`proximity` finds documents' stretches that hold all terms of a phrase, in any order, within a given width.

The index is a written table; test phrases meet it in joins on the term, and one segment (bounded) with one block
of phrases (bounded) makes a group. A term that every document holds is one list per segment, never one list.

Defined cases: null and empty texts have no words; an item without words has no phrase; an item of fewer words
than a window is one phrase; equal items count by their ids; a null item id counts as the empty text; rows
repeated with one doc_id are each judged; empty tables give no rows or no hits; other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import clean_text, cogrouped, new_path, saved, scratch, table

WINDOW = 10
#: A segment is closed once its texts have so many bytes.
SEGMENT_BYTES = 12 << 20
#: Phrases that meet a segment at once.
PHRASES_AT_ONCE = 50_000

#: Letters A-Z to lower case; every other ASCII byte that is no letter or digit separates words.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))

INDEX_SCHEMA = "segment long, term binary, n long, postings binary, doc_ids array<long>, digests array<binary>, starts array<long>, n_words array<long>"


def words(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


def _binary(data: bytes, ends: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in `data`."""
    offsets = np.concatenate(([0], ends)).astype("i4")
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def _segment(number: int, doc_ids: list, digests: list, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Index rows of one segment: one for its documents, one for each term."""
    sizes = np.array([len(w) for w in texts], "i8")
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    place: dict[bytes, int] = {}
    ids = np.array([place.setdefault(w, len(place)) for doc in texts for w in doc], "i4")
    at = np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(ids, kind="stable")
    first = np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=len(place))))) if len(ids) else np.zeros(1, "i8")
    gaps = np.diff(at[order], prepend=0)
    gaps[first[:-1]] = at[order][first[:-1]]
    head = pa.schema([("segment", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("postings", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary())), *[(c, pa.list_(pa.int64())) for c in ("starts", "n_words")]])
    yield pa.RecordBatch.from_pydict({"segment": [number], "term": [None], "n": [len(sizes)], "postings": [None], "doc_ids": [doc_ids], "digests": [digests], "starts": [starts], "n_words": [sizes]}, head)
    terms, packed = list(place), gaps.astype("<u4").tobytes()
    for k in range(0, len(terms), 20_000):
        part, span = terms[k:k + 20_000], first[k:k + 20_001]
        none = pa.nulls(len(part), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(part), number)), _binary(b"".join(part), np.cumsum([len(w) for w in part])), pa.array(np.diff(span)),
            _binary(packed[4 * span[0]:4 * span[-1]], 4 * (span[1:] - span[0])), none, pa.nulls(len(part), pa.list_(pa.binary())), none, none], schema=head)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary"))).alias("digest")


def build(docs: DataFrame) -> DataFrame:
    """The index of `docs`, written to the shared folder."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, ids, digests, texts = TaskContext.get().partitionId() << 24, 0, [], [], []
        for batch in batches:
            for doc_id, digest, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                digests.append(digest)
                texts.append(words(text := text.as_py()))
                size += len(text)
                if size >= SEGMENT_BYTES:
                    yield from _segment(number, ids, digests, texts)
                    number, size, ids, digests, texts = number + 1, 0, [], [], []
        if ids:
            yield from _segment(number, ids, digests, texts)

    text = clean_text(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _digest(text))
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "postings")
    found = rows.mapInArrow(index, INDEX_SCHEMA)
    found.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """phrase (its terms joined), terms, items: all distinct windows of the items' words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words(text)
                for k in range(max(1, len(w) - window + 1) if w else 0):
                    ids.append(item)
                    found.append(w[k:k + window])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"])

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), clean_text(F.col("text")).alias("text"))
    return rows.mapInArrow(cut, "item string, terms array<binary>").groupBy("terms").agg(F.collect_set("item").alias("items"))


def _lookups(index: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Postings of the test terms; phrases with their terms from the rarest on, for each segment that holds the rarest; blocks."""
    asked = saved(asked.withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    blocks = -(-max(1, asked.count()) // PHRASES_AT_ONCE)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("phrase"), F.lit(blocks)))
    vocabulary = asked.select(F.explode("terms").alias("term")).distinct()
    postings = saved(index.where("term IS NOT NULL").select("segment", "term", "n", "postings").join(vocabulary, "term"), "test-postings")
    counts = postings.groupBy("term").agg(F.sum("n").alias("count"))
    placed = asked.select("phrase", F.posexplode("terms").alias("shift", "term")).join(counts, "term", "left")
    # A term that no document holds ends the search: its phrase occurs nowhere.
    ranked = placed.groupBy("phrase").agg(
        F.sort_array(F.collect_list(F.struct("count", "shift", "term"))).alias("plan"), F.count(F.when(F.col("count").isNull(), 1)).alias("missing"),
    ).where("missing = 0").withColumn("rarest", F.col("plan")[0]["term"])
    where = postings.select(F.col("term").alias("rarest"), "segment")
    visits = ranked.join(where, "rarest").join(asked.select("phrase", "block", "items"), "phrase")
    return postings, visits.select("segment", "block", "plan", "items"), blocks


def _positions(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, "<u4").astype("i8"))


def occurrences(index: DataFrame, asked: DataFrame, width: int | None = None) -> DataFrame:
    """segment, place of the document in it, begin, end (word positions in the document) and items of every hit.

    Exact phrases if `width` is None; else stretches of at most `width` words that hold all terms in any order.
    """
    postings, visits, blocks = _lookups(index, asked)
    texts = index.where("term IS NULL").select("segment", F.col("term"), "postings", "starts", "n_words")
    lists = postings.select("segment", "term", "postings", F.lit(None).cast("array<long>").alias("starts"), F.lit(None).cast("array<long>").alias("n_words"))
    left = texts.unionByName(lists).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def meet(held: pa.Table, found: pa.Table) -> pa.Table:
        out = {"segment": [], "place": [], "begin": [], "end": [], "items": []}
        packed, starts = {}, None
        for term, data, at in zip(held["term"].to_pylist(), held["postings"].to_pylist(), held["starts"]):
            if term is None:
                starts = np.asarray(at.values)
            else:
                packed[term] = data
        open_lists: dict[bytes, np.ndarray] = {}

        def positions(term: bytes) -> np.ndarray:
            if term not in open_lists:
                open_lists[term] = _positions(packed[term])
            return open_lists[term]

        for plan, items in zip(found["plan"].to_pylist(), found["items"].to_pylist()):
            if any(step["term"] not in packed for step in plan):
                continue
            if width is None:
                begin = positions(plan[0]["term"]) - plan[0]["shift"]
                for step in plan[1:]:
                    there = positions(step["term"])
                    k = np.searchsorted(there, begin + step["shift"])
                    begin = begin[(k < len(there)) & (there[np.minimum(k, len(there) - 1)] == begin + step["shift"])]
                    if not len(begin):
                        break
                spans = [(b, b + len(plan)) for b in begin]
            else:
                spans = near([positions(t) for t in {step["term"] for step in plan}], width)
            for b, e in spans:
                doc = int(np.searchsorted(starts, b, side="right")) - 1
                if doc < len(starts) - 1 and e >= starts[doc + 1]:
                    continue  # a stretch of a proximity match over the gap between two documents
                for name, value in zip(out, (0, doc, b - starts[doc], e - starts[doc], items)):
                    out[name].append(int(value) if name != "items" else value)
        out["segment"] = [held["segment"][0].as_py()] * len(out["place"])
        return pa.table(out, schema=pa.schema([*[(c, pa.int64()) for c in ("segment", "place", "begin", "end")], ("items", pa.list_(pa.string()))]))

    def grouped(key, held: pa.Table, found: pa.Table) -> pa.Table:
        if not held.num_rows or not found.num_rows:
            return pa.table({"segment": [], "place": [], "begin": [], "end": [], "items": []}, schema=pa.schema([*[(c, pa.int64()) for c in ("segment", "place", "begin", "end")], ("items", pa.list_(pa.string()))]))
        return meet(held, found)

    return cogrouped(left, visits, ["segment", "block"], grouped, "segment long, place long, begin long, end long, items array<string>")


def near(lists: list[np.ndarray], width: int) -> list[tuple[int, int]]:
    """Shortest stretches [begin, end) of at most `width` words that hold one position of every list.

    From each position of the rarest list, the nearest position of every other list within reach is looked up on
    both sides; stretches that end at the rarest term's reach are enough, as every match holds the rarest term.
    """
    lists = sorted(lists, key=len)
    every = np.sort(np.concatenate(lists))
    which = {int(p): k for k, there in enumerate(lists) for p in there}
    found = set()
    for anchor in lists[0]:
        reach = every[np.searchsorted(every, anchor - width + 1):np.searchsorted(every, anchor + width)]
        low, seen, need = 0, {}, len(lists)
        for p in reach:
            seen[which[int(p)]] = seen.get(which[int(p)], 0) + 1
            while len(seen) == need:
                if p - reach[low] < width:
                    found.add((int(reach[low]), int(p) + 1))
                k = which[int(reach[low])]
                seen[k] -= 1
                if not seen[k]:
                    del seen[k]
                low += 1
    return sorted(found)


def documents_of(index: DataFrame) -> DataFrame:
    """segment, place, doc_id, digest (of the text), n_words of every document."""
    packed = index.where("term IS NULL").select("segment", F.posexplode(F.arrays_zip("doc_ids", "digests", "n_words")).alias("place", "d"))
    return packed.select("segment", F.col("place").cast("long").alias("place"), F.col("d.doc_ids").alias("doc_id"), F.col("d.digests").alias("digest"), F.col("d.n_words").alias("n_words"))


def exact_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit (words in occurring windows), n_items, items_sha256, contaminated per row of `docs`."""
    index = build(docs)
    found = occurrences(index, phrases(items, window))
    spans = F.array_sort(F.collect_set(F.struct("begin", "end")))
    per_doc = found.groupBy("segment", "place").agg(spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(F.greatest(s["upto"], x["end"]).alias("upto"), (s["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(s["upto"], x["begin"]))).alias("n")),
        lambda s: s["n"])
    per_doc = per_doc.select("segment", "place", covered.alias("n_hit"), "items")
    rows = documents_of(index).join(per_doc, ["segment", "place"], "left")
    none = F.array().cast("array<string>")
    rows = rows.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)), "items": F.coalesce("items", none)})
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` in whose text no window of an item occurs, with their columns."""
    with scratch(docs.sparkSession):
        index = build(docs)
        bad = occurrences(index, phrases(items, window)).select("segment", "place").distinct().join(documents_of(index), ["segment", "place"])
        bad = saved(bad.select("digest").distinct(), "contaminated", keep=True)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]).alias("row"), _digest(clean_text(F.col("text"))))
    return rows.join(bad, "digest", "left_anti").select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(names)])


def op4_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, array_to_string(w[k:k + 9], ' ') AS phrase, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
places AS (SELECT row, w, unnest(range(1, len(w) + 1)) AS k FROM d),
hits AS (
  SELECT p.row, p.k, x.n, x.item FROM (SELECT DISTINCT n FROM windows) s JOIN places p ON p.k + s.n - 1 <= len(p.w)
  JOIN windows x ON x.n = s.n AND x.phrase = array_to_string(p.w[p.k:p.k + s.n - 1], ' ')),
words AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(k, k + n)) AS j FROM hits) GROUP BY row),
items AS (SELECT row, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row) LEFT JOIN items USING (row)
"""
