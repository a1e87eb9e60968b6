import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import phrase_index as pi
from ledgerlake.llm.common import cogrouped

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    held = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            held.setdefault(tuple(w[k:k + window]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for phrase, ids in held.items():
            for k in range(len(w) - len(phrase) + 1):
                if tuple(w[k:k + len(phrase)]) == phrase:
                    hit.update(range(k, k + len(phrase)))
                    found |= ids
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(pi, "SEGMENT_BYTES", 400)
    monkeypatch.setattr(pi, "PHRASES_AT_ONCE", 7)


@pytest.fixture(params=[None, 7, 31])
def partitions(spark, request):
    """Shuffles as they come, and kept at so many partitions: small ones are else merged into one."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    if request.param:
        spark.conf.set("spark.sql.shuffle.partitions", request.param)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hits_equal_brute_force(spark, docs_of, small, partitions):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(["the", "of", "a", "b", "cat", "Dog", "Éa", "x1"]) for _ in range(n))
    items = [(k, say(rng.choice([1, 3, 9, 10, 11, 25]))) for k in range(12)] + [(3, say(14)), (None, "cat dog the of"), (50, None), (51, "..."), (9, items_text := say(12)), (10, items_text)]
    docs = [(k, say(rng.randint(0, 60))) for k in range(60)]
    docs += [(100 + k, say(5) + " " + (t or "") + ", " + say(5)) for k, (_, t) in enumerate(items)] + [(4, items[4][1]), (4, items[4][1]), (None, None)]
    got = pi.exact_hits(docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_a_phrase_never_spans_two_documents(spark, docs_of):
    docs = [(k, t) for k, t in enumerate(["a b c d e", "f g h i j"] * 5)]
    got = pi.exact_hits(docs_of(docs), spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string"))
    assert not any(r["contaminated"] for r in got.collect())


def test_proximity_in_any_order(spark, docs_of):
    docs = [(1, "red x green y blue"), (2, "blue green red"), (3, "red green x x x x x x blue"), (4, "red red red")]
    index = pi.build(docs_of(docs))
    asked = pi.phrases(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"))
    got = pi.occurrences(index, asked, width=5).join(pi.documents_of(index), ["segment", "place"]).collect()
    assert {(r["doc_id"], r["begin"], r["end"]) for r in got} == {(1, 0, 5), (2, 0, 3)}


def test_awkward_and_empty_tables(spark, docs_of, awkward):
    none = spark.createDataFrame([], "item_id long, text string")
    assert sorted(map(str, (tuple(r) for r in pi.exact_hits(docs_of(awkward), none).collect()))) == sorted(map(str, brute(awkward, [])))
    assert pi.exact_hits(docs_of([]), none).count() == 0
    item = spark.createDataFrame([(1, "word word")], "item_id long, text string")
    assert sorted(map(str, (tuple(r) for r in pi.exact_hits(docs_of(awkward), item).collect()))) == sorted(map(str, brute(awkward, [(1, "word word")])))


def test_cogroup_refuses_keys_of_two_types(spark):
    left, right = spark.range(3).select(F.col("id").cast("int").alias("k")), spark.range(3).select(F.col("id").alias("k"))
    with pytest.raises(TypeError, match="differ in type"):
        cogrouped(left, right, ["k"], lambda a, b: a, "k long")


def test_stage_drops_the_same_documents_at_any_partitioning(spark, docs_of, partitions):
    docs = [(k, f"x{k} " * 5 + ("a b c d e f g h i j" if k % 3 == 0 else "a b c d e") + " y" * k) for k in range(60)]
    got = pi.keep_clean(docs_of(docs), spark.createDataFrame([(1, "A b c d e f g h i j")], "item_id long, text string"))
    assert {r["doc_id"] for r in got.collect()} == {k for k in range(60) if k % 3}
