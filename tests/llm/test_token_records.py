import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import token_records as tr

PATH = public_tokenizers.path(tr.VOCABULARY)
ODD = ["It's  the\tTest'S, don't! 3.14e10 ÀÉÎ straße İstanbul ΣΑΣ J̌ é  x\x1cy", "<|startoftext|> a<|endoftext|>b <|STARTOFTEXT|>", "你好 мир ​ zero", "a" * 3000, "!!!... ??? --", "\u0000 \x0b\x0c", "naïve café", "ﬁ ½ ①"]


def whole(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_pieces_give_the_ids_of_whole_texts():
    encode = tr.WordEncoder(PATH, 2)
    assert [np.frombuffer(x, "<u2").tolist() + [1] for x in encode(ODD)] == whole(ODD)


def test_pieces_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(tr, "CACHE_BYTES", 50)
    encode = tr.WordEncoder(PATH, 4)
    for text in ODD * 2:
        assert np.frombuffer(next(encode([text])), "<u4").tolist() + [1] == whole([text])[0]


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        tr.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), 2)


def test_round_trip(docs_of, awkward):
    rows = awkward + [(100 + k, t) for k, t in enumerate(ODD)]
    got = sorted(map(tuple, tr.encode_and_read(docs_of(rows)).collect()), key=lambda r: r[1])
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for (doc_id, _), ids in zip(ordered, whole([t for _, t in ordered])):
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_shuffled_reads_give_every_record(spark, docs_of):
    rows = [(k, f"word{k} and more") for k in range(200)]
    shards = tr.write(docs_of(rows), PATH)
    got = tr.shuffled(spark, shards, 3).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(200)) and [r["doc_id"] for r in got] != list(range(200))
    assert {r["doc_id"]: r["ids"] for r in got} == dict(zip(range(200), whole([t for _, t in rows])))


def test_damage_is_found(spark, docs_of):
    shards = tr.write(docs_of([(1, "some words here")]), PATH)
    path = shards[0]["records"].removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[14] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged record"):
        tr.digests(spark, shards).collect()


def test_empty_table(docs_of):
    assert tr.encode_and_read(docs_of([])).collect() == []
