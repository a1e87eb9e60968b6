import random
import zlib

import numpy as np

from ledgerlake.llm import language as la

SYLLABLES = {"en": "the ing tion er and ou sh wh", "de": "der ung sch ein pf keit ü ch", "fr": "eau eux le tion qu é oi ment", "es": "ción ñ ado que ll os ar ez", "xx": "kwa mbo zulu tsh ngo ewe"}


def texts(rng, lang, n):
    pieces = SYLLABLES[lang].split()
    word = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(1, 3)))
    return [" ".join(word() for _ in range(rng.randint(4, 60))) for _ in range(n)]


def test_held_out_texts_are_recognised(docs_of):
    rng = random.Random(1)
    rows = [(lang, t) for lang in SYLLABLES for t in texts(rng, lang, 60)]
    rng.shuffle(rows)
    docs = [(k, t) for k, (_, t) in enumerate(rows)]
    table = docs_of(docs, {k: lang for k, (lang, _) in enumerate(rows)})
    got = {r["doc_id"]: r for r in la.identify(table, *la.fit(table)).collect()}
    held = [k for k in range(len(rows)) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert np.mean([got[k]["lang_pred"] == rows[k][0] for k in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_labels_of_the_held_out_fold_teach_nothing(docs_of):
    rng = random.Random(2)
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    rows = [(k, texts(rng, "en" if k % 2 else "de", 1)[0]) for k in range(400)]
    lang = {k: "zz" if k in held else "en" if k % 2 else "de" for k, _ in rows}
    table = docs_of(rows, lang)
    assert la.fit(table)[0] == ["de", "en"]


def test_family_comes_first():
    rng = random.Random(3)
    machines = []
    data = {lang: [la.features(t) for t in texts(rng, lang, 40)] for lang in ("en", "de", "fr", "es")}
    for level, yes, no, a, b in (("family", "germanic", "romance", ("en", "de"), ("fr", "es")), ("language", "de", "en", ("de",), ("en",)), ("language", "es", "fr", ("es",), ("fr",))):
        x = np.vstack([v for side in (a, b) for lang in side for v in data[lang]])
        y = np.repeat([1, -1], [sum(len(data[k]) for k in a), sum(len(data[k]) for k in b)])
        machines.append(la.Machine(level, yes, no, *la.train(x, y)))
    for lang in data:
        assert la.predict(texts(rng, lang, 1)[0] * 3, sorted(data), machines)[0] == lang


def test_awkward_and_empty_tables(docs_of, awkward):
    rows = awkward + [(200 + k, "eine kleine nachtmusik und der hund") for k in range(8)]
    table = docs_of(rows, {200 + k: "de" for k in range(8)})
    got = la.identify(table, *la.fit(table)).collect()
    assert len(got) == len(rows)
    assert {(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (1, 2, 3)} == {("und", 0.0)}
    empty = docs_of([])
    assert la.fit(empty) == ([], []) and la.identify(empty, [], []).count() == 0
    assert la.predict("some text", [], []) == ("und", 0.0)
    assert la.predict("some text", ["en"], []) == ("en", 1.0)
