import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from ledgerlake.llm import toxicity as tx


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_finds_what_brute_force_finds():
    rng = random.Random(1)
    words = {w: 1.0 for w in ("idiot", "scum", "worthless", "pathetically", "ab")}
    stems = {"lowei": 2.0, "chl": 1.0}
    automaton = tx.LexiconAutomaton(words, stems)
    letters = "idotscumwrhleaptycab"
    for _ in range(3000):
        w = list(rng.choice([*words, *stems]) + rng.choice(["", "", "xy"]))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters)])
        w = "".join(w)
        near = [distance(w, t) for t in words if distance(w, t) <= tx.edits(len(t))]
        near += [d for t in stems for k in range(1, len(w) + 1) if (d := distance(w[:k], t)) <= tx.edits(len(t))]
        found = automaton.find(w)
        assert (found is None) == (not near), w
        if found:
            assert found[0] == min(near), w


def corpus(n=600, seed=2):
    rng = random.Random(seed)
    syllables = "the an er on ti es re st en at ou".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for k in range(n):
        text = [word() for _ in range(rng.randint(10, 80))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grumpkin", "blorth", "snivelwort", "zunk" + word()]))
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_held_out_texts_and_misspellings(spark, docs_of):
    rows, labels = corpus()
    table, marks = docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tx.fit(table, marks)
    assert {"grumpkin", "blorth", "snivelwort"} <= set(model.words) and any(s.startswith("zunk") for s in model.stems)
    got = {r["doc_id"]: r for r in tx.score(table, model).collect()}
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(got[k]["predicted"] == (k % 5 == 0) for k in held) >= 0.97 * len(held)
    assert model.score("ater grumpkn then snivlwort erst blorht blorthh") > 0.5 > model.score("ater then erst reston")


def test_quotation_is_told_from_use():
    model = tx.Model(words={"blorth": 8.0}, weights=[2.0, 0.1, 3.0, 1.0, 0.1, 1.0, 0.5, 0.2, -4.0])
    use = model.score("well you blorth and more of the same")
    quoted = model.score('the letter reads: "we saw a blorth there" and ends')
    said = model.score("he said blorth was the word in use then")
    assert use > 0.5 and quoted < use and said < use
    tokens = tx.TOKEN.findall(text := 'a "blorth" b blorth')
    model.learn(set(tokens))
    assert [m[1] for m in model.matches(text, tokens, {"blorth"})] == ["quoted", "plain"]


def test_copies_count_once(spark, docs_of):
    """A word that only copies of one toxic text hold does not enter the lexicon."""
    rows, labels = corpus(300)
    near = [(1000 + k, f"common rare{k % 2} thatword grumpkin here") for k in range(80)]
    marks = spark.createDataFrame(labels + [(i, 0, 1) for i, _ in near], "doc_id long, quality int, toxic int")
    model = tx.fit(docs_of(rows + near), marks)
    assert "thatword" not in model.words and "grumpkin" in model.words


def test_a_slur_after_few_words_stays_despite_quotations(spark, docs_of):
    """Many toxic texts, three different words before the slur, and clean texts that quote it: the share is of texts."""
    rows, labels = corpus(900)
    rng = random.Random(5)
    for k, (i, text) in enumerate(rows):
        words = text.split()
        if labels[i][2]:
            words[3:3] = [("you", "utter", "filthy")[k % 3], "quobble"]
        elif k % 30 == 1:
            words.insert(rng.randrange(len(words)), "quobble")
        rows[k] = (i, " ".join(words))
    model = tx.fit(docs_of(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert "quobble" in model.words


def test_classes_count_alike_on_both_sides(spark, docs_of):
    """Copies count once among toxic and among other texts, and every word of any copy counts."""
    text = "one two three four five six seven eight nine ten"
    rows = [(k, text) for k in range(40)] + [(100 + k, f"{text} other{k} lone words here") for k in range(3)]
    marks = spark.createDataFrame([(k, 1, k % 2) for k, _ in rows], "doc_id long, quality int, toxic int")
    got = {r["word"]: (r["pos"], r["neg"]) for r in tx.vocabulary(tx.counted(docs_of(rows), marks)).collect()}
    side = lambda k, t: tx.copy_class(t.split()) if zlib.crc32(str(k).encode()) % 5 else None
    for word in ("one", "lone", "other0", "other1", "other2"):
        held = {(k % 2, side(k, t)) for k, t in rows if word in t.split() and side(k, t) is not None}
        assert got.get(word, (0, 0)) == (sum(x for x, _ in held), sum(1 - x for x, _ in held)), word
    assert got["one"][0] <= 4 and got["one"][1] <= 4


def test_every_term_that_passes_enters_the_lexicon(spark):
    """More words pass than any fixed limit would keep, and each brings all its beginnings along."""
    made = [f"{k:05d}".translate(str.maketrans("0123456789", "bcdfghjklm")) + "xyzaeiou" for k in range(6000)]
    rows = {(w, 20 + k % 7, 0, False, -100.0 - k) for k, w in enumerate(made)}
    uses = Counter()
    for word, pos, *_ in rows:
        uses.update({word[:length]: pos for length in tx.STEMS})
    rows |= {(stem, pos, 0, True, -float(pos)) for stem, pos in uses.items()}
    good = spark.createDataFrame(list(rows), "word string, pos long, neg long, stem boolean, chance double")
    got = tx.lexicon(good).collect()
    stems = {r["word"] for r in got if r["stem"]}
    words = {r["word"] for r in got if not r["stem"]}
    assert all(w in words or any(w[:k] in stems for k in tx.STEMS) for w in made)
    assert not any(w[:k] in stems for w in words for k in tx.STEMS)


def test_keep_clean_keeps_columns_and_clean_rows(spark, docs_of):
    rows, labels = corpus(400)
    table = docs_of(rows)
    kept = tx.keep_clean(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, _ in rows if k % 5}


def test_awkward_and_empty_tables(spark, docs_of, awkward):
    rows, labels = corpus(300)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (10, 1, None), (11, 0, 0), (11, 0, 1)], "doc_id long, quality int, toxic int")
    table = docs_of([(i if i is None else i + 5000, t) for i, t in awkward] + rows)
    got = tx.score(table, tx.fit(table, marks)).collect()
    assert len(got) == len(table.collect()) and all(0 <= r["_2"] <= 1 for r in tx.score(table, tx.fit(table, marks)).select(F.col("key"), F.col("predicted").alias("_2")).collect())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = tx.fit(table, none)
    assert {r["predicted"] for r in tx.score(table, model).collect()} == {0}
    assert tx.score(docs_of([]), model).count() == 0
