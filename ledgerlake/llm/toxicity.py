"""Toxicity by a learnt lexicon, found despite misspellings, and read in its context.

1. Lexicon: words, and stems that start words, which labelled toxic texts use far more often than others. Toxic and
   other texts count alike: copies and most near copies of one text fall into one class (`copy_class`), and a word
   counts once for every class with a text that holds it. A term enters if such an excess would be chance with a
   probability of `ALPHA` over all words tested.
2. Matching: the lexicon is a trie. A Levenshtein automaton runs along it: a state holds trie nodes with the errors
   made so far, and successor states are made when first needed and kept. One edit is allowed in terms of 5 letters
   or more, two from 10. A misspelt form that training texts hold counts by its own evidence, not its neighbour's.
3. Context: a window of words around each match tells use from quotation (quotation marks, reporting verbs) and
   aims (second person). A logistic model over the summed evidence per context, fitted on a bounded sample of
   labelled texts (`FIT_ROWS`), gives the score.

Defined cases: null and empty texts have no matches and get the score of such texts; without usable labels every
score is 0; labels repeated for a document count as toxic if any does; null labels are ignored; rows repeated with
one doc_id are each scored; an empty table gives no rows; other columns are not looked at.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import id_remainder, saved, scratch, table, word_hashes

HELD_OUT = (5, 0)
ALPHA = 0.01
#: Share of toxic texts among those that hold a term, at least.
LEAST_SHARE = 0.7
STEMS = range(4, 9)
#: Labelled texts that the logistic model is fitted on, about, drawn by the hash of the text.
FIT_ROWS = 20_000
#: Words and pairs that a task counts before it passes them on.
HELD_WORDS = 1_000_000
#: Words on either side of a match that make its context.
AROUND = 6
#: Words that a Python worker remembers before it starts anew.
KNOWN_WORDS = 400_000

TOKEN = re.compile(r"[^\W_]+")
# Signs and words that mark quotation, and words of address.
QUOTES = "\"“”„«»‹›‘’"
REPORTING = frozenset("said says quote quoted wrote called sagte sagt schrieb zitat dit disait écrit citation dijo dice escribió cita".split())
ADDRESS = frozenset("you your yours you're du dich dir dein ihr euch tu te toi ton vous votre tú ti usted vosotros".split())
CONTEXTS = ("plain", "quoted", "aimed")
FEATURES = [f"{kind}_{c}" for kind in ("exact", "misspelt") for c in CONTEXTS] + ["different", "density"]


def edits(n: int) -> int:
    """Errors allowed in a term of n letters."""
    return 0 if n < 5 else 1 if n < 10 else 2


class LexiconAutomaton:
    """Levenshtein automaton of all terms of a trie at once, made deterministic as it is used."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, str] = {}
        self.stem_at: dict[int, str] = {}
        self.allowed, self.reach = {0: 0}, {0: 0}
        for terms, at in ((words, self.word_at), (stems, self.stem_at)):
            for term in sorted(terms):
                node = 0
                for letter in term:
                    self.reach[node] = max(self.reach.get(node, 0), edits(len(term)))
                    node = self.children[node].setdefault(letter, len(self.children))
                    if node == len(self.children):
                        self.children.append({})
                self.reach[node] = max(self.reach.get(node, 0), edits(len(term)))
                at[node] = term
        self.forget()

    def forget(self) -> None:
        self.number: dict[tuple, int] = {}
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple] = []
        self.stems: list[tuple] = []
        self.states: list[tuple] = []
        self.first = self._state({0: 0})

    def _state(self, errors: dict[int, int]) -> int:
        todo = list(errors.items())
        while todo:  # letters of the term that the word leaves out
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.reach[child] and e + 1 < errors.get(child, 9):
                    errors[child] = e + 1
                    todo.append((child, e + 1))
        key = tuple(sorted((node, e) for node, e in errors.items() if e <= self.reach[node]))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            for found, at in ((self.ends, self.word_at), (self.stems, self.stem_at)):
                found.append(tuple(sorted((e, at[node]) for node, e in key if node in at and e <= edits(len(at[node])))))
        return self.number[key]

    def _step(self, state: int, letter: str) -> int:
        after: dict[int, int] = {}
        for node, e in self.states[state]:
            options = [(child, e + (c != letter)) for c, child in self.children[node].items()]
            for n, x in [*options, (node, e + 1)]:
                if x <= self.reach[n] and x < after.get(n, 9):
                    after[n] = x
        return self._state(after)

    def find(self, word: str) -> tuple[int, str, str] | None:
        """Errors, term and matched form (the word, or as much of it as a stem takes), best first; None if nothing is near."""
        state, best = self.first, None
        for k, letter in enumerate(word, 1):
            moves = self.moves[state]
            if letter not in moves:
                moves[letter] = self._step(state, letter)
            state = moves[letter]
            if not self.states[state]:
                return best
            for e, term in self.stems[state]:
                if best is None or e < best[0]:
                    best = (e, term, word[:k])
        for e, term in self.ends[state]:
            if best is None or e <= best[0]:
                best = (e, term, word)
                break
        if len(self.states) > 100_000:
            self.forget()
        return best


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    forms: dict[str, float] = field(default_factory=dict)  # misspelt forms that training texts hold
    weights: list[float] = field(default_factory=list)  # of FEATURES, and the constant
    automaton: LexiconAutomaton | None = None
    known: dict[str, tuple | None] = field(default_factory=dict)
    hits: dict[str, tuple[bool, float]] = field(default_factory=dict)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("automaton", "known", "hits")}

    def __setstate__(self, state):
        self.__init__(**state)

    def learn(self, words: set[str]) -> None:
        """Look up words not met before."""
        self.automaton = self.automaton or LexiconAutomaton(self.words, self.stems)
        if len(self.known) > KNOWN_WORDS:
            self.known, self.hits = {}, {}
        for w in words.difference(self.known):
            found = self.automaton.find(w)
            if found and w not in self.hits:
                e, term, form = found
                own = self.words.get(term, self.stems.get(term, 0.0))
                self.hits[w] = (e == 0, own if e == 0 else self.forms.get(form, own / (1 + e)))
            self.known[w] = None

    def matches(self, text: str, tokens: list[str], present: set[str]) -> list[tuple[str, str, bool, float]]:
        """word, context, exact and evidence of every match."""
        out, quoted = [], None
        for k, w in enumerate(tokens):
            if w in present:
                if quoted is None:
                    quoted = _in_quotes(text)
                around = tokens[max(0, k - AROUND):k + AROUND + 1]
                if (k < len(quoted) and quoted[k]) or not REPORTING.isdisjoint(around):
                    context = "quoted"
                else:
                    context = "aimed" if not ADDRESS.isdisjoint(around) else "plain"
                out.append((w, context, *self.hits[w]))
        return out

    def features(self, text: str) -> list[float]:
        low = text.lower()
        tokens = TOKEN.findall(low)
        different = set(tokens)
        self.learn(different)
        present = {w for w in different if w in self.hits}
        if not present:
            return [0.0] * len(FEATURES)
        sums, found = dict.fromkeys(FEATURES, 0.0), self.matches(low, tokens, present)
        for _, context, exact, evidence in found:
            sums[f"{'exact' if exact else 'misspelt'}_{context}"] += evidence
        out = [np.sign(v) * np.log1p(abs(v)) for v in sums.values()]
        positive = [m for m in found if m[3] > 0]
        out[-2:] = [np.log1p(len({m[0] for m in positive})), np.log1p(1000 * len(positive) / len(tokens))]
        return [float(x) for x in out]

    def score(self, text: str) -> float:
        z = self.weights[-1] + sum(a * b for a, b in zip(self.weights, self.features(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _in_quotes(text: str) -> list[bool]:
    """Per token, whether an odd number of quotation marks stands before it in its line and one after."""
    out = []
    for line in text.split("\n"):
        marks = [k for k, c in enumerate(line) if c in QUOTES]
        for t in TOKEN.finditer(line):
            before = int(np.searchsorted(marks, t.start()))
            out.append(before % 2 == 1 and before < len(marks))
    return out


def copy_class(tokens: list[str]) -> int:
    """The least hash of three successive words: the same for copies, nearly always for near copies of some length.

    Texts that only share a phrase agree as seldom as the phrase makes out their words.
    """
    h = word_hashes([t.encode() for t in tokens])
    for _ in range(min(3, len(h)) - 1):
        h = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + (h[:-1] >> np.uint64(29)))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return int((h ^ (h >> np.uint64(32))).min().astype(np.int64)) if len(h) else 0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, alone: labelled ids outside the held-out fold, and whether each text is the only one of its class.

    Most texts are alone and need no comparison of their words with those of others.
    """
    n, out = HELD_OUT
    known = labels.where("toxic >= 0").where(id_remainder(F.col("doc_id"), n) != out).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [copy_class(TOKEN.findall(t.as_py().lower())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64())], names=["doc_id", "class"])

    texts = docs.where(id_remainder(F.col("doc_id"), n) != out).where("text IS NOT NULL").select("doc_id", "text")
    found = texts.mapInArrow(classes, StructType([texts.schema["doc_id"], StructField("class", LongType())]))
    rows = saved(found.join(known, "doc_id"), "toxic-classes")
    single = rows.groupBy("toxic", "class").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")).where("n = 1")
    single = single.groupBy("doc_id").agg(F.count(F.lit(1)).alias("single"))
    ids = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).join(single, "doc_id", "left")
    return saved(ids.select("doc_id", "toxic", (F.coalesce("single", F.lit(0)) == F.col("n")).alias("alone")), "toxic-labelled")


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled texts outside the held-out fold as rows of three kinds:

    word, class (null), neg, pos: other and toxic texts of a batch, alone in their class, that hold the word;
    word, class, neg, pos: a class of other (neg = 1) or toxic (pos = 1) texts with one that holds the word;
    text, toxic: the sample to fit on. Rows without word and text count texts.
    """
    n, out = HELD_OUT
    # Labels grow with the corpus, so the join shuffles at every size; the comparison lets Spark put a Bloom filter of
    # the labelled ids, of bounded size, before the shuffle of texts.
    known = labelled(docs, labels).where("toxic >= 0")
    share = min(1.0, FIT_ROWS / max(1, known.count()))
    rows = docs.where(id_remainder(F.col("doc_id"), n) != out).where("text IS NOT NULL").select("doc_id", "text").join(known.hint("merge"), "doc_id")
    rows = rows.select("text", "toxic", (F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20)).alias("picked"), "alone")
    schema = pa.schema([("word", pa.string()), ("class", pa.int64()), ("neg", pa.int64()), ("pos", pa.int64()), ("text", pa.string()), ("toxic", pa.int32())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out_rows(pairs: set, texts: tuple[Counter, Counter]) -> pa.RecordBatch:
            held = list(texts[0].keys() | texts[1].keys())
            size = len(held) + len(pairs)
            return pa.RecordBatch.from_arrays([
                pa.array(held + [p[0] for p in pairs], pa.string()), pa.array([None] * len(held) + [p[1] for p in pairs], pa.int64()),
                *[pa.array([t[w] for w in held] + [int(p[2] == k) for p in pairs], pa.int64()) for k, t in enumerate(texts)],
                pa.nulls(size, pa.string()), pa.nulls(size, pa.int32())], schema=schema)

        pairs, texts = set(), (Counter(), Counter())
        for batch in batches:
            numbers, picked = [0, 0], []
            for text, toxic, pick, alone in zip(batch.column(0), *(c.to_pylist() for c in batch.columns[1:])):
                text = text.as_py()
                tokens = TOKEN.findall(text.lower())
                numbers[bool(toxic)] += 1
                if alone:
                    texts[bool(toxic)].update(set(tokens))
                else:
                    key = copy_class(tokens)
                    pairs.update((w, key, int(bool(toxic))) for w in set(tokens))
                if pick:
                    picked.append((text, int(bool(toxic))))
                if len(pairs) + len(texts[0]) + len(texts[1]) > HELD_WORDS:
                    yield out_rows(pairs, texts)
                    pairs, texts = set(), (Counter(), Counter())
            size = 1 + len(picked)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(size, pa.string()), pa.nulls(size, pa.string()), *[pa.array([v] + [0] * len(picked), pa.int64()) for v in numbers],
                pa.array([None] + [t for t, _ in picked], pa.string()), pa.array([None] + [x for _, x in picked], pa.int32())], schema=schema)
        yield out_rows(pairs, texts)

    return saved(rows.mapInArrow(count, "word string, class long, neg long, pos long, text string, toxic int"), "toxic-counts")


def vocabulary(counts: DataFrame) -> DataFrame:
    """word, pos, neg: classes of toxic and of other texts with one that holds it."""
    rows = counts.where("word IS NOT NULL").select("word", "class", "neg", "pos")
    shared = rows.where("class IS NOT NULL").distinct()
    return rows.where("class IS NULL").unionByName(shared).groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def lexicon(good: DataFrame) -> DataFrame:
    """word, pos, neg, stem: of the words and stems in `good`, with chance, those that say the same as no other.

    Of stems that continue one another the one with the clearest excess stays, the longer one among equals; a stem that
    owes half of its uses to one word is that word, and a word that a stem covers is left to it. All of these begin with
    the same letters, so groups of the shortest stem's letters decide it, and every term that passed is looked at.
    """
    def resolve(rows: pa.Table) -> pa.Table:
        found = rows.to_pylist()
        most: dict[str, int] = {}
        for r in found:
            if not r["stem"]:
                for k in STEMS:
                    most[r["word"][:k]] = max(most.get(r["word"][:k], 0), r["pos"])
        # beginnings: those of kept stems, themselves among them
        stems_kept: set[str] = set()
        beginnings: set[str] = set()
        out = []
        for r in sorted((r for r in found if r["stem"]), key=lambda r: (r["chance"], -len(r["word"]), r["word"])):
            s = r["word"]
            nested = s in beginnings or any(s[:k] in stems_kept for k in STEMS)
            if not nested and most.get(s, 0) < 0.5 * r["pos"]:
                stems_kept.add(s)
                beginnings.update(s[:k] for k in STEMS)
                out.append(r)
        out += [r for r in found if not r["stem"] and not any(r["word"][:k] in stems_kept for k in STEMS)]
        return pa.Table.from_pylist(out, rows.schema).select(["word", "pos", "neg", "stem"])

    rows = good.select("word", "pos", "neg", "stem", "chance")
    return rows.groupBy(F.substring("word", 1, STEMS.start)).applyInArrow(resolve, "word string, pos long, neg long, stem boolean")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model; what is counted for it is deleted again."""
    with scratch(docs.sparkSession):
        return _fit(docs, labels)


def _fit(docs: DataFrame, labels: DataFrame) -> Model:
    counts = counted(docs, labels)
    n_pos, n_neg = counts.where("word IS NULL AND text IS NULL").agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    if not n_pos or not n_neg:
        return Model(weights=[0.0] * len(FEATURES) + [-30.0])
    vocab = saved(vocabulary(counts), "toxic-vocabulary")
    uses, rest, n_words = vocab.agg(F.sum("pos"), F.sum("neg"), F.count(F.lit(1))).first()
    rate = uses / (uses + rest)
    stems = vocab.where(F.length("word") > 1).select(F.explode(F.expr(
        f"transform(sequence({STEMS.start}, {STEMS.stop - 1}), k -> IF(length(word) > k, substring(word, 1, k), NULL))")).alias("word"), "pos", "neg")
    stems = stems.where("word IS NOT NULL").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # `chance`: Chernoff's bound of the log probability of so many toxic uses, or more, at the overall rate.
    either = vocab.withColumn("stem", F.lit(False)).unionByName(stems.withColumn("stem", F.lit(True)))
    share = F.least(F.col("pos") / (F.col("pos") + F.col("neg")), F.lit(1 - 1e-12))
    gain = share * F.log(share / rate) + (1 - share) * F.log((1 - share) / (1 - rate))
    limit = float(np.log(ALPHA / max(1, n_words)))
    good = either.where((F.length("word") >= 3) & (share > LEAST_SHARE)).withColumn("chance", -(F.col("pos") + F.col("neg")) * gain).where(F.col("chance") < limit)
    kept = lexicon(good).collect()
    evidence = lambda pos, neg: float(np.log((pos + 0.5) / (uses + 1)) - np.log((neg + 0.5) / (rest + 1)))
    words, stems_kept = ({r["word"]: evidence(r["pos"], r["neg"]) for r in kept if r["stem"] == s} for s in (False, True))
    model = Model(words, stems_kept, weights=[0.0] * (len(FEATURES) + 1))
    model.forms = _seen_forms(vocab, model, evidence)
    model.weights = _fit_weights(counts.where("text IS NOT NULL").select("text", "toxic"), model)
    return model


def _seen_forms(vocab: DataFrame, model: Model, evidence) -> dict[str, float]:
    """Evidence of the misspelt forms in the training vocabulary; their number is bounded by lexicon and edits."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(model.words, model.stems)
        for batch in batches:
            rows = [(found[2], pos, neg) for w, pos, neg in zip(*(c.to_pylist() for c in batch.columns)) if (found := automaton.find(w)) and found[0]]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), *[pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2)]], names=["form", "pos", "neg"])

    found = vocab.select("word", "pos", "neg").mapInArrow(find, "form string, pos long, neg long")
    return {r["form"]: evidence(r["pos"], r["neg"]) for r in found.groupBy("form").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()}


def _fit_weights(rows: DataFrame, model: Model) -> list[float]:
    """Logistic regression with a small penalty, by Newton steps, on the sampled texts."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([model.features(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    data = rows.mapInArrow(features, "x array<double>, toxic int").collect()
    x = np.array([[*r["x"], 1.0] for r in data])
    y = np.array([r["toxic"] for r in data], float)
    order = np.lexsort(np.column_stack([x, y]).T)
    x, y, w = x[order], y[order], np.zeros(x.shape[1])
    penalty = np.diag([0.05] * (len(w) - 1) + [1e-6])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with score and predicted, which take the place of columns of these names.

    Every task is sent the whole model: all terms that passed, and their misspelt forms in training texts.
    """
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    path = text.split(".")

    def _at(batch: pa.RecordBatch) -> pa.Array:
        """The text column, or the field of that name in a column of structs."""
        column = batch.column(names.index(path[0]))
        return column.field(path[1]) if len(path) > 1 else column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text.as_py() or "") for text in _at(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "_score"])

    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    out = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("_score", DoubleType())]))
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)], F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, with the columns of `docs`."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]).alias("row"))
    kept = score(rows, fit(docs, labels), f"row.c{names.index('text')}").where("predicted = 0")
    return kept.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(names)])


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    n, out = HELD_OUT
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), n) == out).alias("held_out"), "score", "predicted")
