"""Language identification by hierarchical discrimination.

A text becomes counts of the byte 1-, 2- and 3-grams of its lower-cased letters, hashed to `DIMS` places, square
roots taken, scaled to length 1. Languages belong to families; a linear support vector machine for every pair of
families picks the family, then one for every pair of its languages picks the language (votes are the machines'
calibrated probabilities). Each machine is trained in a task of its own, on a bounded sample of labelled texts:
about `PER_LANGUAGE` texts of each language, drawn by the hash of the text.

Defined cases: null texts and texts without a letter are `und` with score 0; without labelled texts all are; with
one learnt language it is the answer, with score 1; a language outside the table of families is a family of its
own; null labels teach nothing; rows repeated with one doc_id are each judged; other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import clean_text, id_remainder, saved, table

HELD_OUT = (4, 2)
DIMS = 1 << 12
PER_LANGUAGE = 1_000
UNKNOWN = "und"
#: Weight of the hinge loss against the squared norm.
COST = 4.0

# Language families of ISO 639-1 codes.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "turkic": "tr az kk uz ky tk",
    "semitic": "ar he mt am",
    "indic": "hi ur bn pa mr gu ne si",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

#: ASCII bytes that are no letters become spaces.
LETTERS = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def family(lang: str) -> str:
    return FAMILY_OF.get(lang, lang)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def features(text: str) -> np.ndarray:
    b = np.frombuffer((" " + " ".join(text.lower().encode().translate(LETTERS).decode().split()) + " ").encode(), np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(31) + b[1:]
    three = two[:-1] * np.uint32(131) + b[2:]
    ids = np.concatenate((b, two * np.uint32(0x9E3779B1) >> np.uint32(20), three * np.uint32(0x85EBCA77) >> np.uint32(20)))
    x = np.sqrt(np.bincount(ids, minlength=DIMS).astype(np.float32))
    return x / np.linalg.norm(x)


@dataclass
class Machine:
    """Says how likely `yes` is rather than `no`."""

    level: str
    yes: str
    no: str
    weights: np.ndarray
    bias: float
    slope: float

    def probability(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * (x @ self.weights + self.bias), -30, 30))))


def train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights, bias and slope of the probability: dual coordinate descent on the hinge loss, classes weighted alike."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    cost = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum()))) * COST
    w, alpha, norms, rng = np.zeros(x.shape[1]), np.zeros(len(x)), np.einsum("ij,ij->i", x, x), np.random.default_rng(7)
    for _ in range(20):
        moved = 0.0
        for k in rng.permutation(len(x)):
            gradient = y[k] * (x[k] @ w) - 1
            to = min(max(alpha[k] - gradient / norms[k], 0.0), cost[k])
            if to != alpha[k]:
                w += (to - alpha[k]) * y[k] * x[k]
                moved = max(moved, abs(to - alpha[k]))
                alpha[k] = to
        if moved < 1e-3:
            break
    margin, slope = y * (x @ w), 1.0
    for _ in range(30):  # slope of the logistic curve over the margins
        p = 1 / (1 + np.exp(np.clip(slope * margin, -30, 30)))
        slope = float(np.clip(slope + (margin @ p - 0.01 * slope) / (margin**2 @ (p * (1 - p)) + 0.01), 0.5, 20))
    return w[:-1].astype(np.float32), float(w[-1]), slope


def training_rows(docs: DataFrame, lang: Column) -> DataFrame:
    """x, lang of the sample, written to the shared folder."""
    n, out = HELD_OUT
    rows = docs.where((id_remainder(F.col("doc_id"), n) != out) & F.col("text").isNotNull() & lang.isNotNull()).select("text", lang.alias("lang"))
    drawn = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one number per language
    # The shares are part of the filter: texts are drawn where they are read, and only the sample goes any further.
    share = F.create_map(*[F.lit(v) for lang, n_ in counts.items() for v in (lang, PER_LANGUAGE / n_)])[F.col("lang")] if counts else F.lit(0.0)
    sample = rows.where(drawn < share)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [(features(t).tobytes(), lang) for t, lang in zip(*(c.to_pylist() for c in batch.columns)) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in keep], kind) for j, kind in enumerate((pa.binary(), pa.string()))], names=["x", "lang"])

    return saved(sample.mapInArrow(make, "x binary, lang string"), "languages")


def fit(docs: DataFrame, lang: Column | None = None) -> tuple[list[str], list[Machine]]:
    """Learnt languages and their machines; both are bounded by the number of languages."""
    spark, rows = docs.sparkSession, training_rows(docs, F.col("lang") if lang is None else lang)
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    families = sorted({family(x) for x in langs})
    pairs = [("family", a, b) for a, b in combinations(families, 2)]
    pairs += [("language", a, b) for a, b in combinations(langs, 2) if family(a) == family(b)]
    if not pairs:
        return langs, []
    sides = [(k, x, side) for k, (level, a, b) in enumerate(pairs) for side, name in ((1, a), (-1, b)) for x in langs if (family(x) if level == "family" else x) == name]
    plan = spark.createDataFrame(sides, "pair int, lang string, side int")

    def one(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x = np.vstack([np.frombuffer(v, np.float32) for v in part["x"]])
        order = np.lexsort((part["x"].map(hash), part["lang"]))
        w, bias, slope = train(x[order], part["side"].to_numpy(float)[order])
        return pd.DataFrame({"pair": [key[0]], "w": [w.tobytes()], "bias": [bias], "slope": [slope]})

    found = rows.join(plan, "lang").groupBy("pair").applyInPandas(one, "pair int, w binary, bias double, slope double").collect()
    return langs, [Machine(*pairs[r["pair"]], np.frombuffer(r["w"], np.float32), r["bias"], r["slope"]) for r in sorted(found, key=lambda r: r["pair"])]


def vote(options: list[str], machines: list[Machine], x: np.ndarray) -> tuple[str, float]:
    """The option with the highest mean probability over its machines, and its share of those means."""
    if len(options) == 1:
        return options[0], 1.0
    total = dict.fromkeys(options, 0.0)
    for m in machines:
        p = m.probability(x)
        total[m.yes] += p
        total[m.no] += 1 - p
    best = max(options, key=lambda o: (total[o], o))
    return best, total[best] / (len(options) - 1)


def predict(text: str | None, langs: list[str], machines: list[Machine]) -> tuple[str, float]:
    if not langs or not has_letter(text):
        return UNKNOWN, 0.0
    x = features(text)
    chosen, sure = vote(sorted({family(x) for x in langs}), [m for m in machines if m.level == "family"], x)
    inside = [o for o in langs if family(o) == chosen]
    lang, surer = vote(inside, [m for m in machines if m.level == "language" and m.yes in inside], x)
    return lang, sure * surer


def identify(docs: DataFrame, langs: list[str], machines: list[Machine]) -> DataFrame:
    """doc_id, lang_pred, score of every row of `docs`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict(t, langs, machines) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text(F.col("text")).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    n, out = HELD_OUT
    found = identify(docs, *fit(docs))
    return found.select("doc_id", (id_remainder(F.col("doc_id"), n) == out).alias("held_out"), "lang_pred", "score")
