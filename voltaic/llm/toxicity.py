"""Toxicity: a learned weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, applies compatibility forms, maps homoglyphs and digit or
sign substitutions to Latin letters, drops invisible characters and turns the
rest into single spaces. Lexicon entries are whole words or word beginnings,
weighted by their smoothed log odds between toxic and clean documents. One
automaton holds entries and exception phrases; a match inside an exception
phrase does not count. The summed weight and the weight per 1000 words go
through a logistic curve, which gives the score.

Fitting uses at most about ``sample_docs`` labelled documents (chosen by a hash
of the id, exact repeats once) and at most ``max_entries`` entries. Scoring covers every whole text. Null and empty
texts have no match and get the score of weight 0. Rows are scored one by one,
so repeats, ties and further columns make no difference.
"""
from __future__ import annotations

import bisect
import functools
import itertools
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import DOUBLE, LONG, STRINGS, Scratch, in_sample, map_text, ship, slices

#: Letters that look like Latin ones (Cyrillic, then Greek).
HOMOGLYPHS = dict(zip("аеорсухіѕјкмтнв", "aeopcyxisjkmthb", strict=True)) | dict(
    zip("αειοκντυρ", "aeiokvtup", strict=True)
)
#: Digits and signs written for letters.
SUBSTITUTES = dict(zip("01345789@$", "oieastbgas", strict=True))
#: Lengths of word beginnings that may enter the lexicon.
PREFIXES = range(3, 9)


class _Fold(dict):
    """Folded form of a character, worked out on first use."""

    def __missing__(self, code: int) -> str:
        out = ""
        for ch in unicodedata.normalize("NFKC", chr(code)).lower():
            ch = SUBSTITUTES.get(ch, HOMOGLYPHS.get(ch, ch))
            if unicodedata.category(ch) != "Cf":
                out += ch if ch.isalnum() or unicodedata.category(ch)[0] == "M" else " "
        self[code] = out
        return out


_FOLD = _Fold()


def fold(text: str | None) -> list[str]:
    """Words of the folded text."""
    return text.translate(_FOLD).split() if text else []


@dataclass
class Model:
    """Entries (``" word "`` or the beginning ``" wor"``) with weights, exception phrases, curve."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)


class Matcher:
    """Automaton of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        for entry, weight in model.entries.items():
            self.automaton.add_word(entry, (entry, weight))
        for phrase in model.exceptions:
            key = " " + " ".join(fold(phrase)) + " "
            self.automaton.add_word(key, (key, None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, words: list[str]) -> list[tuple[int, str, float]]:
        """Start, entry and weight of each match that no exception phrase covers."""
        if not len(self.automaton) or not words:
            return []
        found, spared = [], []
        for end, (entry, weight) in self.automaton.iter(" " + " ".join(words) + " "):
            start = end - len(entry) + 1
            if weight is None:
                spared.append((start, end))
            else:
                found.append((start, end, entry, weight))
        if spared:
            # Of the phrases that begin at or before a match, the one that reaches furthest decides.
            spared.sort()
            begins = [a for a, _ in spared]
            reach = list(itertools.accumulate((b for _, b in spared), max))
            at = [bisect.bisect_right(begins, match[0]) - 1 for match in found]
            found = [match for match, k in zip(found, at, strict=True) if k < 0 or reach[k] < match[1]]
        return [(start, entry, weight) for start, _, entry, weight in found]

    def measure(self, words: list[str]) -> tuple[float, list[tuple[int, str, float]]]:
        """Summed weight, the strongest match of each word counting once."""
        best: dict[int, float] = {}
        hits = self.hits(words)
        for start, _, weight in hits:
            best[start] = max(weight, best.get(start, 0.0))
        return sum(best.values()), hits


def _features(weight: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(weight), np.log1p(weight), np.log1p(1000 * weight / np.maximum(n_words, 1))], axis=1)


def _word_features(words: list[str]) -> set[str]:
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in PREFIXES if k < len(w))
    return out


def _count_features(allowed, batches):
    """Per task: documents that hold each feature (of ``allowed``, if given)."""
    allowed = allowed and allowed.value
    counts: Counter = Counter()
    for batch in batches:
        for part in slices(batch, 0):
            for text in part.column(0).to_pylist():
                own = _word_features(fold(text))
                counts.update(own if allowed is None else own & allowed)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"]
    )


def _list_features(candidates, batches):
    """Indices of the candidate features in each document."""
    index = candidates.value
    for batch in batches:
        out = [
            sorted(index[f] for f in _word_features(fold(t)) if f in index)
            for part in slices(batch, 0)
            for t in part.column(0).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], names=["features"])


def _neighbours(line: str, start: int) -> list[str]:
    """The word after the space at ``start`` with the word before it, and with the word after it."""
    stop = line.index(" ", start + 1)
    out = []
    if start:
        out.append(line[line.rindex(" ", 0, start) + 1 : stop])
    if stop < len(line) - 1:
        out.append(line[start + 1 : line.index(" ", stop + 1)])
    return out


def _measure(model, batches):
    matcher = Matcher(model.value)
    for batch in batches:
        for part in slices(batch, 0):
            out = []
            for text in part.column(0).to_pylist():
                words = fold(text)
                weight, hits = matcher.measure(words)
                line = " " + " ".join(words) + " "
                around = set()
                for start, _, _ in hits:
                    around.update(_neighbours(line, start))
                out.append((weight, len(words), sorted(around)))
            weights, lengths, arounds = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array(weights, pa.float64()), pa.array(lengths, pa.int64()),
                 pa.array(arounds, pa.list_(pa.string()))],
                names=["toxic", "weight", "n_words", "around"],
            )


def _cover(rows: list[list[int]], weights: np.ndarray, names: list[str], min_docs: int, most: int, times: int = 3):
    """Greedy choice of features: each pick has the most weight over documents held by under ``times`` picks.

    Of equal ones the longest is taken; beginnings and continuations of a pick are left out.
    """
    lengths = np.array([len(n) for n in names], float)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.fromiter((f for r in rows for f in r), np.int64, len(doc))
    held = np.zeros(len(rows), np.int64)
    picked: list[int] = []
    open_ = np.ones(len(names), bool)
    while len(picked) < most:
        count = np.bincount(feature[held[doc] < times], minlength=len(weights))
        gain = np.where((count >= min_docs) & open_, count * weights + 1e-3 * lengths, 0)
        if not len(gain) or gain.max() <= 0:
            break
        picked.append(int(gain.argmax()))
        own = names[picked[-1]]
        open_ &= np.array([not (n.startswith(own) or own.startswith(n)) for n in names])
        held[doc[feature == picked[-1]]] += 1
    return picked


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 40) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - ridge * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_docs: int = 20_000,
    min_docs: int = 3,
    min_share: float = 0.002,
    min_weight: float = 3.5,
    max_entries: int = 2_000,
    exceptions: tuple[str, ...] = (),
) -> Model:
    """Fit lexicon, exceptions and curve on labelled documents.

    An entry must occur in ``min_docs`` toxic documents of the sample and in
    ``min_share`` of them, and have log odds of ``min_weight``. Phrases around a
    match that occur in as many clean documents and in no toxic one join the
    given ``exceptions``.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where("id is not null and toxic in (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = sample_docs / max(1, known.count())
    if share < 1:
        known = known.where(in_sample(share, F.lit("toxicity"), "id"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    sample = rows.join(known, "id").groupBy(F.xxhash64("text").alias("h")).agg(
        F.max(F.struct("toxic", "text")).alias("r")
    ).select("r.text", "r.toxic")
    scratch = Scratch(spark, "toxicity")
    sample = scratch.store(sample, "sample")
    try:
        totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
        n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
        if not n_toxic or not n_clean:
            return Model({}, exceptions, (4.0 if n_toxic else -4.0, 0.0, 0.0))
        min_docs = max(min_docs, int(np.ceil(min_share * n_toxic)))

        def counted(label: int, allowed=None) -> dict[str, int]:
            got = sample.where(F.col("toxic") == label).select("text")
            got = got.mapInArrow(functools.partial(_count_features, allowed), "feature string, n long")
            got = got.groupBy("feature").agg(F.sum("n").alias("n"))
            table = got.where(F.col("n") >= (min_docs if allowed is None else 1)).toArrow()
            return dict(zip(table.column("feature").to_pylist(), table.column("n").to_pylist(), strict=True))

        toxic = counted(1)
        clean = counted(0, spark.sparkContext.broadcast(set(toxic)))
        odds = {
            f: float(np.log((n + 0.5) / (n_toxic + 1)) - np.log((clean.get(f, 0) + 0.5) / (n_clean + 1)))
            for f, n in toxic.items()
        }
        names = sorted(f for f, w in odds.items() if w >= min_weight)
        index = spark.sparkContext.broadcast({f: i for i, f in enumerate(names)})
        held = sample.where("toxic = 1").select("text").mapInArrow(
            functools.partial(_list_features, index), "features array<int>"
        )
        lists = held.toArrow().column(0).to_pylist()
        weights = np.array([odds[f] for f in names])
        picked = _cover(lists, weights, names, min_docs, max_entries)
        model = Model({names[i]: odds[names[i]] for i in picked}, exceptions)

        schema = "toxic int, weight double, n_words long, around array<string>"

        def measured(model: Model) -> DataFrame:
            shared = spark.sparkContext.broadcast(model)
            return sample.select("text", "toxic").mapInArrow(functools.partial(_measure, shared), schema)

        around = measured(model).select("toxic", F.explode("around").alias("phrase")).groupBy("phrase").agg(
            F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")
        )
        learned = [r[0] for r in around.where(f"toxic = 0 and clean >= {min_docs}").collect()]
        model.exceptions = tuple(sorted({*exceptions, *learned}))
        table = measured(model).select("toxic", "weight", "n_words").toArrow()
        toxic_col, weight, n_words = (table.column(c).to_numpy().astype(float) for c in ("toxic", "weight", "n_words"))
        model.curve = tuple(float(b) for b in _logistic(_features(weight, n_words), toxic_col))
        return model
    finally:
        scratch.drop(sample)


def _score_setup(model):
    matcher = Matcher(model.value)
    curve = np.array(model.value.curve)

    def fn(texts: list) -> list:
        split = [fold(t) for t in texts]
        measured = [matcher.measure(w) for w in split]
        x = _features(np.array([m[0] for m in measured], float), np.array([len(w) for w in split], float))
        score = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        matches = [sorted({entry.strip() for _, entry, _ in m[1]}) for m in measured]
        return [score.tolist(), [len(m[1]) for m in measured], matches]

    return fn


def score(
    docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.7, drop: bool = False, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``n_hits``, ``hits`` (matched entries) and ``predicted`` (score >= threshold).

    Input columns of these names are replaced. ``drop`` leaves out the rows
    predicted toxic, ``keep_text=False`` the texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "predicted"])
    columns = {"score": DOUBLE, "n_hits": LONG, "hits": STRINGS}
    where = (lambda scores, *_: [s < threshold for s in scores]) if drop else None
    out = map_text(docs, text_col, columns, functools.partial(_score_setup, shared), keep_text, where)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
