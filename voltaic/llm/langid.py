"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; runs of characters that are no letters become one space.
Each order's n-grams are hashed to a fixed number of buckets; a language's
bucket counts give smoothed log probabilities, a ``buckets x languages`` matrix
of fixed size that is broadcast. A batch of texts is scored at once: one hash
per position, one gather per language, one segmented sum per text.

Fitting uses at most ``sample_docs`` labelled documents (about that many when
there are more, chosen by a hash of the id); everything else covers all rows.
Null texts, empty texts and texts without a letter get ``und`` and score 0.
Repeated rows get the same result; a tie goes to the language that sorts first.
With no labelled document at all, every text is ``und``.
"""
from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import DOUBLE, STRING, in_sample, map_text, ship, slices

#: Prediction for texts without letters.
UNDETERMINED = "und"
#: More distinct labels than this are refused: the matrix must stay small enough to broadcast.
MAX_LANGUAGES = 256


@dataclass
class Model:
    """Log probabilities by language and bucket; ``languages`` in sorted order."""

    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray
    orders: tuple[int, ...]
    bits: int


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)], bool)


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and single spaces of all texts as code points, the text index of each, letters by text."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    letter = _letters()[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    letter[high] = [chr(c).isalpha() for c in codes[high]]
    kept = letter.copy()
    kept[1:] |= letter[:-1] & (doc[1:] == doc[:-1])
    codes = np.where(letter, codes, np.uint32(32))[kept]
    return codes, doc[kept], np.bincount(doc[letter], minlength=len(texts))


def _buckets(codes: np.ndarray, doc: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram that lies within one text, and its text index."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    h = np.full(n, order, np.uint32)
    for k in range(order):
        h = (h ^ codes[k : k + n]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    h = (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits)
    within = doc[:n] == doc[order - 1 :]
    return h[within], doc[:n][within]


def _count_setup(lang_index: int, text_index: int, orders: tuple[int, ...], bits: int, batches):
    """Per task: n-gram counts by language and bucket."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for part in slices(batch, text_index):
            langs = part.column(lang_index).to_pylist()
            codes, doc, _ = _codes(part.column(text_index).to_pylist())
            names = sorted(set(langs))
            of_doc = np.searchsorted(names, langs)
            for i, name in enumerate(names):
                counts.setdefault(name, np.zeros(1 << bits, np.int64))
                docs[name] = docs.get(name, 0) + int((of_doc == i).sum())
            for order in orders:
                bucket, at = _buckets(codes, doc, order, bits)
                own = of_doc[at]
                for i, name in enumerate(names):
                    counts[name] += np.bincount(bucket[own == i], minlength=1 << bits)
    for name, own in counts.items():
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name] * (len(used) + 1), pa.string()),
                pa.array(np.append(used, -1), pa.int64()),
                pa.array(np.append(own[used], docs[name]), pa.int64()),
            ],
            names=["lang", "bucket", "n"],
        )


def fit(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    orders: tuple[int, ...] = (1, 2, 3, 4),
    bits: int = 16,
    sample_docs: int = 20_000,
    smoothing: float = 0.5,
) -> Model:
    """Fit on the rows of ``docs`` with text and language (a sample of about ``sample_docs`` of them)."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("text is not null and lang is not null")
    languages = [r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} distinct labels")
    share = sample_docs / max(1, rows.count())
    if share < 1:
        rows = rows.where(in_sample(share, F.lit("langid"), "id"))
    run = functools.partial(_count_setup, 1, 0, tuple(orders), bits)
    counted = rows.select("text", "lang").mapInArrow(run, "lang string, bucket long, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang, bucket, n = (table.column(c).to_numpy() for c in ("lang", "bucket", "n"))
    names = sorted(set(lang.tolist()))
    counts = np.zeros((len(names), 1 << bits))
    prior = np.ones(len(names))
    row = np.searchsorted(names, lang.tolist()) if len(names) else np.zeros(0, int)
    gram = bucket >= 0
    counts[row[gram], bucket[gram]] = n[gram]
    prior[row[~gram]] = n[~gram]
    log_prob = np.log(counts + smoothing) - np.log(counts.sum(axis=1, keepdims=True) + smoothing * (1 << bits))
    return Model(names, np.log(prior / prior.sum()), log_prob.astype(np.float32), tuple(orders), bits)


def score_texts(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score (0 to 1) of each text.

    The score is the posterior with the evidence scaled to at most 100 n-grams,
    as neighbouring n-grams are not independent.
    """
    codes, doc, letters = _codes(texts)
    total = np.tile(model.log_prior, (len(texts), 1)) if model.languages else np.zeros((len(texts), 0))
    grams = np.zeros(len(texts))
    for order in model.orders if model.languages else ():
        bucket, at = _buckets(codes, doc, order, model.bits)
        if not len(at):
            continue
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        own = at[starts]
        grams[own] += np.diff(np.append(starts, len(at)))
        for k in range(len(model.languages)):
            total[own, k] += np.add.reduceat(model.log_prob[k][bucket], starts, dtype=np.float64)
    known = (letters > 0) & (len(model.languages) > 0)
    if not model.languages:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    best = total.argmax(axis=1)
    scaled = (total - total.max(axis=1, keepdims=True)) * np.minimum(1, 100 / np.maximum(grams, 1))[:, None]
    posterior = 1 / np.exp(scaled).sum(axis=1)
    langs = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
    return langs, np.where(known, posterior, 0.0).tolist()


def _score_setup(model):
    own = model.value
    return lambda texts: list(score_texts(own, texts))


def predict(
    docs: DataFrame, model: Model, *, text_col: str = "text", least: float | None = None, keep_text: bool = True
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; input columns of these names are replaced.

    With ``least``, only rows of a determined language with that score or more
    stay; ``keep_text=False`` leaves out the texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    where = None
    if least is not None:
        where = lambda langs, scores: [c != UNDETERMINED and s >= least for c, s in zip(langs, scores, strict=True)]
    columns = {"lang_pred": STRING, "score": DOUBLE}
    return map_text(docs, text_col, columns, functools.partial(_score_setup, shared), keep_text, where)
