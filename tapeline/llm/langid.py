"""Language identification as mixture inference: expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm._shared import chunks, rows

#: n-grams are this many bytes of the lower-cased text, everything but letters turned into single spaces.
GRAM = 3
#: Hash cells of n-grams.
CELLS = 1 << 15
#: Labelled rows that a model is fitted on, about: a hash of doc_id draws them where there are more.
TRAIN_ROWS = 60_000
#: Share of a language's probability that is spread evenly over all cells.
SMOOTHING = 0.01
STEPS = 25
#: Languages, each of which adds a column to the model that every task holds; more of them are an error.
MAX_LANGUAGES = 500
#: Log-likelihood that a language must add for each halving of its standard error: one parameter's share of the BIC, times
#: the bytes of an n-gram, as neighbouring n-grams overlap and are not independent.
PENALTY = 0.5 * GRAM

SPACES = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def cells(text: str | None) -> np.ndarray:
    """Hash cells of all n-grams of a whole text; empty if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return np.empty(0, np.int64)
    raw = b" ".join(text.lower().encode().translate(SPACES).split())
    a = np.frombuffer(b" %s " % raw, np.uint8).astype(np.uint32)
    if len(a) < GRAM:
        return np.empty(0, np.int64)
    key = np.zeros(len(a) - GRAM + 1, np.uint32)
    for j in range(GRAM):
        key = (key << np.uint32(8)) | a[j : len(a) - GRAM + 1 + j]
    return ((key * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Languages in order, and for each cell its probability in each language and, last, in none of them."""

    languages: tuple[str, ...]
    p: np.ndarray


@dataclass(frozen=True)
class Guess:
    language: str
    score: float
    mixture: dict[str, float]
    unknown: float


NOTHING = Guess("und", 0.0, {}, 1.0)


def _em(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the columns of p that make the counts n likeliest, and the log-likelihood."""
    share = np.full(p.shape[1], 1.0 / p.shape[1])
    total = n.sum()
    for _ in range(STEPS):
        joint = p * share
        new = (joint * (n / joint.sum(1))[:, None]).sum(0) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(n @ np.log(p @ share))


def infer(model: Model, text: str | None) -> Guess:
    """The language set that penalised likelihood selects, with proportions; ``und`` without a letter or a language."""
    grams = cells(text)
    if not len(grams) or not model.languages:
        return NOTHING
    at, n = np.unique(grams, return_counts=True)
    n = n.astype(np.float64)
    p = model.p[at]
    last = p.shape[1] - 1
    share, _ = _em(p, n)
    order = np.argsort(-share[:last], kind="stable")
    cost = PENALTY * np.log(n.sum())
    best, held = None, -np.inf
    for size in range(1, last + 1):
        chosen = [*order[:size], last]
        own, fit = _em(p[:, chosen], n)
        fit -= cost * size
        if fit <= held:
            break
        held, best = fit, (chosen, own)
    chosen, own = best
    mixture = {model.languages[i]: float(s) for i, s in zip(chosen[:-1], own[:-1], strict=True)}
    top = max(mixture, key=lambda k: (mixture[k], k))
    return Guess(top, min(1.0, max(0.0, mixture[top])), mixture, float(own[-1]))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language and cell, summed over the whole task: a row for each pair at most."""
    sums: dict[str, np.ndarray] = {}
    for texts, languages in chunks(batches, "text", "lang"):
        for raw, lang in zip(texts, languages, strict=True):
            own = sums.setdefault(lang.decode(), np.zeros(CELLS, np.int64))
            own += np.bincount(cells(raw.decode()), minlength=CELLS)
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["lang", "cell", "n"])


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from ``labelled(doc_id, text, lang)``; rows without text or lang are left out, other columns ignored.

    The driver gets a sum for each language and cell, so its size depends on the number of languages only.
    """
    known = labelled.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = [r["count"] for r in known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()]
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values")
    share = min(1.0, train_rows / max(1, sum(counts)))
    drawn = known.where(F.pmod(F.xxhash64("doc_id", "text", F.lit("train")), F.lit(1_000_000)) / 1e6 < share)
    sums = drawn.select("text", "lang").mapInArrow(_counts, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(sums["lang"].unique()))
    # a text of no known language draws its n-grams evenly from all cells
    p = np.full((CELLS, len(languages) + 1), 1.0 / CELLS)
    p[:, :-1] *= SMOOTHING
    for i, lang in enumerate(languages):
        own = sums[sums["lang"] == lang]
        p[own["cell"].to_numpy(), i] += (1 - SMOOTHING) * own["n"].to_numpy() / own["n"].sum()
    return Model(languages, p)


def _infer(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    model = held.value
    for ids, texts in chunks(batches, "doc_id", "text"):
        out = [infer(model, None if t is None else t.decode()) for t in texts]
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([g.language for g in out]), pa.array([g.score for g in out]),
            pa.array([list(g.mixture.items()) for g in out], pa.map_(pa.string(), pa.float64())), pa.array([g.unknown for g in out]),
        ], names=["doc_id", "lang_pred", "score", "mixture", "unknown"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score, mixture, unknown)`` for each row of ``docs(doc_id, text)``.

    ``mixture`` has the proportions of the selected languages, ``unknown`` that of n-grams of no language; ``score`` is the
    predicted language's proportion. Null texts and texts without a letter are ``und`` with score 0. Ties go to the later
    name. Other columns are ignored; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # cells times languages
    return docs.select("doc_id", "text").mapInArrow(lambda it: _infer(it, held), "doc_id bigint, lang_pred string, score double, mixture map<string,double>, unknown double")


def _known(batches: Iterator[pa.RecordBatch], held, max_unknown: float) -> Iterator[pa.RecordBatch]:
    model = held.value
    for part in rows(batches):
        found = [infer(model, t) for t in part.column("text").to_pylist()]
        yield part.filter(pa.array([g.language != "und" and g.unknown <= max_unknown for g in found], pa.bool_()))


def known_language(docs: DataFrame, model: Model, max_unknown: float = 0.5) -> DataFrame:
    """``docs`` without texts of no language: without a letter, or with over ``max_unknown`` of their n-grams of none.

    Rows pass with all their columns, without a shuffle.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # cells times languages
    return docs.mapInArrow(lambda it: _known(it, held, max_unknown), docs.schema)
