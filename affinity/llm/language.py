"""Language identification by multilingual mixture inference.

A document is a mixture of languages. Each language is a distribution over hashed byte
trigrams, counted on all training rows. Expectation-maximisation estimates a document's
language shares; languages leave the mixture while the penalised likelihood improves, and
the largest remaining share names the document.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import in_arrow

BUCKETS = 1 << 16
SMOOTHING = 0.5
PENALTY = 3.0  # log-likelihood a further language must gain, times log(trigrams)
TOLERANCE = 1e-3  # EM ends when no share moves further in a step
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = regex.compile(r"[^\p{L}]+")


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the UTF-8 bytes of the lower-cased letters, words apart by one
    space. The whole text counts."""
    b = np.frombuffer((" " + _NOT_LETTERS.sub(" ", text.lower()) + " ").encode(), dtype=np.uint8).astype(np.uint32)
    g = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return (g * np.uint32(2654435761)) >> np.uint32(16)


def _count(batches):
    totals = defaultdict(lambda: np.zeros(BUCKETS, dtype=np.int64))
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            totals[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
            names=["lang", "gram", "n"],
        )


class Model:
    """Per language the smoothed probability of every trigram bucket."""

    def __init__(self, langs: list[str], prob: np.ndarray):
        self.langs, self.prob = langs, prob


def fit(training: DataFrame) -> Model:
    """Counts (lang, trigram) over all rows of `training` (text, lang) with both present.
    The driver receives at most BUCKETS counts a language, whatever the input's size."""
    rows = training.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = (
        in_arrow(rows, _count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.full((len(langs), BUCKETS), SMOOTHING)
    at = np.searchsorted(np.array(langs, dtype=object), counts["lang"].to_numpy()) if langs else []
    table[at, counts["gram"].to_numpy(dtype=np.int64)] += counts["n"].to_numpy(dtype=np.float64)
    return Model(langs, table / table.sum(axis=1, keepdims=True) if langs else table)


def _shares(prob: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """EM: mixture weights for the rows of `prob`, and the log-likelihood. It runs until it
    stands still, which it always comes to: every step raises a bounded, concave likelihood."""
    w = np.full(len(prob), 1.0 / len(prob))
    moved = len(prob) > 1
    while moved:
        new = w * (prob @ (n / (w @ prob))) / n.sum()
        moved = np.abs(new - w).max() >= TOLERANCE
        w = new
    return w, float(n @ np.log(w @ prob))


def mixture(prob: np.ndarray, grams: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The languages (row numbers of `prob`) of the best penalised likelihood, and shares."""
    ids, n = np.unique(grams, return_counts=True)
    local = prob[:, ids]
    penalty = PENALTY * np.log(max(2, n.sum()))
    chosen = list(range(len(prob)))
    w, ll = _shares(local, n)
    while len(chosen) > 1:
        rest = [c for i, c in enumerate(chosen) if i != int(np.argmin(w))]
        w2, ll2 = _shares(local[rest], n)
        if ll2 + penalty < ll:
            break
        chosen, w, ll = rest, w2, ll2
    return chosen, w


def name(model: Model, text: str | None) -> tuple[str, float, list[str]]:
    """A text's language, its share, and all languages of the mixture by falling share."""
    if not model.langs or text is None or not _LETTER.search(text):
        return UNKNOWN, 0.0, []
    chosen, w = mixture(model.prob, trigrams(text))
    order = sorted(range(len(chosen)), key=lambda i: (-w[i], chosen[i]))
    found = [model.langs[chosen[i]] for i in order]
    return found[0], float(min(1.0, max(0.0, w[order[0]]))), found


def _texts(batch: pa.RecordBatch) -> list:
    return batch.column("text").cast(pa.string()).to_pylist()


def _predictor(model):
    def run(batches):
        for batch in batches:
            named = [name(model.value, text) for text in _texts(batch)]
            pred, score, found = zip(*named) if named else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(pred, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(found, pa.list_(pa.string())),
                ],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    return run


def _filter(model):
    def run(batches):
        for batch in batches:
            known = [name(model.value, text)[0] != UNKNOWN for text in _texts(batch)]
            yield batch.filter(pa.array(known, pa.bool_()))

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score (the named language's share, 0 to 1) and all languages of
    the mixture by falling share, one row per row of `docs`. Only the text is read.

    Null texts and texts without a letter are `und` with score 0, as is every text when the
    model learned no language. Ties go to the language first in order; repeated rows are
    predicted each; empty tables give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_arrow(
        docs, _predictor(shared), "doc_id long, lang_pred string, score double, languages array<string>"
    )


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that `predict` does not call `und`, with all their columns. Every
    row is judged by its own text, whether its doc_id is null, repeated or neither."""
    return in_arrow(docs, _filter(docs.sparkSession.sparkContext.broadcast(model)), docs.schema)


def held_out(doc_id: Column) -> Column:
    """Fixed value of the contract: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
