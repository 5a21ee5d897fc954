"""Language identification with error-correcting output codes.

Every language gets a codeword, and one binary classifier per bit predicts that bit from hashed byte
n-grams. A bit classifier is the log-odds of an n-gram between the languages whose bit is one and those
whose bit is zero, so it is fitted in closed form from n-gram counts per language: one distributed sum over
all training texts, from which a table of languages x buckets reaches the driver, however many texts there
are. Decoding weighs each bit's loss by how far apart that classifier holds its two sides, takes the
nearest codeword and flags a text whose two nearest codewords are about equally far.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNDETERMINED = "und"


class Settings(NamedTuple):
    orders: tuple[int, ...] = (2, 3, 4)
    bits: int = 13               # log2 of the number of n-gram buckets
    smoothing: float = 0.5
    most_columns: int = 31       # bits of a codeword at most
    ambiguous_below: float = 0.6  # score under which a text is flagged
    block_bytes: int = 1 << 20   # text bytes handled at once


class Model(NamedTuple):
    languages: tuple[str, ...]
    code: np.ndarray      # languages x columns, +1 or -1
    weights: np.ndarray   # buckets x columns, log-odds
    trust: np.ndarray     # columns: margin of the bit's worst language, at least a little
    settings: Settings


# ---------------------------------------------------------------- features


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def buckets(data: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each byte, for bytes with ``order - 1`` successors."""
    n = len(data) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    code = np.full(n, order, np.uint32)
    for k in range(order):
        code *= np.uint32(257)
        code += data[k:k + n]
    code *= np.uint32(2654435761)
    return (code >> np.uint32(32 - bits)).astype(np.int64)


def lowered(text: str) -> np.ndarray:
    """UTF-8 bytes of the lower-cased text between blanks, so that word ends count as n-grams."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)


def block_slices(data: np.ndarray, order: int, block: int) -> Iterator[np.ndarray]:
    """``data`` in overlapping pieces that together hold each n-gram once."""
    for at in range(0, max(1, len(data) - order + 1), block):
        yield data[at:at + block + order - 1]


# ---------------------------------------------------------------- codewords


def codewords(n_languages: int, most_columns: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 per language; no constant, equal or complementary columns.

    Up to five languages take the exhaustive code. More take random columns, the set with the largest least
    distance between two rows out of fixed-seed trials.
    """
    if n_languages < 2:
        return np.ones((n_languages, 1), np.int8)
    if 2 ** (n_languages - 1) - 1 <= most_columns:
        rest = itertools.product((1, -1), repeat=n_languages - 1)
        return np.array([(1, *r) for r in rest if -1 in r], np.int8).T
    columns = max(most_columns, math.ceil(6 * math.log2(n_languages)))
    rng, best, best_distance = np.random.default_rng(seed), None, -1
    for _ in range(64):
        trial = rng.choice(np.array([1, -1], np.int8), (n_languages, columns))
        flat = np.abs(trial.sum(axis=0, dtype=np.int64)) == n_languages
        trial[0, flat] *= -1
        apart = (columns - trial.astype(np.int64) @ trial.T.astype(np.int64)) // 2
        np.fill_diagonal(apart, columns)
        if apart.min() > best_distance:
            best, best_distance = trial, int(apart.min())
    return best


# ---------------------------------------------------------------- training


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", settings: Settings = Settings()) -> Model:
    """Fit on every row with a text that holds a letter and a language.

    N-gram counts are summed per language inside each task, then over tasks: what is shuffled and what
    reaches the driver is bounded by languages x buckets, not by the texts. No row, or only one language,
    gives a model that predicts ``und`` or that language.
    """
    size = len(settings.orders) << settings.bits

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, language in zip(batch["_text"], batch["_lang"], strict=True):
                if not has_letter(value):
                    continue
                total = sums.setdefault(language, np.zeros(size, np.int64))
                data = lowered(value)
                for i, order in enumerate(settings.orders):
                    part = total[i << settings.bits:(i + 1) << settings.bits]
                    for piece in block_slices(data, order, settings.block_bytes):
                        found = buckets(piece, order, settings.bits)
                        if len(found) < 4096:
                            np.add.at(part, found, 1)
                        else:
                            part += np.bincount(found, minlength=1 << settings.bits)
        for language, total in sums.items():
            seen = np.flatnonzero(total)
            yield pd.DataFrame({"lang": language, "bucket": seen, "n": total[seen]})

    rows = docs.select(docs[text].alias("_text"), docs[lang].alias("_lang")).where("_text IS NOT NULL AND _lang IS NOT NULL")
    summed = (rows.mapInPandas(count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts = {}
    for language, part in summed.groupby("lang"):
        counts[language] = np.zeros(size)
        counts[language][part["bucket"].to_numpy()] = part["n"].to_numpy()
    return model_of(counts, settings)


def model_of(counts: dict[str, np.ndarray], settings: Settings) -> Model:
    """The model for n-gram counts per language."""
    languages = tuple(sorted(counts))
    code = codewords(len(languages), settings.most_columns)
    size = len(settings.orders) << settings.bits
    if len(languages) < 2:
        return Model(languages, code, np.zeros((size, 1), np.float32), np.ones(1), settings)
    share = np.stack([counts[c] + settings.smoothing for c in languages])
    for i in range(len(settings.orders)):  # each order is a distribution of its own
        part = share[:, i << settings.bits:(i + 1) << settings.bits]
        part /= part.sum(axis=1, keepdims=True)
    weights = np.empty((size, code.shape[1]), np.float32)
    for b, column in enumerate(code.T):
        weights[:, b] = np.log(share[column > 0].mean(axis=0)) - np.log(share[column < 0].mean(axis=0))
    expected = share @ weights / len(settings.orders)      # mean margin per n-gram of each language's own texts
    trust = np.maximum((code * expected).min(axis=0), 1e-3)
    return Model(languages, code, weights, trust / trust.sum(), settings)


# ---------------------------------------------------------------- prediction


def margins(text: str, model: Model) -> tuple[np.ndarray, int]:
    """Summed log-odds per bit over the whole text, and the number of n-grams."""
    settings, data = model.settings, lowered(text)
    total, n = np.zeros(model.weights.shape[1]), 0
    for i, order in enumerate(settings.orders):
        part = model.weights[i << settings.bits:(i + 1) << settings.bits]
        for piece in block_slices(data, order, settings.block_bytes):
            found = buckets(piece, order, settings.bits)
            if len(found) < 8192:
                total += part[found].sum(axis=0, dtype=np.float64)
            else:
                total += np.bincount(found, minlength=1 << settings.bits) @ part
            n += len(found)
    return total, n


def decode(total: np.ndarray, n: int, model: Model) -> tuple[str, float, bool]:
    """Language of the nearest codeword, its score, and whether the decision is ambiguous.

    A bit's margin is its mean log-odds times the root of the text's length in n-grams: longer texts are
    surer, but n-grams overlap and are not independent evidence. The loss of a bit is logistic and weighed
    by the trust in its classifier; a codeword's distance is the weighed loss over its bits.
    """
    if len(model.languages) == 1:
        return model.languages[0], 1.0, False
    margin = total / math.sqrt(max(n, 1))
    loss = np.logaddexp(0.0, -model.code * margin) @ model.trust
    chance = np.exp(loss.min() - loss)
    chance /= chance.sum()
    best = int(np.argmin(loss))
    score = float(chance[best])
    return model.languages[best], score, score < model.settings.ambiguous_below


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``, replacing columns of those names.

    A null text, a text without a letter and any text under a model without languages are ``und`` with
    score 0, flagged ambiguous. Whole texts are read. Every row is kept; other columns pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x bits floats, bounded by the settings

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            out = [(UNDETERMINED, 0.0, True) if value is None or not known.languages or not has_letter(value)
                   else decode(*margins(value, known), known) for value in batch]
            yield pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous", "_lang_id")]
    found = docs.select(*kept, run(docs[text]).alias("_lang_id"))
    return found.select(*kept, "_lang_id.lang_pred", "_lang_id.score", "_lang_id.ambiguous")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """Rows that may be learned from: an id that is known and not held out."""
    return doc_id.isNotNull() & ~held_out(doc_id)
