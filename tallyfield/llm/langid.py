"""Language identification with hyperdimensional letter vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.llm.common import held_out, require

DIMENSIONS = 512
ORDER = 3
SEED = 2024
#: Characters of one step of work, and n-gram vectors held at once.
STEP = 1 << 20
REMEMBERED = 1 << 15
#: All languages without a letter in the text.
UNKNOWN = "und"

_vectors: dict[int, np.ndarray] = {}


def letter_vector(code: int) -> np.ndarray:
    """The random +1/-1 vector of a letter; 0 is the mark between words."""
    if code not in _vectors:
        rng = np.random.default_rng((SEED, code))
        _vectors[code] = rng.integers(0, 2, DIMENSIONS, np.int8) * np.int8(2) - np.int8(1)
    return _vectors[code]


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """One vector per n-gram: letter vectors, permuted by their place, bound by multiplication."""
    out = np.ones((len(grams), DIMENSIONS), np.int8)
    codes, at = np.unique(grams, return_inverse=True)
    table = np.vstack([letter_vector(int(c)) for c in codes]) if len(codes) else np.zeros((0, DIMENSIONS), np.int8)
    at = at.reshape(grams.shape)
    for place in range(grams.shape[1]):
        out *= np.roll(table, grams.shape[1] - 1 - place, axis=1)[at[:, place]]
    return out


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of this step, the texts as places in them with each other run a single 0, and their owners."""
    joined = [f" {x.lower()} " for x in texts]
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(joined), dtype=np.int32), [len(x) for x in joined])
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    alphabet = np.array([0, *(c for c in np.flatnonzero(seen) if chr(c).isalpha())], np.int64)
    place = np.zeros(0x110000, np.int32)
    place[alphabet] = np.arange(len(alphabet))
    at = place[codes]
    keep = (at > 0) | np.append(True, (at[:-1] > 0) | (owner[1:] != owner[:-1]))
    return alphabet, at[keep].astype(np.int64), owner[keep]


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner and number of each n-gram in the texts, the distinct n-grams, letters per text."""
    alphabet, at, owner = _letters(texts)
    n = len(at) - ORDER + 1
    letters = np.bincount(owner, weights=at > 0, minlength=len(texts))
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, ORDER), np.int64), letters
    packed = np.zeros(n, np.int64)
    for place in range(ORDER):
        packed = packed * len(alphabet) + at[place : place + n]
    inside = owner[:n] == owner[ORDER - 1 :]
    packed, owner = packed[inside], owner[:n][inside]
    size = len(alphabet) ** ORDER
    if size <= 8 * STEP:
        met = np.zeros(size, bool)
        met[packed] = True
        distinct = np.flatnonzero(met)
        number = np.zeros(size, np.int32)
        number[distinct] = np.arange(len(distinct))
        number = number[packed]
    else:  # many scripts at once
        distinct, number = np.unique(packed, return_inverse=True)
    powers = len(alphabet) ** np.arange(ORDER - 1, -1, -1)
    return owner, number, alphabet[distinct[:, None] // powers % len(alphabet)], letters


def text_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bundled vector of each text, and how many letters it has. Texts of any length are added up in steps."""
    out, letters = np.zeros((len(texts), DIMENSIONS), np.float32), np.zeros(len(texts))
    step: list[tuple[int, str]] = []

    def add() -> None:
        owner, number, grams, found = _grams([x for _, x in step])
        rows = np.array([k for k, _ in step])
        np.add.at(letters, rows, found)
        for begin in range(0, len(grams), REMEMBERED):
            vectors = gram_vectors(grams[begin : begin + REMEMBERED]).astype(np.float32)
            size = len(vectors)
            for first in range(0, len(step), 256):
                low, high = np.searchsorted(owner, [first, first + 256])
                some, where = number[low:high] - begin, owner[low:high] - first
                if size < len(grams):
                    inside = (some >= 0) & (some < size)
                    some, where = some[inside], where[inside]
                high = min(256, len(step) - first)
                counts = np.bincount(where * np.int64(size) + some, minlength=high * size)
                np.add.at(out, rows[first : first + 256], counts.reshape(high, size).astype(np.float32) @ vectors)
        step.clear()

    held = 0
    for k, text in enumerate(texts):
        for begin in range(0, max(len(text), 1), STEP):
            # A cut acts as a space: it changes the few n-grams that would cross it, for texts above a million letters.
            piece = text[begin : begin + STEP]
            step.append((k, piece))
            held += len(piece)
            if held >= STEP:
                add()
                held = 0
    if step:
        add()
    return out, letters


@dataclass(frozen=True)
class LanguageModel:
    """Names in order and one unit prototype each."""

    names: list[str]
    prototypes: np.ndarray


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Bundle all texts of a language into its prototype: sums per partition, then over partitions.

    Each text counts the same, however long, so that no single one can set the tone of a language. Only languages x dimensions sums leave a partition. Rows with a null text or language are left out.
    """

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, part in batch.groupby("lang", sort=False):
                total = sums.setdefault(name, np.zeros(DIMENSIONS))
                # The vectors of one language add up before the n-grams are turned into vectors.
                held: list[str] = []
                size = 0
                for text in [*part["text"], None]:
                    if text is not None:
                        held.append(text)
                        size += len(text)
                    if held and (text is None or size >= STEP):
                        owner, number, grams, letters = _grams(held)
                        weight = (1e6 / np.maximum(letters, 1))[owner]
                        counts = np.bincount(number, weights=weight, minlength=len(grams))
                        for begin in range(0, len(grams), REMEMBERED):
                            vectors = gram_vectors(grams[begin : begin + REMEMBERED]).astype(np.float64)
                            total += counts[begin : begin + REMEMBERED] @ vectors
                        held, size = [], 0
        for name, total in sums.items():
            yield pd.DataFrame({"lang": name, "j": np.arange(DIMENSIONS), "v": np.round(total).astype(np.int64)})

    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    sums = rows.mapInPandas(bundle, "lang string, j int, v long").groupBy("lang", "j").agg(F.sum("v").alias("v"))
    found = sums.toPandas()
    names = sorted(found["lang"].unique())
    table = np.zeros((len(names), DIMENSIONS))
    table[[names.index(x) for x in found["lang"]], found["j"].to_numpy(int)] = found["v"].to_numpy()
    norms = np.linalg.norm(table, axis=1)
    keep = norms > 0
    return LanguageModel([x for x, k in zip(names, keep) if k], table[keep] / norms[keep][:, None])


def predict(text: Column, model: LanguageModel) -> Column:
    """Struct of lang_pred and score: the prototype with the largest cosine, and that cosine cut to 0..1.

    ``und`` with score 0 for a null text, a text without a letter, or a model without languages.
    """

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def of(texts: pd.Series) -> pd.DataFrame:
        vectors, letters = text_vectors([x or "" for x in texts])
        names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if model.names and len(texts):
            cosine = vectors @ model.prototypes.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
            best = cosine.argmax(axis=1)
            some = letters > 0
            names[some] = np.array(model.names, object)[best[some]]
            scores[some] = np.clip(cosine[np.arange(len(texts)), best], 0, 1)[some]
        return pd.DataFrame({"lang_pred": names, "score": np.round(scores, 6)})

    return of(text)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred and score for every row; the model is learned from rows outside the held-out fold.

    Null and letterless texts give ``und`` and 0; ties between languages go to the first name. An empty
    table gives no rows.
    """
    require(docs, id_col, text_col, lang_col)
    model = fit(docs.filter(~held_out(F.col(id_col))), text_col, lang_col)
    found = docs.select(
        F.col(id_col), held_out(F.col(id_col)).alias("held_out"), predict(F.col(text_col), model).alias("p")
    )
    return found.select(F.col(id_col), "held_out", "p.lang_pred", "p.score")
