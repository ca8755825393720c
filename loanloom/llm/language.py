"""Language identification: every document as a mixture of languages, fitted by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from loanloom.llm.common import releasing

#: Hashed character trigrams; a language's model has one number for each.
GRAMS = 4096
#: Characters that are looked at in one go; longer texts are counted in pieces, to the same counts.
CHUNK = 500_000
DOCS_AT_ONCE = 256


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _kept(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points with what is not a letter as blank, and which of them count: letters and their neighbours."""
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    return np.where(letter, points, 32).astype(np.uint64), keep


def _hashed(points: np.ndarray) -> np.ndarray:
    """Bucket of each trigram of neighbouring points."""
    mixed = ((points[:-2] * np.uint64(1_000_003) + points[1:-1]) * np.uint64(1_000_003) + points[2:]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % GRAMS


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of lower-cased letters, with what is not a letter as blank, and the text that each belongs to."""
    padded = [f" {t.lower()} " for t in texts]
    points, keep = _kept(_points("".join(padded)))
    points, owner = points[keep], np.repeat(np.arange(len(texts)), [len(t) for t in padded])[keep]
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = owner[2:] == owner[:-2]
    return _hashed(points)[same], owner[2:][same]


def _long_counts(text: str) -> np.ndarray:
    """Counts of a long text's trigrams, in pieces: each is read with a neighbour on either side, and its first trigrams with the end of the piece before."""
    padded, before, out = f" {text.lower()} ", np.zeros(0, np.uint64), np.zeros(GRAMS)
    for at in range(0, len(padded), CHUNK):
        low, high = max(at - 1, 0), min(at + CHUNK, len(padded))
        points, keep = _kept(_points(padded[low : high + 1]))
        inside = slice(at - low, high - low)
        run = np.concatenate([before, points[inside][keep[inside]]])
        if len(run) > 2:
            out += np.bincount(_hashed(run), minlength=GRAMS)
        before = run[-2:]
    return out


def gram_counts(texts: list[str]) -> np.ndarray:
    """Counts of hashed trigrams, a row for each text; all zero where a text has no letter."""
    out = np.zeros((len(texts), GRAMS), dtype=np.float32)
    at = 0
    while at < len(texts):
        to, size = at + 1, len(texts[at])
        while to < len(texts) and size + len(texts[to]) <= CHUNK:
            size, to = size + len(texts[to]), to + 1
        if size > CHUNK:
            out[at] = _long_counts(texts[at])
        else:
            codes, owner = _codes(texts[at:to])
            out[at:to] = np.bincount(owner * GRAMS + codes, minlength=(to - at) * GRAMS).reshape(to - at, GRAMS)
        at = to
    return out


@dataclass(frozen=True)
class LanguageModel:
    """``likelihood``: a row per language, scaled so that a uniform language has 1 everywhere."""

    names: tuple[str, ...]
    likelihood: np.ndarray

    def _fit(self, counts: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Shares after ``rounds`` of expectation-maximisation, and the log-likelihood before the last; shares of 0 stay 0."""
        total, logs = counts.sum(axis=1), None
        for _ in range(rounds):
            mixed = share @ self.likelihood
            share = share * ((counts / mixed) @ self.likelihood.T) / total[:, None]
            share /= share.sum(axis=1, keepdims=True)
        mixed = share @ self.likelihood
        logs = (counts * np.log(mixed)).sum(axis=1, dtype=np.float64)
        return share, logs

    def mixtures(self, counts: np.ndarray, rounds: int = 8, again: int = 4, price: float = 4.0) -> np.ndarray:
        """Shares of the languages in each document. Starting from all, the language with the least share is taken out as long
        as the log-likelihood loses less than its price, ``price`` times half the log of the number of trigrams."""
        n_lang = len(self.names)
        share, logs = self._fit(counts, np.full((len(counts), n_lang), 1 / n_lang, dtype=np.float32), rounds)
        cost = price * 0.5 * np.log(np.maximum(counts.sum(axis=1), 2)) + 0.01 * counts.sum(axis=1)
        going = np.arange(len(counts))
        for _ in range(n_lang - 1):
            least = np.where(share[going] > 0, share[going], np.inf).argmin(axis=1)
            tried = share[going].copy()
            tried[np.arange(len(going)), least] = 0
            rest = tried.sum(axis=1)
            tried = np.where(rest[:, None] > 0, tried / np.maximum(rest, 1e-30)[:, None], share[going])
            tried, new = self._fit(counts[going], tried.astype(np.float32), again)
            ok = logs[going] - new <= cost[going]
            share[going[ok]], logs[going[ok]] = tried[ok], new[ok]
            going = going[ok]
            if not len(going):
                break
        return share


def train(docs: DataFrame, usable: Column, lang_col: str = "lang", text_col: str = "text", smoothing: float = 0.5) -> LanguageModel:
    """Trigram frequencies per language over all documents for which ``usable`` holds; rows without language or text take no part.

    What reaches the driver is the model itself, ``GRAMS`` numbers for each language.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, len(batch), DOCS_AT_ONCE):
                part = batch.iloc[at : at + DOCS_AT_ONCE]
                grams = gram_counts(part["text"].tolist())
                for lang, rows in part.reset_index(drop=True).groupby("lang").indices.items():
                    sums[lang] = sums.get(lang, 0) + grams[rows].sum(axis=0, dtype=np.float64)
        for lang, total in sums.items():
            yield pd.DataFrame({"lang": lang, "gram": np.flatnonzero(total), "n": total[total > 0].astype(np.int64)})

    known = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInPandas(releasing(count), "lang string, gram long, n long")
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(rows["lang"].unique()))
    table = np.zeros((len(names), GRAMS))
    table[rows["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(dtype=np.int64), rows["gram"].to_numpy(dtype=np.int64)] = rows["n"]
    table = (table + smoothing) / (table + smoothing).sum(axis=1, keepdims=True) * GRAMS
    return LanguageModel(names, table.astype(np.float32))


def _released(run):
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return releasing(run)(texts)

    return predict


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (the language of the largest share), ``score`` (that share) and ``lang_mix`` ("en:0.81,fr:0.19",
    the languages that pay for themselves, largest first).

    ``und`` with score 0 where the text is null or empty, has no letter, or no language was learned. Whole texts count; repeated rows
    each get a row; an empty table stays empty. Columns of the same names are replaced, others pass through.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_mix", "_found")]

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            out = []
            for at in range(0, len(batch), DOCS_AT_ONCE):
                counts = gram_counts(batch.iloc[at : at + DOCS_AT_ONCE].fillna("").tolist())
                rows: list[tuple] = [("und", 0.0, "")] * len(counts)
                has = np.flatnonzero(counts.sum(axis=1)) if model.names else []
                if len(has):
                    for i, share in zip(has, model.mixtures(counts[has]), strict=True):
                        order = [j for j in np.argsort(-share, kind="stable") if share[j] > 0]
                        mix = ",".join(f"{model.names[j]}:{share[j]:.2f}" for j in order)
                        rows[i] = (model.names[order[0]], min(1.0, float(share[order[0]])), mix)
                out += rows
            yield pd.DataFrame(out, columns=["lang_pred", "score", "lang_mix"])

    found = F.pandas_udf(_released(predict), "lang_pred string, score double, lang_mix string")
    return docs.select(*[F.col(f"`{c}`") for c in kept], found(F.col(text_col)).alias("_found")).select(*[F.col(f"`{c}`") for c in kept], "_found.*")


def rejected() -> Column:
    """Documents without a language: no letters, or no language with two fifths of the text."""
    return (F.col("lang_pred") == "und") | (F.col("score") < 0.4)
