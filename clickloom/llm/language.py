"""Language ID: TF-IDF vectors of character n-grams against several centroids per language.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``); prediction covers whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import per_text, settle

#: Labelled rows the model is fitted on at most, shared equally by the languages.
SAMPLE_ROWS = 2400
#: Hashed n-gram features, centroids per language, n-gram lengths 1 to GRAM.
FEATURES = 4096
CENTROIDS = 4
GRAM = 3
#: Code points looked at together, so that a very long text needs bounded memory.
SLICE = 1 << 20
#: One labelled row of HELD is kept back to set the radius: at each text length the distance that QUANTILE of these rows
#: keep, plus MARGIN and SHORT by the root of the number of n-grams. Beyond it a text is rejected.
HELD = 4
QUANTILE = 0.99
MARGIN = 0.03
SHORT = 0.6
#: Characters of a held-back row that are cut to shorter texts.
START = 4096

UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of letter n-grams, every other character being a word boundary; None without letters."""
    if not text:
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.where(letter, code, 32)[keep].astype(np.uint32)
    code = np.concatenate(([np.uint32(32)], code, [np.uint32(32)])).astype(np.uint32)
    counts = np.zeros(FEATURES, np.int64)
    for at in range(0, len(code), SLICE):
        part = code[at:at + SLICE + GRAM - 1]
        key = np.zeros(len(part), np.uint32)
        for n in range(1, GRAM + 1):
            key = key[:len(part) - n + 1] * np.uint32(0x9E3779B1) + part[n - 1:] + np.uint32(n)
            own = key[:max(0, min(SLICE, len(code) - n + 1 - at))]
            mixed = (own ^ (own >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            counts += np.bincount(mixed >> np.uint32(20), minlength=FEATURES)
    return counts


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    raw = np.log1p(counts, dtype=np.float32) * idf
    return raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-9)


def _length_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(1 + counts.sum(axis=1)).astype(int)


def _clusters(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from far-apart rows; fewer centroids if there are fewer different rows."""
    picked = [rows.mean(axis=0)]
    for _ in range(k - 1):
        picked.append(rows[np.argmin(np.max(rows @ np.array(picked).T, axis=1))])
    centres = np.array(picked, np.float32)
    for _ in range(12):
        near = np.argmax(rows @ centres.T, axis=1)
        centres = np.array([rows[near == i].mean(axis=0) for i in np.unique(near)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray  # language number of each centroid
    radius: np.ndarray  # by length class: the largest accepted distance

    def predict(self, texts) -> list[tuple[str, float, bool]]:
        """Language, cosine to the nearest centroid, and whether the text is rejected."""
        out = []
        for at in range(0, len(texts), 256):
            found = [gram_counts(t) for t in texts[at:at + 256]]
            known = [c for c in found if c is not None]
            if not known or not self.languages:
                out += [(UNKNOWN, 0.0, True)] * len(found)
                continue
            counts = np.array(known)
            near = _vectors(counts, self.idf) @ self.centroids.T
            best = near.argmax(axis=1)
            score = np.clip(near[np.arange(len(best)), best], 0, 1).astype(float)
            far = 1 - score > self.radius[_length_class(counts)]
            each = iter(zip(best, score, far, strict=True))
            for c in found:
                if c is None:
                    out.append((UNKNOWN, 0.0, True))
                else:
                    b, s, f = next(each)
                    out.append((self.languages[self.owner[b]], float(s), bool(f)))
        return out


def sample(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` different rows of ``labelled(text, lang)``, about as many of each language and one at least,
    as far as ``rows`` goes; however many copies a language's texts have."""
    labelled = labelled.select("text", "lang").filter("lang is not null and text is not null")
    # Copies fall together by 128 bits of hash before the shuffle; the text comes back for the rows that are taken.
    keyed = labelled.withColumns({"_key1": F.xxhash64("text", "lang"), "_key2": F.xxhash64(F.lit(1), "text", "lang")})
    different = settle(keyed.select("lang", "_key1", "_key2").distinct(), "labelled")
    sizes = different.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_key1", "_key2")).alias("_least"))
    share = sizes.withColumn("_share", F.lit(2.0 * rows) / (
        F.col("_n") * F.count(F.lit(1)).over(Window.partitionBy()))).drop("_n").orderBy("_least").limit(rows)
    unit = F.pmod(F.col("_key1"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sure = F.struct("_key1", "_key2") == F.col("_least")
    taken = (different.join(F.broadcast(share), "lang").withColumn("_unit", unit)
             .filter(sure | (F.col("_unit") < F.col("_share")))
             .orderBy((~sure), F.col("_unit") / F.col("_share"), "lang", "_key1", "_key2").limit(rows)
             .select("lang", "_key1", "_key2"))
    return (keyed.join(F.broadcast(taken), ["lang", "_key1", "_key2"])
            .groupBy("lang", "_key1", "_key2").agg(F.first("text").alias("text")).select("text", "lang"))


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Centroids from ``labelled(text, lang)``; null texts and languages are left out.

    No usable row gives a model that knows no language.
    """
    def count(texts: pd.Series) -> pd.DataFrame:
        counts = [gram_counts(t) for t in texts]
        return pd.DataFrame({"counts": [None if c is None else c.astype(np.uint32).tobytes() for c in counts],
                             "start": [t[:START] for t in texts]})

    got = per_text(sample(labelled, rows), count, "counts binary, start string").select("lang", "counts", "start").filter(
        "counts is not null").collect()  # at most `rows` vectors
    got.sort(key=lambda r: (r["lang"], bytes(r["counts"])))
    languages = sorted({r["lang"] for r in got})
    if not got:
        return Model([], np.zeros(FEATURES, np.float32), np.zeros((0, FEATURES), np.float32),
                     np.zeros(0, int), np.full(64, 2.0))
    counts = np.array([np.frombuffer(r["counts"], np.uint32) for r in got])
    idf = (np.log((1 + len(got)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    vectors = _vectors(counts, idf)
    label = np.array([languages.index(r["lang"]) for r in got])
    groups = [_clusters(vectors[label == i], CENTROIDS) for i in range(len(languages))]
    centroids = np.concatenate(groups).astype(np.float32)
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    radius = _radius(counts, idf, label, [r["start"] for r in got])
    return Model(languages, idf, centroids, owner, radius)


def _radius(counts: np.ndarray, idf: np.ndarray, label: np.ndarray, starts: list[str]) -> np.ndarray:
    """By length class, the distance up to which a text is accepted: held-back rows, whole and cut, against centroids
    of the others. A language of few rows keeps none back; classes with few texts are taken together."""
    vectors = _vectors(counts, idf)
    place = np.zeros(len(label), int)
    for i in np.unique(label):
        place[label == i] = np.arange((label == i).sum())
    held = place % HELD == HELD - 1
    centroids = np.concatenate([_clusters(vectors[(label == i) & ~held], CENTROIDS) for i in np.unique(label)])
    held = held if held.any() else ~held
    distance, length = [], []
    for n in range(3, START.bit_length() + 1):  # the last time whole
        cuts = [gram_counts(starts[i][:1 << n]) for i in np.flatnonzero(held)
                if len(starts[i]) >= 1 << n] if n < START.bit_length() else list(counts[held])
        cuts = [c for c in cuts if c is not None]
        if cuts:
            asked = np.array(cuts, np.uint32)
            distance.append(1 - (_vectors(asked, idf) @ centroids.T).max(axis=1))
            length.append(_length_class(asked))
    distance, length = np.concatenate(distance), np.concatenate(length)
    # Few texts say little about a class.
    enough = max((n for n in np.unique(length) if (length >= n).sum() >= 100), default=length.min())
    radius = np.full(64, np.quantile(distance[length >= enough], QUANTILE))
    for n in np.unique(length[length < enough]):
        same = distance[length == n]
        radius[n] = np.quantile(same if len(same) >= 100 else distance[length >= n], QUANTILE)
    # A shorter text lies farther off: each class takes the radius of the longer ones at least.
    radius = np.maximum.accumulate(radius[::-1])[::-1]
    return radius + MARGIN + SHORT / np.sqrt(2.0 ** np.arange(64))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected; columns of these names are replaced.

    A null text, or one without a letter, is ``und`` with score 0 and rejected; so is every text for a model without
    languages. Any other text gets the nearest language, and is rejected if it lies farther from all centroids than
    nearly all held-back texts of its length did.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.predict(texts.tolist()), columns=["lang_pred", "score", "rejected"])

    return per_text(docs, predict, "lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is found, with the columns of ``docs``."""
    packed = docs.select(F.struct("*").alias("_doc"), "text")
    return identify(packed, fit(labelled)).filter(~F.col("rejected")).select("_doc.*")
