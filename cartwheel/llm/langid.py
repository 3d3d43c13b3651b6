"""Language identification by nearest centroid over TF-IDF character n-grams.

A text is folded to lower-case letters and single spaces; its 2- and 3-byte
grams are hashed into a fixed number of bins, weighted by inverse document
frequency and normalised. Each language has several centroids (spherical
k-means over its training vectors). A text gets the language of the centroid
with the highest cosine. It is rejected when it is too far from it for its
length: a text of k different grams can reach at most the norm of the centroid's
k largest weights, and must reach a share of that. The share is learned for each
language and length (power of two of k) from training texts and pieces of them,
held against centroids of the other half of the sample: a low quantile with a
margin, REJECT_SHARE at least.

Training uses a bounded sample (``SAMPLE_ROWS`` labelled rows over all
languages, chosen by hash of the id); prediction reads every whole text.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored, unused

BIN_BITS = 16
BINS = 1 << BIN_BITS
SAMPLE_ROWS = 3_000
# Training texts of a language, however many languages there are.
LEAST_OF_LANGUAGE = 20
CENTROIDS = 3
ROUNDS = 8
REJECT_SHARE = 0.1
# Shares are learned from whole texts and pieces of so many words, in bands by the number of different grams.
PIECE_WORDS = (2, 6, 20, 60, 200)
BANDS = BIN_BITS + 1
LOW_QUANTILE, MARGIN, LEAST_PIECES = 0.01, 0.5, 10
UNKNOWN = "und"
CHUNK = 1 << 20

_FOLD = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed 2- and 3-byte grams over the whole text, in chunks of bounded memory."""
    out = np.zeros(BINS, np.float32)
    folded = b" " + b" ".join(text.lower().encode().translate(_FOLD).split()) + b" "
    for at in range(0, len(folded), CHUNK):
        b = np.frombuffer(folded[at : at + CHUNK + 2], np.uint8).astype(np.uint32)
        pairs = b[:-1] * np.uint32(256) + b[1:]
        threes = pairs[:-1] * np.uint32(256) + b[2:]
        if at + CHUNK + 1 < len(folded):
            pairs = pairs[:-1]  # the last pair opens the next chunk
        for grams in (pairs, threes):
            bins = (grams * np.uint32(2654435761)) >> np.uint32(32 - BIN_BITS)
            out += np.bincount(bins, minlength=BINS).astype(np.float32)
    return out


def sparse_counts(text: str) -> bytes:
    counts = gram_counts(text)
    at = np.flatnonzero(counts)
    return zlib.compress(at.astype(np.uint32).tobytes() + counts[at].tobytes(), 1)


def sparse_row(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bins and values of a packed row."""
    both = zlib.decompress(packed)
    return np.frombuffer(both, np.uint32, len(both) // 8), np.frombuffer(both, np.float32, offset=len(both) // 2)


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf[at]
    norm = np.linalg.norm(v)
    return v / norm if norm > 0 else v


def reach_of(values: np.ndarray) -> np.ndarray:
    """By number of different grams: the highest cosine there can be with a centroid of these values (more grams than values add nothing)."""
    return np.sqrt(np.cumsum(np.concatenate([[0.0], -np.sort(-values.astype(float))]) ** 2))


def band(grams: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(grams, 1)).astype(int)


@dataclass
class LanguageModel:
    languages: tuple[str, ...]  # one per centroid
    idf: np.ndarray
    centroids: list[tuple[np.ndarray, np.ndarray]]  # bins that occur and their values, unit length
    shares: np.ndarray  # centroid x band: what a text must reach

    @functools.cached_property
    def reach(self) -> list[np.ndarray]:
        return [reach_of(values) for _, values in self.centroids]

    @functools.cached_property
    def by_bin(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The centroids' values bin by bin: where each bin's start, whose they are, and the values."""
        bins = np.concatenate([at for at, _ in self.centroids])
        whose = np.repeat(np.arange(len(self.centroids)), [len(at) for at, _ in self.centroids])
        order = np.argsort(bins, kind="stable")
        return np.searchsorted(bins[order], np.arange(BINS + 1)), whose[order], np.concatenate([v for _, v in self.centroids])[order]

    def cosines(self, at: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Of a unit vector with values at some bins, with each centroid."""
        starts, whose, values = self.by_bin
        n = starts[at + 1] - starts[at]
        ends = np.cumsum(n)
        pick = np.repeat(starts[at] - (ends - n), n) + np.arange(n.sum())
        return np.bincount(whose[pick], values[pick] * np.repeat(vector, n), len(self.centroids))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores (cosine, 0 to 1) and whether each text is rejected."""
        known = np.array([has_letter(t) for t in texts], bool)
        if not known.any() or not len(self.languages):
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        similar = np.zeros((len(texts), len(self.languages)), np.float32)
        grams = np.zeros(len(texts), int)
        for i in np.flatnonzero(known):
            counts = gram_counts(texts[i])
            at = np.flatnonzero(counts)
            similar[i] = self.cosines(at, weighted(at, counts[at], self.idf))
            grams[i] = len(at)
        best = similar.argmax(axis=1)
        score = np.clip(similar[np.arange(len(texts)), best], 0.0, 1.0).astype(float)
        langs = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        reach = np.array([self.reach[b][min(g, len(self.reach[b]) - 1)] for b, g in zip(best, grams, strict=True)])
        return langs, np.where(known, score, 0.0), ~known | (score < self.shares[best, band(grams)] * reach)


def training_sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``lang, text`` of about ``rows`` rows, equally many of each language.

    A language has at least one and about LEAST_OF_LANGUAGE texts, if it has them,
    however many languages there are. Rows are drawn by a hash of id and text, and
    equal ones are one row.
    """
    use = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("id"))
    use = use.filter("lang is not null and text is not null")
    draw = F.pmod(F.xxhash64(F.lit(99), "id", "text"), F.lit(1 << 30)) / float(1 << 30)
    use = use.select("lang", "text", draw.alias("draw"))
    per = stored(use.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")), "languages")
    each = max(LEAST_OF_LANGUAGE, rows / max(1, per.count()))
    limits = per.select(F.col("lang").alias("of_lang"), F.greatest("least", F.lit(each) / F.col("n")).alias("below"))
    drawn = use.join(limits, (F.col("lang") == F.col("of_lang")) & (F.col("draw") <= F.col("below")))
    return drawn.select("lang", "text").distinct()


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on the bounded sample: grams are counted and languages clustered on the executors; centroids reach the driver."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = []
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                if has_letter(text):
                    own.append((lang, sparse_counts(text), [sparse_counts(t) for t in pieces(text)]))
            yield pd.DataFrame(own, columns=["lang", "counts", "pieces"])

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(BINS, np.int64)
        for batch in batches:
            n += len(batch)
            for packed in batch["counts"]:
                df[sparse_row(packed)[0]] += 1
        yield pd.DataFrame({"n": [n], "df": [df.tobytes()]})

    sample = training_sample(labelled, id_col, text_col, lang_col, rows).mapInPandas(counts, "lang string, counts binary, pieces array<binary>")
    sample = stored(sample, "language-sample")
    n, df = 0, np.zeros(BINS, np.int64)
    for r in sample.select("counts").mapInPandas(frequencies, "n long, df binary").toLocalIterator():
        n, df = n + r["n"], df + np.frombuffer(r["df"], np.int64)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)

    def learn(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("counts", key=lambda c: c.map(bytes))
        means, shares = learn_language([sparse_row(c) for c in own["counts"]], [[sparse_row(p) for p in ps] for ps in own["pieces"]], idf)
        packed = [zlib.compress(np.flatnonzero(m).astype(np.uint32).tobytes() + m[m != 0].astype(np.float32).tobytes(), 1) for m in means]
        return pd.DataFrame({"lang": own["lang"].iloc[0], "k": range(len(means)), "centroid": packed, "shares": [shares.tolist()] * len(means)})

    found = sample.groupBy("lang").applyInPandas(learn, "lang string, k long, centroid binary, shares array<double>").collect()
    found.sort(key=lambda r: (r["lang"], r["k"]))
    if not found:
        return LanguageModel((), idf, [], np.zeros((0, BANDS)))
    return LanguageModel(tuple(r["lang"] for r in found), idf, [sparse_row(r["centroid"]) for r in found], np.array([r["shares"] for r in found]))


def pieces(text: str) -> Iterator[str]:
    """Runs of PIECE_WORDS words from within a text that has more of them."""
    words = text.split()
    for n in PIECE_WORDS:
        piece = " ".join(words[len(words) // 3 : len(words) // 3 + n])
        if len(words) // 3 + n <= len(words) and has_letter(piece):
            yield piece


def learn_language(texts: list[tuple[np.ndarray, np.ndarray]], parts: list[list[tuple[np.ndarray, np.ndarray]]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of one language and, per band, the share of its reach that a text must have."""

    def centroids(rows) -> np.ndarray:
        # only the bins that occur, so that the matrix stays small
        used = np.unique(np.concatenate([at for at, _ in rows]))
        unit = np.zeros((len(rows), len(used)), np.float32)
        for own, (at, n) in zip(unit, rows, strict=True):
            own[np.searchsorted(used, at)] = weighted(at, n, idf)
        means = clusters(unit, CENTROIDS)[0]
        out = np.zeros((len(means), BINS), np.float32)
        out[:, used] = means
        return out

    bands, ratios = [], []
    for half in (0, 1) if len(texts) > 1 else ():
        means = centroids(texts[half::2])
        reach = [reach_of(m) for m in means]
        for at, n in (row for text, own in zip(texts[1 - half :: 2], parts[1 - half :: 2], strict=True) for row in (text, *own)):
            cosines = means[:, at] @ weighted(at, n, idf)
            best = cosines.argmax()
            bands.append(band(np.array(len(at))))
            ratios.append(cosines[best] / reach[best][len(at)])
    bands, ratios = np.array(bands, int), np.array(ratios)
    shares, last = np.full(BANDS, REJECT_SHARE), REJECT_SHARE
    for b in range(BANDS):
        if (bands == b).sum() >= LEAST_PIECES:
            last = max(REJECT_SHARE, MARGIN * float(np.quantile(ratios[bands == b], LOW_QUANTILE)))
        shares[b] = last
    return centroids(texts), shares


def clusters(unit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means, seeded by farthest points; clusters that end empty go."""
    seeds = [0]
    for _ in range(min(k, len(unit)) - 1):
        near = (unit @ unit[seeds].T).max(axis=1)
        seeds.append(int(near.argmin()))
    means = unit[sorted(set(seeds))]
    for _ in range(ROUNDS):
        label = (unit @ means.T).argmax(axis=1)
        means = np.stack([unit[label == c].mean(axis=0) for c in sorted(set(label))])
        means /= np.linalg.norm(means, axis=1, keepdims=True)
    return means, (unit @ means.T).argmax(axis=1)


def language_of(model: LanguageModel, text: Column) -> Column:
    """Struct column ``lang, score, rejected`` for a text column (the model has CENTROIDS sparse vectors of at most BINS values a language)."""

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang, score, rejected = model.predict(list(batch))
            yield pd.DataFrame({"lang": lang, "score": score, "rejected": rejected})

    return predict(text)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score, rejected``; only the text is looked at.

    A text that is null or has no letter is ``und`` with score 0 and rejected.
    Every other text gets a learned language (``und`` if nothing was learned).
    Equal similarities go to the language first by name. Repeated rows are
    judged one by one; further columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), language_of(model, F.col(text_col)).alias("p"))
    return rows.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def accepted(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with their columns as they are."""
    found = unused(docs, "_lid")
    return docs.withColumn(found, language_of(model, docs[text_col])).filter(~F.col(found)["rejected"]).drop(found)
