"""Benchmark decontamination: rare n-gram seeds join passages to items, then Smith-Waterman alignment.

The word 3-grams of the test items are looked for in every document, through a
filter of fixed size, and what is found is counted over the whole corpus. A gram
of an item is one of its seeds when it is found at all and is rare: at most once
in RARE_DOCS documents, or at most COMMON_TIMES as often as the middle one of the
item's found grams. An item of common words thus keeps half of its grams at least.

Seed hashes are equi-joined with the hashes found in the documents. A passage
around a hit is as wide as an alignment over the threshold can be; it is aligned
word by word with the item, and the score is the best local alignment over that
of a full copy, so edited and paraphrased copies score in between. Words whose
alignment can't get there by an upper bound are left out, so every alignment over
the threshold that holds a seed of its item is found.

Each different text is aligned once. The documents are read once for their hits,
however many items there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import in_batches, only, stored, texts, unused, window_hashes, word_hashes

SEED_WORDS = 3
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
RARE_DOCS = 1_000
COMMON_TIMES = 8
# Items that one text is compared with in one row, on average at most.
BLOCK_ITEMS = 4_096
# The filter has a bit for each value of a hash's first FILTER_BITS bits, in pieces of what Spark's bitmaps hold.
FILTER_BITS = 27
PIECE_BITS = 1 << 15
BATCH_HITS = 1 << 20

GRAMS = "item long, gram long, at int, words int"
HITS = "text_key binary, gram long, at int"
FOUND = pa.schema([("text_key", pa.binary()), ("item_id", pa.int64()), ("score", pa.float64()), ("word_from", pa.int64()), ("word_to", pa.int64())])

_PLAIN = bytes(32 if c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 else c for c in range(256))


def plain_words(text: str | bytes | None) -> np.ndarray:
    """Hashes of the words of a text: lower case, ASCII punctuation as space."""
    if not text:
        return np.zeros(0, np.uint64)
    text = text.decode() if isinstance(text, bytes) else text
    return word_hashes(text.lower().encode().translate(_PLAIN).split())


def grams_of(words: np.ndarray) -> np.ndarray:
    """Seed hashes by position; a text shorter than a seed has one of all its words."""
    return window_hashes(words, min(SEED_WORDS, max(1, len(words))))


def local_alignment(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score of two word sequences and the passage position where it ends."""
    best, end = 0, 0
    row = np.zeros(len(item) + 1, np.int64)
    steps = np.arange(len(item) + 1) * -GAP
    for j, word in enumerate(passage):
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(item == word, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        # gaps along the item: the best earlier cell less its distance
        row = np.maximum.accumulate(new + steps) - steps
        top = int(row.max())
        if top > best:
            best, end = top, j
    return best, end


def insertions(length: int, threshold: float) -> int:
    """Most words beyond the item's that a passage can have within an alignment at or over the threshold."""
    return max(4, math.ceil(MATCH * length * (1 - threshold) / -GAP))


def reachable(item: np.ndarray, passage: np.ndarray, least: float, most_words: int) -> Iterator[tuple[int, int]]:
    """(from, end) of the parts of a passage that hold every alignment with a score of ``least`` or more.

    A passage word gains MATCH at most if the item has it and loses 1 if not, so the
    best sum of a run of words up to a position is over that of any alignment ending there.
    """
    total = np.cumsum(np.where(np.isin(passage, item), MATCH, max(MISMATCH, GAP)))
    lowest = np.minimum(np.minimum.accumulate(np.concatenate(([0], total[:-1]))), 0)
    ends = np.flatnonzero(total - lowest >= least) + 1
    if not len(ends):
        return
    starts = np.maximum(ends - most_words, 0)
    cuts = np.flatnonzero(starts[1:] > ends[:-1])
    yield from zip(starts[np.concatenate(([0], cuts + 1))].tolist(), ends[np.concatenate((cuts, [len(ends) - 1]))].tolist(), strict=True)


def best_passage(item: np.ndarray, words: np.ndarray, spans: list[tuple[int, int]], threshold: float) -> tuple[float, int, int]:
    """(score, first word, end word) of the best alignment within the spans; score 0 where none reaches the threshold."""
    windows: list[list[int]] = []
    for low, high in sorted((max(0, low), min(len(words), high)) for low, high in spans):
        if windows and low <= windows[-1][1]:
            windows[-1][1] = max(windows[-1][1], high)
        else:
            windows.append([low, high])
    most, best = MATCH * len(item), (0.0, 0, 0)
    for low, high in windows:
        passage = words[low:high]
        if MATCH * np.isin(item, passage).sum() < threshold * most:
            continue
        for start, stop in reachable(item, passage, threshold * most, len(item) + insertions(len(item), threshold)):
            score, end = local_alignment(item, passage[start:stop])
            if score / most > best[0]:
                best = (score / most, low + start, low + start + end + 1)
    return best if best[0] >= threshold else (0.0, 0, 0)


def distinct_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, item_id, item_text``: items with a text, repeated ones once, named by a hash of id and text."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("item_text")).filter(F.col("item_text").isNotNull()).distinct()
    return rows.select(F.xxhash64("item_id", "item_text").alias("item"), "item_id", "item_text")


def item_grams(items: DataFrame) -> DataFrame:
    """``item, gram, at, words``: the seed hashes of every item by position, and the item's length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("item", pa.int64()), ("gram", pa.int64()), ("at", pa.int32()), ("words", pa.int32())])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                    words = plain_words(text)
                    if len(words):
                        yield from ((item, gram, at, len(words)) for at, gram in enumerate(grams_of(words).view(np.int64).tolist()))

        yield from in_batches(rows(), schema)

    return items.select("item", "item_text").mapInArrow(cut, GRAMS)


def gram_filter(grams: DataFrame) -> np.ndarray:
    """Bits of the grams' leading bits: 16 MB, whatever the number of grams."""
    bit = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    pieces = grams.groupBy((bit / PIECE_BITS).cast("int").alias("piece")).agg(F.bitmap_construct_agg(bit % PIECE_BITS).alias("bits"))
    size = PIECE_BITS // 8
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in pieces.collect():
        out[row["piece"] * size : (row["piece"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def gram_hits(keyed: DataFrame, grams: DataFrame) -> DataFrame:
    """``text_key, gram, at``: places of the items' grams in ``keyed`` (``text_key, text``), and a few others that the filter lets by."""
    short = [r["words"] for r in grams.filter(F.col("words") < SEED_WORDS).select("words").distinct().collect()]
    widths = [*sorted(short), SEED_WORDS]
    shared = keyed.sparkSession.sparkContext.broadcast(gram_filter(grams))

    def hits_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words, found = plain_words(text), []
        for width in widths:
            hashes = window_hashes(words, width)
            bit = hashes >> np.uint64(64 - FILTER_BITS)
            at = np.flatnonzero(shared.value[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
            found.append((hashes[at].view(np.int64), at.astype(np.int32)))
        return np.concatenate([g for g, _ in found]), np.concatenate([a for _, a in found])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for n, text in enumerate(texts(batch.column(1))):
                own = hits_of(text)
                if len(own[0]):
                    rows.append((n, *own))
                    held += len(own[0])
                if held >= BATCH_HITS:
                    yield flat(batch, rows)
                    rows, held = [], 0
            if rows:
                yield flat(batch, rows)

    def flat(batch: pa.RecordBatch, rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        of = np.repeat([n for n, _, _ in rows], [len(g) for _, g, _ in rows])
        columns = [batch.column(0).take(pa.array(of)), pa.array(np.concatenate([g for _, g, _ in rows])), pa.array(np.concatenate([a for _, _, a in rows]))]
        return pa.RecordBatch.from_arrays(columns, names=["text_key", "gram", "at"])

    return keyed.select("text_key", "text").mapInArrow(scan, HITS)


def rare_seeds(grams: DataFrame, hits: DataFrame, n_docs: int) -> DataFrame:
    """The rows of ``grams`` that are seeds: found in the corpus, and rare there or for their item."""
    counted = grams.join(hits.groupBy("gram").agg(F.count("*").alias("found")), "gram")
    counts = F.array_sort(F.collect_list("found"))
    middle = counted.groupBy("item").agg(F.element_at(counts, ((F.count("*") + 1) / 2).cast("int")).alias("middle"))
    rare = (F.col("found") * RARE_DOCS <= n_docs) | (F.col("found") <= COMMON_TIMES * F.col("middle"))
    return counted.join(middle, "item").filter(rare).select(*grams.columns)


def candidates(seeds: DataFrame, hits: DataFrame, threshold: float) -> DataFrame:
    """``text_key, item, spans``: for each text and item that share a seed, the word ranges around the places."""
    slack = F.greatest(F.lit(4), F.ceil(F.col("words") * (MATCH * (1 - threshold) / -GAP)).cast("int"))
    reach = seeds.select("gram", "item", (F.col("at") + slack).alias("before"), (F.col("words") - F.col("at") + slack).alias("after"))
    span = F.struct((F.col("at") - F.col("before")).alias("low"), (F.col("at") + F.col("after")).alias("high"))
    return hits.join(reach, "gram").groupBy("text_key", "item").agg(F.collect_set(span).alias("spans"))


def aligned(rows: DataFrame, threshold: float) -> DataFrame:
    """``text_key, item_id, score, word_from, word_to`` of rows ``text_key, text, items`` (id, text and spans of each)."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in batches:
                for n, text in enumerate(texts(batch.column(1))):
                    key, words = batch.column(0)[n].as_py(), plain_words(text)
                    for own in batch.column(2)[n].as_py():
                        best = best_passage(plain_words(own["item_text"]), words, [(s["low"], s["high"]) for s in own["spans"]], threshold)
                        if best[0]:
                            yield (key, own["item_id"], *best)

        yield from in_batches(found(), FOUND)

    return rows.select("text_key", "text", "items").mapInArrow(align, "text_key binary, item_id long, score double, word_from long, word_to long")


def with_key(docs: DataFrame, name: str, text_col: str) -> DataFrame:
    """``docs`` with the 128-bit hash of the text as column ``name`` (null for a null text)."""
    return docs.withColumn(name, F.unhex(F.md5(F.col(text_col))))


def leaking_texts(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, threshold: float) -> DataFrame:
    """``text_key, item_id, score, word_from, word_to``: one row per different text of ``docs`` and item found in it."""
    items = stored(distinct_items(benchmark, item_col, item_text_col), "items")
    grams = stored(item_grams(items), "item_grams")
    keyed = with_key(docs.select(F.col(text_col).alias("text")), "text_key", "text").filter(F.col("text").isNotNull())
    hits = stored(gram_hits(keyed, grams), "gram_hits")
    found = stored(candidates(rare_seeds(grams, hits, docs.count()), hits, threshold), "candidates")
    blocks = -(-items.count() // BLOCK_ITEMS) or 1
    own = F.struct("item_id", "item_text", "spans")
    by_text = found.join(items, "item").groupBy("text_key", F.pmod("item", F.lit(blocks)).alias("block")).agg(F.collect_list(own).alias("items"))
    once = only(keyed, "text_key", found.select("text_key").distinct()).groupBy("text_key").agg(F.first("text").alias("text"))
    return stored(aligned(once.join(by_text, "text_key"), threshold), "leaks")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, word_from, word_to``: one row per document row and item found in it.

    score is the alignment's share of a full copy's (0 to 1), of the best passage;
    it lies between the given word positions (words in lower case, without ASCII
    punctuation). Null and empty texts hold nothing; items with a null text or
    without words are found nowhere; an item with a null id is reported as null. Repeated rows are judged one by one,
    repeated items as one. Further columns are ignored; empty tables give no rows.
    """
    leaks = leaking_texts(docs, benchmark, text_col, item_col, item_text_col, threshold)
    named = with_key(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text_key", "text")
    return named.select("doc_id", "text_key").join(leaks, "text_key").drop("text_key")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their columns as they are."""
    leaks = leaking_texts(docs, benchmark, text_col, "item_id", "text", threshold)
    key = unused(docs, "_text_key")
    return only(with_key(docs, key, text_col), key, leaks.select("text_key").distinct(), "left_anti").drop(key)
