"""Substring dedup by difference-cover anchors.

COVER is a difference cover modulo PERIOD: for any two positions i, j some shift
below PERIOD puts both on cover residues. So of any two equal windows of
``PERIOD - 1 + ANCHOR`` words, one in each of two documents, some ANCHOR-word
window lies at a cover position of both. Only windows at cover positions are
hashed and shuffled, 3 in 7. Where an anchor is in several documents, it is
extended to the 13-word windows around it; these are keyed by 96 bits of
hash, and the smallest document of each key keeps it. Whole copies of a text are
told by its hash beforehand: they lose all their windows and are first with none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm import common
from cartwheel.llm.common import WORD, after_first_holder, in_batches, only, plain_id, ranked_id, salted, stored, texts, window_hashes, word_count, word_hashes

WINDOW = 13
# A perfect difference set modulo 7: every residue is a difference of two members.
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
LOCAL_ROWS = 8


def anchor_positions(n_words: int) -> np.ndarray:
    at = np.arange(max(0, n_words - ANCHOR + 1))
    return at[np.isin(at % PERIOD, COVER)]


def starts_near(anchors: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the windows that hold one of the anchors at a shift below PERIOD."""
    near = np.zeros(max(0, n_words - WINDOW + 1) + PERIOD, bool)
    for shift in range(PERIOD):
        at = anchors - shift
        near[at[(at >= 0) & (at < len(near))]] = True
    return np.flatnonzero(near[: max(0, n_words - WINDOW + 1)])


def covered(starts: np.ndarray, n_words: int) -> np.ndarray:
    """Mask of the words inside a window that starts at one of ``starts``."""
    edges = np.zeros(n_words + 1, np.int64)
    starts = starts[starts + WINDOW <= n_words]
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return np.cumsum(edges)[:n_words] > 0


def _arrays(doc: int, n: int) -> pa.Array:
    return pa.array(np.full(n, doc, np.int64))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
            words = word_hashes((text or b"").split())
            if len(words) < WINDOW:
                continue
            at = anchor_positions(len(words))
            h = (window_hashes(words, ANCHOR)[at] >> np.uint64(16)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), _arrays(doc, len(at)), pa.array(at, pa.int32())], ["anchor", "doc_id", "pos"])


def anchors(docs: DataFrame) -> DataFrame:
    """``anchor, doc_id, pos`` at cover positions; 48 bits of hash, for an anchor only proposes."""
    return docs.select("doc_id", "text").mapInArrow(_merged(_anchor_rows), "anchor long, doc_id long, pos int")


def frequent(docs: DataFrame, rows) -> list[int]:
    """At most HEAVY_KEYS values in the first column of ``rows`` that hold HEAVY_ROWS rows or more.

    Every batch of texts reports what it saw LOCAL_ROWS times or more. As with
    ``heavy_keys``, the list only decides how a key is dealt.
    """
    least = min(LOCAL_ROWS, common.HEAVY_ROWS)

    def count(batches):
        for batch in batches:
            seen = [r.column(0).to_numpy() for r in rows([batch])]
            keys, n = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys[n >= least]), pa.array(n[n >= least].astype(np.int64))], ["key", "n"])

    counts = docs.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= common.HEAVY_ROWS)
    return [r["key"] for r in counts.orderBy(F.desc("n"), "key").limit(common.HEAVY_KEYS).collect()]


def _merged(run, rows: int = 65_536):
    """The same rows in larger batches."""

    def merged(batches):
        held, n = [], 0
        for batch in run(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return merged


def shared_anchors(docs: DataFrame, heavy: list[int]) -> DataFrame:
    """``doc_id, at`` : per document the positions of its anchors that several documents have.

    A heavy anchor counts as shared without a look; windows decide later.
    """
    found = anchors(docs)
    same = Window.partitionBy("anchor", "salt")
    runs = salted(found, "anchor", "doc_id", heavy).withColumn("low", F.min("doc_id").over(same)).withColumn("high", F.max("doc_id").over(same))
    both = runs.filter((F.col("low") < F.col("high")) | F.col("anchor").isin(heavy)).select("doc_id", "pos")
    return both.groupBy("doc_id").agg(F.collect_list("pos").alias("at"))


def _window_rows(heavy: list[int] | None = None):
    """Windows around the shared anchors ``at``, or, of any text, the windows that hold one of ``heavy`` anchors."""
    chosen = np.array(sorted(heavy or []), np.int64)

    def run(batches):
        for batch in batches:
            at = batch.column("at") if heavy is None else [None] * batch.num_rows
            for doc, text, own in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), at, strict=True):
                words = word_hashes((text or b"").split())
                if heavy is None:
                    near = own.values.to_numpy()
                else:
                    near = np.flatnonzero(np.isin((window_hashes(words, ANCHOR) >> np.uint64(16)).astype(np.int64), chosen))
                starts = starts_near(near, len(words))
                if not len(starts):
                    continue
                h1 = window_hashes(words, WINDOW)[starts].view(np.int64)
                h2 = (window_hashes(words, WINDOW, lane=1)[starts] >> np.uint64(33)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), _arrays(doc, len(starts)), pa.array(starts, pa.int32())], ["h1", "h2", "doc_id", "start"])

    return run


def whole_copies(docs: DataFrame) -> DataFrame:
    """Ids all of whose texts a smaller id has too: every window of theirs is a repeat, and nobody else's first."""
    hashed = docs.select("doc_id", F.unhex(F.md5("text")).alias("h"), F.unhex(F.sha1("text")).alias("h_more")).filter("h is not null")
    least = hashed.groupBy("h", "h_more").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").drop("most")
    least = stored(least, "least").withColumnRenamed("h", "l").withColumnRenamed("h_more", "l_more")
    rows = hashed.join(least, (F.col("h") == F.col("l")) & (F.col("h_more") == F.col("l_more")), "left")
    copies = rows.groupBy("doc_id").agg(F.min(F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))).alias("copy"))
    return stored(copies.filter("copy").select("doc_id"), "copies")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Per document the starts of windows that a document with a smaller id has too."""
    heavy = frequent(docs.select("doc_id", "text"), _anchor_rows)
    at = stored(shared_anchors(docs, heavy), "anchors")
    candidates = only(docs, "doc_id", at.select("doc_id"))
    # a window is as frequent as its anchors at most, so heavy windows hold a heavy anchor
    heavy = frequent(candidates.select("doc_id", "text"), _window_rows(heavy)) if heavy else []
    placed = candidates.join(at.withColumnRenamed("doc_id", "at_id"), F.col("doc_id") == F.col("at_id"))
    found = placed.select("doc_id", "text", "at").mapInArrow(_merged(_window_rows()), "h1 long, h2 int, doc_id long, start int")
    later = after_first_holder(found, ["h1", "h2"], "doc_id", heavy, ranged=False)
    return stored(later.groupBy("doc_id").agg(F.collect_list("start").alias("starts")), "windows")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_text`` (kept words joined by one space).

    Words are runs of other bytes than 0x20 and 0x09-0x0D, unchanged. A word goes
    when a 13-word window over it also starts in a document with a smaller
    id; windows are judged on the whole input. Null and short texts lose nothing. A null id
    is below all others. Rows that repeat an id are one document: their windows
    don't repeat each other, and a window start that one of them loses is lost in
    all. Further columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(ranked_id(F.col(id_col)).alias("doc_id"), F.col(text_col).alias("text"))
    copies = whole_copies(rows)
    kept_once = only(rows, "doc_id", copies, "left_anti")
    starts = repeated_windows(kept_once)
    # only documents that lose some of their words have their texts moved
    hit = starts.select("doc_id")
    touched = only(kept_once, "doc_id", hit).join(starts.withColumnRenamed("doc_id", "start_id"), F.col("doc_id") == F.col("start_id"), "left").select("doc_id", "text", "starts")
    whole = only(kept_once, "doc_id", hit, "left_anti").withColumn("starts", F.lit(None).cast("array<int>"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches):
        def out():
            for batch in batches:
                for doc, text, lost in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), batch.column("starts"), strict=True):
                    words = (text or b"").split()
                    removed = 0
                    if lost.is_valid:
                        gone = covered(np.unique(lost.values.to_numpy()), len(words))
                        removed = int(gone.sum())
                    kept = [w for w, g in zip(words, gone, strict=True) if not g] if removed else words
                    yield doc, len(words), removed, b" ".join(kept).decode()

        yield from in_batches(out(), schema)

    done = touched.unionByName(whole).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")
    gone = only(rows, "doc_id", copies).select("doc_id", word_count(F.col("text")).alias("n_words"), F.array_join(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), " ").alias("body"))
    short = F.col("n_words") < WINDOW
    gone = gone.select("doc_id", "n_words", F.when(short, 0).otherwise(F.col("n_words")).cast("long").alias("n_removed"), F.when(short, F.col("body")).otherwise("").alias("kept_text"))
    done = done.unionByName(gone)
    return done.withColumn("doc_id", plain_id(F.col("doc_id")))
