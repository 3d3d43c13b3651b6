"""Line dedup: first occurrences found over range-partitioned line hashes.

Every line of at least ``min_chars`` code points becomes (128-bit hash, document,
position). The rows are range-partitioned by hash with a secondary sort by
document and position; the first document of each hash streams from the sorted
run. Hashes that a sketch finds heavy are dealt over several runs (see
``common.after_first_holder``). What comes back to a document is not text but its
keep bitmap, compressed as runs of kept lines, and only for documents that lose
a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import SPACES, after_first_holder, heavy_keys, lower_ascii, ranked_id, stored

MIN_CHARS = 10


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    lines = docs.select(ranked_id(F.col(id_col)).alias("doc_id"), F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
    keyed = lines.select("doc_id", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    # the second hash starts from another state, so the pair is a 128-bit key
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "pos")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, pos`` of the lines whose key a document with a smaller id has too."""
    # read several times (sketch, range bounds, both ways): hash the lines once
    hashes = stored(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    return after_first_holder(hashes, ["h1", "h2"], "doc_id", heavy_keys(hashes, "h1")).select("doc_id", "pos")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document that loses lines: ``doc_id, n_dropped, drop_from, drop_to``.

    The bitmap of a document is stored as the runs of its cleared bits: run i
    covers lines ``drop_from[i]`` to ``drop_to[i]``, both included, in rising order.
    """
    lost = dropped_lines(docs, id_col, text_col, min_chars).groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    at = lambda i: F.get(F.col("p"), i)
    return lost.select(
        "doc_id",
        F.size("p").cast("long").alias("n_dropped"),
        F.filter("p", lambda x, i: F.coalesce(at(i - 1) != x - 1, F.lit(True))).alias("drop_from"),
        F.filter("p", lambda x, i: F.coalesce(at(i + 1) != x + 1, F.lit(True))).alias("drop_to"),
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, kept_text``.

    A line's key is the line stripped of 0x20 and 0x09-0x0D at both ends, A-Z
    lower-cased. Keys of ``min_chars`` code points or more stay only in the
    smallest doc_id that holds them, there with all their lines. Null and empty
    texts are one empty line. Null ids sort below all others and count as one
    document; rows that repeat an id are one document for the keys they hold,
    and a line position dropped in one of them is dropped in all. A text
    that loses every line becomes empty with all its lines dropped. Further
    columns are ignored; an empty table gives no rows.
    """
    runs = keep_bitmaps(docs, id_col, text_col, min_chars).withColumnRenamed("doc_id", "run_doc")
    rows = docs.select(F.col(id_col).alias("doc_id"), split_lines(F.col(text_col)).alias("lines"))
    rows = rows.join(runs, F.col("doc_id") == F.col("run_doc"), "left")  # a null id is the smallest and loses nothing
    rows = rows.select("doc_id", "lines", F.size("lines").alias("n"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "drop_from", "drop_to")
    # kept runs lie between the dropped ones: one slice a run, linear in the text
    begins = F.concat(F.array(F.lit(0)), F.transform("drop_to", lambda x: x + 1))
    ends = F.concat("drop_from", F.array("n"))
    kept = F.flatten(F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")), lambda r: F.slice("lines", r["b"] + 1, r["e"] - r["b"])))
    return rows.select(
        "doc_id",
        F.col("n").cast("long").alias("n_lines"),
        "n_dropped",
        F.when(F.col("drop_from").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
