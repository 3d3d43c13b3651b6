"""Exact dedup by 128-bit content hash, with the bytes compared inside each group.

Rows are grouped by the MD5 of the normalised text (A-Z lower-cased, null as
empty). Only ids and hashes move in that step, pre-aggregated in the map tasks,
so a text that fills a third of the corpus costs one row per task. Texts of
groups with several rows are then compared byte by byte with the group's
representative (a join on the hash that AQE may split when one text is hot);
rows that merely share the hash are grouped again by their whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import lower_ascii, only, stored


def md5_bytes(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    content_hash: Callable[[Column], Column] = md5_bytes,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    keep: ``"min"`` or ``"max"``, the id that stays in a group of equal texts.
    A null text counts as empty. A null id is below every other id and keeps
    its group only when no other id is there. Repeated rows count each in
    group_size; all rows of the id that stays are reported as kept. An empty
    table gives no rows; further columns are ignored.
    """
    pick = {"max": F.max, "min": F.min}[keep]
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("body")).select("doc_id", content_hash(F.col("body")).alias("h"), "body")
    hashed = stored(rows.select("doc_id", "h", F.sha2("body", 256).alias("text_sha256")), "hashes")
    groups = hashed.groupBy("h").agg(pick("doc_id").alias("head"), F.count("*").alias("n"))

    # Only texts of groups with several rows are read again. The groups are kept in
    # a table, so that each join below stands between two plain shuffles and a hot
    # group's rows can be split.
    several = stored(groups.filter("n > 1"), "groups")
    ids = stored(hashed.join(several, "h", "left_semi").select("doc_id").distinct(), "copies")
    again = only(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body")), "doc_id", ids)
    again = again.withColumn("body", lower_ascii(F.coalesce("body", F.lit("")))).withColumn("h", content_hash(F.col("body")))
    of_head = several.select(F.col("h").alias("head_h"), "head")
    heads = again.join(of_head, (F.col("h") == F.col("head_h")) & F.col("doc_id").eqNullSafe(F.col("head")))
    heads = stored(heads.groupBy("h").agg(F.min("body").alias("head_body")), "heads")
    # collisions: equal hash, other bytes than the head's; kept in a table, for there are hardly ever any
    strays = stored(again.join(heads, "h").filter(F.col("body") != F.col("head_body")).select("doc_id", "h", "body"), "hash-collisions")

    found = hashed.join(several, "h", "left")
    found = found.withColumn("head", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("head"))).withColumn("n", F.coalesce("n", F.lit(1)))
    if strays.isEmpty():
        return found.select("doc_id", F.col("head").alias("keep_id"), F.col("n").cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("head")).alias("kept"), "text_sha256")

    lost = strays.groupBy("h").agg(F.count("*").alias("strays"))
    own = strays.groupBy("h", "body").agg(pick("doc_id").alias("stray_head"), F.count("*").alias("stray_n"))
    own = own.select(F.col("h").alias("stray_h"), F.sha2("body", 256).alias("stray_sha"), "stray_head", "stray_n")
    found = found.join(lost, "h", "left").join(own, (F.col("h") == F.col("stray_h")) & (F.col("text_sha256") == F.col("stray_sha")), "left")
    keep_id = F.when(F.col("stray_n").isNull(), F.col("head")).otherwise(F.col("stray_head"))
    size = F.when(F.col("stray_n").isNull(), F.col("n") - F.coalesce("strays", F.lit(0))).otherwise(F.col("stray_n"))
    return found.select(
        "doc_id",
        keep_id.alias("keep_id"),
        size.cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )
