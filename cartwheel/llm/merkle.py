"""Merkle manifest of a dataset: levels kept as strings of hex digests.

Rows are leaves in groups (sources). In a group every 16 consecutive nodes become
the digest of their concatenated hex texts until one is left, the group's root; the
groups' roots, in order, become the root of the dataset the same way.

A block of 256 consecutive nodes that starts at a multiple of 256 is one row, whose
levels are strings of 64 characters a node: fixed-width substrings of one level are
hashed to the next, and what stands left and right of a node in its run of 16 are
its siblings. A block gives one node, and the nodes of a group's blocks are the rows
of the next round, so a group of n rows takes log256(n) rounds and no task sees
more than a block of it. Positions are prefix sums over a range partitioning, which
deals a group that holds a third of all rows over as many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import scratch, stored

# Nodes under one parent, characters of a digest.
FAN = 16
HEX = 64
# Levels of a block below the node that it gives.
LEVELS = 2
BLOCK = FAN**LEVELS


def field(value: Column) -> Column:
    """One value as text that can't run into the next: ``-`` for null, else ``<UTF-8 bytes>:<value>``."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof, an array of (left, right) sibling texts from the leaf up."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def _group(column: Column) -> Column:
    """A group as text whose byte order is that of the groups, null first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a text column ``group``) with ``at``, the place in the group by ``order``, and ``m``, the group's rows.

    The rows are sorted within a range partitioning; each task's rows of a group
    follow those of the tasks before it. The windows see one row per group and task.
    """
    spark = rows.sparkSession
    placed = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "group", *order).sortWithinPartitions("group", *order)
    placed = stored(placed.withColumn("part", F.spark_partition_id()).withColumn("line", F.monotonically_increasing_id()), "ordered")
    parts = placed.groupBy("group", "part").agg(F.count("*").alias("n"), F.min("line").alias("first"))
    of_group = Window.partitionBy("group")
    before = F.coalesce(F.sum("n").over(of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("group", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(of_group).alias("m"))
    return placed.join(parts, ["group", "part"]).withColumn("at", F.col("line") + F.col("shift")).drop("part", "line", "shift")


def _parents(level: Column) -> Column:
    """The next level's string: every 16 digests of this one hashed."""
    run = lambda k: F.substring(level.cast("binary"), k * (FAN * HEX) + 1, F.lit(FAN * HEX))
    last = F.floor((F.length(level) - 1) / F.lit(FAN * HEX)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda k: F.sha2(run(k), 256)), "")


def _blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """``group, m, block, level0, level1, top, items`` of nodes ``group, m, at, node`` and carried columns.

    A group in one block ends there, at the level where one node is left; else
    every block goes up both levels.
    """
    items = F.array_sort(F.collect_list(F.struct("at", "node", *carried)))
    block = F.floor(F.col("at") / BLOCK).cast("long").alias("block")
    blocks = nodes.groupBy("group", "m", block).agg(items.alias("items"))
    blocks = blocks.withColumn("level0", F.array_join(F.col("items")["node"], ""))
    blocks = blocks.withColumn("level1", F.when(F.col("m") > 1, _parents(F.col("level0"))))
    top = F.when(F.col("m") <= 1, F.col("level0")).when(F.col("m") <= FAN, F.col("level1")).otherwise(F.sha2("level1", 256))
    return blocks.withColumn("top", top)


def _siblings(level: Column, place: Column) -> Column:
    """What stands left and right of a node in its run of 16, as fixed-width substrings of its level."""
    run = F.substring(level.cast("binary"), F.floor(place / FAN).cast("int") * (FAN * HEX) + 1, F.lit(FAN * HEX)).cast("string")
    mine = (place % FAN).cast("int") * HEX
    return F.struct(F.substring(run, F.lit(1), mine).alias("left"), F.substring(run, mine + HEX + 1, F.lit(FAN * HEX)).alias("right"))


_PROOF = "array<struct<left:string,right:string>>"


def _write_tree(leaves: DataFrame, folder: str, carried: list[str]) -> None:
    """Blocks of all rounds of ``group, m, at, node`` as ``folder/round=0`` and on."""
    spark = leaves.sparkSession
    nodes, n = leaves, 0
    while True:
        _blocks(nodes, carried if n == 0 else []).write.option("compression", "zstd").parquet(f"{folder}/round={n}")
        above = spark.read.parquet(f"{folder}/round={n}").filter(F.col("m") > BLOCK)
        if above.isEmpty():
            return
        nodes = above.select("group", F.ceil(F.col("m") / BLOCK).alias("m"), F.col("block").alias("at"), F.col("top").alias("node"))
        n += 1


def _rounds(spark: SparkSession, folder: str) -> list[DataFrame]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted((f.getPath().getName() for f in system.listStatus(path)), key=lambda name: int(name.split("=")[1]))
    return [spark.read.parquet(f"{folder}/{name}") for name in names]


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """``group, node``: the root of each group, from the round in which it ended."""
    return reduce(DataFrame.unionByName, [b.filter(F.col("m") <= BLOCK).select("group", F.col("top").alias("node")) for b in rounds])


def _paths(rounds: list[DataFrame], of_group: DataFrame, carried: list[str]) -> DataFrame:
    """``group, at, node, carried..., proof`` of every leaf; ``of_group`` has ``group, above``, the proof of each group's root.

    From the last round down: a group's last block takes the group's proof, other
    blocks that of their node a round above.
    """
    paths = None
    for n, blocks in reversed(list(enumerate(rounds))):
        ends = blocks.filter(F.col("m") <= BLOCK).join(of_group, "group")
        if paths is not None:
            on = paths.select("group", F.col("at").alias("block"), F.col("proof").alias("above"))
            ends = ends.unionByName(blocks.filter(F.col("m") > BLOCK).join(on, ["group", "block"]).select(*ends.columns))
        fields = ["at", "node", *(carried if n == 0 else [])]
        each = ends.select("group", "m", "level0", "level1", "above", F.posexplode("items").alias("place", "item"))
        own = F.when(F.col("m") <= 1, F.array().cast(_PROOF)).when(F.col("m") <= FAN, F.array(_siblings(F.col("level0"), F.col("place"))))
        own = own.otherwise(F.array(_siblings(F.col("level0"), F.col("place")), _siblings(F.col("level1"), F.floor(F.col("place") / FAN))))
        paths = each.select("group", *(F.col("item")[c].alias(c) for c in fields), F.concat(own, "above").alias("proof"))
    return paths


def write_manifest(leaves: DataFrame, folder: str, order: list[str], group: str = "source", carried: list[str] | None = None) -> None:
    """Write the manifest of ``leaves`` (a digest ``leaf`` and further columns) to ``folder``.

    Leaves of a group stand in the order of the columns ``order``, nulls first, ties
    by digest. ``folder/leaves`` and ``folder/groups`` hold the blocks of both
    trees, round by round. ``order`` and ``carried`` columns are kept with the leaves.
    """
    spark = leaves.sparkSession
    carried = [*order, *(carried or [])]
    rows = leaves.select(_group(F.col(group)).alias("group"), F.col("leaf").alias("node"), *(F.col(c).alias(f"_{c}") for c in carried))
    numbered = _numbered(rows, [*(f"_{c}" for c in order), "node"])
    _write_tree(numbered, f"{folder}/leaves", [f"_{c}" for c in carried])
    roots = _tops(_rounds(spark, f"{folder}/leaves")).withColumnsRenamed({"group": "_group"}).withColumn("group", F.lit(""))
    _write_tree(_numbered(roots, ["_group"]), f"{folder}/groups", ["_group"])


def manifest_root(spark: SparkSession, folder: str) -> str | None:
    """The root of the dataset, null for an empty one."""
    row = _tops(_rounds(spark, f"{folder}/groups")).first()
    return row["node"] if row else None


def proofs(spark: SparkSession, folder: str) -> DataFrame:
    """A row per leaf of a written manifest: ``group, at, leaf, subroot, root, proof`` and the columns kept with it.

    group: null groups as empty text, others after ``=``; at: place in the group;
    proof: for ``fold``, through the group's root to the dataset's.
    """
    groups = _rounds(spark, f"{folder}/groups")
    top = groups[0].select(F.lit("").alias("group"), F.array().cast(_PROOF).alias("above")).limit(1)
    of_group = _paths(groups, top, ["_group"]).select(F.col("_group").alias("group"), F.col("node").alias("subroot"), F.col("proof").alias("above"))
    leaves = _rounds(spark, f"{folder}/leaves")
    kept = [f.name for f in leaves[0].schema["items"].dataType.elementType.fields if f.name not in ("at", "node")]
    paths = _paths(leaves, of_group.select("group", "above"), kept)
    names = [F.col(c).alias(c[1:]) for c in kept]
    root = F.lit(manifest_root(spark, folder)).cast("string").alias("root")
    return paths.join(of_group.select("group", "subroot"), "group").select("group", "at", F.col("node").alias("leaf"), "subroot", root, "proof", *names)


def manifest(leaves: DataFrame, order: list[str], group: str = "source", carried: list[str] | None = None) -> DataFrame:
    """``proofs`` of a manifest of ``leaves`` written to the shared folder."""
    folder = scratch(leaves.sparkSession, "manifest")
    write_manifest(stored(leaves, "leaves"), folder, order, group, carried)
    return proofs(leaves.sparkSession, folder)


def document_leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, source, leaf, claimed``: each document's digest, and that of the document as handed over for a check.

    The latter differs where 5 divides the CRC-32 of the decimal doc_id: there A-Z
    of the text came lower-cased. A null doc_id or text is handed over as it is.
    """
    digest = lambda text: row_digest(*(docs[c] for c in ("doc_id", "source", "lang", "n_chars")), text)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(docs["doc_id"].cast("string")) % 5 == 0
    claimed = F.when(tampered, digest(F.translate(docs["text"], upper, upper.lower()))).otherwise(F.col("leaf"))
    return docs.withColumn("leaf", digest(docs["text"])).select(docs["doc_id"], docs["source"], "leaf", claimed.alias("claimed"))


def verified_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root, verified``: every document, as claimed, held against the manifest.

    One row per document; a document that is there several times has a leaf each
    time. Null ids come first in their source, null sources are a source of their
    own before the others; any other column may be null or be further ones, which
    are ignored. An empty table gives no rows.
    """
    found = manifest(document_leaves(docs), ["doc_id"], "source", ["claimed"])
    found = found.withColumn("folded_root", fold(F.col("claimed"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def proof_text(proof: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")
