"""N-gram Jaccard join over a prefix tree.

A document is its set of distinct 5-word shingles in one global order: shingles
that are frequent in the corpus come last, all others by hash. Sets of
similarity 0.75 share one of their first ``n // 4 + 1`` shingles, and ``k`` of their
first ``n // 4 + k``; with k = ``n // 16 + 1`` a set meets others by the shingles of
its prefix, under length and position bounds. Candidates of one set are stored
in a tree by their ordered shingles; the set walks down the tree, shared prefixes
are counted once, and subtrees go when the shingles left can't reach the overlap
needed.

Only components are asked for, so sets that are connected already aren't compared
again. First the sets at a prefix shingle are compared with one of them. Sets of
different components that meet less often than similar ones must are dropped,
over and over; those left meet in blocks of trees.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.bpe import ranges
from cartwheel.llm.common import BROADCAST_IDS, only, plain_id, ranked_id, stored, texts, window_hashes, word_hashes
from cartwheel.llm.substrings import _merged

SHINGLE = 5
# J >= 3/4  <=>  7 * overlap >= 3 * (size + size)
GROUP_SETS = 256
LAST_SHINGLES = 200_000
LAST_COUNT = 8
# Similar sets of n shingles meet at n // MORE + 1 shingles at least.
MORE = 16
PRUNINGS = 3


def shingle_set(text: bytes | None) -> np.ndarray:
    """Distinct shingle hashes of 63 bits, sorted; a text of fewer words is one shingle, one without words none."""
    words = word_hashes((text or b"").lower().split())
    return _distinct(window_hashes(words, min(SHINGLE, len(words))) >> np.uint64(1)) if len(words) else words


def _distinct(values: np.ndarray) -> np.ndarray:
    """``np.unique`` by sorting, which takes a fifth of the time of its hash table for a text's shingles."""
    values = np.sort(values)
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set, as two longs."""
    one, two = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(one), int(two)


def in_order(shingles: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Shingles as keys that sort in the global order; ``last``: (hash, rank) of the frequent ones, sorted by hash."""
    if not len(last):
        return shingles
    at = np.searchsorted(last[:, 0], shingles)
    at[at == len(last)] = 0
    return np.sort(np.where(last[at, 0] == shingles, last[at, 1] | np.uint64(1 << 63), shingles))


def prefix_length(n: int) -> int:
    return n // 4 + n // MORE + 1


def least_meetings(size: str) -> str:
    """SQL: at how many prefix shingles a set of this size meets any similar one, which has 3/4 of its size at least."""
    return f"({size} * 3 + 3) div 4 div {MORE} + 1"


class Node(NamedTuple):
    run: np.ndarray  # shingles every set below shares from here on
    members: list[int]  # sets that end here
    children: list["Node"]
    shortest: int
    longest: int
    labels: frozenset  # of the sets below


def prefix_tree(sets: list[np.ndarray], labels: list | None = None) -> Node:
    """Tree of ordered sets; a node holds the whole run up to the next fork."""
    labels = labels or [None] * len(sets)
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())

    def build(part: list[int], depth: int) -> Node:
        a, b = sets[part[0]], sets[part[-1]]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[depth:n] != b[depth:n])
        fork = depth + int(differ[0]) if len(differ) else n
        ends = [i for i in part if len(sets[i]) == fork]
        rest = [i for i in part if len(sets[i]) > fork]
        forks = [k for k in range(len(rest)) if k == 0 or sets[rest[k]][fork] != sets[rest[k - 1]][fork]]
        below = [build(rest[k:e], fork) for k, e in zip(forks, [*forks[1:], len(rest)], strict=False)]  # none where nothing is left
        lengths = [len(sets[i]) for i in part]
        return Node(a[depth:fork], ends, below, min(lengths), max(lengths), frozenset(labels[i] for i in part))

    return build(order, 0)


def similar_in_tree(tree: Node, probe: np.ndarray, skip: set | frozenset = frozenset()) -> Iterator[int]:
    """Sets of the tree that are similar to ``probe``; subtrees whose labels are all in ``skip``, which may grow, are left out."""
    open_nodes = [(tree, 0, 0)] if len(probe) else []  # an empty set is similar to none
    while open_nodes:
        node, depth, overlap = open_nodes.pop()
        if skip and node.labels <= skip:
            continue
        if 4 * min(node.longest, len(probe)) < 3 * max(node.shortest, len(probe)) and (4 * node.longest < 3 * len(probe) or 4 * len(probe) < 3 * node.shortest):
            continue
        behind = len(probe)
        # what the rest of the longest set below, or of the probe, could add
        hopeless = lambda: 7 * (overlap + min(node.longest - depth, behind)) < 3 * (max(node.shortest, -(-3 * len(probe) // 4)) + len(probe))  # noqa: B023, E731
        # so many shingles of a long run tell most sets that aren't similar
        cut = max(0, prefix_length(node.longest) - depth)
        for run in (node.run[:cut], node.run[cut:]):
            if len(run):
                at = np.searchsorted(probe, run)
                at[at == len(probe)] = 0
                overlap += int(np.count_nonzero(probe[at] == run))
                depth += len(run)
                behind = len(probe) - int(np.searchsorted(probe, run[-1], "right"))
                if hopeless():
                    break
        else:
            yield from (i for i in node.members if 7 * overlap >= 3 * (depth + len(probe)))
            open_nodes += [(child, depth, overlap) for child in node.children]


def shapes(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, n_shingles, h1, h2`` (128-bit hash of the set) per row, and the shingles that come last in the order.

    A task reports the shingles that it saw more than once. The LAST_SHINGLES most
    reported ones come last, by their count. Any order gives the same links; this
    one keeps shared passages out of the prefixes.
    """

    def run(batches):
        for batch in batches:
            ids, sizes, one, two, all_sets = [], [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                s = shingle_set(text)
                ids.append(doc)
                sizes.append(len(s))
                h1, h2 = set_hash(s)
                one.append(h1)
                two.append(h2)
                all_sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array([True] * len(ids))], ["doc_id", "n_shingles", "h1", "h2", "is_set"])
            if all_sets:
                seen, n = np.unique(np.concatenate(all_sets), return_counts=True)
                seen, n = seen[n > 1], n[n > 1]
                zero = pa.array(np.zeros(len(seen), np.int64))
                yield pa.RecordBatch.from_arrays([zero, pa.array(n.astype(np.int64)), pa.array(seen.view(np.int64)), zero, pa.array(np.zeros(len(seen), bool))], ["doc_id", "n_shingles", "h1", "h2", "is_set"])

    both = stored(docs.mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, is_set boolean"), "shapes")
    often = both.filter("not is_set").groupBy("h1").agg(F.sum("n_shingles").alias("n")).filter(F.col("n") >= LAST_COUNT)
    often = often.orderBy(F.desc("n"), "h1").limit(LAST_SHINGLES).select("h1").toPandas()["h1"].to_numpy(np.int64).view(np.uint64)
    last = np.stack([often, np.arange(len(often), 0, -1).astype(np.uint64)], axis=1)
    # column by column: a search in a column that isn't in one piece copies it first, for every document
    return both.filter("is_set").drop("is_set"), np.asfortranarray(last[np.argsort(last[:, 0])])


def prefixes(docs: DataFrame, last) -> DataFrame:
    """``key, doc_id, size, pos``: the prefix of every set. Of equal sets in one task one is enough, for they meet by their hash."""

    def run(batches):
        seen = set()
        for batch in batches:
            ids, sizes, keys = [], [], [np.zeros(0, np.uint64)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                ordered = in_order(shingle_set(text), last.value)
                mark = set_hash(ordered)
                if not len(ordered) or mark in seen:
                    continue
                seen.add(mark)
                ids.append(doc)
                sizes.append(len(ordered))
                keys.append(ordered[: prefix_length(len(ordered))].copy())
            n = np.fromiter(map(len, keys[1:]), np.int64, len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(ids, np.int64), n)), pa.array(np.repeat(np.array(sizes, np.int32), n)), pa.array(ranges(np.zeros(len(n), np.int64), n).astype(np.int32))], ["key", "doc_id", "size", "pos"])

    return docs.mapInArrow(_merged(run), "key long, doc_id long, size int, pos int")


def meetings(docs: DataFrame, last) -> DataFrame:
    """``key, doc_id, size, pos, head``: rows of prefix shingles that several sets have, each with one of them, the same at most shingles."""
    ranked = Window.partitionBy("key").orderBy(F.xxhash64("doc_id"), "doc_id")
    met = prefixes(docs, last).withColumn("n", F.row_number().over(ranked)).withColumn("next", F.lead("doc_id").over(ranked))
    met = met.withColumn("head", F.first(F.struct("doc_id", "size", "pos")).over(ranked)).filter("n > 1 or next is not null").drop("n", "next")
    return stored(met, "met")


def bounds(a: str, b: str) -> str:
    """SQL: may the sets of two prefix rows be similar if this is the first shingle they share?"""
    return (
        f"4 * least({a}.size, {b}.size) >= 3 * greatest({a}.size, {b}.size)"
        f" and 7L * least({a}.size - {a}.pos, {b}.size - {b}.pos) >= 3L * ({a}.size + {b}.size)"
    )


def with_texts(dealt: DataFrame, docs: DataFrame) -> DataFrame:
    """``dealt`` with the texts of its ``doc_id``; the texts stay where they are while a count shows that ``dealt`` can be broadcast."""
    dealt = stored(dealt, "dealt")
    if dealt.count() <= BROADCAST_IDS:
        dealt = F.broadcast(dealt)
    else:
        docs = only(docs, "doc_id", stored(dealt.select("doc_id").distinct(), "candidates"))
    bodies = docs.select(F.col("doc_id").alias("body_id"), "text")
    return bodies.join(dealt, F.col("doc_id") == F.col("body_id")).drop("body_id")


def similar_pairs(pairs: DataFrame, docs: DataFrame, last) -> DataFrame:
    """The pairs ``a, b`` whose texts are similar. All b of one a share trees of up to about GROUP_SETS sets."""
    per = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP_SETS).alias("groups")).withColumnRenamed("a", "per_a")
    dealt = pairs.join(per, F.col("a") == F.col("per_a")).select("a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("part"))
    probes = dealt.select("a", "part", F.lit(None).cast("long").alias("b"), F.col("a").alias("doc_id")).distinct()
    rows = with_texts(probes.unionByName(dealt.withColumn("doc_id", F.col("b"))), docs)

    def match(group: pa.Table) -> pa.Table:
        a, b = group.column("a")[0].as_py(), group.column("b").to_pylist()
        sets = [in_order(shingle_set(t), last.value) for t in texts(group.column("text"))]
        # one text an id, but for rows that repeat an id: then any of them may link it
        probes = [s for s, i in zip(sets, b, strict=True) if i is None]
        members = [(i, s) for s, i in zip(sets, b, strict=True) if i is not None]
        tree = prefix_tree([s for _, s in members]) if members else None
        found = sorted({members[k][0] for probe in probes for k in similar_in_tree(tree, probe)}) if tree else []
        return pa.table({"a": pa.array([a] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return stored(rows.groupBy("a", "part").applyInArrow(match, "a long, b long"), "links")


def similar_in_groups(members: DataFrame, docs: DataFrame, last) -> DataFrame:
    """Links ``a, b`` that connect the ``part``s of each group of ``head, doc_id, part``, as far as its sets are similar.

    A group is cut into blocks of about GROUP_SETS sets, and every two blocks meet
    in a task: one as a tree, the sets of the other walking it. Once two parts are
    linked they count as one, so a task gives fewer links than it has sets.
    """
    per = members.groupBy("head").agg(F.ceil(F.count("*") / GROUP_SETS).cast("int").alias("blocks")).withColumnRenamed("head", "per_head")
    dealt = members.join(per, F.col("head") == F.col("per_head")).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("head", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "doc_id", "part")
    rows = with_texts(dealt, docs)

    def match(group: pa.Table) -> pa.Table:
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        own, ids, parts = (group.column(c).to_pylist() for c in ("own", "doc_id", "part"))
        sets = [in_order(shingle_set(t), last.value) for t in texts(group.column("text"))]
        stored_sets = [k for k, o in enumerate(own) if o == high]
        found = []
        if stored_sets:
            tree = prefix_tree([sets[k] for k in stored_sets], [parts[k] for k in stored_sets])
            joined = {p: {p} for p in parts}  # part to all parts it is linked to by now
            for k, o in enumerate(own):
                if o != low:
                    continue
                same = joined[parts[k]]
                for i in similar_in_tree(tree, sets[k], same):
                    j = stored_sets[i]
                    if parts[j] not in same:
                        found.append((ids[k], ids[j]))
                        more = joined[parts[j]]
                        same |= more
                        for p in more:
                            joined[p] = same
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return stored(rows.groupBy("head", "low", "high").applyInArrow(match, "a long, b long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``a, b``: the smallest node each reaches.

    Alternating large-star and small-star steps, every round a written table, until
    the edges stay the same; a node with many links is only aggregated and joined on.
    """
    spark = edges.sparkSession
    edges, mark = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), None
    edges = stored(edges, "edges")
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "at")
        large = both.join(least, F.col("u") == F.col("at")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: all smaller neighbours of a node, and the node, get the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "at")
        small = large.join(low, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored(small.union(low.select(F.col("at").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return stored(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots), "components")
        mark = now


def relabelled(table: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``table`` with the ids of ``column`` replaced by their component where ``labels`` has one."""
    own = labels.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    if labels.count() <= BROADCAST_IDS:
        own = F.broadcast(own)
    joined = table.join(own, table[column] == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_component", column)).drop("_node", "_component")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    A-Z is lower-cased; words are runs of other bytes than 0x20 and 0x09-0x0D. Two
    documents are linked at Jaccard similarity 0.75 or more of their shingle
    sets; component_id is the smallest id reachable by links. Null and empty texts
    have 0 shingles and no link. A null id counts as the smallest id and is
    reported as null. Rows that repeat an id are one node; a further copy of it adds
    nothing. Further columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(ranked_id(F.col(id_col)).alias("doc_id"), F.col(text_col).alias("text"))
    shape, last = shapes(rows)
    shared = spark.sparkContext.broadcast(last)

    # equal sets: one class each, whatever its size
    classes = shape.filter("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # a table of its own, so that the join can split the rows of a hot class
    classes = stored(classes, "classes").withColumnRenamed("h1", "c1").withColumnRenamed("h2", "c2")
    placed = shape.join(classes, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")) & (F.col("n_shingles") > 0), "left")
    placed = stored(placed.select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("first")), "placed")
    # a copy stands for the first of its class; rows that repeat an id with different texts are one node of their own
    firsts = stored(placed.groupBy("doc_id").agg(F.min("first").alias("a"), F.max("first").alias("most")), "firsts")
    copies = stored(firsts.filter("a = most and a <> doc_id").select(F.col("doc_id").alias("node"), F.col("a").alias("component")), "copies")
    several = firsts.filter("a < most").select(F.col("doc_id").alias("several_id"))
    same_id = placed.join(several, F.col("doc_id") == F.col("several_id")).filter("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    same_id = stored(same_id.distinct(), "same-ids")

    # one set of each prefix shingle is compared with the others that have it
    met = meetings(rows, shared)
    pairs = met.filter("doc_id <> head.doc_id").withColumn("row", F.struct("size", "pos")).filter(bounds("head", "row")).select(F.col("head.doc_id").alias("a"), F.col("doc_id").alias("b"))
    pairs = relabelled(relabelled(pairs.distinct(), "a", copies), "b", copies).filter("a <> b").distinct()
    links = same_id.union(similar_pairs(stored(pairs, "pairs"), rows, shared))
    labels = components(links)

    # Sets of different components that are similar meet at least_meetings() shingles.
    nodes = relabelled(met.select("key", F.col("head.doc_id").alias("head"), "doc_id", "size"), "doc_id", copies)
    nodes = relabelled(nodes.withColumn("part", F.col("doc_id")), "part", labels)
    of_key, of_doc = Window.partitionBy("key"), Window.partitionBy("doc_id")
    for _ in range(PRUNINGS):
        # a copy's row that now repeats the one of its class goes, and shingles of one component
        nodes = nodes.withColumn("before", F.lag("doc_id").over(of_key.orderBy("doc_id", "size"))).withColumn("low", F.min("part").over(of_key)).withColumn("high", F.max("part").over(of_key))
        nodes = nodes.filter("low < high and (before is null or before <> doc_id)").select("key", "head", "doc_id", "size", "part")
        nodes = nodes.withColumn("n", F.count("*").over(of_doc)).withColumn("least", F.min("size").over(of_doc))
        nodes = stored(nodes.filter(f"n >= {least_meetings('least')}").drop("n", "least"), "nodes")
    # What is left is compared for good: all sets that met the same one are a group.
    more = similar_in_groups(stored(nodes.select("head", "doc_id", "part").distinct(), "groups"), rows, shared)
    if not more.isEmpty():
        labels = components(links.union(more))

    out = placed.withColumnRenamed("first", "component_id")
    out = relabelled(out, "component_id", labels)
    return out.select(plain_id(F.col("doc_id")).alias("doc_id"), "n_shingles", plain_id(F.col("component_id")).alias("component_id"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with their columns as they are."""
    found = jaccard_components(docs, id_col, text_col)
    stay = stored(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stay")).distinct(), "stay")
    return only(docs, id_col, stay)
