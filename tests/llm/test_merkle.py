import zlib

import pytest
from cases import lower_a, sha

from cartwheel.llm import merkle, queries
from cartwheel.llm.common import scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """The root, and each node's sibling texts, level by level."""
    paths, own, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, p in enumerate(own):
            low = p // 16 * 16
            paths[k].append(("".join(level[low:p]), "".join(level[p + 1 : low + 16])))
        own = [p // 16 for p in own]
        level = [sha("".join(level[k : k + 16])) for k in range(0, len(level), 16)]
    return (level or [None])[0], paths


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by_source[s], key=lambda x: x[:3]), *tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])])) for s in sources}
    root, above = tree([trees[s][1] for s in sources])
    out = []
    for k, s in enumerate(sources):
        rows, subroot, paths = trees[s]
        for (_, _, leaf, row), path in zip(rows, paths):
            tampered = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf_of((*row[:4], lower_a(row[4]))) if tampered else leaf
            for left, right in path + above[k]:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in path + above[k]))
            out.append((row[0], leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def query_rows(docs):
    rows = merkle.verified_documents(docs).withColumn("proof", merkle.F.sha2(merkle.proof_text(merkle.F.col("proof")), 256))
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def docs_of(spark, rows, extra=True):
    more = "group string, at long, node string, leaf string, m long, block string"
    data = [(*r, "g", 1, "n", "l", 2, "b") for r in rows] if extra else rows
    return spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string" + (", " + more if extra else ""))


@pytest.mark.parametrize("name", ["messy_docs", "small_docs", "no_docs"])
def test_documents(request, name):
    docs = request.getfixturevalue(name)
    assert query_rows(docs) == brute([tuple(r) for r in docs.select(*FIELDS).collect()])


@pytest.mark.parametrize("sizes", [(1,), (2,), (16,), (17,), (256,), (257,), (1, 1), (1, 272, 16, 5_000), (3,) * 300])
def test_sizes_of_sources(spark, sizes):
    names = [None, "", "é", "Z", "a", "=", "\U0001f600", "￿"]
    rows = [(1000 * s + k, names[s] if s < len(names) else f"s{s}", None if k % 3 else "en", k, f"Text {k}" if k % 7 else None) for s, size in enumerate(sizes) for k in range(size)]
    assert query_rows(docs_of(spark, rows).repartition(5)) == brute(rows)


def test_ties_and_null_ids(spark):
    rows = [(None, "s", None, None, "A"), (None, "s", None, None, "B"), (5, "s", "x", 1, "A"), (5, "s", "x", 1, "A"), (5, "s", "x", 1, "b"), (-3, "s", "", 0, ""), (7, None, None, None, None)]
    assert query_rows(docs_of(spark, rows)) == brute(rows)


def test_three_rounds_of_blocks(spark):
    """More than 256 blocks of one source."""
    docs = spark.range(70_000).selectExpr("id AS doc_id", "'hot' AS source", "'en' AS lang", "id AS n_chars", "concat('T', id) AS text")
    got = query_rows(docs)
    assert got == brute([tuple(r) for r in docs.collect()])


def test_a_written_manifest_proves_its_leaves_and_no_others(spark):
    rows = [(k, f"s{k % 3}", "en", k, f"text {k}") for k in range(900)]
    folder = scratch(spark, "manifest-test")
    merkle.write_manifest(merkle.document_leaves(docs_of(spark, rows, False)), folder, ["doc_id"])
    found = merkle.proofs(spark, folder)
    root = merkle.manifest_root(spark, folder)
    fold = lambda leaf: found.select((merkle.fold(leaf, merkle.F.col("proof")) == root).alias("ok")).distinct().collect()
    assert [r.ok for r in fold(merkle.F.col("leaf"))] == [True]
    assert [r.ok for r in fold(merkle.F.reverse("leaf"))] == [False]
    assert sorted(found.select("group", "at", "doc_id").collect()) == sorted((f"=s{k % 3}", k // 3, k) for k in range(900))


def test_query_columns(spark):
    assert queries.op13_merkle_manifest(spark, "/root/testdata/sf0.001").columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
