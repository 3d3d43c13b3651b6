import collections

import pytest
from cases import as_docs, pairs_of, words
from pyspark.sql import functions as F

from cartwheel.llm import mixing
from cartwheel.llm.mixing import mix, mixed_documents, schedule, source_targets


def filled(sizes):
    """Targets by repeated capping and resharing, in plain Python."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, free, target = float(sum(sizes.values())), set(names), {}
    while free:
        whole = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / whole > 3 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / whole for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            free.remove(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 50, None: 7}, {"a": 10}, {"a": 0, "b": 0}, {f"s{i}": 10 * i for i in range(30)}, {"z": 1, "y": 1000, "x": 1}])
def test_targets_are_the_fixed_point_of_resharing(spark, sizes):
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_rows long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = filled(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)


@pytest.mark.parametrize("name", ["messy_docs", "small_docs", "no_docs"])
def test_mix(request, name):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    sizes = collections.Counter()
    for i, t, s in rows:
        sizes[(i, s)] += len(words(t))
    per = collections.Counter()
    for (i, s), n in sizes.items():
        per[s] += n
    got = mix(docs, block_words=16).collect()
    assert {(r.doc_id, r.source): r["size"] for r in got} == dict(sizes) and len(got) == len(sizes)
    want, taken = filled(per), collections.Counter()
    for r in got:
        assert r.source_size == per[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s in per:
        assert abs(taken[s] - want[s]) <= 16 * 4
    assert sorted(got, key=repr) == sorted(mix(docs.repartition(3), block_words=16).collect(), key=repr)


def test_buckets_do_not_change_the_mix(small_docs, monkeypatch):
    whole = sorted(mix(small_docs).collect(), key=repr)
    monkeypatch.setattr(mixing, "SLOTS_A_BUCKET", 7)
    assert sorted(mix(small_docs).collect(), key=repr) == whole


def test_schedule_keeps_shares_from_the_start(spark):
    targets = spark.createDataFrame([(0, 60.0 * 256), (1, 30.0 * 256), (2, 10.0 * 256)], "sid int, target double")
    slots = sorted((r.slot, r.sid, r.rank) for r in schedule(targets).collect())
    assert [s for s, _, _ in slots] == list(range(100))
    seen = collections.Counter()
    for n, (_, sid, rank) in enumerate(slots, 1):
        assert rank == seen[sid]
        seen[sid] += 1
        assert all(abs(seen[s] - n * share) < 3 for s, share in ((0, 0.6), (1, 0.3), (2, 0.1)))


def test_mixed_documents_come_as_often_as_taken(messy_docs):
    out = mixed_documents(messy_docs, block_words=16)
    assert out.columns == messy_docs.columns
    times = collections.Counter((r.doc_id, r.source) for r in out.filter("doc_id between 20 and 59").collect())
    for r in mix(messy_docs, block_words=16).filter(F.col("doc_id").between(20, 59)).collect():
        want = int(r.taken / r["size"] + 0.5) if r["size"] else 0
        assert times[(r.doc_id, r.source)] == want


def test_own_columns_of_the_mix_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 5, 6)], "doc_id long, text string, source string, _mix_times int, _mix_copy int")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} <= {(1, "a b c", "s", 5, 6)}
