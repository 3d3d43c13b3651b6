"""Exact, line and substring dedup against brute force."""

import pytest
from cases import SPACES, lower_a, order, pairs_of, sha, words
from pyspark.sql import functions as F

from cartwheel.llm import common
from cartwheel.llm.exact import exact_dedup
from cartwheel.llm.lines import keep_bitmaps, line_dedup
from cartwheel.llm.substrings import COVER, PERIOD, substring_dedup

MIN = -(1 << 63)


@pytest.fixture(params=["messy_docs", "small_docs", "no_docs"])
def docs(request):
    return request.getfixturevalue(request.param)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def brute_exact(pairs, pick):
    groups = {}
    for i, t in pairs:
        groups.setdefault(lower_a(t or ""), []).append(i)
    out = []
    for body, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = pick(known) if known else None
        out += [(i, keep, len(ids), i == keep, sha(body)) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,pick", [("max", max), ("min", min)])
def test_exact(docs, keep, pick):
    got = rows_of(exact_dedup(docs, keep=keep), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute_exact(pairs_of(docs), pick)


def test_exact_tells_colliding_texts_apart(messy_docs):
    weak = lambda text: F.length(text) % 7
    got = rows_of(exact_dedup(messy_docs.filter("doc_id is not null"), content_hash=weak), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute_exact([p for p in pairs_of(messy_docs) if p[0] is not None], max)


def brute_lines(pairs):
    key = lambda line: lower_a(line.strip(SPACES))
    first = {}
    for i, t in sorted(pairs, key=lambda p: order(p[0])):
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                first.setdefault(key(line), i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if first.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("heavy", [False, True])
def test_lines(docs, heavy, monkeypatch):
    if heavy:  # every hash seen three times takes the pre-aggregated way
        monkeypatch.setattr(common, "HEAVY_ROWS", 3)
    got = rows_of(line_dedup(docs), "doc_id", "n_lines", "n_dropped", "kept_text")
    want = brute_lines(pairs_of(docs))
    # rows that repeat an id are dealt with together: the messy ones are equal but for the null ids, which lose nothing
    assert got == sorted(want, key=repr)


def test_line_bitmaps_are_runs(spark):
    line = "a line of some length"
    docs = spark.createDataFrame([(1, line), (2, f"{line}\n{line}\nx\n{line}"), (3, "x")], "doc_id long, text string")
    rows = [(r.doc_id, r.n_dropped, list(r.drop_from), list(r.drop_to)) for r in keep_bitmaps(docs).collect()]
    assert rows == [(2, 3, [0, 3], [1, 3])]


def brute_windows(pairs):
    first = {}
    for i, t in sorted(pairs, key=lambda p: order(p[0])):
        w = words(t)
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p : p + 13]), i)
    out = []
    for i, t in pairs:
        w = words(t)
        gone = set()
        for p in range(len(w) - 12):
            if order(first[tuple(w[p : p + 13])]) < order(i):
                gone.update(range(p, p + 13))
        out.append((i, len(w), len(gone), b" ".join(x for p, x in enumerate(w) if p not in gone).decode()))
    return out


def test_the_cover_holds_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


@pytest.mark.parametrize("heavy", [False, True])
def test_substrings(docs, heavy, monkeypatch):
    if heavy:
        monkeypatch.setattr(common, "HEAVY_ROWS", 3)
    got = rows_of(substring_dedup(docs), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == sorted(brute_windows(pairs_of(docs)), key=repr)


def test_substrings_without_the_broadcast(messy_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_IDS", -1)
    got = rows_of(substring_dedup(messy_docs), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == sorted(brute_windows(pairs_of(messy_docs)), key=repr)
