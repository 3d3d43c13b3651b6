import random

import numpy as np
import pytest
from cases import SMALL, as_docs

from cartwheel.llm import decontaminate
from cartwheel.llm.decontaminate import GAP, MATCH, MISMATCH, contaminated, decontaminated, local_alignment, plain_words


def brute_alignment(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (MATCH if a[i - 1] == b[j - 1] else MISMATCH), table[i - 1][j] + GAP, table[i][j - 1] + GAP)
    return max(map(max, table))


def test_alignment_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        assert local_alignment(np.array(a, np.uint64), np.array(b, np.uint64))[0] == brute_alignment(a, b)


def brute(docs, items, threshold):
    """Every document against every item, whole texts."""
    out = set()
    for i, t in docs:
        words = plain_words(t)
        for item, text in items:
            own = plain_words(text)
            if not len(own) or not len(words):
                continue
            if local_alignment(own, words)[0] / (MATCH * len(own)) >= threshold:
                out.add((i, item))
    return out


def edited(text, rng, share):
    words = text.split()
    for _ in range(int(share * len(words))):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(99)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(7)
    prose = lambda n: " ".join(f"w{int(rng.paretovariate(0.7)) % 4000}" for _ in range(n))
    items = [(k, prose(rng.randint(12, 50))) for k in range(25)] + [(100, "two words"), (101, ""), (102, None), (None, prose(20)), (103, "w1 w1 w1 w1 w1 w1"), (3, prose(20))]
    items.append(items[0])
    docs = [(i, prose(rng.randint(1, 200)), None, "s") for i in range(60)]
    for k in range(25):
        docs.append((1000 + k, f"{prose(30)}\n{edited(items[k][1], rng, (k % 4) * 0.1).upper()}!! {prose(40)}", None, "s"))
    docs += [(2000, None, None, None), (2001, "", None, None), (None, prose(10) + " " + items[4][1], None, None), (2002, items[5][1] + " " + prose(50_000), None, None)]
    docs += [(1000, docs[60][1], None, "s"), (2003, "only two words here", None, None)]
    return docs, items


def test_copies_and_edited_copies_are_found(spark, cases):
    docs, items = cases
    bench = spark.createDataFrame([(i, t, 1.0, "d") for i, t in items], "item_id long, text string, score double, doc_id string")
    rows = contaminated(as_docs(spark, docs), bench).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    want = brute([(i, t) for i, t, _, _ in docs if i != 2002], items, decontaminate.THRESHOLD) | {(2002, 5)}
    planted = {(1000 + k, k) for k in range(25)} | {(None, 4), (2002, 5)}
    assert planted <= got
    assert {p for p in got if p[0] != 2002} <= want
    assert all(0.5 <= r.score <= 1 for r in rows) and max(r.score for r in rows) == 1
    clean = decontaminated(as_docs(spark, docs), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, *_ in docs} - {i for i, _ in got}
    assert clean.columns == as_docs(spark, docs).columns


def test_blocks_of_items_give_the_same(spark, cases, monkeypatch):
    docs, items = cases
    frame, bench = as_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(repr, contaminated(frame, bench).select("doc_id", "item_id").collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 8)
    assert sorted(map(repr, contaminated(frame, bench).select("doc_id", "item_id").collect())) == whole


def test_empty_tables(spark, no_docs, cases):
    docs, items = cases
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert contaminated(no_docs, bench).collect() == []
    assert contaminated(as_docs(spark, docs), bench.limit(0)).collect() == []
    assert decontaminated(as_docs(spark, docs), bench.limit(0)).count() == len(docs)


def test_small_tables_equal_all_pairs(spark, small_docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in contaminated(small_docs, bench).collect()}
    docs = [(r.doc_id, r.text) for r in small_docs.collect() if len(r.text) < 4000]
    items = [(r.item_id, r.text) for r in bench.limit(12).collect()]
    short = {i for i, _ in docs}
    names = {i for i, _ in items}
    assert {p for p in got if p[0] in short and p[1] in names} == brute(docs, items, decontaminate.THRESHOLD)


def test_edited_copies_without_another_copy_are_found(spark):
    rng = random.Random(3)
    prose = lambda n: [rng.choice(["the", "of", "and", "in", f"u{rng.randrange(10**6)}", f"v{rng.randrange(10**6)}"]) for _ in range(n)]
    items = [(k, prose(rng.randint(20, 60))) for k in range(36)]
    docs = [(i, " ".join(prose(rng.randint(5, 150))), None, "s") for i in range(40)]
    for k, words in items[:30]:
        copy = [f"new{k}x{n}" if n % (4 + k % 3) == 3 else w for n, w in enumerate(words)]
        docs.append((1000 + k, " ".join(prose(30) + copy + prose(30)), None, "s"))
    for k, words in items[30:]:  # a word put in after nearly every word
        loose = [x for n, w in enumerate(words[:-3]) for x in (w, f"put{k}x{n}")] + words[-3:]
        docs.append((1000 + k, " ".join(prose(30) + loose + prose(30)), None, "s"))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    rows = contaminated(as_docs(spark, docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute([d[:2] for d in docs], [(k, " ".join(w)) for k, w in items], decontaminate.THRESHOLD)
    assert {(1000 + k, k) for k, _ in items} <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        own, words = plain_words(dict((k, " ".join(w)) for k, w in items)[r.item_id]), plain_words(dict(d[:2] for d in docs)[r.doc_id])
        assert r.score == local_alignment(own, words[r.word_from : r.word_to])[0] / (MATCH * len(own))


def test_an_item_with_a_null_id_is_found_and_reported(spark):
    text = "seven words of an item without name"
    docs = spark.createDataFrame([(1, f"before {text} after", 3), (2, "nothing of it here at all", 4)], "doc_id long, text string, _leaks int")
    items = spark.createDataFrame([(None, text), (None, "another item with words of its own")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.score) for r in contaminated(docs, items).collect()] == [(1, None, 1.0)]
    clean = decontaminated(docs, items)
    assert clean.columns == docs.columns and [tuple(r) for r in clean.collect()] == [(2, "nothing of it here at all", 4)]


def seeds_of(spark, items, hits, n_docs):
    grams = spark.createDataFrame([(i, g, at, len(own)) for i, own in items.items() for at, g in enumerate(own)], decontaminate.GRAMS)
    found = spark.createDataFrame([(b"t", g, n) for g, times in hits.items() for n in range(times)], decontaminate.HITS)
    return {(r.item, r.gram) for r in decontaminate.rare_seeds(grams, found, n_docs).collect()}


def test_seeds_are_found_and_rare_in_the_corpus_or_for_their_item(spark):
    hits = {1: 1, 2: 2, 3: 9, 4: 500, 5: 600, 6: 30_000, 7: 1}
    # 0 is found nowhere and takes no one's place; 3 is over eight times the middle one
    assert seeds_of(spark, {10: [0, 1, 2, 3, 7]}, hits, 0) == {(10, 1), (10, 2), (10, 7)}
    assert seeds_of(spark, {10: [0, 1, 2, 3, 7]}, hits, 9_000) == {(10, 1), (10, 2), (10, 3), (10, 7)}
    # an item of common grams keeps those no more common than its others
    assert seeds_of(spark, {10: [4, 5, 6], 11: [6], 12: [0]}, hits, 9_000) == {(10, 4), (10, 5), (11, 6)}


def test_edited_copies_are_found_next_to_many_full_copies(spark):
    rng = random.Random(5)
    words = [f"u{rng.randrange(10**6)}" for _ in range(40)]
    edited_words = [f"new{n}" if n % 5 == 4 else w for n, w in enumerate(words)]
    docs = [(i, f"a{i} {' '.join(words)} b{i}") for i in range(300)] + [(1000, " ".join(edited_words)), (1001, " ".join(edited_words)), (2000, "other words")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = {r.doc_id: r.score for r in contaminated(frame, bench).collect()}
    assert set(got) == {i for i, _ in docs if i != 2000} and got[0] == 1 and got[1000] == got[1001] < 1


def test_the_filter_lets_every_gram_by(spark):
    rng = np.random.default_rng(2)
    grams = rng.integers(-(1 << 63), (1 << 63) - 1, 5_000)
    bits = decontaminate.gram_filter(spark.createDataFrame([(int(g),) for g in grams], "gram long"))
    at = grams.view(np.uint64) >> np.uint64(64 - decontaminate.FILTER_BITS)
    assert (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all()
    assert int(np.unpackbits(bits).sum()) == len(np.unique(at))
