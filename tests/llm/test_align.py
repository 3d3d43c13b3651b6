import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import order, pairs_of, sha

from cartwheel.llm import align, bpe, queries

try:
    A, B = queries.vocabulary_path(queries.BYTE_BPE), queries.vocabulary_path(queries.PIECE_BPE)
except ImportError:
    A = B = ""
pytestmark = pytest.mark.skipif(not (os.path.exists(A) and os.path.exists(B)), reason="no tokenizer files")


@pytest.fixture(scope="module")
def tokens_of():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = bpe.byte_letters()

    def of(text):
        """(ids, token bytes) of both sides by the libraries, or nothing."""
        want = b" " + (text or "").encode()
        a_ids, b_ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            return [], [], [], []
        return a_ids, a_bytes, b_ids, b_bytes

    return of


def spans(tokens):
    ends = np.cumsum([0, *map(len, tokens)]).tolist()
    return list(zip(ends, ends[1:]))


def brute(rows, tokens_of):
    """All pairs of tokens compared, counts by document, text by text."""
    parts, counts = [], Counter()
    for i, text in rows:
        a_ids, a_bytes, b_ids, b_bytes = tokens_of(text)
        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        links = [(x, y, min(p[1], q[1]) - max(p[0], q[0])) for x, p in enumerate(a_spans) for y, q in enumerate(b_spans) if p[0] < q[1] and q[0] < p[1]]
        cuts = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        groups, low = [], 0
        for high in cuts:
            groups.append(([k for k, s in zip(a_ids, a_spans) if low <= s[0] < high], [k for k, s in zip(b_ids, b_spans) if low <= s[0] < high]))
            low = high
        text_of = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        linked = [(a_ids[x], b_ids[y]) for x, y, _ in links]
        counts.update(set(linked))
        parts.append((i, a_ids, b_ids, groups, links, text_of, linked))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for i, a_ids, b_ids, groups, links, text_of, linked in parts:
        inside = sum(len(g) * len(h) for g, h in groups)
        out.append((i, len(a_ids), len(b_ids), len(groups), len(links), inside, text_of, sum(counts[p] == best[p[0]] for p in linked), sum(counts[p] for p in linked)))
    return sorted(out, key=lambda r: (order(r[0]), r[6])), parts


ODD = ["", " ", "  ", "x ", " a\n\tb", "▁x", "a▁", "naïve ½ ①", "<s> </s> <unk> <0x41>", "<|endoftext|> x", "日本語のテキスト", "　 \xa0", "😀😀", "a\x00b", "=" * 50, "a" * 300, "tab\t\ttab  two   three", "\r\n\r\n"]


def columns(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups", "n_best", "count_sum")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=lambda r: (order(r[0]), r[6]))


@pytest.mark.parametrize("frequent", [0, 40, align.FREQUENT_PAIRS])
def test_counts_by_broadcast_and_by_join(spark, tokens_of, frequent):
    rng = random.Random(2)
    words = "the token of a tokenizer isn't always another's 12345 naïveté l'été".split()
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))) for k in range(60)] + [(None, "the token"), (None, None), (3, "x "), (3, "x ")]
    docs = spark.createDataFrame([(i, t, "n", 1, "p", "g") for i, t in rows], "doc_id long, text string, pairs string, row long, n_a string, groups string").repartition(4)
    got = align.counted(align.alignments(docs, A, B, chunk_bytes=300), frequent_pairs=frequent)
    assert columns(got) == brute(rows, tokens_of)[0]


@pytest.mark.parametrize("name", ["messy_docs", "no_docs"])
def test_documents(request, name, tokens_of):
    docs = request.getfixturevalue(name).filter("doc_id is null or doc_id not in (6, 7, 13) and (doc_id < 20 or doc_id % 4 != 0)")
    assert columns(align.counted(align.alignments(docs, A, B))) == brute(pairs_of(docs), tokens_of)[0]


def test_links_say_which_tokens_share_how_many_bytes(spark, tokens_of):
    rows = list(enumerate(ODD))
    want = {i: (a, b, links) for i, a, b, _, links, _, _ in brute(rows, tokens_of)[1]}
    for r in align.alignments(spark.createDataFrame(rows, "doc_id long, text string"), A, B, tokens=True).collect():
        assert (list(r.a_ids), list(r.b_ids), list(zip(r.link_a, r.link_b, r.link_bytes))) == want[r.doc_id]


def test_product_is_the_matrix_product():
    rng = np.random.default_rng(4)
    for n in (0, 1, 7, 30):
        a, b = rng.random((n, 12)) < 0.3, rng.random((9, 12)) < 0.3
        sparse = [align.Rows(np.concatenate([[0], np.cumsum(m.sum(1))]).astype(np.int64), np.nonzero(m)[1]) for m in (a, b)]
        row, column, value = align.product(sparse[0], align.transposed(sparse[1], 12), rows_at_once=4)
        dense = np.zeros((n, 9), int)
        dense[row, column] = value
        assert (dense == a.astype(int) @ b.T.astype(int)).all() and len(row) == np.count_nonzero(dense) and (np.diff(row) >= 0).all()


def test_long_text_without_common_cuts_and_in_row_blocks(tokens_of, monkeypatch):
    text = "a" * 30_000 + " " + "ab" * 500
    whole = align.align_texts(A, B, pa.array([text]))
    monkeypatch.setattr(align.product, "__defaults__", (64,))
    again = align.align_texts(A, B, pa.array([text]))
    assert all((x == y).all() for x, y in zip(whole, again))
    a_ids, _, b_ids, _ = tokens_of(text)
    assert whole.a_ids.tolist() == a_ids and whole.b_ids.tolist() == b_ids
    assert len(whole.link_a) == len(a_ids) + len(b_ids) - whole.group_bounds[1]


def test_models_that_normalise_are_encoded_text_by_text(monkeypatch):
    """Without the word rule the ids are the same, text by text."""
    texts = pa.array([t for t in ODD if t])
    by_word = align.align_texts(A, B, texts)
    monkeypatch.setattr(align.pieces(B), "by_word", False)
    assert all((x == y).all() for x, y in zip(by_word, align.align_texts(A, B, texts)))


def test_query_columns(spark, tokens_of):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some = {r.doc_id: r for r in queries.op11_token_alignment(spark, sf).collect()}
    assert len(some) == docs.count()
    for i, text in pairs_of(docs):
        a_ids, _, b_ids, _ = tokens_of(text)
        assert (some[i].n_a, some[i].n_b) == (len(a_ids), len(b_ids))
        assert (some[i].groups_sha256 == "") == (not a_ids)
    i, text = min((p for p in pairs_of(docs) if p[1]), key=lambda p: len(p[1]))
    assert some[i].groups_sha256 == sha(brute([(i, text)], tokens_of)[0][0][6])
