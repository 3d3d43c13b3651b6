import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import order, pairs_of
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm import queries, tokens
from cartwheel.llm.common import scratch

try:
    PATH = queries.tokenizer_path()
except ImportError:
    PATH = ""
needs_tokenizer = pytest.mark.skipif(not os.path.exists(PATH), reason="no tokenizer file")


@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=30), min_size=1, max_size=8))
@settings(max_examples=300, deadline=None)
def test_vbyte_round_trip(sequences):
    n = np.array([len(s) for s in sequences])
    values = np.array([v for s in sequences for v in s], "<u4")
    control, data = tokens.vbyte_encode(values, n)
    assert [len(c) for c in control] == [-(-len(s) // 4) for s in sequences]
    assert [len(d) for d in data] == [sum(max(1, (x.bit_length() + 7) // 8) for x in s) for s in sequences]
    assert tokens.vbyte_decode(b"".join(control), b"".join(data), n).tolist() == values.tolist()


latin = st.text(st.characters(max_codepoint=0x17F), max_size=40)


@needs_tokenizer
@given(st.lists(st.text(max_size=30) | latin | st.sampled_from(["<|endoftext|>", "e ́", "A b", "don't 12 I'LL", "\x1c x", "J\u030c", "\u0130.", "Σ", "x²½", "\xa0\x85"]), max_size=12))
@settings(max_examples=600, deadline=None)
def test_piece_by_piece_equals_whole_text(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    whole = tokens._tokenizer(PATH)[0].encode(text, add_special_tokens=False).ids
    assert next(tokens.ids_of_texts(PATH, pa.array([text]))).tolist() == whole


@needs_tokenizer
def test_every_latin_character_is_cut_as_the_tokenizer_does():
    texts = [f"a{chr(c)}b{chr(c)}{chr(c)}.{chr(c)}1 {chr(c)}" for c in range(0x180)]
    want = [e.ids for e in tokens._tokenizer(PATH)[0].encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in tokens.ids_of_texts(PATH, pa.array(texts))] == want


@needs_tokenizer
@pytest.mark.parametrize("name", ["messy_docs", "small_docs", "no_docs"])
def test_files_hold_every_document(request, name, monkeypatch):
    docs = request.getfixturevalue(name)
    monkeypatch.setattr(tokens, "TOKENS_A_FILE", 20_000)
    tokenizer = tokens._tokenizer(PATH)[0]
    want = sorted(((i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in pairs_of(docs)), key=lambda x: order(x[0]))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.token_binary(docs, PATH).collect())
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    # rows that repeat an id may come in either order
    assert sorted(((i, n, c) for _, i, n, c in got), key=repr) == sorted(((i, len(ids), crc(ids)) for i, ids in want), key=repr)
    assert [i for _, i, _, _ in got] == [i for i, _ in want]
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n


@needs_tokenizer
def test_frequent_ids_have_low_ranks(spark, small_docs):
    folder = scratch(spark, "tokens-test")
    tokens.write_tokens(small_docs, folder, PATH)
    ranks = {r["rank"]: r["id"] for r in spark.read.parquet(folder + "/ranks").collect()}
    counts = {}
    for r in tokens.read_tokens(spark, folder).collect():
        for i in np.frombuffer(r.ids, "<u4").tolist():
            counts[i] = counts.get(i, 0) + 1
    assert [ranks[k] for k in range(len(ranks))] == sorted(counts, key=lambda i: (-counts[i], i))


@needs_tokenizer
def test_a_file_that_cuts_otherwise_is_encoded_by_the_library():
    other = queries.vocabulary_path(queries.BYTE_BPE)
    assert tokens.cut_as_known(PATH) and not tokens.cut_as_known(other)
    texts = ["Two  Words\n", "don't", "", "<|endoftext|> É"]
    want = [e.ids for e in tokens._tokenizer(other)[0].encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in tokens.ids_of_texts(other, pa.array(texts))] == want


@needs_tokenizer
def test_a_piece_is_encoded_once_in_all_texts_of_a_worker(monkeypatch):
    asked = []
    pieces = tokens._Pieces(tokens._tokenizer(PATH)[0])
    encoded = pieces._encoded
    monkeypatch.setattr(pieces, "_encoded", lambda new: asked.extend(new.to_pylist()) or encoded(new))
    monkeypatch.setattr(tokens, "_tokenizer", lambda path, both=(tokens._tokenizer(PATH)[0], pieces): both)
    texts = [f"Alpha, beta{k % 3}! alpha's  ALPHA gamma{k}" for k in range(40)]
    for _ in range(2):
        assert sum(1 for _ in tokens.ids_of_texts(PATH, pa.array(texts), 1024)) == len(texts)
    assert sorted(asked) == sorted({"alpha", "'s", "beta", "gamma", ",", "!", *"0123456789"})


@needs_tokenizer
def test_texts_with_and_without_odd_words_share_a_chunk():
    texts = [f"Plain text {k}, it's \u017f" if k % 2 else f"Odd \u2019{k}\u2019 J\u030c TEXT <|endoftext|>x \u4f60" for k in range(50)]
    assert len(list(tokens._chunks(pa.array(texts), 1 << 20))) == 1
    want = [e.ids for e in tokens._tokenizer(PATH)[0].encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in tokens.ids_of_texts(PATH, pa.array(texts))] == want


@needs_tokenizer
@given(st.lists(st.lists(latin | st.text(max_size=12), max_size=8).map(" ".join), max_size=12), st.sampled_from([16, 200, 2000]))
@settings(max_examples=100, deadline=None)
def test_what_is_remembered_is_bounded_and_changes_no_ids(texts, most_bytes):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    tokenizer, pieces = tokens._tokenizer(PATH)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in tokens.ids_of_texts(PATH, pa.array(texts, pa.string()), most_bytes)] == want
    assert pieces.nbytes() <= max(2 * most_bytes, 64) or not any(texts)


@needs_tokenizer
def test_a_vocabulary_that_leaves_out_bytes(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    left_out = [t for t in spec["model"]["vocab"] if t.endswith("q</w>")]
    for token in left_out:
        del spec["model"]["vocab"][token]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    spec["model"]["merges"] = [m for m in merges if not m[1].endswith("q</w>")]
    path = str(tmp_path / "less.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    texts = ["iraq and q", "Q", "queue", "\xe9q \xe9"]
    want = [e.ids for e in tokens._tokenizer(path)[0].encode_batch(texts, add_special_tokens=False)]
    assert tokens.cut_as_known(path)
    assert [x.tolist() for x in tokens.ids_of_texts(path, pa.array(texts))] == want
