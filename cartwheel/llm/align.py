"""Links between the tokens that two tokenizers make of the same text.

Both tokenizers cut the same bytes: tokenizer A (a byte-level BPE file) is given a
space and the text, tokenizer B (a sentencepiece model) the text, before which it
puts a space by itself. Which bytes a token covers is a matrix of tokens by bytes
in compressed sparse rows, A and B. Row i of the product A times B transposed,
built row by row from the rows of B transposed that row i selects (Gustavson's
way), has an entry for each token of the other side that shares bytes with token
i, and how many. Byte offsets where tokens of both sides end cut the tokens into
groups; the matrices of tokens by groups give the links within a group. Those are
counted from the row sizes of their product, as a group may be long; the groups
themselves, with the ids of both sides, are their whole content.

A pair of ids is counted once for each document that holds it linked.
"""

from __future__ import annotations

import functools
from array import array
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm import bpe
from cartwheel.llm.common import stored

# Texts are aligned so many bytes at a time, a longer text by itself; products take so many rows at a time.
CHUNK_BYTES = 2 << 20
ROWS_AT_ONCE = 1 << 16
# Counts of the most frequent id pairs are broadcast (17 bytes each); the other pairs are joined by a shuffle.
FREQUENT_PAIRS = 500_000

_MARK = "▁"  # fixed value: stands for a space in pieces


class Rows(NamedTuple):
    """A sparse matrix of ones: row i has the columns ``columns[starts[i]:starts[i + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)


def incidence(lengths: np.ndarray) -> Rows:
    """Tokens by bytes, for tokens of these lengths that follow each other."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Rows(starts, np.arange(starts[-1], dtype=np.int32))


def one_each(columns: np.ndarray) -> Rows:
    """A matrix with one entry a row."""
    return Rows(np.arange(len(columns) + 1), columns)


def transposed(m: Rows, width: int) -> Rows:
    order = np.argsort(m.columns, kind="stable")
    rows = np.repeat(np.arange(len(m.starts) - 1, dtype=np.int32), m.sizes())[order]
    return Rows(np.concatenate([[0], np.cumsum(np.bincount(m.columns, minlength=width))]), rows)


def product(a: Rows, bt: Rows, rows_at_once: int = ROWS_AT_ONCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the entries of the product, row by row: each row of ``a`` adds up the rows of ``bt`` that it selects."""
    found = [(np.zeros(0, np.int64),) * 3]
    n = len(a.starts) - 1
    for low in range(0, n, rows_at_once):
        high = min(n, low + rows_at_once)
        picked = a.columns[a.starts[low] : a.starts[high]]
        each = bt.starts[picked + 1] - bt.starts[picked]
        row = np.repeat(np.repeat(np.arange(low, high), np.diff(a.starts[low : high + 1])), each)
        entry = row << 32 | bt.columns[bpe.ranges(bt.starts[picked], each)]
        if np.any(entry[1:] < entry[:-1]):
            entry.sort()
        first = np.flatnonzero(np.concatenate([[True], entry[1:] != entry[:-1]])[: len(entry)])
        found.append((entry[first] >> 32, entry[first] & 0xFFFFFFFF, np.diff(np.append(first, len(entry)))))
    return tuple(np.concatenate(x) for x in zip(*found))


def product_sizes(a: Rows, bt: Rows) -> np.ndarray:
    """Entries in each row of the product, for an ``a`` with one entry a row, without making them."""
    return bt.sizes()[a.columns]


class Pieces:
    """Tokens of a sentencepiece model as bytes.

    Where no piece has a space after another character, texts are not normalised
    and no piece was defined by hand, a text's ids are those of its words, each
    with the spaces before it.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)]
        self.length = np.fromiter(map(len, self.bytes_of), np.int64, n)
        self.spaces = array("I", [self.model.piece_to_id(_MARK)]).tobytes()
        self.known: dict[bytes, bytes] = {}
        self.odd: set[bytes] = set()
        self.by_word = not any(_MARK in p.lstrip(_MARK) for p in names) and self._takes_texts_as_they_are(path)

    @staticmethod
    def _takes_texts_as_they_are(path: str) -> bool:
        try:
            from sentencepiece import sentencepiece_model_pb2
        except ImportError:
            return False
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        how = spec.normalizer_spec
        by_hand = any(p.type == p.USER_DEFINED for p in spec.pieces)
        return how.add_dummy_prefix and not (how.precompiled_charsmap or how.remove_extra_whitespaces or by_hand)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids (unsigned, 32 bits each) of words that begin with a space, which the model adds by itself. ``odd`` has those that their pieces don't give back."""
        if len(self.known) > bpe.MOST_WORDS or not self.by_word:
            self.forget()
        new = [w for w in words if w not in self.known]
        found = self.model.encode([w[1:].decode() for w in new], num_threads=1)
        found = [self.spaces if w == b" " else array("I", ids).tobytes() for w, ids in zip(new, found)]
        self.known.update(zip(new, found))
        # what the pieces give back is compared at once, and word by word only where it isn't all the same
        given, n = bpe.spread(found, np.arange(len(found)))
        ends = np.cumsum(n)
        lengths = np.diff(np.concatenate([[0], np.cumsum(self.length[given])])[np.concatenate([[0], ends])])
        same = lengths == np.fromiter(map(len, new), np.int64, len(new))
        if not same.all() or b"".join([self.bytes_of[i] for i in given.tolist()]) != b"".join(new):
            self.odd.update(w for w, ids in zip(new, found) if b"".join([self.bytes_of[i] for i in np.frombuffer(ids, np.uint32)]) != w)
        return [self.known[w] for w in words]

    def forget(self) -> None:
        self.known.clear()
        self.odd.clear()


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Aligned(NamedTuple):
    """Tokens, groups and links of some texts; ``*_bounds`` say where each text's entries start."""

    a_ids: np.ndarray
    a_bounds: np.ndarray
    b_ids: np.ndarray
    b_bounds: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    group_bounds: np.ndarray
    group_links: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_bytes: np.ndarray
    link_bounds: np.ndarray


def _piece_ids(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of tokenizer B, where each text's start, and which texts come out as the bytes they are."""
    model = pieces(path)
    data, offsets = bpe.packed(texts)
    cuts = np.zeros(len(data) + 1, bool)
    cuts[offsets] = True
    if model.by_word:
        space = data == 0x20
        cuts[1:-1] |= space[1:] & ~space[:-1]
    cuts = np.flatnonzero(cuts)
    words, numbers = bpe.distinct_words(data, cuts)
    ids = model.encode(words)
    odd = np.array([w in model.odd for w in words] if model.odd else np.zeros(len(words)), bool)
    flat, n = bpe.spread(ids, numbers)
    bounds = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(cuts, offsets)]
    same = np.ones(len(texts), bool)
    for i in np.unique(np.searchsorted(offsets, cuts[:-1][odd[numbers]], "right") - 1):
        same[i] = b"".join([model.bytes_of[k] for k in flat[bounds[i] : bounds[i + 1]]]) == data[offsets[i] : offsets[i + 1]].tobytes()
    return flat, bounds, same


def _kept(flat: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(bounds)
    return flat[np.repeat(keep, n)].astype(np.int64), np.concatenate([[0], np.cumsum(n * keep)])


def align_texts(a_path: str, b_path: str, texts: pa.Array) -> Aligned:
    """Tokens and links of a column of texts without nulls. Empty texts, and those that B doesn't give back as they are, have none."""
    vocab, model = bpe.vocabulary(a_path), pieces(b_path)
    texts = texts.cast(pa.large_string())
    filled = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", pa.large_string()), pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
    b_ids, b_bounds, same = _piece_ids(b_path, filled)
    a_ids, a_bounds = _kept(*bpe.encode_texts(a_path, filled, specials=False), same)
    b_ids, b_bounds = _kept(b_ids, b_bounds, same)

    a, b = incidence(vocab.length[a_ids]), incidence(model.length[b_ids])
    link_a, link_b, link_bytes = product(a, transposed(b, len(b.columns)))

    ends = np.zeros(len(b.columns) + 1, np.int8)
    ends[a.starts[1:]] += 1
    ends[b.starts[1:]] += 1
    of_byte = np.concatenate([[0], np.cumsum(ends == 2)])  # groups that end before each byte
    a_group, b_group = of_byte[a.starts[:-1] + 1], of_byte[b.starts[:-1] + 1]
    n_groups = int(of_byte[-1])
    group_bounds = of_byte[a.starts[a_bounds] + 1]
    group_links = np.concatenate([[0], np.cumsum(product_sizes(one_each(a_group), transposed(one_each(b_group), n_groups)))])
    return Aligned(a_ids, a_bounds, b_ids, b_bounds, a_group, b_group, group_bounds, group_links[a_bounds], link_a, link_b, link_bytes, np.searchsorted(link_a, a_bounds))


@functools.lru_cache(maxsize=2)
def _decimals(n: int, ends: str) -> pa.Array:
    return pa.array([f"{i}{end}" for i in range(n) for end in ends], pa.large_binary())


def group_texts(x: Aligned) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for each text: decimal ids of its groups, in order."""
    na, nb = len(x.a_ids), len(x.b_ids)
    last_a, last_b = np.ones(na, bool), np.ones(nb, bool)
    last_a[:-1], last_b[:-1] = x.a_group[1:] != x.a_group[:-1], x.b_group[1:] != x.b_group[:-1]
    # an id stands behind its own side's ids and the other side's of the groups before (A) or up to its own (B)
    a_at = np.arange(na) + np.searchsorted(x.b_group, x.a_group, "left")
    b_at = np.arange(nb) + np.searchsorted(x.a_group, x.b_group, "right")
    pool = _decimals(int(max(x.a_ids.max(initial=0), x.b_ids.max(initial=0))) // 65536 * 65536 + 65536, ",|;")
    pick = np.zeros(na + nb, np.int64)
    pick[a_at] = x.a_ids * 3 + last_a
    pick[b_at] = x.b_ids * 3 + 2 * last_b
    data, offsets = bpe.packed(pool.take(pa.array(pick)))
    at = offsets[x.a_bounds + x.b_bounds].tolist()
    content = data.tobytes()
    return [content[low : max(low, high - 1)].decode() for low, high in zip(at, at[1:])]


def id_pairs(x: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked id pairs of each text (A's id in the upper 32 bits, B's in the lower), how often each is linked, and where each text's pairs start."""
    pairs = x.a_ids[x.link_a] << 32 | x.b_ids[x.link_b]
    text = np.repeat(np.arange(len(x.a_bounds) - 1), np.diff(x.link_bounds))
    order = np.lexsort((pairs, text))
    pairs, text = pairs[order], text[order]
    first = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (text[1:] != text[:-1])])[: len(pairs)])
    return pairs[first], np.diff(np.append(first, len(pairs))), np.searchsorted(text[first], np.arange(len(x.a_bounds)))


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", tokens: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_group_links, groups, pairs, times``.

    groups: ``group_texts``; pairs, times: ``id_pairs``. With ``tokens`` also the
    ids ``a_ids, b_ids`` and the links as positions in them, ``link_a, link_b,
    link_bytes`` (bytes in common). A null or empty text, or one whose B tokens'
    bytes are not the text's, has zeros, no groups and no pairs. Repeated rows and
    null ids come out as they are, further columns are ignored, an empty table
    gives no rows.
    """
    kinds = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_group_links": "long", "groups": "string", "pairs": "array<long>", "times": "array<int>"}
    if tokens:
        kinds |= dict.fromkeys(("a_ids", "b_ids", "link_a", "link_b", "link_bytes"), "array<int>")

    def run(batches):
        for batch in batches:
            at = 0
            for texts in bpe.chunks(batch.column("text"), chunk_bytes):
                x = align_texts(a_path, b_path, texts)
                counts = [np.diff(n) for n in (x.a_bounds, x.b_bounds, x.group_bounds, x.link_bounds, x.group_links)]
                pairs, times, bounds = id_pairs(x)
                columns = [batch.column("doc_id").slice(at, len(texts)), *(pa.array(n, pa.int64()) for n in counts)]
                columns += [pa.array(group_texts(x), pa.string()), _lists(pairs, bounds, pa.int64()), _lists(times, bounds, pa.int32())]
                if tokens:
                    first_a, first_b = (np.repeat(n[:-1], np.diff(x.link_bounds)) for n in (x.a_bounds, x.b_bounds))
                    columns += [_lists(x.a_ids, x.a_bounds, pa.int32()), _lists(x.b_ids, x.b_bounds, pa.int32())]
                    columns += [_lists(v, x.link_bounds, pa.int32()) for v in (x.link_a - first_a, x.link_b - first_b, x.link_bytes)]
                yield pa.RecordBatch.from_arrays(columns, list(kinds))
                at += len(texts)
        bpe.vocabulary(a_path).forget()
        pieces(b_path).forget()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{k} {v}" for k, v in kinds.items()))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n, best``: in how many rows a pair is, and whether no pair with the same A id is in more of them."""
    counts = stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    a_id = F.shiftright("pair", 32)
    most = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))  # a row per id of A's vocabulary
    best = counts.join(F.broadcast(most), a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return stored(best, "best-pairs")


def _sums(matched: DataFrame) -> DataFrame:
    of_best = F.when(F.col("best"), F.col("time")).otherwise(0)
    return matched.groupBy("row").agg(F.sum(of_best.cast("long")).alias("n_best"), F.sum(F.col("time") * F.col("n")).alias("count_sum"))


def counted(rows: DataFrame, frequent_pairs: int = FREQUENT_PAIRS, digests: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` of ``alignments`` with ``n_best`` and ``count_sum`` in place of pairs and times.

    n_best: links whose pair's count is the highest of its A id; count_sum: the sum
    of the counts of all links; both 0 without links. Pairs in so many rows that at
    most ``frequent_pairs`` pairs are in as many (told by powers of two) are looked
    up in a broadcast table; only rows of the other, rarer pairs are shuffled, so
    no hot pair is. ``digests`` are computed on the way, in place of ``groups``.
    """
    digests = {"groups": F.col("groups")} if digests is None else digests
    kept = [c for c in rows.columns if c not in ("groups", "pairs", "times")]
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), *kept, *(v.alias(k) for k, v in digests.items()), "pairs", "times"), "alignments")
    counts = pair_counts(rows)
    # at most 64 rows: how many pairs have a count of so many bits
    bits = {r["bits"]: r["count"] for r in counts.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()}
    least, total = max(bits, default=0) + 1, 0
    while least - 1 in range(1, 64) and total + bits.get(least - 1, 0) <= frequent_pairs:
        least -= 1
        total += bits.get(least, 0)
    often = F.length(F.bin("n")) >= least
    links = rows.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("time"))))
    frequent = F.broadcast(counts.filter(often))
    sums = _sums(links.join(frequent, "pair"))
    if any(k < least for k in bits):
        rest = links.join(frequent.select("pair"), "pair", "left_anti").join(counts.filter(~often), "pair")
        sums = sums.unionByName(_sums(rest)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = {c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")}
    return rows.drop("pairs", "times").join(sums, "row", "left").withColumns(none).drop("row")
