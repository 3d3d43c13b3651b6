"""Byte-level BPE: distinct words in a trie, encoded along shared prefixes.

The BPE encoding of a text ends with one token only, and what stands before that
token is the encoding of the rest of the text. So the encoding of a string is known
from the last token of each of its prefixes, and strings that share a prefix share
those. The distinct words of a few MB of texts go into a trie; a depth-first walk
gives each node the last token of the path to it, once for all words below. That
token is the one that ends at the node and stays apart from the last token before
it: no merge across their seam comes earlier than the merges that made the two.

Tokens are byte strings. Words are cut as the tokenizer file's byte-level
pre-tokenizer cuts them; texts are packed into one buffer at a time, in which cuts
and distinct words are found by numpy and Arrow.
"""

from __future__ import annotations

import functools
import json
import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts are encoded so many bytes at a time, a longer text by itself.
CHUNK_BYTES = 4 << 20
# Pairs of tokens whose seam was looked at are remembered, so many at most in a worker.
MOST_PAIRS = 300_000
# So are the automaton's steps, and the ids of words and their pieces, until more than so many are known.
MOST_STEPS = 300_000
MOST_WORDS = 400_000
# Ids are decoded so many at a time, a longer sequence by itself.
CHUNK_IDS = 1 << 19

# The byte-level pre-tokenizer's pattern, written for ASCII bytes.
_ASCII_PIECE = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+")
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Below this character the libraries' tables of letters and numbers are the same, whatever their version of Unicode.
_SAME_BELOW = "\u0500"
# The white space beyond ASCII.
_WIDE_SPACE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: a printable byte is its own character, the n-th other one U+0100 + n."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special tokens of a ``tokenizers`` file of a byte-level BPE.

    A file that normalises texts, cuts them otherwise or encodes by other rules is
    a ValueError: its ids would differ.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError(f"not a plain byte-level BPE: {path}")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"added tokens that take in what is around them: {path}")
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        ids = {t: i for t, i in model["vocab"].items() if t.encode() not in self.special}
        self.bytes_of: dict[int, bytes] = {i: as_bytes(t) for t, i in ids.items()}
        self.bytes_of |= {i: t for t, i in self.special.items()}
        self.length = np.zeros(max(self.bytes_of, default=0) + 1, np.int64)
        for i, t in self.bytes_of.items():
            self.length[i] = len(t)
        # merge (left, right): its token and its place among the merges
        self.merge: dict[tuple[int, int], int] = {}
        self.made_by: dict[int, tuple[int, int, int]] = {}
        for place, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            token = ids[left + right]
            self.merge[ids[left], ids[right]] = place
            self.made_by.setdefault(token, (place, ids[left], ids[right]))
        self.seams: dict[int, bool] = {}
        self.steps: dict[int, int] = {}
        self.known: dict[bytes, bytes] = {}

    @functools.cached_property
    def as_column(self) -> pa.Array:
        """Bytes by id, empty where there is no such id."""
        return pa.array([self.bytes_of.get(i, b"") for i in range(len(self.length))], pa.large_binary())

    @functools.cached_property
    def automaton(self) -> tuple[dict[int, int], list[int], list[tuple]]:
        """Finds the tokens ending at each byte of a string.

        A state is a prefix of a token; ``step[state << 8 | byte]`` is the longer
        prefix, ``shorter[state]`` the longest proper suffix that is a prefix too,
        ``ending[state]`` the tokens that are its suffixes, as (size, id), longest first.
        """
        tokens = {t: i for i, t in self.bytes_of.items() if t not in self.special and (len(t) == 1 or i in self.made_by)}
        step: dict[int, int] = {}
        shorter, ending = [0], [()]
        prefixes: dict[bytes, int] = {b"": 0}
        for token in tokens:
            for n in range(1, len(token) + 1):
                prefixes.setdefault(token[:n], 0)
        for prefix in sorted(prefixes, key=len)[1:]:
            state = prefixes[prefix] = len(shorter)
            step[prefixes[prefix[:-1]] << 8 | prefix[-1]] = state
            suffix = next(prefixes[prefix[k:]] for k in range(1, len(prefix) + 1) if prefix[k:] in prefixes)
            shorter.append(suffix)
            own = ((len(prefix), tokens[prefix]),) if prefix in tokens else ()
            ending.append(own + ending[suffix])
        return step, shorter, ending

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` as they are when their bytes stand next to each other.

        The merges at the seam are undone from the last one on. A merge across the
        seam that comes before the merge undone last would have been taken instead
        of it; of equal merges the one further left comes first.
        """
        if len(self.seams) >= MOST_PAIRS:
            self.seams.clear()
        known = self.seams[left << 32 | right] = self._stay_apart(left, right)
        return known

    def forget(self) -> None:
        """Drop what is remembered; an idle worker keeps its memory."""
        self.seams.clear()
        self.steps.clear()
        self.known.clear()

    def _stay_apart(self, left: int, right: int) -> bool:
        undone = (math.inf, 0)
        while True:
            across = self.merge.get((left, right))
            if across is not None and (across, 1) < undone:
                return False
            of_left, of_right = self.made_by.get(left), self.made_by.get(right)
            left_at = (of_left[0], 0) if of_left else (-1, 0)
            right_at = (of_right[0], 2) if of_right else (-1, 2)
            if of_right and right_at > left_at:
                undone, right = right_at, of_right[1]
            elif of_left:
                undone, left = left_at, of_left[2]
            else:
                return True


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.lru_cache(maxsize=2)
def _pre_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).pre_tokenizer


class Trie:
    """Distinct words, each hung where it leaves the word before it.

    Words are inserted in byte order, which is the depth-first order of the trie's
    nodes: an edge holds what a word adds to the path that it shares with its
    predecessor. So only the edges are kept, not a node for each byte.
    """

    def __init__(self, words: list[bytes]) -> None:
        self.edges: list[tuple[int, int]] = []  # (depth at which the word leaves, its number)
        self.words = words
        before = b""
        for number in sorted(range(len(words)), key=words.__getitem__):
            word = words[number]
            depth, end = 0, min(len(before), len(word))
            while depth < end and before[depth] == word[depth]:
                depth += 1
            self.edges.append((depth, number))
            before = word

    def nodes(self) -> int:
        return sum(len(self.words[number]) - depth for depth, number in self.edges)


def encode_words(vocab: Vocabulary, words: list[bytes]) -> list[tuple[int, ...]]:
    """Ids of distinct words."""
    return [tuple(array("I", ids)) for ids in word_ids(vocab, words)]


def word_ids(vocab: Vocabulary, words: list[bytes]) -> list[bytes]:
    """Ids (unsigned, 32 bits each) of distinct words, by a depth-first walk over their trie.

    ``last[d]`` is the last token of the first d bytes of the path, ``states[d]`` the
    state there of the automaton that names the candidates.
    """
    (step, shorter, ending), seams, steps = vocab.automaton, vocab.seams, vocab.steps
    if len(steps) >= MOST_STEPS:
        steps.clear()
    sizes = vocab.length.tolist()
    last, states = [-1], [0]
    out = [b""] * len(words)
    for shared, number in Trie(words).edges:
        word = words[number]
        del last[shared + 1 :], states[shared + 1 :]
        state = states[shared]
        here = shared
        for byte in word[shared:]:
            here += 1
            key = state << 8 | byte
            state = steps.get(key)
            if state is None:
                state = steps[key] = _step(step, shorter, key)
            states.append(state)
            for size, token in ending[state]:
                if size < here:
                    pair = last[here - size] << 32 | token
                    fits = seams.get(pair)
                    if fits is None:
                        fits = vocab.stay_apart(pair >> 32, token)
                    if not fits:
                        continue
                last.append(token)
                break
            else:
                raise ValueError(f"bytes without a token: {word[:here]!r}")
        ids, at = array("I"), len(word)
        while at:
            ids.append(last[at])
            at -= sizes[last[at]]
        ids.reverse()
        out[number] = ids.tobytes()
    return out


def _step(step: dict[int, int], shorter: list[int], key: int) -> int:
    """The state after a state and a byte (``state << 8 | byte``): the longest prefix of a token that the bytes so far end in."""
    state, byte = key >> 8, key & 0xFF
    while (after := step.get(state << 8 | byte)) is None and state:
        state = shorter[state]
    return after or 0


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and where each value starts (one more for the end)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The pieces of ``data`` between neighbouring cuts as an Arrow column that shares its bytes."""
    cuts = np.ascontiguousarray(cuts, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def chunks(column: pa.Array, most_bytes: int) -> Iterator[pa.Array]:
    """Slices of a string column (nulls as empty) of about ``most_bytes``."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    filled = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(filled) > 0) + 1), len(column)]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield column.slice(low, high - low)
            pa.default_memory_pool().release_unused()


def _word_cuts(path: str, column: pa.Array, data: np.ndarray, offsets: np.ndarray, special: dict[bytes, int]) -> np.ndarray:
    """Where words start, at runs of ASCII white space as the pattern cuts them; special tokens stand by themselves.

    A word may take in the one space before it; of longer white space the last
    character, if no space, is a word. Texts with other white space are cut by the
    library's pre-tokenizer.
    """
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    if special:
        content = pa.py_buffer(np.ascontiguousarray(data)).to_pybytes() if any(pc.any(pc.match_substring(column, s.decode())).as_py() for s in special) else b""
        for found in re.finditer(b"|".join(map(re.escape, sorted(special, key=len, reverse=True))), content):
            low, high = found.span()
            if offsets[np.searchsorted(offsets, low, "right")] >= high:  # not across two texts
                begins[[low, high]] = True
    space = _SPACE[data]
    turns = np.flatnonzero(space[1:] != space[:-1]) + 1
    turns = turns[~begins[turns]]
    cuts = begins.copy()
    into_word = turns[~space[turns]]
    cuts[into_word - 1] = True
    cuts[into_word[data[into_word - 1] != 0x20]] = True
    cuts[turns[space[turns]]] = True
    for i in np.flatnonzero(pc.match_substring_regex(column, _WIDE_SPACE).to_numpy(zero_copy_only=False)):
        low, high = offsets[i], offsets[i + 1]
        cuts[low:high] = begins[low:high]
        parts = [low, *(low + 1 + np.flatnonzero(begins[low + 1 : high])), high]
        for a, b in zip(parts, parts[1:]):
            part = data[a:b]
            if part.tobytes() in special:
                continue
            characters = a + np.flatnonzero(part & 0xC0 != 0x80)
            pieces = _pre_tokenizer(path).pre_tokenize_str(part.tobytes().decode())
            cuts[characters[[x for _, (x, _) in pieces]]] = True
    return np.flatnonzero(cuts)


def _pieces(path: str, word: bytes) -> list[bytes]:
    if word[word[:1] == b" " :].isalpha():
        return [word]
    if word.isascii():
        return _ASCII_PIECE.findall(word)
    text = word.decode()
    if max(text) < _SAME_BELOW:
        return [p.encode() for p in _PIECE.findall(text)]
    return [text[a:b].encode() for _, (a, b) in _pre_tokenizer(path).pre_tokenize_str(text)]


def distinct_words(data: np.ndarray, cuts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The different words between the cuts, and each word's number among them."""
    numbered = slices(data, cuts).dictionary_encode()
    return numbered.dictionary.to_pylist(), numbered.indices.to_numpy()


def spread(ids: list[bytes], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` of the words numbered so, one after the other, and how many each has."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    pool = np.frombuffer(b"".join(ids), np.uint32)
    n = lengths[numbers]
    return pool[ranges((np.cumsum(lengths) - lengths)[numbers], n)], n


def encode_column(path: str, column: pa.Array, specials: bool = True, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some texts at a time: their ids, and where each text's ids start (one more for the end).

    specials: special tokens in a text become their id, as the library does by
    itself; else they are plain text. A null text is empty.
    """
    for texts in chunks(column, chunk_bytes):
        yield encode_texts(path, texts, specials)


def encode_texts(path: str, texts: pa.Array, specials: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The same for a column of texts without nulls, all at once."""
    vocab = vocabulary(path)
    special = vocab.special if specials else {}
    data, offsets = packed(texts)
    cuts = _word_cuts(path, texts, data, offsets, special)
    words, numbers = distinct_words(data, cuts)
    if len(vocab.known) > MOST_WORDS:
        vocab.known.clear()
    known = vocab.known
    known.update((w, array("I", [i]).tobytes()) for w, i in special.items())
    new = [w for w in words if w not in known]
    # a piece is the one piece of itself, so its ids are known like those of a word
    parts = [_pieces(path, w) for w in new]
    pieces = list({p for of_word in parts for p in of_word if p not in known})
    known.update(zip(pieces, word_ids(vocab, pieces)))
    known.update((w, b"".join([known[p] for p in of_word])) for w, of_word in zip(new, parts) if len(of_word) != 1)
    ids = [known[w] for w in words]
    for w in special:
        del known[w]  # as plain text they have other ids
    flat, n = spread(ids, numbers)
    ends = np.concatenate([[0], np.cumsum(n)])
    return flat, ends[np.searchsorted(cuts, offsets)]


def decode_ids(vocab: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of the id sequences between the bounds; unknown ids are left out, broken UTF-8 becomes U+FFFD."""
    known = (ids >= 0) & (ids < len(vocab.length))
    data, offsets = packed(vocab.as_column.take(pa.array(ids * known)))
    if not known.all():
        keep = np.repeat(known, np.diff(offsets))
        data, offsets = data[keep], np.concatenate([[0], np.cumsum(np.diff(offsets) * known)])
    at, view = offsets[bounds].tolist(), memoryview(np.ascontiguousarray(data))
    return [str(view[a:b], "utf-8", "replace") for a, b in zip(at, at[1:])]


def encoded(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", specials: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, ids`` (an int array): one row per input row, no special tokens added.

    A null or empty text has no ids. Repeated rows and null ids come out as they
    are; further columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            at = 0
            for flat, bounds in encode_column(tokenizer_path, batch.column("text"), specials, chunk_bytes):
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(ids)), ids], ["doc_id", "ids"])
                at += len(ids)
        vocabulary(tokenizer_path).forget()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, ids, text`` of a table of ``doc_id, ids``; special tokens are kept, null ids are no ids."""

    def run(batches):
        vocab = vocabulary(tokenizer_path)
        for batch in batches:
            ids = batch.column("ids")
            bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(bounds[1:] // CHUNK_IDS)) + 1), len(ids)]
            for low, high in zip(cuts, cuts[1:]):
                if high > low:
                    at = bounds[low : high + 1]
                    texts = decode_ids(vocab, flat[at[0] : at[-1]], at - at[0])
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), ids.slice(low, high - low), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
                    pa.default_memory_pool().release_unused()

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")
