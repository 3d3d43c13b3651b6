"""Token ids to binary files: frequency-ranked ids in stream-vbyte coding.

Ids are ranked by how often they occur in the whole corpus (ties by id), so that
frequent ids take one byte. A document's ranks are coded with separate control
bytes, two bits a value for its byte length, four values a control byte; the
data bytes follow. Decoding looks the four lengths of each control byte up in a
numpy table. Files hold documents in ascending id order, one record each:

    id (int64) | flags (uint8, 1: id is null) | n (uint32) | control bytes (uint32) | data bytes (uint32) | control | data | 0x0A

All integers are little-endian. ``ranks`` beside the files maps rank to id; it
has one row per id of the vocabulary that occurs, whatever the corpus.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import in_batches, scratch, stored

END_ID = 1
TOKENS_A_FILE = 4_000_000
# Texts are encoded so many bytes at a time: more take fewer CPU seconds and more memory.
CHUNK_BYTES = 16 << 20

# Letters, numbers and white space of the tokenizer's pattern below U+0180, lower-cased.
# Every text there is in normal form; only U+0130 has a lower case of two characters.
_L, _N, _S = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+|\n")  # \n: the end of a word
# Words outside that range, or with what may be a special token.
_ODD_WORD = r"[\x{130}\x{180}-\x{10ffff}]|<\|"
# The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on. Pieces have no space.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LETTERS = {b: 0x100 + n for n, b in enumerate(b for b in range(0x100) if b not in _PRINTABLE) if b != 0x20}
_WORDS_AT_ONCE = 1 << 16
_PIECES_AT_ONCE = 1 << 10
_LAST_OF_PIECE = "</w>"

_HEAD = "<qBIII"
_CODES = (np.arange(256)[:, None] >> (2 * np.arange(4)) & 3).astype(np.uint8)


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's threads would take the others'
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, _Pieces(tokenizer)


# How a file must normalise and cut texts for the rules above.
_NORMALISES = ["NFC", "Replace", "Lowercase"]
_CUTS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


@functools.lru_cache(maxsize=2)
def cut_as_known(path: str) -> bool:
    """Whether a file's texts may be cut into words and pieces by the rules above."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normalises = (spec.get("normalizer") or {}).get("normalizers", [])
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    space = [n.get("content") for n in normalises if n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"}]
    return (
        [n["type"] for n in normalises] == _NORMALISES
        and space == [" "]
        and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        and (cuts[0]["pattern"], cuts[0]["behavior"], cuts[0]["invert"]) == ({"Regex": _CUTS}, "Removed", True)
        and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
        and all(t["content"].startswith("<|") for t in spec["added_tokens"])
    )


def ids_of_texts(path: str, column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[np.ndarray]:
    """Ids of every text of a string column, no special tokens added.

    The tokenizer drops white space and never joins across it, so a text's ids are
    those of its words. Words are split and numbered by Arrow for a few MB of
    texts at a time, and each different word is encoded once. Texts of a file that
    cuts in another way are encoded whole by the library.
    """
    if not cut_as_known(path):
        for texts_at_once in _chunks(column, chunk_bytes):
            for ids in _tokenizer(path)[0].encode_batch(texts_at_once.to_pylist(), add_special_tokens=False):
                yield np.array(ids.ids, "<u4")
        return
    for texts_at_once in _chunks(column, chunk_bytes):
        words = pc.ascii_split_whitespace(texts_at_once)
        numbered = words.flatten().dictionary_encode()
        firsts = words.offsets.to_numpy() - words.offsets[0].as_py()
        del words
        pool, lengths = _ids_of_words(path, numbered.dictionary.cast(pa.large_string()), chunk_bytes)
        flat, ends = _gathered(pool, lengths, numbered.indices.to_numpy())
        at = np.concatenate([[0], ends])[firsts]
        del numbered, ends
        for low, high in zip(at, at[1:]):
            yield flat[low:high]


def _gathered(pool: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequences numbered ``which`` of those that stand in ``pool`` one after the other, and where each ends."""
    n = lengths[which]
    ends = np.cumsum(n, dtype=np.int32)
    first = (np.cumsum(lengths, dtype=np.int32) - lengths)[which]
    first += n
    first -= ends
    take = np.repeat(first, n)
    take += np.arange(len(take), dtype=np.int32)
    return pool[take], ends


def _ids_of_words(path: str, words: pa.Array, most_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words one after the other, and how many each has.

    In the Latin range the tokenizer's normalisation is plain lower-casing and its
    letters, digits and marks are known, so a word is cut as it cuts it and the
    pieces go to its model. Other words go to the library as they are.
    """
    tokenizer, pieces = _tokenizer(path)
    is_odd = pc.match_substring_regex(words, _ODD_WORD)
    pool, lengths = pieces.ids_of_words(pc.utf8_lower(words.filter(pc.invert(is_odd))), most_bytes)
    odd = np.flatnonzero(is_odd.to_numpy(zero_copy_only=False))
    if not len(odd):
        return pool, lengths
    found = [np.array(e.ids, "<u4") for e in tokenizer.encode_batch(words.take(pa.array(odd)).to_pylist(), add_special_tokens=False)]
    both = np.concatenate([lengths, np.fromiter(map(len, found), np.int32, len(found))])
    place = np.empty(len(words), np.int64)
    place[odd] = np.arange(len(lengths), len(both))
    place[np.flatnonzero(~is_odd.to_numpy(zero_copy_only=False))] = np.arange(len(lengths))
    return _gathered(np.concatenate([pool, *found]), both, place)[0], both[place]


class _Pieces:
    """Ids of pieces of words, remembered by a worker (``most_bytes`` twice over; then those of the last words, or none).

    ``known`` holds the pieces, their ids stand one after the other in ``pool``,
    ``lengths`` each. The first is the end of a word, which has no ids.
    """

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer(tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.ends_piece = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if getattr(tokenizer.model, "end_of_word_suffix", None) == _LAST_OF_PIECE:
            self.ends_piece[[i for token, i in vocabulary.items() if token.endswith(_LAST_OF_PIECE)]] = True
        self.known, self.pool, self.lengths = pa.array(["\n"], pa.large_string()), np.zeros(0, "<u4"), np.zeros(1, np.int32)

    def ids_of_words(self, words: pa.Array, most_bytes: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case words of the Latin range one after the other, and how many each has."""
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(0, np.int32)
        parts = [pa.array(_PIECE.findall(text + "\n"), pa.large_string()) for text in _joined(words, "\n", _WORDS_AT_ONCE)]
        numbered = pa.chunked_array([self.known, *parts]).dictionary_encode()
        del parts
        all_known = numbered.chunk(0).dictionary
        ids, lengths = self._encoded(all_known.slice(len(self.known)))
        self.known, self.pool, self.lengths = all_known, np.concatenate([self.pool, ids]), np.concatenate([self.lengths, lengths])
        which = np.concatenate([c.indices.to_numpy() for c in numbered.chunks[1:]])
        ids, ends = _gathered(self.pool, self.lengths, which)
        if self.nbytes() > 2 * most_bytes:
            self._keep(np.flatnonzero(np.bincount(which)))
        if self.nbytes() > 2 * most_bytes:
            self._keep(np.zeros(1, np.int64))
        return ids, np.diff(ends[which == 0], prepend=0)

    def nbytes(self) -> int:
        return self.known.nbytes + self.pool.nbytes + self.lengths.nbytes

    def _keep(self, which: np.ndarray) -> None:
        self.pool = _gathered(self.pool, self.lengths, which)[0]
        self.known, self.lengths = self.known.take(pa.array(which)), self.lengths[which]

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [self.pool[:0]]
        for text in _joined(pieces, " ", _PIECES_AT_ONCE):
            text = text if text.isascii() and text.isprintable() else _byte_letters(text)
            found.append(np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.ends_piece[ids])
        if len(ends) == len(pieces):
            return ids, np.diff(ends, prepend=-1).astype(np.int32)
        # a vocabulary that leaves out bytes or doesn't mark the last token of a piece
        each = [[t.id for t in self.model.model.tokenize(_byte_letters(p))] for p in pieces.to_pylist()]
        return np.array([i for x in each for i in x], "<u4"), np.array([len(x) for x in each], np.int32)


def _joined(words: pa.Array, between: str, at_once: int) -> Iterator[str]:
    """The words as texts of ``at_once`` words each (the last has the rest)."""
    for low in range(0, len(words), at_once):
        some = words.slice(low, at_once)
        yield pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some), pa.scalar(between, pa.large_string()))[0].as_py()


def _byte_letters(text: str) -> str:
    return text.encode().decode("latin-1").translate(_BYTE_LETTERS)


def _chunks(column: pa.Array, most_bytes: int) -> Iterator[pa.Array]:
    """Slices of the column (nulls as empty) of about ``most_bytes``, a longer text by itself."""
    if column.null_count:
        column = pc.fill_null(column, "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)) // most_bytes
    cuts = [0, *(np.flatnonzero(np.diff(ends) > 0) + 1), len(column)]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield column.slice(low, high - low)
            pa.default_memory_pool().release_unused()


def _filled(n: np.ndarray) -> np.ndarray:
    """Of the places of sequences of ``n`` values, each padded to fours: whether a value stands there."""
    ends = np.cumsum((n + 3) // 4 * 4)
    out = np.ones(ends[-1] if len(ends) else 0, bool)
    for k in range(1, 4):
        out[(ends - k)[-n % 4 >= k]] = False
    return out


def _used(code: np.ndarray, width: int) -> np.ndarray:
    """Which bytes of values of ``width`` bytes are kept, one more than ``code`` each."""
    out = np.ones((len(code), width), bool)
    for k in range(1, width):
        out[:, k] = code >= k
    return out.reshape(-1)


def vbyte_encode(values: np.ndarray, n: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control bytes and data bytes of sequences of unsigned 32-bit values, ``n`` values each, one after the other."""
    v = values.astype("<u4", copy=False)
    width = max(1, (int(v.max(initial=0)).bit_length() + 7) // 8)
    code = np.zeros(len(v), np.uint8)
    for k in range(1, width):
        code += v >= 1 << 8 * k
    filled = _filled(n)
    four = np.zeros(len(filled), np.uint8)
    four[filled] = code
    four = four.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8).tobytes()
    if width <= 2:
        v = v.astype("<u2")
    data = v.view(np.uint8)[_used(code, v.itemsize)].tobytes()
    ends = np.concatenate([[0], np.cumsum(n)])
    of_data = (np.concatenate([[0], np.cumsum(code, dtype=np.int64)])[ends] + ends).tolist()
    of_control = np.concatenate([[0], np.cumsum((n + 3) // 4)]).tolist()
    return [control[a:b] for a, b in zip(of_control, of_control[1:])], [data[a:b] for a, b in zip(of_data, of_data[1:])]


def vbyte_decode(control: bytes, data: bytes, n: np.ndarray) -> np.ndarray:
    """Values of sequences of ``n`` values each, whose control bytes and data bytes stand one after the other."""
    code = _CODES[np.frombuffer(control, np.uint8)].reshape(-1)[_filled(n)]
    kind = np.dtype("<u2" if code.max(initial=0) < 2 else "<u4")
    out = np.zeros(len(code) * kind.itemsize, np.uint8)
    out[_used(code, kind.itemsize)] = np.frombuffer(data, np.uint8)
    return out.view(kind).astype("<u4", copy=False)


def tokenized(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian uint16 where every id fits, else uint32, then 4 bytes a token)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("wide", pa.bool_()), ("ids", pa.binary())])

    def run(batches):
        def rows():
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for i, tokens in zip(ids, ids_of_texts(tokenizer_path, batch.column("text"), chunk_bytes), strict=True):
                    tokens = np.append(tokens, np.uint32(end_id))
                    wide = bool(tokens.max() > 0xFFFF)
                    yield i, len(tokens), wide, tokens.astype("<u4" if wide else "<u2").tobytes()

        yield from in_batches(rows(), schema, most_bytes=8 << 20)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, wide boolean, ids binary")


def _ids(ids: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(ids, "<u4" if wide else "<u2").astype("<u4")


def frequency_ranks(tokens: DataFrame) -> DataFrame:
    """``rank, id``: ids that occur, most frequent first, ties by id. Each task sends one row per id it saw."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            each = [_ids(ids, wide) for ids, wide in zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist(), strict=True)]
            if each:
                c = np.bincount(np.concatenate(each), minlength=len(total))
                c[: len(total)] += total
                total = c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    counts = tokens.select("ids", "wide").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # one row per id of the vocabulary, whatever the corpus
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), "id")) - 1
    return counts.select(rank.cast("int").alias("rank"), "id")


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Tokenize ``docs`` and write ``folder/ranks`` and ``folder/files``."""
    spark = docs.sparkSession
    tokens = stored(tokenized(docs, tokenizer_path, id_col, text_col, end_id, chunk_bytes), "token-ids")
    frequency_ranks(tokens).write.parquet(f"{folder}/ranks")
    table = spark.read.parquet(f"{folder}/ranks").collect()
    rank_of = np.zeros(max([0, *(r["id"] for r in table)]) + 1, "<u4")
    for r in table:
        rank_of[r["id"]] = r["rank"]
    shared = spark.sparkContext.broadcast(rank_of)
    schema = pa.schema([("record", pa.binary())])

    def encode(batches):
        def rows():
            for batch in batches:
                for low in range(0, batch.num_rows, 512):
                    part = batch.slice(low, 512)
                    names, wide, ids = (part.column(c).to_pylist() for c in ("doc_id", "wide", "ids"))
                    each = [_ids(x, w) for x, w in zip(ids, wide, strict=True)]
                    n = np.array([len(x) for x in each])
                    for i, count, control, data in zip(names, n.tolist(), *vbyte_encode(shared.value[np.concatenate(each)], n), strict=True):
                        yield (struct.pack(_HEAD, i or 0, i is None, count, len(control), len(data)) + control + data,)

        yield from in_batches(rows(), schema, most_bytes=8 << 20)

    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    by_id = F.col("doc_id").asc_nulls_first()
    placed = tokens.repartitionByRange(max(1, -(-total // TOKENS_A_FILE)), by_id).sortWithinPartitions(by_id, "ids")
    placed.mapInArrow(encode, "record binary").select(F.col("record").cast("string")).write.option("lineSep", "\n").text(f"{folder}/files")


def _decoded(spark: SparkSession, folder: str, last: str, of_ids) -> DataFrame:
    """``part, doc_id, before, n_tokens`` and ``of_ids(ids)`` of every record, file by file; before counts within the file."""
    table = spark.read.parquet(f"{folder}/ranks").collect()
    id_of = np.zeros(len(table), "<u4")
    for r in table:
        id_of[r["rank"]] = r["id"]
    shared = spark.sparkContext.broadcast(id_of)
    kind = {"binary": pa.binary(), "long": pa.int64()}[last.split()[1]]
    schema = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), (last.split()[0], kind)])

    def decode(batches):
        def rows():
            for batch in batches:
                for part, content in zip(batch.column("part").to_pylist(), batch.column("content"), strict=True):
                    view, at, before = memoryview(content.as_buffer()), 0, 0
                    while at < len(view):
                        heads, control, data = [], [], []
                        while at < len(view) and len(heads) < 512:
                            i, null, n, c, d = struct.unpack_from(_HEAD, view, at)
                            at += struct.calcsize(_HEAD)
                            heads.append((None if null else i, n))
                            control.append(view[at : at + c])
                            data.append(view[at + c : at + c + d])
                            at += c + d + 1
                        ids = shared.value[vbyte_decode(b"".join(control), b"".join(data), np.array([n for _, n in heads]))]
                        first = 0
                        for i, n in heads:
                            yield part, i, before, n, of_ids(ids[first : first + n])
                            first += n
                            before += n

        yield from in_batches(rows(), schema, most_bytes=8 << 20)

    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    files = spark.read.format("binaryFile").load(f"{folder}/files")
    return files.select(number.alias("part"), "content").mapInArrow(decode, f"part long, doc_id long, before long, n_tokens long, {last}")


def _with_start(rows: DataFrame) -> DataFrame:
    """``start``, the ids of all records before, in place of ``part`` and ``before``; the window is over one row per file."""
    per_file = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_file = per_file.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return rows.join(per_file, "part").withColumn("start", F.col("base") + F.col("before")).drop("part", "before", "base")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, n_tokens, ids, start`` of the files' records, ids as little-endian uint32."""
    return _with_start(_decoded(spark, folder, "ids binary", lambda ids: ids.tobytes()))


def token_digest(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the files' records."""
    rows = stored(_decoded(spark, folder, "ids_crc32 long", lambda ids: zlib.crc32(ids.tobytes())), "token-digest")
    return _with_start(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_binary(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write the token files and report what they hold when read back: ``doc_id, start, n_tokens, ids_crc32``.

    One row per input row. A null or empty text is the end id alone. Rows are in
    ascending id order, null ids first; rows that repeat an id follow each other
    in order of their ids. Further columns are ignored; an empty table
    gives no rows.
    """
    folder = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer_path, id_col, text_col, end_id, chunk_bytes)
    return token_digest(docs.sparkSession, folder)
