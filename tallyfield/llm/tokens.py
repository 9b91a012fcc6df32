"""Token ids of a document table in a compressed, checksummed block file, and back."""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Split

from tallyfield.llm.coder import decode_blocks, encode_blocks
from tallyfield.llm.common import bound_batches, require
from tallyfield.session import pin, scratch_path

#: Ids per block, blocks held at a time, and words remembered per worker.
BLOCK_IDS = 1 << 21
SIDE_BY_SIDE = 1
REMEMBERED = 1 << 18
#: Bytes of text whose words are numbered at a time, and unmet runs of letters that are handed to the library in one text.
TEXT_BYTES = 8 << 20
TOGETHER = 200
END_ID = 1

BLOCK = (
    "part int, block int, first_row long, offset long, n int, continues boolean, "
    "nulls int, doc_ids array<long>, doc_sizes array<int>, ends boolean, body binary"
)
BLOCK_SCHEMA = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("first_row", pa.int64()), ("offset", pa.int64()), ("n", pa.int32()),
     ("continues", pa.bool_()), ("nulls", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
     ("doc_sizes", pa.list_(pa.int32())), ("ends", pa.bool_()), ("body", pa.binary())]
)
_encoders: dict[str, "Words"] = {}

#: A word that is Latin letters and then ASCII punctuation without an apostrophe.
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")
LETTERS = "".join(chr(c) for c in range(33, 256) if PLAIN.fullmatch(chr(c)))
MARKS = "".join(chr(c) for c in range(33, 127) if (found := PLAIN.fullmatch("a" + chr(c))) and found[2])
#: The four separators are blanks to a split at white space and symbols to a tokenizer.
SEPARATORS = "\x1c\x1d\x1e\x1f"


class Words(dict):
    """Words of a tokenizer that neither keeps white space nor joins it to a word, encoded once and remembered.

    Maps a word to its ids as bytes. At half of ``REMEMBERED`` words a new generation begins, which
    takes over from the one before only the words that it meets again.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.runs: dict[str, array] = {}
        self.forget()
        mapped = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.bytes_of = {ord(c): mapped(c)[0][0] for c in LETTERS}
        probe = ["ab", "a'b", "it's", "x,y.", "Z9", "\u00e9!", "Stra\u00dfe,", "The***", "\u00c9t\u00e9.", "n_a", "<|a|>"]
        self.letters_apart = True
        self.letters_apart = all(list(self.ids_of(x)) == self.whole(x) for x in probe)
        text = "  " + " \n\t".join(probe) + " "
        self.splits_at_blanks = self.whole(text) == [i for x in probe for i in self.whole(x)]
        # The same model without normalising, for runs of letters already in its own alphabet.
        self.bare = Tokenizer(self.model)
        self.bare.pre_tokenizer = Split(" ", "removed")
        suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for x, i in tokenizer.get_vocab().items() if x.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.runs.clear()
        self.older: dict[str, bytes] = {}
        self.place: dict[str, int] = {}
        self.pool, self.sizes, self.met = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def ids_of(self, word: str) -> array:
        """Ids of a word; letters and the punctuation behind them are looked up apart where that is the same."""
        plain = PLAIN.fullmatch(word) if self.letters_apart else None
        if plain is None:
            return array("I", self.whole(word))
        letters, rest = plain[1].lower(), plain[2]
        found = self.runs.get(letters)
        if found is None:
            found = array("I", [x.id for x in self.model.tokenize(letters.translate(self.bytes_of))])
            self.runs[letters] = found
        if rest:
            if rest not in self.runs:
                self.runs[rest] = array("I", self.whole(rest))
            found = found + self.runs[rest]
        return found

    def places(self, runs: list[str]) -> np.ndarray:
        """Places in ``sizes``, and so in ``pool``, of the ids of distinct lower-case runs of letters."""
        if len(self.place) + len(runs) > REMEMBERED:
            # What was met most often stays: a quarter at most, and nothing met once.
            kept = np.sort(np.argsort(-self.met, kind="stable")[: REMEMBERED // 4])
            kept = kept[self.met[kept] > 1]
            names = list(self.place)
            self.place = {names[k]: i for i, k in enumerate(kept.tolist())}
            self.pool, self.sizes = _ragged(self.pool, self.sizes, kept), self.sizes[kept]
            self.met = self.met[kept] // 2
        known = self.place
        unmet = [x for x in runs if x not in known]
        if unmet:
            ids, sizes = self.many(unmet)
            known.update(zip(unmet, range(len(known), len(known) + len(unmet))))
            self.pool, self.sizes = np.append(self.pool, ids), np.append(self.sizes, sizes)
            self.met = np.append(self.met, np.zeros(len(unmet), np.int64))
        places = np.fromiter(map(known.__getitem__, runs), np.int64, len(runs))
        self.met[places] += 1
        return places

    def many(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case runs of letters, and how many each has.

        Many runs go to the library as one text. Where a model marks the last id of a word, and only that,
        the marks tell the runs apart.
        """
        found = []
        for k in range(0, len(runs), TOGETHER):
            text = " ".join([x if x.isascii() else x.translate(self.bytes_of) for x in runs[k : k + TOGETHER]])
            # Of a batch of one, since only a batch can leave out the offsets.
            found.append(np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32))
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.ends.take(ids))
        if len(ends) == len(runs) and ends[-1] == len(ids) - 1:
            return ids, np.diff(ends, prepend=-1)
        found = [self.ids_of(x) for x in runs]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found])

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.ids_of(word).tobytes()
        self[word] = found
        return found

    def age(self) -> None:
        if len(self) > REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
            self.runs.clear()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        self.age()
        return np.frombuffer(b"".join(map(self.__getitem__, text.split())), np.uint32)


def _encoder(text: str) -> Words:
    """This worker's encoder for a tokenizer given as JSON text."""
    # Tasks, not threads, share out the cores.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Words(Tokenizer.from_str(text))
    return _encoders[key]


def encode_text(text: str, words: Words) -> np.ndarray:
    """The ids of a text without special tokens."""
    if words.splits_at_blanks and not any(c in text for c in SEPARATORS):
        return words.encode(text)
    return np.array(words.whole(text), np.uint32)


def _ragged(values: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The stretches of ``values``, which lie behind each other with these sizes, in another order."""
    own = sizes.take(order)
    first = (np.cumsum(sizes) - sizes).take(order)
    first -= np.cumsum(own) - own
    at = np.repeat(first, own)
    at += np.arange(len(at))
    return values.take(at)


def _joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), np.uint32), np.array([len(x) // 4 for x in ids], np.int64)


def encode_texts(texts: pa.Array, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts without special tokens, text behind text, and how many each has.

    Arrow splits the texts and numbers the distinct words, and of plain ones the distinct letters and
    punctuation; the ids of those are looked up and laid out by number.
    """
    if not (words.splits_at_blanks and words.letters_apart):
        found = [encode_text(x, words) for x in texts.to_pylist()]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
    words.age()
    split = pc.utf8_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    distinct, order = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    letters = pc.utf8_rtrim(distinct, characters=MARKS)
    plain = pc.match_substring_regex(letters, f"^[{LETTERS}]+$")
    runs = pc.utf8_lower(letters.filter(plain)).dictionary_encode()
    marks = pc.utf8_ltrim(distinct.filter(plain), characters=LETTERS).dictionary_encode()
    place = words.places(runs.dictionary.to_pylist())
    plain = plain.to_numpy(zero_copy_only=False)
    other = distinct.filter(pa.array(~plain)).to_pylist()
    more, sizes = _joined([words[x] for x in (*marks.dictionary.to_pylist(), *other, "")])
    # Two stretches of ids for each distinct word: letters and marks, or all and nothing.
    known = len(words.sizes)
    parts = np.full((len(distinct), 2), known + len(sizes) - 1)
    parts[plain, 0] = place.take(runs.indices.to_numpy())
    parts[plain, 1] = known + marks.indices.to_numpy()
    parts[~plain, 0] = known + len(marks.dictionary) + np.arange(len(other))
    sizes = np.append(words.sizes, sizes)
    ids = _ragged(np.append(words.pool, more), sizes, parts.reshape(-1))
    sizes = sizes.take(parts).sum(axis=1)
    ends = np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64))
    del split, coded, distinct, letters, runs, marks, other, parts
    ids = _ragged(ids, sizes, order)
    upto = np.append(0, np.cumsum(sizes.take(order)))
    sizes = np.diff(upto.take(ends), prepend=0)
    odd = np.flatnonzero(pc.match_substring_regex(texts, f"[{SEPARATORS}]").to_numpy(zero_copy_only=False))
    if len(odd):
        pieces = np.split(ids, np.cumsum(sizes)[:-1])
        for k in odd.tolist():
            pieces[k] = encode_text(texts[k].as_py(), words)
            sizes[k] = len(pieces[k])
        ids = np.concatenate(pieces)
    return ids, sizes


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined until they hold ``TEXT_BYTES``."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(x.nbytes for x in held) >= TEXT_BYTES:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def write_token_file(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> str:
    """Write the ids of all texts, in ascending id order (nulls first), and return the folder.

    The table is range-partitioned by id; each task encodes its stretch, cuts the stream of ids into
    blocks regardless of document bounds, and codes each block's lanes side by side. A block carries
    the ids and sizes of the documents in it, so it can be read on its own. Rows of one id are ordered
    by text. Spark's writer commits a task's file once, whatever attempts were lost. Null texts are
    empty and give the end id alone.
    """
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    bound_batches(spark)
    folder = folder or scratch_path(spark, "token-file")
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _encoder(shared.value)
        size = max(words.tokenizer.get_vocab_size(), end_id + 1)
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        sizes: list[int] = []
        ids: list[int | None] = []
        waiting, block, first_row, offset, continues = 0, 0, 0, 0, False

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal held, sizes, ids, waiting, block, first_row, offset, continues
            stream = np.concatenate(held)
            held = []
            count = -(-len(stream) // BLOCK_IDS) if last else len(stream) // BLOCK_IDS
            cuts = [stream[k * BLOCK_IDS : (k + 1) * BLOCK_IDS] for k in range(count)]
            out, at = [], 0
            for cut, body in zip(cuts, encode_blocks(cuts, size)):
                room, doc_ids, doc_sizes = len(cut), [], []
                goes_on, row = continues, first_row
                while room:
                    take = min(room, sizes[at])
                    doc_ids.append(ids[at])
                    doc_sizes.append(take)
                    room -= take
                    sizes[at] -= take
                    if sizes[at]:
                        continues = True
                    else:
                        at, first_row, continues = at + 1, first_row + 1, False
                nulls = sum(x is None for x in doc_ids)  # they come first
                doc_ids = [x or 0 for x in doc_ids]
                out.append((part, block, row, offset, len(cut), goes_on, nulls, doc_ids, doc_sizes, not continues, body))
                block, offset = block + 1, offset + len(cut)
            rest = stream[sum(map(len, cuts)) :]
            held, sizes, ids, waiting = [rest], sizes[at:], ids[at:], len(rest)
            columns = list(zip(*out)) or [()] * len(BLOCK_SCHEMA)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)

        for batch in _gathered(batches):
            found, counts = encode_texts(batch.column("text").combine_chunks(), words)
            held.append(np.insert(found, np.cumsum(counts), np.uint32(end_id)))
            sizes += (counts + 1).tolist()
            ids += batch.column("id").to_pylist()
            waiting += len(held[-1])
            if waiting >= BLOCK_IDS * SIDE_BY_SIDE:
                yield flush(False)
        if waiting:
            yield flush(True)

    placed.mapInArrow(encode, BLOCK).write.parquet(folder)
    return folder


def _times(matrix: tuple[int, ...], vector: int) -> int:
    """A bit vector times a bit matrix, given as its rows."""
    out, k = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[k]
        vector >>= 1
        k += 1
    return out


@cache
def _zero_bytes(power: int) -> tuple[int, ...]:
    """What 2**power zero bytes do to a crc32, as a bit matrix."""
    if power < 0:  # bits
        step = (0xEDB88320, *(1 << k for k in range(31)))
        for _ in range(3 + power):
            step = tuple(_times(step, x) for x in step)
        return step
    half = _zero_bytes(power - 1)
    return tuple(_times(half, x) for x in half)


def combine_crc(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings joined, from their crcs and the second one's length."""
    power = 0
    while size:
        if size & 1:
            first = _times(_zero_bytes(power), first)
        size >>= 1
        power += 1
    return first ^ second


PIECE = "part int, row long, doc_id long, at long, n long, crc long, whole boolean"


def read_token_file(df: DataFrame | None = None, spark=None, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a token file, all blocks decoded.

    A block with a wrong checksum fails the read. Documents that cross blocks are put together from
    the lengths and checksums of their pieces.
    """
    blocks = df if df is not None else spark.read.schema(BLOCK).parquet(folder)
    bound_batches(blocks.sparkSession)
    parts = blocks.groupBy("part").agg(F.sum(F.col("n").cast("bigint")).alias("size"))
    # One row per written file part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("part").alias("p"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))

    def pieces_of(batch: list) -> pd.DataFrame:
        out = []
        for b, ids in zip(batch, decode_blocks([b.body for b in batch])):
            if len(ids) != b.n:
                raise ValueError("block length differs")
            data, at, last = ids.tobytes(), 0, len(b.doc_sizes) - 1
            for k, (doc_id, size) in enumerate(zip(b.doc_ids, b.doc_sizes)):
                size = int(size)
                cut = (k == 0 and b.continues) or (k == last and not b.ends)
                crc = zlib.crc32(data[4 * at : 4 * (at + size)])
                doc = None if k < b.nulls else int(doc_id)
                out.append((b.part, b.first_row + k, doc, b.offset + at, size, crc, not cut))
                at += size
        return pd.DataFrame(out, columns=[x.split()[0] for x in PIECE.split(", ")]).astype({"doc_id": "Int64"})

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for batch in batches:
            held += batch.itertuples(index=False)
            while len(held) >= SIDE_BY_SIDE:
                yield pieces_of(held[:SIDE_BY_SIDE])
                held = held[SIDE_BY_SIDE:]
        if held:
            yield pieces_of(held)

    pieces = blocks.mapInPandas(decode, PIECE)

    @F.pandas_udf(T.LongType())
    def joined(lists: pd.Series) -> pd.Series:
        out = []
        for pieces in lists:
            crc = 0
            for piece in sorted(pieces, key=lambda x: x["at"]):
                crc = combine_crc(crc, piece["crc"], 4 * piece["n"])
            out.append(crc)
        return pd.Series(out)

    # Written once, so that no block is decoded twice; a document has one narrow row per block it crosses.
    pieces = pin(pieces, "pieces")
    cut = pieces.filter(~F.col("whole")).groupBy("part", "row", "doc_id")
    broken = cut.agg(
        F.min("at").alias("at"), F.sum("n").alias("n"), F.collect_list(F.struct("at", "n", "crc")).alias("pieces")
    ).withColumn("crc", joined("pieces"))
    columns = ["part", "doc_id", "at", "n", "crc"]
    found = pieces.filter("whole").select(columns).unionByName(broken.select(columns))
    found = found.join(F.broadcast(starts), F.col("part") == F.col("p"))
    return found.select("doc_id", (F.col("base") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def encode_and_read(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Write the token file and read it back: one row per document. An empty table gives no rows."""
    folder = write_token_file(docs, tokenizer_path, None, id_col, text_col, end_id)
    found = read_token_file(spark=docs.sparkSession, folder=folder)
    return found.withColumnRenamed("doc_id", id_col)
