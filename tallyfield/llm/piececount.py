"""Token counts of a piece tokenizer by merging batches of pre-tokens as ragged arrays."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import require

LIMIT = 4096
#: The sign that stands for a blank in the pieces.
BLANK = "▁"
NEVER = np.int32(1 << 30)
#: Texts are cut into pre-tokens in stretches of about so many characters, and a worker remembers so many.
STRETCH = 1 << 20
REMEMBERED = 1 << 19
#: Longer pre-tokens are merged alone, visiting only the places of each rank.
LONG = 512


class PieceTable:
    """Pieces of a sentencepiece BPE model as arrays: which two symbols merge, at which rank, into what.

    Symbols are numbered from 1; 0 is a character outside the vocabulary, which never merges and ends as
    one token per UTF-8 byte. Two symbols merge when their joined text is a piece; a better score is a
    smaller rank.
    """

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        norm, kinds = spec.normalizer_spec, {p.type for p in spec.pieces}
        plain = norm.name == "identity" and norm.escape_whitespaces and not norm.remove_extra_whitespaces
        bpe = spec.trainer_spec.model_type == proto.TrainerSpec.BPE
        if not (plain and bpe and spec.trainer_spec.byte_fallback) or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with plain normalisation and byte fallback are supported")
        if kinds & {proto.ModelProto.SentencePiece.USER_DEFINED, proto.ModelProto.SentencePiece.UNUSED}:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.prefix = norm.add_dummy_prefix
        normal = proto.ModelProto.SentencePiece.NORMAL
        score = {p.piece: p.score for p in spec.pieces if p.type == normal}
        letters = sorted({c for piece in score for c in piece} - set(score))
        number = {text: i + 1 for i, text in enumerate([*score, *letters])}
        levels = {s: i for i, s in enumerate(sorted(set(score.values()), reverse=True))}
        self._pairs([(a, b) for piece in score for a, b in self._halves(piece, number)], number, score, levels)
        self._letters(number, score)
        self._cuts(score)
        # A rank is settled when it has one piece and no piece that begins or ends with it ranks as low:
        # then all its places in a sequence can merge at once without changing the outcome.
        self.settled = np.ones(len(levels) + 1, bool)
        seen = np.zeros(len(levels) + 1, np.int64)
        for piece, s in score.items():
            seen[levels[s]] += 1
            for part in (piece[:k] for k in range(2, len(piece))):
                self._unsettle(part, piece, score, levels)
            for part in (piece[k:] for k in range(1, len(piece) - 1)):
                self._unsettle(part, piece, score, levels)
        self.settled[seen > 1] = False

    def _unsettle(self, part: str, piece: str, score: dict, levels: dict) -> None:
        if part in score and levels[score[piece]] <= levels[score[part]]:
            self.settled[levels[score[part]]] = False

    @staticmethod
    def _halves(piece: str, number: dict) -> list[tuple[str, str]]:
        cuts = ((piece[:k], piece[k:]) for k in range(1, len(piece)))
        return [(a, b) for a, b in cuts if a in number and b in number]

    def _pairs(self, pairs: list, number: dict, score: dict, levels: dict) -> None:
        keys = np.array([number[a] << 20 | number[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.made = np.array([number[a + b] for a, b in pairs], np.int32)[order]
        self.rank = np.array([levels[score[a + b]] for a, b in pairs], np.int32)[order]
        # A table of the low bits of a mixed key tells most misses without a search.
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * 0x9E3779B97F4A7C1) >> 24) & ((1 << 22) - 1)

    def _letters(self, number: dict, score: dict) -> None:
        self.of_char = np.zeros(0x110000, np.int32)
        single = {c: i for c, i in number.items() if len(c) == 1}
        self.of_char[[ord(c) for c in single]] = list(single.values())
        self.of_char[ord(" ")] = self.of_char[ord(BLANK)]
        # Tokens that a character leaves when it never merges.
        self.cost = np.ones(0x110000, np.int8)
        for bound, size in ((0x80, 2), (0x800, 3), (0x10000, 4)):
            self.cost[bound:] = size
        self.cost[[ord(c) for c in single if c in score]] = 1
        self.cost[ord(" ")] = self.cost[ord(BLANK)]

    def _cuts(self, score: dict) -> None:
        pairs = {(ord(a), ord(b)) for piece in score for a, b in zip(piece, piece[1:])}
        self.together = np.sort(np.array([a << 21 | b for a, b in pairs], np.int64))
        # No piece holds a blank behind a letter: a text can be cut in front of each run of blanks.
        self.blanks_lead = not any(b == ord(BLANK) != a for a, b in pairs)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of neighbouring symbols; rank NEVER when they do not merge."""
        keys = left.astype(np.int64) << 20 | right
        rank, made = np.full(len(keys), NEVER), np.zeros(len(keys), np.int32)
        maybe = np.flatnonzero(self.seen.take(self._slot(keys)))
        at = np.searchsorted(self.keys, keys[maybe])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == keys[maybe]
        maybe, at = maybe[hit], at[hit]
        rank[maybe], made[maybe] = self.rank[at], self.made[at]
        return rank, made


class PieceCounter:
    """Counts tokens of texts; remembers the counts of pre-tokens met before."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.known: dict[str, int] = {}
        # A run of blanks and what follows it, or a text without a leading blank.
        self.split = re.compile(" *[^ ]+| +" if table.blanks_lead else r"(?s).+").findall
        self.next_cut = re.compile("[^ ] ").search

    def stretches(self, text: str) -> Iterator[str]:
        """The text as the model sees it, cut in front of blanks into parts of some STRETCH characters."""
        text = text.replace(BLANK, " ")
        if self.table.prefix and text:
            text = " " + text
        begin = 0
        while self.table.blanks_lead and len(text) - begin > STRETCH:
            cut = self.next_cut(text, begin + STRETCH)
            if cut is None:
                break
            yield text[begin : cut.start() + 1]
            begin = cut.start() + 1
        yield text[begin:]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. New pre-tokens of the whole batch are merged side by side."""
        out = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in self.stretches(text):
                pieces = self.split(part)
                held.append((i, pieces))
                size += len(part)
                if size >= STRETCH:
                    self._settle(held, out)
                    held, size = [], 0
        self._settle(held, out)
        return out

    def _settle(self, held: list[tuple[int, list[str]]], out: list[int]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh = list(set().union(*(pieces for _, pieces in held)) - self.known.keys())
        self.known.update(zip(fresh, merged_counts(fresh, self.table).tolist()))
        for i, pieces in held:
            out[i] += sum(map(self.known.__getitem__, pieces))


def merged_counts(sequences: list[str], table: PieceTable) -> np.ndarray:
    """Symbols left of each sequence when no two neighbours merge any more.

    All sequences lie in one array. In each round every sequence applies its own lowest-rank pair, all at
    the same time: at all its places from the left where the rank is settled, at its first place
    otherwise. A sequence without a pair leaves the array with its count.
    """
    out = np.zeros(len(sequences), np.int64)
    if not sequences:
        return out
    codes = np.frombuffer("".join(sequences).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    owner = np.repeat(np.arange(len(sequences)), lengths)
    sym, cost = table.of_char.take(codes), table.cost.take(codes).astype(np.int64)
    # Characters that are neighbours in no piece never meet in one: what they part is merged apart.
    shown = np.where(codes == 32, ord(BLANK), codes)
    both = shown[:-1] << 21 | shown[1:]
    at = np.searchsorted(table.together, both)
    at[at == len(table.together)] = 0
    apart = (owner[1:] != owner[:-1]) | (table.together[at] != both)
    part = np.concatenate([[0], np.cumsum(apart)])
    sizes = np.bincount(part)
    for k in np.flatnonzero(sizes > LONG):
        mine = part == k
        first = int(np.argmax(mine))
        out[owner[first]] += _merge_long(sym[mine], cost[mine], table)
    keep = sizes[part] <= LONG
    sym, cost, owner, part = sym[keep], cost[keep], owner[keep], part[keep]
    rank, made = _ranks(sym, part, table)
    while len(sym):
        begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        spans = np.diff(begins, append=len(part))
        lowest = np.minimum.reduceat(rank, begins)
        done = np.repeat(lowest == NEVER, spans)
        if done.any():
            out += np.bincount(owner[done], cost[done], len(out)).astype(np.int64)
            left = ~done
            sym, cost, owner, part, rank, made = (a[left] for a in (sym, cost, owner, part, rank, made))
            spans, lowest = spans[lowest < NEVER], lowest[lowest < NEVER]
            if not len(sym):
                break
        places = np.flatnonzero(rank == np.repeat(lowest, spans))
        places = _chosen(places, part[places], table.settled[rank[places]])
        sym[places], cost[places] = made[places], 1
        stay = np.ones(len(sym), bool)
        stay[places + 1] = False
        moved = np.cumsum(stay)[places] - 1
        sym, cost, owner, part, rank, made = (a[stay] for a in (sym, cost, owner, part, rank, made))
        changed = np.zeros(len(sym), bool)
        changed[moved], changed[moved[moved > 0] - 1] = True, True
        touched = np.flatnonzero(changed)
        rank[touched], made[touched] = _ranks_at(touched, sym, part, table)
    return out


def _chosen(places: np.ndarray, part: np.ndarray, settled: np.ndarray) -> np.ndarray:
    """Of the places of each sequence's lowest rank: every second one of a row of neighbours, or the first."""
    turn = np.arange(len(places))
    new_run = np.concatenate([[True], places[1:] != places[:-1] + 1])
    run = np.maximum.accumulate(np.where(new_run, turn, 0))
    first = np.concatenate([[True], part[1:] != part[:-1]])
    return places[np.where(settled, (turn - run) % 2 == 0, first)]


def _ranks(sym: np.ndarray, part: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    return _ranks_at(np.arange(len(sym)), sym, part, table)


def _ranks_at(at: np.ndarray, sym: np.ndarray, part: np.ndarray, table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Rank and merged symbol of the pairs that start at the given places."""
    after = np.minimum(at + 1, len(sym) - 1)
    rank, made = table.lookup(sym[at], sym[after])
    rank[(after == at) | (part[after] != part[at])] = NEVER
    return rank, made


def _merge_long(sym: np.ndarray, cost: np.ndarray, table: PieceTable) -> int:
    """The same rounds for one long sequence, its places kept by rank so that a round costs what it changes."""
    n = len(sym)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    sym, cost = np.append(sym, 0), np.append(cost, 0)
    rank, made = table.lookup(sym[:-1], sym[1:])
    rank, made = np.append(rank, NEVER), np.append(made, 0)
    places: dict[int, list] = {}
    ranks: list[int] = []

    def enter(at: np.ndarray) -> None:
        at = at[rank[at] < NEVER]
        order = np.argsort(rank[at], kind="stable")
        at = at[order]
        values, starts = np.unique(rank[at], return_index=True)
        for value, some in zip(values.tolist(), np.split(at, starts[1:])):
            if value not in places:
                places[value] = []
                heapq.heappush(ranks, value)
            if table.settled[value]:
                places[value].append(some)
            else:
                for place in some.tolist():
                    heapq.heappush(places[value], place)

    enter(np.arange(n))
    while ranks:
        value = ranks[0]
        if table.settled[value]:
            heapq.heappop(ranks)
            at = np.unique(np.concatenate(places.pop(value)))
            at = at[rank[at] == value]
            if not len(at):
                continue
            turn = np.arange(len(at))
            new_run = np.concatenate([[True], after[at[:-1]] != at[1:]])
            run = np.maximum.accumulate(np.where(new_run, turn, 0))
            at = at[(turn - run) % 2 == 0]
        else:
            if not places[value]:
                heapq.heappop(ranks)
                places.pop(value)
                continue
            at = np.array([heapq.heappop(places[value])])
            if rank[at[0]] != value:
                continue
        right = after[at]
        sym[at], cost[at] = made[at], 1
        sym[right], cost[right], rank[right] = 0, 0, NEVER
        after[at] = after[right]
        inner = after[at] < n
        before[after[at][inner]] = at[inner]
        back = before[at]
        touched = np.unique(np.concatenate([at, back[back >= 0]]))
        rank[touched], made[touched] = table.lookup(sym[touched], sym[np.minimum(after[touched], n)])
        enter(touched)
    return int(cost.sum())


_counters: dict[int, PieceCounter] = {}


def count_tokens(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text, as the sentencepiece library counts tokens.

    Each task turns its texts into pre-tokens, merges the ones it has not met yet in ragged arrays and
    adds up; no row is moved between tasks. A null or empty text has no tokens. Repeated rows keep a row
    each, null ids stay null, other columns are ignored; an empty table gives no rows.
    """
    require(docs, id_col, text_col)
    with open(model_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(PieceTable(file.read()))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        key = shared.id if hasattr(shared, "id") else id(shared)
        if key not in _counters:
            _counters.clear()
            _counters[key] = PieceCounter(shared.value)
        for texts in batches:
            yield pd.Series(_counters[key].count(texts.tolist()), dtype="int64")

    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        F.col(id_col), F.octet_length(text).cast("bigint").alias("n_bytes"), tokens(text).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
