"""Groups of spelling variants: words one edit apart, found with k-d trees over letter counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import require
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin

#: Letters are a-z without case and the Latin-1 letters; a word needs this many and must occur this often.
LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT = 7, 2
#: An occurrence whose hash this divides loses one letter.
DROP_EVERY = 31
#: The more frequent spelling occurs at least so many times as often.
FACTOR = 10
#: Words sampled to place the tree's cuts, words aimed at per leaf and words per bucket inside a leaf.
SAMPLE, LEAF, BUCKET = 200_000, 1 << 16, 64
#: Words of a leaf and queries put before one task at a time, and queries searched side by side.
POINTS, QUERIES, STEP = 1 << 18, 1 << 16, 1 << 14
CHARSET = "iso-8859-1"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    drop_every: int = DROP_EVERY,
) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough.

    With ``drop_every`` an occurrence loses one letter when the crc32 of ``<id>:<word>`` is a multiple of
    it, the letter at that hash modulo the word's length; 0 leaves every word as it is. Counts combine
    before the shuffle.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    # A run is maximal: it starts where the letters start and takes all of them.
    runs = docs.select(
        doc.alias("doc"), F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("run")
    )
    word = F.col("run")
    if drop_every:
        h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
        at = (h % F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(h % drop_every == 0, cut).otherwise(word)
    counts = runs.select(word.alias("word")).filter(F.length("word") >= min_length).groupBy("word")
    return counts.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def letter_code(words: np.ndarray) -> np.ndarray:
    """Letter counts of equally long words, given as rows of characters, in unary: two bits per class.

    Classes are a to z and six for all other letters; a count is taken up to two. The number of bits in
    which two codes differ is the L1 distance of these counts, never more than that of the full counts.
    """
    kind = np.where((words >= 97) & (words <= 122), words - 97, 26 + words % 6).astype(np.uint64)
    code = np.zeros(len(words), np.uint64)
    one = np.uint64(1)
    for column in kind.T:
        bit = one << (column * np.uint64(2))
        code |= np.where(code & bit, bit << one, bit)
    return code


def _rows_of(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode(CHARSET), np.uint8).reshape(len(words), length)


class Tree:
    """A k-d tree over letter codes: each node asks whether a count reaches one or two.

    ``bit`` holds the asked bit of a node, or -1 for a leaf; the children of node i are ``child[i]`` and
    the node after it. Leaves are numbered in ``leaf``.
    """

    def __init__(self, codes: np.ndarray, aim: float):
        self.bit, self.child, self.leaf = [], [], []
        self.members: list[np.ndarray] = []
        todo = [np.arange(len(codes))]
        nodes = [self._node()]
        while todo:
            rows, node = todo.pop(), nodes.pop()
            bit = self._cut(codes[rows]) if len(rows) > aim else -1
            if bit < 0:
                self.leaf[node] = len(self.members)
                self.members.append(rows)
                continue
            has = (codes[rows] >> np.uint64(bit)) & np.uint64(1) == 1
            left, right = self._node(), self._node()
            self.bit[node], self.child[node] = bit, left
            todo += [rows[~has], rows[has]]
            nodes += [left, right]
        self.bit, self.child, self.leaf = (np.array(a, np.int64) for a in (self.bit, self.child, self.leaf))

    def _node(self) -> int:
        self.bit.append(-1)
        self.child.append(-1)
        self.leaf.append(-1)
        return len(self.bit) - 1

    @staticmethod
    def _cut(codes: np.ndarray) -> int:
        """The bit that halves the codes best, -1 when they are all the same."""
        bits = np.unpackbits(codes.astype("<u8").view(np.uint8).reshape(len(codes), 8), axis=1, bitorder="little")
        held = bits.sum(axis=0, dtype=np.int64)
        best = int(np.argmin(np.abs(2 * held - len(codes))))
        return best if 0 < held[best] < len(codes) else -1

    def home(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each code."""
        query, leaf = self.search(codes, 0, 0)
        out = np.empty(len(codes), np.int64)
        out[query] = leaf
        return out

    def search(self, codes: np.ndarray, fewer: int, more: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of all leaves whose box may hold a code with at most ``fewer`` bits less and ``more`` bits more."""
        query, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        less, plus = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        found_query, found_leaf = [], []
        while len(query):
            bit = self.bit[node]
            end = bit < 0
            found_query.append(query[end])
            found_leaf.append(self.leaf[node[end]])
            query, node, less, plus, bit = (a[~end] for a in (query, node, less, plus, bit))
            has = (codes[query] >> bit.astype(np.uint64)) & np.uint64(1) == 1
            child = self.child[node]
            # Without the bit on the first side, with it on the other.
            query = np.concatenate([query, query])
            node = np.concatenate([child, child + 1])
            less = np.concatenate([less + has, less])
            plus = np.concatenate([plus, plus + ~has])
            near = (less <= fewer) & (plus <= more)
            query, node, less, plus = query[near], node[near], less[near], plus[near]
        return np.concatenate(found_query), np.concatenate(found_leaf)


def _limits(query_length: int, length: int) -> tuple[int, int]:
    """Letters that a word of ``length`` may have less and more than a query one edit away."""
    return {-1: (1, 0), 0: (1, 1), 1: (0, 1)}[length - query_length]


class _Index:
    """The words of one leaf: a tree down to small buckets with tight boxes, and the letters to verify with."""

    def __init__(self, words: list[str], length: int):
        self.letters = _rows_of(words, length)
        codes = letter_code(self.letters)
        tree = Tree(codes, BUCKET)
        self.tree, self.members = tree, np.concatenate(tree.members)
        self.codes = codes[self.members]
        self.sizes = np.array([len(m) for m in tree.members])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.low = np.bitwise_and.reduceat(self.codes, self.begins)
        self.high = np.bitwise_or.reduceat(self.codes, self.begins)

    def near(self, letters: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) of all pairs that are one edit apart."""
        fewer, more = _limits(letters.shape[1], length)
        codes = letter_code(letters)
        query, bucket = self.tree.search(codes, fewer, more)
        near = self._within(codes[query], self.high[bucket], self.low[bucket], fewer, more)
        query, bucket = query[near], bucket[near]
        order = np.argsort(bucket, kind="stable")
        query, bucket = query[order], bucket[order]
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        found_query, found_place = [query[:0]], [query[:0]]
        for start, end in zip(starts, np.append(starts[1:], len(bucket))):
            first, some = self.begins[bucket[start]], query[start:end]
            mine = self.codes[None, first : first + self.sizes[bucket[start]]]
            row, column = np.nonzero(self._within(codes[some][:, None], mine, mine, fewer, more))
            found_query.append(some[row])
            found_place.append(first + column)
        query, word = np.concatenate(found_query), self.members[np.concatenate(found_place)]
        right = one_edit(letters[query], self.letters[word])
        return query[right], word[right]

    @staticmethod
    def _within(code: np.ndarray, high: np.ndarray, low: np.ndarray, fewer: int, more: int) -> np.ndarray:
        return (np.bitwise_count(code & ~high) <= fewer) & (np.bitwise_count(low & ~code) <= more)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words given as rows of letters differ by exactly one letter put in, left out or replaced."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    size = a.shape[1]
    ahead = np.cumprod(a == b[:, :size], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
    return ahead + behind >= size


class _Ranked:
    """Words with their place by falling count, then by letters: the best of several has the lowest place."""

    def __init__(self, words: list[str], n: np.ndarray):
        self.words, self.n = np.array(words, object), n
        self.place = np.empty(len(words), np.int64)
        self.place[np.lexsort((np.array(words, str), -n))] = np.arange(len(words))

    def summary(self, mine: np.ndarray, theirs: np.ndarray, other: "_Ranked") -> tuple[np.ndarray, ...]:
        """Columns (word, n_near, near, near_n) from pairs of places here and in the other list."""
        order = np.lexsort((other.place[theirs], mine))
        mine, theirs = mine[order], theirs[order]
        begins = np.flatnonzero(np.diff(mine, prepend=-1))
        best = theirs[begins]
        return self.words[mine[begins]], np.diff(begins, append=len(mine)), other.words[best], other.n[best]


def _fit_trees(words: DataFrame) -> tuple[dict[int, tuple[Tree, int]], int]:
    """Length to (tree, number of its first leaf), fitted on at most ``SAMPLE`` words chosen by hash."""
    sizes = dict(words.groupBy(F.length("word")).count().collect())  # one row per word length
    share = min(1.0, SAMPLE / max(1, sum(sizes.values())))
    chosen = words.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample: dict[int, list[str]] = {}
    for (word,) in chosen.select("word").limit(SAMPLE).collect():
        sample.setdefault(len(word), []).append(word)
    trees, leaves = {}, 0
    for length, size in sorted(sizes.items()):
        held = sample.get(length, [])
        codes = letter_code(_rows_of(held, length)) if held else np.zeros(0, np.uint64)
        # At least a few sampled words a leaf, else the cuts would follow chance.
        trees[length] = (Tree(codes, max(LEAF * len(held) / size, 4)), leaves)
        leaves += len(trees[length][0].members)
    return trees, leaves


def _by_length(words: pd.Series) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """(length, places, words) of the words of each length."""
    lengths = words.str.len().to_numpy()
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        yield length, places, words.iloc[places].tolist()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): how many words are one edit away, and the most frequent of them.

    A tree of letter counts is cut for each word length, from a bounded sample of the words; all words are
    then put into its leaves. A word is sent to its own leaf, to the later leaves of its length and to
    those of the next longer length whose boxes lie near enough, and is compared there inside a finer
    tree; so two words of different leaves meet once, and the meeting counts for both. A block gives one
    row per word with its count and best word, so no list of pairs is made. Leaves with many words or
    queries are cut into blocks.
    """
    trees, leaves = _fit_trees(words)
    shared = words.sparkSession.sparkContext.broadcast(trees)

    def homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaf = np.zeros(len(batch), np.int64)
            for length, places, some in _by_length(batch["word"]):
                tree, first = shared.value[length]
                leaf[places] = first + tree.home(letter_code(_rows_of(some, length)))
            yield batch.assign(leaf=leaf)

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, places, some in _by_length(batch["word"]):
                codes, names, n = letter_code(_rows_of(some, length)), np.array(some, object), batch["n"].to_numpy()[places]
                home = shared.value[length][0].home(codes)
                for other in (length, length + 1):
                    if other in shared.value:
                        tree, first = shared.value[other]
                        query, leaf = tree.search(codes, *_limits(length, other))
                        own = (leaf == home[query]) & (other == length)
                        later = own | (leaf > home[query]) | (other > length)
                        query, leaf, own = query[later], leaf[later], own[later]
                        yield pd.DataFrame({"word": names[query], "n": n[query], "leaf": first + leaf, "own": own})

    points = pin(words.mapInPandas(homes, "word string, n long, leaf long"), "points")
    queries = pin(words.mapInPandas(visits, "word string, n long, leaf long, own boolean"), "queries")
    # One row per leaf.
    blocks = points.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / POINTS).alias("points"))
    asked = queries.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("queries"))
    blocks = pin(blocks.join(asked, "leaf", "left").fillna(1, "queries"), "blocks")
    total = blocks.agg(F.sum(F.col("points") * F.col("queries"))).first()[0] or 1

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one block of its own side, repeated for the blocks of the other side."""
        rows = keyed_join(rows, blocks, ["leaf"], "inner")
        mine = F.pmod(F.xxhash64("word"), F.col(own))
        theirs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1))
        rows = rows.withColumn(own, mine).withColumn(other, theirs)
        return rows.repartition(int(min(total, 20_000)), "leaf", "points", "queries")

    def compared(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(points) and len(queries):
            words = points["word"].tolist()
            index, right = _Index(words, len(words[0])), _Ranked(words, points["n"].to_numpy())
            for own, mine in queries.groupby("own"):
                for length, places, some in _by_length(mine["word"]):
                    n = mine["n"].to_numpy()[places]
                    for begin in range(0, len(some), STEP):
                        left = _Ranked(some[begin : begin + STEP], n[begin : begin + STEP])
                        query, word = index.near(_rows_of(left.words.tolist(), length), len(words[0]))
                        out.append(left.summary(query, word, right))
                        if not own:
                            out.append(right.summary(word, query, left))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, object)] * 4
        return pd.DataFrame(dict(zip(("word", "n_near", "near", "near_n"), columns)))

    keys = ["leaf", "points", "queries"]
    left, right = dealt(points, "points", "queries"), dealt(queries, "queries", "points")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        compared, "word string, n_near long, near string, near_n long"
    )
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form. A form is at least ``FACTOR`` times as frequent, so chains are short."""
    chains = pin(forms.select("word", F.col("form").alias("root")), "chains")
    reach, longest = 1, len(str(1 << 63))
    while reach < longest:
        step = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chains = keyed_join(chains, step, ["root"], "left")
        chains = pin(chains.select("word", F.coalesce("next", "root").alias("root")), "chains")
        reach *= 2
    return chains


def group_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    drop_every: int = DROP_EVERY,
    factor: int = FACTOR,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of the texts.

    ``form`` is the most frequent word one edit away (ties: the smallest in code-point order) if it is
    at least ``factor`` times as frequent; ``root`` follows forms to the last one.

    Null and empty texts hold no words; a null id counts as empty text; repeated rows count again; other
    columns are ignored. An empty table gives no rows. Letters outside Latin-1 end a word.
    """
    require(docs, id_col, text_col)
    if factor < 10:
        raise ValueError("factor must be at least 10: chains of forms are followed a bounded number of steps")
    words = pin(words_of(docs, id_col, text_col, min_length, min_count, drop_every), "words")
    near = keyed_join(words, pin(near_words(words), "near"), ["word"], "left")
    enough = F.col("near_n") >= factor * F.col("n")
    near = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n"),
    )
    near = pin(near, "forms")
    roots = _roots(near.filter(F.col("form").isNotNull()))
    return keyed_join(near, roots, ["word"], "left").withColumn("root", F.coalesce("root", "word"))
