"""Near-duplicate documents by SimHash: fingerprints, generalised-pigeonhole search, components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.llm.common import bound_batches, require
from tallyfield.llm.components import connected_components
from tallyfield.session import pin

BITS = 64
SEED = 42
SHINGLE_CHUNK = 1 << 16
#: Cells of the count sketch of one partition's values: 2**SKETCH_BITS counts, whatever the input.
SKETCH_BITS = 16
#: A value with more fingerprints than this is searched in square blocks instead of by the join.
HOT_VALUE = 256
BLOCK = 2048


def simhash(data: bytes, shingle: int) -> int:
    """The fingerprint of one UTF-8 text; see ``fingerprint``."""
    from xxhash import xxh64_intdigest

    tokens = data.lower().split()
    if not tokens:
        return 0
    if len(tokens) < shingle:
        runs: Iterator = iter([tokens])
        n = 1
    else:
        runs = zip(*(tokens[i:] for i in range(shingle)))
        n = len(tokens) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    join = b" ".join
    while part := [xxh64_intdigest(x, SEED) for x in map(join, itertools.islice(runs, SHINGLE_CHUNK))]:
        raw = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash of a text, as a signed long.

    A-Z are lowered, words are runs of anything but blank, tab to carriage return, and each run of
    ``shingle`` words (a shorter text: all its words), joined by blanks, is hashed with XXH64, seed 42.
    Repeated shingles count each time. A bit is 1 when more than half the hashes have it. Null, empty
    and blank texts get 0.
    """

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        found = [0 if x is None else simhash(x.encode(), shingle) for x in texts]
        return pd.Series(np.array(found, np.uint64).view(np.int64))

    return of(text)


def as_hex(value: Column) -> Column:
    """A signed 64-bit value as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _co_occurrence(fingerprints: DataFrame) -> tuple[np.ndarray, int]:
    """How often each pair of bits is set together, and the number of fingerprints."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            ones = _bits(batch["fp"].to_numpy()).astype(np.float32)
            total += ones.T @ ones
            n += len(batch)
        if n:
            i, j = np.nonzero(total)
            yield pd.DataFrame(
                {"i": np.append(i, BITS), "j": np.append(j, BITS), "n": np.append(total[i, j].astype(np.int64), n)}
            )

    sums = fingerprints.mapInPandas(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both, n = np.zeros((BITS, BITS)), 0
    for i, j, k in sums.collect():  # at most 64 * 64 + 1 rows
        if i == BITS:
            n = k
        else:
            both[i, j] = k
    return both, n


def correlated_parts(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` groups of nearly equal width, correlated bits together.

    A group starts with the free bit that is most correlated with the other free ones and takes, one
    by one, the free bit with the highest mean absolute correlation to its members.
    """
    p = np.diag(both) / max(n, 1)
    covariance = both / max(n, 1) - np.outer(p, p)
    scale = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs(covariance / np.outer(scale, scale))
    np.fill_diagonal(related, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        width = BITS * (k + 1) // parts - BITS * k // parts
        inside = related[np.ix_(free, free)].sum(axis=1)
        group = [free.pop(int(np.argmax(inside)))]
        while len(group) < width:
            group.append(free.pop(int(np.argmax(related[np.ix_(free, group)].mean(axis=1)))))
        groups.append(sorted(group))
    return groups


def part_count(n: int, distance: int) -> int:
    """Number of bit groups with the least expected work for ``n`` fingerprints.

    With ``m`` groups the thresholds sum to ``distance - m + 1``; the work of a query is its probes
    plus the fingerprints it meets when values are spread evenly.
    """
    best = (float("inf"), 1)
    for m in range(1, distance + 2):
        width, left = BITS // m, distance - m + 1
        base, more = divmod(left, m)
        ball = [sum(_choose(width, i) for i in range(t + 1)) for t in (base, base + 1)]
        probes = (m - more) * ball[0] + more * ball[1]
        best = min(best, (probes * (1 + n / 2.0**width), m))
    return best[1]


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def part_value(values: np.ndarray, group: list[int]) -> np.ndarray:
    """The bits of ``group``, packed, for each fingerprint."""
    unsigned = values.astype(np.int64).view(np.uint64)
    out = np.zeros(len(values), np.uint64)
    for k, bit in enumerate(group):
        out |= ((unsigned >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def _cells(values: np.ndarray) -> np.ndarray:
    mixed = values * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(BITS - SKETCH_BITS)).astype(np.int64)


def _balls(width: int, radius: int) -> list[np.ndarray]:
    """For each distance up to ``radius``: the masks with so many of ``width`` bits set."""
    return [
        np.array([sum(1 << b for b in bits) for bits in itertools.combinations(range(width), r)], np.uint64)
        for r in range(radius + 1)
    ]


def _sketches(fingerprints: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """Fingerprints per hashed value and group: a table of fixed size."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((len(groups), 1 << SKETCH_BITS), np.int64)
        for batch in batches:
            for k, group in enumerate(groups):
                table[k] += np.bincount(_cells(part_value(batch["fp"].to_numpy(), group)), minlength=1 << SKETCH_BITS)
        k, cell = np.nonzero(table)
        yield pd.DataFrame({"k": k, "cell": cell, "n": table[k, cell]})

    sums = fingerprints.mapInPandas(count, "k int, cell int, n long").groupBy("k", "cell").agg(F.sum("n").alias("n"))
    table = np.zeros((len(groups), 1 << SKETCH_BITS))
    found = sums.toPandas()  # at most len(groups) * 2**SKETCH_BITS rows
    table[found["k"].to_numpy(), found["cell"].to_numpy()] = found["n"].to_numpy()
    return table


def allocate(costs: np.ndarray, total: int) -> np.ndarray:
    """Thresholds per query by dynamic programming.

    ``costs[q, k, t]`` is the estimated cost of threshold ``t - 1`` in group ``k``. Returns the
    thresholds that sum to ``total`` at the least cost for each query.
    """
    queries, parts, levels = costs.shape
    low, high = -parts, total + parts
    best = np.full((queries, high - low + 1), np.inf)
    best[:, -low] = 0
    picks = []
    for k in range(parts):
        step = np.full_like(best, np.inf)
        pick = np.zeros(best.shape, np.int8)
        for t in range(-1, levels - 1):
            moved = np.full_like(best, np.inf)
            if t >= 0:
                moved[:, t:] = best[:, : best.shape[1] - t]
            else:
                moved[:, :t] = best[:, -t:]
            moved += costs[:, k, t + 1][:, None]
            better = moved < step
            step[better] = moved[better]
            pick[better] = t
        best = step
        picks.append(pick)
    at = np.full(queries, total - low)
    out = np.zeros((queries, parts), np.int8)
    rows = np.arange(queries)
    for k in reversed(range(parts)):
        out[:, k] = picks[k][rows, at]
        at = at - out[:, k]
    return out


def _probes(
    fingerprints: DataFrame, groups: list[list[int]], sketch: np.ndarray, n: int, distance: int
) -> DataFrame:
    """One row per (group, value) that a fingerprint has to look up."""
    spark, left = fingerprints.sparkSession, distance - len(groups) + 1
    levels = left + len(groups) + 1  # thresholds -1 .. left + len(groups) - 1
    levels = min(levels, distance + 2, left + 4)
    shared = spark.sparkContext.broadcast(sketch.astype(np.float32))
    noise = n / float(1 << SKETCH_BITS)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        balls = [_balls(len(g), max(levels - 2, 0)) for g in groups]
        for whole in batches:
            for begin in range(0, len(whole), 4096):
                fps = whole["fp"].to_numpy()[begin : begin + 4096]
                costs = np.zeros((len(fps), len(groups), levels))
                values = [part_value(fps, g) for g in groups]
                for k, value in enumerate(values):
                    for t in range(levels - 1):
                        masks = balls[k][t]
                        cost = np.full(len(fps), float(len(masks)))
                        if len(masks) <= 512:
                            met = shared.value[k][_cells(value[:, None] ^ masks[None, :])]
                            cost += np.maximum(met - noise, 0).sum(axis=1) + len(masks) * n / 2.0 ** len(groups[k])
                        else:
                            cost += len(masks) * n / 2.0 ** len(groups[k])
                        costs[:, k, t + 1] = costs[:, k, t] + cost
                thresholds = allocate(costs, left)
                for k, value in enumerate(values):
                    for t in range(levels - 1):
                        use = thresholds[:, k] >= t
                        if use.any():
                            key = value[use][:, None] ^ balls[k][t][None, :]
                            yield pd.DataFrame(
                                {"k": k, "value": key.ravel().view(np.int64), "q": np.repeat(fps[use], key.shape[1])}
                            )

    return fingerprints.mapInPandas(probe, "k int, value long, q long")


def _entries(fingerprints: DataFrame, groups: list[list[int]]) -> DataFrame:
    """One row per fingerprint and group: what probes look up."""

    def entry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy()
            for k, group in enumerate(groups):
                yield pd.DataFrame({"k": k, "value": part_value(fps, group).view(np.int64), "fp": fps})

    return fingerprints.mapInPandas(entry, "k int, value long, fp long")


def _forest(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the close pairs between two sets connect, one per value at most."""
    close = np.bitwise_count(left[:, None].view(np.uint64) ^ right[None, :].view(np.uint64)) <= distance
    left_at, right_at = close.any(axis=1), close.any(axis=0)
    left, right, close = left[left_at], right[right_at], close[np.ix_(left_at, right_at)]
    if not len(left):
        return left, left
    far = len(right)
    label = np.arange(far)
    while True:
        left_label = np.where(close, label[None, :], far).min(axis=1)
        lowered = np.minimum(label, np.where(close, left_label[:, None], far).min(axis=0))
        if (lowered == label).all():
            break
        label = lowered
    a, b = np.concatenate([left, right]), right[np.concatenate([left_label, label])]
    return a[a != b], b[a != b]


def links(fingerprints: DataFrame, distance: int = 3) -> DataFrame:
    """Links (a, b) that connect all fingerprints with at most ``distance`` differing bits.

    ``fingerprints`` has distinct longs in ``fp``. The bits are cut into groups of correlated bits. Two
    values that differ in at most ``distance`` bits differ, in some group, in no more bits than that
    group's threshold, whenever the thresholds sum to ``distance - groups + 1``; each fingerprint gets
    its own thresholds, the ones with the fewest estimated candidates, looks up every value within
    them, and each hit is verified on all bits inside the join. A value shared by more than
    ``HOT_VALUE`` fingerprints is compared in square blocks that give one link per fingerprint, never
    all pairs.
    """
    both, n = _co_occurrence(fingerprints)
    groups = correlated_parts(both, n, part_count(n, distance))
    sketch = _sketches(fingerprints, groups)
    entries = _entries(fingerprints, groups)
    probes = _probes(fingerprints, groups, sketch, n, distance)
    hot = pin(
        entries.groupBy("k", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > HOT_VALUE)
        .withColumn("slices", F.ceil(F.col("n") / BLOCK).cast("int")),
        "hot-values",
    )
    keys = ["k", "value"]
    plain = (
        probes.join(entries, keys)
        .filter((F.col("q") < F.col("fp")) & (F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= distance))
        .select(F.col("q").alias("a"), F.col("fp").alias("b"))
    )
    if hot.isEmpty():
        return plain
    # At most parts * n / HOT_VALUE hot values: a shuffled join with no broadcast hint.
    cool = probes.join(hot, keys, "left_anti")
    plain = (
        cool.join(entries.join(hot, keys, "left_anti"), keys)
        .filter((F.col("q") < F.col("fp")) & (F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= distance))
        .select(F.col("q").alias("a"), F.col("fp").alias("b"))
    )
    asked = probes.join(hot, keys).select(*keys, F.col("q").alias("fp"), "slices", F.lit(True).alias("asks"))
    asking = asked.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("rows"))
    spread = F.pmod(F.xxhash64("fp"), F.col("mine")).cast("int")
    asked = asked.join(asking, keys).withColumn("mine", F.col("rows")).withColumn("row", spread)
    asked = asked.withColumn("column", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    held = (
        entries.join(hot, keys)
        .join(asking, keys)
        .withColumn("mine", F.col("slices"))
        .withColumn("column", spread)
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
        .withColumn("asks", F.lit(False))
    )
    cells = ["k", "value", "row", "column"]
    blocks = asked.select(*cells, "fp", "asks").unionByName(held.select(*cells, "fp", "asks"))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        fps, asks = block["fp"].to_numpy(), block["asks"].to_numpy()
        a, b = _forest(fps[asks], fps[~asks], distance)
        return pd.DataFrame({"a": a, "b": b})

    dense = blocks.groupBy(*cells).applyInPandas(compare, "a long, b long")
    return plain.unionByName(dense)


def _roots(rows: DataFrame, distance: int, least: Column) -> DataFrame:
    """(fp, component): the smallest ``least`` among all rows that links reach from a fingerprint."""
    nodes = pin(rows.groupBy("fp").agg(F.min(least).alias("least")), "nodes")
    roots = connected_components(links(nodes.select("fp"), distance))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        nodes["fp"], "least", F.coalesce("root", nodes["fp"]).alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(names, "root").select("fp", "component")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
) -> DataFrame:
    """Every row's id, fingerprint (long) and component (smallest id that links reach).

    Texts link when their fingerprints differ in at most ``distance`` bits; equal fingerprints are one
    node, so copies cost nothing beyond their own row. Rows with a null id take part; a component of
    null ids alone has a null component. An empty table gives no rows.
    """
    require(docs, id_col, text_col)
    bound_batches(docs.sparkSession)
    rows = pin(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp")), "prints")
    # A fingerprint of very many copies is a hot key of narrow rows: adaptive skew handling splits it.
    return rows.join(_roots(rows, distance, F.col("id")), "fp").select("id", "fp", "component")


def keep_representatives(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
) -> DataFrame:
    """``docs`` with exactly one row of each component: the one with the smallest id, nulls last.

    Of repeated rows with that id one stays. Columns and their order are those of ``docs``.
    """
    require(docs, id_col, text_col)
    bound_batches(docs.sparkSession)
    tail = "_" + "".join(docs.columns)[:200]
    row, fp = f"row{tail}", "fp" if "fp" not in docs.columns else f"fp{tail}"
    whole = pin(
        docs.withColumn(fp, fingerprint(F.col(text_col), shingle)).withColumn(row, F.monotonically_increasing_id()),
        "printed",
    )
    rows = whole.select(F.col(fp).alias("fp"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row").alias("row"))
    leads = _roots(rows, distance, order).select(F.col("component.row").alias(row)).distinct()
    return whole.join(leads, row, "left_semi").select(*docs.columns)
