"""Benchmark decontamination by templates: numbers, names and units become typed slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import require, words
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin

#: Words of a template window, and the share of an item's windows that a document must hold.
WINDOW = 5
SIMILARITY = 0.8
#: Share of slot fillings that must follow one mapping from the item's values to the document's.
CONSISTENCY = 0.8
#: Words of a window that must not be slots; windows with fewer say nothing about the item.
LITERALS = 2
#: Typed placeholders.
NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"
SLOTS = f"[{NUMBER}{UNIT}{NAME}]"
#: Units, as they follow a number.
UNITS = (
    "mm cm dm m km inch inches foot feet ft yard yards mile miles mg g kg t ton tons lb lbs pound pounds ounce ounces "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years dollar dollars cent cents euro euros percent degrees km/h mph m/s w kw kwh v"
).split()


def canonical(line: Column) -> Column:
    """Template of a text whose words stand one blank apart; word for word, so places stay the same.

    A number becomes NUMBER, a unit after a number UNIT, a capitalised word inside a sentence NAME;
    other words are lowered and lose everything but letters and digits.
    """
    # Each pattern starts with a character that few places have, so the costlier looks around it are rare.
    out = F.regexp_replace(line, r" (?<=[\p{L}\p{N},;:)] )\p{Lu}[\p{L}\p{M}'-]*", f" {NAME}")
    out = F.regexp_replace(out, r"(?=[+$€£\d-])(?<![\p{L}\p{N}])[+-]?[$€£]?\d+(?:[.,:/]\d+)*%?(?![\p{L}\p{N}])", NUMBER)
    out = F.regexp_replace(out, rf"{NUMBER} (?i:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"{NUMBER} {UNIT}")
    return F.lower(F.regexp_replace(out, rf"[^\p{{L}}\p{{M}}\p{{N}} {NUMBER}{UNIT}{NAME}]+", ""))


def verbatim(line: Column) -> Column:
    """The words of such a text lowered, without the signs at the edges of those that hold a letter or digit."""
    inside, sign = r"[\p{L}\p{M}\p{N}]", r"[^\p{L}\p{M}\p{N} ]+"
    edge = rf"(?={sign})(?:(?<![^ ]){sign}(?={inside})|(?<={inside}){sign}(?![^ ]))"
    return F.regexp_replace(F.lower(line), edge, "")


def _tokens(df: DataFrame, text_col: str) -> DataFrame:
    """Adds tokens (as written), template (canonical) and exact (verbatim), of equal length."""
    spaced = df.withColumn("tokens", words(F.col(text_col))).withColumn("line", F.array_join("tokens", " "))

    def split(line: Column) -> Column:
        return F.when(F.size("tokens") > 0, F.split(line, " ")).otherwise(F.array().cast("array<string>"))

    return spaced.select(
        "*", split(canonical(F.col("line"))).alias("template"), split(verbatim(F.col("line"))).alias("exact")
    ).drop("line")


def _word_hashes(piece: Column) -> Column:
    return F.transform(piece, lambda w: F.xxhash64(w))


def _exact_word_hashes(piece: Column) -> Column:
    """Words of verbatim windows have hashes apart from those of templates."""
    return F.transform(piece, lambda w: F.xxhash64(F.lit("verbatim"), w))


def _windows(hashed: Column, length: int) -> Column:
    """A 64-bit hash of each run of ``length`` words, combined from their own hashes.

    Equals ``xxhash64`` of the run's array of word hashes, so an item's window may be hashed as one piece.
    """
    starts = F.when(F.size(hashed) >= length, F.sequence(F.lit(0), F.size(hashed) - length))
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(length)])
    )


def _item_windows(items: DataFrame) -> DataFrame:
    """(item, length, words, at, unit, hash, piece, values) of all informative windows; short items are one window.

    The first word has two readings: as it stands, and as it would read after another word or number
    (NAME or UNIT). Both are rows of the same ``unit``, and ``held`` is the word a second reading must meet.
    """
    sized = items.withColumn("length", F.least(F.size("template"), F.lit(WINDOW))).filter("length > 0")
    starts = F.sequence(F.lit(1), F.size("template") - F.col("length") + 1)
    inner = F.split(canonical(F.concat(F.lit("1 "), F.array_join("tokens", " "))), " ")[1]
    cut = sized.select(
        "item", "length", F.size("template").alias("words"), F.explode(starts).alias("at"), "template", "tokens", inner.alias("inner")
    )
    piece = F.slice("template", F.col("at"), F.col("length"))
    rows = cut.select(
        "item", "length", "words", "at", F.xxhash64(piece).alias("unit"), piece.alias("piece"),
        F.slice("tokens", F.col("at"), F.col("length")).alias("values"), "inner",
    )
    literal = F.size(F.filter("piece", lambda w: ~w.rlike(SLOTS) & (w != "")))
    rows = rows.filter(literal >= F.least(F.lit(LITERALS), F.col("length")))
    other = F.concat(F.array("inner"), F.slice("piece", 2, WINDOW))
    second = rows.filter((F.col("at") == 1) & (F.col("inner") != F.col("piece")[0]))
    second = second.withColumn("piece", other).withColumn("held", _plain(F.col("values")[0]))
    both = rows.withColumn("held", F.lit(None).cast("string")).unionByName(second).drop("inner")
    return both.withColumn("hash", F.xxhash64(_word_hashes(F.col("piece"))))


def _exact_windows(items: DataFrame) -> DataFrame:
    """(item, length, hash) of all verbatim windows, whatever slots they hold."""
    sized = items.withColumn("length", F.least(F.size("exact"), F.lit(WINDOW))).filter("length > 0")
    starts = F.sequence(F.lit(1), F.size("exact") - F.col("length") + 1)
    cut = sized.select("item", "length", F.explode(starts).alias("at"), "exact")
    return cut.select("item", "length", F.xxhash64(_exact_word_hashes(F.slice("exact", F.col("at"), F.col("length")))).alias("hash")).distinct()


def _plain(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}.]+|\.$", "")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("doc"), F.col(text_col).alias("text")
    )


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, doc, item_id, coverage, slots, consistency, same_values) per document that holds an item.

    ``doc`` hashes id and text, so repeated rows are one. Every window of five template words of every
    whole text is looked up among the items' windows; ``coverage`` is the share of an item's distinct
    windows found, at least 0.8. The fillings of the slots are then compared: a re-parameterised copy
    maps each value of the item to one value of the document, so at least 0.8 of the fillings must
    follow the most frequent mapping. Each place of the document where the item may stand is judged on
    its own (see ``_judge``), and the best is told. Beside the templates, windows of lowered words are
    looked up as they stand, with any share of slots: 0.8 of those make a leak too, so a text of
    names, numbers or capitals is found verbatim. ``same_values`` tells verbatim copies. Items of fewer words
    are one window. Null and empty texts and items hold nothing; empty tables give no rows; ids may be
    null; equal items are reported each.
    """
    require(docs, id_col, text_col)
    require(items, item_id_col, item_text_col)
    named = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    named = named.withColumn("item", F.xxhash64("text"))
    distinct = named.dropDuplicates(["item"])
    cut = _tokens(distinct.select("item", "text"), "text")
    wanted = pin(_item_windows(cut), "item-windows")
    sizes = wanted.groupBy("item").agg(F.countDistinct("unit").alias("all"))
    exact = _exact_windows(cut).select("item", F.lit(True).alias("exact"), F.col("hash").alias("unit"), "hash", "length")
    keys = wanted.select("item", F.lit(False).alias("exact"), "unit", "hash", "length").unionByName(exact).distinct()
    totals = keys.groupBy("item", "exact").agg(F.countDistinct("unit").alias("all"))
    keys = pin(keys.join(totals, ["item", "exact"]), "item-keys")
    lengths = sorted(r[0] for r in keys.select("length").distinct().collect())  # at most WINDOW numbers
    rows = _keyed(docs, id_col, text_col)
    if not lengths:
        return rows.select("id", "doc", F.lit(0).alias("item_id"), F.lit(0.0).alias("coverage"), F.lit(0).alias("slots"),
                           F.lit(0.0).alias("consistency"), F.lit(True).alias("same_values")).filter("false")
    # Hashes only: a generated row must not carry the text. Distinct keys first, then the items they belong to.
    # Each word is hashed once, however many windows it stands in.
    hashes = F.concat(*[_windows(F.col(side), n) for side in ("template", "exact") for n in lengths])
    hashed = _tokens(rows, "text").select(
        "id", "doc", _word_hashes(F.col("template")).alias("template"), _exact_word_hashes(F.col("exact")).alias("exact")
    )
    exploded = hashed.select("id", "doc", F.explode(hashes).alias("hash"))
    hits = keyed_join(exploded, pin(keys.select("hash").distinct(), "hashes"), ["hash"], "left_semi").distinct()
    per_item = keyed_join(pin(hits, "hits"), keys, ["hash"], "inner")
    covered = (
        per_item.groupBy("id", "doc", "item", "exact")
        .agg((F.countDistinct("unit") / F.first("all")).alias("coverage"))
        .filter(F.col("coverage") >= SIMILARITY)
    )
    candidates = pin(
        covered.groupBy("id", "doc", "item").agg(F.max("coverage").alias("coverage"), F.max("exact").alias("exact")), "candidates"
    )
    # Second look, at candidate documents only: where do the windows stand, and what fills the slots?
    some = keyed_join(rows, pin(candidates.select("doc").distinct(), "suspects"), ["doc"], "left_semi")
    some = _tokens(some.dropDuplicates(["doc"]), "text").select("doc", "tokens", _word_hashes(F.col("template")).alias("hashed"))
    hits = []
    for n in lengths:
        zipped = F.transform(
            _windows(F.col("hashed"), n),
            lambda h, i: F.struct(h.alias("hash"), (i + 1).alias("place"), F.slice("tokens", i + 1, n).alias("found")),
        )
        seen = some.select("doc", F.inline(zipped))
        own = wanted.filter(F.col("length") == n)
        met = keyed_join(seen, pin(own, "own-windows"), ["hash"], "inner").join(
            candidates.select("doc", "item"), ["doc", "item"], "left_semi"
        )
        met = met.filter(F.col("held").isNull() | (F.col("held") == _plain(F.col("found")[0])))
        hits.append(met.select("doc", "item", "unit", "words", (F.col("place") - F.col("at")).alias("offset"), _fills().alias("fills")))
    met = hits[0]
    for other in hits[1:]:
        met = met.unionByName(other)
    # A verbatim copy is a leak whatever its templates say.
    judged = candidates.join(_judge(met, sizes), ["doc", "item"], "left").filter(F.col("exact") | F.col("slots").isNotNull())
    return judged.join(named.select("item", "item_id"), "item").select(
        "id", "doc", "item_id", F.round("coverage", 6).alias("coverage"), F.coalesce("slots", F.lit(0)).alias("slots"),
        F.round(F.coalesce("consistency", F.lit(1.0)), 6).alias("consistency"),
        (F.col("exact") | F.coalesce("same_values", F.lit(False))).alias("same_values"),
    )


def _fills() -> Column:
    """(value, found) of each slot of a window that was met."""

    slots = F.filter(F.arrays_zip("piece", "values", "found"), lambda t: t.piece.rlike(SLOTS))
    return F.transform(slots, lambda t: F.struct(_plain(t["values"]).alias("value"), _plain(t["found"]).alias("found")))


def _judge(met: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc, item, slots, consistency, same_values) of the best group of windows that makes a leak.

    A window that was met belongs to several groups: windows at the same offset between document and
    item; offsets within the item's length of each other (words put in or left out; two copies one
    after the other never share such a group); windows with the item's own values, wherever they stand; and
    all of them. One group with enough coverage and consistency is enough, so copies with other
    fillings, sibling items and chance windows elsewhere take nothing from it.
    """
    step = F.greatest(F.floor(F.col("words") / 2), F.lit(1)).cast("int")
    band = F.floor(F.col("offset") / step).cast("int")
    same = F.forall("fills", lambda t: t.value == t.found)

    def group(kind: str, place: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), place.cast("int").alias("place"))

    groups = F.array_compact(
        F.array(
            group("all", F.lit(0)), group("offset", F.col("offset")), group("near", band), group("near", band - 1),
            F.when(same, group("same", F.lit(0))),
        )
    )
    keys = ["doc", "item", "kind", "place"]
    spread = met.select("doc", "item", "unit", "fills", F.inline(groups))
    covered = spread.groupBy(*keys).agg(F.countDistinct("unit").alias("met")).join(sizes, "item")
    covered = covered.filter(F.col("met") / F.col("all") >= SIMILARITY).select(*keys, "met")
    covered = pin(covered, "alignments")
    fills = spread.join(covered, keys, "left_semi").select(*keys, F.inline("fills"))
    counted = fills.groupBy(*keys, "value", "found").agg(F.count(F.lit(1)).alias("n"))
    mapped = counted.groupBy(*keys, "value").agg(
        F.max("n").alias("most"), F.sum("n").alias("n"), F.sum(F.when(F.col("value") == F.col("found"), F.col("n")).otherwise(0)).alias("same")
    )
    verdict = mapped.groupBy(*keys).agg(
        F.sum("n").alias("slots"), (F.sum("most") / F.sum("n")).alias("consistency"), (F.sum("same") == F.sum("n")).alias("same_values")
    )
    judged = covered.join(verdict, keys, "left").select(
        "doc", "item", "met", F.coalesce("slots", F.lit(0)).alias("slots"),
        F.coalesce("consistency", F.lit(1.0)).alias("consistency"), F.coalesce("same_values", F.lit(True)).alias("same_values"),
    )
    best = F.max(F.struct("same_values", "consistency", "met", "slots")).alias("best")
    kept = judged.filter(F.col("consistency") >= CONSISTENCY).groupBy("doc", "item").agg(best)
    return kept.select("doc", "item", "best.slots", "best.consistency", "best.same_values")


def drop_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with the columns of ``docs``."""
    found = find_leaks(docs, items, id_col, text_col, item_id_col, item_text_col)
    mark = "doc_" + "".join(docs.columns)[:200]
    bad = pin(found.select(F.col("doc").alias(mark)).distinct(), "leaks")
    marked = docs.withColumn(mark, F.xxhash64(F.col(id_col), F.col(text_col)))
    return keyed_join(marked, bad, [mark], "left_anti").select(*docs.columns)
