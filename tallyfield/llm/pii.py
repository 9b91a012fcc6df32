"""Format-preserving pseudonyms for personal data, in native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import require

#: What is looked for, in order of preference where two could start at one place.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,256}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
DATE = r"(?<![\d.-])(?:19|20)\d\d-\d\d-\d\d(?![\d-])"
IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d])\d(?:[ -]?\d){12,18}(?![\d])"
#: A letter inside a word fails both branches at once.
PATTERN = f"{EMAIL}|(?=[0-9+(])(?:{'|'.join((DATE, IPV4, SOCIAL, PHONE, CARD))})"
ROUNDS = 6
#: Days from 1900-01-01 to 2099-12-31, and the sides of a rectangle that holds them.
DAYS, LONG_SIDE, SHORT_SIDE = 73_049, 271, 270


def _round_value(key: str, label: str, value: Column, k: int) -> Column:
    """A pseudo-random 60-bit number from key, field, round and text."""
    digest = F.sha2(F.concat(F.lit(f"{key}|{label}|{k}|"), value).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def permute_digits(digits: Column, key: str, label: str) -> Column:
    """A keyed permutation of the digit strings of each length (alternating Feistel over decimal halves).

    Up to 36 digits; both halves then fit in a long. One digit is shifted by the key. The same digits
    always give the same result, and different digits different ones.
    """
    n = F.length(digits)
    low_size = F.floor(n / 2).cast("int")
    high_size = n - low_size
    state = F.struct(
        F.substring(digits, F.lit(1), high_size).cast("bigint").alias("a"),
        F.coalesce(F.substring(digits, high_size + 1, low_size).cast("bigint"), F.lit(0).cast("bigint")).alias("b"),
    )
    high, low = F.pow(F.lit(10), high_size).cast("bigint"), F.pow(F.lit(10), low_size).cast("bigint")

    def turn(s: Column, k: Column) -> Column:
        def noise(half: Column, side: str) -> Column:
            tail = F.concat_ws(",", k.cast("string"), n.cast("string"), half.cast("string"))
            return _round_value(key, label + side, tail, 0)

        a = F.pmod(s.a + noise(s.b, "a"), high).cast("bigint")
        b = F.when(low_size > 0, F.pmod(s.b + noise(a, "b"), low)).otherwise(s.b).cast("bigint")
        return F.struct(a.alias("a"), b.alias("b"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state, turn)

    def joined(s: Column) -> Column:
        tail = F.when(low_size > 0, F.lpad(s.b.cast("string"), low_size, F.lit("0"))).otherwise("")
        return F.concat(F.lpad(s.a.cast("string"), high_size, F.lit("0")), tail)

    return F.element_at(F.transform(F.array(done), joined), 1)


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``; all else stays."""
    chars = F.split(shape, "")
    step = F.aggregate(
        chars,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(
            c.rlike("[0-9]"), F.struct(F.concat(s.out, F.substring(digits, s.at, F.lit(1))).alias("out"), (s.at + 1).alias("at"))
        ).otherwise(F.struct(F.concat(s.out, c).alias("out"), s.at.alias("at"))),
        lambda s: s.out,
    )
    return step


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string; a valid number gives a multiple of 10."""
    places = F.split(F.reverse(digits), "")
    return F.aggregate(
        F.transform(
            places,
            lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
                F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int"))
            ),
        ),
        F.lit(0),
        lambda s, x: s + F.coalesce(x, F.lit(0)),
    )


def kind_of(match: Column) -> Column:
    """The kind of a match, or null where validation fails."""
    digits = _digits(match)
    parts = F.split(match, r"\.")
    octets = F.forall(parts, lambda p: p.cast("int") <= 255)
    social = ~match.rlike(r"^(000|666|9..)|-00-|-0000$")
    return (
        F.when(match.contains("@"), "email")
        .when(match.rlike(r"^(19|20)\d\d-\d\d-\d\d$"), F.when(F.try_to_timestamp(match, F.lit("yyyy-MM-dd")).isNotNull(), "date"))
        .when(match.rlike(r"^\d+\.\d+\.\d+\.\d+$"), F.when(octets, "ip"))
        .when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(social, "ssn"))
        .when(match.rlike(r"^(\+\d{1,3}[ .-])?(\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}$"), "phone")
        .when((luhn_sum(digits) % 10 == 0) & ~digits.rlike("^0+$"), "card")
    )


def _card(match: Column, key: str) -> Column:
    """A card number of the same length and spacing whose check digit is right."""
    digits = _digits(match)
    body = permute_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    filled = F.transform(F.array(body), lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    return _refill(match, F.element_at(filled, 1))


def _date(match: Column, key: str) -> Column:
    """Another day of 1900 to 2099: Feistel rounds on a rectangle of days, repeated until the day is in range."""
    day = F.datediff(F.to_date(match, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date")).cast("bigint")
    start = F.struct(F.floor(day / SHORT_SIDE).alias("a"), (day % SHORT_SIDE).alias("b"), F.lit(False).alias("done"))

    def turn(s: Column, k: Column) -> Column:
        # The same rounds in every walk, so that walks of different days cannot meet.
        label = (k % ROUNDS).cast("string")
        a = F.pmod(s.a + _round_value(key, "date-a", F.concat_ws(",", label, s.b.cast("string")), 0), F.lit(LONG_SIDE))
        b = F.pmod(s.b + _round_value(key, "date-b", F.concat_ws(",", label, a.cast("string")), 0), F.lit(SHORT_SIDE))
        ends = (k % ROUNDS == 0) & (a * SHORT_SIDE + b < DAYS)
        return F.when(s.done, s).otherwise(F.struct(a.alias("a"), b.alias("b"), ends.alias("done")))

    # 121 of 73,170 places lie out of range: eight walks in a row that all miss do not occur.
    def day_of(s: Column) -> Column:
        return F.when(s.done, F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), (s.a * SHORT_SIDE + s.b).cast("int")), "yyyy-MM-dd"))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(8 * ROUNDS)), start, turn, day_of)
    return F.coalesce(walked, match)


def _ip(match: Column, key: str) -> Column:
    """Four octets, permuted as one number of 16 + 16 bits."""
    parts = F.split(match, r"\.")
    a = F.get(parts, 0).cast("bigint") * 256 + F.get(parts, 1).cast("bigint")
    b = F.get(parts, 2).cast("bigint") * 256 + F.get(parts, 3).cast("bigint")

    def turn(s: Column, k: Column) -> Column:
        x = s.a.bitwiseXOR(_round_value(key, "ip-a", F.concat_ws(",", k.cast("string"), s.b.cast("string")), 0) % 65536)
        y = s.b.bitwiseXOR(_round_value(key, "ip-b", F.concat_ws(",", k.cast("string"), x.cast("string")), 0) % 65536)
        return F.struct(x.alias("a"), y.alias("b"))

    def joined(s: Column) -> Column:
        return F.concat_ws(
            ".", F.floor(s.a / 256).cast("string"), (s.a % 256).cast("string"), F.floor(s.b / 256).cast("string"), (s.b % 256).cast("string")
        )

    start = F.struct(a.alias("a"), b.alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, joined)


def _email(match: Column, key: str) -> Column:
    """Letters and digits of the name become keyed ones of their class; the host becomes a reserved one."""
    name = F.substring_index(match, "@", 1)
    token = F.lower(F.sha2(F.concat(F.lit(f"{key}|email|"), F.lower(match)).cast("binary"), 256))
    letters = F.translate(F.substring(token, F.lit(1), F.greatest(F.length(name), F.lit(12))), "0123456789", "ghijklmnop")
    return F.concat(letters, F.lit("@example.invalid"))


def pseudonym(match: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a match of a known kind; an unknown kind stays as it is."""
    return (
        F.when(kind == "email", _email(match, key))
        .when(kind == "date", _date(match, key))
        .when(kind == "ip", _ip(match, key))
        .when((kind == "ssn") | (kind == "phone"), _refill(match, permute_digits(_digits(match), key, "number")))
        .when(kind == "card", _card(match, key))
        .otherwise(match)
    )


def pseudonymise(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = "tallyfield"
) -> DataFrame:
    """id, text with pseudonyms, and found: the kinds replaced, in order of place.

    Card numbers (Luhn), dates (calendar), IPv4 addresses (octets), social security and phone numbers
    are validated and permuted within their format by a keyed Feistel network, so equal values stay
    equal everywhere and different ones stay different; e-mail addresses get a keyed name at a reserved
    host. Matches that fail validation stay. The text between matches is untouched. A null text stays
    null with nothing found. Texts are read whole; work is linear in the text, all in native
    expressions, and each row is on its own, so no group of rows can grow a task.
    """
    require(docs, id_col, text_col)
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Most texts hold neither a digit nor an @, which one look settles.
    found = rows.withColumn(
        "matches",
        F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(
            F.array().cast("array<string>")
        ),
    )
    kinds = found.withColumn("kinds", F.transform("matches", lambda m: kind_of(m)))
    swapped = kinds.withColumn(
        "swapped", F.zip_with("matches", "kinds", lambda m, k: pseudonym(m, k, key))
    ).withColumn("gaps", F.when(F.size("matches") > 0, F.split(text, PATTERN, -1)))
    # One more gap than matches: the last gap meets a null, read as nothing.
    woven = F.array_join(
        F.zip_with("gaps", "swapped", lambda g, m: F.concat(F.coalesce(g, F.lit("")), F.coalesce(m, F.lit("")))), ""
    )
    return swapped.select(
        F.col("id").alias(id_col),
        F.when(F.size("matches") > 0, woven).otherwise(text).alias(text_col),
        F.coalesce(F.filter("kinds", lambda k: k.isNotNull()), F.array().cast("array<string>")).alias("found"),
    )
