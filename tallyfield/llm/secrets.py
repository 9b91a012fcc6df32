"""Secret scan: fixed patterns, and strings that stay incompressible beside what surrounds them."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.llm.common import require

KINDS = ("assign", "access", "hex", "novel")
#: The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Words that make a long string beside them worth measuring.
SENSITIVE = re.compile(
    r"(?:password|passwd|pwd|secret|token|api[_-]?key|private[_ -]?key|credential|authorization|bearer|auth|signature)",
    re.I | re.A,
)
LEAST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.~-]{{{LEAST},}}")
INNER = re.compile(r"=+(?=[^=])")
#: Characters before a candidate in which a sensitive word counts, and around it that it is measured against.
BEFORE = 48
AROUND = 512
#: A string is reported when its marginal compressed bytes reach this share of the mean of so many random
#: strings of the same alphabet and length at the same place, or reach the cheapest of them (short strings vary).
NOVELTY = 0.9
REFERENCES = 12
ALPHABETS = ("0123456789", "0123456789abcdef", "0123456789ABCDEF")
CLASSES = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
#: Names that code is full of; the compressor knows them beforehand.
IDENTIFIERS = " ".join(
    f"{a}{b}"
    for a in ("get", "set", "is", "new", "load", "read", "write", "user", "client", "server", "config", "default",
              "access", "auth", "secret", "token", "password", "api_key", "private_key", "session", "request")
    for b in ("", "Name", "Value", "Path", "File", "Id", "Key", "Token", "_name", "_value", "_path", "_file", "_id",
              "_key", "_token", "_url", "_example", "_placeholder", "_here", "Service", "Manager", "Factory")
)


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    words = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=3, dict_data=words, write_checksum=False, write_content_size=False)


def alphabet(candidate: str) -> str:
    """The least usual alphabet that holds a string: digits, hex of one case, or classes and its other signs."""
    signs = set(candidate.rstrip("="))
    for known in ALPHABETS:
        if signs <= set(known):
            return known
    held = "".join(c for c in CLASSES if not signs.isdisjoint(c))
    return held + "".join(sorted(signs.difference(held)))


@lru_cache(maxsize=4096)
def _random(letters: str, length: int, draw: int) -> bytes:
    return "".join(random.Random(f"{letters} {length} {draw}").choices(letters, k=length)).encode()


def novelty(candidate: str, before: str, after: str) -> float:
    """Marginal compressed bytes of a string, given its surroundings and the identifiers, as a share of
    what random strings of its alphabet and length take there; 1 and more is reported."""
    context, squeeze = (before + "\n" + after + "\n").encode(), _compressor().compress
    alone = len(squeeze(context))
    letters = alphabet(candidate)
    usual = [len(squeeze(context + _random(letters, len(candidate), k))) - alone for k in range(REFERENCES)]
    # Repeats of one sign or two are cheap for themselves: nothing is compared with less than random digits.
    least = max(min(min(usual), NOVELTY * sum(usual) / REFERENCES), NOVELTY * len(candidate) * math.log2(10) / 8)
    return max(len(squeeze(context + candidate.encode())) - alone, 0) / least


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the strings to measure: a run is cut after each = that is not padding, so a key never
    counts as part of its value. Without a long value part, all after the first = is the value, or else the run."""
    for m in CANDIDATE.finditer(text):
        starts = [m.start(), *(m.start() + x.end() for x in INNER.finditer(m.group()))]
        parts = [x for x in zip(starts, [*starts[1:], m.end()]) if x[1] - x[0] >= LEAST]
        if len(starts) > 1 and not any(a > m.start() for a, _ in parts):
            if m.end() - starts[1] >= LEAST:
                parts.append((starts[1], m.end()))
            else:
                parts = [(m.start(), m.end())]
        yield from parts


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans of one text, in code points, by start and then kind as listed."""
    spans = []
    lowered = text.lower()
    hinted = any(x in lowered for x in ("passw", "secret", "token", "api_key", "apikey", "key", "auth", "bearer", "pwd", "credential", "signature"))
    if hinted:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_VALUE:
                spans.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if hinted:
        taken = sorted(spans)
        at = 0
        for start, end in candidates(text):
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if at < len(taken) and taken[at][0] < end:
                continue
            if not SENSITIVE.search(text, max(0, start - BEFORE), start):
                continue
            around = text[max(0, start - AROUND) : start], text[end : end + AROUND]
            if novelty(text[start:end], *around) >= 1:
                spans.append((start, end, "novel"))
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))


def secret_spans(text: Column) -> Column:
    """Array of (start, end, kind) per text; empty for null.

    assign, access and hex are the base patterns, leftmost and non-overlapping per kind. novel adds
    strings of 16 or more characters after a sensitive word, outside every base span, that cost zstandard,
    primed with identifiers and the text around, about as much as random strings of their alphabet and length. Work is linear in the text.
    """
    span = T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]
    )

    @F.pandas_udf(T.ArrayType(span))
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"start": a, "end": b, "kind": k} for a, b, k in find_secrets(x)] if x else [] for x in texts], dtype=object
        )

    return of(text)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and spans for every row, repeated rows included; no rows for an empty table."""
    require(docs, id_col, text_col)
    return docs.select(F.col(id_col), secret_spans(F.col(text_col)).alias("spans"))


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, all spans as text, and a hash of the base spans."""

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s.kind != "novel")
    return found.select(
        id_col,
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("novel").alias("n_novel"),
    )


def sha256_of_spans(spans: list[tuple[int, int, str]]) -> str:
    """The hash of base spans, for checks."""
    text = ",".join(f"{k}:{a}:{b}" for a, b, k in spans if k != "novel")
    return hashlib.sha256(text.encode()).hexdigest()
