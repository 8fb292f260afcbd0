"""Secret scans: fixed patterns, and character Markov models for strings without a known shape.

Two first-order character models are trained from labelled samples: the values
that the patterns find (random strings) and the ordinary words of the texts
(identifiers). A token is a secret when its log-likelihood ratio is above a limit
per transition and another in total, which asks more per character of short ones.
Single separators inside a token belong to it and are not scored. Everything is
DataFrame functions.

Positions come from splitting a text at a pattern: the lengths of the pieces
before a match and of the matches before it give its start in code points.

Defined results: a null text counts as empty; without samples both models are
uniform and nothing is added to the pattern matches; spans of the models never
overlap those of the patterns; repeated rows are judged alike; other columns of
the input are not read; a token may have any number of parts and any length.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds in their order, pattern, group that is the secret, least length of that group.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    # a run that is too short is dropped in any case, so only long ones are looked for
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
MODEL_KIND = "markov"
#: Tokens that the models judge: parts with single separators between them; shorter ones than LEAST cannot reach the limits.
LEAST, SEPARATORS = 8, ".:~"
# Possessive, as nothing follows the parts: the same matches without a stack that grows with their number.
CANDIDATE = rf"(?=[A-Za-z0-9+/_=.:~-]{{{LEAST}}})[A-Za-z0-9+/_=-]++(?:[.:~][A-Za-z0-9+/_=-]++)*+"
#: Texts that the identifier model is trained on, at most: a sample by hash, each text once.
FIT_TEXTS = 2_000
#: Words of a text that count as an identifier.
IDENTIFIER = r"[A-Za-z][A-Za-z0-9_-]{3,}"
#: Log-likelihood ratio per transition from which on a token is a secret.
MIN_RATIO = 0.7
#: Log-likelihood ratio of the whole token from which on it is a secret: the limit of 20 characters.
MIN_TOTAL = 19 * MIN_RATIO
MASK = "[SECRET]"
_LOW, _SIGNS = 32, 96
_BLOCK = 32


def _matches(text: Column, pattern: str) -> tuple[Column, Column]:
    """All matches of a pattern and the pieces around them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(values: Column, levels: int = 3) -> Column:
    """Running totals. Blocks are totalled alone and moved by the running totals of the blocks, so that the work stays
    in proportion to the values; one growing array would be copied for each of them."""
    if not levels:
        return F.aggregate(
            values, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out")),
            lambda acc: acc["out"])
    total = lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x)

    def moved(blocks: Column, ends: Column) -> Column:
        within = lambda block, b: F.transform(
            F.sequence(F.lit(1), F.size(block)), lambda j: F.get(ends, b) - total(block) + total(F.slice(block, F.lit(1), j)))
        return F.flatten(F.transform(blocks, within))

    def by_blocks(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / _BLOCK).cast("int")), lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK)))
        return _let(blocks, lambda bs: _let(_running(F.transform(bs, total), levels - 1), lambda ends: moved(bs, ends)))

    return _let(values, lambda v: F.when(F.size(v) > 0, by_blocks(v)).otherwise(F.array().cast("array<int>")))


def _starts(found: Column, pieces: Column) -> Column:
    """The start of each match, in code points: all pieces up to it and all matches before it."""
    def sizes(f: Column, p: Column) -> Column:
        return F.transform(f, lambda m, i: F.length(F.get(p, i)) + F.when(i > 0, F.length(F.get(f, i - 1))).otherwise(0))

    return _running(_let(pieces, lambda p: _let(found, lambda f: sizes(f, p))))


def _spans(text: Column, place: int, name: str, pattern: str, group: int, least: int) -> Column:
    """Spans of one kind: struct(start, place, stop, kind, value)."""
    found, pieces = _matches(text, pattern)
    value = lambda m: F.regexp_extract(m, pattern, group) if group else m
    spans = F.zip_with(found, _starts(found, pieces), lambda m, s: F.struct(
        s.alias("start"), F.lit(place).alias("place"), (s + F.length(m)).alias("stop"), F.lit(name).alias("kind"), value(m).alias("value")))
    none = F.array().cast(_SPANS)
    return F.when(text.rlike(pattern), F.filter(spans, lambda s: F.length(s["value"]) >= least)).otherwise(none)


_SPANS = "array<struct<start:int,place:int,stop:int,kind:string,value:string>>"


def _chunks(v: Column) -> Column:
    """Pieces of at most 65 characters that overlap in one, so that each pair of neighbours is in one piece.

    The place of a character is found by counting from the start, which would take quadratic time in a long value.
    """
    return F.when(F.length(v) <= 65, F.array(v)).otherwise(F.regexp_extract_all(v, F.lit(r"(?s)(?=(.{2,65})).{1,64}"), F.lit(1)))


def _pairs(values: DataFrame) -> DataFrame:
    """How often one printable ASCII character follows another: (pair, n), the pair as one number."""
    code = lambda v, i: F.ascii(F.substring(v, i, 1)) - _LOW
    pairs = F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: code(F.col("value"), i) * _SIGNS + code(F.col("value"), i + 1))
    chunks = values.where(F.length("value") >= 2).select(F.explode(_chunks(F.col("value"))).alias("value"))
    return chunks.select(F.explode(pairs).alias("pair")).where(
        (F.col("pair") >= 0) & (F.col("pair") < _SIGNS * _SIGNS)).groupBy("pair").count()


def train(base: DataFrame) -> list[float]:
    """Log-likelihood ratios of all pairs of characters, random strings over identifiers.

    ``base`` has the texts as ``__s_text`` and the pattern spans as ``__s_base``. At most 96 * 96 counts of
    either sample come back to the driver.
    """
    secret = base.where(F.size("__s_base") > 0).select(F.explode("__s_base.value").alias("value"))
    total = base.count()
    share = 1_000_000 if total <= FIT_TEXTS else int(1_000_000 * FIT_TEXTS / total)
    sample = base.where((F.pmod(F.xxhash64("__s_text"), F.lit(1_000_000)) < share) & (F.size("__s_base") == 0)).select("__s_text").distinct()
    plain = sample.select(F.explode(F.regexp_extract_all("__s_text", F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    tables = []
    for values in (secret, plain):
        counts = {r["pair"]: r["count"] for r in _pairs(values).collect()}
        rows = [0.0] * _SIGNS
        for pair, n in counts.items():
            rows[pair // _SIGNS] += n
        # additive smoothing over the 66 characters that a candidate can hold
        tables.append([math.log((counts.get(p, 0) + 0.5) / (rows[p // _SIGNS] + 0.5 * 66)) for p in range(_SIGNS * _SIGNS)])
    marks = {ord(c) - _LOW for c in SEPARATORS}
    return [0.0 if marks & {*divmod(p, _SIGNS)} else a - b for p, (a, b) in enumerate(zip(*tables, strict=True))]


def _open_text(text: Column, base: Column) -> Column:
    """The text with blanks in place of the pattern spans, so that no other place moves."""
    blanked = F.aggregate(
        F.array_sort(base), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["stop"] <= acc["at"], acc).otherwise(F.struct(
            s["stop"].alias("at"),
            F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                     F.repeat(F.lit(" "), s["stop"] - F.greatest(s["start"], acc["at"]))).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(base) > 0, blanked).otherwise(text)


def _unlikely_pairs(ratios: list[float]) -> str:
    """A pattern that every token over MIN_TOTAL matches: it holds as many pairs with a positive ratio as are needed
    where each has the largest one. It stands for most tokens' scores, which take far longer."""
    signs = string.ascii_letters + string.digits + "+/_=-"
    ratio = lambda a, b: ratios[(ord(a) - _LOW) * _SIGNS + ord(b) - _LOW]
    after = {a: "".join(re.escape(b) for b in signs if ratio(a, b) > 0) for a in signs}
    # pairs outside the list, as with a hyphen at the end, are none that a candidate can hold
    most = max(ratio(a, b) for a in signs for b in signs)
    if most <= 0:
        return r"\z\A."
    one = "|".join(f"{re.escape(a)}(?=[{b}])" for a, b in after.items() if b)
    return rf"\A(?:(?>.*?(?:{one}))){{{math.ceil(MIN_TOTAL / most)}}}"


def _judged_tokens(text: Column, ratios: list[float]) -> Column:
    """Spans of candidate tokens whose ratio is high enough; ``text`` has blanks for the pattern spans.

    Each different token of a text is judged once; places are only worked out for a text with a secret.
    """
    # one text that is folded into one literal: thousands of literals would be planned, and read, one by one
    table = F.split(F.lit(" ".join(map(repr, ratios))), " ").cast("array<double>")
    code = lambda v, i: F.ascii(F.substring(v, i, 1)) - _LOW

    def secret(v: Column) -> Column:
        total = F.aggregate(_chunks(v), F.lit(0.0), lambda sum_, c: F.aggregate(
            F.sequence(F.lit(1), F.length(c) - 1), sum_, lambda acc, i: acc + F.get(table, code(c, i) * _SIGNS + code(c, i + 1))))
        # a separator takes two transitions out
        scored = F.length(v) - 1 - 2 * (F.length(v) - F.length(F.translate(v, SEPARATORS, "")))
        return F.when(F.length(v) >= LEAST, total > F.greatest(F.lit(MIN_TOTAL), scored * MIN_RATIO)).otherwise(False)

    likely = _unlikely_pairs(ratios)
    none = F.array().cast(_SPANS)

    def spans(found: Column, judged: Column) -> Column:
        places = F.zip_with(found, _starts(found, F.split(text, CANDIDATE, -1)), lambda m, s: F.struct(
            s.alias("start"), F.lit(len(KINDS)).alias("place"), (s + F.length(m)).alias("stop"), F.lit(MODEL_KIND).alias("kind"), m.alias("value")))
        return F.filter(places, lambda s: F.array_contains(judged, s["value"]))

    def judged(found: Column) -> Column:
        return F.filter(F.filter(F.array_distinct(found), lambda v: v.rlike(likely)), secret)

    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    return _let(found, lambda f: _let(judged(f), lambda j: F.when(F.size(j) > 0, spans(f, j)).otherwise(none)))


def spanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``, the text as ``__s_text``, and the spans as ``__s_base`` and ``__s_more``."""
    df = docs.withColumn("__s_text", F.coalesce(F.col(text), F.lit("")))
    parts = {f"__s_{name}": _spans(F.col("__s_text"), i, name, *rest) for i, (name, *rest) in enumerate(KINDS)}
    df = df.withColumns(parts).withColumn("__s_base", F.concat(*parts))
    ratios = train(df.select("__s_text", "__s_base"))
    return df.withColumn("__s_more", _judged_tokens(_open_text(F.col("__s_text"), F.col("__s_base")), ratios))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the pattern kinds, the digest of their spans, and all spans."""
    df = spanned(docs.select("doc_id", "text"))
    return df.select(
        "doc_id", *(F.size(f"__s_{name}").cast("bigint").alias(f"n_{name}") for name, *_ in KINDS),
        F.sha2(_listed(F.col("__s_base")), 256).alias("base_sha256"), _listed(F.concat("__s_base", "__s_more")).alias("spans"),
        F.size("__s_more").cast("bigint").alias("n_markov"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by a mask; overlapping spans share one mask."""
    df = spanned(docs).withColumn("__s_all", F.array_sort(F.concat("__s_base", "__s_more")))
    cut = F.aggregate(
        F.col("__s_all"), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["stop"] <= acc["at"], acc).otherwise(F.struct(
            s["stop"].alias("at"),
            F.concat(acc["out"], F.when(s["start"] >= acc["at"], F.concat(
                F.substr(F.col("__s_text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK))).otherwise(F.lit(""))).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substr(F.col("__s_text"), acc["at"] + 1, F.length("__s_text"))))
    df = df.withColumn("text", F.when(F.size("__s_all") > 0, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.size("__s_all") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return df.select(*docs.columns)
