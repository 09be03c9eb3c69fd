"""Secret scan: fixed patterns, and character Markov models.

Everything runs on built-in functions.  Two first-order Markov models over
characters, one of random strings and one of ordinary identifiers, are
trained on labelled samples of the corpus: the values that the fixed patterns
find are labelled random, long words without digits from a bounded sample of
documents are labelled ordinary.  A candidate (a run of 20 or more key
characters outside the patterns' places, or one of 4 or more that adjoins such
a place) is a secret if the log-likelihood ratio of random against ordinary is high enough for its
length.  Its score is one array lookup per character pair.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns and least lengths of the three base kinds
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 18
HEX = r"[0-9a-f]{16,}"          # maximal runs, so the same places as [0-9a-f]+ of 16 or more
KINDS = ("assign", "access", "hex", "markov")

# a run of key characters; what a base span leaves of one, if it adjoins that
MASK = "\x01"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?:[A-Za-z0-9+/_=-]{20,}+|(?<=\x01)[A-Za-z0-9+/_=-]{4,}+|[A-Za-z0-9+/_=-]{4,}+(?=\x01))"
ORDINARY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{8,}(?![A-Za-z0-9+/_=-])"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
SAMPLE_DOCS = 2000              # documents that the sample of ordinary words takes, at most
SAMPLE_STRINGS = 200            # words that it takes from each of them, at most: the first by hash
PRIOR, UNIFORM = 5.0, 0.01      # smoothing: counts for pairs, share of an even spread for characters
LEAST_RATIO = 0.7               # nats a character by which "random" must be likelier

_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _spans(text: Column, pattern: str, kind: int, good) -> Column:
    """Spans of the matches of ``pattern`` that ``good`` accepts.

    Matches and the pieces between them alternate, so the running sum of
    their lengths gives the places.  good: from (whole match, position in
    the list of matches) to a condition.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), good(found).alias("good"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(begin.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end"))
        return F.struct(end.cast("long").alias("at"), F.when(x["good"], F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(rows, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(_SPAN))


def _at_least(n: int):
    return lambda found: F.transform(found, lambda x: F.length(x) >= n)


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, by start, then kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    return F.array_sort(F.concat(
        _spans(text, ASSIGN, 0, lambda _: F.transform(values, lambda x: F.length(x) >= ASSIGN_LEAST)),
        _spans(text, ACCESS, 1, _at_least(ACCESS_LEAST)),
        _spans(text, HEX, 2, _at_least(16))))


def _code(char: Column) -> Column:
    """Index in the alphabet, from 0; its size for any other character."""
    place = F.instr(F.lit(ALPHABET), char)
    return F.when(place > 0, place - 1).otherwise(len(ALPHABET))


def _some(words: Column) -> Column:
    """SAMPLE_STRINGS of the words, wherever they stand."""
    order = F.array_sort(F.transform(words, lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w"))))
    return F.transform(F.slice(order, 1, SAMPLE_STRINGS), lambda x: x["w"])


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with the characters of ``spans`` (by start) put out."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(acc["at"], s["start"])
        piece = F.concat(F.substring(text, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int")), F.repeat(F.lit(MASK), (s["end"] - begin).cast("int")))
        fresh = s["end"] > acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def train(docs: DataFrame, text: str = "text", key: str = "doc_id") -> list[float]:
    """Log-likelihood ratio, random against ordinary, of each character pair.

    All values that the fixed patterns find are counted; ordinary words come
    from SAMPLE_DOCS documents at most (the first by a hash of key and text,
    so the sample doesn't depend on the partitioning).  Returns (a + 1)^2
    numbers for an alphabet of a characters; without samples all are 0 and no
    candidate is accepted.  A pair's probability is smoothed by PRIOR counts
    shared out by how often its second character occurs at all.
    """
    t = F.col("text")
    rows = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("h")).where(F.col("text").isNotNull())
    hit = t.rlike(ASSIGN) | t.rlike(ACCESS) | t.rlike(HEX)
    random = rows.where(hit).select(F.concat(
        F.filter(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda x: F.length(x) >= ASSIGN_LEAST),
        F.filter(F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)), lambda x: F.length(x) >= ACCESS_LEAST),
        F.regexp_extract_all(t, F.lit(HEX), F.lit(0))).alias("s"))
    last = rows.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).head()[0]     # numbers only
    plain = rows.where(F.col("h") <= F.lit(last).cast("bigint")).dropDuplicates(["h"]).select(_some(F.regexp_extract_all(F.regexp_replace(t, ASSIGN, " "), F.lit(ORDINARY), F.lit(0))).alias("s"))
    counts = None
    for label, strings in ((1, random), (0, plain)):
        codes = strings.select(F.explode(F.array_distinct("s")).alias("s")).select(F.transform(F.split("s", ""), _code).alias("c"))
        pairs = codes.select(F.explode(F.arrays_zip(F.expr("slice(c, 1, size(c) - 1)").alias("a"), F.expr("slice(c, 2, size(c) - 1)").alias("b"))).alias("p"))
        part = pairs.groupBy("p.a", "p.b").count().select(F.lit(label).alias("label"), "a", "b", F.col("count").alias("n"))
        counts = part if counts is None else counts.unionByName(part)
    size = len(ALPHABET) + 1
    table = [[[0.0] * size for _ in range(size)] for _ in range(2)]
    for r in counts.collect():          # two tables of the alphabet's pairs
        table[r["label"]][r["a"]][r["b"]] += r["n"]
    if not any(map(any, table[0])):     # nothing to compare with
        return [0.0] * size * size
    chance = []
    for m in table:
        total = sum(map(sum, m)) or 1.0
        single = [(1 - UNIFORM) * sum(row[b] for row in m) / total + UNIFORM / size for b in range(size)]
        chance.append([[(row[b] + PRIOR * single[b]) / (sum(row) + PRIOR) for b in range(size)] for row in m])
    return [log(chance[1][a][b] / chance[0][a][b]) for a in range(size) for b in range(size)]


def ratio(string: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string under ``train``'s model."""
    size = len(ALPHABET) + 1
    weights = F.array(*[F.lit(float(x)) for x in model])
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.transform(F.split(string, ""), _code), start, lambda acc, c: F.struct(
        c.alias("last"),
        (acc["sum"] + F.when(acc["last"] < 0, 0.0).otherwise(F.get(weights, acc["last"] * size + c))).alias("sum")), lambda acc: acc["sum"])


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, kept columns, base, spans) per row of ``docs``: arrays of
    (start, kind, end), kinds numbered as in KINDS, by start, then kind;
    places in code points, end exclusive.

    ``base`` holds the fixed patterns' spans, ``spans`` those and the Markov
    ones, which lie beside them: of a random run that a pattern's place lies
    in, the parts before and after it are judged each.  A null or empty text has none; repeated
    rows are scanned each; an empty table gives no rows.
    """
    model = train(docs, text, key)
    rows = docs.select(F.col(key).alias(key), *[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    t = F.col("__text")
    accepted = lambda found: F.transform(found, lambda x: ratio(x, model) >= LEAST_RATIO * F.length(x))
    found = rows.withColumn("base", base_spans(t)).withColumn("__text", _masked(t, F.col("base")))
    return found.select(key, *keep, "base", F.array_sort(F.concat("base", _spans(t, CANDIDATE, 3, accepted))).alias("spans"))


def count_kind(spans: Column, kind: int) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")    # a second argument would be the index


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", key: str = "doc_id", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``
    (overlapping spans by one mark); other columns stay as they are."""
    row = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.struct(*docs.columns).alias("row"))
    out = scan(row, "t", "k", keep=("t", "row"))
    t, start = F.col("t"), F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substring(t, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("spans", start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(t, (acc["at"] + 1).cast("int"), F.length(t))))
    clean = F.when(F.size("spans") > 0, done).otherwise(t)
    return out.select(*[clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
