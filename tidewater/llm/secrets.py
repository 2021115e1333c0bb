"""Secret scans: three base patterns and sliding-window entropy of candidate strings.

A candidate is a run of 20 or more key characters with a letter and a digit.
Its character class (hexadecimal, one letter case with digits, any) sets the
entropy that a window of 20 characters must reach.  The window slides by one
character: its Shannon entropy is H = log2(W) - sum(c log2 c) / W over the
character counts c, and a step changes only the counts of the character that
leaves and the one that enters.  Candidates that are UUIDs or paths as a
whole are suppressed; of others the windows that overlap a match of the
allow-list are, and each piece between the matches is scored by itself.  Base
spans are never suppressed.  A piece is scored in chunks of bounded length, so the
work is linear in its length and spread over tasks.  Only DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save, text_or_empty

#: The base patterns, in the order in which spans of equal start are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
MIN_VALUE = 6

WINDOW, CHUNK = 20, 500
_KEY = "[A-Za-z0-9+/_=-]"
CANDIDATE = rf"(?<!{_KEY})(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z]){_KEY}{{{WINDOW},}}+"
#: (class pattern, least bits per character); the first class that matches counts.  A bound is the 0.1 % quantile of random
#: windows over the smallest usual alphabet of the class: 16, 32 (base32) and 58 characters (base58).
CLASSES = ((r"^[0-9a-fA-F]+$", 2.70), (r"^([0-9a-z_=-]+|[0-9A-Z_=-]+)$", 3.14), (r"", 3.44))
#: Candidates that are known not to be secrets as a whole, and what no window may overlap.
ALLOW = (
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"^/?[A-Za-z]+[0-9]*(/[A-Za-z]+[0-9]*)+/?$",
)
ALLOW_PART = r"(?i)example|sample|placeholder|changeme|dummy|redacted|0123456789|abcdefghij|qwertyuiop|(.)\1{7}"


def _found(text: Column, pattern: str, no: int, value_group: int | None = None) -> Column:
    """array<struct<kind, i, gap, len, value>>: the matches in order with the distance to the one before.

    The end of the text is matched too, so the lazy gap never runs over a tail twice.
    """
    flags, body = (pattern[:4], pattern[4:]) if pattern.startswith("(?i)") else ("", pattern)
    whole = F.lit(rf"(?s)(.*?)({flags}{body}|\z)")
    gaps = F.regexp_extract_all(text, whole, F.lit(1))
    matches = F.regexp_extract_all(text, whole, F.lit(2))
    values = matches if value_group is None else F.regexp_extract_all(text, whole, F.lit(2 + value_group))
    zipped = F.arrays_zip(gaps.alias("g"), matches.alias("m"), values.alias("v"))
    rows = F.transform(zipped, lambda x, i: F.struct(
        F.lit(no).alias("kind"), i.alias("i"), F.length(x["g"]).cast("long").alias("gap"),
        F.length(x["m"]).cast("long").alias("len"), x["v"].alias("value")))
    none = F.array().cast("array<struct<kind:int,i:int,gap:bigint,len:bigint,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def _f(count: int) -> float:
    return count * math.log2(count) if count else 0.0


def _count(within: Column, char: Column) -> Column:
    return F.length(within) - F.length(F.replace(within, char, F.lit("")))


def entropy_range(value: Column, least: Column, window: int = WINDOW) -> Column:
    """struct(first, last): starts of the first and last windows of at least ``least`` bits; first is null if none.

    A step to the next window takes one character out and one in: with c others of its kind in the 19 that both windows
    share, a character adds f(c + 1) - f(c) to the sum of f(c) = c log2 c.  These steps are listed and added up.
    """
    start = F.substring(value, 1, window)
    table = F.array(*[F.lit(_f(c)) for c in range(window + 1)])
    gain = F.array(*[F.lit(_f(c + 1) - _f(c)) for c in range(window)])
    total = F.aggregate(F.array_distinct(F.split(start, "")), F.lit(0.0),
                        lambda s, c: s + F.when(c != "", F.get(table, _count(start, c))).otherwise(0.0))
    steps = F.when(F.length(value) > window, F.sequence(F.lit(1), F.length(value) - window)).otherwise(F.array().cast("array<int>"))
    both = F.transform(steps, lambda at: F.substring(value, at, F.lit(window + 1)))       # two windows that follow each other

    def change(s):
        shared = F.substring(s, 2, window - 1)
        return F.get(gain, _count(shared, F.substring(s, window + 1, 1))) - F.get(gain, _count(shared, F.substring(s, 1, 1)))

    def state(s, at, first, last):
        high = F.lit(math.log2(window)) - s / window >= least - 1e-9
        return F.struct(s.alias("s"), at.cast("int").alias("at"), F.when(first.isNull() & high, at).otherwise(first).cast("int").alias("first"),
                        F.when(high, at).otherwise(last).cast("int").alias("last"))

    none = F.lit(None).cast("int")
    return F.aggregate(F.transform(both, change), state(total, F.lit(0), none, none),
                       lambda acc, d: state(acc["s"] + d, acc["at"] + 1, acc["first"], acc["last"]))


def _least(value: Column) -> Column:
    out = F.lit(float(CLASSES[-1][1]))
    for pattern, bits in reversed(CLASSES[:-1]):
        out = F.when(value.rlike(pattern), F.lit(float(bits))).otherwise(out)
    return out


def pieces(value: Column, window: int = WINDOW) -> Column:
    """array<struct<at, len>>: the parts between the matches of ALLOW_PART in which a window fits.

    A match is looked for at every character, so matches that overlap all count.
    """
    pattern = F.lit(rf"(?i)(.*?)(?:(?=({ALLOW_PART[4:]})).|\z)".replace(r"\1", r"\3"))
    found = F.arrays_zip(F.regexp_extract_all(value, pattern, F.lit(1)).alias("gap"),
                         F.regexp_extract_all(value, pattern, F.lit(2)).alias("match"))
    kind = "array<struct<at:int,len:int>>"

    def cut(acc, x):
        start, size = acc["done"] + F.length(x["gap"]), F.length(x["match"])
        part = F.array(F.struct(acc["free"].alias("at"), (start - acc["free"]).alias("len")))
        out = F.when(start - acc["free"] >= window, F.concat(acc["out"], part)).otherwise(acc["out"])
        return F.struct((start + F.least(size, F.lit(1))).alias("done"), F.greatest(acc["free"], start + size).alias("free"),
                        out.cast(kind).alias("out"))

    none = F.struct(F.lit(0).alias("done"), F.lit(0).alias("free"), F.array().cast(kind).alias("out"))
    whole = F.array(F.struct(F.lit(0).alias("at"), F.length(value).alias("len"))).cast(kind)
    return F.when(value.rlike(ALLOW_PART), F.aggregate(found, none, cut)["out"]).otherwise(whole)


def chunks(value: Column, window: int = WINDOW) -> Column:
    """Consecutive stretches of CHUNK characters, each with the first window - 1 of the next one, so every window lies whole in
    the stretch in which it starts; the string is walked once."""
    cut = F.regexp_extract_all(value, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    after = F.concat(F.slice(cut, F.lit(2), F.size(cut)), F.array(F.lit("")))
    joined = F.zip_with(cut, after, lambda a, b: F.concat(a, F.substring(b, 1, window - 1)))
    return F.filter(joined, lambda c: F.length(c) >= window)


def spans(found: DataFrame) -> DataFrame:
    """(uid, kind, start, end, value) of the spans that count, from rows (uid, hits)."""
    hit = found.where(F.size("hits") > 0).select("uid", F.explode("hits").alias("h")).select("uid", "h.*")
    line = Window.partitionBy("uid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (hit.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(line))
              .withColumn("start", F.col("end") - F.col("len")).where("len > 0"))
    base = placed.where((F.col("kind") > 0) & (F.col("kind") < 3) | (F.col("kind") == 0) & (F.length("value") >= MIN_VALUE))
    value = F.col("value")
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | value.rlike(pattern)
    part = (placed.where((F.col("kind") == 3) & ~allowed).select("uid", "start", "value", F.explode(pieces(value)).alias("part"))
            .select("uid", (F.col("start") + F.col("part.at")).alias("start"), value.substr(F.col("part.at") + 1, F.col("part.len")).alias("value"))
            .withColumn("least", _least(value))                # below the explode: once a piece
            .select("uid", "start", "least", F.posexplode(chunks(value)).alias("no", "chunk")))
    # few bytes, much work: dealt out evenly by a number of partitions that is not merged again
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = part.repartition(tasks, "uid", "start", "no").withColumn("range", entropy_range(F.col("chunk"), F.col("least")))
    at = F.col("no").cast("long") * CHUNK
    high = ranges.where("range.first is not null").groupBy("uid", "start").agg(
        F.min(at + F.col("range.first")).alias("first"), F.max(at + F.col("range.last")).alias("last"))
    cols = ["uid", "kind", "start", "end", "value"]
    high = high.select("uid", F.lit(3).alias("kind"), (F.col("start") + F.col("first")).alias("start"),
                       (F.col("start") + F.col("last") + WINDOW).alias("end"), F.lit(None).cast("string").alias("value"))
    return base.select(*cols).unionByName(high.select(*cols))


def scan(docs: DataFrame) -> DataFrame:
    """uid, doc_id and ``hits`` (raw matches) of every row, stored; one pass over the texts."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return save(rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.concat(
        _found(text, ASSIGN, 0, 2), _found(text, ACCESS, 1), _found(text, HEX, 2), _found(text, CANDIDATE, 3)).alias("hits")),
        "secret-hits")


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy for every row.

    Null texts count as empty; documents without spans have counts 0 and the
    digest of the empty string; repeated rows are reported singly; an empty
    table gives an empty result; other columns are ignored.
    """
    found = scan(docs)
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    mark = F.concat_ws(":", name, F.col("start"), F.col("end"))
    per = spans(found).withColumn("mark", F.struct("start", "kind", mark.alias("text"))).groupBy("uid").agg(
        *[F.sum((F.col("kind") == i).cast("long")).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sort_array(F.collect_list("mark")).alias("marks"))
    text = lambda rows: F.concat_ws(",", F.transform(rows, lambda m: m["text"]))
    marks = F.coalesce("marks", F.array().cast("array<struct<start:bigint,kind:int,text:string>>"))
    return found.select("uid", "doc_id").join(per, "uid", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.encode(text(F.filter(marks, lambda m: m["kind"] < 3)), "UTF-8"), 256).alias("base_sha256"),
        text(marks).alias("spans"), F.coalesce("n_entropy", F.lit(0)).cast("long").alias("n_entropy"))
