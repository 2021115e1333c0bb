"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are dealt in blocks of equal size.  A source that is held at ``most``
times its words takes just these; the others have the whole blocks of their
targets for sure, and what is left goes to one more block each by highest
quotients target / (2 k - 1).  Each source's words go to its shards in blocks by highest
quotients too.  No shard gets more than ``most`` times its words: its last block is
shorter and the words go on to the next quotient.  Within a
(source, shard) the documents lie end to end in a seeded order: every block is
taken as often as the quota covers the whole shard, the rest goes to blocks in
seeded order.  A document takes the words of its blocks.  Only DataFrame
operations; everything that is sorted in one place has one row per source, or a
few per shard of a source, and the number of shards of a source grows with the
root of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, located, save, text_or_empty

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE, MOST, BLOCK, SEED = 1.5, 2, 64, 42


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) -> adds source_no, target: shares by weight, none above ``most`` times its source.

    Equal to resharing the excess until none is above: sources in order of
    limit / weight are held at their limit as long as that is less than their
    part of what is left.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    cap, w = F.col("_cap"), F.col("_w")
    ranked = (sizes.withColumn("source_no", F.row_number().over(order))
              .withColumn("_w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                             ((F.col("source_no") - 1) % len(weights) + 1).cast("int")))
              .withColumn("_cap", (F.col("source_size") * most).cast("double"))
              .withColumn("_total", F.sum("source_size").over(everything) * share)
              .withColumn("_all_w", F.sum("_w").over(everything)))
    up = Window.orderBy((cap / w).asc(), F.col("source_no")).rowsBetween(Window.unboundedPreceding, -1)
    held = (ranked.withColumn("_cap_before", F.coalesce(F.sum(cap).over(up), F.lit(0.0)))
            .withColumn("_w_left", F.col("_all_w") - F.coalesce(F.sum(w).over(up), F.lit(0.0)))
            .withColumn("_held", cap * F.col("_w_left") <= w * (F.col("_total") - F.col("_cap_before"))))
    free_w = F.sum(F.when(~F.col("_held"), w)).over(everything)
    held_cap = F.coalesce(F.sum(F.when(F.col("_held"), cap)).over(everything), F.lit(0.0))
    return (held.withColumn("target", F.when(F.col("_held"), cap).otherwise(
        F.least(cap, w * (F.col("_total") - held_cap) / free_w)))
        .select("source", "source_size", "source_no", "target"))


def sainte_lague(rows: DataFrame, group: list[str], order: str, weight: str, seats: str, out: str) -> DataFrame:
    """Adds ``out``: the seats of each row by highest quotients weight / (2 k - 1) within ``group``.

    With n rows, everybody's round(weight * (seats - n) / total) seats are won in
    any case and nobody gets more than round(weight * (seats + n) / total), so
    only about 3 n quotients per group are ranked, however many seats there are.
    Ties go to the smaller ``order``.  Rows of weight 0 get none.
    """
    whole = Window.partitionBy(*group)
    total = F.sum(weight).over(whole)
    n = F.sum(F.when(F.col(weight) > 0, 1).otherwise(0)).over(whole)
    base = (rows.withColumn("_t", total).withColumn("_n", n)
            .withColumn("_sure", F.when(F.col(weight) > 0, F.floor(
                F.col(weight) * F.greatest(F.col(seats) - F.col("_n"), F.lit(0)) / F.col("_t") + 0.5)).otherwise(0).cast("long"))
            .withColumn("_sure", F.when(F.col(seats) > F.col("_n"), F.col("_sure")).otherwise(F.lit(0)))
            .withColumn("_top", F.when(F.col(weight) > 0, F.floor(
                F.col(weight) * (F.col(seats) + F.col("_n")) / F.col("_t") + 0.5)).otherwise(0).cast("long"))
            .withColumn("_open", F.col(seats) - F.sum("_sure").over(whole)))
    tried = base.where("_top > _sure").select(
        *group, order, weight, "_open", F.explode(F.sequence(F.col("_sure") + 1, F.col("_top"))).alias("_k"))
    ranked = tried.withColumn("_r", F.row_number().over(
        Window.partitionBy(*group).orderBy((F.col(weight) / (2 * F.col("_k") - 1)).desc(), F.col(order), F.col("_k"))))
    won = ranked.where("_r <= _open").groupBy(*group, order).agg(F.count(F.lit(1)).alias("_won"))
    keys = [*group, order]
    return (base.join(won.hint("merge"), keys, "left")
            .withColumn(out, F.col("_sure") + F.coalesce("_won", F.lit(0)))
            .drop("_t", "_n", "_sure", "_top", "_open", "_won"))


def source_words(sources: DataFrame, block: int, most: int) -> DataFrame:
    """(source_no, source_size, target) -> adds words: their sum is that of the targets, each within a block of its own.

    Sources held at ``most`` times their words take exactly that; the others a block more or less than whole.
    """
    everything = Window.partitionBy()
    limit = F.col("source_size") * most
    held = F.col("target") >= limit
    base = (sources.withColumn("_n", F.floor(F.col("target") / block))
            .withColumn("_sure", F.when(held, limit).otherwise(F.col("_n") * block))
            .withColumn("_last", F.least(F.lit(block), limit - F.col("_sure")))
            .withColumn("_open", F.round(F.sum("target").over(everything)).cast("long") - F.sum("_sure").over(everything)))
    up = Window.orderBy((F.col("target") / (2 * F.col("_n") + 1)).desc(), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    more = F.greatest(F.lit(0), F.least(F.col("_last"), F.col("_open") - F.coalesce(F.sum("_last").over(up), F.lit(0))))
    return base.withColumn("words", F.col("_sure") + more).drop("_n", "_sure", "_last", "_open")


def shard_words(shards: DataFrame, block: int, most: int) -> DataFrame:
    """(source_no, shard, shard_size, quota) -> adds words: the quota of words dealt in blocks by highest quotients.

    The k-th block of a shard has the quotient shard_size / (2 k - 1); the shard holds
    ``most`` times its words, so its last block may be shorter.  With n shards, what
    round(shard_size * (quota / block -+ n / 2) / all) blocks hold is below and above the
    quota, so only a few quotients per shard are ranked, however large the quota is.
    """
    whole = Window.partitionBy("source_no")
    size, quota = F.col("shard_size"), F.col("quota")
    room = size * most
    margin = (F.sum(F.when(size > 0, 1).otherwise(0)).over(whole) + 1) * block / 2
    rounded = lambda words: F.floor(size / F.col("_all") * (words / block) + 0.5)
    base = (shards.withColumn("_all", F.greatest(F.sum("shard_size").over(whole), F.lit(1))).withColumn("_margin", margin)
            .withColumn("_n", F.ceil(room / block))
            .withColumn("_sure", F.least(F.col("_n"), rounded(F.greatest(quota - F.col("_margin"), F.lit(0.0)))))
            .withColumn("_top", F.when(quota + F.col("_margin") >= F.col("_all") * most, F.col("_n")).otherwise(
                F.least(F.col("_n"), rounded(quota + F.col("_margin")))))
            .withColumn("_held", F.least(room, F.col("_sure") * block))
            .withColumn("_open", quota - F.sum("_held").over(whole)))
    tried = base.where("_top > _sure").select("source_no", "shard", "shard_size", "_open", F.explode(
        F.sequence(F.col("_sure") + 1, F.col("_top"))).alias("_k"))
    tried = tried.withColumn("_len", F.least(F.lit(block), room - (F.col("_k") - 1) * block))
    up = Window.partitionBy("source_no").orderBy((size / (2 * F.col("_k") - 1)).desc(), "shard", "_k").rowsBetween(
        Window.unboundedPreceding, -1)
    won = (tried.withColumn("_won", F.least(F.col("_len"), F.col("_open") - F.coalesce(F.sum("_len").over(up), F.lit(0))))
           .where("_won > 0").groupBy("source_no", "shard").agg(F.sum("_won").alias("_won")))
    return (base.join(won.hint("merge"), ["source_no", "shard"], "left")
            .withColumn("words", F.col("_held") + F.coalesce("_won", F.lit(0)))
            .drop("_all", "_margin", "_n", "_sure", "_top", "_held", "_open", "_won"))


class Mix:
    """The plan of a mix: ``taken`` (per document row) and ``ranges`` (words of the partial pass)."""

    def __init__(self, docs: DataFrame, block: int = BLOCK, seed: int = SEED, weights=WEIGHTS,
                 share: float = SHARE, most: int = MOST, uid: Column | None = None):
        self.block = block
        sized = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                 F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
                                 F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), text_or_empty()).alias("row_hash"),
                                 (uid if uid is not None else F.monotonically_increasing_id()).alias("uid")), "mix-sizes")
        words = sized.agg(F.sum("size")).first()[0] or 0
        # rows are joined by fine parts, as many as the largest source could need; a source's parts form its own number of shards;
        # id and text choose the part, so rows that share an id, or have none, spread as others do
        sized = sized.withColumn("part", F.pmod("row_hash", F.lit(int(words ** 0.5 / 32) + 1)).cast("int"))
        parts = save(sized.groupBy("source", "part").agg(F.sum("size").alias("part_size")), "mix-parts")
        sources = source_targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, most)
        sources = save(source_words(sources, block, most).withColumnRenamed("words", "quota"), "mix-sources")
        self.sources = sources
        n_shards = F.floor(F.sqrt("source_size") / 32) + 1
        parts = parts.join(sources.select(F.col("source").alias("_s"), "source_no", "source_size", "target", "quota"),
                           F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("shard", (F.col("part") % n_shards).cast("int"))
        shards = parts.groupBy("source", "source_no", "source_size", "target", "quota", "shard").agg(F.sum("part_size").alias("shard_size"))
        size, words = F.col("shard_size"), F.col("words")
        dealt = (shard_words(shards, block, most)
                 .withColumn("whole", F.when(size > 0, F.floor(words / size)).otherwise(0).cast("long"))
                 .withColumn("some", words - F.col("whole") * size)
                 .withColumn("n_blocks", F.ceil(size / block).cast("long")))
        self.shards = save(dealt.select("source", "source_no", "source_size", "target", "shard", "shard_size", "n_blocks",
                                        "whole", "some"), "mix-quotas")
        # blocks 0 .. n_blocks - 1 and an end mark; full blocks in seeded order, then a shorter last one,
        # take their words until the partial pass is served: chosen leading words, chosen words before each block
        each = self.shards.select("source_no", "shard", "shard_size", "some", F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("n_blocks"))).alias("b"))
        key = Window.partitionBy("source_no", "shard")
        length = F.greatest(F.lit(0), F.least(F.lit(block), F.col("shard_size") - F.col("b") * block))
        seeded = key.orderBy(length < block, F.xxhash64(F.lit(seed + 1), "source_no", "shard", "b"), "b")
        earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
        chosen = (each.withColumn("_len", length)
                  .withColumn("_used", F.coalesce(F.sum("_len").over(earlier(seeded)), F.lit(0)))
                  .withColumn("chosen", F.greatest(F.lit(0), F.least(F.col("_len"), F.col("some") - F.col("_used"))))
                  .withColumn("before", F.coalesce(F.sum("chosen").over(earlier(key.orderBy("b"))), F.lit(0))))
        # Spark estimates exploded rows by the small table they come from; they must not be broadcast
        self.blocks = chosen.select("source_no", "shard", "b", "chosen", "before").hint("merge")
        # documents end to end
        own = parts.select(F.col("source").alias("_s"), F.col("part").alias("_p"), "source_no", "shard").join(
            self.shards.drop("source"), ["source_no", "shard"])
        keyed = sized.join(own, F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_p"))).drop("_s", "_p", "part")
        line = Window.partitionBy("source_no", "shard").orderBy(F.xxhash64(F.lit(seed + 2), "row_hash"), "doc_id", "size", "uid")
        placed = keyed.withColumn("at", F.coalesce(F.sum("size").over(
            line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        self.placed = placed

    def _before(self, at: Column) -> Column:
        return F.col("before") + F.least(F.col("chosen"), at % self.block)

    def taken(self) -> DataFrame:
        start = self.placed.withColumn("b", F.floor(F.col("at") / self.block))
        first = start.join(self.blocks, ["source_no", "shard", "b"]).withColumn("_f", self._before(F.col("at")))
        first = first.drop("before", "chosen").withColumn("b", F.floor((F.col("at") + F.col("size")) / self.block))
        both = first.join(self.blocks, ["source_no", "shard", "b"])
        return both.withColumn("taken", F.col("whole") * F.col("size") + self._before(F.col("at") + F.col("size")) - F.col("_f"))

    def ranges(self) -> DataFrame:
        """(uid, parts): word ranges [lo, hi) of the documents that the partial pass takes, in order."""
        size, at, b = F.col("size"), F.col("at"), self.block
        cut = self.placed.where("size > 0 and some > 0").select("uid", "source_no", "shard", "size", "at", F.explode(F.sequence(
            F.floor(at / b), F.floor((at + size - 1) / b))).alias("b"))
        hit = cut.join(self.blocks.where("chosen > 0").select("source_no", "shard", "b", "chosen").hint("merge"), ["source_no", "shard", "b"])
        lo = F.greatest(F.col("b") * b - at, F.lit(0))
        hi = F.least(F.col("b") * b + F.col("chosen") - at, size)
        return (hit.select("uid", lo.alias("lo"), hi.alias("hi")).where("lo < hi")
                .groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("parts")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, source for every row.

    Null texts have size 0; the null source is a source of its own, last in
    order; documents of no words take none; rows that share a doc_id are dealt
    singly, and equal ones are interchangeable; an empty table gives an empty result; other columns are ignored.
    """
    return Mix(docs, **options).taken().select("doc_id", "size", "source_size", "target", "taken", "source")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: whole copies of each document as often as its
    shard is taken whole, and one row with the words of its chosen blocks (the whole text if all are)."""
    rows = located(docs)
    plan = Mix(rows, uid=F.struct("__tw_file", "__tw_row"), **options)
    use = (plan.placed.select("uid", F.col("whole").alias("__mix_whole"), F.col("size").alias("__mix_size"))
           .join(plan.ranges().withColumnRenamed("parts", "__mix_parts"), "uid", "left")
           .where("__mix_whole > 0 or __mix_parts is not null").select("uid.*", "__mix_whole", "__mix_size", "__mix_parts"))
    use = save(use, "mix-use")
    # whole copies, then one row with the chosen words; a document is joined once
    some = F.when(F.col("__mix_parts").isNotNull(), F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    copies = F.concat(F.array_repeat(F.lit(False), F.col("__mix_whole").cast("int")), some)
    out = rows.join(use.hint("merge"), ["__tw_file", "__tw_row"]).withColumn("__mix_cut", F.explode(copies))
    n_words = F.aggregate("__mix_parts", F.lit(0).cast("long"), lambda a, p: a + p["hi"] - p["lo"])
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    chosen = F.aggregate(F.array(words), F.lit(""), lambda a, w: F.concat_ws(" ", F.flatten(F.transform(
        "__mix_parts", lambda p: F.slice(w, (p["lo"] + 1).cast("int"), (p["hi"] - p["lo"]).cast("int"))))))
    partial = F.col("__mix_cut") & (n_words < F.col("__mix_size"))
    out = out.withColumn("text", F.when(partial, chosen).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(partial, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*[f"`{c}`" for c in docs.columns])
