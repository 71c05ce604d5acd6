"""Mixing sources to target weights (operator 5), DataFrame functions only.

Targets. Sources in order weigh ``WEIGHTS`` in turn and share the words of the
whole corpus; a target stops at ``CAP`` times its source's words and the excess
goes to the others by weight. That fixed point is a water level: a source is
capped if its ratio of cap to weight lies under the level, so sorting the
sources by that ratio gives the level with running sums.

Blocks. The documents of a source are dealt by hash into blocks of about
``BLOCK_WORDS`` words; a larger source has more of them. A target of 2.4 times the
source takes two whole passes over its blocks and, in a permutation of its own, as
many whole blocks as fit in the remaining 0.4. What is left of that room goes on
through the permuted blocks: of the next blocks all documents that fit in the
room, while they fit together; of the block after that, one document after the
other as it fits, in hashed order; and so on with the smaller room, until it is
under ``NEAR`` of the target (or ``NEAR_WORDS``) or no document fits. If a larger room is left, only
documents too large for it are left out: the pass is made again with the smallest
of them taken first (up to ``RETRIES`` times), so that smaller ones make up the
difference. At last the smallest document left out is taken if that brings the
source nearer to its target.

Shards. The block draws of all sources are split among the output shards by a
tree: a node holds the number of draws of every source; its left half gets a
multivariate hypergeometric draw of its size, the right half the rest. Rows of a
level are nodes, and a level is one projection. The hypergeometric draws invert
the distribution function with a hashed uniform, so reruns agree. At the leaves
every shard has its exact quota of every source; quotas laid end to end along
the source's permuted draws give each shard disjoint blocks. Every shard is a task
and a file of its own; inside it, documents are ordered by hash.

Running sums over sources, blocks and draws are taken partition by partition
(``running_totals``); no group holds all documents, blocks or draws of a source. A
node of the tree holds one number for every source.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, last in order; rows with the same id and text are
taken alike in whole passes and as they fit in a partial block; extra columns
are ignored by ``plan`` and kept by ``mix``; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, col, materialized, running_totals, table

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
BLOCK_WORDS = 50_000
#: Share of a target that its source may miss though documents that fit are left.
NEAR = 0.001
#: Words that it may miss at least; tiny sources need no further pass for less.
NEAR_WORDS = 50
#: Times the partial pass is made again for sources that miss by more.
RETRIES = 3
#: Block draws of an output shard.
SHARD_BLOCKS = 64
SEED = 42


def words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    # every word becomes one sign, and the space between them goes
    return F.length(F.translate(F.regexp_replace(t, WORD, "x"), " \t\n\x0b\x0c\r", "")).cast("long")


def targets(sizes: DataFrame, *, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """``source, source_no, source_size, target`` of the sources of ``sizes``
    (columns ``source, size``; one row a source comes out)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = [F.asc_nulls_last("source")]
    numbered = running_totals(per, [], by_name, n=F.lit(1).cast("long")).withColumn("source_no", (F.col("n") - 1).cast("int"))
    weighed = numbered.withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int")),
    ).withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    # the level if exactly the sources of smaller ratios are capped
    ranked = running_totals(
        weighed, [], [F.asc("ratio"), *by_name], size_upto=F.col("source_size"), weight_upto=F.col("weight")
    )
    whole = ranked.agg(F.max("size_upto").alias("size"), F.max("weight_upto").alias("weight")).first()
    left = F.lit(whole["weight"]) - (F.col("weight_upto") - F.col("weight"))
    level = (F.lit(whole["size"]) - cap * (F.col("size_upto") - F.col("source_size"))) / left
    # the first source whose ratio is not under its level sets the level
    free = ranked.withColumn("level", level).where("ratio >= level")
    water = free.orderBy("ratio", *by_name).limit(1).select("level").collect()
    most = cap * F.col("source_size")
    target = F.least(most, F.lit(water[0][0]) * F.col("weight")) if water else most
    return ranked.select("source", "source_no", "source_size", target.alias("target"))


def _uniform(*parts) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _hypergeometric(good: str, bad: str, draws: str, uniform: str) -> str:
    """SQL: the number of good items among ``draws`` of ``good + bad`` items,
    by inverting the distribution function over eight standard deviations on
    either side of the mode (beyond lies less than a double resolves)."""
    n = f"({good} + {bad})"
    return f"""
    transform(array(named_struct('g', cast({good} as double), 'b', cast({bad} as double), 'd', cast({draws} as double), 'u', {uniform})), p ->
      case when p.g + p.b <= p.d then cast(p.g as bigint) when p.d = 0 or p.g = 0 then 0L else
      transform(array(named_struct(
          'mode', floor((p.d + 1) * (p.g + 1) / (p.g + p.b + 2)),
          'spread', 10 + ceil(8 * sqrt(greatest(0D, p.d * (p.g / (p.g + p.b)) * (p.b / (p.g + p.b)) * (p.g + p.b - p.d) / greatest(1D, p.g + p.b - 1)))))), m ->
        transform(array(named_struct(
            'lo', cast(greatest(0D, p.d - p.b, m.mode - m.spread) as bigint),
            'hi', cast(least(p.g, p.d, m.mode + m.spread) as bigint))), r ->
          transform(array(aggregate(sequence(r.lo, r.hi), named_struct('w', 1D, 'all', 0D),
              (a, k) -> named_struct('w', a.w * (p.g - k) * (p.d - k) / ((k + 1) * (p.b - p.d + k + 1)), 'all', a.all + a.w), a -> a.all)), total ->
            aggregate(sequence(r.lo, r.hi), named_struct('w', 1D, 'sum', 0D, 'k', r.hi, 'done', false),
              (a, k) -> named_struct(
                'w', a.w * (p.g - k) * (p.d - k) / ((k + 1) * (p.b - p.d + k + 1)),
                'sum', a.sum + a.w,
                'k', case when not a.done and a.sum + a.w > p.u * total then k else a.k end,
                'done', a.done or a.sum + a.w > p.u * total), a -> a.k))[0])[0])[0]
      end)[0]"""


def split(quotas: DataFrame, shards: int, *, seed: int = SEED) -> DataFrame:
    """``shard, source_no, take``: the draws of every source (columns
    ``source_no`` from 0 without gaps, ``draws``) dealt to ``shards`` shards of
    equal size (within one draw) by a multivariate hypergeometric tree."""
    # one number a source in a node's array
    node = quotas.agg(F.array_sort(F.collect_list(F.struct("source_no", "draws"))).alias("s")).select(
        F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), F.expr("transform(s, x -> x.draws)").alias("q")
    )
    node = node.where(F.size("q") > 0).withColumn("total", F.expr("aggregate(q, 0L, (a, x) -> a + x)"))
    uniform = f"pmod(xxhash64({seed}, lo, hi, i), {1 << 52}L) / {1 << 52}D"
    one = _hypergeometric("q[i]", "(a.items - q[i])", "a.open", uniform)
    left = f"""aggregate(sequence(0, size(q) - 1),
        named_struct('items', aggregate(q, 0L, (a, x) -> a + x),
                     'open', (mid * total) div {shards} - (lo * total) div {shards},
                     'out', cast(array() as array<bigint>)),
        (a, i) -> transform(array({one}), k -> named_struct(
            'items', a.items - q[i], 'open', a.open - k, 'out', concat(a.out, array(k))))[0],
        a -> a.out)"""
    for _ in range((shards - 1).bit_length()):
        wide = F.col("hi") - F.col("lo") > 1
        node = (
            node.withColumn("mid", F.when(wide, F.expr("(lo + hi) div 2")).otherwise(F.col("hi")))
            .withColumn("left", F.when(wide, F.expr(left)).otherwise(F.col("q")))
            .withColumn("right", F.zip_with("q", "left", lambda x, y: x - y))
            .select(
                "total",
                F.inline(
                    F.when(
                        wide,
                        F.array(
                            F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("q")),
                            F.struct(F.col("mid").alias("lo"), "hi", F.col("right").alias("q")),
                        ),
                    ).otherwise(F.array(F.struct("lo", "hi", "q")))
                ),
            )
        )
    return node.select(F.col("lo").alias("shard"), F.posexplode("q").alias("source_no", "take"))


@dataclass
class Plan:
    """What a mix takes. ``sized``: ``doc_id, source_no, size, hash, block`` of
    every row; ``sources``: ``source_no, source, source_size, target, blocks``; ``draws``:
    ``source_no, block, pass, shard, part`` (``part``: only the documents of
    ``fitting``); ``fitting``: ``source_no, hash``; ``shards``: number of output shards."""

    sized: DataFrame
    sources: DataFrame
    draws: DataFrame
    fitting: DataFrame
    shards: int


def _hash(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text)


def _tolerance() -> Column:
    return F.greatest(F.col("target") * NEAR, F.lit(float(NEAR_WORDS)))


def _fitting(items: DataFrame) -> DataFrame:
    """Documents of one block a source taken in hashed order while they fit
    (``items``: ``source_no, hash, size, room``)."""
    per = items.groupBy("source_no").agg(
        F.array_sort(F.collect_list(F.struct("hash", "size"))).alias("docs"), F.first("room").alias("room")
    )
    taken = F.expr(
        """aggregate(docs,
            named_struct('room', room, 'out', cast(array() as array<struct<hash:bigint,size:bigint>>)),
            (a, d) -> if(d.size <= a.room,
                named_struct('room', a.room - d.size, 'out', concat(a.out, array(struct(d.hash as hash, d.size as size)))), a),
            a -> a.out)"""
    )
    return per.select("source_no", F.inline(taken))


def _fill(sized: DataFrame, blocks: DataFrame, rooms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``source_no, block, hash``: documents that fill the rooms (``source_no,
    room, target``) from ``blocks`` (``source_no, block, at``; not yet taken); and
    per source the smallest document left out, with the room that is left.

    A document that was passed over was larger than the room then, so it fits in no
    later room either: every block is looked at once."""
    docs = sized.where("size > 0").groupBy("source_no", "block", "hash").agg(F.sum("size").alias("size"))
    docs = materialized(docs.join(blocks, ["source_no", "block"]), "mix-left")
    rooms = materialized(rooms.withColumn("done", F.lit(-1).cast("long")), "mix-rooms")
    taken = []
    while True:
        open_ = rooms.where(F.col("room") > _tolerance()).select("source_no", "room", "done")
        fits = docs.join(open_, "source_no").where("size <= room and at > done")
        per = materialized(
            running_totals(
                fits.groupBy("source_no", "at").agg(F.sum("size").alias("words"), F.first("room").alias("room")),
                ["source_no"], [F.asc("at")], upto=F.col("words"),
            ),
            "mix-fits",
        )
        if per.isEmpty():
            break
        # the first block that does not fit as a whole, and the room before it
        part = per.where("upto > room").groupBy("source_no").agg(
            F.min(F.struct("at", (F.col("room") - F.col("upto") + F.col("words")).alias("room"))).alias("p")
        ).select("source_no", "p.at", "p.room")
        whole = per.where("upto <= room").select("source_no", "at")
        edge = fits.drop("room").join(part, ["source_no", "at"]).where("size <= room")
        columns = ["source_no", "block", "hash", "size"]
        got = materialized(
            fits.join(whole, ["source_no", "at"], "left_semi").select(*columns).unionByName(
                _fitting(edge).join(edge.select("source_no", "block", "hash"), ["source_no", "hash"]).select(*columns)
            ),
            "mix-fill",
        )
        taken.append(got.drop("size"))
        used = got.groupBy("source_no").agg(F.sum("size").alias("used"))
        # blocks up to the one taken in part are done; without such a block all are
        rooms = materialized(
            rooms.join(used, "source_no", "left").join(part.select("source_no", F.col("at").alias("stop")), "source_no", "left")
            .select(
                "source_no", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room"), "target",
                F.coalesce("stop", F.lit(1 << 62)).alias("done"),
            ),
            "mix-rooms",
        )
    found = materialized(reduce(DataFrame.unionByName, taken, docs.select("source_no", "block", "hash").limit(0)), "mix-found")
    least = (
        docs.join(found, ["source_no", "hash"], "left_anti").groupBy("source_no")
        .agg(F.min(F.struct("size", "hash", "block")).alias("d")).join(rooms, "source_no")
        .select("source_no", "d.*", "room", "target")
    )
    return found, materialized(least, "mix-least")


def _partial(sized: DataFrame, numbers: DataFrame, forced: DataFrame, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The partial pass: the blocks, with ``whole`` for those it takes whole; the
    documents it takes of others (``source_no, block, hash``); and per source the
    smallest document left out and the room that is left. ``forced`` documents
    (``source_no, block, hash, size``) are taken in any case."""
    held = forced.select("source_no", "block").distinct().withColumn("held", F.lit(True))
    used = forced.groupBy("source_no").agg(F.sum("size").alias("used"))
    block = sized.groupBy("source_no", "block").agg(F.sum("size").alias("words")).where("words > 0")
    block = block.join(held, ["source_no", "block"], "left").withColumn("held", F.coalesce("held", F.lit(False)))
    # whole blocks in a permutation while they fit, then documents
    shuffled = [F.xxhash64(F.lit(seed), F.lit("partial"), "source_no", "block"), F.asc("block")]
    counted = F.when(F.col("held"), F.lit(0).cast("long")).otherwise(F.col("words"))
    block = materialized(
        running_totals(block, ["source_no"], shuffled, upto=counted, at=F.lit(1).cast("long"))
        .join(numbers, "source_no")
        .join(used, "source_no", "left")
        .withColumn("rest", F.col("rest") - F.coalesce("used", F.lit(0)))
        .withColumn("whole", ~F.col("held") & (F.col("upto") <= F.col("rest") + 1e-6)),
        "mix-blocks",
    )
    taken = F.coalesce(F.max(F.when(F.col("whole"), F.col("upto"))), F.lit(0))
    rooms = block.groupBy("source_no").agg(
        F.floor(F.first("rest") - taken + 0.5).cast("long").alias("room"), F.first("target").alias("target")
    )
    free = sized.join(forced.select("source_no", "hash"), ["source_no", "hash"], "left_anti")
    found, least = _fill(free, block.where("not whole").select("source_no", "block", "at"), rooms.where("room > 0"))
    return block, found.unionByName(forced.select("source_no", "block", "hash")), least


def plan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    cap: float = CAP,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> Plan:
    raw = materialized(
        docs.select(
            col(doc_id).alias("doc_id"),
            col(source).alias("source"),
            words(col(text)).alias("size"),
            _hash(col(doc_id), col(text), seed).alias("hash"),
        ),
        "mix-sizes",
    )
    sources = materialized(
        targets(raw, weights=weights, cap=cap)
        .withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long"))
        .withColumn(
            "passes",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest("source_size", F.lit(1)) + 1e-9)).otherwise(0).cast("int"),
        )
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")),
        "mix-sources",
    )
    named = sources.select(F.col("source").alias("_source"), "source_no", "blocks")
    sized = materialized(
        raw.join(named, F.col("source").eqNullSafe(F.col("_source"))).select(
            "doc_id", "source_no", "size", "hash", F.pmod("hash", F.col("blocks")).alias("block")
        ),
        "mix-sized",
    )
    numbers = sources.select("source_no", "passes", "rest", "target")
    forced = sized.select("source_no", "block", "hash", "size").limit(0)
    for attempt in range(1 + RETRIES):
        block, found, least = _partial(sized, numbers, forced, seed)
        missed = F.least(F.col("room"), F.abs(F.col("size") - F.col("room"))) > _tolerance()
        again = least.where(missed & (F.col("room") > 0)).join(block.groupBy("source_no").agg(F.first("rest").alias("rest")), "source_no")
        again = again.where("size <= rest").select("source_no", "block", "hash", "size")
        if attempt == RETRIES or again.isEmpty():
            break
        forced = materialized(forced.unionByName(again), "mix-forced")
    nearer = least.where(F.col("size") - F.col("room") < F.col("room")).select("source_no", "block", "hash")
    fitting = materialized(found.unionByName(nearer), "mix-fitting")
    parts = fitting.select("source_no", "block").distinct().withColumn("part", F.lit(True))
    block = block.join(parts, ["source_no", "block"], "left").withColumn("part", F.coalesce("part", F.lit(False)))
    passes = F.col("passes") + (F.col("whole") | F.col("part")).cast("int")
    draw = block.withColumn("n", passes).where("n > 0").select(
        "source_no",
        "block",
        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("pass"),
        "passes",
        "part",
    ).select("source_no", "block", "pass", (F.col("part") & (F.col("pass") == F.col("passes"))).alias("part"))
    order = [F.asc("pass"), F.xxhash64(F.lit(seed), "source_no", "pass", "block"), F.asc("block")]
    draw = materialized(running_totals(draw, ["source_no"], order, at=F.lit(1).cast("long")), "mix-draws")
    quotas = sources.select("source_no").join(draw.groupBy("source_no").agg(F.count(F.lit(1)).alias("draws")), "source_no", "left")
    shards = max(1, -(-draw.count() // shard_blocks))
    quota = split(quotas.fillna(0, ["draws"]), shards, seed=seed).where("take > 0")
    # a shard's draws of a source follow each other: quotas end to end give their places
    ends = running_totals(quota, ["source_no"], [F.asc("shard")], upto=F.col("take"))
    place = ends.select(
        "source_no", F.col("shard").cast("int").alias("shard"), F.explode(F.sequence(F.col("upto") - F.col("take") + 1, "upto")).alias("at")
    )
    dealt = draw.join(place, ["source_no", "at"]).select("source_no", "block", "pass", "shard", "part")
    return Plan(sized, sources, materialized(dealt, "mix-dealt"), fitting.select("source_no", "hash"), shards)


def copies(p: Plan) -> DataFrame:
    """``sized`` with ``copies``, how often the mix takes each row."""
    per = p.draws.groupBy("source_no", "block").agg(
        F.sum((~F.col("part")).cast("int")).alias("whole"), F.max("part").alias("part")
    )
    fits = p.fitting.withColumn("fits", F.lit(1))
    some = F.when(F.col("part"), F.coalesce("fits", F.lit(0))).otherwise(0)
    return (
        p.sized.join(per, ["source_no", "block"], "left")
        .join(fits, ["source_no", "hash"], "left")
        .withColumn("copies", F.when(F.col("size") > 0, F.coalesce("whole", F.lit(0)) + some).otherwise(0))
    )


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, **how) -> DataFrame:
    """The mixed documents: the columns of ``docs``, a row for every time a
    document is taken, each output shard together and shuffled inside."""
    p = plan(docs, doc_id=doc_id, text=text, source=source, seed=seed, **how)
    s = {n: f"_strata_mix_{n}" for n in ("source", "no", "blocks", "block", "hash", "pass", "shard", "part", "fit_no", "fit", "words")}
    names = p.sources.select(
        F.col("source").alias(s["source"]), F.col("source_no").alias(s["no"]), F.col("blocks").alias(s["blocks"])
    )
    rows = docs.withColumns({s["hash"]: _hash(col(doc_id), col(text), seed), s["words"]: words(col(text))}).where(
        F.col(s["words"]) > 0
    )
    rows = rows.join(names, col(source).eqNullSafe(F.col(s["source"]))).withColumn(
        s["block"], F.pmod(s["hash"], F.col(s["blocks"]))
    )
    draws = p.draws.select(
        F.col("source_no").alias(s["no"]),
        F.col("block").alias(s["block"]),
        F.col("pass").alias(s["pass"]),
        F.col("shard").alias(s["shard"]),
        F.col("part").alias(s["part"]),
    )
    fits = p.fitting.select(F.col("source_no").alias(s["no"]), F.col("hash").alias(s["hash"]), F.lit(True).alias(s["fit"]))
    taken = (
        rows.join(draws, [s["no"], s["block"]])
        .join(fits, [s["no"], s["hash"]], "left")
        .where(~F.col(s["part"]) | F.col(s["fit"]))
    )
    return (
        taken.repartitionById(p.shards, F.col(s["shard"]))  # shard i is partition i
        .sortWithinPartitions(s["shard"], F.xxhash64(F.lit(seed), s["shard"], s["pass"], s["hash"]))
        .select(*[col(c) for c in docs.columns])
    )


def op5_source_mix(spark, sf_dir: str) -> DataFrame:
    """Query: words taken of every document."""
    p = plan(table(spark, sf_dir, "documents"))
    return (
        copies(p)
        .join(p.sources.select("source_no", "source_size", "target"), "source_no")
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
    )
