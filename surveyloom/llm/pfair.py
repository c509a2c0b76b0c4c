"""Mixing sources to target weights by Pfair scheduling of blocks.

The documents of a source are put in the order of the MD5 digests of their ids and cut into blocks. Source s has n(s)
blocks and a weight of k(s) tickets. In the ideal, fluid mix every source with blocks left runs at its share of the
tickets; after v rounds source s has done min(n(s), k(s) * v) blocks, and T(v), the sum over the sources, is the time.
Block i of s then runs from T((i - 1) / k(s)) to T(i / k(s)): rounded down and up these are its release time and its
deadline. Earliest deadline first, one block per slot, keeps every block in its window, so that no source is ever a
whole block ahead of or behind the fluid mix, also after other sources have run out.

At whole rounds the fluid mix has done whole blocks of every source. Rounds are therefore scheduled one by one, each
with at most as many blocks as there are tickets, in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from surveyloom.session import stored

BLOCK_ROWS = 32
TICKETS = 200
#: Rows of a source that one window task ranks, on average.
RANKED_ROWS = 4_096
#: Sources whose sizes are broadcast, at most.
MOST_SOURCES = 100_000


def _ranked(docs: DataFrame) -> DataFrame:
    """(source, doc_id, rank) with ranks from 0 in the order of the digests, without a source in one task."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), "doc_id", digest.alias("digest"))
    sizes = stored(keyed.groupBy("source").agg(F.count("*").alias("rows")), "mix-sizes")
    if sizes.count() <= MOST_SOURCES:  # else a join deals the rows by source
        sizes = F.broadcast(sizes)
    parts = F.ceil(F.col("rows") / RANKED_ROWS)
    # The first 32 bits of the digest cut a source into ranges of equal width.
    place = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    cut = keyed.join(sizes, "source").withColumn("part", F.shiftright(place * parts, 32))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("source", "part").agg(F.count("*").alias("n")).select("source", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "part").orderBy("digest", "doc_id")
    ranked = cut.withColumn("inner", F.row_number().over(inside) - 1).join(offsets, ["source", "part"])
    return ranked.select("source", "doc_id", (F.col("offset") + F.col("inner")).alias("rank"))


def source_tickets(docs: DataFrame, tickets: int = TICKETS) -> DataFrame:
    """(source, tickets) by the square root of the rows of each source, at least one ticket; about ``tickets`` in all.

    A null source is the source with the empty name.
    """
    sizes = docs.groupBy(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).agg(F.count("*").alias("rows"))
    whole = sizes.agg(F.sum(F.sqrt("rows")).alias("whole")).scalar()
    return sizes.select("source", F.greatest(F.lit(1), F.floor(tickets * F.sqrt("rows") / whole)).cast("long").alias("tickets"))


def schedule(blocks: DataFrame) -> DataFrame:
    """Slots of blocks. ``blocks``: a row per source (source, tickets, blocks). Result: source, block, release, deadline, slot.

    Tickets and blocks are positive whole numbers. Ties of deadlines go to the name that sorts first.
    """
    all_sources = blocks.agg(F.collect_list(F.struct("tickets", "blocks"))).scalar()
    each = blocks.withColumn("every", all_sources).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    # T(i / k), times k, in whole numbers
    fluid = "aggregate(every, 0L, (a, s) -> a + least(s.blocks * tickets, s.tickets * ({i})))"
    each = each.withColumns({
        "round": F.expr("block div tickets"),
        "release": F.expr(f"{fluid.format(i='block')} div tickets"),
        "deadline": F.expr(f"({fluid.format(i='block + 1')} + tickets - 1) div tickets"),
    }).withColumn("start", F.expr("aggregate(every, 0L, (a, s) -> a + least(s.blocks, s.tickets * round))"))
    rounds = each.groupBy("round", "start").agg(F.sort_array(F.collect_list(F.struct("deadline", "source", "block", "release"))).alias("jobs"))
    # A slot takes the first job by deadline that is released; the others wait in the same order.
    job = "struct<deadline:bigint,source:string,block:bigint,release:bigint>"
    step = "(a, t) -> struct(array_except(a.left, array(filter(a.left, j -> j.release <= start + t)[0])) as left, concat(a.done, array(filter(a.left, j -> j.release <= start + t)[0])) as done)"
    done = f"aggregate(sequence(0, size(jobs) - 1), struct(jobs as left, cast(array() as array<{job}>) as done), {step}, a -> a.done)"
    placed = rounds.select("start", F.posexplode(F.expr(done)).alias("at", "job"))
    return placed.select("job.source", "job.block", "job.release", "job.deadline", (F.col("start") + F.col("at")).alias("slot"))


def mix(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Place of every row of ``docs`` in the mix: source, doc_id, block, slot, place (within the block).

    ``weights``: (source, tickets), whole tickets of at least 1; a missing one is 1 ticket. Without it the square roots
    of the sizes are taken. The whole mix is the order by slot and place. All rows are placed: when a source has run
    out, the others go on by their tickets. A null source is the source with the empty name. Rows that repeat a doc_id
    follow each other; which of them comes first does not show in the result. Other columns are ignored.
    """
    weights = source_tickets(docs) if weights is None else weights
    ranked = stored(_ranked(docs), "mix-ranked")
    sizes = ranked.groupBy("source").agg(F.expr(f"max(rank) div {block_rows} + 1").alias("blocks"))
    blocks = stored(sizes.join(weights, "source", "left").select("source", F.greatest(F.coalesce(F.col("tickets"), F.lit(1)), F.lit(1)).cast("long").alias("tickets"), "blocks"), "mix-sources")
    slots = schedule(blocks)
    own = ranked.select("source", "doc_id", F.expr(f"rank div {block_rows}").alias("block"), F.expr(f"rank % {block_rows}").alias("place"))
    return own.join(slots, ["source", "block"]).select("source", "doc_id", "block", "slot", "place")
