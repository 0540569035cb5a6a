"""Mixing sources to target weights by Pfair scheduling, in DataFrame and SQL expressions.

Documents of a source, by ascending id, form blocks. Time is counted in block slots. Block
``j`` of a source with share w / W may start at ``floor(j * W / w)``, its release, and has to be
placed before ``ceil((j + 1) * W / w)``, its deadline. Earliest deadline first among the
released blocks keeps every source within one block of its share at every slot.

With integer weights all shares are whole after W slots, so the schedule repeats: one frame of
W slots is scheduled, and block numbers are mapped to slots by arithmetic. When a source runs
out, the others go on with their weights; the frame in which it ends gets the blocks it has
left as its weight. There are at most two kinds of frame for each source, and only the counts
per source (one row each) and the frames reach the driver. No document is dropped or repeated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathwake.operators.ordering import with_position

BLOCK_DOCS = 8
FRAME_SLOTS = 256
EXPONENT = 0.5


def target_weights(counts: Mapping[str | None, int], exponent: float = EXPONENT, slots: int = FRAME_SLOTS) -> dict[str | None, int]:
    """Integer weights in proportion to count ** exponent, about ``slots`` in all, 1 at least."""
    powers = {s: n ** exponent for s, n in counts.items()}
    total = sum(powers.values())
    return {s: max(1, round(slots * p / total)) for s, p in powers.items()}


def frames_of(blocks: Mapping[str | None, int], weights: Mapping[str | None, int]) -> list[dict]:
    """Kinds of frame in order: first slot, how often, and for each source weight and first block."""
    left = {s: n for s, n in blocks.items() if n > 0}
    used = dict.fromkeys(left, 0)
    frames, slot = [], 0

    def add(times: int, sizes: dict) -> None:
        nonlocal slot
        frames.append({"slot": slot, "times": times, "weights": sizes, "first": dict(used)})
        slot += times * sum(sizes.values())
        for s, w in sizes.items():
            used[s] += times * w
            left[s] -= times * w

    while left:
        whole = min(left[s] // weights[s] for s in left)
        if whole:
            add(whole, {s: weights[s] for s in left})
        if all(left.values()):
            add(1, {s: min(n, weights[s]) for s, n in left.items()})
        left = {s: n for s, n in left.items() if n}
    return frames


def frame_schedule(spark: SparkSession, frames: list[dict], names: list) -> DataFrame:
    """``(frame, source_no, turn, at)``: the slot inside its frame of each source's turn-th block.

    Earliest deadline first, ties to the source with the lower number.
    """
    rows = ", ".join(
        f"({i}, array({', '.join(f'{f['weights'].get(s, 0)}L' for s in names)}))" for i, f in enumerate(frames)
    )
    weights = spark.sql(f"select * from values {rows} as t(frame, w)").withColumn("slots", F.expr("aggregate(w, 0L, (a, x) -> a + x)"))
    released = "v > 0 and seen.done[i] < v and floor(seen.done[i] * slots / v) <= t"
    deadline = "ceil((seen.done[i] + 1) * slots / v)"
    # Integer forms of floor and ceil: the products are whole numbers.
    released = released.replace("floor(seen.done[i] * slots / v)", "(seen.done[i] * slots) div v")
    deadline = "((seen.done[i] + 1) * slots + v - 1) div v"
    pick = f"array_min(array_compact(transform(w, (v, i) -> if({released}, named_struct('d', {deadline}, 'i', i), null)))).i"
    order = F.expr(f"""
        aggregate(sequence(0L, slots - 1),
            named_struct('done', array_repeat(0L, {len(names)}), 'order', cast(array() as array<int>)),
            (seen, t) -> element_at(transform(array({pick}), p -> named_struct(
                'done', transform(seen.done, (n, i) -> n + if(i = p, 1L, 0L)),
                'order', concat(seen.order, array(p)))), 1)).order""")
    placed = weights.select("frame", F.posexplode(order).alias("at", "source_no"))
    turn = F.row_number().over(W.partitionBy("frame", "source_no").orderBy("at")) - 1
    return placed.withColumn("turn", turn.cast("long"))


def mixture(docs: DataFrame, weights: Mapping[str | None, int] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(doc_id, source, block, place, frame, slot)`` of every distinct (source, doc_id) of ``docs``.

    ``block`` counts a source's blocks from 0, ``place`` the documents of a block, ``slot`` is
    the block's turn in the mixture. ``weights`` gives positive integers by source, 1 where a
    source is not named; without it they follow :func:`target_weights`.

    Defined for every input: null is a source like any other; a null id comes first in its
    source; repeated rows share one place; the last block of a source may be short; an empty
    table gives an empty result; texts and other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id")).distinct()
    placed = with_position(rows, ["source"], ["doc_id"])
    placed = placed.withColumn("block", F.expr(f"position div {block_docs}")).withColumn("place", F.expr(f"position % {block_docs}"))
    counts = {r["source"]: r["n"] for r in placed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return placed.select("doc_id", "source", "block", "place", F.lit(0).alias("frame"), F.lit(0).cast("long").alias("slot"))
    names = sorted(counts, key=lambda s: (s is not None, s or ""))
    weights = target_weights(counts) if weights is None else {s: weights.get(s, 1) for s in names}
    frames = frames_of({s: -(-n // block_docs) for s, n in counts.items()}, weights)
    table = ", ".join(
        f"struct({i}, {no}, {_literal(s)}, {w}L, {f['first'][s]}L, {f['slot']}L, {f['times']}L, {sum(f['weights'].values())}L)"
        for i, f in enumerate(frames) for no, s in enumerate(names) if (w := f["weights"].get(s, 0))
    )
    # One row for each source and kind of frame: its size is known here.
    spans = F.broadcast(
        spark.sql(f"select inline(array({table})) as (frame, source_no, name, w, first, start, times, slots)")
    )
    inside = F.col("source").eqNullSafe(F.col("name")) & (F.col("block") >= F.col("first")) & (F.col("block") < F.col("first") + F.col("times") * F.col("w"))
    found = placed.join(spans, inside)
    found = found.withColumn("turn", F.expr("(block - first) % w")).withColumn("round", F.expr("(block - first) div w"))
    schedule = F.broadcast(frame_schedule(spark, frames, names))
    return found.join(schedule, ["frame", "source_no", "turn"]).select(
        "doc_id", "source", "block", "place", "frame", (F.col("start") + F.col("round") * F.col("slots") + F.col("at")).alias("slot")
    )


def _literal(name: str | None) -> str:
    if name is None:
        return "cast(null as string)"
    return "decode(unhex('" + name.encode().hex() + "'), 'UTF-8')"


def _placed(docs: DataFrame, weights: Mapping[str | None, int] | None, block_docs: int) -> DataFrame:
    """``doc``, the columns of ``docs``, with ``slot`` and ``place``; no name of ``docs`` can clash."""
    order = mixture(docs.select("doc_id", "source"), weights, block_docs).select("doc_id", "source", "slot", "place")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & F.col("doc.source").cast("string").eqNullSafe(F.col("source"))
    return rows.join(order, same, "left").select("doc", "slot", "place")


def mixed(docs: DataFrame, weights: Mapping[str | None, int] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``docs`` with ``slot`` and ``place`` as the columns ``_slot`` and ``_place``, in place of such columns."""
    kept = [f"doc.`{c}`" for c in docs.columns if c not in ("_slot", "_place")]
    return _placed(docs, weights, block_docs).select(*kept, F.col("slot").alias("_slot"), F.col("place").alias("_place"))


def in_mixture_order(docs: DataFrame, weights: Mapping[str | None, int] | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``docs`` laid out in the order of the mixture, columns unchanged.

    Partitions, and so the files of a later write, are ranges of slots in ascending order.
    """
    order = ["slot", "place", "doc.doc_id"]
    laid = _placed(docs, weights, block_docs).repartitionByRange(*order).sortWithinPartitions(*order)
    return laid.select("doc.*")
