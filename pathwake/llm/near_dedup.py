"""Near-duplicate documents by bottom-k sketches of word shingles.

One hash function orders the shingles of a document; the least ``k`` hashes are its sketch.
Documents of equal shingle sets form a class and are compared once. Inverted lists of the
retained values give the pairs of classes to look at; the sketch of a pair's union estimates
their similarity and drops the clearly different; exact similarity on the full sets decides.

Two rules keep the inverted lists short without losing links:

* *Rare values first.* A pair at the threshold shares at least ``m`` of ``k`` retained values
  (for k = 32 and m = 14 a miss has a probability of about 1e-8). So it also shares one of the
  ``k - m + 1`` rarest of either sketch, and only these enter the lists. A passage that many
  otherwise different documents share is frequent, and does not pair them.
* *Stars before pairs.* First every member of a list is compared with the list's first member.
  Components of these links are then known, and only members of different components are
  still paired: directly in short lists, and in long ones with the exact bounds that full sets
  allow. A large family of near copies costs about as many pairs as it has members.

Values, list heads, classes and components that hold much of the table are dealt to many tasks
(:mod:`pathwake.llm.hot`), so no list or family has to be met whole by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.llm import hot
from pathwake.llm.arrays import U64, mix, shingle_sets
from pathwake.llm.components import components
from pathwake.llm.hot import hot_keys, sent, spread_join
from pathwake.runtime import stored, tasks_of

SKETCH = 32
SHARED = 14  # of 32 retained values: what a pair at the threshold shares at least
PERCENT = 85
_ROW = ("doc_id", "text_high", "text_low")  # what tells rows apart, but for repeated ones
PAIRS = 250  # pairs of texts worth a task
SHORT_LIST = 16  # members of a list that are paired directly; longer lists use full sets


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, high, low, sketches = [], [], [], []
        for _, values in shingle_sets(batch.column("text")):
            spread = mix(values.view(U64))
            sizes.append(len(values))
            high.append(spread.sum(dtype=U64).astype(np.int64))
            low.append(mix(spread + U64(1)).sum(dtype=U64).astype(np.int64))
            sketches.append(values[:SKETCH])
        lengths = np.cumsum([0, *map(len, sketches)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in _ROW), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate([np.zeros(0, np.int64), *sketches]))),
            ],
            names=[*_ROW, "n_shingles", "high", "low", "sketch"],
        )


def _linked_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the threshold; the columns are a, b and their texts."""
    for batch in batches:
        keep = []
        # Two walks over slices of the batch: neither holds the sets of all its texts.
        for (_, x), (_, y) in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)), strict=True):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(shared > 0 and 100 * shared >= PERCENT * (len(x) + len(y) - shared))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _needed(size: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(size * SHARED / SKETCH))


def _similar(x: Column, y: Column) -> Column:
    """The sketch of the union holds enough values of both sketches."""
    union = F.slice(F.array_sort(F.array_union(x, y)), 1, SKETCH)
    return F.size(F.array_intersect(union, F.array_intersect(x, y))) >= _needed(F.size(union))


def _sizes_fit(x: str, y: str) -> Column:
    return 100 * F.least(F.col(x), F.col(y)) >= PERCENT * F.greatest(F.col(x), F.col(y))


def _with_both(pairs: DataFrame, n: int, table: DataFrame, column: str, few: int) -> DataFrame:
    """The ``n`` pairs ``(a, b)`` with ``column`` of both classes as ``of_a`` and ``of_b``.

    Many pairs are shuffled to the rows of either class. Up to ``few`` are sent to the rows, so
    that only what a pair needs is shuffled.
    """
    of = {side: table.select(F.col("class").alias(side), F.col(column).alias(f"of_{side}")) for side in "ab"}
    if n <= few:
        met = [of[side].join(F.broadcast(pairs), side) for side in "ab"]
        return met[0].join(met[1], ["a", "b"])
    most = {side: hot_keys(pairs.groupBy(side).agg(F.count("*").alias("n")), [side]) for side in "ab"}
    for side, other in ("ab", "ba"):
        pairs = spread_join(pairs, of[side], [side], most[side], F.col(other))
    return pairs


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """Pairs ``(a, b)`` that pass the estimate and then the exact comparison."""
    pairs = stored(pairs, f"{label}-pairs")
    n = pairs.count()
    if not n:
        return pairs
    similar = _with_both(pairs, n, classes, "sketch", hot.SMALL_ROWS).filter(_similar(F.col("of_a"), F.col("of_b")))
    likely = stored(similar.select("a", "b"), f"{label}-likely", n)
    n = likely.count()
    if not n:
        return likely
    # One class may be in most pairs: its text is repeated by one task for a part of the few only.
    both = _with_both(likely, n, texts, "text", hot.SMALL_ROWS // 10).select("a", "b", "of_a", "of_b")
    return stored(both.coalesce(tasks_of(n, PAIRS)).mapInArrow(_linked_batches, "a bigint, b bigint"), label)


def _identified(docs: DataFrame) -> list[Column]:
    """The columns ``_ROW`` of ``docs``: its id, and 128 bits of its text."""
    text = docs["text"].cast("string")
    parts = (docs["doc_id"].cast("long"), F.xxhash64(text), F.xxhash64(F.lit(1), text))
    return [part.alias(name) for part, name in zip(parts, _ROW, strict=True)]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * shared >= 85 * union on their sets of five-word shingles;
    a component is what links connect, named by its least doc_id. ``kept`` marks that document.

    Defined for every input: a null or wordless text has no shingles, stands alone and is kept;
    repeated rows (same id, same text) share a component and are all kept or all dropped; a
    repeated id with different texts is compared row by row; a null id counts as greater than
    any other, and is kept only in a component of null ids; an empty table gives an empty
    result; other columns are not read.
    """
    return _grouped(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(docs: DataFrame) -> DataFrame:
    """``_ROW``, n_shingles, component_id and label of each row; the label is null without words."""
    sketches = stored(
        docs.select(*_identified(docs), docs["text"].cast("string").alias("text")).mapInArrow(
            _sketch_batches, "".join(f"{c} bigint, " for c in _ROW) + "n_shingles bigint, high bigint, low bigint, sketch array<bigint>"
        ),
        "sketches",
    )
    classes = stored(
        sketches.filter("n_shingles > 0").groupBy("high", "low")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.struct(F.col("doc_id").isNull(), *_ROW)).alias("least"), F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    values = classes.select("class", F.size("sketch").alias("size"), "n_shingles", F.explode("sketch").alias("value"))
    shared = stored(values.groupBy("value").agg(F.count("*").alias("holders")).filter("holders > 1"), "shared")
    # A value of one class comes before all shared ones, so the shared ones suffice here.
    ranked = (
        spread_join(values, shared, ["value"], hot_keys(shared, ["value"], "holders"), F.col("class")).groupBy("class")
        .agg(F.first("size").alias("size"), F.first("n_shingles").alias("n_shingles"),
             F.array_sort(F.collect_list(F.struct("holders", "value"))).alias("rare"))
    )
    alone = F.col("size") - F.size("rare")
    take = F.greatest(F.lit(0), F.col("size") - _needed(F.col("size")) + 1 - alone).cast("int")
    keys = stored(
        ranked.withColumn("rare", F.slice("rare", 1, take))
        .select("class", "n_shingles", F.explode("rare").alias("rare"))
        .select("class", "n_shingles", F.col("rare.value").alias("value")),
        "keys",
    )
    wanted = stored(classes.select("class", "least.*").join(keys.select("class").distinct(), "class"), "wanted")
    texts = stored(_texts_of(docs, wanted), "texts")

    firsts = stored(
        keys.groupBy("value").agg(F.min(F.struct("class", "n_shingles")).alias("first"), F.count("*").alias("n")).filter("n > 1"),
        "firsts",
    )
    n_firsts = firsts.count()
    frequent = hot_keys(firsts, ["value"]) if n_firsts > hot.SMALL_ROWS else None
    stars = (
        spread_join(keys, sent(firsts.drop("n"), n_firsts), ["value"], frequent, F.col("class")).filter("first.class < class")
        .filter(_sizes_fit("n_shingles", "first.n_shingles"))
        .select(F.col("first.class").alias("a"), F.col("class").alias("b")).distinct()
    )
    star_links = _links(stars, classes, texts, "star-links")
    labels = components(star_links).withColumnRenamed("node", "class")
    open_keys = keys.join(sent(labels, labels.count()), "class", "left").withColumn("label", F.coalesce("label", "class"))
    lists = stored(
        open_keys.groupBy("value").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low < high").select("value", "n"),
        "lists", n_firsts,
    )
    members = stored(spread_join(open_keys, sent(lists, n_firsts), ["value"], frequent, F.col("class")), "members")
    links = _long_list_links(members.filter(F.col("n") > SHORT_LIST), star_links, classes, texts)
    links = links.union(_links(_short_list_pairs(members.filter(F.col("n") <= SHORT_LIST)), classes, texts, "short-links"))
    final = components(links).withColumnRenamed("node", "class")

    n_final = final.count()
    placed = classes.select("class", "high", "low", "least_id").join(sent(final, n_final), "class", "left")
    linked = placed.filter("label is not null")
    least = stored(linked.groupBy("label").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n")), "components", n_final)
    large = hot_keys(least, ["label"]) if n_final > hot.SMALL_ROWS else None
    of_class = spread_join(linked, sent(least.drop("n"), n_final), ["label"], large, F.col("class")).select("high", "low", "component_id", "label")
    single = placed.filter("label is null").select("high", "low", F.col("least_id").alias("component_id"), F.col("class").alias("label"))
    of_class = of_class.union(single)
    copies = hot_keys(classes, ["high", "low"])
    # Rows are read from files here, so a repeated task numbers them alike.
    row = F.monotonically_increasing_id()
    grouped = spread_join(sketches.filter("n_shingles > 0").withColumn("row", row), of_class, ["high", "low"], copies, F.col("row"))
    alone = sketches.filter("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "label": F.lit(None).cast("long")})
    columns = [*_ROW, "n_shingles", "component_id", "label"]
    return grouped.select(columns).union(alone.select(columns))


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(class, text)`` of the classes in ``wanted``, one row each."""
    names = {c: f"of_{c}" for c in _ROW}
    same = F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("text_high") == F.col("of_text_high")) & (F.col("text_low") == F.col("of_text_low"))
    found = docs.select(*_identified(docs), docs["text"].cast("string").alias("text")).join(sent(wanted.select("class", *_ROW).withColumnsRenamed(names), wanted.count()), same)
    return found.groupBy("class").agg(F.first("text").alias("text"))


def _short_list_pairs(mixed: DataFrame) -> DataFrame:
    """Pairs of members in different components, from lists of at most ``SHORT_LIST`` members."""
    x, y = mixed.alias("x"), mixed.alias("y")
    fits = (F.col("x.class") < F.col("y.class")) & (F.col("x.label") != F.col("y.label")) & _sizes_fit("x.n_shingles", "y.n_shingles")
    return x.join(y, (F.col("x.value") == F.col("y.value")) & fits).select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, values in shingle_sets(batch.column(1)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))],
                names=["class", "members"],
            )


def _long_list_links(mixed: DataFrame, star_links: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among the members of long lists, found with the members' full sets.

    On full sets the bounds are exact: at most 15 % of a set may lack a partner, so a set with
    more shingles that no other member has is linked with none, and of the others only the
    rarest shingles, as many as may be missing and one more, enter a second inverted list.
    Lists start with the member that lacks the fewest; the rest of its component is not paired.
    """
    long = mixed.select("class", "n_shingles").distinct()
    sets = stored(
        long.join(texts, "class").select("class", "text").mapInArrow(_set_batches, "class bigint, members array<bigint>"),
        "sets",
    )
    values = sets.select("class", F.explode("members").alias("value"))
    holders = stored(values.groupBy("value").agg(F.count("*").alias("holders")).filter("holders > 1"), "holders")
    n_holders = holders.count()
    shared = hot_keys(holders, ["value"], "holders") if n_holders > hot.SMALL_ROWS else None
    joint = spread_join(values, sent(holders, n_holders), ["value"], shared, F.col("class"))
    ranked = joint.groupBy("class").agg(F.array_sort(F.collect_list(F.struct("holders", "value"))).alias("rare"))
    lacking = F.col("n_shingles") - F.size("rare")
    spare = F.expr(f"{100 - PERCENT} * n_shingles div 100") - lacking
    keys = stored(
        ranked.join(long, "class").withColumn("lacking", lacking).withColumn("spare", spare).filter("spare >= 0")
        .withColumn("rare", F.slice(F.transform("rare", lambda r: r["value"]), 1, F.greatest(F.lit(0), F.col("spare").cast("int") + 1)))
        .select("class", "n_shingles", "lacking", "rare", F.posexplode("rare").alias("at", "value")),
        "exact-keys",
    )
    firsts = stored(keys.groupBy("value").agg(F.min(F.struct("lacking", "class", "n_shingles")).alias("first"), F.count("*").alias("n")), "exact-firsts")
    n_firsts = firsts.count()
    frequent = hot_keys(firsts, ["value"]) if n_firsts > hot.SMALL_ROWS else None
    stars = (
        spread_join(keys, sent(firsts.drop("n"), n_firsts), ["value"], frequent, F.col("class")).filter((F.col("first.class") != F.col("class")) & _enough(
            "n_shingles", "first.n_shingles", F.least(F.col("n_shingles") - F.col("lacking"), F.col("first.n_shingles") - F.col("first.lacking"))))
        .select(F.least("first.class", "class").alias("a"), F.greatest("first.class", "class").alias("b")).distinct()
    )
    links = star_links.union(_links(stars, classes, texts, "exact-stars"))
    labels = components(links).withColumnRenamed("node", "class")
    n_labels = labels.count()
    labelled = keys.join(sent(labels, n_labels), "class", "left").withColumn("label", F.coalesce("label", "class"))
    main = firsts.select("value", F.col("first.class").alias("class")).join(sent(labels, n_labels), "class", "left").select("value", F.coalesce("label", "class").alias("main"))
    minor = spread_join(labelled, sent(main, n_firsts), ["value"], frequent, F.col("class")).filter("label != main")
    x, y = minor.alias("x"), labelled.alias("y")
    # The first common value, with enough values left after it on both sides.
    left = F.least(*[F.col(f"{s}.n_shingles") - F.col(f"{s}.lacking") - F.col(f"{s}.at") for s in "xy"])
    before = [F.slice(f"{s}.rare", F.lit(1), F.col(f"{s}.at")) for s in "xy"]
    fits = (F.col("x.label") != F.col("y.label")) & _enough("x.n_shingles", "y.n_shingles", left) & ~F.arrays_overlap(*before)
    pairs = x.join(y, (F.col("x.value") == F.col("y.value")) & fits)
    pairs = pairs.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()
    return links.union(_links(pairs, classes, texts, "exact-links"))


def _enough(x: str, y: str, shared: Column) -> Column:
    """Two sets of these sizes with at most ``shared`` common members can reach the threshold."""
    return (100 + PERCENT) * shared >= PERCENT * (F.col(x) + F.col(y))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of :func:`near_duplicates`; columns stay as they are.

    It has the component's id; of several texts under that id the one of least hash stays, and
    of repeated rows one. A row goes by its own text, whatever other rows have its id. Rows
    without words are all kept.
    """
    groups = stored(_grouped(docs).filter("label is not null"), "groups")
    variants = groups.groupBy("label", "component_id", *_ROW).agg(F.count("*").alias("rows"))
    named = variants.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = stored(named.groupBy("label").agg(F.min(F.struct("text_high", "text_low")).alias("first"), F.count("*").alias("n")), "first")
    large = hot_keys(groups.groupBy("label").agg(F.count("*").alias("n")), ["label"])
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.struct("text_high", "text_low") == F.col("first"))
    judged = spread_join(variants, first.drop("n"), ["label"], large, F.col("text_high"))
    verdicts = judged.select(*[F.col(c).alias(f"of_{c}") for c in _ROW], F.when(~stays, "drop").when(F.col("rows") > 1, "once").alias("verdict"))
    verdicts = stored(verdicts.filter("verdict is not null"), "verdicts")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), *_identified(docs))
    same = F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("text_high") == F.col("of_text_high")) & (F.col("text_low") == F.col("of_text_low"))
    verdicts = sent(verdicts, verdicts.count())
    if verdicts.filter("verdict = 'once'").limit(1).count() == 0:
        return rows.join(verdicts, same, "left_anti").select("doc.*")
    marked = rows.join(verdicts, same, "left")
    repeated = marked.filter("verdict = 'once'").groupBy(*_ROW).agg(F.first("doc").alias("doc"))
    return marked.filter("verdict is null").select("doc.*").union(repeated.select("doc.*"))
