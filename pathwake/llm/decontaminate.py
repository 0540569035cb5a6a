"""Benchmark decontamination: windows of benchmark words found in documents, in SQL expressions.

Each benchmark window has one 64-bit hash of all its words; these are the hash set. A document is
split into words once; hashes of neighbouring words are combined to those of two, four and eight
and then to those of whole windows. A bitmap of the set, which is part of the plan and bounded in
size, passes over nearly all positions that are no hit; what it lets through is looked up by hash,
and a hit counts only if all words are equal. Only these positions leave their document, each with
the words of one window; texts are neither exploded nor shuffled. The plan is the same for a
benchmark of any size.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.llm.hot import hot_keys, spread_join
from pathwake.runtime import stored

WINDOW = 13
PART = 20  # contaminated: at least one word in 20 is hit
# Bits of the bitmap: so many a window, within these bounds (the upper one are 2 MB). A larger
# benchmark lets more positions through, which the lookup by hash then rejects.
BITS, LEAST_BITS, MOST_BITS = 64, 1 << 12, 1 << 24
_END = 1 << 30
# Fixed by the definition of a word: what separates words after lower-casing ASCII letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PIECE = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"
_LEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for a null."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.length(text) == F.octet_length(text)  # then lower() touches A-Z only
    low = F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(low, SEPARATORS), "")


def _with_grams(df: DataFrame, sizes: set[int]) -> DataFrame:
    """Columns with the hashes of so many consecutive words of ``words``; element i starts at word i.

    Each is a column of its own, since an expression that stands twice in another is worked out
    twice. At the end of a text a gram lacks words; the comparison of words rejects such positions.
    """

    def joined(x: str, size: int, y: str) -> Column:
        return F.zip_with(x, F.slice(y, size + 1, _END), lambda a, b: F.xxhash64(a, b))

    df, made = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w))), [1]
    while 2 * made[-1] <= max(sizes):
        df = df.withColumn(f"g{2 * made[-1]}", joined(f"g{made[-1]}", made[-1], f"g{made[-1]}"))
        made.append(2 * made[-1])
    done = set(made)
    for size in sorted(sizes):
        have = 0
        for part in reversed(made):
            if size - have >= part:
                if have and have + part not in done:
                    df = df.withColumn(f"g{have + part}", joined(f"g{have}", have, f"g{part}"))
                    done.add(have + part)
                have += part
    return df


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """``(size, key, windows)``: distinct windows with the sorted ids of their items, by hash.

    An item of fewer than 13 words is one window; one without words has none. ``windows`` lists
    (window, items), one but for equal hashes.
    """
    words = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - WINDOW + 1))
    windows = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, WINDOW))).alias("window"))
    grouped = windows.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("size", F.size("window"))
    grams = _with_grams(grouped.withColumn("words", F.col("window")), set(range(1, WINDOW + 1)))
    key = F.when(F.col("size") == 1, F.col("g1")[0])
    for size in range(2, WINDOW + 1):
        key = key.when(F.col("size") == size, F.col(f"g{size}")[0])
    keyed = grams.select("size", key.alias("key"), F.struct("window", "items").alias("w"))
    return keyed.groupBy("size", "key").agg(F.collect_list("w").alias("windows"))


def _bit(key: Column, shift: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftright(key, shift).bitwiseAND(63)).cast("int"))


def _mask(key: Column) -> Column:
    """Two bits of one word of the bitmap stand for a key."""
    return _bit(key, 52).bitwiseOR(_bit(key, 58))


def bitmap(windows: DataFrame) -> tuple[Column, int]:
    """The keys as a bitmap of 64-bit words, and their number. Only the words reach the driver."""
    keys, bits = windows.count(), LEAST_BITS
    while bits < min(MOST_BITS, BITS * keys):
        bits *= 2
    word = F.col("key").bitwiseAND(bits // 64 - 1)
    rows = windows.groupBy(word.alias("word")).agg(F.bit_or(_mask(F.col("key"))).alias("bits")).collect()
    words = [0] * (bits // 64)
    for row in rows:
        words[row["word"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>"), len(words)  # folded to one literal


def _places(size: int, words: int, filled: Column) -> Column:
    """Positions of a document whose gram the bitmap holds."""

    def place(key: Column, at: Column) -> Column:
        mask = _mask(key)
        held = F.get(filled, key.bitwiseAND(words - 1).cast("int")).bitwiseAND(mask) == mask
        return F.when(held, F.struct(F.lit(size).alias("size"), key.alias("key"), at.alias("at")))

    return F.array_compact(F.transform(f"g{size}", place))


def find_windows(docs: DataFrame, benchmark: DataFrame, text: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc``, n_words, and ``hits``.

    ``hits`` lists (at, size, items) of every occurrence of a benchmark window, by position.
    ``doc`` holds the columns of ``docs``, so that no name can clash; ``text`` only if asked for.
    """
    windows = stored(benchmark_windows(benchmark), "windows")
    filled, length = bitmap(windows)
    sizes = {r["size"] for r in windows.select("size").distinct().collect()}  # 13 at most
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns if text or c != "text"]).alias("doc"), words_of(docs["text"]).alias("words"))
    places = F.expr("cast(array() as array<struct<size: int, key: bigint, at: int>>)")
    if sizes:
        rows = _with_grams(rows, sizes)
        places = F.concat(places, *[_places(s, length, filled) for s in sorted(sizes)])
    here = F.transform(
        "places", lambda p: F.struct(p["size"].alias("size"), p["key"].alias("key"), p["at"].alias("at"), F.slice("words", p["at"] + 1, p["size"]).alias("here"))
    )
    marked = rows.select("doc", "words", places.alias("places")).select("doc", F.size("words").cast("long").alias("n_words"), here.alias("places"))
    # Numbered as stored, so a repeated task finds the same numbers.
    marked = stored(marked, "marked").withColumn("row", F.monotonically_increasing_id())
    some = marked.filter(F.size("places") > 0)
    at_key = ["size", "key"]
    each = some.select("row", F.explode("places").alias("place")).select("row", "place.*")
    frequent = hot_keys(each.groupBy(*at_key).agg(F.count("*").alias("n")), at_key)
    found = spread_join(each, windows, at_key, frequent, F.col("row"))
    equal = F.filter("windows", lambda w: w["window"] == F.col("here"))
    hits = (
        found.withColumn("equal", equal).filter(F.size("equal") > 0)
        .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "size", F.col("equal")[0]["items"].alias("items")))).alias("hits"))
    )
    none = F.array().cast(hits.schema["hits"].dataType)
    with_hits = some.select("row", "doc", "n_words").join(hits, "row", "left").select("doc", "n_words", F.coalesce("hits", none).alias("hits"))
    return marked.filter(F.size("places") == 0).select("doc", "n_words", none.alias("hits")).union(with_hits)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word inside any occurrence of a benchmark window is hit; contaminated means that words
    are hit and 20 * n_hit >= n_words.

    Defined for every input: a null, empty or wordless text has no words and no hits; repeated
    rows and repeated ids each get their row; an item with a null id hits words but is not
    counted or listed; repeated items count once; empty documents give an empty result, an
    empty benchmark hits nothing; other columns are not read.
    """
    return _judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark)


def _judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of :func:`contamination` for ``docs(doc_id, text)``, an id of any type."""
    found = find_windows(docs, benchmark)
    hit = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda seen, h: F.struct(
            F.greatest(seen["end"], h["at"] + h["size"]).alias("end"),
            (seen["n"] + F.greatest(F.lit(0), h["at"] + h["size"] - F.greatest(seen["end"], h["at"]))).alias("n"),
        ),
    )["n"]
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    return (
        found.select(F.col("doc.doc_id").alias("doc_id"), "n_words", hit.cast("long").alias("n_hit"), items.alias("items"))
        .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                ((F.col("n_hit") > 0) & (PART * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated; columns stay as they are.

    The verdict follows from the text alone, so rows are told apart by 128 bits of it and other
    texts under the same id stay.
    """
    text = docs["text"].cast("string")
    parts = {"high": F.xxhash64(text), "low": F.xxhash64(F.lit(1), text)}
    keyed = docs.select(F.struct(*[part.alias(name) for name, part in parts.items()]).alias("doc_id"), docs["text"])
    bad = _judged(keyed, benchmark).filter("contaminated").select("doc_id.*").distinct()
    return docs.join(bad, (parts["high"] == bad["high"]) & (parts["low"] == bad["low"]), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with every hit word, and the separators after it, cut out of ``text``."""
    found = find_windows(docs, benchmark, text=True)
    text = F.col("doc.text")
    pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(1))
    clean = F.array_join(
        F.filter(pieces, lambda _, i: ~F.exists("hits", lambda h: (h["at"] <= i) & (i < h["at"] + h["size"]))), ""
    )
    lead = F.regexp_extract(text, _LEAD, 0)
    cut = F.when(F.size("hits") > 0, F.concat(lead, clean)).otherwise(text)
    return found.select(*[(cut if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
