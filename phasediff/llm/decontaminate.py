"""Benchmark decontamination: windows of test items as a broadcast hash set, probed by the windows of every document.

Only built-in functions. Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. The
set has the 64-bit hash, the words and the items of each window; a document's windows probe the hash, and a hit
counts only where the words are equal too. A text is cut into chunks of CHUNK words that overlap by a window, so
that one row never holds all windows of a long text. Windows that hit nothing end in the task that made them; a
document comes back together from its hits and one marker row, numbered in the same scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasediff.llm.quality_rules import bound
from phasediff.llm.store import written
from phasediff.operators.joins import lookup_join

WINDOW = 10
CHUNK = 2048

#: A larger set is joined by shuffling, copied for each salt of lookup_join.
BROADCAST_BYTES = 64 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_AS_WRITTEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_ROW_BYTES = 96


def normalised_words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lower, _NOT_WORD), "")


def _windows(words: Column, size: int, most: Column | None = None) -> Column:
    """(first word from 0, number of words, words) of each window of so many words, the first most ones."""
    n = F.size(words) - (size - 1)
    n = n if most is None else F.least(most, n)
    return F.transform(
        F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: k < n),
        lambda k: F.struct(
            k.cast("long").alias("first"), F.lit(size).alias("size"), F.array_join(F.slice(words, k + 1, size), " ").alias("window")
        ),
    )


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """hash, window, size and items of each different window; an item of fewer words is one window.

    Null and empty texts have none. Items without item_id mark words and are not listed; equal ids count once.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), normalised_words(F.col("text")).alias("words"))
    short = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.size("words").alias("size"), F.array_join("words", " ").alias("window")))
    cut = items.filter(F.size("words") > 0).select(
        "item_id", F.inline(F.when(F.size("words") < size, short).otherwise(_windows(F.col("words"), size)))
    )
    return (
        cut.groupBy("window", "size")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .select(F.xxhash64("window").alias("hash"), "window", "size", "items")
    )


def _hits(docs: DataFrame, benchmark: DataFrame, carried: list[str], size: int) -> DataFrame:
    """row, n_words, carried (a struct of these columns) and hits (first, end, items) of each row of docs."""
    known = written(benchmark_windows(benchmark, size), "benchmark-windows")
    bytes_of = F.octet_length("window") + _ROW_BYTES + F.coalesce(F.aggregate("items", F.lit(0), lambda a, i: a + F.octet_length(i) + 8), F.lit(0))
    about = known.agg(F.collect_set("size").alias("sizes"), F.sum(bytes_of).alias("bytes")).first()
    sizes = sorted(about["sizes"])  # between 1 and size: at most so many

    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in carried], F.lit(0).alias("_")).alias("carried"),
        normalised_words(F.col("text")).alias("words"),
    )

    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(CHUNK))
        return F.transform(
            starts,
            lambda s: F.struct(
                s.cast("long").alias("at"),
                F.array_join(F.slice(w, s + 1, CHUNK + size - 1), " ").alias("chunk"),
                F.when(s == 0, F.struct("carried", F.size(w).cast("long").alias("n_words"))).alias("marker"),
            ),
        )

    # a document's own columns travel in its marker alone: one row of all that its text becomes
    chunks = words.select("row", F.inline(bound(F.col("words"), cut)))
    of_marker = chunks.schema["marker"].dataType

    def probed(w: Column) -> Column:
        first = F.struct(
            F.lit(-1).cast("long").alias("first"), F.lit(0).alias("size"), F.lit(None).cast("string").alias("window"), F.col("marker").alias("marker")
        )
        none = F.lit(None).cast(of_marker).alias("marker")
        parts = [
            F.transform(_windows(w, s, F.lit(CHUNK)), lambda x: F.struct(x["first"], x["size"], x["window"], none)) for s in sizes
        ]
        return F.concat(F.filter(F.array(first), lambda x: x["marker"].isNotNull()), *parts)

    # an empty chunk splits into one empty word, which no window of the set equals
    pieces = chunks.select("row", "at", F.inline(bound(F.split("chunk", " "), probed)))
    probes = pieces.select(
        "row",
        "marker",
        (F.col("at") + F.col("first")).alias("first"),
        "size",
        "window",
        F.when(F.col("window").isNotNull(), F.xxhash64("window")).alias("hash"),
    )
    entries = known.select("hash", F.col("window").alias("known"), "items")
    met = lookup_join(probes, entries, ["hash"], "left", dim_bytes=int(about["bytes"] or 0), limit_bytes=BROADCAST_BYTES)
    hit = F.col("window") == F.col("known")
    kept = met.filter(F.col("marker").isNotNull() | hit)
    return kept.groupBy("row").agg(
        F.first("marker.carried", ignorenulls=True).alias("carried"),
        F.max("marker.n_words").alias("n_words"),
        F.sort_array(
            F.collect_list(F.when(hit, F.struct("first", (F.col("first") + F.col("size")).alias("end"), "items")))
        ).alias("hits"),
    )


def _hit_words(hits: Column) -> Column:
    """Numbers of the words inside hits, sorted and each once."""
    return F.sort_array(F.array_distinct(F.flatten(F.transform(hits, lambda h: F.sequence(h["first"], h["end"] - 1)))))


def _spans(hit_words: Column) -> Column:
    """Stretches (first, end) of consecutive numbers."""

    def cut(w: Column) -> Column:
        firsts = F.filter(w, lambda x, k: (k == 0) | (F.get(w, F.greatest(k - 1, F.lit(0))) < x - 1))
        lasts = F.filter(w, lambda x, k: F.coalesce(F.get(w, k + 1) > x + 1, F.lit(True)))
        return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), (b + 1).alias("end")))

    return bound(hit_words, cut)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns of each row of docs with n_words, n_hit, spans (first, end: hit words), items and contaminated.

    A window is so many consecutive words of an item, or all words of an item that has fewer; a word inside any
    occurrence of a window is hit, and items are the sorted ids of items with occurring windows. Null and empty
    texts have no words and are never contaminated, nor does an item without words hit anything. Repeated rows are
    judged one by one; empty tables give no rows or no hits. Only the carried columns are looked at besides text,
    so others may have any name. Texts may have any length: no row holds more than CHUNK windows.
    """
    found = _hits(docs, benchmark, list(carried), size)
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    with_words = found.withColumn("_words", _hit_words(F.col("hits")))
    return with_words.select(
        *[F.col(f"carried.`{c}`").alias(c) for c in carried],
        "n_words",
        F.size("_words").cast("long").alias("n_hit"),
        _spans(F.col("_words")).alias("spans"),
        items.alias("items"),
        (F.size("_words") > 0).alias("contaminated"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """text without the words of spans and what stands between such a word and the next."""
    words = F.regexp_extract_all(text, F.lit(f"({_WORD_AS_WRITTEN})"), 1)

    def kept(parts: Column) -> Column:
        def stretches(s: Column) -> Column:
            firsts = F.concat(F.array(F.lit(0).cast("long")), F.transform(s, lambda x: x["end"]))
            ends = F.concat(F.transform(s, lambda x: x["first"]), F.array(F.size(parts).cast("long")))
            return F.zip_with(
                firsts, ends, lambda a, b: F.slice(parts, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
            )

        return F.array_join(F.flatten(bound(spans, stretches)), "")

    def rebuilt(gaps: Column) -> Column:
        parts = F.zip_with(words, F.slice(gaps, 2, F.size(gaps)), lambda w, g: F.concat(w, F.coalesce(g, F.lit(""))))
        return F.concat(F.get(gaps, F.lit(0)), bound(parts, kept))

    return F.when(F.size(spans) > 0, bound(F.split(text, _WORD_AS_WRITTEN), rebuilt)).otherwise(text)


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = WINDOW) -> DataFrame:
    """docs without the rows that are contaminated (remove="documents"), or without their hit words (remove="spans").

    All columns of docs come back, whatever their names; see contamination() for nulls and odd rows.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))]).withColumn("text", F.col(f"c{names.index('text')}"))
    judged = contamination(plain, benchmark, size, tuple(f"c{k}" for k in range(len(names))))
    text = f"c{names.index('text')}"
    if remove == "documents":
        judged = judged.filter(~F.col("contaminated"))
    else:
        judged = judged.withColumn(text, without_spans(F.col(text), F.col("spans")))
    return judged.select(*[F.col(f"c{k}").alias(n) for k, n in enumerate(names)])
