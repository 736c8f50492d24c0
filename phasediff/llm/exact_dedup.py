"""Exact deduplication by naming: fixed-size blocks become integers, then pairs of integers do, again and again.

Round 0 sorts the distinct blocks of the normalised texts and gives each an integer name. Every later
round names the adjacent pairs of a document's names (the last name of an odd number is paired with
NOTHING), until one name is left. Names of one round are equal exactly where what they stand for is, so
the last round and name of a document identify its whole text without trusting a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.llm.store import dropped, freeing, written

BLOCK_BYTES = 4096
NOTHING = -1
SPACES = b" \t\n\v\f\r"

_BLOCKS = "row long, doc_id long, place long, blocks long, at long, block binary, text_sha256 string"
_BATCH_BYTES = 4 << 20
_SEEN_BYTES = 64 << 20


def normalised(text: str | None) -> bytes:
    """Every run of white space as one space, in UTF-8; null is empty."""
    data = (text or "").encode()
    inner = b" ".join(data.split())
    if not inner:
        return b" " if data else b""
    return (b" " if data[:1] in SPACES else b"") + inner + (b" " if data[-1:] in SPACES else b"")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A row for each block of each document. Its bytes come along only where the task meets them first;
    at is the number of that first row, so a text with many copies is sent on once by each task."""
    schema = pa.schema(
        [(n, pa.int64()) for n in ("row", "doc_id", "place", "blocks", "at")]
        + [("block", pa.binary()), ("text_sha256", pa.string())]
    )
    number = TaskContext.get().partitionId() << 40
    seen: dict[bytes, int] = {}
    known = held = 0
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            data = normalised(text.as_py())
            sha = hashlib.sha256(data).hexdigest()
            count = max(1, -(-len(data) // size))
            for k in range(count):
                block = data[k * size : (k + 1) * size]
                at = seen.get(block)
                rows.append((row, doc, k, count, number if at is None else at, block if at is None else None, sha if k == 0 else None))
                if at is None:
                    seen[block] = number
                    known += len(block)
                    held += len(block)
                number += 1
            if held > _BATCH_BYTES or len(rows) > 20_000:
                yield out()
                rows, held = [], 0
            if known > _SEEN_BYTES:  # what comes again is sent again, no more
                seen, known = {}, 0
    if rows:
        yield out()


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Integer names of sorted blocks: the task in the high bits, the rank of the block below."""
    name, last = (TaskContext.get().partitionId() << 40) - 1, None
    for batch in batches:
        names = []
        for block in batch.column(1).to_pylist():
            if block != last:
                name, last = name + 1, block
            names.append(name)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.int64())], ["at", "name"])


def text_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row, doc_id, text_sha256, round, name: equal round and name means equal normalised text.

    row is monotonically_increasing_id() of docs: the same again for a second read of a stored table.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text"))
    blocks = written(numbered.mapInArrow(freeing(lambda b: _blocks(b, block_bytes)), _BLOCKS), "blocks")
    names = written(
        blocks.filter("block is not null")
        .select("at", "block")
        .repartition("block")
        .sortWithinPartitions("block", "at")
        .mapInArrow(freeing(_named), "at long, name long"),
        "block-names",
    )
    level = written(blocks.drop("block").join(names, "at"), "round-0")
    whole = level.filter("place = 0").select("row", "doc_id", "text_sha256")
    done = [level.filter("blocks = 1").select("row", F.lit(0).alias("round"), "name")]
    dropped(names)
    most = level.agg(F.max("blocks")).first()[0] or 1
    level, number = level.filter("blocks > 1").select("row", "place", "blocks", "name"), 0
    while most > 1:
        most, number = -(-most // 2), number + 1
        first = F.max(F.when(F.col("place") % 2 == 0, F.col("name")))
        second = F.max(F.when(F.col("place") % 2 == 1, F.col("name")))
        pairs = written(
            level.groupBy("row", F.floor(F.col("place") / 2).alias("place"), F.ceil(F.col("blocks") / 2).alias("blocks"))
            .agg(first.alias("first"), F.coalesce(second, F.lit(NOTHING)).alias("second")),
            f"pairs-{number}",
        )
        named = pairs.select("first", "second").distinct().withColumn("name", F.monotonically_increasing_id())
        named = written(named, f"pair-names-{number}")
        level = pairs.join(named, ["first", "second"]).select("row", "place", "blocks", "name")
        done.append(level.filter("blocks = 1").select("row", F.lit(number).alias("round"), "name"))
        level = level.filter("blocks > 1")
    dropped(blocks)
    return whole.join(reduce(DataFrame.unionByName, done), "row")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of docs: row, doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the smallest doc_id stays; rows without doc_id come last, and of
    repeated rows the first stays. Null and empty texts are equal to each other. An empty table gives an
    empty result. Only doc_id and text are read; other columns play no part.
    """
    names = written(text_names(docs, block_bytes), "text-names")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    groups = names.groupBy("round", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    groups = written(
        groups.filter("group_size > 1").select(
            "round", "name", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")
        ),
        "copies",
    )
    joined = names.join(groups, ["round", "name"], "left")
    return joined.select(
        "row",
        "doc_id",
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )
