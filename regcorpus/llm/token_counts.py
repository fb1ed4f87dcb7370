"""Operator 8, token counts by a separator scan of flat token files.

A token file is one flat run of little-endian token ids in which an
end-of-document id closes every document; it has no index.  It is stored as
blocks of ``block`` tokens, ``(file, block, data)``, cut without regard to
documents.  Each block is searched for the separator in one vectorised compare.
What a block cannot know alone is where its first document began and how many
documents came before: both are prefix scans over one summary row per block,
done in two levels (segments of blocks, then blocks in a segment) so that one
huge file is never one task's window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regcorpus.llm.bpe import Encoder, few_collections

BLOCK = 1 << 16
SEGMENT = 1024
END = 50256  # free id of the vocabulary, used as end of document
FILES = "file int, block bigint, data binary, first bigint, ids array<bigint>"


def token_files(docs: DataFrame, ranks: dict, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                end: int = END, block: int = BLOCK, dtype: str = "<u2") -> DataFrame:
    """Blocks of flat token files, one file per input partition, in row order.

    Rows with ``block`` = null list the ids of the documents of a file in
    order, from ordinal ``first`` on; they only name documents and hold no
    lengths or places.  Null text
    is an empty document.  The last block of a file may be short."""
    if max(ranks.values(), default=0) > np.iinfo(np.dtype(dtype)).max or end in ranks.values():
        raise ValueError("ids do not fit the token type, or the end id is taken")

    def run(batches):
        with few_collections():
            yield from encode(batches)

    def encode(batches):
        encoder, file = Encoder(ranks, pattern), TaskContext.get().partitionId()
        held, size, at, names = [], 0, 0, 0

        def rows(blocks, ids, first):
            return pa.RecordBatch.from_arrays([
                pa.array([file] * (len(blocks) + bool(ids)), pa.int32()),
                pa.array([*range(first, first + len(blocks)), *([None] if ids else [])], pa.int64()),
                pa.array([*blocks, *([None] if ids else [])], pa.binary()),
                pa.array([*([None] * len(blocks)), *([names] if ids else [])], pa.int64()),
                pa.array([*([None] * len(blocks)), *([ids] if ids else [])], pa.list_(pa.int64()))],
                ["file", "block", "data", "first", "ids"])

        for b in batches:
            ids = b.column(0).to_pylist()
            for text in b.column(1):
                held.append(np.array([*encoder(text.as_py() or ""), end], dtype))
                size += len(held[-1])
                if size >= block * 16:
                    flat = np.concatenate(held)
                    full = [flat[i:i + block].tobytes() for i in range(0, len(flat) - block + 1, block)]
                    yield rows(full, [], at)
                    at, rest = at + len(full), flat[len(full) * block:]
                    held, size = [rest], len(rest)
            if ids:
                yield rows([], ids, at)
                names += len(ids)
        flat = np.concatenate(held) if held else np.zeros(0, dtype)
        yield rows([flat[i:i + block].tobytes() for i in range(0, len(flat), block)], [], at)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FILES)


def separators(files: DataFrame, end: int = END, dtype: str = "<u2") -> DataFrame:
    """``file, block, n, ends``: tokens of a block and the places of its
    separators."""
    def run(batches):
        for b in batches:
            n, ends = [], []
            for data in b.column(2):
                tokens = np.frombuffer(data.as_buffer(), dtype) if data.is_valid else np.zeros(0, dtype)
                n.append(len(tokens))
                ends.append(np.flatnonzero(tokens == end))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(ends, pa.list_(pa.int64()))],
                                             ["file", "block", "n", "ends"])
    return files.filter("block is not null").select("file", "block", "data").mapInArrow(run, "file int, block bigint, n bigint, ends array<bigint>")


def document_lengths(scanned: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``file, ordinal, n_tokens, closed`` of every document, the separator not
    counted.  Tokens after a file's last separator are a document that is not
    ``closed``; a separator right after another closes an empty document."""
    blocks = scanned.withColumn("seg", F.floor(F.col("block") / segment)) \
        .withColumn("n_ends", F.size("ends").cast("long")).withColumn("last", F.get("ends", F.size("ends") - 1))
    # level 1: per segment its tokens, its separators and the place of the last one
    segs = blocks.groupBy("file", "seg").agg(F.sum("n").alias("n"), F.sum("n_ends").alias("n_ends"))
    order = Window.partitionBy("file").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    starts = segs.select("file", "seg", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("seg_at"),
                         F.coalesce(F.sum("n_ends").over(order), F.lit(0)).alias("seg_docs"))
    inner = Window.partitionBy("file", "seg").orderBy("block")
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.join(starts, ["file", "seg"]) \
        .withColumn("at", F.col("seg_at") + F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .withColumn("docs", F.col("seg_docs") + F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
    # level 2: the last separator before a block, in its segment or in an earlier one
    known = placed.withColumn("last", F.col("at") + F.col("last"))
    seg_last = known.groupBy("file", "seg").agg(F.max("last").alias("seg_last"), F.max(F.col("at") + F.col("n")).alias("seg_end"))
    earlier = seg_last.select("file", "seg", F.max("seg_last").over(order).alias("carry"))
    ready = known.join(earlier, ["file", "seg"]) \
        .withColumn("prev", F.coalesce(F.max("last").over(before), F.col("carry"), F.lit(-1).cast("long")))
    inside = ready.filter("n_ends > 0").select("file", "docs", F.posexplode(F.transform("ends", lambda e, i: F.struct(
        (e + F.col("at")).alias("end"), F.when(i > 0, F.get("ends", i - 1) + F.col("at")).otherwise(F.col("prev")).alias("prev")))).alias("i", "d")) \
        .select("file", (F.col("docs") + F.col("i")).alias("ordinal"), (F.col("d.end") - F.col("d.prev") - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    tails = seg_last.groupBy("file").agg(F.coalesce(F.max("seg_last"), F.lit(-1)).alias("last"), F.max("seg_end").alias("size")) \
        .join(segs.groupBy("file").agg(F.sum("n_ends").alias("ordinal")), "file").filter("size > last + 1") \
        .select("file", "ordinal", (F.col("size") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return inside.union(tails)


def token_counts(files: DataFrame, scanned: DataFrame) -> DataFrame:
    """``doc_id, file, ordinal, n_tokens`` of written token files."""
    names = files.filter("block is null").select("file", "first", F.posexplode("ids").alias("i", "doc_id")) \
        .select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    return names.join(document_lengths(scanned).filter("closed"), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
