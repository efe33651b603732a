"""Token counts of documents from flat token files, by a scan for the end-of-document number.

A flat file holds unsigned numbers of two or four bytes and nothing else: documents follow
one another, each ended by the separator. Files are cut into blocks of equal size; a task
finds the separators of a block with one vector comparison. A prefix scan over the blocks of
a file then gives each block the documents ended before it and the tokens since, which
stitches documents that cross blocks.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import text_of
from martloom.llm.files import join, opened
from martloom.session import stage

BLOCK_TOKENS = 1 << 21
WRITE_BYTES = 4 << 20
# What a task reports: a document's place in a file (size null), or a file's tokens (ordinal null).
ORDER = "file string, ordinal long, {kind}, size long"


def load_tokenizer(data: bytes, pattern: str):
    """A byte-pair encoder from a file of ranks, one base64 token and its rank a line."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, pattern: str, separator: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write one flat file per partition under ``folder``, two bytes a token; stored: ORDER.

    A null text has no tokens. File names are unique to the attempt of a task; a file counts if
    the stored rows name it, so a task that runs again does no harm.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    kind = f"id {dict(docs.dtypes)[id_col]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_tokenizer(shared.value, pattern)
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        name, ordinal, size = f"tokens-{uuid.uuid4().hex}.u2", 0, 0
        stream, held, waiting = None, [], 0
        ids = None
        for batch in batches:
            ids = batch.schema.field("id").type
            for text in batch.column("text").to_pylist():
                tokens = np.array([*encoder.encode_ordinary(text), separator], np.uint16)
                held.append(tokens)
                waiting += tokens.nbytes
                size += len(tokens)
                if waiting >= WRITE_BYTES:
                    stream = stream or system.open_output_stream(join(root, name))
                    stream.write(np.concatenate(held).tobytes())
                    held, waiting = [], 0
            n = batch.num_rows
            yield order_batch([name] * n, list(range(ordinal, ordinal + n)), batch.column("id"), [None] * n)
            ordinal += n
        if ordinal:
            stream = stream or system.open_output_stream(join(root, name))
            stream.write(np.concatenate(held).tobytes() if held else b"")
            stream.close()
            yield order_batch([name], [None], pa.nulls(1, ids), [size])

    base = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return stage(base.mapInArrow(run, ORDER.format(kind=kind)), "token-order")


def order_batch(names, ordinals, ids, sizes) -> pa.RecordBatch:
    arrays = [pa.array(names, pa.string()), pa.array(ordinals, pa.int64()), ids, pa.array(sizes, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["file", "ordinal", "id", "size"])


def scan_blocks(files: DataFrame, folder: str, separator: int, width: int, block_tokens: int) -> DataFrame:
    """file, block, ends (documents ended), head and inner (their tokens in the block), tail (tokens after the last).

    ``files`` has file and size (tokens). A block without a separator is all tail.
    """
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("size") / block_tokens) - 1)))
    todo = files.select("file", "size", blocks.alias("block"))
    todo = todo.repartition(F.xxhash64("file", "block"))
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        for batch in batches:
            for name, size, block in zip(*(batch.column(k).to_pylist() for k in range(3))):
                start = block * block_tokens
                with system.open_input_file(join(root, name)) as file:
                    tokens = np.frombuffer(file.read_at((min(size, start + block_tokens) - start) * width, start * width), kind)
                at = np.flatnonzero(tokens == separator)
                lengths = np.diff(at) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]),
                        pa.array([block], pa.int64()),
                        pa.array([len(at)], pa.int64()),
                        pa.array([int(at[0]) if len(at) else 0], pa.int64()),
                        pa.array([lengths.tolist()], pa.list_(pa.int64())),
                        pa.array([len(tokens) - 1 - int(at[-1]) if len(at) else len(tokens)], pa.int64()),
                    ],
                    ["file", "block", "ends", "head", "inner", "tail"],
                )

    return todo.mapInArrow(run, "file string, block long, ends long, head long, inner array<long>, tail long")


def document_lengths(spark: SparkSession, files: DataFrame, folder: str, separator: int, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """file, ordinal, n_tokens of every document in flat files, separators not counted.

    Tokens after a file's last separator are a document too, if there are any. An empty file
    has no documents.
    """
    found = stage(scan_blocks(files, folder, separator, width, block_tokens), "token-blocks")
    order = Window.partitionBy("file").orderBy("block")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    # tokens since the last separator: tails summed from the last block that had one
    since = found.withColumn("turn", F.sum((F.col("ends") > 0).cast("int")).over(upto)).withColumn(
        "open", F.sum("tail").over(Window.partitionBy("file", "turn").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    )
    carried = since.withColumns(
        {
            "carry": F.coalesce(F.lag("open").over(order), F.lit(0)),
            "before": F.sum("ends").over(upto) - F.col("ends"),
            "last": F.lead("block").over(order).isNull(),
        }
    )
    ended = F.when(F.col("ends") > 0, F.concat(F.array(F.col("carry") + F.col("head")), F.col("inner"))).otherwise(F.array().cast("array<bigint>"))
    rest = F.when(F.col("last") & (F.col("open") > 0), F.array("open")).otherwise(F.array().cast("array<bigint>"))
    lengths = carried.select("file", "before", F.posexplode(F.concat(ended, rest)).alias("k", "n_tokens"))
    return lengths.select("file", (F.col("before") + F.col("k")).alias("ordinal"), "n_tokens")


def token_counts(docs: DataFrame, folder: str, vocabulary: str, pattern: str, separator: int, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """id_col and n_tokens of every document, counted in the flat files written from them.

    A null or empty text has 0 tokens; repeated rows are counted one by one; an empty table
    gives no rows; other columns are not read.
    """
    order = write_token_files(docs, folder, vocabulary, pattern, separator, id_col, text_col)
    files = order.filter("ordinal IS NULL").select("file", "size")
    lengths = document_lengths(docs.sparkSession, files, folder, separator, 2, block_tokens)
    named = order.filter("ordinal IS NOT NULL").select("file", "ordinal", F.col("id").alias(id_col))
    return named.join(lengths, ["file", "ordinal"], "left").select(id_col, "n_tokens")
