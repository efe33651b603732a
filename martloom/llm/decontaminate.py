"""Benchmark decontamination with an Aho-Corasick automaton over normalised item windows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bytes_of, text_of
from martloom.session import stage

WINDOW = 10
# Bytes of item text in one automaton, which has at most WINDOW nodes a byte; more items take more rounds.
BYTES_PER_AUTOMATON = 400_000

# Letters and digits stay, A-Z becomes a-z, other ASCII becomes a space; bytes of longer characters stay.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(NORMAL).split()


def item_windows(words: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    """The windows of an item: ``size`` consecutive words, or all of fewer; none without words."""
    if not words:
        return []
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))]


def build(items: list[tuple[object, bytes]], size: int):
    """The automaton over all windows, and per window its length and the items that have it."""
    windows: dict[bytes, set] = {}
    lengths = {}
    for item, data in items:
        for window in item_windows(words_of(data), size):
            phrase = b" " + b" ".join(window) + b" "
            windows.setdefault(phrase, set()).add(item)
            lengths[phrase] = len(window)
    automaton = ahocorasick.Automaton()
    for phrase, owners in windows.items():
        # items without id hit words, but are listed nowhere
        automaton.add_word(phrase.decode("latin-1"), (lengths[phrase], sorted(o for o in owners if o is not None)))
    automaton.make_automaton()
    return automaton


def find(automaton, data: bytes) -> tuple[int, list[tuple[int, int]], set]:
    """Words of a text, runs [first, last) of hit words and the items with occurring windows."""
    words = words_of(data)
    if not words or not len(automaton):
        return len(words), [], set()
    phrase = b" " + b" ".join(words) + b" "
    ends, sizes, items = [], [], set()
    for end, (size, owners) in automaton.iter(phrase.decode("latin-1")):
        ends.append(end)
        sizes.append(size)
        items.update(owners)
    if not ends:
        return len(words), [], items
    spaces = np.flatnonzero(np.frombuffer(phrase, np.uint8) == 32)
    last = np.searchsorted(spaces, ends)
    delta = np.zeros(len(words) + 1, np.int64)
    np.add.at(delta, last - np.array(sizes), 1)
    np.add.at(delta, last, -1)
    hit = np.diff(np.concatenate(([0], (np.cumsum(delta)[:-1] > 0).astype(np.int8), [0])))
    return len(words), list(zip(np.flatnonzero(hit > 0).tolist(), np.flatnonzero(hit < 0).tolist())), items


def original_spans(data: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words as code-point offsets [start, stop) of the original text."""
    if not runs:
        return []
    word = np.frombuffer(data.translate(NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], word.astype(np.int8), [0])))
    starts, stops = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    before = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(before[starts[a]]), "stop": int(before[stops[b - 1]])} for a, b in runs]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
FOUND = (
    "_n_words long, _runs array<struct<start:long,stop:long>>, _spans array<struct<start:long,stop:long>>, "
    "_items array<string>"
)


def scan(docs: DataFrame, items: list[tuple[str, bytes]], size: int) -> DataFrame:
    """Each text scanned once; ``_data`` are its bytes, the other columns pass."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build(shared.value, size)
        for batch in batches:
            counts, runs, spans, owners = [], [], [], []
            for data in batch.column("_data").to_pylist():
                n, found, which = find(automaton, data)
                counts.append(n)
                runs.append([{"start": a, "stop": b} for a, b in found])
                spans.append(original_spans(data, found))
                owners.append(sorted(which))
            rest = [name for name in batch.schema.names if name != "_data"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in rest]
                + [pa.array(counts, pa.int64()), pa.array(runs, RUNS), pa.array(spans, RUNS), pa.array(owners, pa.list_(pa.string()))],
                [*rest, "_n_words", "_runs", "_spans", "_items"],
            )

    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.drop("_data").schema)
    return docs.mapInArrow(run, f"{rest}, {FOUND}")


def item_blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> list[DataFrame]:
    """The items, dealt by a hash to so many frames that each fits one automaton."""
    total = items.agg(F.sum(F.octet_length(text_of(item_text)))).first()[0] or 0
    # the hash deals unevenly: aim at half of the bound
    blocks = 1 if total <= block_bytes else math.ceil(2 * total / block_bytes)
    named = items.select(F.col(item_id).cast("string").alias("item"), bytes_of(item_text).alias("data"))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    return [named.filter(block == b) for b in range(blocks)]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_bytes: int = BYTES_PER_AUTOMATON,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: which words lie in an occurrence of an item's window.

    Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased.
    A window is ``size`` consecutive words of an item; a shorter item is one window. Null
    and wordless texts have no words and no hits; items without words are not looked for;
    items without id are looked for (their windows hit words and make a text contaminated)
    but not listed; items of one id count once. Columns: id_col, n_words, n_hit, items (ids as strings,
    sorted), spans (code-point offsets of hit passages in the original text), contaminated,
    and those named in ``keep``.

    The items enter one automaton, broadcast as text, if they have at most ``block_bytes``
    bytes. More items are dealt to several automata, each scanned in a round of its own.
    """
    extra = [name for name in (keep or []) if name != id_col]
    base = docs.select(id_col, *extra, bytes_of(text_col).alias("_data"))
    blocks = item_blocks(items, item_id, item_text, block_bytes)
    if len(blocks) > 1:
        base = stage(base.withColumn("_key", F.monotonically_increasing_id()), "scan-input")
    found = None
    for block in blocks:
        rows = [(row["item"], bytes(row["data"])) for row in block.collect()]
        part = scan(base, rows, size)
        if len(blocks) > 1:
            part = stage(part, "scan-round")
        found = part if found is None else found.unionByName(part)
    if len(blocks) > 1:
        names = [id_col, *extra]
        found = found.groupBy("_key").agg(
            *[F.first(name).alias(name) for name in names],
            F.first("_n_words").alias("_n_words"),
            F.flatten(F.collect_list("_runs")).alias("_runs"),
            F.flatten(F.collect_list("_spans")).alias("_spans"),
            F.flatten(F.collect_list("_items")).alias("_items"),
        )
    return found.select(
        id_col,
        F.col("_n_words").alias("n_words"),
        covered("_runs").alias("n_hit"),
        F.array_sort(F.array_distinct("_items")).alias("items"),
        F.array_sort("_spans").alias("spans"),
        (F.size("_runs") > 0).alias("contaminated"),
        *extra,
    )


def covered(runs: str):
    """Positions covered by an array of runs that may overlap."""
    state = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        F.array_sort(runs),
        state,
        lambda acc, run: F.struct(
            (acc["sum"] + F.greatest(F.lit(0).cast("long"), run["stop"] - F.greatest(run["start"], acc["end"]))).alias("sum"),
            F.greatest(acc["end"], run["stop"]).alias("end"),
        ),
        lambda acc: acc["sum"],
    )
