"""Token files: id sequences per shard, shortened by a Re-Pair grammar and read back at random places.

A file is Parquet; each row is a shard of consecutive documents. Frequent pairs
of ids are replaced by new symbols, round by round, until no pair pays for its
rule or the 16-bit symbols are used up; the shard stores the rules, how many ids
each of them stands for, the shortened sequence, and a mark every few thousand
symbols: the ids before it. A document is decoded alone: the marks and a few
thousand lengths tell which symbols hold its ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.common import per_batch
from saleswh.llm.encoding import encoder
from saleswh.operators.files import scratch_path

SHARD_SCHEMA = (
    "part int, shard int, ids_before long, n_docs int, n_ids long, first_symbol int, "
    "doc_ids binary, doc_nulls binary, doc_sizes binary, rules binary, rule_sizes binary, symbols binary, marks binary"
)
#: Symbols are written as 16-bit numbers; ids and rules share them.
SYMBOLS = 1 << 16
BUCKET_BITS = 20
#: A rule takes two numbers and a length, eight bytes; each use of it saves two.
LEAST_USES = 5
#: This job has its tasks to itself: more chunks remembered, larger blocks.
KNOWN, BLOCK_BYTES = 1_200_000, 32_000_000
MARK_EVERY = 4096


def _buckets(pairs: np.ndarray) -> np.ndarray:
    """A hash bucket per pair."""
    return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def _frequent_pairs(pair: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs seen ``least`` times or more in order, and how often."""
    ordered = np.sort(pair)
    # Where a pair stands ``least`` times from, it is frequent.
    seen = np.flatnonzero(ordered[least - 1 :] == ordered[: len(ordered) - least + 1]) if len(ordered) >= least else []
    values = ordered[seen]
    start = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[start], np.diff(start, append=len(values)) + least - 1


def _table_of(pairs: np.ndarray) -> np.ndarray:
    """A table of all hash buckets that tells those of the pairs."""
    table = np.zeros(1 << BUCKET_BITS, bool)
    table[_buckets(pairs)] = True
    return table


def _apart(pairs: np.ndarray) -> np.ndarray:
    """Those pairs, in order, whose left symbol ends no chosen pair and whose right one begins none.

    Occurrences of such pairs cannot overlap, apart from runs of one symbol.
    """
    lefts, rights = bytearray(SYMBOLS), bytearray(SYMBOLS)
    chosen = []
    for i, (a, b) in enumerate(zip((pairs >> 16).tolist(), (pairs & 0xFFFF).tolist(), strict=True)):
        if rights[a] or lefts[b] or (a == b and (lefts[a] or rights[b])):
            continue
        lefts[a] = rights[b] = 1
        chosen.append(i)
    return pairs[np.array(chosen, np.int64)]


def compress(
    ids: np.ndarray, first_symbol: int, least: int = LEAST_USES, per_round: int = 4096
) -> tuple[np.ndarray, np.ndarray]:
    """The shortened sequence and its rules: row i is what symbol ``first_symbol + i`` stands for.

    Stops when no pair is seen ``least`` times or the 16-bit symbols are used up.
    """
    symbols = ids.astype(np.uint32)
    rules = [np.empty((0, 2), np.uint32)]
    made = first_symbol
    # Places whose pair may be frequent: without new symbols, a pair never becomes more frequent than it was.
    live = np.arange(max(len(symbols) - 1, 0))
    while len(live) and made < SYMBOLS:
        # Two 16-bit symbols in one number.
        pair = (symbols[live] << np.uint32(16)) | symbols[live + 1]
        pairs, count = _frequent_pairs(pair, least)
        bucket = _buckets(pair)
        full = np.flatnonzero(_table_of(pairs)[bucket])
        live, pair, bucket = live[full], pair[full], bucket[full]
        most = np.lexsort((pairs, -count))[: min(per_round, SYMBOLS - made)]
        pairs = np.sort(_apart(pairs[most]))
        if not len(pairs):
            break
        some = np.flatnonzero(_table_of(pairs)[bucket])
        at, here = live[some], pair[some]
        rule = np.minimum(np.searchsorted(pairs, here), len(pairs) - 1)
        hit = pairs[rule] == here
        at, rule = at[hit], rule[hit]
        if len(at) > 1 and (np.diff(at) == 1).any():
            # A run of one symbol: every second place from the run's start counts.
            start = np.concatenate(([True], np.diff(at) > 1))
            since = np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
            even = since % 2 == 0
            at, rule = at[even], rule[even]
        symbols[at] = made + rule
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        # The pairs of a new symbol with both of its neighbours are new.
        may = np.zeros(len(symbols), bool)
        may[live] = may[at] = True
        symbols, may = symbols[stay], may[stay]
        new = at - np.arange(len(at))
        may[new[new > 0] - 1] = True
        live = np.flatnonzero(may[:-1])
        rules.append(np.stack([pairs >> np.uint32(16), pairs & np.uint32(0xFFFF)], axis=1))
        made += len(pairs)
    return symbols, np.concatenate(rules)


def sizes_of(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """How many ids each symbol stands for."""
    size = [1] * first_symbol
    for a, b in rules.tolist():
        size.append(size[a] + size[b])
    return np.array(size, np.int64)


def expansions(rules: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per symbol its ids in one flat array: where they start, how many, and the array."""
    plain = np.arange(first_symbol, dtype="<u4").tobytes()
    text = [plain[i : i + 4] for i in range(0, len(plain), 4)]
    for a, b in rules.tolist():
        text.append(text[a] + text[b])
    size = np.fromiter(map(len, text), np.int64, len(text)) // 4
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    return start, size, np.frombuffer(b"".join(text), "<u4")


def expand(symbols: np.ndarray, rules: np.ndarray, first_symbol: int) -> np.ndarray:
    start, size, flat = expansions(rules, first_symbol)
    many = size[symbols]
    ends = np.cumsum(many)
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(start[symbols] - (ends - many), many)
    return flat[at]


def marks_of(symbols: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Ids before every ``MARK_EVERY``-th symbol."""
    return np.concatenate(([0], np.cumsum(size[symbols])))[:-1:MARK_EVERY] if len(symbols) else np.empty(0, np.int64)


def expand_range(
    symbols: np.ndarray,
    rules: np.ndarray,
    first_symbol: int,
    start: int,
    stop: int,
    rule_sizes: np.ndarray,
    marks: np.ndarray,
) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard; only the stretch of symbols between two marks is looked at."""
    if stop <= start:
        return np.empty(0, np.uint32)
    low = max(int(np.searchsorted(marks, start, side="right")) - 1, 0)
    high = int(np.searchsorted(marks, stop, side="left"))
    some = symbols[low * MARK_EVERY : high * MARK_EVERY]
    size = np.ones(len(some), np.int64)
    made = some >= first_symbol
    size[made] = rule_sizes[some[made] - first_symbol]
    ends = int(marks[low]) + np.cumsum(size)
    a = int(np.searchsorted(ends, start, side="right"))
    b = int(np.searchsorted(ends, stop, side="left")) + 1
    before = int(ends[a] - size[a])
    parts = [_expand_symbol(int(x), rules, first_symbol) for x in some[a:b].tolist()]
    return np.array([i for part in parts for i in part], np.uint32)[start - before : stop - before]


def _expand_symbol(symbol: int, rules: np.ndarray, first_symbol: int) -> list[int]:
    """The ids of one symbol, by its rules alone."""
    out, waiting = [], [symbol]
    while waiting:
        x = waiting.pop()
        if x < first_symbol:
            out.append(x)
        else:
            left, right = rules[x - first_symbol].tolist()
            waiting += [right, left]
    return out


def write_token_files(
    documents: DataFrame, tokenizer: str, path: str, end_id: int, vocabulary: int, shard_ids: int = 1_000_000
) -> None:
    """All documents in ascending ``doc_id`` order (null first, ties by text) as shards of about ``shard_ids`` ids.

    ``vocabulary``: one more than the largest id; rules take the 16-bit numbers
    from there on. Null text counts as empty.
    """
    if vocabulary > SYMBOLS:
        raise ValueError("ids do not fit 16 bits")
    ordered = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        docs: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal shard, before
            doc, size, whole = pa.concat_arrays(docs), np.concatenate(sizes), np.concatenate(ids)
            symbols, rules = compress(whole, vocabulary)
            many = sizes_of(rules, vocabulary)
            row = [
                part, shard, before, len(size), len(whole), vocabulary,
                doc.fill_null(0).to_numpy().astype("<i8").tobytes(),
                np.packbits(doc.is_null().to_numpy(zero_copy_only=False)).tobytes(),
                size.astype("<i8").tobytes(), rules.astype("<u2").tobytes(), many[vocabulary:].astype("<u4").tobytes(),
                symbols.astype("<u2").tobytes(), marks_of(symbols, many).astype("<i8").tobytes(),
            ]
            shard, before = shard + 1, before + len(whole)
            docs.clear(), sizes.clear(), ids.clear()
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 7]
            names = [x.strip().split(" ")[0] for x in SHARD_SCHEMA.split(",")]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, types, strict=True)], names=names
            )

        for batch in batches:
            at = 0
            for found, edges in encoder(tokenizer, KNOWN).encode(batch.column(1), BLOCK_BYTES, chunks=shard_ids // 4):
                n = len(edges) - 1
                docs.append(batch.column(0).slice(at, n))
                at += n
                sizes.append(np.diff(edges) + 1)
                ids.append(np.insert(found, edges[1:], end_id))
                if sum(map(len, ids)) >= shard_ids:
                    yield flush()
        if docs:
            yield flush()

    per_batch(ordered, write, SHARD_SCHEMA).write.parquet(path)


def read_token_files(shards: DataFrame) -> DataFrame:
    """Per document ``doc_id, start, n_tokens, ids_crc32`` from decoded shards."""
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per partition of the writing job.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start")
    )
    placed = shards.join(offsets, shards["part"] == offsets["of_part"]).select(
        (F.col("part_start") + F.col("ids_before")).alias("start"),
        "first_symbol", "doc_ids", "doc_nulls", "doc_sizes", "rules", "symbols",
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: v[i].as_py() for k, v in zip(batch.schema.names, batch.columns, strict=True)}
                size = np.frombuffer(row["doc_sizes"], "<i8")
                ids = decode_shard(row).astype("<u4")
                edges = np.concatenate(([0], np.cumsum(size)))
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                null = np.unpackbits(np.frombuffer(row["doc_nulls"], np.uint8))[: len(size)].astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=null),
                        pa.array(row["start"] + edges[:-1]),
                        pa.array(size),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return per_batch(placed, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def decode_shard(row: dict) -> np.ndarray:
    """All ids of one shard row."""
    rules = np.frombuffer(row["rules"], "<u2").reshape(-1, 2).astype(np.uint32)
    return expand(np.frombuffer(row["symbols"], "<u2").astype(np.int64), rules, row["first_symbol"])


def decode_document(row: dict, at: int) -> np.ndarray:
    """The ids of the ``at``-th document of one shard row."""
    edges = np.concatenate(([0], np.cumsum(np.frombuffer(row["doc_sizes"], "<i8"))))
    rules = np.frombuffer(row["rules"], "<u2").reshape(-1, 2).astype(np.uint32)
    symbols = np.frombuffer(row["symbols"], "<u2").astype(np.int64)
    sizes, marks = np.frombuffer(row["rule_sizes"], "<u4").astype(np.int64), np.frombuffer(row["marks"], "<i8")
    return expand_range(symbols, rules, row["first_symbol"], int(edges[at]), int(edges[at + 1]), sizes, marks)


def token_round_trip(documents: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """Writes token files to the shared folder and returns what they hold.

    Null and empty texts have the end id only; very long ones are encoded in
    pieces; repeated rows are stored each, a null doc_id comes first and stays
    null; other columns are not read; no rows in, none out.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(documents, tokenizer, path, end_id, vocabulary)
    return read_token_files(spark.read.schema(SHARD_SCHEMA).parquet(path))
