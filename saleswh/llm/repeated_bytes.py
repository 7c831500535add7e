"""Suffix-array dedup: removes bytes inside strings of 200 bytes that start more than once.

Equal windows have to meet in one shard. Each window is keyed by the smallest
hash of its 24-byte grams, so neighbouring windows share a key and form one
segment, and equal windows share it wherever they are. Keys that turn up once
are done: a first pass counts keys alone, and a second one cuts out the segments
of keys that turn up again, with their bytes, so the texts are not shuffled.
Equal segments of a key are counted together; those that differ go to shards by
key, whose suffix arrays are built by induced sorting and whose permuted common
prefixes tell which windows repeat.

A key with very many different segments (a passage that everybody quotes, cut
by other words around it) is split by content before that: into runs of 32
windows keyed by the bytes they all hold, and if need be into single windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.common import in_table, kept, key_table, per_batch, record_batch, rows_by_table
from saleswh.llm.suffix_arrays import repeated_windows
from saleswh.operators.files import write_once

LENGTH, GRAM = 200, 24
RUN = 32
#: A key with more different segments is split.
MOST_CONTENTS = 256
SHARD_BYTES = 500_000

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all 24-byte grams (16 and 8 joined)."""
    with np.errstate(over="ignore"):
        h = (data.astype(np.uint64) + np.uint64(0x1234567)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        power, by_size = _SPREAD, {}
        size = 1
        while size < 16:
            h = h[:-size] * power + h[size:]
            power, size = power * power, size * 2
            by_size[size] = (h, power)
        long, _ = by_size[16]
        short, short_power = by_size[8]
        out = long[:-8] * short_power + short[16:]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return out ^ (out >> np.uint64(29))


def window_keys(h: np.ndarray) -> np.ndarray:
    """Per window of 200 bytes, the smallest of the hashes ``h`` of its grams."""
    width = LENGTH - GRAM + 1
    padded = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(h)] = h
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return start, np.diff(np.append(start, len(values)))


def _cuts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes, and per segment its key, first window and number of windows."""
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    keys = window_keys(hashes)
    start, n = runs_of(keys)
    return hashes, keys[start], start, n


def _holds_twice(hashes: np.ndarray, keys: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether a segment holds the gram of its key more than once, so that its own windows may be equal."""
    stop = start + n + LENGTH - GRAM
    bounds = zip(keys, start.tolist(), stop.tolist(), strict=True)
    return np.fromiter((np.count_nonzero(hashes[a:b] == key) > 1 for key, a, b in bounds), bool, len(start))


def _repeated_keys(texts: DataFrame) -> DataFrame:
    """``key`` of segments that turns up twice or more; counted per batch before the shuffle, stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, times = [], []
            for data in batch.column(0).to_pylist():
                hashes, key, start, n = _cuts(data)
                keys.append(key)
                times.append(1 + _holds_twice(hashes, key, start, n))
            if keys:
                found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
                total = np.bincount(inverse, weights=np.concatenate(times)).astype(np.int64)
                yield record_batch(["key", "n"], [found.view(np.int64), total])

    counted = per_batch(texts.filter(F.octet_length("data") >= LENGTH).select("data"), count, "key long, n long")
    return kept(counted.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"))


SEGMENTS = "key long, content long, text_id binary, at int, n int, again boolean, data binary"


def _segments(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """A row per segment whose key may turn up again: key, hash of its bytes, text, first window, windows, ``again``.

    ``again``: it holds its key twice. ``data`` are its bytes, with the first of
    equal segments in a task only. The table of bits lets some keys through that
    do not turn up again; the more keys there are, the more.
    """
    sent = texts.sparkSession.sparkContext.broadcast(key_table(repeated))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        names = [x.strip().split(" ")[0] for x in SEGMENTS.split(",")]
        for batch in batches:
            # Equal segments in a batch: one carries the bytes.
            seen: set[tuple[int, int]] = set()
            columns: list[list] = [[] for _ in names]
            for text_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes, key, start, n = _cuts(data)
                some = np.flatnonzero(in_table(table, key))
                if not len(some):
                    continue
                key, start, n = key[some], start[some], n[some]
                again = _holds_twice(hashes, key, start, n)
                key, first = key.view(np.int64).tolist(), start.tolist()
                for k, a, b in zip(key, first, (start + n + LENGTH - 1).tolist(), strict=True):
                    whole = data[a:b]
                    content = _signed(whole)
                    columns[1].append(content)
                    columns[6].append(None if (k, content) in seen else whole)
                    seen.add((k, content))
                columns[0] += key
                columns[2] += [text_id] * len(key)
                columns[3] += first
                columns[4] += n.tolist()
                columns[5] += again.tolist()
            if columns[0]:
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
                yield record_batch(names, [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)])

    return per_batch(texts.filter(F.octet_length("data") >= LENGTH).select("text_id", "data"), cut, SEGMENTS)


PARTS = (
    "key long, content long, part_key long, part_content long, off int, n int, copies long, "
    "again boolean, split boolean, data binary"
)


def _parts(wanted: DataFrame) -> DataFrame:
    """Wanted segments with their bytes; those of split keys in runs of windows keyed by what the run's windows share.

    ``wanted``: key, content, n, copies, again, split and data.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.strip().split(" ")[0] for x in PARTS.split(",")]
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

        rows: list[tuple] = []
        for batch in batches:
            for key, content, n, copies, again, split, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not split:
                    rows.append((key, content, key, content, 0, n, copies, again, False, whole))
                else:
                    for off, size, shared in _split(whole, n, key):
                        part = whole[off : off + size + LENGTH - 1]
                        rows.append((key, content, _signed(shared), _signed(part), off, size, copies, False, True, part))
                if len(rows) >= 20_000:
                    yield batch_of(rows)
                    rows = []
        if rows:
            yield batch_of(rows)

    return per_batch(wanted.select("key", "content", "n", "copies", "again", "split", "data"), cut, PARTS)


def _signed(data: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


def _split(whole: bytes, n: int, key: int) -> list[tuple[int, int, bytes]]:
    """Runs of at most 32 windows (first, number), with the bytes that all windows of such a run hold.

    Equal windows hold the gram first at equal distances. Runs are cut where the
    distance passes a multiple of 32, so equal windows are in runs with the same
    shared bytes, also where a segment's edge cuts a run short.
    """
    hashes = gram_hashes(np.frombuffer(whole, np.uint8)).view(np.int64)
    places = np.flatnonzero(hashes == key)
    window = np.arange(n)
    first = places[np.searchsorted(places, window)]
    group = (first - window) // RUN
    start, size = runs_of(group + first * LENGTH)
    shared = first[start] - group[start] * RUN
    return [
        (a, b, whole[c : c + LENGTH - RUN + 1])
        for a, b, c in zip(start.tolist(), size.tolist(), shared.tolist(), strict=True)
    ]


REPEATS = "part_key long, part_content long, start int, stop int"


def _repeats_in_shards(contents: DataFrame) -> DataFrame:
    """Windows of the contents that start elsewhere under the same part key, by suffix arrays of shards.

    Rows come sorted by part key; whole keys are gathered until a shard is full.
    """
    dealt = contents.repartition("part_key").sortWithinPartitions("part_key")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int, bytes]] = []
        size = 0

        def shard(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
            # UTF-8 has no byte above F4, so one more still fits, and 0 is free to part the contents.
            text = np.zeros(sum(len(r[4]) + 1 for r in rows), np.uint8)
            at, starts = 0, []
            for row in rows:
                text[at : at + len(row[4])] = np.frombuffer(row[4], np.uint8)
                text[at : at + len(row[4])] += 1
                starts.append(at)
                at += len(row[4]) + 1
            twice = repeated_windows(text, LENGTH)
            out: list[tuple[int, int, int, int]] = []
            for (key, content, n, copies, _), start in zip(rows, starts, strict=True):
                flags = twice[start : start + n] if copies == 1 else np.ones(n, bool)
                first, many = runs_of(flags)
                out += [
                    (key, content, a, a + b)
                    for a, b in zip(first.tolist(), many.tolist(), strict=True)
                    if flags[a]
                ]
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["part_key", "part_content", "start", "stop"],
            )

        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= SHARD_BYTES and row[0] != last:
                    yield shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                last = row[0]
        if held:
            yield shard(held)

    return per_batch(dealt.select("part_key", "part_content", "n", "copies", "data"), sort, REPEATS)


def _repeats_of_windows(contents: DataFrame) -> DataFrame:
    """The same for keys that are still too full: every window by itself, counted before the shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (xxhash.xxh3_128_digest(data[i : i + LENGTH]), key, content, i, copies)
                for key, content, n, copies, data in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for i in range(n)
            ]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["window", "part_key", "part_content", "start", "copies"],
            )

    windows = per_batch(
        contents.select("part_key", "part_content", "n", "copies", "data"),
        cut,
        "window binary, part_key long, part_content long, start int, copies long",
    )
    again = windows.groupBy("window").agg(F.sum("copies").alias("n")).filter("n > 1").select("window")
    # A part has 32 windows at most; neighbours become one span before they meet the texts again.
    starts = (
        windows.join(again, "window").groupBy("part_key", "part_content").agg(F.collect_set("start").alias("starts"))
    )
    edges = F.arrays_zip(
        F.array_sort(F.filter("starts", lambda at: ~F.array_contains("starts", at - 1))).alias("start"),
        F.array_sort(F.filter("starts", lambda at: ~F.array_contains("starts", at + 1))).alias("last"),
    )
    spans = starts.select("part_key", "part_content", F.explode(edges).alias("span"))
    return spans.select(
        "part_key",
        "part_content",
        F.col("span.start").alias("start"),
        (F.col("span.last") + 1).cast("int").alias("stop"),
    )


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``text_id, start, stop``: windows from start up to stop (exclusive) also start elsewhere.

    ``texts``: text_id (equal for equal texts) and data; a row per document.
    """
    repeated = _repeated_keys(texts)
    cut, _ = write_once(_segments(texts, repeated), "segments")
    members = kept(
        cut.drop("data")
        .join(repeated, "key")
        .groupBy("key", "content", "text_id", "at", "n", "again")
        .agg(F.count("*").alias("copies"))
    )
    contents = members.groupBy("key", "content").agg(
        F.sum("copies").alias("copies"), F.max("again").alias("again"), F.max("n").alias("n")
    )
    contents = kept(contents)
    per_key = contents.groupBy("key").agg(F.count("*").alias("n_contents"), F.max("again").alias("any_again"))
    # All segments of such a key are equal: every window of them repeats.
    alike = (F.col("n_contents") == 1) & ~F.col("any_again")
    judged = kept(contents.join(per_key, "key").withColumn("alike", alike))
    whole = members.join(judged.filter("alike").select("key"), "key").select(
        "text_id", F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("stop")
    )
    wanted = judged.filter("NOT alike").withColumn("split", F.col("n_contents") > MOST_CONTENTS)
    data = cut.filter("data IS NOT NULL").groupBy("key", "content").agg(F.min("data").alias("data"))
    parts, _ = write_once(_parts(wanted.join(data, ["key", "content"])), "parts")
    split = parts.filter("split").groupBy("part_key", "part_content").agg(
        F.sum("copies").alias("copies"),
        F.max("again").alias("again"),
        F.min("n").alias("n"),
        F.min("data").alias("data"),
    )
    full = split.groupBy("part_key").agg(F.count("*").alias("n_contents"), F.sum("copies").alias("n_copies"))
    sized = kept(split.join(full, "part_key").filter("n_copies > 1 OR again"))
    columns = ["part_key", "part_content", "n", "copies", "data"]
    plain = parts.filter("NOT split").select(*columns)
    found = _repeats_in_shards(
        plain.unionByName(sized.filter(F.col("n_contents") <= MOST_CONTENTS).select(*columns))
    ).unionByName(_repeats_of_windows(sized.filter(F.col("n_contents") > MOST_CONTENTS)))
    in_segments = parts.select("key", "content", "part_key", "part_content", "off").join(
        found, ["part_key", "part_content"]
    ).select("key", "content", (F.col("off") + F.col("start")).alias("start"), (F.col("off") + F.col("stop")).alias("stop"))
    in_texts = members.join(in_segments, ["key", "content"]).select(
        "text_id", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("stop")).alias("stop")
    )
    return whole.unionByName(in_texts)


def _documents(documents: DataFrame) -> DataFrame:
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return documents.select(F.col("doc_id").cast("long"), F.unhex(F.md5(data)).alias("text_id"), data.alias("data"))


CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_data binary"
#: Texts that a task holds as Python objects at a time.
ROWS_AT_ONCE = 1000


def removed_spans(documents: DataFrame) -> DataFrame:
    """Per text with something to remove: ``text_id`` and ``spans``, its windows that repeat, in order."""
    texts = _documents(documents).select("text_id", "data")
    spans = repeated_spans(texts).groupBy("text_id", "start", "stop").agg(F.lit(1).alias("_"))
    return spans.groupBy("text_id").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def byte_spans(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows from ``starts`` up to ``stops``, sorted by start."""
    if not len(starts):
        return []
    ends = np.maximum.accumulate(stops + LENGTH - 1)
    new = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1])))
    return list(zip(starts[new].tolist(), ends[np.append(new[1:] - 1, len(ends) - 1)].tolist(), strict=True))


def without_repeats(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``kept_data``, the bytes that stay.

    Null text counts as empty. Rows with equal texts are copies of one another:
    all their windows repeat, also if they share a doc_id. A text shorter than
    200 bytes keeps all. No rows in, none out.
    """
    spans, _ = write_once(removed_spans(documents), "spans")
    # Texts that cannot have any stay where they are.
    key = F.xxhash64("text_id").alias("key")
    table = documents.sparkSession.sparkContext.broadcast(key_table(spans.select(key)))
    own = _documents(documents).select("doc_id", "data", "text_id", key)
    met = rows_by_table(own, "key", table, present=True).join(spans.hint("merge"), "text_id", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                yield _cut_batch(some.column(0), some.column(1), some.column(2).to_pylist())

    # One worker both chooses and cuts: two would hold the texts twice.
    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                some = some.filter(pa.array(~in_table(table.value, some.column(2).to_numpy())))
                yield _cut_batch(some.column(0), some.column(1), [None] * some.num_rows)

    left = per_batch(own.select("doc_id", "data", "key"), leave, CUT)
    return per_batch(met.select("doc_id", "data", "spans"), cut, CUT).unionByName(left)


def _cut_batch(doc_id: pa.Array, texts: pa.Array, spans: list) -> pa.RecordBatch:
    size, removed, count, digest, left = [], [], [], [], []
    for data, own in zip(texts.to_pylist(), spans, strict=True):
        pairs = np.array([(s["start"], s["stop"]) for s in own or []], np.int64).reshape(-1, 2)
        gone = byte_spans(pairs[:, 0], pairs[:, 1])
        stay, at = [], 0
        for a, b in gone:
            stay.append(data[at:a])
            at = b
        rest = b"".join([*stay, data[at:]]) if gone else data
        size.append(len(data))
        removed.append(len(data) - len(rest))
        count.append(len(gone))
        digest.append(hashlib.sha256(rest).hexdigest())
        left.append(rest)
    return record_batch(
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_data"],
        [
            doc_id, pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
            pa.array(digest, pa.string()), pa.array(left, pa.binary()),
        ],
    )
