"""MinHash near-duplicates with min-max hashing.

Each of 128 permutations of a text's five-word shingles gives its minimum and
its maximum, so a signature of 256 values takes half the evaluations. Five
values make a band; texts that share a band are candidates. Texts with equal
shingle sets are one class from the start. In a bucket of many classes each is
first compared with two of them only; those linked become one component, and
then only classes of different components are compared, with one byte per
signature value. What may be alike is confirmed on the full sets, so no link
rests on an estimate. Buckets with many classes left make families; a family is
compared once, block by block inside tasks that hold the sets themselves, and
only links leave them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.common import in_slices, kept, key_table, per_batch, record_batch, rows_by_table
from saleswh.llm.components import connected_components
from saleswh.operators.files import write_once

SHINGLE = 5
PERMUTATIONS, ROWS = 128, 5
BANDS = 2 * PERMUTATIONS // ROWS
PERCENT = 75
#: Of 256 one-byte values a pair at 0.75 shares 193 on average, with deviation 7; 150 is six deviations less.
LEAST_SHARED_BYTES = 150
#: Buckets with more classes than this are compared as families.
MOST_IN_BUCKET = 64
#: Shingle hashes and signatures of a block; a task compares two.
BLOCK_BYTES = 16 << 20

_random = np.random.default_rng(20240229)
_FACTOR = (_random.integers(0, 2**31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_ADD = _random.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)[:, None]
_BAND_ORDER = _random.permutation(2 * PERMUTATIONS)[: BANDS * ROWS]
_BAND_FACTOR = _random.integers(1, 2**62, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words (A-Z only), and the edges of each text in them."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    edges = cut.offsets.to_numpy().astype(np.int64)
    numbered = cut.flatten().dictionary_encode()
    distinct = numbered.dictionary.to_numpy(zero_copy_only=False)
    hashed = np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct), np.uint64, len(distinct))
    empty = np.fromiter((not w for w in distinct), bool, len(distinct))
    at = numbered.indices.to_numpy()
    real = ~empty[at]
    return hashed[at[real]], np.concatenate(([0], np.cumsum(real)))[edges - edges[0]]


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; fewer words are one shingle, none give none."""
    if not len(words):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        size = min(SHINGLE, len(words))
        n = len(words) - size + 1
        total = np.full(n, size, np.uint64)
        for i in range(size):
            total = (total ^ words[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    return np.unique(total)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum of every permutation, long sets in slices."""
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(folded), 2048):
        turned = folded[None, at : at + 2048] * _FACTOR + _ADD
        turned ^= turned >> np.uint32(15)
        turned *= np.uint32(0x85EBCA6B)
        low = np.minimum(low, turned.min(axis=1))
        high = np.maximum(high, turned.max(axis=1))
    return np.concatenate([low, high])


def band_keys(signed: np.ndarray) -> np.ndarray:
    values = signed[_BAND_ORDER].reshape(BANDS, ROWS).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for i in range(ROWS):
            key = (key ^ (values[:, i] * _BAND_FACTOR[i])) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
    return key.view(np.int64)


def sketches(documents: DataFrame) -> DataFrame:
    """A row per document: ``row``, ``task``, ``doc_id``, ``text_key``, ``set_id``, ``n_shingles``, ``bytes`` and ``bands``.

    ``set_id`` is equal for equal shingle sets and null for none; of equal sets in
    a task only the first carries signature bytes and bands. ``text_key`` is a hash
    of the text, by which texts are found again.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in in_slices(batches):
            words, edges = word_hashes(batch.column(4))
            ids, sizes, bytes_, keys = [], [], [], []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                shingles = shingle_set(words[a:b])
                sizes.append(len(shingles))
                own = xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None
                ids.append(own)
                if own is None or own in seen:
                    bytes_.append(None)
                    keys.append(None)
                    continue
                seen.add(own)
                signed = signature(shingles)
                bytes_.append((signed ^ (signed >> np.uint32(16))).astype(np.uint8).tobytes())
                keys.append(band_keys(signed))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4],
                    pa.array(ids, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(bytes_, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["row", "task", "doc_id", "text_key", "set_id", "n_shingles", "bytes", "bands"],
            )

    return per_batch(
        documents.select(
            F.monotonically_increasing_id().alias("row"),
            F.spark_partition_id().alias("task"),
            F.col("doc_id").cast("long").alias("doc_id"),
            text_key().alias("text_key"),
            "text",
        ),
        sketch,
        "row long, task int, doc_id long, text_key long, set_id binary, n_shingles long, bytes binary, bands array<long>",
    )


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _shared_bands(carriers: DataFrame) -> DataFrame:
    """``band, row`` for each band that two rows or more have; the others leave with the first shuffle."""
    entries = carriers.select(F.explode("bands").alias("band"), "row")
    dealt = entries.repartition("band").sortWithinPartitions("band")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray, bool] | None = None  # the last entry, and whether its band has more
        for batch in batches:
            if not batch.num_rows:
                continue
            band, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            open_ = np.zeros(1, bool)
            if held is not None:
                band, row = np.concatenate([held[0], band]), np.concatenate([held[1], row])
                open_[0] = held[2]
            same = band[1:] == band[:-1]
            many = np.concatenate([open_, same]) | np.append(same, False)
            held = band[-1:], row[-1:], bool(many[-1])
            yield record_batch(["band", "row"], [band[:-1][many[:-1]], row[:-1][many[:-1]]])
        if held is not None and held[2]:
            yield record_batch(["band", "row"], [held[0], held[1]])

    return per_batch(dealt, shared, "band long, row long")


def _resembling(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sizes allow a link and whose signatures do not rule it out."""
    side = {
        x: classes.select(F.col("cls").alias(x), F.col("bytes").alias(f"bytes_{x}"), F.col("n_shingles").alias(f"n_{x}"))
        for x in "ab"
    }
    joined = pairs.join(side["a"], "a").join(side["b"], "b")
    possible = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, other = (_signatures(batch.column(i)) for i in (2, 3))
                alike = (one == other).sum(axis=1) >= LEAST_SHARED_BYTES
                yield batch.select(["a", "b"]).filter(pa.array(alike))

    return per_batch(joined.filter(possible).select("a", "b", "bytes_a", "bytes_b"), compare, "a long, b long")


def _texts(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """One text for each class, stored.

    Texts are found by their hash. A table of bits tells those that nobody looks
    for, so they are not shuffled.
    """
    wanted = classes.select("cls", "text_key", "set_id")
    table = documents.sparkSession.sparkContext.broadcast(key_table(wanted.select(F.col("text_key").alias("key"))))
    own = rows_by_table(documents.select(text_key().alias("text_key"), "text"), "text_key", table, present=True)
    texts = own.join(wanted.hint("merge"), "text_key").select("cls", "set_id", "text")

    # Texts with one hash may be of other classes; the set decides. A copy in the same task adds nothing.
    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            keep = []
            for at, cls in enumerate(ids):
                if cls not in seen:
                    words, _ = word_hashes(batch.column(2).slice(at, 1))
                    if xxhash.xxh3_128_digest(shingle_set(words).tobytes()) == batch.column(1)[at].as_py():
                        seen.add(cls)
                        keep.append(at)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["cls", "text"]).take(
                pa.array(keep, pa.int64())
            )

    return kept(per_batch(texts, first_of_each, "cls long, text string").dropDuplicates(["cls"]))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs that hold the threshold on their full shingle sets."""
    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [word_hashes(batch.column(i)) for i in (2, 3)]
            linked = [
                _linked(*(shingle_set(w[e[row] : e[row + 1]]) for w, e in sides)) for row in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return kept(per_batch(both.select("a", "b", "text_a", "text_b"), confirm, "a long, b long"))


def _linked(one: np.ndarray, other: np.ndarray) -> bool:
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * shared >= PERCENT * (len(one) + len(other) - shared)


def _by_key(
    batches: Iterator[pa.RecordBatch], key_columns: int, rows_at_once: int = 4096
) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Whole groups of equal keys from sorted rows, some groups at a time, as a table and their bounds."""
    held: list[pa.RecordBatch] = []

    def bounds(table: pa.Table) -> list[int]:
        keys = [table.column(i).to_numpy() for i in range(key_columns)]
        new = np.zeros(max(table.num_rows - 1, 0), bool)
        for key in keys:
            new |= key[1:] != key[:-1]
        return [0, *(np.flatnonzero(new) + 1).tolist()]

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows_at_once:
            table = pa.Table.from_batches(held)
            starts = bounds(table)
            if len(starts) > 1:
                yield table.slice(0, starts[-1]), list(zip(starts[:-1], starts[1:], strict=True))
                held = table.slice(starts[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        starts = bounds(table)
        yield table, list(zip(starts, [*starts[1:], table.num_rows], strict=True))


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    one, other = zip(*found, strict=True)
    return record_batch(["a", "b"], [pa.array(one, pa.int64()), pa.array(other, pa.int64())])


def _alike(size: np.ndarray, signed: np.ndarray, x: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` that sizes and signatures allow to be linked with row ``x``."""
    near = 100 * np.minimum(size[others], size[x]) >= PERCENT * np.maximum(size[others], size[x])
    others = others[near]
    return others[(signed[others] == signed[x]).sum(axis=1) >= LEAST_SHARED_BYTES]


def _signatures(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 2 * PERMUTATIONS)


def _pairs_in_buckets(entries: DataFrame) -> DataFrame:
    """Resembling pairs of different components within small buckets, but for those of one family.

    ``entries``: band, cls, component, family (-1 for none), n_shingles, bytes.
    """
    dealt = entries.repartition("band").sortWithinPartitions("band")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, groups in _by_key(batches, 1):
            sets, size, signed = rows.column(1).to_numpy(), rows.column(4).to_numpy(), _signatures(rows.column(5))
            part, family = rows.column(2).to_numpy(), rows.column(3).to_numpy()
            found: set[tuple[int, int]] = set()
            for a, b in groups:
                for x in range(a, b - 1):
                    others = np.arange(x + 1, b)
                    apart = (family[others] != family[x]) | (family[x] < 0)
                    others = others[(part[others] != part[x]) & apart]
                    for y in _alike(size, signed, x, others).tolist() if len(others) else ():
                        found.add((int(min(sets[x], sets[y])), int(max(sets[x], sets[y]))))
            if found:
                yield _pairs(sorted(found))

    columns = ["band", "cls", "component", "family", "n_shingles", "bytes"]
    return per_batch(dealt.select(*columns), compare, "a long, b long").distinct()


def _links_in_families(members: DataFrame) -> DataFrame:
    """Links between different components of each family; of links that join the same parts one is enough.

    ``members``: family, cls, component, n_shingles, bytes, text. The largest
    component of a family is only compared with the rest; both are dealt out in
    blocks of some ``BLOCK_BYTES``, so a task holds two blocks at a time, however
    large the family.
    """
    by_component = members.groupBy("family", "component").agg(
        F.count("*").alias("n"), F.sum(8 * F.col("n_shingles") + 2 * PERMUTATIONS).alias("size")
    )
    per_family = by_component.groupBy("family").agg(
        F.max(F.struct("n", "component", "size")).alias("main"), F.sum("size").alias("total")
    )
    sized = members.join(per_family, "family").select(
        *members.columns,
        (F.col("component") == F.col("main.component")).alias("in_main"),
        F.ceil(F.col("main.size") / BLOCK_BYTES).cast("int").alias("main_blocks"),
        F.ceil((F.col("total") - F.col("main.size")) / BLOCK_BYTES).cast("int").alias("rest_blocks"),
    )
    blocks = F.when(F.col("in_main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))
    own = F.col("block")
    rest = F.sequence(F.lit(0), F.col("rest_blocks") - 1)
    main = F.sequence(F.lit(1), F.col("main_blocks"))

    def pair(i: Column, j: Column) -> Column:
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))

    # A task's key: two blocks of the rest, or one of the main component (counted below 0) and one of the rest.
    keys = F.when(F.col("in_main"), F.transform(rest, lambda j: pair(-own - 1, j))).otherwise(
        F.concat(
            F.transform(rest, lambda j: pair(F.least(own, j), F.greatest(own, j))), F.transform(main, lambda m: pair(-m, own))
        )
    )
    dealt = (
        sized.filter("rest_blocks > 0")
        .withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
        .withColumn("key", F.explode(keys))
        .select("family", "key.i", "key.j", "cls", "component", "n_shingles", "bytes", "text")
    )
    dealt = dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, groups in _by_key(batches, 3, rows_at_once=1):
            sets, size, signed = rows.column(3).to_numpy(), rows.column(5).to_numpy(), _signatures(rows.column(6))
            part = rows.column(4).to_numpy()
            words, edges = word_hashes(rows.column(7).combine_chunks())
            shingles: dict[int, np.ndarray] = {}

            def full(x: int) -> np.ndarray:
                if x not in shingles:
                    shingles[x] = shingle_set(words[edges[x] : edges[x + 1]])  # noqa: B023
                return shingles[x]

            found = []
            for a, b in groups:
                joined = {p: p for p in set(part[a:b].tolist())}

                def root(p: int, joined: dict[int, int] = joined) -> int:
                    while joined[p] != p:
                        joined[p] = joined[joined[p]]
                        p = joined[p]
                    return p

                for x in range(a, b - 1):
                    others = np.arange(x + 1, b)
                    others = others[part[others] != part[x]]
                    for y in _alike(size, signed, x, others).tolist() if len(others) else ():
                        p, q = root(int(part[x])), root(int(part[y]))
                        if p != q and _linked(full(x), full(y)):
                            joined[p] = q
                            found.append((int(sets[x]), int(sets[y])))
            if found:
                yield _pairs(found)

    return per_batch(dealt, compare, "a long, b long")


def _later_links(unresolved: DataFrame, first_pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between classes that share a bucket but are in different components so far.

    ``unresolved``: band, cls, component, and n, the classes of the band.
    """
    known = classes.select("cls", "n_shingles", "bytes")
    crowded = unresolved.filter(F.col("n") > MOST_IN_BUCKET)
    lowest = crowded.groupBy("band").agg(F.min("cls").alias("b"))
    families = connected_components(crowded.join(lowest, "band").select(F.col("cls").alias("a"), "b")).select(
        F.col("node").alias("cls"), F.col("component").alias("family")
    )
    few = unresolved.filter(F.col("n") <= MOST_IN_BUCKET).join(families, "cls", "left").join(known, "cls")
    entries = few.withColumn("family", F.coalesce("family", F.lit(-1)))
    pairs = kept(_pairs_in_buckets(entries).join(first_pairs, ["a", "b"], "left_anti"))
    members = crowded.select("cls", "component").distinct().join(families, "cls").join(known, "cls")
    in_families = _links_in_families(members.join(texts, "cls"))
    return _confirmed(pairs, texts).unionByName(in_families)


def _judged(documents: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, ``text_key``, ``n_shingles`` and ``component``, null for a row without words."""
    sketched = kept(sketches(documents))
    with_words = sketched.filter("set_id IS NOT NULL")
    # A class is numbered by its first row, which carries the sketch; the tasks with a copy bring the number back.
    found = kept(
        with_words.groupBy("set_id").agg(F.min("row").alias("cls"), F.collect_set("task").alias("tasks"))
    )
    rows = with_words.select("row", "task", "doc_id", "text_key", "set_id", "n_shingles").join(
        found.select("set_id", "cls", F.explode("tasks").alias("task")), ["task", "set_id"]
    )
    rows = kept(rows.select("row", "doc_id", "text_key", "n_shingles", "cls"))
    carriers = sketched.filter("bytes IS NOT NULL")
    copies = rows.filter("row != cls").select("row", F.col("cls").alias("of"))
    shared = _shared_bands(carriers).join(copies, "row", "left").select("band", F.coalesce("of", "row").alias("cls"))
    banded = kept(shared.distinct())
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("cls").alias("low"), F.max("cls").alias("high"))
    members = kept(banded.join(buckets.filter("n > 1").drop("n"), "band"))
    met = members.select("cls").distinct()
    classes = kept(
        carriers.withColumnRenamed("row", "cls").join(met, "cls").select("cls", "text_key", "set_id", "n_shingles", "bytes")
    )
    texts = _texts(classes, documents)
    member, low, high = F.col("cls"), F.col("low"), F.col("high")
    pivots = members.select(
        F.explode(F.array(F.struct(*_ordered(member, low)), F.struct(*_ordered(member, high)))).alias("p")
    ).select("p.*")
    first_pairs = kept(_resembling(pivots.filter("a != b").distinct(), classes))
    links = _confirmed(first_pairs, texts)
    component = connected_components(links)
    placed = members.select("band", "cls").join(component, F.col("cls") == F.col("node"), "left").select(
        "band", "cls", F.coalesce("component", "cls").alias("component")
    )
    open_bands = (
        placed.groupBy("band")
        .agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
        .filter("x != y")
        .select("band", "n")
    )
    unresolved = kept(placed.join(open_bands, "band"))
    links = links.unionByName(_later_links(unresolved, first_pairs, classes, texts))
    component = connected_components(links).withColumnRenamed("node", "cls")
    placed_rows = rows.join(component, "cls", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("component", "cls").alias("component")
    )
    alone = sketched.filter("set_id IS NULL").select(
        "doc_id", "text_key", "n_shingles", F.lit(None).cast("long").alias("component")
    )
    return kept(placed_rows.unionByName(alone))


def near_duplicate_groups(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept``.

    A row without words (null, empty or blank text) is linked with nothing and
    kept. Rows that share a doc_id are judged by their own texts. A null doc_id
    counts as no id: the smallest other id of the group is taken, and ``kept``
    is then false; it is null for a group without any id. Other columns are not
    read; a very long text is one row of its task; no rows in, none out.
    """
    rows = _judged(documents)
    smallest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    judged = rows.filter("component IS NOT NULL").join(smallest, "component").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("component IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    keep = F.when(F.col("component_id").isNotNull(), F.col("doc_id").eqNullSafe(F.col("component_id")))
    return judged.unionByName(alone).withColumn("kept", keep)


def one_of_each_group(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each group, all columns as they were.

    The row with the smallest doc_id stays, one without an id only if no other
    has one; of rows with the same doc_id, or all without, that with the smaller
    hash of the text. Rows that are alike in both are repeated rows, of which one
    stays. A row without words stays, and so does each of its repetitions. Other
    columns may have any name; no rows in, none out.

    A table of bits tells the rows that stay for sure; only the others are
    shuffled, to meet the keys of those that go.
    """
    rows = _judged(documents).filter("component IS NOT NULL")
    keys = rows.groupBy("component", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key").alias("key")).agg(
        F.count("*").alias("n")
    )
    first = keys.groupBy("component").agg(F.min("key").alias("stays"))
    judged = keys.join(first, "component").select(
        F.col("key.doc_id").alias("of_doc"),
        F.col("key.text_key").alias("of_text"),
        F.when(F.col("key") != F.col("stays"), "goes").when(F.col("n") > 1, "once").alias("fate"),
    )
    fates, _ = write_once(judged.filter("fate IS NOT NULL"), "fates")
    # Names that no column of the documents can have.
    tag = uuid.uuid4().hex
    key, text = f"key_{tag}", f"text_{tag}"
    keyed = documents.select(
        F.struct(*documents.columns).alias(f"row_{tag}"),
        F.col("doc_id").cast("long").alias(f"doc_{tag}"),
        text_key().alias(text),
    ).withColumn(key, F.xxhash64(f"doc_{tag}", text))
    table = documents.sparkSession.sparkContext.broadcast(
        key_table(fates.select(F.xxhash64("of_doc", "of_text").alias("key")))
    )
    others = rows_by_table(keyed, key, table, present=False).select(f"row_{tag}.*")
    met = F.col(f"doc_{tag}").eqNullSafe(F.col("of_doc")) & (F.col(text) == F.col("of_text"))
    marked = rows_by_table(keyed, key, table, present=True).join(fates.hint("merge"), met, "left")
    left = others.unionByName(marked.filter("fate IS NULL").select(f"row_{tag}.*"))
    if fates.filter("fate = 'once'").isEmpty():
        return left
    alike = Window.partitionBy(f"doc_{tag}", text).orderBy(f"at_{tag}")
    repeated = marked.filter("fate = 'once'").withColumn(f"at_{tag}", F.monotonically_increasing_id())
    once = repeated.withColumn(f"place_{tag}", F.row_number().over(alike)).filter(f"place_{tag} = 1")
    return left.unionByName(once.select(f"row_{tag}.*"))
