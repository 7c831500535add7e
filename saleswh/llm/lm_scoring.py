"""LM scoring: the log-likelihood of every whole text under a gated recurrent language model.

Word counts cover all training documents. The most frequent words are symbols
of their own, in classes of 64 that stand in similar surroundings; all others
are grouped by their ending, and within a group the counts decide. So a score
is the sum over its tokens of the class given the state, the word given state
and class or, for rare words, the word given its group.

All training documents are dealt to workers, which train copies of the model in
rounds: each document is learned from in one of them, and the copies are averaged
after each round. Counts of rare words, which
may be any number, are joined by word; only the counts of a fixed number of
frequent words go to all tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.llm import recurrent
from saleswh.llm.common import kept, per_batch

SYMBOL_WORDS = 4096  # words that the network tells apart
FREQUENT_WORDS = 262_144  # words whose counts every task holds
ENDINGS = 64
END = 0  # the hash of the end token; no word hashes to it in practice
SMOOTHING = 0.1
TOKENS_PER_WORKER, ROUNDS = 4_000_000, 3
PARAMETER_BLOCKS = 64
COPIES_AT_ONCE = 64


@dataclass(frozen=True)
class Corpus:
    """Totals of the training tokens, and the frequent words by falling count."""

    tokens: int
    distinct: int
    words: np.ndarray  # hashes
    counts: np.ndarray
    group_tokens: np.ndarray  # per ending, of the words that are no symbols
    group_distinct: np.ndarray

    @property
    def base_total(self) -> float:
        return self.tokens + SMOOTHING * (self.distinct + 1)


def held_out_column() -> Column:
    """crc32 of the doc_id as text is divisible by 10; a null doc_id is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 10 == 0, F.lit(False))


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts with the end token behind each, their edges, and the ending group of every token."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    edges = cut.offsets.to_numpy().astype(np.int64)
    numbered = cut.flatten().dictionary_encode()
    distinct = [w.encode() for w in numbered.dictionary.to_pylist()]
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct)).view(np.int64)
    ending = np.fromiter((zlib.crc32(w[-3:]) % ENDINGS for w in distinct), np.int64, len(distinct))
    at = numbered.indices.to_numpy()
    real = np.fromiter((bool(w) for w in distinct), bool, len(distinct))[at]
    bounds = np.concatenate(([0], np.cumsum(real)))[edges - edges[0]]
    words = np.insert(hashed[at[real]], bounds[1:], END)
    return words, bounds + np.arange(len(bounds)), np.insert(ending[at[real]], bounds[1:], 0)


def count_words(training: DataFrame) -> DataFrame:
    """``word, ending, n`` over all training texts, counted per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _, ending = tokens_of(batch.column(0))
            found, first, n = np.unique(words, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(ending[first].astype(np.int32)), pa.array(n)], names=["word", "ending", "n"]
            )

    counted = per_batch(training.select("text"), count, "word long, ending int, n long")
    return counted.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))


def corpus_of(counts: DataFrame) -> Corpus:
    """What every task needs to know; of bounded size."""
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT_WORDS).toArrow()
    words, ending, n = (top.column(c).to_numpy() for c in ("word", "ending", "n"))
    groups = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("d")).collect()
    tokens, distinct = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for row in groups:
        tokens[row["ending"]], distinct[row["ending"]] = row["n"], row["d"]
    total, kinds = int(tokens.sum()), int(distinct.sum())
    np.subtract.at(tokens, ending[:SYMBOL_WORDS], n[:SYMBOL_WORDS])
    np.subtract.at(distinct, ending[:SYMBOL_WORDS], 1)
    return Corpus(total, kinds, words, n, tokens, distinct)


class Frequent:
    """The words of a corpus by binary search: rank and count, or -1 and 0."""

    def __init__(self, corpus: Corpus) -> None:
        self.order = np.argsort(corpus.words)
        self.sorted = corpus.words[self.order]
        self.counts = corpus.counts

    def rank(self, words: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.full(len(words), -1)
        distinct, inverse = np.unique(words, return_inverse=True)
        at = np.minimum(np.searchsorted(self.sorted, distinct), len(self.sorted) - 1)
        return np.where(self.sorted[at] == distinct, self.order[at], -1)[inverse]


def symbols_of(rank: np.ndarray, ending: np.ndarray) -> np.ndarray:
    """Frequent words by rank, all others by ending behind them."""
    return np.where((rank >= 0) & (rank < SYMBOL_WORDS), rank, SYMBOL_WORDS + ending)


def word_classes(corpus: Corpus, followers: np.ndarray) -> recurrent.Symbols:
    """Symbols in classes of 64: halves along the main direction of what stands before them, again and again."""
    n = SYMBOL_WORDS // recurrent.CLASS_WORDS
    seen = np.log1p(followers.astype(np.float64))
    seen /= np.linalg.norm(seen, axis=1, keepdims=True) + 1e-9
    parts = [np.arange(SYMBOL_WORDS)]
    while len(parts) < n:
        halves = []
        for part in parts:
            x = seen[part] - seen[part].mean(axis=0)
            _, vectors = np.linalg.eigh(x.T @ x)
            order = part[np.argsort(x @ vectors[:, -1], kind="stable")]
            halves += [order[: len(order) // 2], order[len(order) // 2 :]]
        parts = halves
    of_class = np.zeros(SYMBOL_WORDS + ENDINGS, np.int64)
    in_class = np.full(SYMBOL_WORDS + ENDINGS, -1, np.int64)
    for c, part in enumerate(parts):
        of_class[part], in_class[part] = c, np.arange(len(part))
    of_class[SYMBOL_WORDS:] = n + np.arange(ENDINGS)
    return recurrent.Symbols(of_class, in_class)


def training_symbols(training: DataFrame, sent: Broadcast[Corpus]) -> DataFrame:
    """``turn, symbols``: each training document as 16-bit symbols, and the round that learns from it.

    Documents are dealt one by one to workers of about ``TOKENS_PER_WORKER``
    tokens, so copies of a document do not meet at one worker.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent(sent.value)
        row = TaskContext.get().partitionId()
        for batch in batches:
            words, edges, ending = tokens_of(batch.column(0))
            symbol = symbols_of(frequent.rank(words), ending).astype("<u2").tobytes()
            n = len(edges) - 1
            of_text = [symbol[2 * a : 2 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array((row + np.arange(n)) % ROUNDS, pa.int32()), pa.array(of_text, pa.binary())],
                names=["turn", "symbols"],
            )
            row += n

    numbered = per_batch(training.select("text"), number, "turn int, symbols binary")
    return kept(numbered.repartition(_workers(sent.value)))


def _workers(corpus: Corpus) -> int:
    return max(1, round(corpus.tokens / TOKENS_PER_WORKER))


CONTEXTS = 64


def _flat_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts one after the other, and which of them begin a text."""
    texts = texts.to_pylist()
    symbol = np.frombuffer(b"".join(texts), "<u2")
    first = np.zeros(len(symbol), bool)
    first[np.cumsum([0, *(len(x) // 2 for x in texts)])[:-1]] = True
    return symbol, first


def _followers(texts: DataFrame) -> np.ndarray:
    """How often each symbol stands behind each of the most frequent words; a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(CONTEXTS * SYMBOL_WORDS, np.int64)
        for batch in batches:
            symbol = _flat_symbols(batch.column(0))[0].astype(np.int64)
            behind = (symbol[:-1] < CONTEXTS) & (symbol[1:] < SYMBOL_WORDS)
            table += np.bincount(symbol[:-1][behind] * SYMBOL_WORDS + symbol[1:][behind], minlength=len(table))
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["at", "n"])

    found = per_batch(texts.select("symbols"), count, "at long, n long")
    found = found.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CONTEXTS * SYMBOL_WORDS, np.int64)
    out[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(CONTEXTS, SYMBOL_WORDS).T


def _mean_block(copies: pa.Table) -> pa.Table:
    """The mean of some copies of one block of parameters, each weighing as many workers as it stands for."""
    n = copies.column("n").to_numpy()
    values = sum(w * np.frombuffer(x, "<f4").astype(np.float64) for w, x in zip(n, copies.column("values").to_pylist(), strict=True))
    mean = (values / n.sum()).astype("<f4").tobytes()
    return pa.table(
        {"block": copies.column("block").slice(0, 1), "worker": copies.column("worker").slice(0, 1), "n": [n.sum()], "values": pa.array([mean], pa.binary())}
    )


def _mean_parameters(copies: DataFrame, workers: int) -> pa.Table:
    """The means of all blocks, over some ``COPIES_AT_ONCE`` workers at a time, and those over one another's."""
    schema = "block int, worker int, n long, values binary"
    while workers > COPIES_AT_ONCE:
        some = copies.withColumn("worker", F.floor(F.col("worker") / COPIES_AT_ONCE).cast("int"))
        copies = some.groupBy("block", "worker").applyInArrow(_mean_block, schema)
        workers = -(-workers // COPIES_AT_ONCE)
    return copies.groupBy("block").applyInArrow(_mean_block, schema).toArrow()


def train_model(training: DataFrame, corpus: Corpus) -> tuple[recurrent.Parameters, recurrent.Symbols]:
    """Rounds of training on all workers, each followed by averaging the parameters where they are."""
    spark = training.sparkSession
    texts = training_symbols(training, spark.sparkContext.broadcast(corpus))
    known = word_classes(corpus, _followers(texts))
    n = SYMBOL_WORDS // recurrent.CLASS_WORDS
    symbol_count = np.zeros(SYMBOL_WORDS + ENDINGS)
    symbol_count[: min(SYMBOL_WORDS, len(corpus.counts))] = corpus.counts[:SYMBOL_WORDS]
    symbol_count[SYMBOL_WORDS:] = corpus.group_tokens + SMOOTHING
    class_share = np.bincount(known.of_class, weights=symbol_count, minlength=n + ENDINGS)
    word_share = np.zeros((n, recurrent.CLASS_WORDS))
    word_share[known.of_class[:SYMBOL_WORDS], known.in_class[:SYMBOL_WORDS]] = symbol_count[:SYMBOL_WORDS]
    word_share /= np.maximum(word_share.sum(axis=1, keepdims=True), 1e-9)
    p = recurrent.first_parameters(class_share / class_share.sum(), word_share, len(symbol_count))
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast((p, known))

        def learn(batches: Iterator[pa.RecordBatch], turn: int = turn, sent=sent) -> Iterator[pa.RecordBatch]:
            parts = [_flat_symbols(batch.column(0)) for batch in batches]  # about TOKENS_PER_WORKER / ROUNDS tokens
            if parts:
                symbols, starts = (np.concatenate(x) for x in zip(*parts, strict=True))
                trained = recurrent.train(*sent.value, symbols, starts, rate=0.01 / (1 + turn))
                blocks = np.array_split(recurrent.flat(trained).astype("<f4"), PARAMETER_BLOCKS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(len(blocks)), pa.int32()),
                        pa.array([TaskContext.get().partitionId()] * len(blocks), pa.int32()),
                        pa.array([1] * len(blocks), pa.int64()),
                        pa.array([x.tobytes() for x in blocks], pa.binary()),
                    ],
                    names=["block", "worker", "n", "values"],
                )

        own = texts.filter(F.col("turn") == turn).select("symbols")
        copies = per_batch(own, learn, "block int, worker int, n long, values binary")
        found = _mean_parameters(copies, _workers(corpus))
        if found.num_rows:
            blocks = dict(zip(found.column("block").to_pylist(), found.column("values").to_pylist(), strict=True))
            p = recurrent.unflat(np.frombuffer(b"".join(blocks[i] for i in sorted(blocks)), "<f4"), p)
    return p, known


SCORES = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_frequent long, base double, model double, "
    "rare array<long>"
)


def score_documents(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Null text counts as empty: it is one end token. Rows that share a doc_id are
    scored one by one; a null doc_id is not held out. Without training documents
    every token is unknown and both scores are that of a uniform guess; no rows
    in, none out.
    """
    own = documents.select(F.col("doc_id").cast("long"), "text", held_out_column().alias("held_out"))
    training = own.filter(~F.col("held_out"))
    counts = kept(count_words(training))
    corpus = corpus_of(counts)
    p, known = train_model(training.select("text"), corpus)
    sent = documents.sparkSession.sparkContext.broadcast((p, known, corpus))
    group_total = corpus.group_tokens + SMOOTHING * (corpus.group_distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, own, about = sent.value
        frequent = Frequent(about)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            words, edges, ending = tokens_of(batch.column(1))
            rank = frequent.rank(words)
            symbol = symbols_of(rank, ending)
            common = rank >= 0
            count = np.where(common, about.counts[np.maximum(rank, 0)] if len(about.counts) else 0, 0)
            base = np.where(common, np.log10((count + SMOOTHING) / about.base_total), 0.0)
            # Words of an ending group that every task knows: their share of the group.
            grouped = common & (symbol >= SYMBOL_WORDS)
            within = np.where(grouped, np.log10((count + SMOOTHING) / group_total[ending]), 0.0)
            per_text = lambda x, edges=edges: np.add.reduceat(x, edges[:-1]) if len(edges) > 1 else x[:0]
            found = recurrent.score(model, own, symbol, edges) / np.log(10)
            n = len(edges) - 1
            rare = ~common
            owners = np.concatenate(([0], np.cumsum(rare)))[edges].astype(np.int32)
            # A rare word brings its group along in the lowest bits.
            code = (words[rare] & ~np.int64(ENDINGS - 1)) | ending[rare]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(n)), batch.column(0), batch.column(2), pa.array(np.diff(edges)),
                    pa.array(per_text(common.astype(np.int64))), pa.array(per_text(base)),
                    pa.array(per_text(within) + found), pa.ListArray.from_arrays(pa.array(owners), pa.array(code)),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "n_frequent", "base", "model", "rare"],
            )
            row += n

    scored = kept(per_batch(own.select("doc_id", "text", "held_out"), score, SCORES))
    rare_counts = counts.select(
        F.col("word").bitwiseAND(F.lit(~(ENDINGS - 1))).bitwiseOR(F.col("ending").cast("long")).alias("code"), "n"
    )
    # Equal words of a text are counted before they are moved.
    rare = (
        scored.select("row", F.explode("rare").alias("code"))
        .groupBy("row", "code")
        .agg(F.count("*").alias("times"))
    )
    seen = rare.join(rare_counts, "code", "left")
    n = F.coalesce("n", F.lit(0)) + SMOOTHING
    of_group = F.get(F.array(*(F.lit(float(x)) for x in group_total)), F.pmod(F.col("code"), F.lit(ENDINGS)).cast("int"))
    sums = seen.groupBy(F.col("row").alias("of_row")).agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(n / corpus.base_total)).alias("rare_base"),
        F.sum(F.col("times") * F.log10(n / of_group)).alias("rare_model"),
    )
    joined = scored.drop("rare").join(sums, F.col("row") == F.col("of_row"), "left")
    zero = F.lit(0.0)
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("rare_model", zero)).alias("score"),
    )
