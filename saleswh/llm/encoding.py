"""Exact encoding of many texts with a public tokenizer file.

A blank between two characters that are no white space always ends a piece of
the tokenizers used here, so a text may be cut there and each chunk encoded by
itself. Arrow cuts the texts and numbers the distinct chunks of a block; chunks
not seen before are encoded together in one text, and a bounded dictionary
keeps their ids: when it is full, chunks that were met in one block only go. A
text with other blanks is encoded whole. The ids are those of one call on the
whole text (tested).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A blank at an edge or beside other white space, or the mark of special tokens.
UNSAFE = r"^ | $| [\s\pZ\x0b\x1c-\x1f\x{85}]|[\s\pZ\x0b\x1c-\x1f\x{85}] |<\||\x00"
SEPARATOR = "<|endoftext|>"
#: Marks a chunk that has no blank before it.
FIRST = "\0"
#: Marks behind a letter that are a piece of their own, however many there are.
MARKS = ",.!?;:"


def _parts(key: str) -> list[str]:
    """Chunks that have the same ids as ``key`` when encoded one by one; empty if it is not cut."""
    if "\n" in key[1:-1]:
        lines = key.split("\n")
        if all(lines) and not any(x[0].isspace() or x[-1].isspace() for x in lines) and lines[0] != FIRST:
            return [lines[0], *(y for x in lines[1:] for y in (f"{FIRST}\n", FIRST + x))]
        return []
    word = key.rstrip(MARKS)
    if word[-1:].isalpha() and len(word) < len(key):
        return [word, FIRST + key[len(word) :]]
    return []


class _Codes(dict):
    """Numbers its keys in the order of their first use and notes the new ones."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        self.new.append(key)
        return code


#: Chunks that are remembered (some 180 bytes each), and bytes of text that are cut at a time.
KNOWN, BLOCK_BYTES = 400_000, 4_000_000


class ChunkEncoder:
    """``known``: how many chunks are remembered before those met in one block only are forgotten."""

    def __init__(self, path: str, known: int = KNOWN) -> None:
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.cutting = Tokenizer.from_file(path)
        self.cut = self.cutting.token_to_id(SEPARATOR)
        # Without a normalizer each id stands for a fixed number of bytes, which tells chunks apart.
        self.id_bytes = None
        if self.plain.normalizer is None:
            vocabulary = self.plain.get_vocab(with_added_tokens=False)
            self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            for token, at in vocabulary.items():
                self.id_bytes[at] = len(token)
        # How this file writes a letter chunk before its merges.
        self.lower = self.plain.normalizer is not None
        spelled = {piece: self.plain.pre_tokenizer.pre_tokenize_str(piece) for piece in map(chr, range(33, 256))}
        self.spelling = {ord(c): x[0][0] for c, x in spelled.items() if c.isalpha() and len(x) == 1}
        self.blank = "" if self.lower else self.plain.pre_tokenizer.pre_tokenize_str(" ")[0][0]
        self.known = known
        self.codes = _Codes()
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)  # chunks that an earlier block had as well

    def _forget(self) -> None:
        """Keeps the chunks met again, if they are few enough; their codes follow in the same order."""
        stay = np.flatnonzero(self.again)
        if len(stay) > self.known // 2:
            stay = stay[:0]
        kept = set(stay.tolist())
        codes = _Codes()
        codes.update((key, i) for i, key in enumerate(key for key, at in self.codes.items() if at in kept))
        size = np.diff(self.starts)[stay]
        ends = np.concatenate(([0], np.cumsum(size)))
        self.ids = self.ids[np.arange(ends[-1]) + np.repeat(self.starts[stay] - ends[:-1], size)]
        self.codes, self.starts, self.again = codes, ends, np.zeros(len(stay), bool)

    def _met(self, codes: np.ndarray) -> None:
        """Notes the chunks that were known before this block."""
        self.again[codes[codes < len(self.again)]] = True

    def _letters(self, key: str) -> list[int]:
        """Ids of a chunk of Latin letters, which is one piece: straight from the merges."""
        first = key[:1] == FIRST
        word = key[1:] if first else key
        spelled = (word.lower() if self.lower else word).translate(self.spelling)
        return [x.id for x in self.plain.model.tokenize(spelled if first else self.blank + spelled)]

    def _encode_block(self, block: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks of a block, one after the other, and how many each has."""
        block = [x[1:] if x[:1] == FIRST else f" {x}" for x in block]
        if self.id_bytes is not None and all(x[:1] == " " for x in block):
            ids = np.array(self.plain.encode("".join(block), add_special_tokens=False).ids, np.uint32)
            size = np.fromiter((len(x.encode()) for x in block), np.int64, len(block))
            ends = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum(size), side="left") + 1
            return ids, np.diff(ends, prepend=0)
        if any(SEPARATOR in x for x in block):
            parts = [self.plain.encode(x, add_special_tokens=False).ids for x in block]
            return np.array([i for x in parts for i in x], np.uint32), np.array([len(x) for x in parts], np.int64)
        ids = np.array(self.cutting.encode(SEPARATOR.join(block), add_special_tokens=False).ids, np.uint32)
        edges = np.concatenate(([-1], np.flatnonzero(ids == self.cut), [len(ids)]))
        return ids[ids != self.cut], np.diff(edges) - 1

    def _encode_new(self) -> None:
        """Ids of the chunks met for the first time; a chunk made of known parts takes theirs."""
        new = self.codes.new
        if not new:
            return
        base = len(self.codes) - len(new)
        made_of: dict[int, list[int]] = {}
        letters: list[int] = []
        others: list[int] = []
        for at, key in enumerate(new):  # grows while it is read
            if (key[-1:] in MARKS or "\n" in key) and (parts := _parts(key)):
                made_of[at] = [self.codes[x] for x in parts]
            elif key.lstrip(FIRST).isalpha() and (key.isascii() or max(key) < "\u0100"):
                letters.append(at)
            else:
                others.append(at)
        self.codes.new = []
        # Other chunks with and without a leading blank go into blocks of their own.
        rest = sorted(others, key=lambda at: new[at][:1] == FIRST)
        ids_of = [self._letters(new[at]) for at in letters]
        found = [(np.array([i for x in ids_of for i in x], np.uint32), np.array([len(x) for x in ids_of], np.int64))]
        for at in range(0, len(rest), 1024):
            found.append(self._encode_block([new[i] for i in rest[at : at + 1024]]))
        ids = np.concatenate([self.ids, *(x for x, _ in found)])
        sizes = np.concatenate([np.empty(0, np.int64), *(x for _, x in found)])
        start = np.zeros(len(new), np.int64)
        size = np.zeros(len(new), np.int64)
        where = np.array(letters + rest, np.int64)
        start[where] = len(self.ids) + np.cumsum(sizes) - sizes
        size[where] = sizes
        old = len(self.starts) - 1
        # Chunks made of others are replaced by their parts, until none of the parts is.
        codes = base + np.arange(len(new))
        many_parts = np.ones(len(new), np.int64)
        owners = np.fromiter(made_of, np.int64, len(made_of))
        many_parts[owners] = np.fromiter(map(len, made_of.values()), np.int64, len(made_of))
        parts_of = np.fromiter((x for parts in made_of.values() for x in parts), np.int64, int(many_parts[owners].sum()))
        first_part = np.zeros(len(new), np.int64)
        first_part[owners] = np.cumsum(many_parts[owners]) - many_parts[owners]
        made = np.zeros(len(new), bool)
        made[owners] = True
        of_chunk = np.arange(len(new))
        while (split := (codes >= base) & made[np.maximum(codes - base, 0)]).any():
            many = np.where(split, many_parts[np.maximum(codes - base, 0)], 1)
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            whole, split, of_chunk = np.repeat(codes, many), np.repeat(split, many), np.repeat(of_chunk, many)
            codes = whole
            codes[split] = parts_of[first_part[whole[split] - base] + place[split]]
        counts = np.bincount(of_chunk, minlength=len(new))
        self._met(codes)
        known = codes < old
        first = np.where(known, self.starts[np.minimum(codes, old)], start[np.maximum(codes - base, 0)])
        many = np.where(known, self.starts[np.minimum(codes + 1, old)] - first, size[np.maximum(codes - base, 0)])
        ends = np.concatenate(([0], np.cumsum(many)))
        at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], many)
        self.ids = np.concatenate([self.ids, ids[at]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends[np.cumsum(counts)]])

    def _chunk_codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all chunks, and the edges of each text in them."""
        if len(self.codes) > self.known:
            self._forget()
        self.again = np.append(self.again, np.zeros(len(self.codes) - len(self.again), bool))
        texts = pc.fill_null(texts, "")
        cut = pc.split_pattern(texts, " ")
        edges = cut.offsets.to_numpy().astype(np.int64)
        edges -= edges[0]
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False)
        inner = np.fromiter(map(self.codes.__getitem__, distinct), np.int64, len(distinct))
        self._encode_new()
        self._met(inner)
        codes = inner[numbered.indices.to_numpy()]
        unsafe = pc.match_substring_regex(texts, UNSAFE).to_numpy(zero_copy_only=False)
        whole, safe = np.flatnonzero(unsafe), np.flatnonzero(~unsafe)
        first = edges[:-1]
        starting = distinct[numbered.indices.to_numpy()[first[safe]]]
        codes[first[safe]] = np.fromiter((self.codes[FIRST + x] for x in starting), np.int64, len(safe))
        self._encode_new()
        self._met(codes[first[safe]])
        if len(whole):
            codes[first[whole]] = [self._whole(x) for x in texts.take(pa.array(whole)).to_pylist()]
            lost = np.zeros(len(codes) + 1, np.int64)
            np.add.at(lost, first[whole] + 1, 1)
            np.add.at(lost, edges[1:][whole], -1)
            stay = np.cumsum(lost)[:-1] == 0
            codes = codes[stay]
            edges = np.concatenate(([0], np.cumsum(stay)))[edges]
        return codes, edges

    def _whole(self, text: str) -> int:
        """The code of a text that is encoded whole; it is not remembered by its text."""
        ids = np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.append(self.starts, self.starts[-1] + len(ids))
        code = len(self.codes)
        self.codes[code] = code
        return code

    def encode(
        self, texts: pa.Array, block_bytes: int = BLOCK_BYTES, chunks: int = 1_000_000
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts after the other: all ids, and the edges of each text in them."""
        for block in blocks(texts, block_bytes):
            codes, edges = self._chunk_codes(block)
            at = 0
            while at < len(edges) - 1:
                to = max(at + 1, int(np.searchsorted(edges, edges[at] + chunks, side="right")) - 1)
                part = codes[edges[at] : edges[to]]
                starts = self.starts[part]
                ends = np.concatenate(([0], np.cumsum(self.starts[part + 1] - starts)))
                where = np.arange(ends[-1])
                where += np.repeat(starts - ends[:-1], np.diff(ends))
                yield self.ids[where], ends[edges[at : to + 1] - edges[at]]
                at = to

    def count(self, texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> np.ndarray:
        """How many ids each text has."""
        found = [np.empty(0, np.int64)]
        for block in blocks(texts, block_bytes):
            codes, edges = self._chunk_codes(block)
            ends = np.concatenate(([0], np.cumsum(self.starts[codes + 1] - self.starts[codes])))
            found.append(np.diff(ends[edges]))
        return np.concatenate(found)


def blocks(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes of text, of one text at least."""
    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        held = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, held + size, side="right")))
        yield texts.slice(at, to - at)
        at = to


@lru_cache(maxsize=2)
def encoder(path: str, known: int = KNOWN) -> ChunkEncoder:
    """One encoder per worker process and file; a reused worker keeps what it knows."""
    return ChunkEncoder(path, known)
