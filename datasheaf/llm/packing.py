"""Packing by lexical retrieval.

Documents are sorted by a lexical signature and dealt in that order into shards
of bounded size, so that like texts meet. Each shard has a BM25 inverted index
over its token ids. A seed document opens a window; the index returns the unused
documents most like it, which fill the window greedily. The one that doesn't fit
is cut, and its rest opens the next window as the seed. Windows are full, but
for the last of each partition.

A document longer than a stretch is dealt as stretches that follow each other,
so a row has a bounded size, and ranges of equal numbers of rows are of like
numbers of tokens.

Shuffles: one, of the token ids as 16-bit numbers, by ranges of (signature,
document, start): one hot signature is split like any other part of the order. A
worker holds one shard at a time, whatever the size of its partition.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datasheaf.llm._common import per_row, staged
from datasheaf.llm.bpe_transducer import byte_letters

WINDOW = 1024
END = 0
#: A shard ends at either.
SHARD_DOCS, SHARD_TOKENS = 2048, 1 << 21
#: Most ids in a row of the shuffle.
STRETCH = 1 << 13
#: A partition holds about so many tokens; beyond so many partitions they grow instead.
PARTITION_TOKENS, PARTITIONS = 1 << 22, 1 << 16
QUERY_TERMS = 16
K1, B = 1.2, 0.75
PIECES = pa.schema([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


class ByteBpe:
    """The ids of a byte-level BPE tokenizer file, by an engine that takes ids for ranks; the file's merges are held against that."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, step = spec["model"]["vocab"], spec["pre_tokenizer"]
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if (step["type"], step["add_prefix_space"], step["use_regex"], spec["normalizer"]) != ("ByteLevel", False, True, None) or max([*vocab.values(), *special.values()]) >= 1 << 16:
            raise ValueError("not a plain byte-level tokenizer of 16-bit ids")
        if any(vocab[m.replace(" ", "")] != 256 + n for n, m in enumerate(merges)):
            raise ValueError("ids aren't in the order of the merges")
        byte = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        # the pattern of the byte-level pre-tokenizer
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.engine = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.special = list(special)

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.engine.encode(text, allowed_special="all")
        return self.engine.encode_ordinary(text)


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


_SHUFFLED = np.random.default_rng(1).permutation(1 << 16).astype(np.uint16)


def signature(ids: np.ndarray) -> int:
    """The three smallest, after a fixed permutation, of the document's 16 highest distinct ids, 16 bits each.

    High ids are late merges, so rare words. Texts that share most of them have
    the same signature, and its size doesn't follow the length of the text.
    """
    least = np.sort(_SHUFFLED[np.unique(ids)[-16:]])[:3].tolist()
    return sum(x << s for x, s in zip([*least, 0, 0], (32, 16, 0), strict=False))


class Shard:
    """A BM25 index over the token ids of a shard's documents, and which of them are still unused."""

    def __init__(self, docs: list[np.ndarray]) -> None:
        n = len(docs)
        found = [np.unique(d, return_counts=True) for d in docs]
        sizes = np.array([len(u) for u, _ in found])
        terms, tf = np.concatenate([u for u, _ in found]), np.concatenate([c for _, c in found])
        owner = np.repeat(np.arange(n), sizes)
        length = np.array([len(d) for d in docs], float)
        df = np.bincount(terms, minlength=1 << 16)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / length.mean()))
        order = np.argsort(terms, kind="stable")
        self.n, self.df = n, df
        self.owner, self.weight = owner[order], weight[order]
        self.at = np.concatenate(([0], np.cumsum(df)))
        self.terms, self.own_weight, self.first = terms, weight, np.concatenate(([0], np.cumsum(sizes)))
        self.unused = np.ones(n, bool)
        self.next = 0

    def take(self, doc: int) -> None:
        self.unused[doc] = False

    def like(self, seed: int) -> Iterator[int]:
        """Unused documents, most like the seed first; those that share no term last, in order."""
        a, b = self.first[seed], self.first[seed + 1]
        terms, weight = self.terms[a:b], self.own_weight[a:b] * (self.df[self.terms[a:b]] > 1)
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(-weight, QUERY_TERMS)[:QUERY_TERMS]]
        spans = [(self.at[t], self.at[t + 1]) for t in terms.tolist()]
        score = np.bincount(np.concatenate([self.owner[x:y] for x, y in spans]), np.concatenate([self.weight[x:y] for x, y in spans]), self.n) * self.unused
        top = np.argpartition(-score, 15)[:16] if self.n > 16 else np.arange(self.n)
        top = top[np.lexsort((top, -score[top]))]
        yield from (d for d in top[score[top] > 0].tolist() if self.unused[d])
        rest = np.flatnonzero((score > 0) & self.unused)
        yield from (d for d in rest[np.lexsort((rest, -score[rest]))].tolist() if self.unused[d])
        self.following()  # all before it are used
        yield from (d for d in range(self.next, self.n) if self.unused[d])

    def following(self) -> int | None:
        while self.next < self.n and not self.unused[self.next]:
            self.next += 1
        return self.next if self.next < self.n else None


class Packer:
    """Cuts documents into windows. ``first`` numbers the first sequence."""

    def __init__(self, first: int, window: int = WINDOW) -> None:
        self.sequence, self.used, self.window = first, 0, window
        self.pieces: list[tuple[int, int, int, int, int, int, int]] = []

    def put(self, key: int, ids: np.ndarray, start: int, doc_tokens: int) -> None:
        raw, n, at = memoryview(ids.astype("<u4").tobytes()), len(ids), 0
        while at < n:
            take = min(n - at, self.window - self.used)
            self.pieces.append((key, start + at, take, zlib.crc32(raw[4 * at : 4 * (at + take)]), doc_tokens, self.sequence, self.used))
            at += take
            self.used += take
            if self.used == self.window:
                self.sequence, self.used = self.sequence + 1, 0

    def shard(self, docs: list[np.ndarray], places: list[tuple[int, int]] | None = None) -> None:
        """Put all documents: each window's opener is the seed of the search that fills it. ``places`` are start and length of the document that each is a stretch of."""
        places = places or [(0, len(d)) for d in docs]
        index = Shard(docs)
        while (seed := index.following()) is not None:
            index.take(seed)
            self.put(seed, docs[seed], *places[seed])
            while self.used and seed is not None:
                opener, seed = seed, None
                for d in index.like(opener):
                    index.take(d)
                    before = self.sequence
                    self.put(d, docs[d], *places[d])
                    if self.sequence != before:  # the window is full; the rest of d opens the next
                        seed = d
                        break


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a byte-level tokenizer file readable on every
    executor. Each document is its ids and a closing 0, so null and empty texts
    have one token. Repeated rows are packed each for itself and null ids stay
    null. Other columns aren't read; an empty table gives no rows.
    """

    def tokenized(texts: list[bytes]) -> list[pa.Array]:
        encode, ids, keys = byte_bpe(tokenizer).encode, [], []
        for t in texts:
            own = array("H", encode(t.decode()))
            own.append(END)
            ids.append(own.tobytes())
            keys.append(signature(np.frombuffer(own, np.uint16)))
        return [pa.array(keys, pa.int64()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())]

    rows = per_row(docs, [F.col(id_col).alias("doc_id")], F.col(text_col), tokenized, "signature bigint, doc_tokens bigint, ids binary")
    cut = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("doc_tokens") - 1, F.lit(STRETCH).cast("bigint")), lambda x: F.struct(x.alias("start"), F.substring("ids", (2 * x + 1).cast("int"), F.lit(2 * STRETCH)).alias("ids")))
    rows = rows.select("doc_id", "signature", "doc_tokens", F.crc32("ids").alias("tie"), F.explode(cut).alias("s"))
    rows = staged(rows.select("doc_id", "signature", "tie", "doc_tokens", "s.start", "s.ids"), "tokens")
    total = rows.filter("start = 0").agg(F.sum("doc_tokens")).first()[0] or 0
    n = min(PARTITIONS, max(1, -(-total // PARTITION_TOKENS)))
    order = ["signature", "doc_id", "tie", "start"]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "start", "doc_tokens", "ids")
    schema = f"{dealt.select('doc_id')._jdf.schema().toDDL()}, " + ", ".join(f"{f.name} bigint" for f in PIECES)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 40, window)
        held_ids: list[pa.Array] = []
        docs: list[np.ndarray] = []
        places: list[tuple[int, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            packer.pieces = []
            packer.shard(docs, places)
            columns = list(zip(*packer.pieces, strict=True))
            keys = pa.concat_arrays(held_ids).take(pa.array(columns[0], pa.int64()))
            return pa.RecordBatch.from_arrays([keys, *(pa.array(c, pa.int64()) for c in columns[1:])], names=["doc_id", *PIECES.names])

        for batch in batches:
            raw, at = batch.column(3), zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for i, place in enumerate(at):
                docs.append(np.frombuffer(raw[i].as_py(), np.uint16))
                places.append(place)
                held_ids.append(batch.column(0).slice(i, 1))
                size += len(docs[-1])
                if len(docs) >= SHARD_DOCS or size >= SHARD_TOKENS:
                    yield flush()
                    held_ids, docs, places, size = [], [], [], 0
        if docs:
            yield flush()

    return dealt.mapInArrow(packed, schema)
