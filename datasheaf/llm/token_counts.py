"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a text form a linked list; a heap holds the adjacent pairs that
are pieces of the vocabulary. The pair of lowest rank (of equal ones the
leftmost) is merged, its new neighbours are pushed, and the count is the number
of initial symbols minus the merges. No identifier is made.

Two facts, both checked against the vocabulary when it is read, keep this
cheap: no piece has the space mark after another character, so no merge crosses
the start of a word; and a character that no longer piece contains never
merges. A text is cut at both, and each distinct part is merged once while it
stays in a table of bounded size.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datasheaf.llm._common import per_row

MARK = "▁"  # what a space becomes
#: Parts remembered by a worker, in two generations: some 60 MB.
MEMORY = 1 << 18
#: More than the places of any text.
PLACES = 1 << 40
#: Longer parts are merged anew each time, so that the memory is bounded in bytes too.
MEMORY_CHARS = 64


class PieceCounter:
    """Counts of one sentencepiece BPE model with byte fallback, identity normalisation and a leading space."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        normal = [i for i in range(pieces.vocab_size()) if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))]
        by_score = sorted(normal, key=lambda i: (-pieces.get_score(i), i))
        self.rank = {pieces.id_to_piece(i): n for n, i in enumerate(by_score)}
        self.pieces = list(self.rank)
        self.known = {p for p in self.rank if len(p) == 1}
        longer = [p for p in self.rank if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError("a piece crosses the start of a word")
        lone = "".join(re.escape(c) for c in "\n\t\r|" if not any(c in p for p in longer))
        self.split = re.compile(f"{MARK}*[^{MARK}{lone}]+|[{lone}]|{MARK}+" if lone else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.memory: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def merged(self, part: str) -> int:
        """Tokens of a part: initial symbols minus merges; a symbol outside the vocabulary counts its bytes."""
        rank, pieces = self.rank.get, self.pieces
        symbols: list[str] = list(part)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry is the pair's rank, then the place of its left side
        heap = [r * PLACES + i for i, r in enumerate(map(rank, map(str.__add__, symbols, symbols[1:]))) if r is not None]
        heapify(heap)
        merges = 0
        while heap:
            r, i = divmod(heappop(heap), PLACES)
            j, pair = after[i], pieces[r]
            # stale once one of its sides has merged otherwise; what was merged away is empty
            if j >= n or symbols[i] + symbols[j] != pair or not symbols[i]:
                continue
            merges += 1
            symbols[i], symbols[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(pair + symbols[k])) is not None:
                    heappush(heap, r * PLACES + i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + pair)) is not None:
                heappush(heap, r * PLACES + h)
        alone = 0 if self.known.issuperset(part) else sum(len(c.encode()) - 1 for c in part if c not in self.rank)
        return n + alone - merges

    def count(self, text: str) -> int:
        if not text:
            return 0
        parts = self.split.findall(MARK + text.replace(" ", MARK))
        try:
            return sum(map(self.memory.__getitem__, parts))
        except KeyError:
            return sum(map(self.remembered, parts))

    def remembered(self, part: str) -> int:
        n = self.memory.get(part)
        if n is None:
            n = self.older.pop(part, None)
            if n is None:
                n = self.merged(part)
            if len(part) <= MEMORY_CHARS:
                if len(self.memory) >= MEMORY:
                    self.memory, self.older = {}, self.memory
                self.memory[part] = n
        return n


@lru_cache(maxsize=2)
def counter(model: str) -> PieceCounter:
    return PieceCounter(model)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    ``model`` is the path of a sentencepiece model, readable on every executor.
    Null and empty texts have 0 bytes and tokens. Null ids and repeated rows
    stay; other columns aren't read; an empty table gives no rows.
    """

    def counts(texts: list[bytes]) -> list[pa.Array]:
        count = counter(model).count
        return [pa.array(np.fromiter(map(len, texts), np.int64, len(texts))), pa.array(np.array([count(t.decode()) for t in texts], np.int64))]

    found = per_row(docs, [F.col(id_col).alias("doc_id")], F.col(text_col), counts, "n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
