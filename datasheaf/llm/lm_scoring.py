"""Language-model scores by a hierarchical Pitman-Yor process.

Each context has a restaurant whose customers are the words that followed it.
A word's customers sit at tables; each table is one customer of the restaurant
that all contexts share as their parent, whose base is uniform over the known
words and one unknown. Gibbs sweeps seat the customers anew, and the predictive
probabilities of the sweeps after ``BURN_IN`` are averaged.

The context of a token is the word before it, and the end of the text before
stands for the start of a text. Every word has a restaurant of its own, whatever
the size of the corpus; score() takes a bound below which words share one.

How it is distributed. Words are dealt to buckets by ranges of their hash. A
bucket holds all that is counted of its words: their counts, their customers and
tables in every context, and their customers and tables in the parent. It also
owns the restaurants of its words. A restaurant has as many tables as customers,
but for those that the dishes of two or more customers save; so a sweep
exchanges, of the contexts that have such dishes, only the savings: each bucket
sends its part to the owner and gets the sum back. Documents are read in chunks,
which become arrays of numbers; a chunk asks each bucket once for its distinct
words and pairs (word, context). A bucket answers with the words' probabilities
in the parent, the weight their restaurants give to the parent, and the share of
each pair that is its own; the chunk puts them together. Words are told apart by
their bytes, contexts by 56 bits of hash (two words that share them would share
a restaurant). Draws depend on (bucket, sweep) alone,
so a recomputed task gives the same seating.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datasheaf.llm._common import pack, pack_steps, squeeze, staged, unpack, unpack_steps, unsqueeze

#: For least_count() alone, which score() doesn't use.
SCALE = 200
#: Contexts that aren't words.
START, RARE, FIRST_WORD = 0, 1, 2
CHUNK_TOKENS, BUCKET_TOKENS, TOKEN_BYTES = 1 << 20, 1 << 21, 6
BURN_IN, SAMPLES = 1, 3
STRENGTH = 1.0
#: Customers of a dish up to which the weights of all numbers of tables come from one table; beyond, from a series or a saddle point.
EXACT = 1024
#: Log probabilities travel as multiples of this, in 16 bits; those of whole weights as multiples of the finer one.
STEP, FINE = 1 / 2048, 1 / 4096
#: Bits of hash that tell contexts apart.
HASH_BITS = 56
END = b""  # no word is empty


def tokens(text: bytes) -> list[bytes]:
    """A-Z lower-cased words and one end."""
    words = text.lower().split()
    words.append(END)
    return words


# ---- seating ----------------------------------------------------------------


@lru_cache(maxsize=4)
def log_stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """[c, t]: log of the generalised Stirling number, the weight of all ways to seat c customers at t tables."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[0, 0] = 0.0
    for c in range(1, most + 1):
        t = np.arange(1, c + 1)
        stay = c - 1 - discount * t
        with np.errstate(divide="ignore"):
            s[c, 1 : c + 1] = np.logaddexp(s[c - 1, :c], s[c - 1, 1 : c + 1] + np.where(stay > 0, np.log(np.maximum(stay, 1e-300)), -np.inf))
    return s


def _series(c: int, most: int, discount: float) -> tuple[np.ndarray, int]:
    """Logs, but for a constant, of the generalised Stirling numbers of c customers at 1 .. most tables, and how many of them are good.

    t! d^t S(c, t) is the sum over j of (-1)^j C(t, j) Gamma(c - jd) / Gamma(-jd).
    Its terms fall quickly while t is small beside c^d. Where they cancel to
    less than six digits of the largest, the sum isn't good.
    """
    t = np.arange(1, most + 1, dtype=float)
    choose, total, largest = np.ones(most), np.zeros(most), np.zeros(most)
    with np.errstate(all="ignore"):
        for j in range(1, min(most, int((c - 1) / discount), 400) + 1):
            choose = choose * np.maximum(t - j + 1, 0) / j
            size = choose * math.exp(math.lgamma(1 + j * discount) + math.lgamma(c - j * discount) - math.lgamma(c))
            total += size * (math.sin(math.pi * j * discount) * (1 if j % 2 else -1))
            largest = np.maximum(largest, size)
            if (size <= 1e-18 * largest).all():
                break
        good = np.isfinite(total) & (total > 1e-6 * largest)
        logs = np.log(total) - np.cumsum(np.log(t)) - t * math.log(discount)
    return logs, int(most if good.all() else good.argmin())


def _rows(c: int, most: int, discount: float) -> np.ndarray:
    """The same from the recurrence, customer by customer."""
    t = np.arange(1, most + 1)
    s = np.full(most, -np.inf)
    s[0] = 0.0
    for n in range(2, c + 1):
        stay = n - 1 - discount * t
        with np.errstate(all="ignore"):
            s = np.logaddexp(np.concatenate(([-np.inf], s[:-1])), s + np.where(stay > 0, np.log(np.maximum(stay, 1e-300)), -np.inf))
    return s


def _mean_size(q: np.ndarray | float, discount: float) -> np.ndarray | float:
    """Customers at a table whose size has the generating function 1 - (1 - x)^d, tilted to x = 1 - q."""
    return discount * (1 - q) * q ** (discount - 1) / (1 - q**discount)


def _saddle(c: int, t: np.ndarray, discount: float) -> np.ndarray:
    """The same, for many tables, t < c: c! / (t! d^t) times the coefficient of x^c in (1 - (1 - x)^d)^t, at its saddle point, with the term of second order."""
    low, high = np.full(len(t), -700.0), np.full(len(t), -1e-9)  # logs of q; the mean size falls as q rises
    for _ in range(60):
        middle = (low + high) / 2
        above = _mean_size(np.exp(middle), discount) > c / t
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    q = np.exp((low + high) / 2)
    r, odds = np.log1p(-q), (1 - q) / q
    m = c / t
    h = 1 + (1 - discount) * odds - m
    k2 = m * h
    h1 = (1 - discount) * odds * (1 + odds) - k2
    k3 = k2 * h + m * h1
    k4 = k3 * h + 2 * k2 * h1 + m * ((1 - discount) * odds * (1 + odds) * (1 + 2 * odds) - k3)
    second = (k4 / (8 * k2**2) - 5 * k3**2 / (24 * k2**3)) / t
    steps = np.concatenate(([0.0], np.cumsum(np.log(t[1:]))))  # log of t! but for a constant
    return -steps - t * math.log(discount) + t * np.log1p(-(q**discount)) - c * r - 0.5 * np.log(t * k2) + second


def table_weights(c: int, opening: float, slope: float, discount: float) -> tuple[int, np.ndarray]:
    """Weights of the numbers of tables of a dish of many customers: the first number, and the weights from there to where they no longer count."""

    def weighed(first: int, logs: np.ndarray) -> tuple[np.ndarray, bool]:
        w = logs + np.concatenate(([0.0], np.cumsum(np.log(opening + slope * np.arange(first, first + len(logs) - 1)))))
        w -= w.max()
        return np.exp(w), (first == 1 or w[0] < -40) and (first + len(logs) > c or w[-1] < -40)

    most = min(64, c)
    while most <= 4096:
        logs, good = _series(c, most, discount)
        w, done = weighed(1, logs[:good]) if good else (np.zeros(0), False)
        if done:
            return 1, w
        if good < most:
            break
        most = min(2 * most, c)
    # many tables: the weights are largest where one more table changes nothing
    low, high = -700.0, -1e-9
    for _ in range(60):
        q = math.exp((low + high) / 2)
        t = c / _mean_size(q, discount)
        rising = math.log(opening + slope * t) - math.log(t) - math.log(discount) + math.log1p(-(q**discount)) > 0
        low, high = ((low + high) / 2, high) if rising else (low, (low + high) / 2)
    half = 64 + int(8 * math.sqrt(t))
    while t - half > 100 and t + half < c - 1:
        tables = np.arange(int(t) - half, int(t) + half + 1)
        w, done = weighed(int(tables[0]), _saddle(c, tables.astype(float), discount))
        if done:
            return int(tables[0]), w
        half *= 2
    most = min(1024, c)
    while True:
        w, done = weighed(1, _rows(c, most, discount))
        if done:
            return 1, w
        most = min(2 * most, c)


def seat(customers: np.ndarray, opening: np.ndarray, slope: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Draw the number of tables of each dish, given all others, from its Gibbs conditional.

    ``opening`` is (strength + discount * tables of the other dishes) times the
    parent's probability of the dish, ``slope`` discount times that probability:
    the weight of a new table is opening + slope * own tables.
    """
    tables = np.minimum(customers, 1)
    log_s = log_stirling(discount)
    # dishes of equal numbers of customers are drawn together
    few = np.flatnonzero((customers > 1) & (customers <= EXACT))
    few = few[np.argsort(customers[few], kind="stable")]
    for c, rows in zip(*_runs(customers[few], few), strict=True):
        i = np.arange(c)
        weight = log_s[c, 1 : c + 1] + np.cumsum(np.log(opening[rows, None] + slope[rows, None] * i), axis=1)
        weight = np.exp(weight - weight.max(axis=1, keepdims=True)).cumsum(axis=1)
        tables[rows] = 1 + (weight < rng.random(len(rows))[:, None] * weight[:, -1:]).sum(axis=1)
    for at in np.flatnonzero(customers > EXACT):
        first, weight = table_weights(int(customers[at]), float(opening[at]), float(slope[at]), discount)
        weight = weight.cumsum()
        tables[at] = first + int((weight < rng.random() * weight[-1]).sum())
    return tables


def _runs(values: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(values):
        return [], []
    cuts = np.flatnonzero(np.diff(values)) + 1
    return values[np.concatenate(([0], cuts))].tolist(), np.split(rows, cuts)


@dataclass
class Totals:
    """What buckets share: for each context its customers and tables, and the parent's customers and tables."""

    context_tables: np.ndarray
    customers: float
    tables: float


@dataclass
class Shape:
    """Fixed for all sweeps."""

    context_customers: np.ndarray
    vocabulary: int
    discount: float
    parent_discount: float
    totals: list[Totals] = field(default_factory=list)


class Seats:
    """The tables of a bucket's words: ``single`` contexts with one customer by word, and the pairs (word, context) with more."""

    def __init__(self, number: int, single: np.ndarray, word: np.ndarray, context: np.ndarray, customers: np.ndarray, tables: np.ndarray | None = None, parent_tables: np.ndarray | None = None) -> None:
        self.number, self.n_words = number, len(single)
        self.single, self.word, self.context, self.customers = (x.astype(np.int64) for x in (single, word, context, customers))
        self.tables = np.ones(len(word), np.int64) if tables is None else tables.astype(np.int64)
        self._feed_parent()
        self.parent_tables = np.minimum(self.parent_customers, 1) if parent_tables is None else parent_tables.astype(np.int64)

    def _feed_parent(self) -> None:
        self.parent_customers = self.single + np.bincount(self.word, self.tables, self.n_words).astype(np.int64)

    def parent(self, shape: Shape, at: Totals) -> np.ndarray:
        """The parent's predictive probability of each word."""
        base = 1 / (shape.vocabulary + 1)
        return (self.parent_customers - shape.parent_discount * self.parent_tables + (STRENGTH + shape.parent_discount * at.tables) * base) / (STRENGTH + at.customers)

    def sweep(self, number: int, shape: Shape) -> None:
        at, rng = shape.totals[number], np.random.default_rng([self.number, number])
        p, d = self.parent(shape, at)[self.word], shape.discount
        others = np.maximum(at.context_tables[self.context] - self.tables, 0)
        self.tables = seat(self.customers, (STRENGTH + d * others) * p, d * p, d, rng)
        self._feed_parent()
        base, d = 1 / (shape.vocabulary + 1), shape.parent_discount
        others = np.maximum(at.tables - self.parent_tables, 0)
        self.parent_tables = seat(self.parent_customers, (STRENGTH + d * others) * base, np.full(self.n_words, d * base), d, rng)


class Bucket:
    """All pairs of a bucket, sorted by word, and their seats."""

    def __init__(self, number: int, pair_context: np.ndarray, pair_customers: np.ndarray, per_word: np.ndarray) -> None:
        self.context, self.customers = pair_context.astype(np.int64), pair_customers.astype(np.int64)
        self.word, self.n_words = np.repeat(np.arange(len(per_word)), per_word), len(per_word)
        self.several = np.flatnonzero(self.customers > 1)
        single = np.bincount(self.word[self.customers == 1], minlength=self.n_words)
        self.seats = Seats(number, single, self.word[self.several], self.context[self.several], self.customers[self.several])

    def tables(self) -> np.ndarray:
        found = np.minimum(self.customers, 1)
        found[self.several] = self.seats.tables
        return found

    def predictive(self, shape: Shape, at: Totals) -> np.ndarray:
        """Probability of each pair's word after its context."""
        c, t = shape.context_customers[self.context], at.context_tables[self.context]
        own = np.maximum(self.customers - shape.discount * self.tables(), 0)
        return (own + (STRENGTH + shape.discount * t) * self.seats.parent(shape, at)[self.word]) / (STRENGTH + c)


# ---- chunks -----------------------------------------------------------------


def least_count(n_bytes: int) -> int:
    """A bound for score() that leaves SCALE * sqrt(n_bytes) restaurants at most, far fewer as words are distributed."""
    return max(2, math.ceil(math.sqrt(n_bytes) / SCALE))


def context_words(rows: DataFrame, least: int) -> tuple[list[bytes], int]:
    """The words that training texts hold at least so often, and the number of training tokens. Every word of every text is counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        total = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([None, *counts], pa.binary()), pa.array([total, *counts.values()], pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = tokens(text)
                total += len(words)
                words.pop()  # the end is no context
                counts.update(words)
                if len(counts) >= CHUNK_TOKENS // 2:
                    yield flush()
                    total = 0
                    counts.clear()
        if total:
            yield flush()

    counts = rows.filter(~F.col("held_out")).select("body").mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = sorted(((-r["n"], r["word"] and bytes(r["word"])) for r in counts.filter(F.col("word").isNull() | (F.col("n") >= least)).collect()), key=lambda x: (x[0], x[1] or b""))
    return [w for _, w in found if w is not None], sum(-n for n, w in found if w is None)


def _deltas(rising: np.ndarray) -> bytes:
    return np.diff(rising, prepend=0).astype("<u4").tobytes()


def _undo(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4").astype(np.int64))


ASKED = "words binary, per_word binary, contexts binary, customers binary"


def chunked(rows: DataFrame, contexts: list[bytes], n_buckets: int) -> DataFrame:
    """Rows of documents (bucket null): their pairs in the chunk; and of buckets: the chunk's distinct words and pairs with their training counts."""
    key = rows.select("doc_id")
    key_type = key.schema[0].dataType
    schema = f"chunk bigint, bucket int, {key._jdf.schema().toDDL()}, held_out boolean, n_tokens bigint, pairs binary, {ASKED}"
    context_of = {w: FIRST_WORD + i for i, w in enumerate(contexts)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        keys_type = to_arrow_type(key_type)
        chunk = TaskContext.get().partitionId() << 32
        local: dict[bytes, int] = {}
        ids: list[np.ndarray] = []
        keys: list = []
        held: list[bool] = []
        size = 0

        def flush() -> pa.RecordBatch:
            found = list(local)
            buckets = np.fromiter((zlib.crc32(w) % n_buckets for w in found), np.int64, len(found))
            order = np.array(sorted(range(len(found)), key=lambda i: (buckets[i], found[i])))
            rank = np.empty(len(found), np.int64)
            rank[order] = np.arange(len(found))
            before = np.fromiter((context_of.get(w, RARE) for w in found), np.int64, len(found))
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.concatenate(ids)
            context = np.empty(len(flat), np.int64)
            context[1:] = before[flat[:-1]]
            context[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = START
            pairs, at = np.unique((rank[flat] << 32) | context, return_inverse=True)
            training = ~np.repeat(np.array(held), lengths)
            customers = np.bincount(at[training], minlength=len(pairs))
            per_word = np.bincount(pairs >> 32, minlength=len(found))
            n, out = len(ids), {k: [] for k in ("bucket", "words", "per_word", "contexts", "customers")}
            edges = np.concatenate(([0], np.cumsum(per_word)))
            bounds = np.flatnonzero(np.diff(buckets[order], prepend=-1))
            for a, b in zip(bounds, [*bounds[1:], len(found)], strict=True):
                x, y = edges[a], edges[b]
                out["bucket"].append(int(buckets[order[a]]))
                out["words"].append(b"\n".join(found[i] for i in order[a:b]))
                out["per_word"].append(per_word[a:b].astype("<u4").tobytes())
                out["contexts"].append((pairs[x:y] & 0xFFFFFFFF).astype("<u4").tobytes())
                out["customers"].append(customers[x:y].astype("<u4").tobytes())
            m = len(out["bucket"])
            refs = [_deltas(np.sort(x)) for x in np.split(at, np.cumsum(lengths)[:-1])]
            arrays = [
                pa.array([chunk] * (n + m), pa.int64()),
                pa.array([None] * n + out["bucket"], pa.int32()),
                pa.array(keys + [None] * m, keys_type),
                pa.array(held + [None] * m, pa.bool_()),
                pa.array(lengths.tolist() + [None] * m, pa.int64()),
                pa.array(refs + [None] * m, pa.binary()),
                *(pa.array([None] * n + out[k], pa.binary()) for k in ("words", "per_word", "contexts", "customers")),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", "bucket", "doc_id", "held_out", "n_tokens", "pairs", "words", "per_word", "contexts", "customers"])

        for batch in batches:
            for k, h, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = tokens(text)
                number = local.setdefault
                ids.append(np.array([number(w, len(local)) for w in words], np.int32))
                keys.append(k)
                held.append(h)
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield flush()
                    chunk, size = chunk + 1, 0
                    local, ids, keys, held = {}, [], [], []
        if ids:
            yield flush()

    return rows.select("doc_id", "held_out", "body").mapInArrow(run, schema)


# ---- buckets ----------------------------------------------------------------


STATE = "bucket int, contexts binary, customers binary, per_word binary, chunks array<bigint>, asked_words array<binary>, asked_pairs array<binary>, asked_per_word array<binary>"


def merge_bucket(asked: pa.Table) -> pa.Table:
    """Sum the chunks' counts of one bucket; keep where each chunk's words and pairs are among the bucket's."""
    asked = asked.sort_by("chunk")
    column = {n: asked.column(n).to_pylist() for n in ("chunk", "words", "per_word", "contexts", "customers")}
    lists = [w.split(b"\n") for w in column["words"]]
    ordered = sorted(set().union(*lists))
    place = {w: i for i, w in enumerate(ordered)}
    words = [np.fromiter(map(place.__getitem__, x), np.int64, len(x)) for x in lists]
    per_word = [np.frombuffer(x, "<u4") for x in column["per_word"]]
    keys = [(np.repeat(w, n) << 32) | np.frombuffer(c, "<u4") for w, n, c in zip(words, per_word, column["contexts"], strict=True)]
    pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
    customers = np.bincount(at, np.concatenate([np.frombuffer(x, "<u4") for x in column["customers"]]), len(pairs))
    spots = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
    row = {
        "bucket": [asked.column("bucket")[0].as_py()],
        "contexts": [(pairs & 0xFFFFFFFF).astype("<u4").tobytes()],
        "customers": [customers.astype("<u8").tobytes()],
        "per_word": [np.bincount(pairs >> 32, minlength=len(ordered)).astype("<u4").tobytes()],
        "chunks": [column["chunk"]],
        "asked_words": [[_deltas(w) for w in words]],
        "asked_pairs": [[_deltas(s) for s in spots]],
        "asked_per_word": [column["per_word"]],
    }
    return pa.table(row, schema=pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in ("contexts", "customers", "per_word")), ("chunks", pa.list_(pa.int64())), *((n, pa.list_(pa.binary())) for n in ("asked_words", "asked_pairs", "asked_per_word"))]))


def _bucket(row: dict) -> Bucket:
    return Bucket(row["bucket"], np.frombuffer(row["contexts"], "<u4"), np.frombuffer(row["customers"], "<u8"), np.frombuffer(row["per_word"], "<u4"))


SEATS = {"single": "<u4", "word": "<u4", "context": "<u4", "customers": "<u8", "tables": "<u8", "parent_tables": "<u8"}


def _packed(seats: Seats) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([seats.number], pa.int32()), *(pa.array([getattr(seats, k).astype(t).tobytes()], pa.binary()) for k, t in SEATS.items())], names=["bucket", *SEATS])


def _seats(row: dict) -> Seats:
    return Seats(row["bucket"], *(np.frombuffer(row[k], t) for k, t in SEATS.items()))


def seated(rows: DataFrame, sweep: int | None = None, shape: Shape | None = None) -> DataFrame:
    """The seats of the buckets: the first ones, or after one more sweep. Written, so no sweep is done twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if shape is None:
                    yield _packed(_bucket(row).seats)
                else:
                    seats = _seats(row)
                    seats.sweep(sweep, shape)
                    yield _packed(seats)

    needed = rows.select("bucket", "contexts", "customers", "per_word") if shape is None else rows
    return staged(needed.mapInArrow(run, "bucket int, " + ", ".join(f"{k} binary" for k in SEATS)), "seats")


def _sums(rows: DataFrame, figures: Callable[[dict], tuple[dict[str, np.ndarray], dict[str, float]]], n_contexts: int) -> tuple[dict[str, np.ndarray], Counter]:
    """Totals over all buckets of the figures by context, and of the single ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[str, np.ndarray] = {}
        one: Counter[str] = Counter()
        for batch in batches:
            for row in batch.to_pylist():
                more, single = figures(row)
                for k, v in more.items():
                    by[k] = by.get(k, 0) + v
                one.update(single)
        for k, v in by.items():
            some = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(v[some].astype(float), pa.float64())], names=["name", "place", "value"])
        yield pa.RecordBatch.from_arrays([pa.array(list(one), pa.string()), pa.array([-1] * len(one), pa.int64()), pa.array([float(v) for v in one.values()], pa.float64())], names=["name", "place", "value"])

    summed: dict[str, np.ndarray] = {}
    one: Counter[str] = Counter()
    for name, place, value in rows.mapInArrow(run, "name string, place bigint, value double").groupBy("name", "place").agg(F.sum("value").alias("value")).collect():
        if place < 0:
            one[name] = value
        else:
            summed.setdefault(name, np.zeros(n_contexts))[place] = value
    return summed, one


def _discount(once: float, twice: float) -> float:
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def fit(state: DataFrame, n_contexts: int, sweeps: int) -> tuple[Shape, int]:
    """The totals before each sweep and after the last, and the number of training tokens."""

    def counted(row: dict) -> tuple[dict[str, np.ndarray], dict[str, float]]:
        b = _bucket(row)
        by = {"customers": np.bincount(b.context, b.customers, n_contexts), "single": np.bincount(b.context, b.customers == 1, n_contexts)}
        parents = b.seats.parent_customers
        one = {"tokens": int(b.customers.sum()), "words": int((parents > 0).sum())}
        return by, one | {f"pairs_{k}": int((b.customers == k).sum()) for k in (1, 2)} | {f"words_{k}": int((parents == k).sum()) for k in (1, 2)}

    def tables(row: dict) -> tuple[dict[str, np.ndarray], dict[str, float]]:
        seats = _seats(row)
        return {"tables": np.bincount(seats.context, seats.tables, n_contexts)}, {"customers": int(seats.parent_customers.sum()), "tables": int(seats.parent_tables.sum())}

    by, one = _sums(state.select("bucket", "contexts", "customers", "per_word"), counted, n_contexts)
    none = np.zeros(n_contexts)
    shape = Shape(by.get("customers", none), int(one["words"]), _discount(one["pairs_1"], one["pairs_2"]), _discount(one["words_1"], one["words_2"]))
    seats = seated(state)
    for n in range(sweeps + 1):
        more, at = _sums(seats, tables, n_contexts)
        shape.totals.append(Totals(by.get("single", none) + more.get("tables", none), at["customers"], at["tables"]))
        if n < sweeps:
            seats = seated(seats, n, shape)
    return shape, int(one["tokens"])


ANSWER = "chunk bigint, bucket int, counts binary, per_word binary, logs binary"


def answers(state: DataFrame, shape: Shape, burn_in: int) -> DataFrame:
    """For each chunk and bucket: its words' training counts, and its pairs' averaged log probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = _bucket(row)
                p, n = np.zeros(len(b.context)), 0
                for i in range(len(shape.totals) - 1):
                    b.seats.sweep(i, shape)
                    if i >= burn_in:
                        p, n = p + b.predictive(shape, shape.totals[i + 1]), n + 1
                logs = np.clip(np.round(-np.log10(p / max(n, 1)) / STEP), 0, 65535).astype("<u2")
                counts = np.bincount(b.word, b.customers, b.n_words).astype("<u8")
                for chunk, words, pairs, per_word in zip(row["chunks"], row["asked_words"], row["asked_pairs"], row["asked_per_word"], strict=True):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk], pa.int64()), pa.array([row["bucket"]], pa.int32()), *(pa.array([x], pa.binary()) for x in (counts[_undo(words)].tobytes(), per_word, logs[_undo(pairs)].tobytes()))],
                        names=["chunk", "bucket", "counts", "per_word", "logs"],
                    )

    return state.mapInArrow(run, ANSWER)


def _score_listed(rows: DataFrame, least: int, burn_in: int, samples: int) -> DataFrame:
    contexts, n_train = context_words(rows, least)
    n_contexts = FIRST_WORD + len(contexts)
    n_buckets = max(1, -(-n_train // BUCKET_TOKENS))
    chunks = staged(chunked(rows, contexts, n_buckets), "chunks")
    asked = chunks.filter(F.col("bucket").isNotNull()).select("chunk", "bucket", "words", "per_word", "contexts", "customers")
    state = staged(asked.groupBy("bucket").applyInArrow(merge_bucket, STATE), "buckets")
    shape, n_train = fit(state, n_contexts, burn_in + samples)
    base = float(np.log10(n_train + shape.vocabulary + 1))

    own = chunks.filter(F.col("bucket").isNull()).select("chunk", "bucket", "doc_id", "held_out", "n_tokens", "pairs")
    both = own.unionByName(answers(state, shape, burn_in), allowMissingColumns=True)
    schema = f"{own.select('doc_id')._jdf.schema().toDDL()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"

    def of_chunk(table: pa.Table) -> pa.Table:
        asked = table.filter(pa.compute.is_valid(table.column("bucket"))).sort_by("bucket")
        own = table.filter(pa.compute.is_null(table.column("bucket")))
        got = {n: [bytes(x) for x in asked.column(n).to_pylist()] for n in ("counts", "per_word", "logs")}
        per_word = np.frombuffer(b"".join(got["per_word"]), "<u4")
        counts = np.repeat(np.frombuffer(b"".join(got["counts"]), "<u8"), per_word)
        logs, plus_one, known = np.frombuffer(b"".join(got["logs"]), "<u2").astype(float) * -STEP, np.log10(counts + 1.0), counts > 0
        out = []
        for raw in own.column("pairs").to_pylist():
            at = _undo(raw)
            total = float(logs[at].sum())
            out.append((int(known[at].sum()), n_train, float(plus_one[at].sum()) - base * len(at), total, 10 ** min(300.0, -total / len(at))))
        columns = list(zip(*out, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        return pa.table([*(own.column(n) for n in ("doc_id", "held_out", "n_tokens")), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return both.groupBy("chunk").applyInArrow(of_chunk, schema)


# ---- every word a context ---------------------------------------------------


def _hashed(words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words in the order of their hashes, these, and the order."""
    hashes = (np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    if (hashes[order][1:] == hashes[order][:-1]).any():
        order = np.array(sorted(range(len(words)), key=lambda i: (hashes[i], words[i])))
    return [words[i] for i in order.tolist()], hashes[order], order


def _owner(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each hash; it rises with the hash."""
    return (hashes >> HASH_BITS - 32) * n_buckets >> 32


def _dealt(rows: DataFrame, by: str, n_buckets: int):
    """Grouped, in a fixed number of tasks: packed arrays are small, so AQE would put too many buckets in one."""
    return rows.repartition(2 * n_buckets, by).groupBy(by)


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    return pa.Table.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in schema.split(", "))]))


def _before(flat: np.ndarray) -> np.ndarray:
    """The context of each token: the one before it, and the end of a text, which is the last token too, before a text."""
    return np.roll(flat, 1)


def _pairs(flat: np.ndarray, n_words: int) -> np.ndarray:
    """(word, context) of each token as one number."""
    return flat * n_words + _before(flat)


def numbered(rows: DataFrame) -> DataFrame:
    """For each chunk: a row for each document, with its place, and one (place null) with the chunk's distinct words in the order of their hashes, all tokens as numbers of these, and the tokens of each document, twice that and one more if it trains."""
    key = rows.select("doc_id")
    key_type = key.schema[0].dataType
    schema = f"chunk bigint, place bigint, {key._jdf.schema().toDDL()}, held_out boolean, n_tokens bigint, words binary, tokens binary, lengths binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        names = ["chunk", "place", "doc_id", "held_out", "n_tokens", "words", "tokens", "lengths"]
        kinds = [pa.int64(), pa.int64(), to_arrow_type(key_type), pa.bool_(), pa.int64(), *[pa.binary()] * 3]
        chunk = TaskContext.get().partitionId() << 32
        local: dict[bytes, int] = {}
        ids: list[np.ndarray] = []
        keys: list = []
        held: list[bool] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            words, _, order = _hashed(list(local))
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            lengths, n = np.fromiter(map(len, ids), np.int64, len(ids)), len(ids)
            whole = squeeze(b"\n".join(words)), pack(rank[np.concatenate(ids)]), pack(lengths << 1 | ~np.array(held))
            for row in (([chunk] * n, range(n), keys, held, lengths, *[[None] * n] * 3), ([chunk], [None], [None], [None], [None], *([x] for x in whole))):
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for k, h, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = tokens(text)
                number = local.setdefault
                ids.append(np.array([number(w, len(local)) for w in words], np.int32))
                keys.append(k)
                held.append(h)
                size += len(words)
                if size >= CHUNK_TOKENS:
                    yield from flush()
                    chunk, size = chunk + 1, 0
                    local, ids, keys, held = {}, [], [], []
        if ids:
            yield from flush()

    return rows.select("doc_id", "held_out", "body").mapInArrow(run, schema)


def asked_by(chunks: DataFrame, n_buckets: int) -> DataFrame:
    """What each chunk asks of each bucket: its distinct words and pairs, with their training counts."""
    schema = f"chunk bigint, bucket int, {ASKED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, hashes, _ = _hashed(unsqueeze(row["words"]).split(b"\n"))
                flat, lengths, n_words = unpack(row["tokens"]), unpack(row["lengths"]), len(words)
                pairs = _pairs(flat, n_words) << 1 | np.repeat(lengths & 1, lengths >> 1)
                pairs.sort()
                training, pairs = pairs & 1, pairs >> 1
                first = np.flatnonzero(np.diff(pairs, prepend=-1))
                customers = np.add.reduceat(training, first)
                word, context = np.divmod(pairs[first], n_words)
                per_word = np.bincount(word, minlength=n_words)
                owners, edges = _owner(hashes, n_buckets), np.concatenate(([0], np.cumsum(per_word)))
                bounds = np.flatnonzero(np.diff(owners, prepend=-1)).tolist()
                for a, b in zip(bounds, [*bounds[1:], n_words], strict=True):
                    x, y = edges[a], edges[b]
                    asked = {"words": squeeze(b"\n".join(words[a:b])), "per_word": pack(per_word[a:b]), "contexts": pack_steps(hashes[context[x:y]]), "customers": pack(customers[x:y])}
                    yield from _table([{"chunk": row["chunk"], "bucket": int(owners[a])} | asked], schema).to_batches()

    return chunks.filter("place is null").select("chunk", "words", "tokens", "lengths").mapInArrow(run, schema)


FIGURES = ("tokens", "vocabulary", "pairs_1", "pairs_2", "words_1", "words_2")
MERGED = "bucket int, " + ", ".join(f"{x} bigint" for x in FIGURES) + ", counts binary, hashes binary, per_word binary, customers binary, needed binary, context binary, chunks array<bigint>, asked_words array<binary>, asked_pairs array<binary>"


def merge_asked(asked: pa.Table) -> pa.Table:
    """Sum the chunks' counts of one bucket; keep where each chunk's words and pairs are among the bucket's, and the contexts of dishes of two or more."""
    asked = asked.sort_by("chunk")
    column = {n: asked.column(n).to_pylist() for n in ("words", "per_word", "contexts", "customers")}
    lists = [unsqueeze(w).split(b"\n") for w in column["words"]]
    ordered, hashes, _ = _hashed(list(set().union(*lists)))
    place = {w: i for i, w in enumerate(ordered)}
    words = [np.fromiter(map(place.__getitem__, x), np.int64, len(x)) for x in lists]
    del lists, place
    contexts, at = np.unique(np.concatenate([unpack_steps(x) for x in column["contexts"]]), return_inverse=True)
    keys = [np.repeat(w, unpack(n)) for w, n in zip(words, column["per_word"], strict=True)]
    pairs, at = np.unique(np.concatenate(keys) << 32 | at, return_inverse=True)
    customers = np.bincount(at, np.concatenate([unpack(x) for x in column["customers"]]), len(pairs)).astype(np.int64)
    spots = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
    word, several = pairs >> 32, customers > 1
    used, context = np.unique(pairs[several] & 0xFFFFFFFF, return_inverse=True)
    counts, parents = (np.bincount(word, x, len(ordered)).astype(np.int64) for x in (customers, customers > 0))
    row = {"bucket": asked.column("bucket")[0].as_py(), "tokens": int(counts.sum()), "vocabulary": int((counts > 0).sum())}
    row |= {f"{n}_{k}": int((x == k).sum()) for n, x in (("pairs", customers), ("words", parents)) for k in (1, 2)}
    row |= {"counts": pack(counts), "hashes": pack_steps(hashes), "per_word": pack(np.bincount(word, minlength=len(ordered))), "customers": pack(customers), "needed": pack_steps(contexts[used]), "context": pack_steps(context)}
    row |= {"chunks": asked.column("chunk").to_pylist(), "asked_words": [pack_steps(w) for w in words], "asked_pairs": [pack_steps(s) for s in spots]}
    return _table([row], MERGED)


def _by_hash(hashes: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Sums of the values by hash, for each wanted hash, all of which occur."""
    distinct, at = np.unique(hashes, return_inverse=True)
    return np.bincount(at, values, len(distinct)).astype(np.int64)[np.searchsorted(distinct, wanted)]


OWNED = "bucket int, sender int, kind string, place binary, held binary, hashes binary"


def owned(state: DataFrame, n_buckets: int) -> DataFrame:
    """Each bucket asks the owners for the contexts it needs. Rows to it from each owner: their places there and numbers of customers; and to the owner itself (kind owned) the hashes of its places."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                needed = unpack_steps(row["needed"])
                out = [{"bucket": row["bucket"], "sender": -1, "hashes": row["hashes"], "counts": row["counts"]}]
                owners = _owner(needed, n_buckets)
                for part in np.split(np.arange(len(needed)), np.flatnonzero(np.diff(owners)) + 1) if len(needed) else []:
                    out.append({"bucket": int(owners[part[0]]), "sender": row["bucket"], "hashes": pack_steps(needed[part])})
                yield from _table(out, "bucket int, sender int, hashes binary, counts binary").to_batches()

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["sender"] < 0)
        asked = [(r["sender"], unpack_steps(r["hashes"])) for r in rows if r["sender"] >= 0]
        places = np.unique(np.concatenate([np.zeros(0, np.int64), *(x for _, x in asked)]))
        held = _by_hash(unpack_steps(own["hashes"]), unpack(own["counts"]), places)
        out = [{"bucket": own["bucket"], "sender": -1, "kind": "owned", "hashes": pack_steps(places)}]
        for sender, x in asked:
            at = np.searchsorted(places, x)
            out.append({"bucket": sender, "sender": own["bucket"], "kind": "reply", "place": pack_steps(at), "held": pack(held[at])})
        return _table(out, OWNED)

    asked = state.select("bucket", "hashes", "counts", "needed").mapInArrow(ask, "bucket int, sender int, hashes binary, counts binary")
    return staged(_dealt(asked, "bucket", n_buckets).applyInArrow(answer, OWNED), "owned")


#: What a bucket carries from sweep to sweep, and what it sends to owners (kind saved): places, and customers less tables in them.
CARRIED = ("single", "word", "context", "customers", "tables", "parent_tables", "owners", "lengths", "places", "held")
POST = "bucket int, sender int, kind string, parent_customers_sum bigint, parent_tables_sum bigint, place binary, saved binary, " + ", ".join(f"{x} binary" for x in CARRIED)


def _posted(seats: Seats, owners: np.ndarray, lengths: np.ndarray, places: np.ndarray, held: np.ndarray) -> pa.Table:
    saved = np.bincount(seats.context, seats.customers - seats.tables, len(places)).astype(np.int64)
    fields = {n: pack(getattr(seats, n)) for n in ("single", "customers", "tables", "parent_tables")}
    fields |= {n: pack_steps(getattr(seats, n)) for n in ("word", "context")} | {"owners": pack(owners), "lengths": pack(lengths), "places": pack_steps(places), "held": pack(held)}
    out = [{"bucket": seats.number, "kind": "seats", "parent_customers_sum": int(seats.parent_customers.sum()), "parent_tables_sum": int(seats.parent_tables.sum())} | fields]
    at = 0
    for owner, n in zip(owners.tolist(), lengths.tolist(), strict=True):
        out.append({"bucket": owner, "sender": seats.number, "kind": "saved", "place": pack_steps(places[at : at + n]), "saved": pack(saved[at : at + n])})
        at += n
    return _table(out, POST)


def first_seats(state: DataFrame, replies: DataFrame, n_buckets: int) -> DataFrame:
    """The seats before the first sweep: one table for each dish."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        row = next(r for r in rows if r["kind"] is None)
        found = sorted((r for r in rows if r["kind"] == "reply"), key=lambda r: r["sender"])
        customers, per_word = unpack(row["customers"]), unpack(row["per_word"])
        word = np.repeat(np.arange(len(per_word)), per_word)
        seats = Seats(row["bucket"], np.bincount(word[customers == 1], minlength=len(per_word)), word[customers > 1], unpack_steps(row["context"]), customers[customers > 1])
        places, held = ([f(r[n]) for r in found] for n, f in (("place", unpack_steps), ("held", unpack)))
        none = [np.zeros(0, np.int64)]
        return _posted(seats, np.array([r["sender"] for r in found], np.int64), np.array([len(x) for x in places], np.int64), np.concatenate(none + places), np.concatenate(none + held))

    both = state.select("bucket", "per_word", "customers", "context").unionByName(replies.filter("kind = 'reply'").drop("hashes"), allowMissingColumns=True)
    return staged(_dealt(both, "bucket", n_buckets).applyInArrow(run, POST), "seats")


SUMS = "bucket int, sender int, kind string, saved binary"


def saved_sums(post: DataFrame, n_buckets: int) -> DataFrame:
    """What each owner's restaurants save in all buckets: back to each sender, and to the owner itself (kind owned)."""

    def run(table: pa.Table) -> pa.Table:
        rows = [(r["bucket"], r["sender"], unpack_steps(r["place"]), unpack(r["saved"])) for r in table.to_pylist()]
        total = np.bincount(np.concatenate([p for _, _, p, _ in rows]), np.concatenate([s for _, _, _, s in rows])).astype(np.int64)
        out = [{"bucket": rows[0][0], "kind": "owned", "saved": pack(total)}]
        return _table(out + [{"bucket": sender, "sender": bucket, "kind": "sum", "saved": pack(total[p])} for bucket, sender, p, _ in rows], SUMS)

    return staged(_dealt(post.filter("kind = 'saved'").select("bucket", "sender", "place", "saved"), "bucket", n_buckets).applyInArrow(run, SUMS), "saved")


def swept(post: DataFrame, sums: DataFrame, number: int, shape: Shape, at: tuple[float, float], n_buckets: int) -> DataFrame:
    """The seats after one more sweep."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        row = next(r for r in rows if r["kind"] == "seats")
        saved = [unpack(r["saved"]) for r in sorted((r for r in rows if r["kind"] == "sum"), key=lambda r: r["sender"])]
        owners, lengths, held = (unpack(row[n]) for n in ("owners", "lengths", "held"))
        seats = Seats(row["bucket"], unpack(row["single"]), *(unpack_steps(row[n]) for n in ("word", "context")), *(unpack(row[n]) for n in ("customers", "tables", "parent_tables")))
        totals = Totals(held - np.concatenate([np.zeros(0, np.int64), *saved]), *at)
        seats.sweep(number, Shape(held, shape.vocabulary, shape.discount, shape.parent_discount, [totals] * (number + 1)))
        return _posted(seats, owners, lengths, unpack_steps(row["places"]), held)

    both = post.filter("kind = 'seats'").select("bucket", "sender", "kind", *CARRIED).unionByName(sums.filter("kind = 'sum'"), allowMissingColumns=True)
    return staged(_dealt(both, "bucket", n_buckets).applyInArrow(run, POST), "seats")


def _logs(p: np.ndarray) -> bytes:
    return pack(np.clip(np.round(-np.log10(p) / FINE), 0, 65535))


ANSWERED = "chunk bigint, bucket int, counts binary, sharing binary, parents array<binary>, backs array<binary>, own binary"


def answered(parts: DataFrame, shape: Shape, at: dict[int, tuple[float, float]], n_buckets: int) -> DataFrame:
    """For each chunk and bucket: its words' training counts, and those of others that share their hash; in each sampled sweep their probability in the parent, and the weight of the parent in their own restaurants; and the mean over the sweeps of the customers of its pairs less the discounts."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        row = next(r for r in rows if r["kind"] is None)
        counts, customers, per_word, hashes = unpack(row["counts"]), unpack(row["customers"]), unpack(row["per_word"]), unpack_steps(row["hashes"])
        several, word = customers > 1, np.repeat(np.arange(len(per_word)), per_word)
        single = np.bincount(word[customers == 1], minlength=len(per_word))
        held = _by_hash(hashes, counts, hashes)
        places = unpack_steps(next(r for r in rows if r["kind"] == "places")["hashes"])
        tables, parents, backs = np.zeros(int(several.sum())), [], []
        for sweep, (c, t) in at.items():
            of = next(r for r in rows if r["kind"] == "seats" and r["sender"] == sweep)
            now = Seats(row["bucket"], single, word[several], unpack_steps(row["context"]), customers[several], unpack(of["tables"]), unpack(of["parent_tables"]))
            tables += now.tables
            parents.append(now.parent(shape, Totals(None, c, t)))
            kept = held.copy()
            for r in (r for r in rows if r["kind"] == "owned" and r["sender"] == sweep):
                near = np.minimum(np.searchsorted(places, hashes), len(places) - 1)
                kept -= np.where(places[near] == hashes, unpack(r["saved"])[near], 0)
            backs.append((STRENGTH + shape.discount * kept) / (STRENGTH + held))
        own = (customers == 1) * (1 - shape.discount)
        own[several] = customers[several] - shape.discount * tables / len(at)
        # log10(own) is over -2 and under 13
        own = np.where(own > 0, np.round((np.log10(np.maximum(own, 0.01)) + 2) / FINE) + 1, 0)
        out = []
        for chunk, words, pairs in zip(row["chunks"], row["asked_words"], row["asked_pairs"], strict=True):
            w = unpack_steps(words)
            out.append({"chunk": chunk, "bucket": row["bucket"], "counts": pack(counts[w]), "sharing": pack((held - counts)[w]), "parents": [_logs(p[w]) for p in parents], "backs": [_logs(b[w]) for b in backs], "own": pack(own[unpack_steps(pairs)])})
        return _table(out, ANSWERED)

    return _dealt(parts, "bucket", n_buckets).applyInArrow(run, ANSWERED)


def _score_every(rows: DataFrame, burn_in: int, samples: int) -> DataFrame:
    if samples < 1:
        raise ValueError("at least one sweep must be sampled")
    n_bytes = rows.filter(~F.col("held_out")).agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_buckets = max(1, -(-n_bytes // (TOKEN_BYTES * BUCKET_TOKENS)))
    chunks = staged(numbered(rows), "chunks")
    state = staged(_dealt(asked_by(chunks, n_buckets), "bucket", n_buckets).applyInArrow(merge_asked, MERGED), "buckets")
    one = {n: v or 0 for n, v in state.agg(*(F.sum(n).alias(n) for n in FIGURES)).first().asDict().items()}
    n_train = one["tokens"]
    shape = Shape(np.zeros(0), one["vocabulary"], _discount(one["pairs_1"], one["pairs_2"]), _discount(one["words_1"], one["words_2"]))

    def sums_of(post: DataFrame) -> tuple[float, float]:
        found = post.filter("kind = 'seats'").agg(F.sum("parent_customers_sum"), F.sum("parent_tables_sum")).first()
        return found[0] or 0, found[1] or 0

    places = owned(state, n_buckets)
    post = first_seats(state, places, n_buckets)
    parts = state.select("bucket", "counts", "hashes", "per_word", "customers", "context", "chunks", "asked_words", "asked_pairs", F.lit(None).cast("string").alias("kind"), F.lit(None).cast("int").alias("sender"))
    parts = parts.unionByName(places.filter("kind = 'owned'").select("bucket", "hashes", F.lit("places").alias("kind")), allowMissingColumns=True)
    sums, at, sampled = saved_sums(post, n_buckets), sums_of(post), {}
    for n in range(burn_in + samples):
        post = swept(post, sums, n, shape, at, n_buckets)
        sums, at = saved_sums(post, n_buckets), sums_of(post)
        if n >= burn_in:
            sampled[n] = at
            parts = parts.unionByName(post.filter("kind = 'seats'").select("bucket", "kind", F.lit(n).alias("sender"), "tables", "parent_tables"), allowMissingColumns=True)
            parts = parts.unionByName(sums.filter("kind = 'owned'").select("bucket", "kind", F.lit(n).alias("sender"), "saved"), allowMissingColumns=True)

    base = float(np.log10(n_train + shape.vocabulary + 1))
    own = chunks.select("chunk", "place", "doc_id", "held_out", "n_tokens", "tokens")
    both = own.unionByName(answered(parts, shape, sampled, n_buckets), allowMissingColumns=True)
    schema = f"{own.select('doc_id')._jdf.schema().toDDL()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"

    def of_chunk(table: pa.Table) -> pa.Table:
        docs = table.filter(pa.compute.is_valid(table.column("place"))).sort_by("place")
        flat = unpack(next(x for x in table.column("tokens").to_pylist() if x is not None))
        got = table.filter(pa.compute.is_valid(table.column("bucket"))).sort_by("bucket").drop_columns(["doc_id", "tokens"]).to_pylist()
        counts, held = (np.concatenate([unpack(r[n]) for r in got]) for n in ("counts", "sharing"))
        held, before = held + counts, _before(flat)
        own = np.concatenate([unpack(r["own"]) for r in got])
        own = np.where(own > 0, 10 ** ((own - 1) * FINE - 2), 0)[np.unique(_pairs(flat, len(counts)), return_inverse=True)[1]]
        p = own / (STRENGTH + held[before])
        for i in range(samples):
            parent, back = (10 ** (np.concatenate([unpack(r[n][i]) for r in got]) * -FINE) for n in ("parents", "backs"))
            p += back[before] * parent[flat] / samples
        lengths = np.array(docs.column("n_tokens").to_pylist(), np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        known, plus_one, logs = (np.add.reduceat(x, starts) for x in ((counts > 0).astype(np.int64)[flat], np.log10(counts + 1.0)[flat], np.minimum(np.log10(p), 0)))
        columns = known, np.full(len(lengths), n_train), plus_one - base * lengths, logs, 10 ** np.minimum(300.0, -logs / lengths)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        return pa.table([*(docs.column(n) for n in ("doc_id", "held_out", "n_tokens")), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return _dealt(both, "chunk", n_buckets).applyInArrow(of_chunk, schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int | None = None, burn_in: int = BURN_IN, samples: int = SAMPLES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Documents whose crc32(doc_id as text) mod 7 is 2 are held out; the others
    train. A null id counts as the empty text; a null text is an empty one and
    has one token, the end. base_score is the add-one unigram model's log10
    probability, score the process's. ``least``: occurrences from which a word
    has a restaurant; rarer ones then share one, and the list of the others has
    to fit the driver. By default every word has one. Repeated rows stay and
    train as often; other columns aren't read; an empty table gives no rows.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.crc32(key) % 7 == 2).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    return _score_every(rows, burn_in, samples) if least is None else _score_listed(rows, least, burn_in, samples)
