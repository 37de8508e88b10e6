import collections
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from datasheaf.llm import lm_scoring


def plain(rows):
    words = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = collections.Counter(w for i, ws in words if not held(i) for w in ws)
    n, v = c.total(), len(c)
    return [(str(i), held(i), len(ws), sum(w in c for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in words]


def compare(docs):
    got = lm_scoring.score(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert all(r.score <= 0 and r.perplexity >= 1 for r in got)
    return got


def test_documents(documents):
    got = [r for r in compare(documents) if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)  # better than the base on texts it hasn't seen


def test_edges(edges, nothing):
    compare(edges)
    assert lm_scoring.score(nothing).count() == 0


def test_small_chunks(documents, monkeypatch):
    """The same documents in many chunks and buckets: the counts are the same."""
    few = documents.limit(60).cache()
    monkeypatch.setattr(lm_scoring, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(lm_scoring, "BUCKET_TOKENS", 2000)
    compare(few)


def test_table_counts_are_exact():
    """Draws for one dish against the distribution that seating customers one by one gives, weighed by hand."""
    c, d, a, b = 4, 0.6, 0.3, 0.05
    weight = collections.Counter()
    for seating in itertools.product(range(c), repeat=c - 1):  # table of each later customer
        sizes, w, ok = [1], a, True
        for t in seating:
            if t < len(sizes):
                w *= sizes[t] - d
                sizes[t] += 1
            elif t == len(sizes):
                w *= a + b * len(sizes)
                sizes.append(1)
            else:
                ok = False
                break
        if ok:
            weight[len(sizes)] += w
    n = 40000
    draws = lm_scoring.seat(np.full(n, c), np.full(n, a), np.full(n, b), d, np.random.default_rng(0))
    for t in range(1, c + 1):
        assert abs((draws == t).mean() - weight[t] / sum(weight.values())) < 0.01
    assert (lm_scoring.seat(np.array([0, 1, 5000]), np.full(3, a), np.full(3, b), d, np.random.default_rng(0)) <= [0, 1, 5000]).all()


def by_recurrence(c, a, b, d):
    """The distribution of the number of tables, by the plain recurrence in logs."""
    w = np.full(c + 1, -np.inf)
    w[1] = 0.0
    t = np.arange(c + 1)
    with np.errstate(divide="ignore"):
        for n in range(1, c):
            new = np.concatenate(([-np.inf], w[:-1] + np.log(a + b * t[:-1])))
            w = np.logaddexp(new, w + np.log(np.maximum(n - d * t, 0)))
    w = np.exp(w - w.max())
    return w / w.sum()


@pytest.mark.parametrize(("a", "b", "d"), [(0.5, 0.001, 0.8), (5, 0.01, 0.8), (20, 0.02, 0.8), (300, 0.1, 0.7), (2, 0.05, 0.3), (40, 0.3, 0.5), (600, 0.0005, 0.73)])
def test_large_dishes_follow_their_conditional(a, b, d):
    """On both sides of every size at which the weights are computed in another way."""
    rng = np.random.default_rng(1)
    for c in (33, 100, 1000, 1024, 1025, 3000):
        wanted = by_recurrence(c, a, b, d)
        if c > lm_scoring.EXACT:
            first, w = lm_scoring.table_weights(c, a, b, d)
            got = np.zeros(c + 1)
            got[first : first + len(w)] = w / w.sum()
            # a series to the last digits, or a saddle point where tables are many
            assert abs(got - wanted).sum() < (1e-5 if first == 1 else 1e-3), (c, first)
        n = 3000 if c <= lm_scoring.EXACT else 200
        draws = lm_scoring.seat(np.full(n, c), np.full(n, a), np.full(n, b), d, rng)
        mean = (wanted * np.arange(c + 1)).sum()
        spread = math.sqrt((wanted * (np.arange(c + 1) - mean) ** 2).sum() / n)
        assert abs(draws.mean() - mean) < 5 * spread + 1e-9


def test_gibbs_against_a_plain_sampler(spark):
    """A tiny corpus: mean numbers of tables, and predictive probabilities, against customers moved one at a time."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("a a a b b c d e f".split()) for _ in range(12)) for _ in range(20)]
    rows = spark.createDataFrame([(i, False, bytearray(t.encode())) for i, t in enumerate(texts)], "doc_id bigint, held_out boolean, body binary")
    contexts, _ = lm_scoring.context_words(rows, 2)
    state = lm_scoring.chunked(rows.coalesce(1), contexts, 1).filter("bucket is not null").groupBy("bucket").applyInArrow(lm_scoring.merge_bucket, lm_scoring.STATE).cache()
    n_contexts = lm_scoring.FIRST_WORD + len(contexts)
    shape, _ = lm_scoring.fit(state, n_contexts, 0)
    row = state.first().asDict()
    b, tables, first = lm_scoring._bucket(row), [], 300
    for i in range(3000):
        b.seats.sweep(i, shape)
        shape.totals.append(lm_scoring.Totals(np.bincount(b.context, b.tables(), n_contexts), b.seats.parent_customers.sum(), b.seats.parent_tables.sum()))
        if i >= first:
            tables.append((b.tables().sum(), b.seats.parent_tables.sum()))

    # the plain sampler: tables as lists of customers
    d, e, base, theta = shape.discount, shape.parent_discount, 1 / (shape.vocabulary + 1), lm_scoring.STRENGTH
    inner, outer = collections.defaultdict(list), collections.defaultdict(list)

    def weight_of(w):
        total = sum(sum(x) for x in outer.values())
        return (sum(outer[w]) - e * len(outer[w]) + (theta + e * sum(map(len, outer.values()))) * base) / (theta + total)

    def sit(found, discount, new):
        k = rng.choices(range(len(found) + 1), [n - discount for n in found] + [new])[0]
        if k == len(found):
            found.append(0)
        found[k] += 1
        return found[k] == 1

    def leave(found):
        k = rng.choices(range(len(found)), found)[0]
        found[k] -= 1
        if not found[k]:
            found.pop(k)
            return True

    def enter(u, w):
        own = sum(len(x) for (v, _), x in inner.items() if v == u)
        if sit(inner[u, w], d, (theta + d * own) * weight_of(w)):
            sit(outer[w], e, (theta + e * sum(map(len, outer.values()))) * base)

    customers = [(u, w) for u, w, c in zip(b.context.tolist(), b.word.tolist(), b.customers.tolist(), strict=True) for _ in range(c)]
    for u, w in customers:
        enter(u, w)
    plain_tables = []
    for i in range(260):
        for u, w in customers:
            if leave(inner[u, w]):
                leave(outer[w])
            enter(u, w)
        if i >= 60:
            plain_tables.append((sum(map(len, inner.values())), sum(map(len, outer.values()))))
    got, wanted = np.mean(tables, axis=0), np.mean(plain_tables, axis=0)
    assert abs(got[0] - wanted[0]) < 0.05 * wanted[0] and abs(got[1] - wanted[1]) < 0.1 * wanted[1], (got, wanted)


def test_contexts_are_counted_exactly(spark, documents, monkeypatch):
    rows = documents.select("doc_id", F.lit(False).alias("held_out"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    counts = collections.Counter(w for r in rows.collect() for w in bytes(r.body).lower().split())
    for parts, size in ((1, 1 << 20), (7, 400)):
        monkeypatch.setattr(lm_scoring, "CHUNK_TOKENS", size)
        words, n = lm_scoring.context_words(rows.repartition(parts), 30)
        assert words == sorted((w for w, c in counts.items() if c >= 30), key=lambda w: (-counts[w], w)) and n == counts.total() + rows.count()
    assert lm_scoring.least_count(100 * 10**8) == 10 * lm_scoring.least_count(10**8) and lm_scoring.least_count(0) == 2


def test_probabilities_sum_to_one(spark, documents):
    """Over all words and one unknown, after any context."""
    rows = documents.select("doc_id", F.lit(False).alias("held_out"), F.coalesce("text", F.lit("")).cast("binary").alias("body")).limit(40)
    contexts, _ = lm_scoring.context_words(rows, 40)
    chunks = lm_scoring.chunked(rows.coalesce(1), contexts, 1).filter("bucket is not null")
    state = chunks.groupBy("bucket").applyInArrow(lm_scoring.merge_bucket, lm_scoring.STATE).cache()
    n_contexts = lm_scoring.FIRST_WORD + len(contexts)
    shape, _ = lm_scoring.fit(state, n_contexts, 2)
    row = state.first().asDict()
    b = lm_scoring._bucket(row)
    b.seats.sweep(0, shape)
    b.seats.sweep(1, shape)
    at = shape.totals[2]
    p = b.seats.parent(shape, at)
    assert at.tables == b.seats.parent_tables.sum() and (at.context_tables == np.bincount(b.context, b.tables(), n_contexts)).all()
    base = 1 / (shape.vocabulary + 1)
    unknown = (lm_scoring.STRENGTH + shape.parent_discount * at.tables) * base / (lm_scoring.STRENGTH + at.customers)
    assert abs(p.sum() + unknown - 1) < 1e-9
    for u in range(n_contexts):
        c, t = shape.context_customers[u], at.context_tables[u]
        back = (lm_scoring.STRENGTH + shape.discount * t) / (lm_scoring.STRENGTH + c)
        own = np.where(b.context == u, np.maximum(b.customers - shape.discount * b.tables(), 0), 0).sum() / (lm_scoring.STRENGTH + c)
        assert abs(own + back * (p.sum() + unknown) - 1) < 1e-9


def test_scores_do_not_depend_on_a_bound_by_size(documents, monkeypatch):
    """A bound that grows with the corpus would leave few of these words a restaurant; every word has one."""
    few = documents.limit(80).cache()
    wanted = {r.doc_id: r.score for r in lm_scoring.score(few).collect()}
    monkeypatch.setattr(lm_scoring, "SCALE", 1)
    assert {r.doc_id: r.score for r in lm_scoring.score(few).collect()} == wanted


def test_every_word_is_a_context(spark, documents, monkeypatch):
    """Restaurants dealt over many buckets and chunks, against all of them in one with their totals on the driver."""
    few = documents.limit(150).coalesce(1).cache()
    wanted = {r.doc_id: r for r in lm_scoring.score(few, least=1, samples=6).collect()}
    monkeypatch.setattr(lm_scoring, "CHUNK_TOKENS", 5000)
    monkeypatch.setattr(lm_scoring, "BUCKET_TOKENS", 10000)
    got = {r.doc_id: r for r in lm_scoring.score(few, samples=6).collect()}
    assert got.keys() == wanted.keys() and len({r.train_tokens for r in got.values()}) == 1
    apart = [(got[k].score - w.score) / w.n_tokens for k, w in wanted.items() if w.n_tokens >= 40]  # shorter ones differ more by the draws
    assert len(apart) > 100 and max(map(abs, apart)) < 0.02 and abs(sum(apart)) / len(apart) < 0.002, (min(apart), max(apart), sum(apart) / len(apart))


def test_savings_of_contexts_are_summed(spark, documents, monkeypatch):
    """Owners get, over all buckets, the customers less the tables of each of their words' restaurants."""
    rows = documents.limit(60).select("doc_id", F.lit(False).alias("held_out"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    words = [lm_scoring.tokens(bytes(r.body)) for r in rows.collect()]
    pairs = collections.Counter((u, w) for x in words for u, w in zip([b"", *x], x, strict=False))
    saved = collections.Counter()
    for (u, _), n in pairs.items():
        saved[u] += n - 1  # one table for each dish
    n_buckets = 5
    state = lm_scoring._dealt(lm_scoring.asked_by(lm_scoring.numbered(rows.repartition(3)).cache(), n_buckets), "bucket", n_buckets).applyInArrow(lm_scoring.merge_asked, lm_scoring.MERGED).cache()
    places = lm_scoring.owned(state, n_buckets)
    sums = lm_scoring.saved_sums(lm_scoring.first_seats(state, places, n_buckets), n_buckets)
    hashes = {r.bucket: lm_scoring.unpack_steps(r.hashes).tolist() for r in places.filter("kind = 'owned'").collect()}
    got = {h: n for r in sums.filter("kind = 'owned'").collect() for h, n in zip(hashes[r.bucket], lm_scoring.unpack(r.saved).tolist(), strict=True)}
    assert got == {lm_scoring.xxhash.xxh64_intdigest(u) >> 8: n for u, n in saved.items() if n}
