import collections
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from datasheaf.llm import simhash_dedup as s


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def plain_components(fps, distance):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def compare(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps, 2)
    wanted = sorted((str(i), f"{f:016x}", str(rows[k][0])) for (i, _), f, k in zip(rows, fps, roots, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in s.near_duplicates(docs).collect()) == wanted


def test_documents(documents):
    compare(documents)


def test_edges(edges, nothing):
    compare(edges)
    assert s.near_duplicates(nothing).count() == 0 and s.keep_one(nothing).count() == 0
    kept = s.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "6", "7", "8", "None"]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize(("distance", "hot_key"), [(2, 128), (2, 3), (2, 1), (3, 4), (4, 100), (0, 2)])
def test_no_link_is_lost(spark, distance, hot_key):
    """Random fingerprints around few centres, also where every key counts as hot."""
    rng = random.Random(distance * 100 + hot_key)
    centres = [rng.getrandbits(64) for _ in range(5)] + [0, (1 << 64) - 1]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, distance + 2))) for c in centres for _ in range(25)}
    fps |= {(c & ~0xFFFFFFFF) | rng.getrandbits(32) for c in centres for _ in range(5)}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    got = [(r.a, r.b) for r in s.links(df, distance, hot_key).collect()]
    wanted = {(signed(a), signed(b)) for a in fps for b in fps if signed(a) < signed(b) and (a ^ b).bit_count() <= distance}
    assert len(got) == len(set(got)) and set(got) == wanted


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.node: r.root for r in s.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert s.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_similar_texts(spark):
    """Groups of copies with few words changed: one of each stays, unrelated texts all stay."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, n = [], 0
    for _ in range(40):
        base = [word() for _ in range(300)]
        for _ in range(3):
            copy = list(base)
            for at in rng.sample(range(300), 3):
                copy[at] = word()
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n + i, " ".join(word() for _ in range(200))) for i in range(40)]
    kept = [r.doc_id for r in s.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert set(range(n, n + 40)) <= set(kept)
    assert {i for i in range(0, n, 3)} <= set(kept) and len([i for i in kept if i < n]) <= 44


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_groups(found):
    """The smallest number of each group of at least 0.8, all pairs compared."""
    root = list(range(len(found)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(found)):
        for j in range(i):
            if jaccard(found[i], found[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {find(i) for i in root}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def some_words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def kept_ids(spark, texts):
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return {r.doc_id for r in s.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}


def test_copies_among_texts_that_share_a_passage(spark):
    """The keys of near copies are led by other documents with the same passage."""
    rng = random.Random(11)
    passage = some_words(rng, 330)
    texts = [passage + some_words(rng, 70) for _ in range(300)]
    for t in texts[250:]:
        copy = list(t)
        for at in range(10, 330, 45):
            copy[at] = some_words(rng, 1)[0]
        texts.append(copy)
    found = [shingles(t) for t in texts]
    assert all(jaccard(found[250 + i], found[300 + i]) >= 0.8 and jaccard(found[i], found[300 + i]) < 0.8 for i in range(50))
    assert kept_ids(spark, texts) == plain_groups(found) == set(range(300))


def test_blocks_replaced_and_appended(spark):
    rng = random.Random(12)
    texts = []
    for i in range(150):
        base = some_words(rng, 400)
        n = 39 + i % 2 if i < 75 else 80 + i % 16
        texts += [base, base[: 200 - n // 2] + some_words(rng, n) + base[200 - n // 2 + n :] if i < 75 else base + some_words(rng, n)]
    found = [shingles(t) for t in texts]
    assert all(0.8 <= jaccard(a, b) < 0.86 for a, b in zip(found[::2], found[1::2], strict=True))
    assert kept_ids(spark, texts) == set(range(0, 300, 2))


def test_a_repeated_line_is_counted_once(spark):
    rng = random.Random(13)
    texts = []
    for _ in range(10):
        base = some_words(rng, 300)
        texts += [base, base + some_words(rng, 6) * 17]
    assert all(jaccard(shingles(a), shingles(b)) > 0.95 for a, b in zip(texts[::2], texts[1::2], strict=True))
    assert kept_ids(spark, texts) == set(range(0, 20, 2))


def test_a_repeated_phrase_alone_links_nothing(spark):
    """Only the shingles decide, even where fingerprints are within two bits."""
    rng = random.Random(14)
    texts = []
    for _ in range(20):
        phrase = some_words(rng, 49)
        texts += [phrase * 70 + some_words(rng, 1800) for _ in range(2)]
    assert kept_ids(spark, texts) == set(range(40))


def test_documents_against_all_pairs(spark, documents):
    rows = {r.doc_id: (r.text or "").encode().lower().split() for r in documents.collect()}
    found = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for _, w in sorted(rows.items())]
    ids = sorted(rows)
    assert {r.doc_id for r in s.keep_one(documents).collect()} == {ids[i] for i in plain_groups(found)}


def test_a_large_group_that_no_leader_joins(spark):
    """Copies of one text, each so changed that it is like some of the others only."""
    rng = random.Random(15)
    base = some_words(rng, 200)
    texts = []
    for i in range(250):
        copy = list(base)
        for at in rng.sample(range(200), 3 + i % 4):
            copy[at] = some_words(rng, 1)[0]
        texts.append(copy)
    found = [shingles(t) for t in texts]
    assert kept_ids(spark, texts) == plain_groups(found)


def test_parity_never_excludes_a_similar_pair():
    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 300, 5000):
        for more in (0, n // 8, n // 4):
            a = rng.integers(0, 1 << 63, n + more).astype(np.uint64)
            p, q = s.parities(a).view(np.uint64), s.parities(a[:n]).view(np.uint64)
            if len(p) > len(q):
                p = p[: len(q)] ^ p[len(q) :]
            assert sum(int(x).bit_count() for x in p ^ q) <= more


def test_index_misses_no_pair():
    """Sets at the similarity, with none, half or nearly all of what they share being common: the keys of both meet."""
    rng = np.random.default_rng(4)
    for share in (0.0, 0.5, 0.9, 1.0):
        for _ in range(300):
            both = rng.integers(0, 1 << 63, 400).astype(np.uint64)
            a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, 50).astype(np.uint64)])) for _ in range(2))
            common = np.sort(both[: int(share * 400)].view(np.int64))
            keys = [set(s.index_keys(x, common, np.arange(1, len(common) + 1)).tolist()) for x in (a, b)]
            assert keys[0] & keys[1] and all(len(k) <= s.prefix_size(450, 0.8) for k in keys)


def test_unfinished_components_are_an_error(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")
    with pytest.raises(RuntimeError):
        s.components(chain, most_rounds=2)


def test_common_shingles_are_counted_in_all_texts(spark, monkeypatch):
    """Also if none of the texts that share them is one that a hash of the text would draw."""
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared, fewer = words(12), words(12)
    texts = [" ".join(words(20) + shared + (fewer if i % 3 else []) + words(20)) for i in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").filter("pmod(xxhash64(text), 16) <> 0").repartition(4).cache()
    counts = collections.Counter(h for r in df.collect() for h in s.shingle_set(r.text.encode()).view(np.int64).tolist())
    monkeypatch.setattr(s, "COUNTED", 1 << 9)
    h, ranks = s.common_shingles(df, F.col("text"))
    wanted = {x: n for x, n in counts.items() if n > s.COMMON_OVER}
    assert len(wanted) >= 8 and h.tolist() == sorted(wanted)
    rising = [wanted[x] for x in h[np.argsort(ranks)].tolist()]
    assert rising == sorted(rising) and sorted(ranks.tolist()) == list(range(1, len(wanted) + 1))
    assert all(len(x) == 0 for x in s.common_shingles(df.limit(0), F.col("text")))
