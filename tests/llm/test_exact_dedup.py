import hashlib
import re

import pytest
from pyspark.sql import functions as F

from datasheaf.llm import exact_dedup


def plain(rows):
    texts = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in texts:
        groups.setdefault(t, []).append(i)
    key = lambda i: (i is None, i)
    return sorted(((str(i), str(min(groups[t], key=key)), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts)), len(groups)


def compare(docs, **how):
    got = exact_dedup.exact_groups(docs, **how).collect()
    wanted, n = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == wanted
    assert sum(r.kept for r in got) == n and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_documents(documents):
    compare(documents)


@pytest.mark.parametrize("block_bytes", [1, 5, 64, 4096])
def test_block_sizes(edges, block_bytes):
    compare(edges.filter("doc_id is null or doc_id <> 7"), block_bytes=block_bytes)


@pytest.mark.parametrize("weak", [lambda b: F.octet_length(b).cast("long"), lambda b: F.lit(1).cast("long")])
def test_colliding_fingerprints(edges, weak):
    compare(edges, block_bytes=256, fingerprint=weak)


def test_rows_kept(edges, nothing):
    kept = exact_dedup.keep_first(edges)
    assert kept.columns == edges.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "6", "7", "8", "None"]
    assert exact_dedup.exact_groups(nothing).count() == 0 and exact_dedup.keep_first(nothing).count() == 0
