import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from datasheaf.llm import packing
from datasheaf.llm._common import vocabulary

PATH = vocabulary("byte_bpe_50k.json")


def check(rows, texts, window):
    """Pieces tile each document, sequences have no gaps, checksums hold."""
    library = Tokenizer.from_file(PATH)
    wanted = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids + [0]) for t in texts)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    assert len(by_sequence) <= sum(map(len, wanted)) // window + 8
    assert sum(r.length for r in rows) == sum(map(len, wanted))
    return wanted


@pytest.mark.parametrize("stretch", [packing.STRETCH, 100])
def test_documents(spark, documents, monkeypatch, stretch):
    monkeypatch.setattr(packing, "STRETCH", stretch)
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = packing.pack(documents, PATH).collect()
    check(rows, texts.values(), 1024)
    library = Tokenizer.from_file(PATH)
    for i, t in texts.items():
        ids, at = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4"), 0
        for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


@pytest.mark.parametrize("stretch", [packing.STRETCH, 3])
def test_edges(edges, nothing, monkeypatch, stretch):
    monkeypatch.setattr(packing, "STRETCH", stretch)
    check(packing.pack(edges, PATH).collect(), [r.text for r in edges.collect()], 1024)
    assert packing.pack(nothing, PATH).count() == 0


def test_nearest_first():
    docs = [np.array(d, np.uint16) for d in ([1, 2, 3, 90, 0], [7, 8, 9, 0], [1, 2, 3, 91, 0], [5, 6, 0], [4, 4, 4, 0])]
    index = packing.Shard(docs)
    index.take(0)
    assert next(index.like(0)) == 2
    index.take(2)
    assert list(index.like(0))[0] in (1, 3, 4)  # nothing shares a rare word: in order


@pytest.mark.parametrize("window", [1, 7, 64])
def test_any_window(window):
    rng = np.random.default_rng(window)
    docs = [rng.integers(0, 50, rng.integers(1, 40)).astype(np.uint16) for _ in range(60)]
    p = packing.Packer(0, window)
    p.shard(docs)
    assert sum(x[2] for x in p.pieces) == sum(map(len, docs)) and p.sequence == sum(map(len, docs)) // window
    assert sorted({x[0] for x in p.pieces}) == list(range(60))
