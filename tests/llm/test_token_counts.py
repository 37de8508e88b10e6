import random

import pytest
import sentencepiece

from datasheaf.llm import token_counts
from datasheaf.llm._common import vocabulary

PATH = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_library(library):
    rng = random.Random(2)
    odd = ["", " ", "  a  b ", "\x00\n\t\r\n x", "a" * 2000, "ab " * 500, " " * 50, "▁▁x ▁", "<s> </s> <unk> <0x0A>", "日本語 한국어 😀 ﬁ é"]
    texts = odd + ["".join(rng.choice("aàéßñ thingσ\u0301 \n\t,.!<|>'\u3000x12😀▁") for _ in range(150)) for _ in range(150)]
    counter = token_counts.PieceCounter(PATH)
    for t in texts:
        assert counter.count(t) == counter.count(t) == len(library.encode(t)), t[:60]


def test_rows(edges, nothing, library):
    got = token_counts.count_tokens(edges, PATH).collect()
    wanted = sorted(str((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "")))) for r in edges.collect())
    assert sorted(str((r.doc_id, r.n_bytes, r.n_tokens)) for r in got) == wanted
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got) and any(r.over_limit for r in got)
    assert token_counts.count_tokens(nothing, PATH).count() == 0
