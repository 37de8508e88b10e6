import hashlib
import random
import unicodedata

import numpy as np
import pytest
from tokenizers import Tokenizer

from datasheaf.llm import bpe_transducer
from datasheaf.llm._common import vocabulary

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe_transducer.WordBpe(PATH)


def texts():
    rng = random.Random(4)
    odd = ["", " ", "Don't I'LL it's 12½ Ⅷ", "ΑΣ ΣΑΣ. İstanbul ẞ e\u0301", "\x00\x1c\x85\u180e\u200b a", "a" * 3000, "ab" * 2500, "日本語 한국어 😀👍🏽", "<|endoftext|>x<|startoftext|> Y <|endoftext|", "x" * 2300 + "<|endoftext|>"]
    return odd + ["".join(rng.choice("aàéßñ thingΣσς\u0301 \n\t,.!<|>'\u3000x12😀") for _ in range(120)) for _ in range(150)]


def test_equals_library(coder, library):
    for t in texts():
        ids = library.encode(t, add_special_tokens=False).ids
        assert coder.encode(t) == ids, t[:60]
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_streaming_equals_whole():
    """Any window of four lookaheads gives the tokens of the whole, for random merge lists."""
    rng = random.Random(1)
    for _ in range(60):
        tokens, merges = list("abc"), []
        for _ in range(12):
            pair = rng.choice(tokens), rng.choice(tokens)
            if len(pair[0] + pair[1]) <= 6 and pair not in merges and pair[0] + pair[1] not in tokens:
                merges.append(pair)
                tokens.append(pair[0] + pair[1])
        ahead = bpe_transducer.sufficient_lookahead(merges)
        t = bpe_transducer.Transducer({p: n for n, p in enumerate(merges)}, ahead)
        t.window = ahead + 2
        text = "".join(rng.choice("abc") for _ in range(400))
        assert list(t.stream(text)) == t.merge(list(text))


def test_decoder_is_incremental(coder, library):
    ids = library.encode("Aé日😀 <|endoftext|> don't", add_special_tokens=False).ids
    machine = bpe_transducer.Decoder(coder)
    assert "".join([machine.push([i]) for i in ids]) + machine.close() == library.decode(ids, skip_special_tokens=False)
    machine = bpe_transducer.Decoder(coder)
    assert machine.push(ids[:2]) + machine.push([]) + machine.push(ids[2:]) + machine.close() == library.decode(ids, skip_special_tokens=False)


def test_characters_are_cut_between_bytes(monkeypatch):
    monkeypatch.setattr(bpe_transducer, "BLOCK", 3)
    assert "".join(bpe_transducer.characters("aé日😀x".encode())) == "aé日😀x" and list(bpe_transducer.characters(b"")) == []


def test_blocks_change_nothing(monkeypatch, coder, library):
    """Blocks far smaller than texts and words, cut anywhere: composed characters, special strings, long runs without white space."""
    monkeypatch.setattr(bpe_transducer, "BLOCK", 48)
    monkeypatch.setattr(bpe_transducer, "SPARE", 16)
    rng = random.Random(9)
    long = ["".join(rng.choice(["a", "é", "e\u0301", "Σ", "한", "日本", "ᄒ", "ᅡ", "!", "'s", "'", "12", "<|endoftext|>", "\u0323", "b" * 90]) for _ in range(rng.randint(1, 150))) for _ in range(150)]
    for t in [*texts(), *long, *[" ".join(long[i : i + 4]) for i in range(40)]]:
        wanted = library.encode(t, add_special_tokens=False).ids
        blocks = [t[i : i + 7] for i in range(0, len(t), 7)]
        assert np.frombuffer(b"".join(coder.stream(blocks)), "<u4").tolist() == wanted, t[:80]


def test_every_word_goes_through_the_transducer(monkeypatch):
    coder, seen = bpe_transducer.WordBpe(PATH), []
    real = coder.bpe.stream
    monkeypatch.setattr(coder.bpe, "stream", lambda symbols, size=len: seen.append("".join(symbols)) or real(symbols, size))
    coder.encode("three words, twice three words")
    assert seen == ["three</w>", "words</w>", ",</w>", "twice</w>"]


def test_memory_is_flat_in_the_text(coder):
    """A text of 32 MB, made as it is read, and one word of 300 kB: what is held doesn't grow."""
    import tracemalloc

    def peak(n):
        tracemalloc.start()
        size = sum(len(raw) for raw in coder.stream("some words of a text that goes on, " * 2000 for _ in range(n)))
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        return size, most

    (small, a), (large, b) = peak(5), peak(100)
    assert large == 20 * small and b < 1.3 * a
    held = [len(raw) for raw in coder.stream("xyzw" * 500 for _ in range(150))]
    assert max(held) < 4 * 2 * bpe_transducer.BLOCK


def test_all_characters(coder, library):
    """Every code point between letters, and pairs of combining marks, as the library has them."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    lines = [" ".join(f"{c}a{c}" for c in points[i : i + 256]) for i in range(0, 0x30000, 256)] + [" ".join(points[i : i + 4096]) for i in range(0x30000, len(points), 4096)]
    rng = random.Random(2)
    marks = [c for c in points[:0x20000] if unicodedata.combining(c)]
    lines += [" ".join("".join([rng.choice("aeoαのက"), rng.choice(marks), rng.choice(marks), rng.choice(marks)]) for _ in range(60)) for _ in range(500)]
    for line, e in zip(lines, library.encode_batch(lines, add_special_tokens=False), strict=True):
        assert coder.encode(line) == e.ids, [hex(ord(c)) for c in line[:8]]


def test_query_rows(edges, nothing, library):
    got = bpe_transducer.encode_decode(edges, PATH, with_ids=True).collect()
    assert len(got) == edges.count()
    wanted = []
    for r in edges.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        wanted.append(str((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest())))
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in got) == sorted(wanted)
    assert bpe_transducer.encode_decode(nothing, PATH).count() == 0


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe_transducer, "MEMORY", 8)
    c = bpe_transducer.WordBpe(PATH)
    first = c.encode(" ".join(f"w{chr(97 + i % 26)}x{chr(97 + i % 7)}" for i in range(200)))
    assert len(c.memory) <= 8 and len(c.older) <= 8 and first == c.encode(" ".join(f"w{chr(97 + i % 26)}x{chr(97 + i % 7)}" for i in range(200)))
