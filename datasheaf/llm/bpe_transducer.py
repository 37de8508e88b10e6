"""Byte-pair encoding by a bounded-lookahead streaming transducer, and incremental decoding.

Encoding. Whether a token of a byte-pair encoding is final depends on what
follows it only through chains of merges of falling rank: the token's last part
could have merged with what follows, had that been formed before, which depends
on what follows it in turn. ``sufficient_lookahead`` finds the longest chain
from the merge list alone. The transducer holds a few times that many symbols,
whatever the length of the word, and emits tokens as soon as so many symbols
follow them, or the word ends. All words go through it; tokens of short words
are remembered. A text is read in blocks, and its ids leave as they come.

Decoding. Ids become bytes, bytes become text in a state machine that holds the
unfinished bytes of one character at most.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from datasheaf.llm._common import per_row

#: Words remembered by a worker, in two generations of some 50 MB, and the longest one kept.
MEMORY, MEMORY_CHARS = 1 << 17, 48
NEVER = 1 << 60
#: Characters of a text that are read at a time, and the last ones of an open word that are held back.
BLOCK, SPARE = 1 << 16, 64
#: Characters up to here compose with none before them, and their kinds are the same in all versions of Unicode.
UNFAMILIAR = regex.compile(r"[^\x00-\u024f]")
#: Some of the characters that never compose with the one before: Latin, Cyrillic, Hebrew, Arabic, Devanagari, Thai, kana, ideographs, Hangul syllables.
STARTER = regex.compile(r"[\x00-\u024f\u0400-\u0481\u05d0-\u05ea\u0620-\u064a\u0904-\u0939\u0e01-\u0e30\u3041-\u3096\u30a1-\u30fa\u3400-\u9fff\uac00-\ud7a3\U00020000-\U0003ffff]")
#: White space as the vocabulary's patterns see it.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible Latin-1, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]], size=len) -> int:
    """Symbols after a token that can decide whether it stays as it is.

    Taken in order of rank, a merge (a, b) can reach size(b) symbols past the
    end of a, and on from there as far as any earlier merge reaches whose left
    side can be the last token of b while b is formed: b itself, its right
    part, that one's right part, and so on.
    """
    reach: dict[str, int] = {}
    right: dict[str, str] = {}
    most = 0
    for a, b in merges:
        further, part = 0, b
        while part is not None:
            further = max(further, reach.get(part, 0))
            part = right.get(part)
        here = size(b) + further
        reach[a] = max(reach.get(a, 0), here)
        right.setdefault(a + b, b)
        most = max(most, here)
    return most


class Transducer:
    """Streams symbols to tokens in constant memory. ``rank`` has the merges in order of rank."""

    def __init__(self, rank: dict[tuple[str, str], int], lookahead: int) -> None:
        self.rank, self.lookahead = rank, lookahead
        self.window = 4 * lookahead + 64

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        rank, symbols = self.rank, list(symbols)
        ranks = [rank.get(p, NEVER) for p in zip(symbols, symbols[1:], strict=False)]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            symbols[i] = new = symbols[i] + symbols.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((new, symbols[i + 1]), NEVER)
            if i:
                ranks[i - 1] = rank.get((symbols[i - 1], new), NEVER)
        return symbols

    def stream(self, symbols: Iterable[str], size=len) -> Iterator[str]:
        """Tokens of the symbols; ``size`` gives the symbols in a token."""
        held = Held(self, size)
        for s in symbols:
            yield from held.push((s,))
        yield from held.close()


class Held:
    """The symbols of one word that aren't tokens for good yet; ``window`` at most."""

    def __init__(self, machine: Transducer, size=len) -> None:
        self.machine, self.size = machine, size
        self.symbols: list[str] = []

    def push(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens that no further symbol can change."""
        for s in symbols:
            self.symbols.append(s)
            if len(self.symbols) >= self.machine.window:
                stable, at = len(self.symbols) - self.machine.lookahead, 0
                for token in self.machine.merge(self.symbols):
                    if at + self.size(token) > stable:
                        break
                    yield token
                    at += self.size(token)
                del self.symbols[:at]

    def close(self) -> Iterator[str]:
        yield from self.machine.merge(self.symbols)
        self.symbols = []


class WordBpe:
    """A tokenizer file of words: composed, lower-cased, cut by a pattern, each word's bytes merged with an end mark on the last.

    A text goes through in blocks: bytes to characters, words, symbols, tokens,
    ids. What is held is one block, and the open end of a word that is longer.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.bpe = Transducer({p: n for n, p in enumerate(pairs)}, sufficient_lookahead(pairs, self.symbols))
        (cut,) = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(cut.replace(r"\s", WHITE))
        self.marked = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}
        self.raw = {t: i.to_bytes(4, "little") for i, t in self.texts.items()}
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # character tables beyond FAMILIAR are the library's own: they change with each version of Unicode
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer

    def symbols(self, token: str) -> int:
        """Symbols in a token: the end mark belongs to the last one."""
        return len(token) - len(self.end) if self.end and token.endswith(self.end) else len(token)

    def normal(self, text: str) -> str:
        """Composed (NFC) and lower-cased one character at a time, so a final sigma is none."""
        return self.normalizer.normalize_str(text) if UNFAMILIAR.search(text) else text.lower()

    def words(self, normal: str) -> list[str]:
        if not UNFAMILIAR.search(normal):
            return self.pattern.findall(normal)
        return [bytes(map(self.byte_of.__getitem__, piece)).decode() for piece, _ in self.pre_tokenizer.pre_tokenize_str(normal)]

    def word(self, word: str) -> bytes:
        """The ids as little-endian 32 bits."""
        known = self.memory.get(word)
        if known is None:
            known = self.older.pop(word, None)
            if known is None:
                known = b"".join([self.raw[t] for t in self.bpe.stream(self.spelled(word), self.symbols)])
            if len(word) <= MEMORY_CHARS:
                if len(self.memory) >= MEMORY:
                    self.memory, self.older = {}, self.memory
                self.memory[word] = known
        return known

    def spelled(self, word: str) -> list[str]:
        letters = [self.letters[b] for b in word.encode()]
        letters[-1] += self.end
        return letters

    def split(self, text: str) -> Iterator[tuple[bool, str]]:
        """The special strings of a text, and what is between them."""
        if self.marked and any(s in text for s in self.special):
            yield from ((piece in self.special, piece) for piece in self.marked.split(text) if piece)
        elif text:
            yield False, text

    def stream(self, blocks: Iterable[str]) -> Iterator[bytes]:
        """The ids of a text that comes in blocks, in parts as they become stable, as little-endian 32 bits."""
        buffer, long = "", LongWord(self)
        for block in blocks:
            buffer += block
            while len(buffer) >= BLOCK:
                at = max(map(buffer.rfind, " \n\t\r"))
                if at > 0:  # before white space nothing is composed, and no word goes on
                    yield from long.last(buffer[:at])
                    buffer = buffer[at:]
                    break
                if len(buffer) < 2 * BLOCK or not (at := self.safe(buffer)):
                    break
                yield from long.more(buffer[:at])
                buffer = buffer[at:]
        yield from long.last(buffer)

    def safe(self, text: str) -> int:
        """The last place before which characters don't compose with what follows, outside of special strings; 0 if there is none."""
        found = [m.start() for m in STARTER.finditer(text, len(text) - BLOCK // 2, len(text) - SPARE)]
        at = found[-1] if found else 0
        if at and self.marked:
            for m in self.marked.finditer(text, max(0, at - SPARE)):
                if m.start() < at < m.end():
                    return m.end()
        return at

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.stream([text])), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        machine = Decoder(self)
        return "".join([machine.push([i]) for i in ids]) + machine.close()


class LongWord:
    """Words of the white-space-free run that a text's blocks may cut; a word longer than a block goes to the transducer as it comes."""

    def __init__(self, coder: WordBpe) -> None:
        self.coder, self.open, self.tail = coder, None, ""

    def more(self, text: str) -> Iterator[bytes]:
        """``text``, whose last word may go on."""
        yield from self._take(text, False)

    def last(self, text: str) -> Iterator[bytes]:
        """``text``, whose last word ends with it."""
        if self.tail:
            yield from self._take(text, True)
            return
        get, word = self.coder.memory.get, self.coder.word
        for special, piece in self.coder.split(text):
            yield self.coder.raw[piece] if special else b"".join([get(w) or word(w) for w in self.coder.words(self.coder.normal(piece))])

    def _take(self, text: str, ended: bool) -> Iterator[bytes]:
        pieces = list(self.coder.split(text)) or [(False, "")]
        for i, (special, piece) in enumerate(pieces):
            words = self.coder.words(self.tail + ("" if special else self.coder.normal(piece)))
            self.tail = ""
            goes_on = words and not special and not ended and i == len(pieces) - 1
            keep = words.pop() if goes_on else ""
            yield from self._words(words)
            if special:
                yield self.coder.raw[piece]
            if len(keep) > SPARE:  # its kind of character goes on or not, whatever comes before the last few
                self.open = self.open or Held(self.coder.bpe, self.coder.symbols)
                yield b"".join([self.coder.raw[t] for t in self.open.push([self.coder.letters[b] for b in keep[:-SPARE].encode()])])
                keep = keep[-SPARE:]
            self.tail = keep

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Whole words; the first one ends the open one."""
        if words and self.open:
            spelled = self.coder.spelled(words.pop(0))
            yield b"".join([self.coder.raw[t] for t in (*self.open.push(spelled), *self.open.close())])
            self.open = None
        yield b"".join(map(self.coder.word, words))


class Decoder:
    """Ids to text as they come: whole characters at once, at most one unfinished character held, U+FFFD for what is none.

    A file without a decoder shows the tokens themselves, a space between.
    """

    def __init__(self, coder: WordBpe) -> None:
        self.shown = coder.texts
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.gap = b""

    def push(self, ids: Iterable[int]) -> str:
        shown = [t for i in ids if (t := self.shown.get(i)) is not None]
        if not shown:
            return ""
        text = self.machine.decode(self.gap + " ".join(shown).encode())
        self.gap = b" "
        return text

    def close(self) -> str:
        return self.machine.decode(b"", True)


def characters(body: bytes) -> Iterator[str]:
    """The characters of UTF-8 bytes, block by block."""
    machine, view = codecs.getincrementaldecoder("utf-8")(), memoryview(body)
    for at in range(0, len(body), BLOCK):
        yield machine.decode(view[at : at + BLOCK], at + BLOCK >= len(body))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256; ids and decoded too if asked for.

    ``path`` is a tokenizer file readable on every executor. Null and empty
    texts have no tokens and decode to the empty text. Null ids and repeated
    rows stay; other columns aren't read; an empty table gives no rows. Ids and
    decoded text go into the digests as they come; only ``with_ids`` holds them.
    """

    def coded(texts: list[bytes]) -> list[pa.Array]:
        coder, n, ids, decoded, all_ids, all_texts = tokenizer(path), [], [], [], [], []
        for body in texts:
            machine, size = Decoder(coder), 0
            of_ids, of_text = hashlib.sha256(), hashlib.sha256()
            held_ids, held_text = [], []
            for raw in coder.stream(characters(body)):
                part = np.frombuffer(raw, "<u4").tolist()
                shown = machine.push(part)
                size += len(part)
                of_ids.update(raw)
                of_text.update(shown.encode())
                if with_ids:
                    held_ids += part
                    held_text.append(shown)
            shown = machine.close()
            of_text.update(shown.encode())
            n.append(size)
            ids.append(of_ids.hexdigest())
            decoded.append(of_text.hexdigest())
            all_ids.append(held_ids)
            all_texts.append("".join(held_text) + shown)
        out = [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
        return out + ([pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_texts, pa.string())] if with_ids else [])

    more = ", ids array<int>, decoded string" if with_ids else ""
    return per_row(docs, [F.col(id_col).alias("doc_id")], F.col(text_col), coded, "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + more)
