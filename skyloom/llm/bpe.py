"""Byte-level BPE as a streaming transducer with a bounded lookahead, and its inverse as a byte-to-text state machine.

Why a bound exists. Let the merges run over a string w and over w followed by more bytes. Left of some frontier both
runs make the same merges. The frontier moves left only when a merge (s, t) happens in one run and not in the other,
with t starting where the frontier stood. Such merges have rising ranks, and t grew to the right from the left
operand of the merge before, so that operand lies on the left spine of t's derivation. The longest chain of
merges under these two conditions, each counted with the bytes of its left operand, bounds how far new bytes can
change what stands to their left. :func:`sufficient_lookahead` computes it by one pass over the merge list; a token that
ends at least so many bytes before the end of what was read is stable and is emitted.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import regex

#: White space as Unicode's White_Space property has it (fixed values).
SPACE = "\\t\\n\\x0b\\x0c\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Characters in which the classes of the split are plain ranges, and the split pattern of the vocabulary file's pre-tokenizer over them (fixed values).
COMMON = r"\x00-\u024f\u2010-\u2027"
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t\n\x0b\x0c\r\x20\x85\xa0"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
#: What the memo of words may hold before it is emptied, in bytes of words with 256 a word for the rest; bounds the memory of a worker.
MEMO_BYTES = 80_000_000
#: Characters per step; longer texts are read in such steps. A word whose known part is longer than LONG is taken as it comes.
STEP, LONG = 1 << 16, 1024


class Shown(dict):
    """For str.translate: a common character of the same class for each other one. Versions of Unicode differ between libraries, so the class of a
    character outside the common ones is asked of the tokenizer library's own pre-tokenizer, once."""

    #: A character of each class, and a common one that stands for it; the last is white space.
    KINDS = (("a", "\u0101"), ("1", "\xb2"), ("!", "\xa7"))

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.ask = ByteLevel(add_prefix_space=False).pre_tokenize_str

    def __missing__(self, code: int) -> str:
        c = chr(code)
        made = self[code] = c if not uncommon(c) else next((sign for like, sign in self.KINDS if len(self.ask(like + c)) == 1), "\xa0")
        return made


uncommon = re.compile(rf"[^{COMMON}]").search


@lru_cache(maxsize=1)
def _shown() -> Shown:
    return Shown()


def shown(text: str) -> str:
    """``text`` in common characters of the same classes, place by place."""
    return text.translate(_shown()) if uncommon(text) else text


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that vocabulary files use for bytes, by the usual rule: printable Latin-1 stands for
    itself, the other bytes for 256, 257 and so on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(spec: dict) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ids of tokens as bytes, and of special strings."""
    back = byte_alphabet()
    return {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items()}, {t["content"]: t["id"] for t in spec["added_tokens"]}


class Merges:
    """A vocabulary file's tables by id: bytes of each token, and rank and result of each pair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = byte_alphabet()
        vocab, self.special = read_vocabulary(spec)
        self.bytes_of: dict[int, bytes] = {i: b for b, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        self.byte_id = [vocab[bytes([b])] for b in range(256)]
        self.vocab = vocab
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (bytes(back[c] for c in x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.pairs[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.lookahead = sufficient_lookahead(self.pairs, self.bytes_of)
        #: a long word's windows repeat where the word does
        self.encode_window = lru_cache(maxsize=256)(self.encode_word)

    def encode_word(self, word: bytes) -> list[int]:
        """Merge by rank, leftmost first among equals."""
        ids = [self.byte_id[b] for b in word]
        pairs = self.pairs
        if len(ids) > 48:
            return self._encode_heap(ids)
        while len(ids) > 1:
            best, at, made = 1 << 60, -1, 0
            for i in range(len(ids) - 1):
                hit = pairs.get((ids[i], ids[i + 1]))
                if hit is not None and hit[0] < best:
                    best, at, made = hit[0], i, hit[1]
            if at < 0:
                break
            ids[at : at + 2] = [made]
        return ids

    def _encode_heap(self, ids: list[int]) -> list[int]:
        """The same for longer strings, with a queue of pairs over a linked list."""
        n, pairs = len(ids), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(hit[0], i, ids[i], ids[i + 1], hit[1]) for i in range(n - 1) if (hit := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
                if hit := pairs.get((made, ids[after[j]])):
                    heapq.heappush(queue, (hit[0], i, made, ids[after[j]], hit[1]))
            if before[i] >= 0 and (hit := pairs.get((ids[before[i]], made))):
                heapq.heappush(queue, (hit[0], before[i], ids[before[i]], made, hit[1]))
        return [x for x in ids if x >= 0]


def sufficient_lookahead(pairs: dict[tuple[int, int], tuple[int, int]], bytes_of: dict[int, bytes]) -> int:
    """Bytes after which a token can't change any more, see the module's text. One pass in rank order."""
    left_of: dict[int, int] = {}
    reach: dict[int, int] = {}  # longest chain that ends in a merge with this left operand
    most = 1
    for (s, t), (_, made) in sorted(pairs.items(), key=lambda x: x[1][0]):
        back, x = 0, t
        while True:
            back = max(back, reach.get(x, 0))
            if x not in left_of:
                break
            x = left_of[x]
        chain = back + len(bytes_of[s])
        reach[s] = max(reach.get(s, 0), chain)
        left_of.setdefault(made, s)
        most = max(most, chain)
    return most


class LongWord:
    """A word of any length, byte by byte in and ids out: holds at most the lookahead and a step of four times as much."""

    def __init__(self, merges: Merges):
        self.merges, self.held = merges, b""

    def push(self, more: bytes) -> list[int]:
        """The ids that have become stable."""
        keep, step, out = self.merges.lookahead, 4 * self.merges.lookahead, []
        for at in range(0, len(more), step):
            self.held += more[at : at + step]
            done = 0
            for i in self.merges.encode_window(self.held):
                end = done + len(self.merges.bytes_of[i])
                if end > len(self.held) - keep:
                    break
                out.append(i)
                done = end
            self.held = self.held[done:]
        return out

    def close(self) -> list[int]:
        """The rest, once the word has ended."""
        rest, self.held = self.held, b""
        return list(self.merges.encode_window(rest)) if rest else []


class Words(dict):
    """Ids of a word and the same as decimals joined by commas. No token of a word that is shorter than the lookahead is stable
    before the word ends, so such words are encoded at their end and kept, as far as there's room; longer ones take :class:`LongWord`."""

    def __init__(self, merges: Merges, room: int = MEMO_BYTES):
        super().__init__()
        self.merges, self.room, self.left = merges, room, room

    def __missing__(self, word: str) -> tuple[tuple[int, ...], bytes]:
        raw = word.encode("utf-8", "replace")
        if len(raw) > self.merges.lookahead:
            run = LongWord(self.merges)
            return said(run.push(raw) + run.close())
        made = said(self.merges.encode_word(raw))
        self.left -= len(raw) + 256
        if self.left < 0:
            self.clear()
            self.left = self.room
        self[word] = made
        return made


def said(ids: list[int]) -> tuple[tuple[int, ...], bytes]:
    return tuple(ids), b",".join([b"%d" % i for i in ids])


class Stream:
    """One text's way through the transducer: the split's unfinished tail, and the word that is open where it's long."""

    def __init__(self, transducer: Transducer):
        self.of, self.held, self.run, self.kind = transducer, "", None, None

    def feed(self, text: str, final: bool = False) -> list[tuple[tuple[int, ...], bytes]]:
        """What becomes stable by ``text``. ``final``: the text ends here.

        A word is told from its last character and the one after; a contraction looks at three. So the last word of a step and what starts
        in its last three characters wait for more. Of a run of white space, the last character may belong to the next word.
        """
        out, held = [], self.held + text
        if self.run is not None:
            end = self.kind.match(shown(held)).end()
            goes_on = end == len(held) and not final
            stop = end - 1 if self.kind is self.of.spaces and (goes_on or end < len(held)) else end
            out.append(said(self.run.push(held[:stop].encode("utf-8", "replace"))))
            held = held[stop:]
            if goes_on:
                self.held = held
                return out
            out.append(said(self.run.close()))
            self.run = None
        words = self.of.split(held)
        if not final:
            at, k = len(held), len(words)
            while k and (k == len(words) or at - len(words[k - 1]) > len(held) - 3):
                k -= 1
                at -= len(words[k])
            self.held = held[at:]
            del words[k:]
        out += map(self.of.memo.__getitem__, words)
        if not final and len(self.held) > LONG:
            self.kind = next(c for c in self.of.classes if c.fullmatch(shown(self.held[-1])))
            self.run = LongWord(self.of.merges)
            stop = len(self.held) - (self.kind is self.of.spaces)
            out.append(said(self.run.push(self.held[:stop].encode("utf-8", "replace"))))
            self.held = self.held[stop:]
        return out


class Transducer:
    """Text in, token ids out, in steps; holds at most a step, the split's short tail and a long word's lookahead."""

    def __init__(self, merges: Merges):
        self.merges, self.memo = merges, Words(merges)
        self.find = re.compile(SPLIT)
        letters, numbers, others, self.spaces = (re.compile(c + "*") for c in (f"[{_L}]", f"[{_N}]", f"[^{_S}{_L}{_N}]", f"[{_S}]"))
        self.classes = (letters, numbers, others, self.spaces)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(merges.special, key=len, reverse=True))) if merges.special else None
        self.longest = max(map(len, merges.special), default=1)

    def split(self, text: str) -> list[str]:
        return [text[m.start() : m.end()] for m in self.find.finditer(shown(text))] if uncommon(text) else self.find.findall(text)

    def _segments(self, parts: Iterable[str]):
        """(text, special): text and the special string that ends its segment, None where the segment goes on. Holds back what may be the
        start of a special string."""
        held = ""
        for part in parts:
            held += part
            safe, at = max(0, len(held) - self.longest + 1), 0
            for m in self.specials.finditer(held) if self.specials else ():
                if m.start() >= safe:
                    break
                yield held[at : m.start()], m[0]
                at = m.end()
            stop = max(at, safe)
            yield held[at:stop], None
            held = held[stop:]
        at = 0
        for m in self.specials.finditer(held) if self.specials else ():
            yield held[at : m.start()], m[0]
            at = m.end()
        yield held[at:], None

    def stream(self, parts: Iterable[str]):
        """Lists of (ids, the same as decimals) of a text that comes in parts, as they become stable."""
        now = Stream(self)
        for text, special in self._segments(parts):
            for at in range(0, len(text), STEP):
                yield now.feed(text[at : at + STEP])
            if special is not None:
                yield now.feed("", True)
                yield [said([self.merges.special[special]])]
                now = Stream(self)
        yield now.feed("", True)

    def chunks(self, text: str):
        """The same for a text at hand; one of a step or less, without special strings, takes one feed."""
        if len(text) <= STEP and not any(s in text for s in self.merges.special):
            yield list(map(self.memo.__getitem__, self.split(text)))
        else:
            yield from self.stream(text[at : at + STEP] for at in range(0, len(text), STEP))

    def encode(self, text: str) -> list[int]:
        """All ids of ``text``."""
        return [i for some in self.chunks(text) for ids, _ in some for i in ids]


class Decoder:
    """Ids in, text out, in steps: a state machine over bytes that holds at most three bytes of an unfinished character."""

    def __init__(self, merges: Merges):
        self.bytes_of = [merges.bytes_of[i] for i in range(max(merges.bytes_of) + 1)]
        self.text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], final: bool = False) -> str:
        return self.text.decode(b"".join(map(self.bytes_of.__getitem__, ids)), final)


def digests(transducer: Transducer, text: str | None) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids as decimals joined by commas, SHA-256 of what they decode to; one pass,
    with no list of all ids."""
    ids_sha, text_sha, n = hashlib.sha256(), hashlib.sha256(), 0
    decoder = Decoder_of(transducer.merges)
    for some in transducer.chunks(text or ""):
        ids = list(chain.from_iterable([ids for ids, _ in some]))
        if not ids:
            continue
        if n:
            ids_sha.update(b",")
        n += len(ids)
        ids_sha.update(b",".join([x for _, x in some if x]))
        text_sha.update(decoder.feed(ids).encode("utf-8"))
    text_sha.update(decoder.feed([], True).encode("utf-8"))
    return n, ids_sha.hexdigest(), text_sha.hexdigest()


@lru_cache(maxsize=4)
def _table(merges: Merges) -> list[bytes]:
    return [merges.bytes_of.get(i, b"") for i in range(max(merges.bytes_of) + 1)]


def Decoder_of(merges: Merges) -> Decoder:
    """A decoder that shares the table of ``merges``."""
    made = Decoder.__new__(Decoder)
    made.bytes_of, made.text = _table(merges), codecs.getincrementaldecoder("utf-8")("replace")
    return made


@lru_cache(maxsize=4)
def transducer_for(path: str) -> Transducer:
    """One transducer a worker and vocabulary file."""
    return Transducer(Merges(path))
