"""Token counts, the transducer and packing against the tokenizer library."""

import hashlib
import random
import resource
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyloom.llm import bpe
from skyloom.llm import op2_token_counts as o2
from skyloom.llm import op4_packing as o4
from skyloom.llm import op7_bpe as o7
from skyloom.llm.bpe import Decoder, transducer_for

PATH = public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids_of(text):
    return library("byte_bpe_50k.json").encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("abt' lrsve\n\t1é漢!<|>")), st.characters(codec="utf-8")), max_size=60))
def test_transducer_equals_library(text):
    made = transducer_for(PATH)
    ids = made.encode(text)
    assert ids == ids_of(text)
    assert Decoder(made.merges).feed(ids, True) == library("byte_bpe_50k.json").decode(ids, skip_special_tokens=False)


def test_classes_are_the_librarys():
    """Characters that versions of Unicode class differently, alone and beside letters, digits and signs."""
    import sys
    import unicodedata

    import regex

    letter = regex.compile(r"\p{L}").match
    odd = [c for c in map(chr, range(0x250, sys.maxunicode + 1)) if bool(letter(c)) != unicodedata.category(c).startswith("L")][::97]
    made = transducer_for(PATH)
    for c in [*odd, "\U000323b0", "\u1c89", "\ua7cb", "\u0378", "\u2028", "\u180e", "\u200b", "\u0661", "\u2167"]:
        if not 0xD800 <= ord(c) < 0xE000:
            text = f"«{c} a{c}1{c}!{c}\n{c}{c} x"
            assert made.encode(text) == ids_of(text), hex(ord(c))
            assert o2._counter(o2.vocabulary_path())([text]) == [counted(text)], hex(ord(c))
            assert [i for some in made.stream([text + c * 2000 + "ab"]) for ids, _ in some for i in ids] == ids_of(text + c * 2000 + "ab"), hex(ord(c))


@pytest.mark.parametrize("text", ["x" * 100_000, " " * 70_000 + "a", "they'll" * 15_000, "ab " * 21_845 + "'ll ok", "a<|endoftext|>b" * 3, "aaaaaaaaab" * 500, "1" * 65_534 + "'s x"])
def test_long_texts_are_encoded_in_steps(text):
    assert transducer_for(PATH).encode(text) == ids_of(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "'", "'s", "'re", "'ll", "1", "23", "!", "é", "漢", "<|endoftext|>", "<|endof", "x" * 30, " " * 30, "!" * 30, "7" * 30, "the", "ou"]), max_size=40), st.integers(1, 9), st.integers(4, 12))
def test_small_steps_change_nothing(parts, step, long):
    made, text = transducer_for(PATH), "".join(parts)
    before = bpe.STEP, bpe.LONG
    bpe.STEP, bpe.LONG = step, long
    try:
        got = [i for some in made.stream(parts) for ids, _ in some for i in ids]
        assert got == made.encode(text) == ids_of(text)
    finally:
        bpe.STEP, bpe.LONG = before


@pytest.mark.parametrize("unit", ["the", " ", "-=", "é"])
def test_memory_stays_constant_over_one_long_word(unit):
    """64 MB of one word, in parts: what's held at any time is a few steps. Ids are compared with a shorter word's."""
    made, part = transducer_for(PATH), unit * 64_000
    short = [i for some in made.stream([part]) for ids, _ in some for i in ids]
    n, first, last, before = 0, [], [], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for some in made.stream(part for _ in range((64 << 20) // len(part.encode()))):
        for ids, _ in some:
            n += len(ids)
            first = first or list(ids)
            last = list(ids) or last
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 8 << 10 and n > 1 << 18
    assert short[: len(first)] == first and short[-len(last) :] == last


def test_stable_tokens_stay():
    """What the lookahead calls stable at a cut is a prefix of the ids of any longer word."""
    made, draw = transducer_for(PATH).merges, random.Random(3)
    for _ in range(200):
        word = bytes(draw.choice(b"aabtheringon") for _ in range(draw.randint(2, 900)))
        cut = draw.randint(1, len(word))
        ids, full, done, stable = made.encode_word(word[:cut]), made.encode_word(word), 0, []
        for i in ids:
            done += len(made.bytes_of[i])
            if done > cut - made.lookahead:
                break
            stable.append(i)
        assert full[: len(stable)] == stable


def test_decoder_holds_unfinished_characters():
    made = transducer_for(PATH)
    ids, decoder = made.encode("漢字 é \U0001f600"), Decoder(made.merges)
    assert "".join(decoder.feed([i]) for i in ids) + decoder.feed([], True) == "漢字 é \U0001f600"


def test_round_trip_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in o7.op7_bpe(spark, sf_dir).collect():
        ids = ids_of(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
    again = o7.decode_documents(o7.encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20)))
    assert all(r.text == docs[r.doc_id] for r in again.collect())


def counted(text):
    return len(library("word_bpe_49k.json").encode(text or "", add_special_tokens=False).ids)


def test_counts_and_cache(spark, edge_docs, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(edge_docs.select("doc_id", "text"))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(((d is None, d or 0), len((t or "").encode()), counted(t), counted(t) > 2048) for d, t in texts)
    cache = str(tmp_path / "cache")
    for _ in range(2):
        got = o2.count_tokens(docs, cache).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    version = o2.tokenizer_digest(o2.vocabulary_path())
    kept = spark.read.parquet(f"{cache}/{version}")
    assert kept.count() == kept.select("digest").distinct().count()  # the second run appended nothing


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \t\n\r\x0b\x0cΣσǺ'<|>é漢 　")), max_size=40))
def test_normalising_keeps_the_count(text):
    import re

    assert counted(re.sub(r"[\t\n\x0b\f\r ]+", " ", text).strip(" ")) == counted(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("abT' LRSVE\n\t1é漢!<|>Σσǆ")), st.characters(codec="utf-8")), max_size=60))
def test_word_memo_counts_as_the_library(text):
    assert o2._counter(o2.vocabulary_path())([text]) == [counted(text)]


def test_counts_by_other_files():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["", "Some words, é 漢字.", " x  y "]
    assert o2._counter(path)(texts) == [len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t)) for t in texts]
    assert o2._counter(PATH)(texts) == [len(ids_of(t)) for t in texts]


def test_white_space_counts_where_the_tokenizer_keeps_it(spark, tmp_path):
    import sentencepiece

    texts = ["a  b\n\nc", " a b c ", "a b c", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for name, count in (("byte_bpe_50k.json", lambda t: len(ids_of(t))), ("piece_bpe_32k.model", lambda t: len(piece.encode(t or ""))), ("word_bpe_49k.json", counted)):
        got = o2.count_tokens(docs, str(tmp_path / name), public_tokenizers.path(name)).collect()
        assert {r.doc_id: r.n_tokens for r in got} == {k: count(t) for k, t in enumerate(texts)}, name


def check_packing(rows, texts, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, text in texts.items():
        ids = np.array([*ids_of(text), 2], dtype="<u4")
        at = 0
        for k, r in enumerate(sorted(by_doc.pop(doc), key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert k == 0 or r.length == capacity
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), sum(r.length for r in rows)


@pytest.mark.parametrize("shard", [50, 20_000])
def test_packing(spark, sf_dir, shard):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = o4.pack_documents(docs, shard_rows=shard).collect()
    n, total = check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, 1024)
    assert n <= -(-total // 1024) + 8


def test_packed_sequences_hold_the_ids(spark, edge_docs):
    docs = edge_docs.filter("doc_id < 8")
    got = o4.sequences(docs, capacity=64).collect()
    assert all(len(r.ids) == 4 * r.n <= 256 for r in got)
    assert sorted(np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])) == sorted(i for r in docs.collect() for i in [*ids_of(r.text), 2])


def test_sum_of_squares_rule():
    draw, capacity = random.Random(5), 30
    lengths = np.array([draw.randint(1, 30) for _ in range(300)])
    bins, offsets, fill = o4.sum_of_squares(lengths, capacity)
    open_, placed = [], []
    for s, b in zip(lengths.tolist(), bins.tolist(), strict=True):
        cost = {}
        for gap in {capacity, *(g for g in open_ if g >= s)}:
            after = list(open_)
            if gap < capacity:
                after.remove(gap)
            if gap - s:
                after.append(gap - s)
            cost[gap] = sum(after.count(g) ** 2 for g in set(after))
        if b < len(placed):
            gap = capacity - placed[b]
            open_.remove(gap)
        else:
            gap = capacity
            placed.append(0)
        assert cost[gap] == min(cost.values())
        placed[b] += s
        if capacity - placed[b]:
            open_.append(capacity - placed[b])
    assert placed == fill.tolist() and max(placed) <= capacity


def test_counts_of_a_hot_text(spark, tmp_path):
    """A third of all rows have one text, which is looked up by broadcast; the others twice or once, by their digests."""
    rows = [(k, "the one text" if k % 3 == 0 else f"text {k // 2}") for k in range(6000)]
    got = {r.doc_id: r.n_tokens for r in o2.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()}
    count = o2._counter(o2.vocabulary_path())
    assert got == {k: count([t])[0] for k, t in rows}
