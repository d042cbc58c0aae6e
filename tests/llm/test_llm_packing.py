from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallywork.llm import packing, tokens
from tallywork.llm.queries import op1_packing

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def held(pieces, encode, texts, width, end):
    """Every id of every row lies in one piece, windows have no gap and no overflow."""
    windows = {}
    by_doc = {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append(p)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= width
    for doc_id, text in texts.items():
        ids = np.array([*encode(text), end], "<u4")
        parts = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts[:-1]]))
        for p in parts:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    return len(windows), sum(p.length for p in pieces)


def test_whole_table(spark, folder, rows):
    pieces = op1_packing(spark, folder).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in rows}
    windows, ids = held(pieces, plain(BYTES), {r.doc_id: r.text for r in rows}, 1024, 0)
    assert windows <= ids / 1024 * 1.05 + 8


def test_odd_rows(odd, nothing):
    pieces = packing.pack(odd.drop("source").withColumnRenamed("lang", "start"), BYTES, 64, 0).collect()
    texts = {r.doc_id: r.text for r in odd.filter("doc_id not in (7, 9)").collect()}
    for doc_id, text in texts.items():
        assert sum(p.length for p in pieces if p.doc_id == doc_id) == len(plain(BYTES)(text)) + 1
    assert sum(p.length for p in pieces if p.doc_id == 7) == 2 * (len(plain(BYTES)("same text here now")) + 1)
    assert sorted(p.length for p in pieces if p.doc_id is None) == sorted([len(plain(BYTES)("no id at all")) + 1, 1])
    assert packing.pack(nothing, BYTES).count() == 0


@pytest.mark.parametrize("width", [1, 2, 7, 64])
def test_best_fit_is_tightest(width):
    rng = random.Random(width)
    for _ in range(50):
        lengths = sorted((rng.randint(1, width) for _ in range(rng.randint(0, 60))), reverse=True)
        rooms, fits = [], []
        for n in lengths:
            open_rooms = [r for r in rooms if r >= n] if n < width else []
            if open_rooms:
                rooms.remove(min(open_rooms))
            rooms.append((min(open_rooms) if open_rooms else width) - n)
            fits.append(width - rooms[-1] - n)
        windows, offsets = packing.best_fit(lengths, width)
        assert offsets == fits and len(set(windows)) == len(rooms)


TEXTS = ["", " ", "a", "a  b", " a", "a ", "a\n b", "\n", "a \nb", "don't we'll, 12 34abc.", "a\n\nb c", "ß ÉÀ ǅ Σας", "!!, a", ", a",
         "a., b", "a, , b", "\x01, a, b", "\x02a b", "a_, b", "é, a", "é ́b", "foo, bar. baz.\nqux,\nx.", "<|endoftext|> a",
         " x  y", "tab\tand\rmore"]


@pytest.mark.parametrize("path, keeps_space", [(BYTES, True), (WORDS, False)])
def test_word_by_word_ids_are_those_of_the_text(path, keeps_space, rows):
    encoder, encode = tokens.WordwiseEncoder(path, keeps_space), plain(path)
    texts = TEXTS + [r.text for r in rows[:60]]
    rng = random.Random(4)
    texts += ["".join(rng.choices("ab ,.\n'1!é", k=rng.randint(1, 30))) for _ in range(400)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encode(text), repr(text)
