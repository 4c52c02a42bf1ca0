"""Token files, packing and the piecewise encoder against the tokenizers library."""

from __future__ import annotations

import random
import string
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioforge.llm import common, packing, tokenfile, tokens
from odd import SMALL, no_documents, odd_documents, odd_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
EMPTY = pa.array([], pa.large_binary())


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.read_vocabulary(PATH))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from(" \n\t\r\u00a0\u2003\x1c'.,!abcdXYZ019é漢"), st.characters(codec="utf-8")), max_size=80))
def test_pieces_give_the_ids_of_the_whole_text(tokenizer, encoder, text):
    assert encoder.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_of_a_batch_are_looked_up_once_and_put_together(tokenizer):
    worker = tokens.Encoder(tokens.read_vocabulary(PATH))
    asked = []
    look_up = worker._behind_blanks
    worker._behind_blanks = lambda names: asked.append(names) or look_up(names)
    texts = ["Say word, say word. say word!", "", "a  run of  spaces ", "say word, (word)\nnext word,",
             " led by one", "word, word,", "\u00a0 über, straße.\u00a0", "one",
             " ".join(f"word{a}{b} é{b}{a} x{a}y{b}" for a in string.punctuation for b in "*'._3é")]
    found = [ids.tolist() for ids in worker.encode(texts)]
    assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    (names,) = asked
    assert len(names) == len(set(names)) and {"word,", "word.", "word!"} <= set(names)
    # Remembered without the marks.
    assert "word" in worker.cache and not {"word,", "word.", "word!"} & set(worker.cache)
    cut, counts = tokens.pieces(texts)
    assert counts.tolist() == [6, 1, 2, 4, 3, 2, 2, 1, 576] and len(cut) == counts.sum()


def test_pieces_forgotten_between_batches_are_taken_over(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 5)
    worker = tokens.Encoder(tokens.read_vocabulary(PATH))
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdeé", k=4)) + draw.choice(["", ",", "...", "-x", "\nnew"]) for _ in range(40)]
    for _ in range(20):
        text = " ".join(draw.choices(words, k=12))
        assert worker.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_what_an_encoder_remembers_has_its_own_limit(tokenizer):
    worker = tokens.Encoder(tokens.read_vocabulary(PATH), 50)
    for i in range(40):
        text = " ".join(f"w{chr(97 + i % 26)}{chr(97 + k)}{chr(97 + i // 26)}" for k in range(20))
        assert worker.encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(worker.cache) <= 70 and len(worker.older) <= 70


def test_pieces_with_numbers_and_lines_are_remembered_by_their_parts(tokenizer):
    worker = tokens.Encoder(tokens.read_vocabulary(PATH))
    texts = ["go x1y, x1y. x1y) end.\nNext (end).\nNext end,\nonce\nmore \u2014 caf\u00e9\u2026, 'tis-\u00bd", "go \u2026,\nx don't\nit's"]
    wanted = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids.tolist() for ids in worker.encode(texts)] == wanted
    assert {"x1y", "end", "(end", "don't"} <= set(worker.cache)
    assert not any("\n" in piece or piece[-1] in tokens.MARKS for piece in worker.cache)
    # Met again, alone or with other marks and lines, they are not asked for.
    worker._words = worker._unit = worker._together = lambda words: pytest.fail(words) if words else EMPTY
    assert worker.encode(["go x1y) end,\nNext"])[0].tolist() == tokenizer.encode("go x1y) end,\nNext").ids


def test_pieces_take_little_memory_and_survive_a_change_of_generations(tokenizer):
    worker = tokens.Encoder(tokens.read_vocabulary(PATH), 3000)
    draw = random.Random(5)
    for _ in range(6):
        texts = [" ".join(["always"] + ["".join(draw.choices("abc\u00e9dß", k=8)) for _ in range(40)]) for _ in range(50)]
        found = [ids.tolist() for ids in worker.encode(["go", *texts])]
        assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in ["go", *texts]]
    assert 0 < len(worker.older) and len(worker.cache) <= 5010
    for known in (worker.cache, worker.older):
        assert known.names.nbytes + known.ids.nbytes < 64 * len(known) + 64


def test_small_batches_are_encoded_together():
    rows = lambda n, at: pa.RecordBatch.from_pydict({"text": [str(at + i).zfill(100) for i in range(n)]})
    given = [rows(5, 10 * k) for k in range(7)]
    size = sum(batch.nbytes for batch in given[:3])
    found = list(common.gathered(iter(given), size))
    assert [batch.num_rows for batch in found] == [15, 15, 5]
    assert [x for b in found for x in b["text"].to_pylist()] == [x for b in given for x in b["text"].to_pylist()]
    assert list(common.gathered(iter([]), size)) == []


def test_strings_of_added_tokens_give_their_ids(encoder):
    plain = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "plain words", "<|endoftext|>", "x<|endoftext|>  <|endoftext|>\ny z",
             "<|endoftext |>", ""]
    found = [ids.tolist() for ids in encoder.encode(texts)]
    assert found == [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert found[0] == [64, 220, 50256, 275]


def expected(tokenizer, text, end):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4")


def test_code_lengths_are_limited_and_best():
    counts = np.array([0, 1, 1, 2, 3, 5, 8, 13, 21, 34, 55], np.int64)
    free = tokenfile.code_lengths(counts, 18)
    assert free[0] == 0 and free[1:].tolist() == [9, 9, 8, 7, 6, 5, 4, 3, 2, 1]
    short = tokenfile.code_lengths(counts, 4)
    assert short.max() == 4 and sum(2.0 ** -x for x in short[1:]) <= 1
    assert tokenfile.code_lengths(np.array([0, 7]), 4).tolist() == [0, 1]


def test_blocks_round_trip_and_start_at_their_marks():
    draw = random.Random(1)
    ids = np.array([min(int(draw.expovariate(0.05)), 300) for _ in range(3000)], np.uint32)
    lengths = tokenfile.code_lengths(np.bincount(ids))
    bits, marks = tokenfile.encode_bits(ids, tokenfile.canonical_codes(lengths), lengths)
    table = tokenfile.decode_table(lengths)
    assert (tokenfile.decode_bits(bits, marks, len(ids), table) == ids).all()
    third = tokenfile.decode_bits(bits, marks[16:24], tokenfile.BLOCK, table)
    assert (third == ids[2 * tokenfile.BLOCK : 3 * tokenfile.BLOCK]).all()


def test_bits_written_in_parts_are_those_written_at_once(monkeypatch):
    draw = random.Random(2)
    ids = np.array([min(int(draw.expovariate(0.01)), 5000) for _ in range(5000)], np.uint16)
    lengths = tokenfile.code_lengths(np.bincount(ids))
    codes = tokenfile.canonical_codes(lengths)
    found = []
    for at_once in (1, 7, 1000, 1 << 20):
        monkeypatch.setattr(tokenfile, "AT_ONCE", at_once)
        found.append(tokenfile.encode_bits(ids, codes, lengths))
    assert found[1:] == found[:-1]
    table = tokenfile.decode_table(lengths)
    assert (tokenfile.decode_bits(*found[0], len(ids), table) == ids).all()
    for n in (1, 255, 256, 257):
        some = tokenfile.encode_bits(ids[:n], codes, lengths)
        assert (tokenfile.decode_bits(*some, n, table) == ids[:n]).all()


def test_token_file_of_odd_rows(spark, tokenizer, fresh):
    tokenfile.write_token_file(odd_documents(spark), fresh)
    found = tokenfile.read_token_file(spark, fresh, keep_ids=True).orderBy("start").collect()
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in found] == [r[0] for r in rows]
    at = 0
    for row in found:
        assert row.start == at and row.n_tokens == len(row.ids) // 4
        assert row.ids_crc32 == zlib.crc32(row.ids)
        at += row.n_tokens
    wanted = sorted((r[0] is not None, r[0], expected(tokenizer, r[1], 0).tobytes()) for r in rows if r[0] is not None)
    assert sorted((True, r.doc_id, bytes(r.ids)) for r in found if r.doc_id is not None) == wanted


def test_token_file_of_nothing(spark, fresh):
    tokenfile.write_token_file(no_documents(spark), fresh)
    assert tokenfile.read_token_file(spark, fresh).count() == 0


def check_pieces(found, wanted):
    """Every id in exactly one piece, sequences gapless; gives the padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in found:
        assert zlib.crc32(row.ids) == row.ids_crc32 and len(row.ids) == 4 * row.length
        pieces[row.doc_id, row.doc_tokens].append(row)
        sequences[row.sequence_id].append(row)
    padding = 0
    for rows in sequences.values():
        at = 0
        for row in sorted(rows, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= packing.LENGTH
        padding += 0 if at & (at - 1) == 0 else packing.LENGTH - at
    for key, texts in wanted.items():
        rows = sorted(pieces[key], key=lambda r: r.start)
        if len(texts) == 1:
            assert b"".join(bytes(r.ids) for r in rows) == texts[0]
        assert sum(r.length for r in rows) * 4 == sum(map(len, texts))
    assert len(pieces) == len(wanted)
    return padding


def test_packing_of_odd_rows(spark, tokenizer):
    wanted = defaultdict(list)
    for row in odd_rows():
        ids = expected(tokenizer, row[1], 1)
        wanted[row[0], len(ids)].append(ids.tobytes())
    found = packing.pack(odd_documents(spark), keep_ids=True).collect()
    assert check_pieces(found, wanted) == 0


def test_packing_of_whole_documents(spark, tokenizer):
    docs = common.table(spark, SMALL, "documents")
    wanted = defaultdict(list)
    for row in docs.collect():
        ids = expected(tokenizer, row.text, 1)
        wanted[row.doc_id, len(ids)].append(ids.tobytes())
    assert check_pieces(packing.pack(docs, keep_ids=True).collect(), wanted) == 0
    assert packing.pack(no_documents(spark)).count() == 0


def test_a_piece_goes_where_it_fits_best_and_else_the_fullest_window_is_emitted():
    packer = packing.Packer(100, 2)
    piece = lambda doc, n: (doc, 0, np.arange(n, dtype="<u4"), n)
    assert list(packer.add(piece(1, 60))) == [] and list(packer.add(piece(2, 90))) == []
    assert list(packer.add(piece(3, 25))) == []  # fits the first window only
    (full,) = packer.add(piece(4, 10))  # both have room for it, the second exactly
    assert [p[0] for p in full] == [2, 4]
    assert list(packer.add(piece(5, 50))) == []
    (full,) = packer.add(piece(6, 70))  # none fits: the fullest is topped up
    assert [(p[0], len(p[2])) for p in full] == [(1, 60), (3, 25), (6, 15)]
