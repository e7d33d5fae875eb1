import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from braidwork.llm import packing, tokenfiles, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'sLt 12.,!\n\t é日 \u0085", max_size=30))
def test_word_by_word_equals_whole(text):
    e = tokens.encoder(PATH)
    assert e.encode(text) == e.whole(text)


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y\nz <|endoftext|><|endoftext|>", "no <|endoftext| here", "a <|ENDOFTEXT|> b"])
def test_added_tokens_have_their_own_id(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens.encoder(PATH).encode(text), "<u4").tolist() == ids
    assert (50256 in ids) == ("<|endoftext|>" in text)


def test_packing(docs, rows, tokenizer):
    got = packing.packed_documents(docs, PATH).collect()
    expected = Counter()
    total = 0
    for r in rows:
        ids = [*ids_of(tokenizer, r[1]), 2]
        total += len(ids)
        at, piece = 0, 0
        while at < len(ids):
            n = len(ids) % 1024 or 1024 if at == 0 else 1024
            expected[(r[0], piece, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()))] += 1
            at, piece = at + n, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(sequences) <= 1.05 * -(-total // 1024) + 1


def test_placement_keeps_the_sum_of_squares_low():
    sequence, offset = packing.place(np.array([600, 500, 424, 400, 24]), 1024)
    assert len(set(sequence.tolist())) == 2 and offset.tolist()[0] == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=400), st.integers(0, 60000))
def test_file_round_trip(ids, low):
    ids = np.array(ids + [low] * 200, dtype=np.uint32)
    file = tokenfiles.TokenFile(tokenfiles.encode_file(ids))
    assert (file.ids() == ids).all()
    assert all((file.block(i) == ids[128 * i : 128 * (i + 1)]).all() for i in range(file.blocks))


def test_empty_file_and_bad_file():
    assert len(tokenfiles.TokenFile(tokenfiles.encode_file(np.zeros(0, np.uint32))).ids()) == 0
    with pytest.raises(ValueError):
        tokenfiles.TokenFile(b"other bytes that are no file")


def test_token_files(docs, rows, tokenizer, empty):
    files = tokenfiles.write_token_files(docs, PATH, 0, file_ids=500)
    got = tokenfiles.read_token_files(files).collect()
    each = [(r[0], [*ids_of(tokenizer, r[1]), 0]) for r in rows]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in each)
    before = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == before
        before += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert files.count() > 5
    assert tokenfiles.read_token_files(tokenfiles.write_token_files(empty, PATH)).count() == 0
    assert packing.packed_documents(empty, PATH).count() == 0


def test_ids_of_many_rows_lie_in_several_files(spark, tokenizer):
    """A third of the rows has no id, another third is one row again and again: no range holds them all, and starts run on."""
    rows = [(None, f"text {i}") for i in range(300)] + [(7, "the same row")] * 300 + [(100 + i, f"other {i}") for i in range(300)]
    files = tokenfiles.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), PATH)
    sizes = [sum(len(r.doc_ids) for r in files.collect() if r.part == p) for p in {r.part for r in files.collect()}]
    assert sum(sizes) == 900 and len(sizes) == 4 and max(sizes) < 420
    got = sorted(map(tuple, tokenfiles.read_token_files(files).collect()), key=lambda r: r[1])
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    order = [r[0] for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    want = Counter((i, len(ids_of(tokenizer, t)) + 1, zlib.crc32(np.array([*ids_of(tokenizer, t), 0], "<u4").tobytes())) for i, t in rows)
    assert Counter((r[0], r[2], r[3]) for r in got) == want
