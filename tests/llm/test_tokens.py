"""Token operators: exact ids, round trips, whole coverage."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from telcolake.llm import packing, token_files
from telcolake.llm.tokens import WordEncoder
from llm.cases import ODD

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ENCODERS = {n: WordEncoder(public_tokenizers.path(n)) for n in NAMES}


def ids_of(name, text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(list("abI'sé,.!_ \n\t\x1c ́Σ12|<>") + ["<|endoftext|>", ". ", ", "]), max_size=40).map("".join))
def test_words_give_the_ids_of_the_whole_text(name, text):
    assert np.frombuffer(ENCODERS[name].encode([text])[0], "<u4").tolist() == ENCODERS[name].exact.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=2000), st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    parts = token_files.pack_blocks(ids, 256, percentile)
    assert (token_files.unpack_blocks(*parts, len(ids), 256) == ids).all()


def test_outliers_become_exceptions():
    ids = np.full(512, 7, np.uint32)
    ids[100] = 50_000
    _, widths, exceptions, _, data = token_files.pack_blocks(ids, 512, 0.9)
    assert widths.tolist() == [0] and exceptions.tolist() == [1] and len(data) == 6


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_token_files_hold_all_ids_in_order(spark, odd, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(odd, path, public_tokenizers.path(NAMES[0]))
    rows = token_files.read_token_files(spark, path).orderBy("start").collect()
    expected = sorted(((d, ids_of(NAMES[0], t) + [2]) for d, t, *_ in ODD), key=lambda x: (x[0] is not None, x[0] or 0, crc(x[1])))
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0, crc(x[1])))
    assert got == expected
    at = 0
    for r in rows:
        assert (r.start, r.ids_crc32) == (at, zlib.crc32(r.ids))
        at += r.n_tokens
    assert [r.doc_id or 0 for r in rows] == sorted(r.doc_id or 0 for r in rows)


def test_token_files_of_nothing(spark, docs_of, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(docs_of([]), path, public_tokenizers.path(NAMES[0]))
    assert token_files.read_token_files(spark, path).count() == 0


def whole(pieces, window):
    """Every document lies in its pieces once, every window but the last is full."""
    docs, windows = {}, {}
    for p in pieces:
        docs.setdefault((p.doc_id, p.source, p.doc_tokens), []).append((p.start, p.length))
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for runs in windows.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= window
    full = [sum(n for _, n in v) for _, v in sorted(windows.items())]
    assert all(n == window for n in full[:-1])
    return docs, windows


def test_packing_of_odd_rows(odd, docs_of):
    pieces = packing.pack(odd, public_tokenizers.path(NAMES[1]), window=64).collect()
    whole(pieces, 64)
    assert sum(p.length for p in pieces) == sum(len(ids_of(NAMES[1], t)) + 1 for _, t, *_ in ODD)
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
    assert packing.pack(docs_of([]), public_tokenizers.path(NAMES[1])).count() == 0


def test_windows_hold_the_target_shares(docs_of):
    rows = [(i, "word " * 99, "en", "big" if i % 3 else "small") for i in range(600)]
    docs = docs_of(rows)
    got = packing.pack(docs, public_tokenizers.path(NAMES[1]), window=1000, shares={"small": 0.5, "big": 0.5}, keep_ids=False).collect()
    whole(got, 1000)
    early = [p for p in got if p.sequence_id < 30]
    share = sum(p.length for p in early if p.source == "small") / sum(p.length for p in early)
    assert abs(share - 0.5) < 0.05
    sequences = packing.sequences(packing.pack(docs, public_tokenizers.path(NAMES[1]), window=1000)).collect()
    assert sorted({len(s.ids) // 4 for s in sequences})[-1] == 1000


def test_tokens_are_read_in_short_arrow_batches(spark, docs_of, monkeypatch):
    seen = []
    real = packing.written
    monkeypatch.setattr(packing, "written", lambda df, label: (seen.append(spark.conf.get(packing.ARROW_ROWS)), real(df, label))[1])
    before = spark.conf.get(packing.ARROW_ROWS)
    rows = [(i, f"text {i} " * 5) for i in range(1500)]
    tokens, _ = packing.token_table(docs_of(rows), public_tokenizers.path(NAMES[1]))
    assert seen == [str(packing.TEXT_BATCH_ROWS)] and spark.conf.get(packing.ARROW_ROWS) == before
    tokenizer = Tokenizer.from_file(public_tokenizers.path(NAMES[1]))
    tokenizer.encode_special_tokens = True
    want = {i: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes() for i, t in rows}
    assert {r.doc_id: r.ids for r in tokens.collect()} == want
