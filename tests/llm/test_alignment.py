"""Alignment of two tokenizers against plain loops over all token pairs."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.cases import ODD
from telcolake.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
OWN = alignment.Aligner(A, B)
# Odd spaces, a carriage return that pieces join to what is before it, the mark that B writes for a space, special tokens.
TEXTS = [" lead", "a  b\n\n c\t d ", "x;\r\ny();\r\n", "has ▁ mark", "<|endoftext|> <s> <unk>", "\x00\x1c \x85\xa0", "ends\n", "\n", "naïve café ﬁ ①", "日本語のテキスト 😀"]


def ranges(ids, of):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + len(of[i])))
        at += len(of[i])
    return out


def plain(texts):
    """The contract's measures, every pair of tokens compared."""
    found = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a, b = OWN.a.encode(" " + (text or ""), add_special_tokens=False).ids, OWN.b.encode(text or "")
        if not text or b"".join(OWN.a_bytes[i] for i in a) != whole or b"".join(OWN.b_bytes[i] for i in b) != whole:
            found.append(None)
            continue
        ra, rb = ranges(a, OWN.a_bytes), ranges(b, OWN.b_bytes)
        links = [(x, y) for x, s, e in ra for y, t, u in rb if s < u and t < e]
        cuts = sorted({e for _, _, e in ra} & {e for _, _, e in rb})
        groups, before = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in r if before <= s and e <= cut) for r in (ra, rb)))
            before = cut
        found.append((len(a), len(b), len(cuts), links, ";".join(groups)))
    counts = Counter(p for f in found if f for p in f[3])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_best = sum(counts[p] == best[p[1]] for p in f[3])
        rows.append((*f[:3], len(f[3]), n_best, sum(counts[p] for p in f[3]), hashlib.sha256(f[4].encode()).hexdigest()))
    return rows


def of_whole(text):
    a, b = OWN.a.encode(" " + text, add_special_tokens=False).ids, OWN.b.encode(text)
    return OWN.align([" " + text], np.array(a), np.array([len(a)]), np.array(b), np.array([len(b)]))[0]


@pytest.mark.parametrize("text", TEXTS)
def test_odd_texts_have_the_alignment_of_the_whole_text(text):
    whole = of_whole(text)
    assert OWN.texts([text]) == [whole]
    assert (whole is None) == ("▁" in text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"abI'sé,.;)!_ \n\t\r\x1cΣ12|<>▁\xa0", "  ", "\r\n", " the", "<s>", "<0x0A>"]), min_size=1, max_size=30).map("".join))
def test_words_give_the_alignment_of_the_whole_text(text):
    whole = of_whole(text)
    assert OWN.texts([text]) == [whole]


def test_alignment_of_a_word_among_others():
    words = [" tokenization", "\n\nfoo", " ▁", " x", " naïve,", " ①②"]
    alone = [OWN.align([w], *OWN.tokens([w]))[0] for w in words]
    assert OWN.align(words, *OWN.tokens(words)) == alone and alone[2] is None and None not in alone[3:]
    assert OWN.align(words[3:], *OWN.tokens(words[3:])) == alone[3:]


def rows_of(df):
    return sorted(((r.doc_id, *[r[m] for m in alignment.MEASURES]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [alignment.PAIR_BLOCK, 20])
def test_measures_equal_plain_loops(docs_of, block):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "shared text, shared by many") for i in range(60)] + [(None, None), (3, "")]
    got = rows_of(alignment.alignment(docs_of(rows), A, B, block))
    assert got == sorted(((d, *m) for (d, _), m in zip(rows, plain([t for _, t in rows]))), key=repr)


def test_odd_rows(odd):
    short = [(d, t) for d, t, *_ in ODD if len(t or "") < 1000]
    got = rows_of(alignment.alignment(odd.filter("length(coalesce(text, '')) < 1000"), A, B))
    assert got == sorted(((d, *m) for (d, _), m in zip(short, plain([t for _, t in short]))), key=repr)
    long = alignment.alignment(odd, A, B, keep_groups=True).filter("doc_id = 6").first()
    assert long.n_links >= max(long.n_a, long.n_b) > 20_000
    assert hashlib.sha256(long.groups.encode()).hexdigest() == long.groups_sha256


def test_a_full_memo_starts_afresh(monkeypatch):
    own = alignment.Aligner(A, B)
    monkeypatch.setattr(alignment, "MEMO_WORDS", 3)
    texts = ["one two three", "four five six seven", "one " + "x" * 100, "two four"]
    assert [t for text in texts for t in own.texts([text])] == OWN.texts(texts)


def test_no_rows(docs_of):
    assert alignment.alignment(docs_of([]), A, B).count() == 0
    assert rows_of(alignment.alignment(docs_of([(1, None)]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_copies_are_encoded_once(docs_of):
    texts = alignment.distinct_texts(docs_of([(i, "copy") for i in range(500)] + [(1, "other")]))
    assert sorted(map(tuple, texts.collect())) == [("copy", 500), ("other", 1)]
