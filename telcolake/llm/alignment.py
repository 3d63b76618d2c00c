"""Alignment of two tokenizers over all texts, each distinct text tokenised and aligned once.

Texts are grouped by their full text, so copies (however many) reach the tokenizers as one
row with its multiplicity. Both token rows of a text are cut at the byte offsets where a
token of either ends; each span between two cuts lies in one token of A and one of B and is
one link. Pairs are counted over the corpus with the multiplicity of their text as weight,
the counts are looked up for the links of each distinct text, and the measures are joined to
the doc_ids through the text's SHA-256.

Both tokenizers cut between a visible character and white space, so a text is the row of its
words; the alignment of a word is computed once per Python process and memoised. A text
with white space that some piece joins to what is before it (a carriage return, say) is
taken as one word.

Large data: copies are counted before the texts are shuffled. Links are stored as 4 bytes (8
for vocabularies over 65,536 ids). Pair counts are added up per task before their shuffle.
They reach the scoring tasks in blocks of ``PAIR_BLOCK`` pairs, one pass over the links per
block, so any number of pairs works and no more than a block is broadcast at once. Measures of
the few texts with so many copies that their rows would fill a task are broadcast, all others
are joined by shuffle.

Defined cases: a null or empty text, and one whose tokens of A or B don't give back its bytes
with a space before it, has no tokens: zeros, and an empty ``groups_sha256``; repeated and
null doc_ids are rows of their own; texts of any length are taken whole; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolake.llm.common import join_hot, ready, remove, written
from telcolake.llm.tokens import WITH_SPACE, batches

# Words kept per Python process in each of two generations, and the longest that is kept.
MEMO_WORDS = 250_000
MEMO_CHARS = 64
# Distinct pairs that a task adds up before it passes them on.
PAIRS_IN_TASK = 4_000_000
# Pairs in one broadcast: 17 bytes each.
PAIR_BLOCK = 2_000_000

# Words encoded by one call of A, with a special token between them.
JOINED = 400
_MARK = "<|endoftext|>"
_JOINED = re.compile(r"(?<=\S)\s").findall
_aligners: dict[tuple[str, str], "Aligner"] = {}


def _byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write for the 256 bytes: printable ones as they are, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


# Alignment of a word or text: its groups as text, its links as packed id pairs, its tokens of A.
Word = tuple[bytes, bytes, int]


class Aligner:
    """Align texts by a byte-level tokenizer file (A) and a sentence-piece model (B)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.marked = Tokenizer.from_file(a_path)
        self.mark = self.marked.token_to_id(_MARK)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_alphabet()
        entries = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = {i: bytes(alphabet[c] for c in entry) for entry, i in entries.items() if all(c in alphabet for c in entry)}
        self.b_bytes = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (self.b.is_unknown(i) or self.b.is_control(i)):
                self.b_bytes[i] = piece.replace("▁", " ").encode()
        self.wide = max(max(self.a_bytes), max(self.b_bytes)) >= 1 << 16
        self.a_sizes, self.b_sizes = (_sizes(of) for of in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = _Spelling(max(self.a_bytes), b",|"), _Spelling(max(self.b_bytes), b",;")
        pieces = [self.b.id_to_piece(i).replace("▁", " ") for i in self.b_bytes]
        # White space before which a text may not be cut; a piece with a line feed allows no cut at all.
        self.joined = {" "} if any("\n" in p for p in pieces) else {c for p in pieces for c in _JOINED(p)}
        # What B puts before a line feed, and the line feed: cut off again where a word must not get B's space.
        self.lead = len(self.b.encode("\n"))
        # Words seen lately, and those seen before them: frequent words are never forgotten.
        self.memo: dict[str, Word | None] = {}
        self.older: dict[str, Word | None] = {}

    def words(self, text: str) -> list[str]:
        """The words of the text with a space before it."""
        text = " " + text
        return [text] if any(c in text for c in self.joined) else WITH_SPACE(text)

    def tokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A of all words end to end and their number by word; the same of B."""
        alone = [self.mark is None or "<|" in w or "|>" in w for w in words]
        together = [w for w, own in zip(words, alone) if not own]
        groups = [together[i : i + JOINED] for i in range(0, len(together), JOINED)]
        joined = self.marked.encode_batch_fast([_MARK.join(g) + _MARK for g in groups], add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int64) for e in joined]) if joined else np.zeros(0, np.int64)
        ends = np.flatnonzero(ids == self.mark)
        a, n_a = np.delete(ids, ends), np.diff(ends, prepend=-1) - 1
        if any(alone):
            each = iter(np.split(a, np.cumsum(n_a)[:-1]))
            own = iter(self.a.encode_batch_fast([w for w, x in zip(words, alone) if x], add_special_tokens=False))
            rows = [np.array(next(own).ids, np.int64) if x else next(each) for x in alone]
            a, n_a = np.concatenate(rows), np.array([len(r) for r in rows])
        spaced = [len(w) > 1 and w[0] == " " for w in words]  # B puts no space before nothing
        of_b = self.b.encode([w[1:] if s else "\n" + w for s, w in zip(spaced, words)], num_threads=1)
        of_b = [ids if s else ids[self.lead :] for s, ids in zip(spaced, of_b)]
        n_b = np.array(list(map(len, of_b)))
        return a, n_a, np.fromiter(chain.from_iterable(of_b), np.int64, int(n_b.sum())), n_b

    def align(self, words: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> list[Word | None]:
        """Groups and links of each word's tokens; None if they don't give back its bytes.

        The words are laid end to end and aligned in one go: their ends are cuts of both.
        """
        raw = [w.encode() for w in words]
        whole = b"".join(raw)
        if not (_bytes(self.a_bytes, a) == whole == _bytes(self.b_bytes, b) and self._ends_meet(raw, a, n_a, b, n_b)):
            return self._align_fit(words, raw, a, n_a, b, n_b)
        end_a, end_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ends = np.zeros(len(whole) + 1, np.uint8)
        ends[end_a] = 1
        ends[end_b] |= 2
        cuts = np.flatnonzero(ends)
        kind = ends[cuts]
        of_a, of_b, both = (kind & 1).astype(bool), (kind & 2).astype(bool), kind == 3
        links = np.empty((len(cuts), 2), "<u4" if self.wide else "<u2")
        links[:, 0], links[:, 1] = a[np.cumsum(of_a) - of_a], b[np.cumsum(of_b) - of_b]

        # Tokens in the order of groups, those of A first in each.
        group = np.cumsum(both) - both
        group_a, group_b = group[of_a], group[of_b]
        numbers = np.arange(group[-1] + 1)
        place_a = np.arange(len(a)) + np.searchsorted(group_b, numbers)[group_a]
        place_b = np.arange(len(b)) + np.searchsorted(group_a, numbers, side="right")[group_b]
        width = max(self.a_text.width, self.b_text.width)
        spelled, sizes = np.empty(len(a) + len(b), f"S{width}"), np.empty(len(a) + len(b), np.int64)
        spelled[place_a], sizes[place_a] = self.a_text.of(a, both[of_a])
        spelled[place_b], sizes[place_b] = self.b_text.of(b, both[of_b])
        text, packed = spelled.tobytes().translate(None, b"\0"), links.tobytes()

        to = np.cumsum(sizes)[np.cumsum(n_a + n_b) - 1].tolist()
        cut_to = (np.searchsorted(cuts, end_a[np.cumsum(n_a) - 1], side="right") * 2 * links.itemsize).tolist()
        return [(text[x : y - 1], packed[u:v], n) for n, x, y, u, v in zip(n_a.tolist(), [0, *to], to, [0, *cut_to], cut_to)]

    def _ends_meet(self, raw: list[bytes], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> bool:
        """Whether each word, not only all of them together, is its tokens of A and of B."""
        ends = np.cumsum([len(r) for r in raw])
        if not (n_a.all() and n_b.all()):
            return False
        return all((np.cumsum(sizes[ids])[np.cumsum(n) - 1] == ends).all() for sizes, ids, n in ((self.a_sizes, a, n_a), (self.b_sizes, b, n_b)))

    def _align_fit(self, words, raw, a, n_a, b, n_b) -> list[Word | None]:
        """``align`` where some words are not their tokens."""
        of_a, of_b = np.split(a, np.cumsum(n_a)[:-1]), np.split(b, np.cumsum(n_b)[:-1])
        fit = [i for i, r in enumerate(raw) if _bytes(self.a_bytes, of_a[i]) == r == _bytes(self.b_bytes, of_b[i])]
        out: list[Word | None] = [None] * len(words)
        if fit:
            good = self.align([words[i] for i in fit], np.concatenate([of_a[i] for i in fit]), n_a[fit], np.concatenate([of_b[i] for i in fit]), n_b[fit])
            for i, word in zip(fit, good):
                out[i] = word
        return out

    def texts(self, texts: list[str]) -> list[Word | None]:
        """The alignment of each text."""
        collects = gc.isenabled()
        gc.disable()  # nothing here refers to itself, and the memo is large
        try:
            return self._texts(texts)
        finally:
            if collects:
                gc.enable()

    def _texts(self, texts: list[str]) -> list[Word | None]:
        split = [self.words(t) for t in texts]
        seen = set().union(*split)
        if len(self.memo) + len(seen) > MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        new = seen.difference(self.memo)
        found = {w: self.older[w] for w in new.intersection(self.older)}
        fresh = list(new.difference(found))
        if fresh:
            found.update(zip(fresh, self.align(fresh, *self.tokens(fresh))))
        self.memo.update(found)
        get = self.memo.__getitem__
        out: list[Word | None] = []
        for words in split:
            of = list(map(get, words))
            if None in of:
                out.append(None)
                continue
            groups, links, n_a = zip(*of)
            out.append((b";".join(groups), b"".join(links), sum(n_a)))
        for word in [w for w in fresh if len(w) > MEMO_CHARS]:
            del self.memo[word]
        return out


def _bytes(of: dict[int, bytes], ids: np.ndarray) -> bytes | None:
    try:
        return b"".join(map(of.__getitem__, ids.tolist()))
    except KeyError:  # no token that stands for bytes
        return None


def _sizes(of: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(of) + 1, np.int64)
    out[list(of)] = list(map(len, of.values()))
    return out


class _Spelling:
    """Ids in decimal with the mark that follows them: one inside a group, one at its end."""

    def __init__(self, greatest: int, marks: bytes):
        digits = [str(i).encode() for i in range(greatest + 1)]
        self.width = len(digits[-1]) + 1
        self.inside, self.last = (np.array([d + marks[k : k + 1] for d in digits], f"S{self.width}") for k in (0, 1))
        self.sizes = np.array([len(d) + 1 for d in digits])

    def of(self, ids: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.where(last, self.last[ids], self.inside[ids]), self.sizes[ids]


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python process for two files; workers are reused between tasks."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text, copies) of all texts with content."""
    return docs.filter("text is not null and text <> ''").groupBy("text").agg(F.count("*").alias("copies"))


_ALIGNED = "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, links binary"


def aligned_texts(texts: DataFrame, a_path: str, b_path: str, keep_groups: bool = False) -> DataFrame:
    """Measures and links of each distinct text; ``groups`` holds the alignment itself if asked for."""

    def run(parts):
        own = aligner(a_path, b_path)
        width = 8 if own.wide else 4
        for batch in parts:
            held, copies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in batches(held):
                rows = []
                for text, n, found in zip(held[part], copies[part], own.texts(held[part])):
                    digest = hashlib.sha256(text.encode()).digest()
                    if found is None:
                        rows.append((digest, n, 0, 0, 0, 0, "", None, b""))
                        continue
                    groups, links, n_a = found
                    n_groups, n_links = groups.count(b"|"), len(links) // width
                    n_b = n_groups + n_links - n_a  # each cut ends a token of A, of B, or of both
                    rows.append((digest, n, n_a, n_b, n_groups, n_links, hashlib.sha256(groups).hexdigest(), groups.decode() if keep_groups else None, links))
                kinds = (pa.binary(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_NAMES)

    return texts.select("text", "copies").mapInArrow(run, _ALIGNED)


_NAMES = [c.split()[0] for c in _ALIGNED.split(", ")]


def _keys(links: pa.Array, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Id pairs of all links of a batch as one number each, and the number of links by row."""
    sizes = np.array([len(x) for x in links.to_pylist()], np.int64) // (8 if wide else 4)
    ids = np.frombuffer(b"".join(links.to_pylist()), "<u4" if wide else "<u2").reshape(-1, 2)
    if wide:
        return ids[:, 0].astype(np.uint64) << np.uint64(32) | ids[:, 1], sizes
    return ids[:, 0].astype(np.uint32) << np.uint32(16) | ids[:, 1], sizes


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(keys) else weights


def pair_counts(aligned: DataFrame, wide: bool) -> DataFrame:
    """(pair, n, best): how many links of the corpus hold each id pair; best if no pair of its B id has more."""

    def count(parts):
        keys, sums = np.zeros(0, np.uint64 if wide else np.uint32), np.zeros(0, np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(sums)], names=["pair", "n"])

        for batch in parts:
            mine, sizes = _keys(batch.column(0), wide)
            mine, weights = _added(mine, np.repeat(batch.column(1).to_numpy(), sizes))
            keys, sums = _added(np.r_[keys, mine], np.r_[sums, weights])
            if len(keys) > PAIRS_IN_TASK:
                yield rows()
                keys, sums = keys[:0], sums[:0]
        yield rows()

    counted = aligned.select("links", "copies").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    right = F.expr("pair & 4294967295" if wide else "pair & 65535")
    counted = counted.withColumn("b", right)
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    return counted.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored_texts(aligned: DataFrame, pairs: DataFrame, wide: bool, block: int = PAIR_BLOCK) -> DataFrame:
    """(digest, n_best, count_sum) of each distinct text; ``pairs`` is looked up in blocks of about ``block`` rows."""
    spark = aligned.sparkSession
    blocks = max(1, -(-pairs.count() // block))
    parts = []
    for i in range(blocks):
        rows = pairs.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == i).toArrow()
        keys = rows.column("pair").to_numpy().astype(np.uint64 if wide else np.uint32)
        order = np.argsort(keys)
        shared = spark.sparkContext.broadcast((keys[order], rows.column("n").to_numpy()[order], rows.column("best").to_numpy(zero_copy_only=False)[order]))

        def score(batches_, shared=shared, i=i):
            keys, counts, best = shared.value
            for batch in batches_:
                mine, sizes = _keys(batch.column(1), wide)
                at = np.minimum(np.searchsorted(keys, mine), max(0, len(keys) - 1))
                found = keys[at] == mine if len(keys) else np.zeros(len(mine), bool)
                ends = np.r_[0, np.cumsum(sizes)]
                sums = [np.r_[0, np.cumsum(np.where(found, of[at] if len(keys) else 0, 0).astype(np.int64))] for of in (best, counts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums]], names=["digest", "n_best", "count_sum"])

        parts.append(aligned.select("digest", "links").mapInArrow(score, "digest binary, n_best long, count_sum long"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole if blocks == 1 else whole.groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignment(docs: DataFrame, a_path: str, b_path: str, block: int = PAIR_BLOCK, keep_groups: bool = False) -> DataFrame:
    """(doc_id, measures) of every document of ``docs`` (doc_id, text); with ``groups``, the alignment, if asked for."""
    spark = docs.sparkSession
    ready(spark)
    wide = aligner(a_path, b_path).wide
    aligned, aligned_path = written(aligned_texts(distinct_texts(docs), a_path, b_path, keep_groups), "aligned-texts")
    pairs, pairs_path = written(pair_counts(aligned, wide), "pair-counts")
    scores, scores_path = written(scored_texts(aligned, pairs, wide, block), "text-scores")
    names = [*MEASURES, *(["groups"] if keep_groups else [])]
    measures, measures_path = written(aligned.drop("links").join(scores, "digest").select("digest", "copies", *names), "text-measures")

    rows = docs.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("_full"))
    full = rows.filter("_full").select("doc_id", "digest")
    found = join_hot(full, measures, "digest", "copies").select("doc_id", *names)
    none = [F.lit("").alias(n) if n == "groups_sha256" else F.lit(None).cast("string").alias(n) if n == "groups" else F.lit(0).cast("long").alias(n) for n in names]
    result, _ = written(found.unionByName(rows.filter("not _full").select("doc_id", *none)), "alignment")
    for path in (aligned_path, pairs_path, scores_path, measures_path):
        remove(spark, path)
    return result
