"""Merkle manifest against a tree built node by node."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm.cases import ODD
from telcolake.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(hashes):
    """Root, and per leaf the (left, right) siblings level by level."""
    paths, nodes = [[] for _ in hashes], [(h, [i]) for i, h in enumerate(hashes)]
    while len(nodes) > 1:
        parents = []
        for k in range(0, len(nodes), 3):
            run = [h for h, _ in nodes[k : k + 3]]
            for slot, (_, leaves) in enumerate(nodes[k : k + 3]):
                for i in leaves:
                    paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            parents.append((digest(*run), [i for _, leaves in nodes[k : k + 3] for i in leaves]))
        nodes = parents
    return nodes[0][0], paths


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {s: sorted(groups[s], key=lambda x: x[:3]) for s in sources}
    lower = {s: tree([x[2] for x in ordered[s]]) for s in sources}
    root, upper = tree([lower[s][0] for s in sources])
    out = []
    for s, above in zip(sources, upper):
        for (_, _, own, row), below in zip(ordered[s], lower[s][1]):
            path = below + above
            even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
            node = leaf((*row[:4], row[4] and row[4].replace("\n", ""))) if even else own
            for left, right in path:
                node = digest(left, node, right)
            out.append((row[0], own, lower[s][0], root, digest(*[a + b for a, b in path]), node, node == root))
    return sorted(out, key=repr)


def found(docs):
    rows = merkle.manifest(docs, also=merkle.tampered(docs))
    folded = merkle.fold(F.col("tampered_leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")), folded.alias("f"), (folded == F.col("root")))
    return sorted(map(tuple, rows.collect()), key=repr)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 243, 244, 1000])
def test_tree_of_one_source(docs_of, size):
    rows = [(i * 7 % 1009, f"a\nb {i}", "en", "s") for i in range(size)]
    docs = docs_of(rows)
    assert found(docs) == expected([(d, s, lang, len(t), t) for d, t, lang, s in rows])


def test_odd_rows(odd):
    plain = [tuple(r) for r in odd.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert found(odd) == expected(plain)


def test_many_sources_and_alike_rows(docs_of):
    rows = [(i, "x\n" * (i % 5), "en", None if i % 40 == 0 else f"s{i % 31}") for i in range(400)] + [(5, "same", "en", "s5")] * 300
    docs = docs_of(rows)
    assert found(docs) == expected([(d, s, lang, len(t), t) for d, t, lang, s in rows])


def test_no_rows(docs_of):
    assert merkle.manifest(docs_of([])).count() == 0


def test_shuffles_no_text(docs_of):
    docs = docs_of([(i, "a long text " * 50) for i in range(50)])
    rows = merkle.trees(docs.select("doc_id", "source", merkle.leaf([F.col(c) for c in merkle.COLUMNS]).alias("h")), ["source"], ["doc_id", "h"])[0]
    assert "text" not in rows.columns


def test_changes_are_named(docs_of):
    rows = [(i, f"text {i}", "en", f"s{i % 3}") for i in range(30)] + [(None, "no id", "en", "s0"), (4, "again", "en", "s1")]
    stored = merkle.manifest(docs_of(rows))
    later = [r for r in rows if r[0] != 7] + [(99, "new", "en", "s0")]
    later[2] = (2, "other text", "en", "s2")
    got = {(r.doc_id, r.status): r.rows for r in merkle.verify(docs_of(later), stored).collect()}
    assert got.pop((2, "changed")) == got.pop((7, "missing")) == got.pop((99, "added")) == 1
    assert {s for _, s in got} == {"same"} and sum(got.values()) == len(rows) - 2
