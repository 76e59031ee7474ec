"""The Merkle manifest beside a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import edge
from edge import edge_docs, no_docs  # noqa: F401  fixtures
from shelfwise.llm import merkle_manifest as mm
from shelfwise.llm import queries


def plain_hash(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return plain_hash("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def plain_tree(nodes):
    """(root, for each node its siblings' lists and places from the leaf upwards)."""
    where, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, w in enumerate(where):
            run = nodes[w // 3 * 3: w // 3 * 3 + 3]
            paths[i].append((w % 3, run[:w % 3] + run[w % 3 + 1:]))
        nodes = [plain_hash(nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        where = [w // 3 for w in where]
    return nodes[0], paths


def plain(rows):
    """Sorted digests rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for (_, _, leaf, r), path in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1]):
            held = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                held = (*r[:4], r[4].replace("\n", ""))
            h = plain_leaf(held)
            for place, others in path + top:
                h = plain_hash(others[:place] + [h] + others[place:])
            proof = plain_hash(d for _, others in path + top for d in others)
            out.append((r[0], leaf, trees[s][0], root, proof, h, h == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def run(monkeypatch, spark, docs, levels):
    build = mm.manifest
    monkeypatch.setattr(queries, "table", lambda *a: docs)
    monkeypatch.setattr(mm, "manifest", lambda rows: build(rows, levels=levels))
    return got(queries.op11_merkle_descent(spark, ""))


def fields(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("levels", [2, 6])
def test_awkward_rows(monkeypatch, spark, edge_docs, levels):
    assert run(monkeypatch, spark, edge_docs, levels) == plain(fields(edge_docs))


@pytest.mark.parametrize("sizes", [[1], [1, 3, 9, 10, 27, 40]])
def test_tree_shapes(monkeypatch, spark, sizes):
    rows = [(100 * g + i, f"line\n{g} {i}" if i % 2 else "", "en", f"s{g}" if g else None, i, "x", 1, 1.0)
            for g, n in enumerate(sizes) for i in range(n)]
    docs = edge.frame(spark, rows)
    assert run(monkeypatch, spark, docs, 2) == plain(fields(docs))


def test_tampering_shows(monkeypatch, spark):
    docs = edge.frame(spark, [(i, "a\nb", "en", "s", 3, "x", 1, 1.0) for i in range(50)])
    for r in run(monkeypatch, spark, docs, 2):
        assert r[6] == (zlib.crc32(str(r[0]).encode()) % 2 == 1)


def test_empty_table(monkeypatch, spark, no_docs):
    assert run(monkeypatch, spark, no_docs, 6) == []


def test_requests_for_some_leaves(spark):
    docs = edge.frame(spark, [(i, str(i), "en", f"s{i % 2}", 1, "x", 1, 1.0) for i in range(60)])
    rows = docs.select("doc_id", "source", mm.leaf_digest([F.col(c) for c in mm.FIELDS]).alias("leaf"))
    m = mm.manifest(rows, levels=1)
    some = mm.proofs(m, m.placed.where("doc_id in (7, 40)"))
    found = some.withColumn("up", mm.folded(F.col("leaf"), F.col("proof"))).collect()
    assert sorted(r.doc_id for r in found) == [7, 40]
    assert all(r.up == r.root == m.root and r.n == 30 for r in found)
    assert mm.proofs(m, m.placed.limit(0)).count() == 0


def test_store_is_addressed_by_content(spark):
    docs = edge.frame(spark, [(i, str(i), "en", "s", 1, "x", 1, 1.0) for i in range(40)] + [(5, "5", "en", "s", 1, "x", 1, 1.0)] * 30)
    rows = docs.select("doc_id", "source", mm.leaf_digest([F.col(c) for c in mm.FIELDS]).alias("leaf"))
    m = mm.manifest(rows, levels=1)
    pages = m.store.collect()
    assert len({p.digest for p in pages}) == len(pages)
    for p in pages:
        assert [plain_hash(c) for c in p.children] == p.parents
    found = mm.proofs(m).withColumn("up", mm.folded(F.col("leaf"), F.col("proof"))).collect()
    assert len(found) == 70 and all(r.up == m.root for r in found)
