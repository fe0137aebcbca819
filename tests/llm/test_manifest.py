"""Merkle manifest against a tree that is kept whole."""

import hashlib
import zlib

import cases
import pytest
from fleetfold.llm import manifest
from pyspark.sql import functions as F


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def whole(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at - at % 8 : at - at % 8 + 8]
        out.append((at % 8, run[: at % 8] + run[at % 8 + 1 :]))
        at //= 8
    return out


def expected(rows, tamper):
    """(id, leaf, subroot, root, proof digest, folded root) by definition."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, members = [], []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        members.append(own)
        trees.append(whole([leaf(r) for r in own]))
    upper = whole([t[-1][0] for t in trees])
    root = upper[-1][0] if trees else None
    out = []
    for number, (own, tree) in enumerate(zip(members, trees)):
        for at, row in enumerate(own):
            proof = path(tree, at) + path(upper, number)
            node = leaf(tamper(row))
            for place, others in proof:
                node = h(*others[:place], node, *others[place:])
            out.append((row[0], leaf(row), tree[-1][0], root, h(*[o for _, others in proof for o in others]), node))
    return sorted(out, key=repr)


def lowered(row):
    hit = row[0] is not None and row[1] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
    return (row[0], cases.re.sub("[A-Z]", lambda m: m.group().lower(), row[1]), *row[2:]) if hit else row


def found(df, stride=manifest.STRIDE):
    hit = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").isNotNull()
    low = [manifest.lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in manifest.FIELDS]
    proofs = manifest.Manifest(df, changed=F.when(hit, manifest.leaf(low)), stride=stride).proofs()
    return cases.rows(proofs, "id", "leaf", "subroot", "root", "proof_sha256", "folded_root")


def test_edge_rows(spark):
    docs = cases.edge_docs(spark).withColumns({c: F.lit("own") for c in ("pos", "part", "parts", "nodes", "above", "changed", "one")})
    assert found(docs) == expected(cases.EDGE_ROWS, lowered)
    empty = manifest.Manifest(cases.empty_docs(spark))
    assert empty.root() is None and empty.proofs().count() == 0


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_trees_of_all_shapes(spark, stride):
    """One row, a run, a run and one, a subtree, a subtree and one, and more languages than a run holds."""
    sizes = {"a": 1, "b": 8, "c": 9, "d": 64, "e": 65, "f": 513, "": 2, None: 3, "é": 73, "und": 1, "z": 7}
    rows = [(7 * k + len(lang or ""), f"Text {k} OF {lang}", lang, "s", k) for lang, n in sizes.items() for k in range(n)]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    got = found(docs, stride)
    assert got == expected(rows, lowered)
    tampered = [r for r in rows if lowered(r) != r]
    assert sum(g[5] != g[3] for g in got) == len(tampered) > 0


def test_one_language_has_its_subroot_as_root(spark):
    rows = [(1, "only", "en", None, None)]
    (only,) = found(spark.createDataFrame(rows, cases.SCHEMA))
    assert only == (1, leaf(rows[0]), leaf(rows[0]), leaf(rows[0]), h(""), leaf(rows[0]))


def test_packed_proofs_fold_to_the_root(spark):
    rows = [(k, f"t{k}", "ab"[k % 2], None, 1) for k in range(40)]
    tree = manifest.Manifest(spark.createDataFrame(rows, cases.SCHEMA))
    for r in tree.proofs().collect():
        unpacked = manifest._unpack(bytes(r.proof))
        assert manifest.fold(r.leaf, unpacked) == r.root == tree.root()
        assert manifest.fold(manifest.fold("00" * 32, []), unpacked) != r.root
