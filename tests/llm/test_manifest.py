"""The manifest against a tree hashed in plain Python."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from chainlytics.llm import manifest as M

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, i, replaced, fanout):
    """(root, siblings of node i, root with it replaced), hashing everything anew."""
    proof, now = [], list(nodes)
    now[i] = replaced
    while len(nodes) > 1:
        first = i - i % fanout
        proof += nodes[first:i] + nodes[i + 1 : first + fanout]
        nodes, now = ([H(*level[k : k + fanout]) for k in range(0, len(level), fanout)] for level in (nodes, now))
        i //= fanout
    return nodes[0], proof, now[0]


def brute(rows, tampered, fanout=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), leaf_of(tampered(row))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {g: [(h, o, d) for _, d, h, o in sorted(groups[g])] for g in names}
    has = {g: [k for k, *_ in sorted(groups[g])] for g in names}
    subroots = [climb([h for h, _, _ in leaves[g]], 0, leaves[g][0][0], fanout)[0] for g in names]
    out = []
    for place, g in enumerate(names):
        for i, (h, other, doc_id) in enumerate(leaves[g]):
            subroot, low, changed = climb([x[0] for x in leaves[g]], i, other, fanout)
            root, high, folded = climb(subroots, place, changed, fanout)
            out.append((doc_id if has[g][i] else None, h, subroot, root, low + high, folded))
    return sorted(out, key=repr)


def found(spark, rows, changed=None, schema=SCHEMA, **more):
    proofs = M.build(spark.createDataFrame(rows, schema), changed, **more).proofs()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, list(r.siblings), r.folded_root) for r in proofs.collect()), key=repr)


def more_chars(row):
    hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
    return (*row[:3], row[3] + 1 if hit and row[3] is not None else row[3], row[4])


def changed():
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def documents(seed, n):
    rng = random.Random(seed)
    return [
        (rng.choice([None, i, i, -i, 5 * i]), rng.choice(["s", "", None]), rng.choice(["en", "en", "en", "fr", "", "é", "z", None]), rng.choice([None, 0, 17]), rng.choice([None, "", "text ü", "x" * 50]) )
        for i in range(n)
    ]


@pytest.mark.parametrize("n, block, fanout", [(1, 1024, 2), (2, 4, 2), (9, 4, 2), (150, 4, 2), (150, 8, 2), (150, 16, 3), (150, 4, 7), (150, 1024, 2)])
def test_as_hashed_anew(spark, monkeypatch, n, block, fanout):
    """Small blocks make several tiers in the groups' trees and over the groups."""
    monkeypatch.setattr(M, "BLOCK", block)
    rows = documents(n, n)
    assert found(spark, rows, changed(), fanout=fanout) == brute(rows, more_chars, fanout)


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 4)
    rows = [(i, "s", f"l{i % 23}", i, "t") for i in range(60)]
    assert found(spark, rows, changed()) == brute(rows, more_chars)


def test_only_changed_rows_fail(spark):
    rows = [(i, "s", "en", i, "t") for i in range(300)]
    bad = {r[0] for r in found(spark, rows, changed()) if r[5] != r[3]}
    assert bad == {i for i in range(300) if zlib.crc32(str(i).encode()) % 7 == 0}
    assert all(r[5] == r[3] for r in found(spark, rows))


def test_repeated_rows_long_texts_and_clashing_columns(spark):
    rows = [(1, "s", "en", 4, "same")] * 5 + [(2, "s", "en", 4, "long " * 200_000), (None, None, None, None, None)] * 2
    assert found(spark, rows, changed()) == brute(rows, more_chars)
    wide = [(*r, "g", 1, "x") for r in rows]
    assert found(spark, wide, changed(), SCHEMA + ", g string, i int, digest string") == brute(rows, more_chars)


def test_no_rows(spark):
    empty = M.build(spark.createDataFrame([], SCHEMA))
    assert empty.root is None and empty.proofs().isEmpty()


def test_folding_does_not_hash_what_is_left_of_a_slot():
    tree = M.Tree([H(str(i)) for i in range(8)], 4)
    nodes = list(tree.levels[0])
    nodes[2] = H("new")
    tree.levels[0][0] = "not read"
    assert tree.fold(2, H("new")) == M.Tree(nodes, 4).root
