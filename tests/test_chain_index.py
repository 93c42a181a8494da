import random
from pathlib import Path

import pytest

from chainlytics.plans import chain_index, tables
from conftest import rows

SCHEMA = "hash string, previousblockhash string, height int"


def tree(seed, size, forks=6):
    """Headers of a chain with forks of any depth, parents by name."""
    rng = random.Random(seed)
    parent, height, tips = {"h0": None}, {"h0": 0}, ["h0"]
    for i in range(1, size):
        tip = rng.randrange(len(tips))
        if rng.random() < forks / size:
            tips.append(rng.choice(list(parent)))
            tip = len(tips) - 1
        parent[f"h{i}"], height[f"h{i}"] = tips[tip], height[tips[tip]] + 1
        tips[tip] = f"h{i}"
    return parent, height


def line(parent, name):
    out = []
    while name is not None:
        out.append(name)
        name = parent[name]
    return out


def headers(spark, parent, height, names):
    return spark.createDataFrame([(n, parent[n], height[n]) for n in names], SCHEMA)


@pytest.fixture(scope="module")
def forked(spark, tmp_path_factory):
    """An index of 500 headers that arrived shuffled, in three batches, some twice."""
    parent, height = tree(3, 500)
    index = chain_index.chain_index(f"{tmp_path_factory.mktemp('index')}/index", 16)
    names = list(parent)
    random.Random(4).shuffle(names)
    for part in (names[:200], names[150:400], names[400:]):
        chain_index.extend(index, headers(spark, parent, height, part))
    return index, parent, height


def test_every_pointer_is_there_whatever_the_order(spark, forked):
    index, parent, height = forked
    want = []
    for name in parent:
        path = line(parent, name)
        want += [(k, height[name], name, path[4**k] if len(path) > 4**k else None) for k in range(5) if height[name] % 4**k == 0 and (k == 0 or len(path) > 4**k)]
    assert rows(tables.read(spark, index)) == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_common_ancestors_and_reorganisations(spark, forked, seed):
    index, parent, height = forked
    rng = random.Random(seed)
    old, new = (rng.choice(list(parent)) for _ in range(2))
    left, entered = line(parent, old), line(parent, new)
    meet = next(n for n in left if n in entered)
    at = [(n, height[n]) for n in (old, new)]
    assert chain_index.common_ancestor(spark, index, *at) == (meet, height[meet])
    found = {(r["side"], r["hash"]) for r in chain_index.reorganisation(spark, index, *at).collect()}
    assert found == {("leaving", n) for n in left[: left.index(meet)]} | {("entering", n) for n in entered[: entered.index(meet)]}


def test_a_new_tip_opens_the_bands_near_it_only(spark, root, monkeypatch):
    index = chain_index.chain_index(f"{root}/index", 16)
    parent = {f"h{i}": f"h{i - 1}" if i else None for i in range(600)}
    height = {f"h{i}": i for i in range(600)}
    chain_index.extend(index, headers(spark, parent, height, [f"h{i}" for i in range(597)]))
    opened = []
    real = tables._folders
    monkeypatch.setattr(tables, "_folders", lambda *args: opened.extend(args[3]) or real(*args))
    chain_index.extend(index, headers(spark, parent, height, ["h597", "h598", "h599"]))
    assert len([n for n in set(opened) if "=0-" in n]) <= 2 and len(set(opened)) < 12 < len(list(Path(index.path).glob("band16=*")))
    monkeypatch.undo()
    assert chain_index.ancestor(spark, index, ("h599", 599), 3) == ("h3", 3)


def test_chains_that_do_not_meet_and_missing_headers(spark, root):
    index = chain_index.chain_index(f"{root}/index", 16)
    data = [("a0", None, 0), ("a1", "a0", 1), ("b0", None, 0), ("b1", "b0", 1), ("c9", "gone", 9), (None, "a0", 1), ("x", "a0", None)]
    chain_index.extend(index, spark.createDataFrame(data, SCHEMA))
    chain_index.extend(index, spark.createDataFrame([], SCHEMA))
    assert chain_index.common_ancestor(spark, index, ("a1", 1), ("b1", 1)) is None
    assert rows(chain_index.reorganisation(spark, index, ("a1", 1), ("b1", 1))) == [("entering", "b0", 0), ("entering", "b1", 1), ("leaving", "a0", 0), ("leaving", "a1", 1)]
    assert chain_index.ancestor(spark, index, ("c9", 9), 2) is None
    assert chain_index.reorganisation(spark, index, ("a1", 1), ("a1", 1)).isEmpty()
