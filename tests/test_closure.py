import random

from conftest import rows

from codeloom.operators import closure, taxonomy

SCHEMA = "node string, parent string, label string"


def walk(data):
    """The plain walk upwards, node by node."""
    stated = {}
    for node, parent, label in data:
        if node is not None:
            stated.setdefault(node, set()).add((parent, label))
    out = []
    for node in stated:
        path, at, seen, fault = [], node, set(), None
        while True:
            if at in seen:
                path, fault = None, "cycle"
                break
            seen.add(at)
            ways = stated[at]
            path.insert(0, min((label for _, label in ways if label is not None), default=None))
            if len(ways) > 1:
                fault = "ambiguous"
                break
            (parent, _), = ways
            if parent is None:
                break
            if parent not in stated:
                fault = "orphan"
                break
            at = parent
        out.append((node, path, None if path is None else len(path) - 1, fault))
    return sorted(out, key=repr)


def found(spark, data):
    return rows(closure.closure(spark.createDataFrame(data, SCHEMA)), "node", "path", "depth", "fault")


def test_walks_of_random_rows(spark):
    rng = random.Random(5)
    data = [(f"n{i}", None if rng.random() < 0.1 else f"n{rng.randrange(130)}", f"l{i % 9}") for i in range(120)]
    data += [(f"t{i}", f"t{i // 2}" if i > 1 else None, f"t{i}") for i in range(1, 60)]
    data += [data[0], ("n3", "n4", "other"), (None, "n1", "x"), ("x", None, None), ("self", "self", "s")]
    got = found(spark, data)
    assert got == walk(data)
    assert {fault for *_, fault in got} == {None, "orphan", "ambiguous", "cycle"}


def test_deep_chain_a_wide_parent_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr("codeloom.operators.skew.fits_broadcast", lambda df: False)
    chain = [(f"c{i}", f"c{i - 1}" if i else None, str(i)) for i in range(70)]
    wide = [(f"w{i}", "c0", "w") for i in range(2000)]
    assert found(spark, chain + wide) == walk(chain + wide)
    assert found(spark, []) == []


def test_the_transaction_tree_as_rows(spark):
    paths = taxonomy.transaction_paths()
    cut = [tuple(x for x in p if x is not None) for p in paths]
    data = [("/".join(p), "/".join(p[:-1]) or None, p[-1]) for p in cut] + [(b, None, b) for b in {p[0] for p in cut}]
    tree = closure.closure(spark.createDataFrame(data, SCHEMA))
    assert {tuple(r.path) for r in tree.collect()} == set(cut) | {p[:1] for p in cut}
    pred = [(*p, True) for p in paths] + [("FEE ITEM ", "nsf/od", None, None, True), ("Fee item", None, None, None, False), (None, None, None, None, False)]
    shown = spark.createDataFrame(pred, "a string, b string, c string, d string, ok boolean")
    off = closure.off_tree(shown, ["a", "b", "c", "d"], tree, fewest=2)
    assert rows(off, "a", "ok") == [("Fee item", False), (None, False)]
    same = taxonomy.illegal_predictions(shown, ["a", "b", "c", "d"], paths)
    assert rows(off) == rows(same)
