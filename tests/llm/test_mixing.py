import pytest

from shapelens.llm import mixing


def water_filling(sizes, weights, share, at_most):
    """Resharing round by round, as one would by hand."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= at_most * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            target[s] = at_most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_and_taken(documents):
    rows = mixing.mix_report(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    target = water_filling(sizes, [3, 1, 2], 1.5, 2)
    for r in rows:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
    for source in sizes:
        assert abs(taken[source] - target[source]) <= max(r.size for r in rows if r.source == source) / 2 + 1e-6


def test_hot_source_and_null_source(make):
    docs = make([(i, "w " * (i % 7 + 1), "en", "hot" if i % 3 else None if i % 2 else f"s{i % 5}") for i in range(600)])
    first, again = (sorted(map(tuple, mixing.mix(docs.repartition(n), [3, 1, 2], keep=["source"]).collect()), key=repr) for n in (2, 7))
    assert first == again and len(first) == 600
    assert {r[1] for r in first} == {"hot", None, "s0", "s1", "s2", "s3", "s4"}


def test_odd_rows(odd, make):
    mixed = mixing.mix(odd, [1.0], keep=odd.columns)
    rows = mixed.collect()
    assert len(rows) == odd.count() and mixed.columns.count("size") == 1
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert len({r.copies for r in rows if r.doc_id == 4}) == 1
    assert mixing.mix_report(make([(1, "x")]).where("doc_id > 1")).count() == 0
    nothing = mixing.mix_report(make([(1, None), (2, "")])).collect()
    assert [r.taken for r in nothing] == [0, 0] and [r.target for r in nothing] == [0.0, 0.0]
