import random
from collections import Counter, defaultdict

import pyarrow as pa

from shapelens.llm import near_dup


def classes_by_hand(rows, words, least=0.8):
    """All pairs by plain Jaccard similarity of counted shingles (no weights by frequency)."""
    def shingles(text):
        w = words(text)
        return Counter(tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    close = 0
    by_shingle = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            by_shingle[g].append(k)
    for k, (i, s) in enumerate(sets):
        for m in {m for g in s for m in by_shingle[g] if m > k}:
            j, t = sets[m]
            similarity = sum((s & t).values()) / sum((s | t).values())
            if similarity >= least:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
            close += abs(similarity - least) < 0.015
    return {i: find(i) for i, _ in rows}, close


def test_classes_of_the_corpus(spark, plain_words):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want, _ = classes_by_hand([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], plain_words)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicate_report(docs).collect()}
    assert set(got) == set(want)
    wrong = [i for i in want if got[i] != want[i]]
    assert len(wrong) <= 2  # weights may move a pair that is near the threshold
    assert len(set(got.values())) < len(got)


def test_a_large_group_a_shared_passage_and_a_chain(make):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(120)]
    group = []
    for _ in range(150):  # one word changed: 5 of about 116 shingles differ
        copy = list(base)
        copy[rng.randrange(120)] = word()
        group.append(" ".join(copy))
    passage = " ".join(word() for _ in range(60))
    sharing = [passage + " " + " ".join(word() for _ in range(60)) for _ in range(120)]
    start = [word() for _ in range(200)]
    chain = [" ".join(start[8 * k:] + [f"c{j}" for j in range(8 * k)]) for k in range(4)]
    texts = group + sharing + chain + [" ".join(base).upper()] * 20
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(make(list(enumerate(texts)))).collect()}
    assert {got[i] for i in range(150)} == {0} and {got[i] for i in range(274, 294)} == {0}
    assert all(got[i] == i for i in range(150, 270))
    assert {got[i] for i in range(270, 274)} == {270}


def test_similarity_decides(make):
    words = [f"w{i}" for i in range(104)]  # 100 shingles
    other = lambda n: " ".join(words[:-n] + [f"x{i}" for i in range(n)])
    classes = lambda rows: {r.doc_id: r.class_id for r in near_dup.near_duplicates(make(rows)).collect()}
    one, two, three = (1, " ".join(words)), (2, other(9)), (3, other(14))
    assert classes([one, two]) == {1: 1, 2: 1}  # 91 of 109 shared
    assert classes([one, three]) == {1: 1, 3: 3}  # 86 of 114
    assert classes([one, two, three]) == {1: 1, 2: 1, 3: 1}  # 91 of 109 between the last two


def test_odd_rows(odd, make):
    got = near_dup.near_duplicates(odd).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1, 2, 3, 4, 4, 5, 6, 7] and all(r.class_id == r.doc_id for r in got)
    docs = make([(9, ""), (8, ""), (7, None), (6, None), (5, "a b"), (4, "A, b!"), (3, "a b c"), (None, "a b"), (5, "a b")], class_id=1, band=2)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == {9: 8, 8: 8, 7: 7, 6: 6, 5: 4, 4: 4, 3: 3, None: 4}
    left = near_dup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [3, 4, 6, 7, 8]
    assert near_dup.near_duplicates(docs.where("false")).count() == 0 == near_dup.drop_near_duplicates(docs.where("false")).count()


def test_rows_are_told_apart_by_id_and_text(make):
    one, two, three = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    docs = make([(5, one), (5, two), (5, one), (6, two), (None, one), (None, three), (None, three), (None, None), (None, None)])
    classes = sorted((r.doc_id or 0, r.class_id or 0) for r in near_dup.near_duplicates(docs).collect())
    assert classes == [(0, 0)] * 4 + [(0, 5)] + [(5, 5)] * 3 + [(6, 5)]
    left = sorted((r.doc_id or 0, r.text or "") for r in near_dup.drop_near_duplicates(docs).collect())
    assert left == sorted([(5, one), (5, two), (0, three), (0, "")])


def test_frequent_values_are_dealt_and_change_nothing(spark, make, monkeypatch):
    monkeypatch.setattr(near_dup, "SPREAD", 5)
    rows = spark.range(200).selectExpr("case when id < 90 then 1 when id < 95 then null else id end as k", "id as v")
    few = spark.range(150).selectExpr("id as k", "id * 2 as w")
    for how in ("inner", "left"):
        got = sorted(near_dup.join_frequent(rows, few, "k", how).select("k", "v", "w").collect(), key=str)
        assert got == sorted(rows.join(few, "k", how).select("k", "v", "w").collect(), key=str)
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(100)]
    group = [" ".join(words[:i] + ["x"] + words[i + 1:]) for i in range(60)]
    got = near_dup.near_duplicates(make(list(enumerate(group + [" ".join(words)] * 30 + ["something else " * 9])))).collect()
    assert {r.class_id for r in got if r.doc_id < 90} == {0} and len(got) == 91


def test_near_copies_in_a_group_of_a_third(make):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    more = lambda n: " ".join(word() for _ in range(n))
    base = more(104)  # 100 shingles
    copies = [base] * 560
    near = [base + " " + more(15 + i % 5) for i in range(60)]  # 0.80 to 0.84 to the base, 0.70 at most to each other
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(make(list(enumerate(copies + near + [more(12) for _ in range(1060)])))).collect()}
    assert [i for i in range(620) if got[i] != 0] == []
    assert all(got[i] == i for i in range(620, 1680))


def test_crowds_of_any_size_go_one_way(make, monkeypatch):
    """Texts at both sides of the threshold, in one crowd of many classes, by brute force."""
    monkeypatch.setattr(near_dup, "MOST", 1, raising=False)
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    base = [word() for _ in range(104)]
    rows = list(enumerate(" ".join(base + [word() for _ in range(rng.randrange(8, 40))]) for _ in range(200)))
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(make(rows)).collect()}

    shingler = near_dup.Shingler()
    weights = near_dup.count_shingles(make(rows))
    found = shingler(pa.array([t for _, t in rows]))
    w = weights.weights(found)
    sets = [dict(zip(found.hashes[s:e].tolist(), w[s:e].tolist())) for s, e in zip(found.starts, found.starts[1:])]
    parent = list(range(200))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(200):
        for j in range(i):
            both = sum(min(v, sets[j].get(k, 0)) for k, v in sets[i].items())
            if both >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    want = {i: find(i) for i in range(200)}
    assert 20 < sum(want[i] == i for i in want) < 180
    assert got == want
