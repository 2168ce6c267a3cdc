import random

from shapelens.llm import decontam


def brute(words, items, window=10):
    hit, found = set(), set()
    for item, tokens in items:
        size = min(window, len(tokens))
        for i in range(len(tokens) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j: j + size] == tokens[i: i + size]:
                    hit |= set(range(j, j + size))
                    found.add(item)
    return len(hit), sorted(found)


def test_search_equals_plain_code():
    rng = random.Random(5)
    for _ in range(200):
        letters = [b"a", b"b", b"c"][: rng.randint(1, 3)]
        text = lambda n: [rng.choice(letters) for _ in range(n)]  # noqa: E731, B023
        items = [(str(i), b" ".join(text(rng.randint(0, 14))).decode()) for i in range(5)]
        words = text(rng.randint(0, 40))
        ranges, found = decontam.hits_of(words, decontam.searches(items, 10))
        assert (sum(e - s for s, e in ranges), sorted(found)) == brute(words, [(i, t.encode().split()) for i, t in items])


def test_blocks_do_not_change_results(spark, documents, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = decontam.find_contamination(documents, benchmark, ["doc_id"])
    many = decontam.find_contamination(documents, benchmark, ["doc_id"], block_bytes=1500)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect())) and one.where("size(hit_items) > 0").count() > 0


def test_odd_rows(spark, odd, make):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "One"), (None, "日本語 x"), (4, "wort5 und5 wort6 und6 wort7 und7 wort8 und8 wort9 und9 wort10 und10")], "item_id long, text string")
    rows = {(r.doc_id, r.n_words): r for r in decontam.contamination_report(odd, items).collect()}
    assert rows[4, 1].n_hit == 1 and rows[1, 0].n_hit == rows[2, 0].n_hit == 0
    assert rows[5, 120_000].n_items == 1 and rows[5, 120_000].n_hit >= 12
    assert rows[6, 4].n_hit == 2
    assert decontam.contamination_report(odd, items.where("false")).where("contaminated").count() == 0
    assert decontam.contamination_report(odd.where("false"), items).count() == 0
    left = decontam.drop_contaminated(odd, items)
    assert left.columns == odd.columns and left.count() == odd.count() - 4
