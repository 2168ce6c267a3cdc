import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from shapelens.llm import simhash

SIGN = 1 << 64


def brute(text):
    words = re.sub(r"[\x20\x09-\x0D]+", " ", text or "").strip(" ").split(" ")
    votes, total = [0] * 64, 0
    for i in range(max(1, len(words) - 2)):
        term, h = words[i: i + 3], 42
        for w in term:
            h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        weight = 0 if term[0] == "" else 1 + sum(len(w.encode()) > 3 for w in term)
        total += weight
        for b in range(64):
            votes[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


def test_report_equals_plain_code(documents):
    rows = documents.orderBy("doc_id").collect()
    got = {r.doc_id: r for r in simhash.fingerprint_report(documents).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows[:60] + rows[-2:]):
        i = i if i < 60 else len(rows) - 62 + i
        after = rows[(i + 1) % len(rows)].text
        n, quarter = len(row.text), len(row.text) // 4
        edited = row.text[: n - quarter] + after[:quarter]
        r = got[row.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (brute(row.text), brute(edited))
        assert r.near_edited == 1 - (brute(row.text) ^ brute(edited)).bit_count() / 64
        assert r.near_next == 1 - (brute(row.text) ^ brute(after)).bit_count() / 64
    mean = lambda name: sum(getattr(r, name) for r in got.values()) / len(got)
    assert mean("near_edited") > 0.7 > 0.55 > mean("near_next")


def test_block_tables_find_all_pairs(spark):
    import random

    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(150)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values]
    values += [v ^ (1 << 63) for v in values[:40]] + values[:5]
    signed = [v - SIGN if v >> 63 else v for v in values]
    got = {tuple(sorted((r.left % SIGN, r.right % SIGN))): r.distance
           for r in simhash.near_pairs(spark.createDataFrame([(v,) for v in signed], "fingerprint long")).collect()}
    distinct = sorted(set(values))
    want = {(a, b): (a ^ b).bit_count() for i, a in enumerate(distinct) for b in distinct[i + 1:] if (a ^ b).bit_count() <= 3}
    assert got == want and len(want) > 100


def test_large_buckets_lose_and_repeat_no_pair(spark):
    import random

    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {base}
    for _ in range(400):  # as if made from one template: most stand in one bucket of some table
        values.add(base ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(1, 4))}))
    values |= {rng.getrandbits(64) for _ in range(50)}
    prints = spark.createDataFrame([(v - SIGN if v >> 63 else v,) for v in values], "fingerprint long")
    ordered = sorted(values)
    want = {(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1:] if (a ^ b).bit_count() <= 3}
    for bucket in (0, 20, 10_000):
        got = [tuple(sorted((r.left % SIGN, r.right % SIGN))) for r in simhash.near_pairs(prints, bucket=bucket).collect()]
        assert len(got) == len(set(got)) and set(got) == want, bucket


def test_rows_of_one_id(make):
    docs = make([(1, "a b c d"), (1, "a b c d"), (1, "a b c d"), (1, "e f g h"), (2, "x y z"), (None, "q"), (None, "q")])
    got = sorted((r.doc_id or 0, r.fingerprint, r.n_chars) for r in simhash.fingerprint_report(docs).collect())
    print_of = lambda t: f"{brute(t):016x}"
    assert got == sorted([(1, print_of("a b c d"), 7)] * 3 + [(1, print_of("e f g h"), 7), (2, print_of("x y z"), 5)] + [(0, print_of("q"), 1)] * 2)


def test_odd_rows(odd, make):
    got = simhash.fingerprint_report(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    empty = "0" * 16
    assert by[1].fingerprint == by[2].fingerprint == by[3].fingerprint == empty and by[1].n_chars == 0
    assert len({r.fingerprint for r in got if r.doc_id == 4}) == 1
    assert by[None].near_next == 1.0 and by[5].n_chars > 500_000
    assert simhash.fingerprint_report(make([(1, "x")]).where("doc_id > 1")).count() == 0


def test_native(documents):
    plan = simhash.fingerprint_report(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
    assert F is not None
