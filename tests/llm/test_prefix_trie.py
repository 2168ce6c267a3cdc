import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shapelens.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Every prefix of every rebuilt conversation, in plain Python."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest, len((text or "").encode()), role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        opener = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        full[c] = tuple(own.get(opener, [])[:h] + ts[h:])
    members, ends = {}, {}
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
        ends.setdefault(ts, []).append(c)
    children = {p: {q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p} for p in members}

    def below(p):
        return [p] + [x for q in children[p] for x in below(q)]

    out = set()
    for p, cs in members.items():
        under = below(p)
        out.add((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), sum(not children[x] for x in under),
                 sum((len(members[x]) - 1) * x[-1][0] for x in under if x), hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def report(spark, rows, **extra):
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    got = [tuple(r) for r in prefix_trie.trie_report(df).select(*COLUMNS).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_shared_openings_and_copies(spark):
    rows = []
    for c in range(60):
        for t in range(2 + c % 7):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"said {t} {c // 20 if t < 3 else c % 4}"))
    assert report(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "of no conversation"), (1, None, "user", "null turn"), (1, 0, None, "no role"), (1, 1, "user", None),
        (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "user", "tie"), (-3, 0, "user", "a"), (-3, 1, "assistant", "ÄÖ日本"), (0, 0, "user", "a"),
        (7, 0, "user", ""), (11, 5, "us", "era"), (12, 5, "user", "a"), (13, 0, "", ""), (9_000_000_000, 0, "user", "a"),
        (14, 0, "user", "lang " * 50_000),
    ]
    assert report(spark, rows, key="k", path=1, size=2, depth=3, h=4, opener=5) == plain(rows)


def test_long_conversations_need_no_round_per_turn(spark):
    rows = [(c, t, "user", f"turn {t}" if t < 900 else f"turn {t} of {c}") for c in (10, 15, 20) for t in range(1000 if c < 20 else 950)]
    assert report(spark, rows) == plain_counts(rows)


def plain_counts(rows):
    """The same for conversations 10, 15 and 20 alone, whose first 900 turns are alike."""
    size = lambda c, t: len((f"turn {t}" if t < 900 else f"turn {t} of {c}").encode())
    none = hashlib.sha256(b"").hexdigest()
    out = set()
    for d in range(901):
        out.add((10, d, 10 if d else None, 3, 3 if d == 900 else 1, 3, 2 * sum(size(10, t) for t in range(max(0, d - 1), 900)), none))
    for c, n in ((10, 1000), (15, 1000), (20, 950)):
        for d in range(901, n + 1):
            out.add((c, d, 10 if d == 901 else c, 1, 0 if d == n else 1, 1, 0, hashlib.sha256(str(c).encode()).hexdigest() if d == n else none))
    return out


def test_many_end_at_one_node(spark):
    rows = [(c, 0, "user", "hello") for c in range(0, 30_000, 5)] + [(1_000_000 + 5 * c, 0, "user", f"hello {c}") for c in range(50)]
    assert {r for r in report(spark, rows) if r[3] > 1} == {r for r in plain_hello() if r[3] > 1}


def plain_hello():
    alike = list(range(0, 30_000, 5))
    none = hashlib.sha256(b"").hexdigest()
    yield (0, 0, None, 6050, 51, 51, 5999 * 5, none)
    yield (0, 1, 0, 6000, 0, 1, 5999 * 5, hashlib.sha256(",".join(map(str, alike)).encode()).hexdigest())


def test_empty_table(spark):
    assert report(spark, []) == set()


@pytest.mark.parametrize("rows", [[(4, 0, "user", "x")], [(5, 0, "user", "x"), (6, 0, "user", "y")]])
def test_turnless_and_single(spark, rows):
    assert report(spark, rows) == plain(rows)
