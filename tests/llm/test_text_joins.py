"""op 3 and op 5 against brute force."""

import hashlib
import random
import re

from llm_helpers import SF001, alike_words, pairs

from rambler.llm.decontaminate import decontaminate
from rambler.llm.near_dup import Settings, least_matches, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contaminated(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = []
    for item, text in items:
        w = words(text)
        windows += [(item, w[i : i + size]) for i in range(max(1, len(w) - size + 1) if w else 0)]
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i : i + len(x)] == x:
                    hit.update(range(i, i + len(x)))
                    found.add(item)
        listed = sorted(str(i) for i in found if i is not None)
        yield repr((doc, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))


def test_decontamination_against_brute_force(spark, docs, odd, none):
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    own = [(90, "Word"), (91, "lorem IPSUM"), (92, None), (93, ""), (None, "der hund"), (94, "word"), (94, "word"), (95, " ".join("lorem ipsum dolor sit amet".split() * 3))]
    mixed = spark.createDataFrame([(*r, "t") for r in own], "item_id long, text string, token string")
    short = odd.filter("length(text) < 4000 OR text IS NULL")
    for d, b, listed in ((docs, bench, items), (short, mixed, own)):
        got = sorted(repr(tuple(r)) for r in decontaminate(d, b).collect())
        assert got == sorted(contaminated(pairs(d), listed))
    assert decontaminate(none, bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    # too many rows to broadcast: the same by shuffling
    assert sorted(map(repr, decontaminate(docs, bench, broadcast_rows=0).collect())) == sorted(map(repr, decontaminate(docs, bench).collect()))


def test_decontamination_counts_overlaps_once(spark):
    long = "lorem ipsum dolor sit amet " * 3000
    d = spark.createDataFrame([(1, long), (2, "a b c a b a b c")], "doc_id long, text string")
    b = spark.createDataFrame([(7, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet lorem"), (8, "a b"), (9, "b a b c")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate(d, b).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].n_items) == (15_000, 15_000, 1)
    assert (got[2].n_hit, got[2].n_items) == (7, 2)


def test_no_python_in_decontamination(docs, spark):
    plan = decontaminate(docs, spark.read.parquet(f"{SF001}/benchmark.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Cartesian" not in plan and "NestedLoop" not in plan


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components_by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and group[i] != group[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    group = [group[j] if g == group[i] else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    return sorted(repr((d, len(s), least[g], d == least[g])) for (d, _), s, g in zip(rows, sets, group))


def test_near_duplicates_against_brute_force(spark, docs, odd, none):
    rnd = random.Random(6)
    rows = []
    for family in range(6):          # an original, copies of it, copies of copies, and others that share a passage
        base = [f"w{rnd.randint(0, 10**6)}" for _ in range(rnd.choice([6, 30, 120, 400]))]
        for _ in range(12):
            copy = list(base)
            for k in rnd.sample(range(len(copy)), max(1, len(copy) // rnd.choice([20, 40, 60]))):
                copy[k] = f"e{rnd.randint(0, 10**6)}"
            rows.append((len(rows) * 7 % 101, " ".join(copy).upper() if rnd.random() < 0.2 else " ".join(copy)))
        rows.append((len(rows) * 7 % 101, " ".join(base[: len(base) // 2] + [f"z{rnd.randint(0, 10**6)}" for _ in range(len(base))])))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    for d in (made, docs.select("doc_id", "text"), odd):
        got = sorted(repr((r.doc_id, r.n_shingles, r.component_id, r.kept if r.doc_id is not None else r.doc_id == r.component_id))
                     for r in near_duplicates(d).collect())
        assert got == components_by_hand(pairs(d))
    assert near_duplicates(none).count() == 0


def test_near_duplicates_tell_long_words_apart(spark):
    rows = [(10 * n + k, f"{w} one two three four five") for n in (512, 1024) for k, w in enumerate(alike_words(n))]
    found = near_duplicates(spark.createDataFrame([(d, t.split()[0]) for d, t in rows] + [(d + 5, t) for d, t in rows], "doc_id long, text string"))
    assert all(r.kept for r in found.collect())


def test_near_duplicates_of_rows_without_ids(spark):
    """An id on many rows meets its own texts only."""
    rows = [(None, " ".join(f"w{k}x{i}" for i in range(30))) for k in range(600) for _ in range(2)] + [(7, "a b c d e f g")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(d).collect()
    assert len(got) == len(rows) and all(r.kept and r.component_id == r.doc_id for r in got) and sum(r.n_shingles for r in got) == 1200 * 26 + 3


def test_pruning_bound():
    s = Settings()
    least = least_matches(s)
    assert len(least) == 4 and all(0 < m < (k + 1) * s.batch for k, m in enumerate(least)) and sorted(least) == least
    # a pair at the threshold is dropped at the first batch with probability below 1e-3
    from math import comb
    p = 0.75 + 0.25 / 256
    assert sum(comb(32, m) * p**m * (1 - p) ** (32 - m) for m in range(least[0])) < 1e-3
