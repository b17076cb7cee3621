"""op 13 against a brute-force version."""

import hashlib
import random
import re
import zlib

import pytest
from llm_helpers import SF001, pairs

from rambler.llm.periodic_runs import best_run, periodic_runs
from rambler.llm.queries import op13_periodic_runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(words):
    """By the failure function."""
    fail, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = fail[k - 1]
        k += words[i] == words[k]
        fail[i] = k
    return len(words) - fail[-1]


def runs_of(words, least=24, times=3):
    """Every stretch that holds a period and can't grow, if that is its smallest period."""
    found = set()
    for q in range(1, len(words) // times + 1):
        begin = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                length = i + q - begin
                if length >= max(least, times * q) and smallest_period(words[begin : i + q]) == q:
                    found.add((begin, length, q))
                begin = i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in runs))


def results(docs, **kw):
    return sorted(repr((r.doc_id, r.n_words, [tuple(x) for x in r.runs], tuple(r.best) if r.best else None, r.collapsed)) for r in periodic_runs(docs, **kw).collect())


def wanted(rows, **kw):
    for doc, text in rows:
        words = WORDS.findall(text or "")
        runs = runs_of(words, **kw)
        yield repr((doc, len(words), runs, best_run(runs), collapsed(words, runs)))


def periodic_texts(seed):
    rnd = random.Random(seed)
    for k in range(150):
        words, letters = [], rnd.choice([1, 2, 3, 50])
        for _ in range(rnd.randint(1, 5)):
            unit = [f"w{rnd.randrange(letters)}" for _ in range(rnd.randint(1, 9))]
            if rnd.random() < 0.3:      # a period of periods
                unit = unit * rnd.randint(2, 5) + [f"x{rnd.randrange(3)}"]
            words += (unit * rnd.randint(1, 40))[: rnd.randint(1, 120)]
            if rnd.random() < 0.5 and words:
                words[rnd.randrange(len(words))] = "z"
        yield (k, rnd.choice([" ", "  ", "\n", " \t"]).join(words))


def test_runs_against_brute_force(spark, docs, odd, none):
    made = spark.createDataFrame(list(periodic_texts(3)), "doc_id long, text string")
    short = docs.filter("length(text) < 6000")
    for d in (made, short, odd.filter("length(text) < 20000 OR text IS NULL")):
        assert results(d) == sorted(wanted(pairs(d)))
    few = made.filter("doc_id < 60")
    assert results(few, least=4, times=4) == sorted(wanted(pairs(few), least=4, times=4))
    with pytest.raises(ValueError):
        periodic_runs(few, times=2)
    assert periodic_runs(none).count() == 0


def test_long_runs(spark):
    unit = [f"u{i}" for i in range(5000)]
    texts = [("lorem ipsum dolor sit amet " * 30_000).strip(), "x " * 200_000, " ".join(unit * 4), " ".join(f"{i}" for i in range(100_000))]
    got = {r.doc_id: r for r in periodic_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [[tuple(x) for x in got[i].runs] for i in range(4)] == [[(0, 150_000, 5)], [(0, 200_000, 1)], [(0, 20_000, 5000)], []]
    assert got[0].collapsed == "lorem ipsum dolor sit amet" and got[1].collapsed == "x" and got[2].collapsed == " ".join(unit) and got[3].collapsed == texts[3]


def test_ties_take_the_smallest_start_and_period():
    assert best_run([(5, 30, 10), (0, 60, 20), (0, 24, 8)]) == (0, 24, 8) and best_run([]) is None


def test_query_on_the_whole_table(spark):
    want = []
    for doc, text in pairs(spark.read.parquet(f"{SF001}/documents.parquet")):
        words = WORDS.findall(text or "")
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_of(words)
        s, n, p = best_run(runs) or (None, None, None)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{a},{b},{c}\n" for a, b, c in runs), collapsed(words, runs))]
        want.append(repr((doc, len(runs), s, n, p, 1000 * n // p if p else None, *digest)))
    assert sorted(repr(tuple(r)) for r in op13_periodic_runs(spark, SF001).collect()) == sorted(want)
