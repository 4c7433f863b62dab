"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cascata.llm import common, queries, spelling

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def plain_words(rows, letters=5, times=3):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= letters and n >= times}


def edits(word, alphabet):
    """All texts one edit away."""
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    out |= {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in alphabet}
    out |= {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in alphabet}
    return out - {word}


def plain(rows):
    words = plain_words(rows)
    alphabet = set("".join(words))
    out = {}
    for w, n in words.items():
        near = sorted(edits(w, alphabet) & words.keys(), key=lambda x: (-words[x], x))
        form = near[0] if near and words[near[0]] >= 2 * n else None
        out[w] = (form, n, len(near), words.get(form))
    return out


def check(got, rows):
    want = plain(rows)
    assert {r.word for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert (r.form, r.n, r.n_near, r.form_n) == want[r.word], r
        last = r.word
        while want[last][0]:
            last = want[last][0]
        assert r.root == last


def varied(rng, many):
    """Words with variants of variants, in texts of different ids."""
    base = ["".join(rng.choice("abcdeéÀñ×ÿinst") for _ in range(rng.choice([5, 6, 7, 12]))) for _ in range(25)]
    pool = list(base)
    for _ in range(many):
        w = list(rng.choice(pool))
        k = rng.randrange(len(w))
        if (kind := rng.randrange(3)) == 0:
            w[k] = rng.choice("abcdeéÀñ")
        elif kind == 1:
            w.insert(k, rng.choice("xyzeñ"))
        else:
            del w[k]
        pool.append("".join(w))
    weights = [1 / (1 + k % 40) for k in range(len(pool))]
    return [(i, " ".join(rng.choices(pool, weights, k=60)).replace("a", rng.choice("aA"))) for i in range(120)]


@pytest.mark.parametrize("most", [4096, 7])
def test_variants(spark, most):
    rng = random.Random(most)
    rows = varied(rng, 200) + [(None, None), (None, "wordsé Wordsé wordsé3wordsd"), (7, ""), (7, " \n"), (8, "z" * 400)] + [(9, "repeat rows")] * 200
    rows += [(500 + k, "z" * 400 + " " + "z" * 401) for k in range(3)]
    frame = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, n long, word string, h int")
    check(spelling.variants(frame.repartition(5), most=most).collect(), rows)


def test_small_chunks(spark):
    words = spark.createDataFrame([(w, k) for k, w in enumerate({"".join(p) for p in np.random.default_rng(3).permuted([list("abcde")] * 60, axis=1).tolist()} | {"abcd", "abcdef"})], "word string, n long")
    got = {r.word: r.n_near for r in spelling.near_words(words, most=3, many=5).collect()}
    held = [r.word for r in words.collect()]
    want = {w: n for w in held if (n := sum(spelling.one_apart(w, x) for x in held))}
    assert got == want


def test_one_apart():
    rng = random.Random(1)
    for _ in range(4000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(6))) for _ in range(2))
        assert spelling.one_apart(a, b) == (b in edits(a, "ab"))


def test_empty(spark):
    empty = queries.table(spark, SF, "documents").limit(0)
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "a bb ccc")], "doc_id long, text string")).count() == 0


def test_query_over_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    check(queries.QUERIES["op12_spelling"](spark, SF).collect(), rows)
