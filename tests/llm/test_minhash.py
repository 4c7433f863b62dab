"""MinHash fingerprints and classes against plain versions."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cascata.llm import common, minhash, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, part string, kind int, node string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "p", 7, "n") for i, t in rows], DOCS)


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def plain_sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_print(text):
    """The definition, one shingle and one function at a time."""
    a, b, odd = minhash.factors()
    odd, full, out = [int(v) for v in odd], 2**64, np.full(128, 2**32 - 1, np.uint64)

    def stir(v):
        v = ((v ^ v >> 32) * 0x9E3779B97F4A7C15) % full
        v = ((v ^ v >> 29) * 0xC2B2AE3D27D4EB4F) % full
        return v ^ v >> 32

    for s in plain_sets(text):
        total = sum(xxhash.xxh64_intdigest(w, 11) * odd[k] for k, w in enumerate(s)) + len(s)
        x = np.uint64(stir(total % full) >> 32)
        out = np.minimum(out, (a * x + b) >> np.uint64(32))
    return "".join(f"{int(v):08x}" for v in out)


def likeness(x, y):
    return sum(x[i : i + 8] == y[i : i + 8] for i in range(0, 1024, 8)) / 128


def edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def expected(rows):
    """Results by hand; rows with unique ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, t) in enumerate(order):
        own, following = t or "", order[(k + 1) % len(order)][1] or ""
        changed = edited(own, following)
        prints = [plain_print(x) for x in (own, changed, following)]
        out[i] = (
            len(own), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1],
            likeness(prints[0], prints[1]), likeness(prints[0], prints[2]),
        )
    return out


def sample(rng):
    texts = [None, "", " \n\t ", "a", "日本 𝄞\x00  x é", "A b C d", "x" * 3000, sentence(rng, 4), sentence(rng, 20000)]
    texts += [sentence(rng, rng.choice([3, 8, 30, 90])) for _ in range(60)]
    rows = list(zip(rng.sample(range(-500, 4000), len(texts)), texts))
    return [*rows, (None, "no id é"), (9000, texts[20]), (9001, texts[20].upper())]


@pytest.mark.parametrize("partitions", [1, 13])
def test_fingerprints(spark, partitions):
    rows = sample(random.Random(3))
    got = minhash.fingerprint_documents(docs(spark, rows).repartition(5), partitions).collect()
    want = expected(rows)
    assert len(got) == len(rows) and want.keys() == {r.doc_id for r in got}
    for r in got:
        assert tuple(r)[1:7] == want[r.doc_id]


def test_equal_rows_and_ids(spark):
    rows = [(5, "a b"), (5, "a b"), (5, "c d e f"), (3, "x"), (None, None), (None, ""), (None, "z")] + [(1, "hot text")] * 300
    got = minhash.fingerprint_documents(docs(spark, rows).repartition(4), 3).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t or "")) for i, t in rows)
    for i, t in set(rows):
        same = {tuple(r) for r in got if r.doc_id == i and r.fingerprint == plain_print(t)}
        assert len(same) == 1
    one = minhash.fingerprint_documents(docs(spark, [(1, "abcd é")]), 2).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1
    assert minhash.fingerprint_documents(docs(spark, []), 2).count() == 0


def near_copies(rng):
    rows = []
    for k in range(60):
        body = sentence(rng, rng.choice([20, 100, 400])).split()
        rows.append((3 * k, " ".join(body)))
        near = list(body)
        near[len(near) // 2] = "changed"
        rows += [(3 * k + 1, " ".join(near)), (3 * k + 2, " ".join(body[: int(len(body) * 0.97)]))]
    big = sentence(rng, 300).split()
    for k in range(60):
        near = list(big)
        near[5 * k] = "other"
        rows.append((1000 + k, " ".join(near)))
    return rows


def test_classes(spark):
    rows = near_copies(random.Random(5)) + [(2000, "same"), (2001, "same"), (None, "same"), (2002, " "), (2003, "")]
    sets = [plain_sets(t) for _, t in rows]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b) - 1e-12
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if alike(sets[i], sets[j]) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    got = {r.doc_id: r.class_id for r in minhash.fingerprint_documents(docs(spark, rows), 4).collect()}
    want = {i: least.get(r) for (i, _), r in zip(rows, root)}
    # A pair at the very edge of similarity may miss all bands (five in a thousand).
    wrong = [i for i in want if want[i] != got[i]]
    assert len(wrong) <= 2, wrong
    assert {got[1000 + k] for k in range(60)} == {1000}


def family(rng, members, most):
    """Texts of one body, each with up to ``most`` of its words changed, and texts that share its first part."""
    body = sentence(rng, 200).split()
    texts = []
    for k in range(members):
        near = list(body)
        for _ in range(rng.randrange(most)):
            near[rng.randrange(200)] = f"own{rng.randrange(10**6)}"
        texts.append(" ".join(near[: rng.randrange(150, 201)]))
    return texts + [" ".join(body[:60]) + " " + sentence(rng, 150) for _ in range(20)] + ["", "\n", "a b", "a  b"]


@pytest.mark.parametrize("most", [4, 20])
def test_pairs_between_are_complete(spark, most):
    texts = family(random.Random(most), 50, most)
    given = spark.createDataFrame([(t.encode(), t) for t in texts], "node binary, text string")
    hashed = given.select("node", minhash.shingle_set(F.col("text")).alias("set"))
    sets = common.store(hashed.select("node", "set", F.size("set").alias("n"), minhash.parities(F.col("set")).alias("bits")))
    plain = {t.encode(): plain_sets(t) for t in texts}
    names = sorted(n for n in plain if plain[n])
    want = {
        (a, b) for k, a in enumerate(names) for b in names[k + 1 :]
        if len(plain[a] & plain[b]) >= 0.8 * len(plain[a] | plain[b]) - 1e-12
    }
    opened = given.select("node", F.col("node").alias("root"))
    pairs = minhash.pairs_between(opened, sets, 0.8)
    met = {(bytes(r.a), bytes(r.b)) for r in pairs.collect()}
    assert want <= met
    # Texts that only share their first part do not meet.
    shared = {t.encode() for t in texts[50:70]}
    assert not any(a in shared and b in shared for a, b in met)
    assert {(bytes(r.a), bytes(r.b)) for r in minhash.verified(pairs, sets, 0.8).collect()} == want
    # Texts of one group do not meet.
    assert minhash.pairs_between(opened.withColumn("root", F.lit(b"one")), sets, 0.8).isEmpty()


def test_open_sets_move_once(spark, monkeypatch):
    rows = [(bytes([k]), bytes([k]), list(range(k, k + 20))) for k in range(4)]
    frame = spark.createDataFrame(rows, "node binary, root binary, set array<long>").withColumn("n", F.size("set"))
    seen, count = [], minhash.counters_of
    monkeypatch.setattr(minhash, "counters_of", lambda held: seen.append(held) or count(held))
    found = minhash.pairs_between(frame.select("node", "root"), frame.drop("root"), 0.8)
    assert {(r.a[0], r.b[0]) for r in found.collect()} >= {(0, 1), (1, 2), (2, 3)}
    assert "Join" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_texts_move_compressed():
    texts = ["", None, "ção \U0001f600 " * 50, "x", "word " * 400]
    moved = minhash.packed(pa.array(texts))
    assert [minhash.unpacked(m) for m in moved.to_pylist()] == texts
    batch = pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(len(texts)), pa.int64()), "_h1": pa.array(range(len(texts)), pa.int64()),
        "node": pa.array([bytes([k]) for k in range(len(texts))], pa.binary()), "text": pa.array(texts),
    })
    starts = minhash.place_of(np.zeros(1, bool), np.array([2**62]), np.zeros(1, np.int64))
    dealt = [b for b in minhash.dealer(starts)([batch])]
    assert sum(b.column("text").nbytes for b in dealt) < 600


def test_likely_keeps_all_wanted(spark):
    texts = spark.range(3000).select(F.col("id"), minhash.node_of(F.col("id").cast("string")).alias("node"))
    wanted = texts.where("id % 10 = 0").select("node")
    kept = [r.id for r in minhash.likely(texts, wanted).collect()]
    assert set(range(0, 3000, 10)) <= set(kept) and len(kept) < 450
    assert minhash.likely(texts, wanted.limit(0)).isEmpty()


def test_parities_never_exceed_the_difference(spark):
    rng = random.Random(4)
    sets = [sorted({rng.randrange(-(2**63), 2**63) for _ in range(n)}) for n in (0, 1, 15, 16, 17, 40, 300, 3000)]
    sets += [s[: len(s) * 3 // 4] for s in sets]
    frame = spark.createDataFrame([(k, s) for k, s in enumerate(sets)], "k int, set array<long>")
    bits = {r.k: r.b for r in frame.select("k", minhash.parities(F.col("set")).alias("b")).collect()}
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            least = minhash.least_difference(*(minhash.pa.array([bytes(bits[k])]) for k in (i, j)))[0].as_py()
            assert least <= len(set(x) ^ set(y))


def test_estimates_are_close():
    rng = random.Random(8)
    for share in (0.2, 0.5, 0.9):
        a = sentence(rng, 600).split()
        b = a[: int(600 * share)] + sentence(rng, 600 - int(600 * share)).split()
        x, y = plain_sets(" ".join(a)), plain_sets(" ".join(b))
        rows = minhash.signatures([" ".join(a), " ".join(b)])
        assert abs(minhash.agreement(rows[:1], rows[1:])[0] - len(x & y) / len(x | y)) < 0.15


def test_query_over_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    want = expected(rows)
    got = queries.QUERIES["op11_minhash"](spark, SF)
    for r in got.collect():
        assert tuple(r)[1:7] == want[r.doc_id]
    column = queries.table(spark, SF, "documents").select("doc_id", minhash.fingerprint_column(F.col("text")).alias("f"))
    assert all(r.f == want[r.doc_id][2] for r in column.collect())
    assert np.mean([w[4] for w in want.values()]) > np.mean([w[5] for w in want.values()])
