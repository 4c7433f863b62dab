"""Corpus operators against brute force, the vocabulary's own library and planted cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cascata.llm import (
    common,
    decontamination,
    line_dedup,
    quality_classifier,
    quality_rules,
    queries,
    sentencepiece_codec,
    sharding,
    simhash,
    toxicity,
    url_filters,
    warc,
)
from checks import compare

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "a", "日本 𝄞\x00  x", "▁▁ a  b ", "x" * 3000]
DOCS = "doc_id long, text string, _d string, ids string, score string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def docs(spark, rows):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "d", "i", "s") for i, t in rows], DOCS)


def odd_rows():
    return [*enumerate(ODD), (None, "a"), (3, "a"), (3, "a")]


def words_text(rng, n, base=4000):
    return " ".join(f"w{rng.randrange(base)}" for _ in range(n))


def test_piece_codec(spark):
    sp = pytest.importorskip("sentencepiece")
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, rng = sp.SentencePieceProcessor(model_file=path), random.Random(3)
    alphabets = ["ab ▁  ", "the and ing .,;!|*", "日本語ñéß\n\t\x00𝄞①  ▁x", "  　\n."]
    texts = ["".join(rng.choice(alphabets[k % 4]) for _ in range(rng.randrange(40))) for k in range(1500)]
    texts += [t or "" for t in ODD] + [" " * n + "a" for n in range(40)]
    rows = docs(spark, list(enumerate(texts)) + [(None, None)])
    coded = sentencepiece_codec.encode(rows, path)
    found = sentencepiece_codec.decode(coded, path).select("text", "ids", "decoded").collect()
    for r in found:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    model = sentencepiece_codec.PieceModel(sentencepiece_codec.read_model(path))
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(3, 32000)]) for _ in range(8)]
        assert model.decode(ids) == library.decode(ids)
    assert coded.limit(0).count() == 0


def test_op1_digests(spark):
    sp = pytest.importorskip("sentencepiece")
    import public_tokenizers

    library = sp.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, SF, "documents").collect()}
    for r in queries.QUERIES["op1_sentencepiece"](spark, SF).collect():
        ids = library.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_toxicity(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        body = [f"{rng.choice('abcdefg')}{rng.choice(['ran', 'lon', 'mit', 'sel'])}{rng.choice('oeiu')}" for _ in range(60)]
        if i % 2:
            body[::12] = ["moronic"] * 5
        rows.append((i, " ".join(body)))
        labels.append((i, i % 2))
    known = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    frame = docs(spark, rows)
    model = toxicity.fit(frame, known, per_class=120)
    scored = toxicity.score_documents(frame, model).toPandas()
    held = scored[scored.held_out]
    assert ((held.predicted == held.doc_id % 2).mean()) > 0.95
    assert model.word("morronic") > model.word("arano") and model.word("moronics") > 0
    odd = toxicity.score_documents(docs(spark, odd_rows()), model).toPandas()
    assert len(odd) == len(odd_rows()) and odd.score.between(0, 1).all()
    empty = toxicity.fit(frame.limit(0), known)
    assert set(toxicity.score_documents(frame, empty).toPandas().score) == {0.0}
    one = toxicity.fit(frame, known.where("toxic = 1"))
    assert set(toxicity.score_documents(frame, one).toPandas().predicted) == {1}


def test_folds(spark):
    got = spark.range(50).select("id", common.fold_of(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def overlapping(text, item):
    cut = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    d, b = cut(text), cut(item)
    width = min(len(b), 12)
    least = len(b) if len(b) < 12 else 10
    return bool(b) and any(
        sum(x == y for x, y in zip(d[i : i + width], b[j : j + width])) >= least
        for j in range(len(b) - width + 1) for i in range(len(d) - width + 1)
    )


def test_every_window_with_two_substitutions_has_a_seed():
    for a in range(12):
        for b in range(12):
            assert any(
                all(s + k not in (a, b) for k in mask) for mask in decontamination.MASKS for s in range(12 - mask[-1])
            )


def test_decontamination(spark):
    rng = random.Random(1)
    items = [(i, words_text(rng, n, 300)) for i, n in enumerate([30, 20, 12, 8, 3])] + [(9, ""), (None, None)]
    rows = odd_rows()
    for k in range(60):
        body = words_text(rng, 40, 300).split()
        passage = items[k % 5][1].split()
        for _ in range(k % 4):
            passage[rng.randrange(len(passage))] = "changed"
        at = rng.randrange(40)
        rows.append((100 + k, " ".join(body[:at] + passage + body[at:] if k % 3 else body)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = docs(spark, rows)
    got = {(r.doc_id, r.item_id) for r in decontamination.overlaps(frame, bench).collect()}
    want = {(d, i) for d, t in rows for i, x in items if overlapping(t, x)}
    assert got == want and len(want) > 20
    kept = decontamination.clean(frame, bench)
    assert kept.columns == frame.columns
    dirty = {d for d, _ in want}
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(d) for d, _ in rows if d not in dirty)
    assert decontamination.overlaps(frame.limit(0), bench).count() == 0
    assert decontamination.overlaps(frame, bench.limit(0)).count() == 0


def simple_print(text, width):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), 42) for i in range(max(1, len(w) - width + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(n, linked):
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root
    return root


def test_simhash_groups(spark):
    rng = random.Random(2)
    rows = odd_rows()
    for k in range(40):
        text = words_text(rng, 300)
        rows += [(1000 + 3 * k, text), (1001 + 3 * k, text.upper().replace(" ", "\n")), (1002 + 3 * k, text + " extra")]
    got = simhash.near_groups(docs(spark, rows), 3, 2).collect()
    prints = [simple_print(t, 3) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 2]
    root = grouped(len(rows), linked)
    least = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = Counter((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, root))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.near_groups(docs(spark, rows).limit(0)).count() == 0


def test_candidates_are_complete(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 60)
    values = set(base.tolist()) | {0}
    for v in base.tolist():
        for _ in range(6):
            values.add(v ^ int(sum(1 << int(b) for b in rng.choice(62, rng.integers(1, 5), replace=False))))
    values = sorted(values)
    frame = spark.createDataFrame([(v, [v]) for v in values], "node long, print array<long>")
    got = {(r.a, r.b) for r in simhash.candidates(frame, 3, 1).collect()}
    assert got == {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3}


def test_keep_one(spark):
    rng = random.Random(6)
    rows = [*odd_rows(), (900, "same text again"), (900, "same text again"), (900, "other"), (None, None), (None, "own")]
    for k in range(40):
        text = words_text(rng, 300)
        rows += [(1000 + 3 * k, text), (1001 + 3 * k, text.upper()), (1002 + 3 * k, text + " extra" if k % 2 else words_text(rng, 200))]
    prints = [simple_print(t, 3) for _, t in rows]
    linked = [(a, b) for a in range(len(rows)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 2]
    root, least = grouped(len(rows), linked), {}
    for (i, _), r in zip(rows, root):
        least[r] = min(least.get(r, (True, 0)), (i is None, i or 0))
    frame = docs(spark, rows)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    want = Counter(None if z else i for z, i in least.values())
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert simhash.keep_one(frame.limit(0)).count() == 0


def test_sharding(spark):
    rng = random.Random(8)
    rows = odd_rows() + [(i, "é" * rng.randrange(300)) for i in range(500)] + [(77, "hot")] * 300
    got = sharding.shard_documents(docs(spark, rows), 24).toPandas()
    want = Counter((i, 8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((None if np.isnan(a) else int(a), b, c) for a, b, c in zip(got.doc_id, got["size"], got.text_crc32)) == want
    assert set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    for _, shard in got.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    order = got.sort_values(["shard", "slot"]).doc_id.fillna(-1)
    assert order.is_monotonic_increasing
    sums, target = got.groupby("shard")["size"].sum(), got["size"].sum() / 24
    assert (abs(sums - target) <= got["size"].max()).all()
    assert sharding.shard_documents(docs(spark, rows).limit(0)).count() == 0


def removed_by_hand(rows, least):
    seqs = []
    for i, t in sorted(rows, key=lambda r: r[0]):
        seqs.append((i, [(n, x) for n, x in enumerate((t or "").split("\n")) if x.split()]))
    seen, gone = {}, set()
    for d, (i, seq) in enumerate(seqs):
        for s in range(len(seq)):
            for e in range(s + 1, len(seq) + 1):
                if sum(len(x.split()) for _, x in seq[s:e]) >= least:
                    key = tuple(x for _, x in seq[s:e])
                    if key in seen:
                        gone |= {(i, n) for n, _ in seq[s:e]}
                    else:
                        seen[key] = (d, s)
    return gone


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup(spark, seed):
    rng = random.Random(seed)
    bank = [words_text(rng, rng.choice([1, 2, 3, 7]), 50) for _ in range(12)] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(bank) for _ in range(rng.randrange(14)))) for i in range(40)]
    frame = docs(spark, rows)
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, 6).collect()}
    gone = removed_by_hand(rows, 6)
    assert len(gone) > 30
    for i, t in rows:
        assert got[i] == "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)


def test_line_dedup_keeps_odd_rows(spark):
    frame = docs(spark, odd_rows())
    out = line_dedup.dedup_lines(frame)
    assert Counter(map(str, out.collect())) == Counter(map(str, frame.collect()))
    assert line_dedup.dedup_lines(frame.limit(0)).count() == 0


def test_line_dedup_keeps_repeated_rows(spark):
    rng = random.Random(12)
    long = words_text(rng, 60) + "\n" + words_text(rng, 55)
    short = "\n".join(words_text(rng, 9) for _ in range(14))
    both = short + "\n\n" + long
    rows = [(1, long)] * 2 + [(2, short)] * 3 + [(3, both)] * 2 + [(4, "own\n" + long), (None, short), (None, short)]
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs(spark, rows)).collect())
    # Null ids come first, so the runs of 2 go; every copy of a document is treated alike.
    assert got == Counter({(None, short): 2, (1, long): 2, (2, ""): 3, (3, ""): 2, (4, "own"): 1})


def test_quality_rules(spark):
    rng = random.Random(9)
    clean = [(i, words_text(rng, 120)) for i in range(3000)]
    junk = [(5000 + i, " ".join(w + "***" for w in words_text(rng, 120).split())) for i in range(50)]
    labels = spark.createDataFrame([(i, 1) for i, _ in clean] + [(i, 0) for i, _ in junk] + [(None, 1)], "doc_id long, quality int")
    got = quality_rules.judge_documents(docs(spark, clean + junk + odd_rows()), labels).toPandas()
    assert not got[got.doc_id >= 5000].kept.any()
    # Ids 0 to 6 also name odd rows.
    good = got[(got.doc_id > 6) & (got.doc_id < 5000)]
    assert (~good.kept).mean() <= quality_rules.RISK
    none = quality_rules.judge_documents(docs(spark, clean[:20]), labels.limit(0)).toPandas()
    assert none.kept.all()
    assert quality_rules.counts("a b\na b\n\n#|") == (5, 6, 2, 1, 0, 3)
    assert quality_rules.counts("a b c d e x a b c d e")[4] == 10


def test_quality_rules_reject_on_few_rows(spark):
    rng = random.Random(13)
    sizes = [(30, 60), (120, 250), (400, 240), (1100, 40)]
    clean = [(1000 * k + i, words_text(rng, n)) for k, (n, many) in enumerate(sizes) for i in range(many)]
    junk = [(5000 + 100 * k + i, " ".join(w + "***" for w in words_text(rng, n).split())) for k, (n, _) in enumerate(sizes) for i in range(25)]
    labels = spark.createDataFrame([(i, 1) for i, _ in clean] + [(i, 0) for i, _ in junk], "doc_id long, quality int")
    got = quality_rules.judge_documents(docs(spark, clean + junk), labels).toPandas()
    assert not got[got.doc_id >= 5000].kept.any()
    assert (~got[got.doc_id < 5000].kept).mean() <= quality_rules.RISK


def test_joint_cutoffs():
    level = quality_rules.ERROR / 4
    least = quality_rules.least_good(0.02, level)
    assert least == 217 and quality_rules.tail(0, least, 0.02) <= level < quality_rules.tail(0, least - 1, 0.02)
    assert quality_rules.strata([78, 910, 1439, 214], least) == [[0, 1], [2, 3]]
    assert quality_rules.strata([50, 50, 50, 50], least) == []
    assert quality_rules.allowed({3: 1}, 216, 9, 0.02, level) == 0
    assert quality_rules.allowed({3: 1}, 217, 9, 0.02, level) == 3
    steps = quality_rules.path({("symbols", 90): 5}, {("long_words", 60): 9})
    assert len(steps) == len(set(steps)) == quality_rules.GRID * len(quality_rules.RULES)
    assert steps[quality_rules.GRID - 90] == ("symbols", 89)


def test_binomial_tail():
    from math import comb

    for n, k, p in ((50, 3, 0.1), (7, 0, 0.3), (9, 9, 0.2)):
        want = sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
        assert abs(quality_rules.tail(k, n, p) - want) < 1e-9


def test_quality_classifier(spark):
    rng = random.Random(10)
    rows = [(i, words_text(rng, 80) if i % 3 else "|".join(["BUY!!! NOW!!!"] * 30)) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows], "doc_id long, quality int")
    got = quality_classifier.score_documents(docs(spark, rows), labels).toPandas()
    held = got[got.held_out]
    assert (held.predicted == (held.doc_id % 3 > 0)).mean() > 0.97
    odd = quality_classifier.score_documents(docs(spark, odd_rows()), labels).toPandas()
    assert len(odd) == len(odd_rows()) and odd.score.between(0, 1).all()
    free = quality_classifier.score_documents(docs(spark, rows), labels.limit(0)).toPandas()
    assert (free.score == 1).all()
    at, value = quality_classifier.isotonic([0.1, 0.2, 0.3, 0.4], [0, 3, 1, 4], [4, 4, 4, 4])
    assert (np.diff(value) > 0).all() and len(at) == 3


def test_bloom_cascade_is_exact(spark):
    keys = spark.range(20000).select(*url_filters.key_hashes(F.col("id").cast("string")))
    listed = spark.range(0, 30000, 7).select(*url_filters.key_hashes(F.col("id").cast("string")))
    cascade = url_filters.build(keys, listed)
    rows = spark.range(20000).select("id", *url_filters.key_hashes(F.col("id").cast("string"))).toPandas()
    found = cascade.listed(rows._h1.to_numpy().view(np.uint64), rows._h2.to_numpy().view(np.uint64))
    assert (found == (rows.id % 7 == 0)).all() and len(cascade.levels) > 2
    assert url_filters.build(keys, listed.limit(0)).levels == []


@pytest.mark.parametrize("most", [url_filters.MOST_BYTES, 0])
def test_urls(spark, monkeypatch, most):
    monkeypatch.setattr(url_filters, "MOST_BYTES", most)
    urls = [
        (1, None, None), (2, "no scheme", "allow"), (3, "http://A.COM", "allow"), (4, "http://example.com/en/x", "block"),
        (5, "http://www.Example.com/en/", "allow"), (6, "x://net/es/?q", "block"), (7, "http://notexample.com/en/", "allow"),
        (8, "http://a.net/EN/", "allow"), (8, "http://a.net/fr/", "block"), (9, "http://", "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "x") for i, u, _ in urls], "page_id long, url string, rule string")
    got = url_filters.judge_pages(pages, queries.URL_RULES).collect()
    assert Counter((r.page_id, r.verdict) for r in got) == Counter((i, v or "allow") for i, _, v in urls)


def test_revisits(spark):
    kind = "record_id long, url string, at long, kind string, headers map<string,string>, digest string"
    rows = [
        (1, "http://a.com/x/", 10, "response", {"etag": "1", "server": "s"}, "A"),
        (2, "https://www.a.com/x#y", 20, "response", {"etag": "2", "date": "old"}, "B"),
        (3, "http://a.com/x", 15, "revisit", {"etag": "1", "server": "t"}, None),
        (4, "http://a.com/x", 25, "revisit", {"etag": 'W/2', "date": "new"}, None),
        (5, "http://a.com/x", 10, "revisit", {"etag": "1"}, None),
        (6, "http://a.com/x", 30, "revisit", {"etag": "1"}, None),
        (7, "http://a.com/x", 30, "revisit", None, None),
        (8, None, 30, "revisit", None, None),
    ]
    found = {r.record_id: r for r in warc.resolve(spark.createDataFrame(rows, kind)).collect()}
    assert {k: r.status for k, r in found.items()} == {3: "resolved", 4: "resolved", 5: "no_response", 6: "changed", 7: "unchecked"}
    assert found[3].headers == {"etag": "1", "server": "s"} and found[3].digest == "A"
    assert found[4].headers["date"] == "new" and found[4].response_id == 2
    assert warc.resolve(spark.createDataFrame([], kind)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_texts(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), compare.engine(SF), queries.ORACLE[name]) == []


def test_pipeline(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet").count()
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert 0 < len(rows) <= before and all(r.text == r.decoded for r in rows)
    assert len({r.text for r in rows}) == len(rows)
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(b in r.text for b in bench for r in rows)
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def plain_lines(rows):
    """Rows with unique ids, after line dedup by hand."""
    gone = removed_by_hand(rows, 50)
    return [(i, "\n".join(x for n, x in enumerate((t or "").split("\n")) if (i, n) not in gone)) for i, t in rows]


def plain_near(rows):
    prints = [simple_print(t, 3) for _, t in rows]
    root = grouped(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 2])
    best = {}
    for (i, _), r in zip(rows, root):
        best[r] = min(best.get(r, i), i)
    return [(i, t) for i, t in rows if i in set(best.values())]


def test_stages_against_plain_versions(spark):
    """Block edits, appended passages, shared passages, repeated lines and changed benchmark passages."""
    sp = pytest.importorskip("sentencepiece")
    import public_tokenizers

    rng = random.Random(21)
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    shared = words_text(rng, 55)
    rows = [(0, None), (1, ""), (2, " \n"), (3, words_text(rng, 4000))]
    for k in range(35):
        body = words_text(rng, rng.choice([30, 120, 300])).split()
        text = " ".join(body)
        near = list(body)
        near[3] = "edited"
        rows.append((10 * k + 10, text))
        rows.append((10 * k + 11, [text, text + " tail", " ".join(near), " ".join(body[: len(body) // 2])][k % 4]))
        if k % 5 == 0:
            rows.append((10 * k + 12, f"{words_text(rng, 40)}\n{shared}\n{words_text(rng, 30)}"))
        if k % 7 == 0:
            passage = rng.choice(bench).split()
            passage[rng.randrange(len(passage))] = "changed"
            rows.append((10 * k + 13, f"{words_text(rng, 60)} {' '.join(passage)} {words_text(rng, 60)}"))
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    got = lambda df: sorted((r.doc_id, r.text or "") for r in df.collect())
    after, want = common.store(stages["line dedup"](spark, frame, SF)), plain_lines(rows)
    assert got(after) == sorted(want) and want != [(i, t or "") for i, t in rows]
    after, want = common.store(stages["near dedup"](spark, after, SF)), plain_near(want)
    assert got(after) == sorted(want) and len(want) < len(rows) - 10
    after = common.store(stages["decontamination"](spark, after, SF))
    clean = [(i, t) for i, t in want if not any(overlapping(t, b) for b in bench)]
    assert got(after) == sorted(clean) and len(clean) < len(want)
    library = sp.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in stages["encoding"](spark, after, SF).collect():
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids) and r.n_tokens == len(r.ids)
