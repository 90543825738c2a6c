"""Operators that read texts: held-out accuracy, brute force, planted cases and odd rows."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.llm import compression, decontamination, imatch, language, ngram_join, queries, secrets, toxicity
from lamella.llm.common import components, staged


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def small(spark):
    """The 1,000-document tables: enough labels to learn from."""
    return "/root/testdata/sf0.01"


def test_quality_held_out(spark, small):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = queries.op2_compression_quality(spark, small).collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    own = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for y, s in own if y], [s for y, s in own if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_toxicity_held_out(spark, small):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    rows = queries.op7_counterfactual_toxicity(spark, small).collect()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) for r in rows)
    own = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p for y, p in own if not y) <= 1
    assert sum(p for y, p in own if y) >= 0.6 * sum(y for y, _ in own)


def test_counterfactual_penalty_spares_mentions(spark):
    """Mentions of one group stand in toxic texts only; with the penalty a neutral mention is not toxic."""
    rows = [(i, ("muslim people idiot scum" if i % 4 == 0 else "christian people garden") + f" filler{i % 7}", int(i % 4 == 0)) for i in range(200)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    probe = spark.createDataFrame([(1, "muslim people garden"), (2, "idiot scum"), (3, None), (4, "")], "doc_id long, text string")

    def scores(penalty):
        model = toxicity.fit(docs, labels, penalty=penalty)
        return {r.doc_id: r.s for r in probe.select("doc_id", toxicity.scorer(model)("text").alias("s")).collect()}

    free, held = scores(0.0), scores(20.0)
    assert held[1] < free[1] and held[1] < 0.3 and held[2] > 0.7 and held[3] == held[4] < 0.5


def test_language_held_out(spark, small):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op3_language_profiles(spark, small).collect()
    own = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows) and np.mean(own) > 0.97


def test_language_without_letters(spark, odd_docs):
    predict = language.predictor({"en": language.ngrams("the cat")[0].tolist()})
    got = {r.text: r.p.lang_pred for r in spark.createDataFrame([("123 !?",), ("",), (None,), ("cat",)], "text string").select("text", predict("text").alias("p")).collect()}
    assert got == {"123 !?": "und", "": "und", None: "und", "cat": "en"}
    assert language.identify(odd_docs, {}).where("lang_pred <> 'und'").count() == 0


def test_secrets_query(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op4_secret_ownership(spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        t = docs[r.doc_id]
        found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(secrets.ASSIGN, t, re.I | re.A) if len(m[2]) >= 8]
        found += [(m.start(), 1, "access", m.end()) for m in re.finditer(secrets.ACCESS, t) if len(m[0]) >= 16]
        found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(secrets.HEX, t) if len(m[0]) >= 32]
        line = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(f[1] == k for f in found) for k in range(3))
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_ownership_separates_copies(spark):
    shared, own = "AKIA" + "A1B2C3D4E5F6G7H8", "Zx9Kq2Lm7Vb4Nc8Wd1Rt5Yp3"
    rows = [(i, f"text {i} {shared}", f"repo{i % 5}") for i in range(10)] + [(20, f"key {own} end", "repo1"), (21, None, None), (22, "", "r")]
    out = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(out) == 13 and out[21] == out[22] == []
    assert all(not out[i][0].live and (out[i][0].repositories, out[i][0].owners) == (5, 10) for i in range(10))
    assert [(s.kind, s.live) for s in out[20]] == [("opaque", True)]


def test_one_repository_is_never_a_copy(spark):
    words = " ".join(f"word{i}" for i in range(60))
    own, near, wide = ("Zx9Kq2Lm7Vb4Nc8Wd1Rt5Y" + x for x in ("own", "near", "wide"))
    rows = [(i, f"file {i} holds {own}", "repo1") for i in range(8)]
    rows += [(10 + i, f"{words} {near} edited {i}", "repo1") for i in range(7)] + [(19, f"other text {near}", "repo2")]
    rows += [(20 + i, f"sample {i} of {wide}", f"repo{i % 2}") for i in range(6)]
    rows += [(30, f"blob {own * 30} end", "repo3")]
    out = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    seen = {i: [(s.kind, s.repositories, s.owners, s.live) for s in spans] for i, spans in out.items()}
    assert all(seen[i] == [("opaque", 1, 8, True)] for i in range(8))
    assert all(seen[i] == [("opaque", 2, 2, True)] for i in [*range(10, 17), 19])
    assert all(seen[i] == [("opaque", 2, 6, False)] for i in range(20, 26))
    assert seen[30] == [("opaque", 1, 1, True)] and (out[30][0].start, out[30][0].end) == (5, 5 + 30 * len(own))


def brute_components(texts, n, percent):
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if 100 * small >= percent * large and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_ngram_groups(spark, small, n, percent):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute_components({r.doc_id: r.text for r in docs.collect()}, n, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.group_by_ngrams(docs, n, percent).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_ngram_groups_of_similar_short_texts(spark):
    """Dense and chained neighbourhoods, many of them at the limit."""
    rng = np.random.default_rng(3)
    texts, i = {}, 0
    for length in (1, 2, 4, 9, 15, 30, 60, 120):
        base = [f"w{length}_{k}" for k in range(length)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.integers(0, 1 + length // 8)):
                words[rng.integers(0, length)] = f"x{rng.integers(0, 4)}"
            texts[i] = " ".join(words[: rng.integers(max(1, length - 3), length + 1)])
            i += 1
    for n, percent in ((1, 80), (3, 90), (2, 50)):
        got = ngram_join.group_by_ngrams(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), n, percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, n, percent)


@pytest.mark.parametrize(("block", "volume"), [(8, 2_000_000), (200, 900)])
def test_ngram_groups_in_size_bands(spark, monkeypatch, block, volume):
    """One large candidate group of all sizes, cut into many blocks."""
    rnd = random.Random(5)
    texts = {}
    for i in range(200):
        words = [f"w{k}" for k in range(rnd.randint(20, 400))]
        if rnd.random() < 0.7:
            words[rnd.randrange(len(words))] = f"x{i}"
        texts[i] = " ".join(words)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "VOLUME", volume)
    got = ngram_join.group_by_ngrams(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, 5, 80)


@pytest.mark.parametrize("crowd", [2, 64])
def test_ngram_groups_of_texts_with_common_passages(spark, monkeypatch, crowd):
    """Passages of many texts, more or less of each text; near copies of all kinds."""
    rnd = random.Random(11)
    passages = [[f"p{k}_{j}" for j in range(14)] for k in range(4)]
    texts = {}
    for i in range(0, 300, 2):
        words = sum(rnd.sample(passages, rnd.randint(0, 4)), []) + [f"u{i}_{j}" for j in range(rnd.choice([0, 3, 8, 20, 60]))]
        texts[i] = " ".join(words)
        for _ in range(rnd.randint(0, 1 + len(words) // 20) if words else 0):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(3)}"
        texts[i + 1] = " ".join(words)
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    got = ngram_join.group_by_ngrams(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 70).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts, 3, 70)


def test_texts_that_share_nothing_are_no_candidates(spark, monkeypatch):
    """Texts of few n-grams for their class have many empty fragments; those alone bring nobody together."""
    texts = [(i, " ".join(f"w{i}_{j}" for j in range(length))) for i, length in enumerate([21, 37, 68] * 200)]
    found, cells = [], ngram_join._cells
    monkeypatch.setattr(ngram_join, "_cells", lambda members, percent: found.append(members.count()) or cells(members, percent))
    ngram_join.group_by_ngrams(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert found == [0]


def test_staged_tables_leave_no_shuffle_files(spark):
    def shuffle_files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().iterator()
        out = 0
        while blocks.hasNext():
            out += blocks.next().isShuffle()
        return out

    before, rows = shuffle_files(), spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 100).alias("m")).count()
    back = staged(rows, "test-shuffles")
    for _ in range(50):
        if shuffle_files() <= before:  # removed in the background
            break
        time.sleep(0.2)
    assert shuffle_files() <= before and back.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_ngram_groups_odd_rows(spark, odd_docs):
    got = sorted(ngram_join.group_by_ngrams(odd_docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [(r.doc_id, r.component_id) for r in got] == [(1, 1), (1, 1), (2, 2), (3, 3), (5, 5), (6, 6), (None, None)]
    kept = ngram_join.keep_one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == 6
    assert ngram_join.group_by_ngrams(odd_docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long"), "test").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 103)}}


def test_leaks(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    wanted = {i: plain(t) for i, t in items.items()}
    want = {(d, i) for d, t in docs.items() for i, w in wanted.items() if w in plain(t)}
    got = {(r.doc_id, r.item_id) for r in queries.op9_benchmark_leaks(spark, small).collect()}
    assert want and got == want


def test_block_max_search_loses_nothing():
    rng = np.random.default_rng(1)
    items = [(i, " ".join(f"t{x}" for x in rng.zipf(1.3, 20) % 300)) for i in range(500)]
    index = decontamination.Index(items)
    for _ in range(50):
        terms = np.unique(rng.integers(0, len(index.terms), 40))
        scores = np.zeros(len(items))
        for t in terms:
            for at in range(index.begin[t], index.begin[t + 1]):
                scores[index.item[at]] += index.impact[at]
        hits, got = index.search(terms, 0.3)
        assert hits.tolist() == np.flatnonzero(scores >= 0.3 - 1e-9).tolist() and np.allclose(got, scores[hits])


def test_leaks_with_changed_words(spark):
    question = " ".join(f"q{i}" for i in range(40)) + "? "
    answers = {1: "the old red bridge", 2: "one bridge over the wide river", 3: " ".join(f"a{i}" for i in range(27))}
    benchmark = spark.createDataFrame([(i, question.replace("q", f"q{i}x") + a) for i, a in answers.items()], "item_id long, text string")
    texts, alone = [], len(answers) * 3
    for i, a in answers.items():
        for changed in (1, 2, 3):
            words = a.split()
            for at in range(1, len(words) - 1, max(2, len(words) // 3))[: min(changed, len(words) // 2)]:
                words[at] = "changed"
            texts.append("before it " + question.replace("q", f"q{i}x") + " ".join(words) + " and after")
    texts += [question.replace("q", f"q{i}x") + "nothing that fits here at all" for i in answers]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, benchmark).collect()}
    assert found == {(d, 1 + d // 3) for d in range(alone)}
    assert sorted(r.doc_id for r in decontamination.remove_leaks(docs, benchmark).collect()) == list(range(alone, len(texts)))


def test_leaks_odd_rows(spark, odd_docs):
    none = spark.createDataFrame([(1, None), (None, "a b"), (2, "")], "item_id long, text string")
    assert decontamination.find_leaks(odd_docs, none).count() == 0
    kept = decontamination.remove_leaks(odd_docs, spark.createDataFrame([(1, "a b c d. e f g")], "item_id long, text string"))
    assert kept.columns == odd_docs.columns and kept.count() == 5


def test_imatch_query(spark, sf):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    rows = {r.doc_id: r for r in queries.op5_imatch(spark, sf).collect()}
    assert len(rows) == len(docs)
    prints = defaultdict(set)
    for i, (d, t) in enumerate(docs):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + docs[(i + 1) % len(docs)][1][:cut]
        assert (rows[d].n_chars, rows[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        prints[t].add(rows[d].fingerprint)
    assert all(len(v) == 1 for v in prints.values())
    assert np.mean([r.near_edited for r in rows.values()]) > 0.3 > 0.05 > np.mean([r.near_next for r in rows.values()])


def test_imatch_odd_rows(spark, odd_docs):
    lexicon = imatch.learn_lexicon(odd_docs)
    rows = imatch.compare_with_edits(odd_docs, lexicon).collect()
    assert len(rows) == 7 and len({r.fingerprint for r in rows if r.doc_id == 1}) == 1
    assert imatch.fingerprints(odd_docs.limit(0), lexicon).count() == 0


def test_imatch_lexicon_is_the_whole_band(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    each = docs.select(F.explode(imatch.terms("text")).alias("t")).where("t <> ''").groupBy("t").agg(F.count("t").alias("df"))
    total = docs.count()
    band = [r.h for r in each.where(f"df >= 2 AND df <= {0.2 * total}").select(F.xxhash64("t").alias("h")).collect()]
    lexicon = imatch.learn_lexicon(docs)
    assert len(band) > 1000 and sorted(r.term for r in lexicon.collect()) == sorted(band)
    some = docs.where("doc_id < 100").withColumnRenamed("text", "t")
    sent, shuffled = ({r.doc_id: r.m for r in imatch.mark_texts(some, {"m": "t"}, lexicon, n).collect()} for n in (10**6, 0))
    assert sent and sent == shuffled


def test_models_on_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, 0), (5, None, 1), (None, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    quality = compression.fit(odd_docs, labels)
    assert odd_docs.select(compression.scorer(quality)("text").alias("s")).where("s BETWEEN 0 AND 1").count() == 7
    model = toxicity.fit(odd_docs, labels)
    assert toxicity.remove_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxicity.remove_toxic(odd_docs.limit(0), model).count() == 0
    assert toxicity.fit(odd_docs.limit(0), labels)["weights"] is not None


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, out, sf), f"test-{name}")
        if name != "sharding":
            assert out.columns == docs.columns
        if name == "toxicity":
            before = {r.doc_id: r.text for r in out.collect()}
        if name == "ngram_join":
            want = {d for d, (_, c) in brute_components(before, 5, 80).items() if c == d}
            assert sorted(r.doc_id for r in out.collect()) == sorted(want)
        if name == "decontamination":
            assert decontamination.find_leaks(out, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    got = corpus_pipeline.run(spark, sf)
    assert sorted(map(str, got.collect())) == sorted(map(str, out.collect())) and 0 < got.select(F.max("shard")).first()[0] < 16


def test_several_indexes_score_as_one(spark, sf, monkeypatch):
    docs, benchmark = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")

    def found():
        rows = decontamination.find_leaks(docs, benchmark, threshold=0.3, overlap=0.1).collect()
        return {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap) for r in rows}

    one, kept = found(), decontamination.remove_leaks(docs, benchmark).count()
    monkeypatch.setattr(decontamination, "ITEMS_AN_INDEX", 7)
    several = found()
    assert benchmark.count() > 14 and len(one) > 10 and set(several) == set(one)
    assert all(several[k] == pytest.approx(one[k], abs=1e-9) for k in one)
    assert decontamination.remove_leaks(docs, benchmark).count() == kept
