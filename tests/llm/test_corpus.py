"""Sharding, license scans, languages, toxicity, mixing and the pipeline, on small planted tables."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import kdshards, languages, licenses, mixing, toxicity
from kindred.llm.hashing import ALPHANUMERIC, batch_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, node string"


def prose(rnd, lang, count):
    syllables = {"en": "th er on an re he in ed nd ha".split(), "de": "sch ein ung ch er keit ö ß be ver".split(), "fr": "é è eau ou ai que ment re".split()}[lang]
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 5))) for _ in range(count))


def table(spark, rows):
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y") for r in rows], DOCS)


# --- sharding ------------------------------------------------------------------


def sharded(spark, rows, shards=8):
    return kdshards.shard(table(spark, rows), shards).collect()


def laws(out, rows, shards=8):
    assert sorted(((r.doc_id, r.text_crc32, r.size) for r in out), key=str) == sorted(
        ((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t, *_ in rows), key=str)
    slots = defaultdict(list)
    for r in out:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_even_and_groups_stay_together(spark):
    rnd = random.Random(1)
    rows = [(i, prose(rnd, rnd.choice(["en", "de"]), rnd.randrange(1, 120)), rnd.choice(["en", "de", None]), f"src{rnd.randrange(5)}") for i in range(2500)]
    rows += [(3000 + i, "the same text for all of these rows " * 3, "en", "src0") for i in range(120)]
    rows += [(4000 + i, None, None, None) for i in range(5)] + [(5000, "é" * 4000, "fr", "src1"), (5001, "", "en", "src1")]
    out = sharded(spark, rows)
    laws(out, rows)
    load, places = defaultdict(int), defaultdict(set)
    texts = {i: t for i, t, *_ in rows}
    for r in out:
        load[r["shard"]] += r["size"]
        places[texts[r.doc_id]].add(r["shard"])
    assert max(load.values()) <= 1.02 * sum(load.values()) / 8 and min(load.values()) >= 0.98 * sum(load.values()) / 8
    assert all(len(p) == 1 for p in places.values())


def test_a_group_beyond_a_shard_is_cut(spark):
    rows = [(i, "one text, a third of all rows " * 4, "en", "src0") for i in range(900)] + [(1000 + i, f"text {i} " * 15, "en", "src1") for i in range(900)]
    out = sharded(spark, rows)
    laws(out, rows)
    load = defaultdict(int)
    for r in out:
        load[r["shard"]] += r["size"]
    assert max(load.values()) <= 1.05 * sum(load.values()) / 8


@pytest.mark.parametrize("count", [0, 1, 5])
def test_few_rows(spark, count):
    rows = [(i, f"t{i}", "en", "s") for i in range(count)] + [(0, "t0", "en", "s")] * min(count, 1) + [(None, "n", None, None)] * min(count, 1)
    laws(sharded(spark, rows), rows)


# --- licenses ------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_scan(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    hits = [(i, label) for i in range(len(words)) for p, label in licenses.PHRASES.items() if words[i: i + len(p.split())] == p.split()]
    return len(words), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({x for _, x in hits}))


def test_base_columns_equal_a_plain_scan(spark):
    rnd = random.Random(2)
    bits = ["MIT", "License", "apache", "LICENSE", "general", "Public", "license.", "é", "x1", "--", "\n", "mit-license", "0", "Ä"]
    texts = [" ".join(rnd.choice(bits) for _ in range(rnd.randrange(40))) for _ in range(300)]
    texts += [None, "", " .,; ", "mit license", "MIT LICENSE MIT LICENSE", "general public license" * 2, "w " * 30_000 + "mit license", "\x00mit\x01license"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(3, texts[3], "en", "s"), (None, "the apache license", None, None)]
    out = licenses.scan(table(spark, rows)).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=key) == sorted(
        ((i, *base_scan(t)) for i, t, *_ in rows), key=key)


def test_notices_are_found_with_edits_and_not_elsewhere(spark):
    notice = licenses.TEMPLATES["bsd"][0]
    edited = notice.replace("source and binary forms", "source and also binary forms").replace("conditions", "terms")
    words = notice.split()
    shuffled = words[:]
    random.Random(4).shuffle(shuffled)
    rows = [
        (1, f"intro words {notice} outro", "en", "s"), (2, f"a b c {edited}.", "en", "s"), (3, " ".join(shuffled), "en", "s"),
        (4, "redistribution and use in source of anything", "en", "s"), (5, "Licensed under CC BY-NC 4.0.", "en", "s"), (6, "nothing", "en", "s"),
        (7, f"{notice} {notice}", "en", "s"),
    ]
    out = {r.doc_id: r for r in licenses.scan(table(spark, rows)).collect()}
    assert [out[i].labels for i in range(1, 8)] == ["bsd", "bsd", "", "", "cc-by-nc", "", "bsd"]
    assert out[1].score == 1.0 and 0.6 <= out[2].score < 1 and out[3].score == 0.0 and len(out[7].spans) == 2
    assert (out[1].spans[0].first_word, out[1].spans[0].last_word) == (2, 2 + len(words) - 1)


@pytest.mark.parametrize(
    "label, before, after",
    [("bsd", "", "conditions are met"), ("bsd", "redistribution and use", ""), ("mpl", "", "this source code"), ("mpl", "this source code", "")],
)
@pytest.mark.parametrize("times", [40, 4000])
def test_a_notice_beside_its_own_repeated_words_is_found(spark, label, before, after, times):
    notice = licenses.TEMPLATES[label][0]
    text = " ".join([before] * times + [notice] + [after] * times)
    found = licenses.scan(table(spark, [(1, text, "en", "s"), (2, " ".join([before + after] * times), "en", "s")])).collect()
    rows = {r.doc_id: r for r in found}
    assert rows[1].labels == label and rows[1].score == 1.0
    (span,) = rows[1].spans
    n = len(re.findall(r"[0-9A-Za-z]+", notice))
    first = times * len(before.split())
    assert (span.first_word, span.last_word) == (first, first + n - 1)
    assert rows[2].labels == "" and rows[2].score == 0.0


def test_scan_of_nothing(spark):
    assert licenses.scan(table(spark, [])).count() == 0


# --- languages -----------------------------------------------------------------


def corpus(seed, count=240):
    rnd = random.Random(seed)
    return [(i, prose(rnd, lang := rnd.choice(["en", "de", "fr"]), rnd.randrange(3, 60)), lang, f"src{i % 7}") for i in range(count)]


def test_language_of_held_out_texts(spark):
    model = languages.fit_documents(table(spark, corpus(1)))
    rows = [(i, t, None, s) for i, t, _, s in corpus(2)]
    out = {r.doc_id: r for r in languages.identify(languages.document_evidence(table(spark, rows)), model, ["doc_id"]).collect()}
    assert np.mean([out[i].language == lang for i, _, lang, _ in corpus(2)]) >= 0.97
    assert len(out) == len(rows)


def test_weak_texts_follow_declaration_and_host(spark):
    rows = corpus(3) + [(1000 + i, prose(random.Random(i), "de", 40), "de", "de-host") for i in range(60)]
    rows += [(2000, "a", "de", "src1"), (2001, "a", None, "de-host"), (2002, None, "de", "src1"), (2003, "12 !?", None, None), (2004, "", "xx", "y"), (2004, "", "xx", "y")]
    docs = table(spark, rows)
    out = defaultdict(list)
    for r in languages.identify(languages.document_evidence(docs), languages.fit_documents(docs), ["doc_id"]).collect():
        out[r.doc_id].append(r)
    assert out[2000][0].language == "de" and out[2001][0].language == "de"
    assert not any(r.accepted for i in (2002, 2003, 2004) for r in out[i]) and len(out[2004]) == 2
    assert all(0 < r.posterior <= 1 + 1e-9 for rs in out.values() for r in rs)


def fused(model, rows):
    """Posterior of each row (text, declared, suffix, domain, host) by plain sums over the other rows."""
    size, keys = len(model.languages), [tuple((v or "").lower() for v in r[1:]) for r in rows]
    evidence = []
    for r in rows:
        mean, n = model.evidence(r[0])
        evidence.append(mean * min(n, languages.EVIDENCE))
    shares = [np.exp(e - e.max()) / np.exp(e - e.max()).sum() for e in evidence]
    out = []
    for i, (e, k) in enumerate(zip(evidence, keys)):
        def total(same):
            return sum((s for j, s in enumerate(shares) if j != i and same(keys[j])), np.zeros(size))
        every = total(lambda o: True)
        p = (every + 1) / (every.sum() + size)
        for counts in (total(lambda o: o[2] == k[2]), total(lambda o: o[2:] == k[2:])):
            p = (counts + languages.SMOOTHING * p) / (counts.sum() + languages.SMOOTHING)
        log = e + np.log(p)
        for at in (0, 1):
            counts = total(lambda o: o[at] == k[at])
            log += np.log((counts + languages.SMOOTHING * (counts.sum() + 1) / (every.sum() + 1)) / (every + languages.SMOOTHING))
        out.append(np.exp(log - log.max()) / np.exp(log - log.max()).sum())
    return out


def test_fusion_equals_plain_sums_over_the_other_rows(spark):
    model = languages.fit_documents(table(spark, corpus(1, 60)))
    model = languages.Trigrams(model.languages, model.logs * 0.1)  # so that the other evidence matters
    rnd = random.Random(5)
    rows = [("a b", None, None, None, None), ("", "de", "de", "x.de", "www.x.de"), (None, "DE", "de", "x.de", "x.de"), ("le", "zz", "fr", "only.fr", "only.fr")]
    rows += [
        (prose(rnd, lang, rnd.randrange(1, 6)), rnd.choice([lang, None, "en"]), rnd.choice(["de", "com"]), d := rnd.choice(["a.com", "b.de"]), rnd.choice(["", "www."]) + d)
        for lang in ("de", "fr", "en") for _ in range(15)
    ]
    rows += rows[-3:]
    # Names that the operator uses or adds do no harm.
    schema = "id long, text string, declared string, suffix string, domain string, host string, n long, e0 long, Language string, p0 long"
    frame = spark.createDataFrame([(i, *r, 1, 2, "x", 3) for i, r in enumerate(rows)], schema)
    found = languages.identify(frame, model, ["id", "n", "e0", "Language", "p0"])
    assert found.columns == ["id", "n", "e0", "p0", "language", "posterior", "accepted"]
    found = sorted(found.collect(), key=lambda r: r.id)
    for r, q in zip(found, fused(model, rows)):
        assert abs(r.posterior - q.max()) < 1e-9 and (r.n, r.e0, r.p0) == (1, 2, 3)
        assert q[model.languages.index(r.language)] > q.max() - 1e-9
    assert len(found) == len(rows) and len({round(r.posterior, 6) for r in found}) > 10


def test_a_filter_on_languages_does_not_grow_the_plan(spark):
    """Pushed down the steps of the fusion, the filter named each step many times: the driver ran out of memory."""
    docs = table(spark, [r for r in corpus(8, 40) if r[2] != "fr"])
    found = languages.identify(languages.document_evidence(docs), languages.fit_documents(docs), ["doc_id"]).where("accepted")
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 2_000
    assert found.count() > 0


def test_rare_languages_share_a_model_and_keep_their_names(spark):
    rows = [r for r in corpus(6, 300) if r[2] != "fr"] + [(5000 + i, prose(random.Random(i), "fr", 40), ("fr", "oc")[i % 2], "rare") for i in range(20)]
    docs = table(spark, rows + [(9000, prose(random.Random(99), "fr", 40), None, "rare"), (9001, "", "", "rare")])
    model = languages.fit(docs.selectExpr("doc_id as id", "text", "lang as language"), own=2)
    assert model.languages == ["de", "en", languages.OTHERS]
    out = {r.doc_id: r for r in languages.identify(languages.document_evidence(docs), model, ["doc_id"]).collect()}
    rare = [r for r in rows if r[0] >= 5000]
    assert all(out[i].language == lang and out[i].accepted for i, _, lang, _ in rare)
    assert out[9000].language is None and not out[9000].accepted
    assert np.mean([out[i].language == lang for i, _, lang, _ in rows]) >= 0.97


def test_a_very_long_text_is_read_whole(spark):
    text = prose(random.Random(1), "en", 40) + " " + " ".join(prose(random.Random(i), "de", 60) for i in range(3000))
    docs = table(spark, corpus(7, 90) + [(777, text, None, "long")])
    out = {r.doc_id: r for r in languages.identify(languages.document_evidence(docs), languages.fit_documents(docs), ["doc_id"]).collect()}
    assert len(text) > 1_000_000 // 2 and out[777].language == "de"


def test_pages_give_their_evidence(spark):
    pages = spark.createDataFrame([
        (1, "https://user@www.Shop.example.DE:8080/a?b", '<HTML class=x LANG="de-AT"><script>var t="</p>en";</script><!-- no --><p>Straße</p>'),
        (2, "no address", "plain"), (3, None, None),
    ], "page_id long, url string, html string")
    out = {r.page_id: r for r in languages.page_evidence(pages).collect()}
    assert (out[1].declared, out[1].suffix, out[1].domain, out[1].host) == ("de", "de", "example.de", "www.shop.example.de")
    assert out[1].text.split() == ["Straße"]
    assert out[2].declared is None and out[2].host is None and out[3].text == ""


def test_languages_of_nothing(spark):
    empty = languages.document_evidence(table(spark, []))
    assert languages.fit_documents(table(spark, [])) is None
    assert languages.identify(empty, None, ["doc_id"]).count() == 0
    model = languages.fit_documents(table(spark, corpus(1, 30)))
    assert languages.identify(empty, model, ["doc_id"]).count() == 0


def test_trigrams_do_not_depend_on_segments(monkeypatch):
    text = "Ein Satz, der länger ist als ein Segment. " * 30
    whole = np.concatenate(list(languages.trigram_buckets(text)))
    monkeypatch.setattr(languages, "_SEGMENT", 50)
    assert np.concatenate(list(languages.trigram_buckets(text))).tolist() == whole.tolist()


# --- toxicity ------------------------------------------------------------------


def rated(seed, count=900):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words = prose(rnd, rnd.choice(["en", "de"]), rnd.randrange(20, 150)).split()
        toxic = rnd.random() < 0.3
        for _ in range(rnd.randrange(2, 5) * toxic):
            words.insert(rnd.randrange(len(words)), rnd.choice(["Scoundrel", "WRETCH", "vermin", "lout!"]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = rated(1)
    rows += [(5000, None, "en", "s"), (5001, "", "en", "s"), (5002, "wretch " * 20_000, "en", "s"), (None, "vermin", None, None), (5003, "x", "en", "s"), (5003, "x", "en", "s")]
    marks = spark.createDataFrame(labels + [(5003, None), (None, 1), (7777, 1)], "doc_id long, toxic int")
    out = toxicity.rate(table(spark, rows), marks, keep=["doc_id"]).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 100 and np.mean([p == t for p, t in held]) >= 0.97
    score = {r.doc_id: r.score for r in out}
    assert score[5002] > 0.5 and score[5000] == score[5001] < 0.5


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = rated(2, 300)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    scores = []
    for marks in (labels, turned):
        out = toxicity.rate(table(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int"))
        scores.append({r.doc_id: r.score for r in out.collect()})
    assert scores[0] == scores[1]


def test_without_labels_nothing_is_toxic(spark):
    rows, _ = rated(3, 20)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.rate(table(spark, rows), none).collect()} == {0.0}
    assert toxicity.rate(table(spark, []), none).count() == 0


def test_ratio_of_known_words():
    hashes = list(batch_words(["bad", "fine word"], ALPHANUMERIC))
    pair = toxicity.pair_keys(np.concatenate((hashes[0], hashes[1])))[2:]
    model = toxicity.Model((hashes[0], np.array([2.0])), (pair, np.array([-3.0])))
    assert model.ratio(hashes[0]) == 2.0 and model.ratio(hashes[1]) == -1.5 and model.ratio(hashes[0][:0]) == 0.0


def counted(seed):
    """(without, word, context, t, o) of two small models; context 0 begins a text."""
    rnd = random.Random(seed)
    rows = {(f, rnd.randrange(1, 9), rnd.randrange(0, 9)): (float(rnd.choice([0, 0, 1, 1, 2, 5])), float(rnd.choice([0, 1, 2, 3]))) for f in (0, 1) for _ in range(40)}
    return [(f, w, u, t, o) for (f, w, u), (t, o) in rows.items() if t or o]


def kneser_ney(rows, at):
    """p(word) and p(word | context) of one class, from the definition.  ``at``: 3 toxic, 4 ordinary."""
    def discount(counts):
        n1, n2 = (sum(c == size for c in counts) for size in (1, 2))
        return n1 / (n1 + 2 * n2) if n1 and n2 else toxicity.DISCOUNT

    words = {r[1] for r in rows} | {None}
    both = {w: sum(r[1] == w for r in rows) for w in words}
    before = {w: sum(r[1] == w and r[at] > 0 for r in rows) for w in words}
    d, total = discount(before.values()), sum(before.values())
    shared = {w: (both[w] + 0.5) / (sum(both.values()) + 0.5 * len(words)) for w in words}
    single = {w: (max(before[w] - d, 0) + d * sum(n > 0 for n in before.values()) * shared[w]) / total for w in words}
    d = discount([r[at] for r in rows])

    def after(word, context):
        seen = {r[1]: r[at] for r in rows if r[2] == context and r[at] > 0}
        if not seen:
            return single[word]
        return (max(seen.get(word, 0) - d, 0) + d * len(seen) * single[word]) / sum(seen.values())

    return single, after


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_probabilities_are_kneser_neys_and_sum_to_one(spark, seed):
    rows = counted(seed)
    pairs = spark.createDataFrame(rows, "without int, word long, context long, t double, o double")
    words = toxicity.word_probabilities(pairs)
    every = words.where("word is not null").select("without", "word").crossJoin(spark.range(9).withColumnRenamed("id", "context"))
    wanted = every.join(pairs, ["without", "word", "context"], "left").fillna(0.0, ["t", "o"])
    single = {(r.without, r.word): (r.p_t, r.p_o) for r in words.collect()}
    double = {(r.without, r.word, r.context): (r.p_t, r.p_o) for r in toxicity.pair_probabilities(pairs, words, wanted).collect()}
    for f in (0, 1):
        own = [r for r in rows if r[0] == f]
        for i, at in enumerate((3, 4)):
            alone, after = kneser_ney(own, at)
            assert {w: p[i] for (g, w), p in single.items() if g == f} == pytest.approx(alone)
            assert sum(alone.values()) == pytest.approx(1)
            for context in {r[2] for r in own}:
                assert sum(after(w, context) for w in alone) == pytest.approx(1)
                for word in alone:
                    if word is not None:
                        assert double[f, word, context][i] == pytest.approx(after(word, context))


def rare_toxic(seed, count, every):
    """Every ``every``-th text is toxic."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words = prose(rnd, rnd.choice(["en", "de"]), rnd.randrange(20, 150)).split()
        for _ in range(2 * (i % every == 0)):
            words.insert(rnd.randrange(len(words)), rnd.choice(["scoundrel", "wretch"]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(i % every == 0)))
    return rows, labels


def test_the_larger_class_is_not_cut_to_the_smaller(spark):
    rows, labels = rare_toxic(4, 400, 20)
    fitted = {i: t for i, t in labels if zlib.crc32(str(i).encode()) % 5}
    docs, marks = table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    assert {r.doc_id: (int(r.toxic), r.weight) for r in toxicity.labelled_sample(docs, marks).collect()} == {i: (t, 1.0) for i, t in fitted.items()}
    few = toxicity.labelled_sample(docs, marks, 50).collect()
    toxic = sum(fitted.values())
    assert toxic < 50 and sum(r.toxic for r in few) == toxic and sum(not r.toxic for r in few) == 50
    assert {r.weight for r in few if not r.toxic} == {(len(fitted) - toxic) / 50}


def test_few_toxic_texts_among_many(spark):
    rows, labels = rare_toxic(5, 900, 18)
    out = toxicity.rate(table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(t for _, t in held) >= 5 and all(p == t for p, t in held)


def test_one_long_text_and_copies_do_not_make_a_word_toxic(spark):
    rows, labels = rare_toxic(6, 400, 8)
    ordinary = prose(random.Random(8), "fr", 60)
    rnd = random.Random(9)
    long = " ".join(f"{prose(rnd, 'de', 1)} mild" for _ in range(400))
    rows += [(1000, long, "en", "s"), *[(2000 + i, ordinary + f" end{i}", "fr", "s") for i in range(40)]]
    labels += [(1000, 1), *[(2000 + i, 1) for i in range(40)]]
    model = toxicity.fit(toxicity.labelled_sample(table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")))
    known = set(model.words[0].tolist())
    for word in ["mild", *ordinary.split()]:
        assert next(batch_words([word], ALPHANUMERIC))[0] not in known
    assert next(batch_words(["wretch"], ALPHANUMERIC))[0] in known


def test_all_labelled_texts_are_fitted_on(spark):
    """Of more than 6,000 labelled texts of a class the others were left out: expressions only they hold were unknown."""
    ids = [i for i in range(16_000) if zlib.crc32(str(i).encode()) % 5]
    assert len(ids) > 12_500
    docs = spark.range(16_000).selectExpr("id as doc_id", "concat('plain words ', id, if(id % 2 = 0, concat(' odd', id div 1600), '')) as text")
    marks = spark.range(16_000).selectExpr("id as doc_id", "if(id % 2 = 0, 1, 0) as toxic")
    sample = toxicity.labelled_sample(docs, marks)
    assert sorted(r.doc_id for r in sample.select("doc_id").collect()) == ids
    counted = toxicity._counted(toxicity.stage(sample.select("text", "toxic", "weight", "fold"), "sample"))
    words = {r.word: r.t1 + r.t2 + r.t3 + r.t4 for r in counted.frequent.where("not paired").collect()}
    for n in range(10):
        held = sum(i % 2 == 0 and i // 1600 == n for i in ids)
        assert words[int(next(batch_words([f"odd{n}"], ALPHANUMERIC))[0].astype(np.int64))] == held


def test_portions_give_the_same_model(spark, monkeypatch):
    rows, labels = rated(7, 300)
    rows = [(i, text + " you rotten lout" * toxic, *more) for (i, text, *more), (_, toxic) in zip(rows, labels)]
    sample = toxicity.stage(toxicity.labelled_sample(table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")), "sample")
    whole = toxicity.fit(sample)
    monkeypatch.setattr(toxicity, "PORTION_TEXTS", 100)
    parts = toxicity.fit(sample)
    for a, b in zip((*whole.words, *whole.pairs, whole.curve), (*parts.words, *parts.pairs, parts.curve)):
        assert len(a) and np.allclose(np.asarray(a).astype(float), np.asarray(b).astype(float), rtol=1e-9)


def test_the_curve_of_stored_rows_is_that_of_arrays(spark):
    rnd = np.random.default_rng(1)
    ratio, toxic, weight = rnd.normal(0, 0.01, 400), rnd.random(400) < 0.3, rnd.integers(1, 4, 400).astype(float)
    ratio += 0.004 * toxic
    judged = spark.createDataFrame([(bool(t), float(w), float(r)) for t, w, r in zip(toxic, weight, ratio)], "toxic boolean, weight double, ratio double")
    assert toxicity._curve(judged) == pytest.approx(toxicity.logistic(ratio, toxic, weight), rel=1e-6)


# --- mixing --------------------------------------------------------------------


def water_fill(budget, children):
    """children: name -> (weight, capacity); by repeated rounds instead of the closed form."""
    given, open_ = dict.fromkeys(children, 0.0), {c for c, (w, _) in children.items() if w > 0}
    while open_ and budget > 1e-9:
        total = sum(children[c][0] for c in open_)
        full = {c for c in open_ if children[c][1] <= budget * children[c][0] / total + 1e-9}
        if not full:
            return given | {c: budget * children[c][0] / total for c in open_}
        for c in full:
            given[c] = float(children[c][1])
        budget -= sum(children[c][1] for c in full)
        open_ -= full
    return given


WEIGHTS = {"domain": lambda: F.when(F.col("domain") == "d0", 3).otherwise(1), "lang": lambda: F.when(F.col("lang") == "en", 2).otherwise(1), "source": lambda: F.lit(1)}
PLAIN = {"domain": lambda p: 3 if p[0] == "d0" else 1, "lang": lambda p: 2 if p[1] == "en" else 1, "source": lambda p: 1}


def mixed(spark, rows, total, epochs):
    docs = spark.createDataFrame(rows, "domain string, lang string, source string, doc_id long, n long")
    return mixing.mix(docs, F.col("n"), F.lit(total) + F.sum("tokens") * 0, {k: v() for k, v in WEIGHTS.items()}, epochs).collect()


def test_budgets_and_prefixes(spark):
    rnd = random.Random(6)
    rows = [(f"d{rnd.randrange(3)}", rnd.choice(["en", "de"]), f"s{rnd.choice([0, 0, 0, 1, 2])}", i, rnd.randrange(1, 40)) for i in range(700)]
    out = mixed(spark, rows, 20_000, 2)
    leaves = defaultdict(int)
    for *path, _, n in rows:
        leaves[tuple(path)] += 2 * n
    budgets = {(): 20_000.0}
    for depth, level in enumerate(mixing.LEVELS):
        new = {}
        for parent, budget in budgets.items():
            children = defaultdict(lambda: [0, 0])
            for path, capacity in leaves.items():
                if path[:depth] == parent:
                    children[path[: depth + 1]] = [PLAIN[level](path), children[path[: depth + 1]][1] + capacity]
            new |= water_fill(budget, children)
        budgets = new
    taken, seen = defaultdict(int), set()
    tokens = {i: n for *_, i, n in rows}
    for r in out:
        taken[r.domain, r.lang, r.source] += r.n_tokens
        assert (r.doc_id, r.epoch) not in seen and r.n_tokens == tokens[r.doc_id]
        seen.add((r.doc_id, r.epoch))
    for path, budget in budgets.items():
        assert budget - 45 <= taken[path] <= budget + 1
    # A document that opens a second epoch means that the leaf's first is complete.
    second = {(r.domain, r.lang, r.source) for r in out if r.epoch == 1}
    for path in second:
        assert all((i, 0) in seen for *p, i, _ in rows if tuple(p) == path)
    assert {tuple(r) for r in out} == {tuple(r) for r in mixed(spark, rows, 20_000, 2)}


def test_more_than_there_is_takes_all_and_nothing_takes_nothing(spark):
    rows = [("d0", "en", "s", 1, 5), ("d0", "en", "s", 1, 5), ("d1", None, "s", 2, 7), (None, None, None, None, 3), ("d1", "de", "t", 4, 0)]
    out = mixed(spark, rows, 10**6, 1)
    assert sorted(r.n_tokens for r in out if r.n_tokens) == [3, 5, 5, 7]
    assert mixed(spark, rows, 0, 1) == [] and mixed(spark, [], 100, 1) == []


# --- pipeline ------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rows, labels = rated(7, 400)
    rows += [(1000 + i, rows[0][1] + f" tail{i}", "en", "s") for i in range(5)] + [(2000, "", None, None), (2001, None, None, None)]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
        if i < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert len(kept[-1]) == docs.count()
    toxic = {i for i, t in labels if t}
    assert len(toxic & kept[0]) <= 0.05 * len(toxic) and len(kept[0] - toxic) >= 0.97 * (len(rows) - len(toxic))
    assert kept[0] - kept[1] == {2000, 2001} & kept[0]
    assert len(kept[2] & {0, *range(1000, 1005)}) == 1 and kept[1] - kept[2] <= {0, *range(1000, 1005)} | toxic
    assert 0.5 * len(kept[2]) < len(kept[3]) < len(kept[2]) and kept[4] == kept[3]
    assert docs.where("not intact").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(kept[4])


def test_the_curve_converges_on_separable_ratios():
    rng = np.random.default_rng(1)
    ratio = np.concatenate((rng.normal(-0.02, 0.002, 900), rng.normal(0.1, 0.02, 100)))
    toxic = np.arange(1000) >= 900
    for weight in (np.ones(1000), np.where(toxic, 1.0, 12.0)):
        slope, offset = toxicity.logistic(ratio, toxic, weight)
        predicted = slope * toxicity.stretched(ratio) + offset >= 0
        assert slope > 0 and (predicted == toxic).all()


def test_pipeline_rows_that_repeat_an_id_and_a_text(spark):
    import corpus_pipeline

    text = prose(random.Random(3), "en", 60)
    rows = [
        (1, text, "en", "b", 5), (1, text, "en", "a", 7), (1, text, "en", "a", 6), (1, text, "de", "z", 9), (None, prose(random.Random(4), "de", 60), "de", None, None),
        (2, None, "en", "a", 0), (2, None, None, "b", 0),
    ]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        out = {tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
        assert out == {rows[3], rows[4], rows[6]}
        keyed = corpus_pipeline._keyed(docs)
        assert keyed.select("row_key", "row_check").distinct().count() == len(rows)
