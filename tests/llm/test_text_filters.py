"""URL filter, quality rules, toxicity and the quality classifier."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataforge.llm import quality_mil, quality_rules, toxicity, training, url_filter

W = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", "   \n\t ", "one", "a b c a b c a b c", "x\n\nx\nx \n y\n", "Ünï wörds\u00a0stay\u2003one", "# * $ %&|<> !", "a " * 3000, "\n".join(["same line here"] * 40), "b\x0bc\x0cd\re"]


# --- URLs


def rule_by_hand(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for r in url_filter.RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.name) > len(best.name)):
            best = r
    return host, path, best


URLS = [None, "", "no scheme", "http://", "http://NET/", "https://a.net", "https://a.net?x=/", "http://Example.NET/en/5", "http://sub.example.net/en/?q=1&r=2", "http://notexample.net/en/1", "http://example.com/de/1", "http://x.example.com/de", "https://É.org/fr/", "ftp://org/fr/x#y", "http://a.org/fr", "x://y://z.net/", "http://example.net#/en/", "http://a.net/" + "p/" * 500, "http://xnet/"]


def test_rules_and_trees(spark):
    rows = [(i, u, "clash") for i, u in enumerate(URLS + URLS)]
    df = spark.createDataFrame(rows, "page_id long, url string, label string")
    got = url_filter.judge(df, url_filter.fit(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule = rule_by_hand(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None), r.url
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == rule.verdict)
    with pytest.raises(ValueError):
        url_filter.judge(df.withColumn("host", F.lit("x")), url_filter.Model(0.0))


def test_trees_learn_what_the_labels_show(spark, sf):
    pages = spark.read.parquet(sf.replace("0.001", "0.1") + "/pages.parquet")
    model = url_filter.fit(pages)
    apart = F.crc32(F.col("url")) % 4 == 0
    labelled = url_filter.judge(pages.filter(apart), url_filter.fit(pages.filter(~apart))).filter("rule is not null").toPandas()
    most = max((labelled.verdict == v).mean() for v in ("allow", "block"))
    assert ((labelled.block_score >= 0.5) == (labelled.verdict == "block")).mean() > most + 0.1  # on URLs that no tree saw
    assert model == url_filter.fit(pages.repartition(5)) and len(model.trees) == url_filter.TREES


def test_urls_without_labels(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, url_filter.fit(empty)).count() == 0
    none = spark.createDataFrame([(1, "http://x.dk/")], "page_id long, url string")
    assert url_filter.judge(none, url_filter.fit(none)).first().verdict == "allow"


# --- quality rules


def measured_by_hand(text):
    t = text or ""
    w = W.findall(t)
    n = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if W.search(x)]
    base = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), base


def test_quality_measures(spark):
    docs = ODD + ["".join(np.random.default_rng(k).choice(list("ab \n#"), 400)) for k in range(30)]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(docs + docs)], "doc_id long, text string, n_words string")
    for r in quality_rules.judged(df).collect():
        q = r["__quality"]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words, q.base_failed) == measured_by_hand(r.text), repr(r.text)[:80]
        assert q.kept == (not q.base_failed and not q.failed)
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality_rules.judged(df).filter("__quality.kept").collect())
    assert quality_rules.judged(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        quality_rules.measures(df.withColumn("__quality", F.lit(1)))


def test_quality_runs_without_python(spark, sf):
    plan = quality_rules.judged(spark.read.parquet(sf + "/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_labelled_documents_are_told_apart(spark, sf):
    d = sf.replace("0.001", "0.01")
    got = quality_rules.judged(spark.read.parquet(d + "/documents.parquet")).select("doc_id", "__quality.*").join(spark.read.parquet(d + "/labels.parquet"), "doc_id")
    assert got.filter("quality = 1 and not base_failed and not kept").count() == 0
    assert got.filter("quality = 0 and kept").count() == 0


# --- learned scores


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


FILL = "the house of many words stands near a river and people walk along quiet roads".split()


def toxic_corpus(n=400):
    rng, rows, labels = np.random.default_rng(4), [], []
    for i in range(n):
        words = list(rng.choice(FILL, 40))
        bad = i % 4 == 0
        if bad:
            for k in (3, 9, 20):
                words[k] = ["blarghish", "snortish"][k % 2] + str(rng.choice(["", "ness", "ly"]))
        rows.append((i, " ".join(words), "x"))
        labels.append((i, 1 - int(bad), int(bad)))
    return rows, labels


SCHEMA, LABELS = "doc_id long, text string, entry string", "doc_id long, quality int, toxic int"


def test_toxicity_learns_folds_and_excepts(spark):
    rows, labels = toxic_corpus()
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS), phrases=("Snortish Creek",))
    probe = ["what a blarghish thing", "what a BL4RGHI5H thing", "what a blаrghіsh thing", "the house of many words", "walk to Snortish  Creek now", "they walk to snortish creak", "", None, "blarghish " * 5000]
    df = spark.createDataFrame([(1000 + i, t, "c") for i, t in enumerate(probe)], SCHEMA)
    got = {r.doc_id - 1000: r for r in toxicity.score(df, model).collect()}
    hits = [got[i].total > 0 for i in range(len(probe))]
    assert hits == [True, True, True, False, False, True, False, False, True]
    assert got[0].score > got[3].score and got[8].predicted == 1 and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == held(r.doc_id) for r in got.values())
    clean = toxicity.keep_clean(df, model)
    assert clean.columns == df.columns and {r.doc_id - 1000 for r in clean.collect()} == {i for i in got if got[i].score < 0.5}
    marked = toxicity.score(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in marked]) > 0.98


def test_held_out_labels_are_never_read(spark):
    rows, labels = toxic_corpus(200)
    df = spark.createDataFrame(rows, SCHEMA)
    other = [(i, 1 - q, 1 - t) if held(i) else (i, q, t) for i, q, t in labels]
    for module in (toxicity, quality_mil):
        a, b = (sorted(tuple(r) for r in module.score(df, module.fit(df, spark.createDataFrame(x, LABELS))).collect()) for x in (labels, other))
        assert a == b


def test_scores_without_labels_or_rows(spark):
    rows, labels = toxic_corpus(40)
    df, none, one = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], LABELS), spark.createDataFrame([(i, 1, 0) for i, *_ in labels], LABELS)
    for module in (toxicity, quality_mil):
        for known in (none, one):
            model = module.fit(df, known)
            assert module.score(df, model).filter("score between 0 and 1").count() == 40
            assert module.score(df.limit(0), model).count() == 0


def test_covered_hits_in_long_texts():
    best, covered = {i: 1.0 for i in range(0, 1000, 5)}, [(i, i + 3) for i in range(0, 1000, 10)]
    assert toxicity._outside(best, covered) == {s: w for s, w in best.items() if not any(a <= s < b for a, b in covered)}


def bags_of(texts):
    data = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    return quality_mil.passages(np.frombuffer(b"".join(data), np.uint8), off)


def test_passages_cover_all_words():
    texts = ["", "one", "w " * 100, "a\nb " * 24, "é! " * 49]
    bags = bags_of(texts)
    assert np.diff(bags.first).tolist() == [1, 1, 3, 1, 2] and bags.x.shape[1] == quality_mil.N_FEATURES
    assert np.allclose(bags.x, np.concatenate([bags_of([t]).x for t in texts]))
    assert np.bincount(bags.place, minlength=8).tolist() == [0, 1, 48, 48, 4, 48, 48, 1]
    assert bags.words[1] == bags.words[48] != bags.words[0] and bags_of(["One"]).words == bags_of(["one"]).words


def small_network(rng, features, buckets, hidden=4, attention=3):
    shapes = {"W": (features, hidden), "E": (buckets, hidden), "b": hidden, "V": (hidden, attention), "U": (hidden, attention), "a": attention, "c": hidden}
    return {"mean": rng.normal(size=features), "scale": rng.uniform(1, 2, features)} | {k: rng.normal(size=n) for k, n in shapes.items()} | {"d": np.float64(0.1)}


def test_attention_scores_by_hand():
    rng = np.random.default_rng(1)
    texts = ["", "one two", "the cat sat " * 40, "x " * 130 + "end"]
    bags = bags_of(texts)
    w = small_network(rng, quality_mil.N_FEATURES, quality_mil.BUCKETS)
    logit, kept = quality_mil.forward(w, bags)
    for d in range(len(texts)):
        coded, weights = [], []
        for p in range(bags.first[d], bags.first[d + 1]):
            own = [w["E"][b] for b, q in zip(bags.words, bags.place, strict=True) if q == p]
            h = np.tanh(((bags.x[p] - w["mean"]) / w["scale"]) @ w["W"] + (sum(own) / len(own) if own else 0) + w["b"])
            gate = [np.tanh(h @ w["V"][:, k]) / (1 + np.exp(-(h @ w["U"][:, k]))) for k in range(3)]
            coded.append(h)
            weights.append(np.exp(sum(a * g for a, g in zip(w["a"], gate, strict=True))))
        att = np.array(weights) / sum(weights)
        assert np.allclose(kept["att"][bags.first[d] : bags.first[d + 1]], att)
        assert np.isclose(logit[d], sum(a * h for a, h in zip(att, coded, strict=True)) @ w["c"] + w["d"])


def test_gradients_of_the_attention_network():
    rng = np.random.default_rng(0)
    words, place = np.array([3, 1, 3, 0, 2, 2], np.uint16), np.array([0, 0, 1, 4, 4, 6])
    bags = quality_mil.Bags(rng.normal(size=(7, 5)), np.array([0, 2, 3, 7]), words, place)
    w = small_network(rng, 5, 4)
    delta = rng.normal(size=3)
    grads = quality_mil._gradients(w, quality_mil.forward(w, bags)[1], delta, bags)
    for k, g in grads.items():
        for at in list(np.ndindex(np.shape(w[k])))[:16]:
            def loss(step, k=k, at=at):
                v = {n: np.array(a, float) for n, a in w.items()}
                v[k][at] += step
                return quality_mil.forward(v, bags)[0] @ delta
            assert np.isclose((loss(1e-6) - loss(-1e-6)) / 2e-6, np.asarray(g)[at], rtol=1e-4, atol=1e-7), (k, at)


def test_quality_learns_what_words_say(spark):
    """Two classes of equal form, told apart by their words alone."""
    rng = np.random.default_rng(8)
    good, bad = (["".join(rng.permutation(list(x))) for x in ("abcdefg", "hijklmn") for _ in range(20)] for _ in range(2))
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad, 120)), "c") for i in range(400)]
    df, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, i % 2, 0) for i in range(400)], LABELS)
    got = [r for r in quality_mil.score(df, quality_mil.fit(df, labels)).collect() if r.held_out]
    assert len(got) > 40 and np.mean([r.predicted == r.doc_id % 2 for r in got]) > 0.95


def test_samples_hold_one_row_an_id(spark):
    rows, labels = toxic_corpus(60)
    many = [*rows, *[(1, f"the other text {k}", "x") for k in range(500)], (2, "z" * 5000, "x")]
    df, known = spark.createDataFrame(many, SCHEMA), spark.createDataFrame(labels + labels, LABELS)
    for most in (5, 1000):
        got = training.sample(df, known, "toxic", most, longest=4000)[0].collect()
        assert len({r.id for r in got}) == len(got) <= 2 * most
        assert all(r.text == min(t for i, t, _ in many if i == r.id and len(t) <= 4000) for r in got)
    for module in (toxicity, quality_mil):
        assert module.score(df, module.fit(df, known)).count() == len(many)


def test_lexicon_totals_by_hand():
    rng = np.random.default_rng(5)
    lexicon = {"blar": 2.0, "blargh": 3.5, "snort": 1.25, "no ": 1.75, "scum": 4.0}
    model = toxicity.Model(lexicon, ["snort creek", "blarney", "scum"], [1.0, 1.0], 0.0)
    words = ["blar", "blargh", "blarghish", "blarney", "snort", "snorting", "creek", "no", "nose", "scum", "scummy", "xscum", "the"]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 5, 40, 400)]
    got = toxicity.totals(texts, model.automaton())
    for text, (total, n) in zip(texts, got, strict=True):
        own = text.split()
        spared = {i for i in range(len(own)) if own[i] in ("blarney", "scum")} | {j for i in range(len(own) - 1) if own[i : i + 2] == ["snort", "creek"] for j in (i, i + 1)}
        want = 0.0
        for i, word in enumerate(own):
            fits = [v for e, v in lexicon.items() if (word == e.strip() if e.endswith(" ") else word.startswith(e))]
            want += max(fits, default=0.0) if i not in spared else 0.0
        assert (n, total) == (len(own), pytest.approx(want))


def test_short_words_count_as_a_whole(spark):
    rows, labels = toxic_corpus(300)
    rows = [(i, t.replace("blarghish", "gak").replace("snortish", "gak").replace("gakness", "gak").replace("gakly", "gak"), x) for i, t, x in rows]
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS))
    assert "gak " in model.lexicon
    assert toxicity.totals(["what a gak", "what a gakkery"], model.automaton())[:, 0].tolist() == [model.lexicon["gak "], 0.0]


def test_held_out_accuracy(spark, sf):
    d = sf.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(d + "/documents.parquet"), spark.read.parquet(d + "/labels.parquet")
    got = quality_mil.score(docs, quality_mil.fit(docs, labels)).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95
    got = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.toxic).mean() > 0.93
