"""Quality, toxicity, language and URL models: held-out accuracy, parts
against brute force, and odd inputs."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from docflow.llm import langid, quality, toxicity, url_filter
from docflow.llm.common import crc_mod, read
from tests.conftest import SF_CHECK


# --- quality ---------------------------------------------------------------

def test_quality_held_out(spark):
    docs, labels = read(spark, SF_CHECK, "documents"), read(spark, SF_CHECK, "labels")
    held = crc_mod("doc_id", 5) == 0
    out = quality.classify(docs, labels.filter(~held))
    assert out.count() == docs.count()
    x = out.join(labels, "doc_id").filter(held).select("quality", "score").collect()
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in x) / len(x) >= 0.95
    assert all(0 <= r.score <= 1 for r in x)


def test_quality_learns_a_pair_of_features():
    r = np.random.default_rng(1)
    x = r.random((3000, len(quality.NAMES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)     # no single feature tells
    m = quality.fit(x, y, rounds=20)
    t = r.random((500, len(quality.NAMES)))
    assert (2, 5) in [(i, j) for i, j, _ in m.pairs]
    assert ((m.score(t) >= 0.5) == ((t[:, 2] > 0.5) ^ (t[:, 5] > 0.5))).mean() > 0.9


def test_quality_scores_are_bin_additions():
    r = np.random.default_rng(2)
    x = r.random((400, len(quality.NAMES)))
    m = quality.fit(x, (x[:, 0] > 0.5).astype(float), rounds=5)
    row = x[7]
    at = [int((e <= v).sum()) for e, v in zip(m.edges, row)]
    z = m.base + sum(t[a] for t, a in zip(m.tables, at)) + sum(t[m.pair_bins[i][at[i]], m.pair_bins[j][at[j]]] for i, j, t in m.pairs)
    assert m.score(x[7:8])[0] == pytest.approx(1 / (1 + np.exp(-z)))


def test_quality_odd_inputs(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "word " * 50_000), (None, "a"), (5, "é 漢字 \ud83d\ude00".encode("utf-16", "surrogatepass").decode("utf-16"))]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.classify(docs, none).collect()
    assert len(got) == len(rows) and all(x.score == 0.5 for x in got)
    one = quality.classify(docs, spark.createDataFrame([(1, 1), (1, 1), (2, None)], "doc_id long, quality int")).collect()
    assert len(one) == len(rows) and all(x.score == pytest.approx(2.5 / 3) for x in one)
    assert quality.classify(docs.limit(0), none).collect() == []
    assert quality.features("") == quality.features("") and not np.isnan(quality.features("")).any()


# --- toxicity --------------------------------------------------------------

def symbols(words):
    g = toxicity.Grammar(toxicity.seed_lexicon(), {}, toxicity.DEFAULT)
    return [(g.look(w) or (0, 0))[0] * 8 for w in words.split()]


def marks(words):
    return [s & 7 for s in toxicity.BACKWARD.run(toxicity.FORWARD.run(symbols(words))[::-1])[::-1]]


def test_composed_machine_equals_its_parts():
    r = random.Random(3)
    parts = [toxicity.Transducer.window(t) for t in (toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT)]
    for _ in range(200):
        s = [r.randrange(6) * 8 for _ in range(r.randrange(12))]
        one = s
        for p in parts:
            one = p.run(one)
        assert toxicity.FORWARD.run(s) == one


def test_marks():
    T, N, R = toxicity.TARGETED, toxicity.NEGATED, toxicity.REPORTED
    assert marks("you utter idiot") == [0, 0, T]
    assert marks("idiot that you are") == [T, 0, 0, 0]
    assert marks("not an idiot") == [0, 0, N]
    assert marks("claimed the man an idiot")[-1] == R
    assert marks("the a b c d idiot") == [0] * 6


def test_clause_scores():
    g = toxicity.Grammar(toxicity.seed_lexicon(), {"slur": 5.0}, toxicity.DEFAULT)
    plain, targeted, negated = (g.clauses(t)[0] for t in ("an idiot.", "you idiot.", "not an idiot."))
    assert targeted > plain > negated > 0
    assert g.clauses("I will kill time.") == [] and len(g.clauses("I will kill you. idiot, scum!")) == 3
    assert g.clauses("slurry here") == [5.0] and g.clauses("slur") == []
    assert g.score(None) == g.score("") == g.score("fine words") < 0.3


def test_toxicity_held_out_and_learned_words(spark):
    r = random.Random(4)
    vocab = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(20)]
    rows, labels = [], []
    for i in range(1200):
        words = [r.choice(vocab) for _ in range(60)]
        bad = i % 8 == 0
        if bad:
            for _ in range(3):
                words[r.randrange(60)] = "blurg" + r.choice("abcdefghij") + "x"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = crc_mod("doc_id", 4) == 2
    g = toxicity.fit(docs, lab.filter(~held))
    assert "blurg" in g.prefixes and g.look("blurgzzz")[0] == toxicity.INSULT     # unseen, by its pattern
    x = toxicity.scores(docs, g).join(lab, "doc_id").filter(held).collect()
    assert sum((s.score >= 0.3) == (s.toxic == 1) for s in x) / len(x) > 0.98
    kept = toxicity.score(docs, g)
    assert kept.columns == ["doc_id", "text", "__docflow_score"] and kept.filter("__docflow_score >= 0.3").count() == 150


def test_words_of_a_copied_text_are_not_learned(spark):
    r = random.Random(5)
    vocab = [f"v{i}".replace("0", "o").replace("1", "l").translate(str.maketrans("23456789", "abcdefgh")) for i in range(400)]
    bad = "unique rarity wording " + " ".join(r.choice(vocab) for _ in range(30))
    rows = [(i, bad + " " + r.choice(vocab)) for i in range(60)] + [(100 + i, " ".join(r.choice(vocab) for _ in range(40))) for i in range(600)]
    labels = [(i, int(i < 60)) for i, _ in rows]
    g = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert "rarity" not in g.lexicon


def test_toxicity_odd_inputs(spark):
    rows = [(1, None), (2, ""), (3, "idiot " * 50_000), (None, "a"), (4, "\n\n..!!")]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1), (2, 1), (3, None)], "doc_id long, toxic int")):
        got = {x.doc_id: x.score for x in toxicity.scores(docs, toxicity.fit(docs, labels)).collect()}
        assert len(got) == 5 and got[3] > 0.3 > got[1] == got[2] == got[4]
    assert toxicity.scores(docs.limit(0), toxicity.fit(docs.limit(0), none)).collect() == []


# --- language --------------------------------------------------------------

def test_language_held_out(spark):
    docs = read(spark, SF_CHECK, "documents")
    held = crc_mod("doc_id", 4) == 2
    out = langid.predict(docs, langid.fit(docs.filter(~held)))
    assert out.count() == docs.count()
    x = out.join(docs, "doc_id").filter(held).collect()
    assert sum(r.lang == r.lang_pred for r in x) / len(x) > 0.97 and all(0 <= r.score <= 1 for r in x)


def test_word_first_then_longest_known_grams():
    table = lambda rows: langid.Table(pa.array(list(rows), pa.large_string()), np.array(list(rows.values())).reshape(len(rows), 2))
    m = langid.Model(["a", "b"], table({"known": [-1.0, -9.0]}), {4: table({"\x02new": [-2.0, -3.0]}), 3: table({"unk": [-3.0, -1.0], "nkn": [-1.0, -1.0]}),
                                                                  2: table({}), 1: table({"z": [-5.0, -4.0]})})
    got = m.vectors(pa.array(["known", "newly", "unknow", "zzz", "qq"]))
    assert got.tolist() == [[-1.0, -9.0], [-2.0, -3.0], [-2.0, -1.0], [-5.0, -4.0], [0.0, 0.0]]


def brute_language(train, texts):
    """Plain dictionaries of all words and n-grams of the training texts."""
    find = lambda t: regex.findall(r"\p{L}+", (t or "").lower())
    marked = lambda w, n: f"\x02{w}\x03" if n > 1 else w
    grams = lambda w, n: [marked(w, n)[i:i + n] for i in range(len(marked(w, n)) - n + 1)] if n else [w]
    langs = sorted({x for _, x in train if x is not None})
    count = {n: {x: Counter(g for t, y in train if y == x for w in find(t) for g in grams(w, n)) for x in langs} for n in range(5)}
    keys = {n: set().union(*count[n].values()) for n in count}
    log = lambda n, g: [math.log10((count[n][x][g] + 0.5) / (sum(count[n][x].values()) + 0.5 * (len(keys[n]) + 1))) for x in langs]

    def word(w):
        for n in (0, 4, 3, 2, 1):
            known = [log(n, g) for g in grams(w, n) if g in keys[n]]
            if known:
                return [sum(c) / len(known) for c in zip(*known)]
        return [0.0] * len(langs)
    out = []
    for t in texts:
        ws = find(t)
        if not ws:
            out.append(("und", 0.0))
            continue
        total = [sum(c) for c in zip(*map(word, ws))]
        p = [10 ** ((x - max(total)) / len(ws) * min(len(ws), 20)) for x in total]
        out.append((langs[total.index(max(total))], max(p) / sum(p)))
    return out


def test_predictions_are_those_of_plain_dictionaries(spark):
    r = random.Random(4)
    vocab = {x: ["".join(r.choice(letters) for _ in range(r.randint(1, 8))) for _ in range(30)] for x, letters in (("a", "abcdé"), ("b", "cdefß"), ("c", "acfgñ"))}
    make = lambda x: r.choice([" ", ", ", " 7 "]).join(r.choice(vocab[x]).title() for _ in range(r.choice([1, 4, 30])))
    train = [(make(x), x) for x in "abc" for _ in range(15)] + [("x y", None), (None, "a"), ("once", "c")]
    texts = [make(r.choice("abc")) + r.choice(["", " zzgg", " abß"]) for _ in range(60)] + [None, "", "12 !?", "once"]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(train)], "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), langid.fit(docs)).collect()}
    for i, (lang, score) in enumerate(brute_language(train, texts)):
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score), i
    assert got[63].lang_pred == "c"          # known from one occurrence


def test_the_sample_is_bounded_by_language(spark):
    rows = [(i, f"w{i}" if i % 5 else "rare", "big" if i % 5 else "small") for i in range(5000)]
    m = langid.fit(spark.createDataFrame([(i, t.translate(str.maketrans("0123456789", "abcdefghij")), x) for i, t, x in rows], "doc_id long, text string, lang string"), per_lang=200)
    assert m.langs == ["big", "small"] and 120 < len(m.words.keys) < 300


def test_counts_are_exact(spark):
    docs = spark.createDataFrame([("x", "Ab ab, c1d"), ("x", None), ("y", "ab É é")], "lang string, text string")
    got = {(r.lang, r.word): r.n for r in langid.count_words(docs).collect()}
    assert got == {("x", "ab"): 2, ("x", "c"): 1, ("x", "d"): 1, ("y", "ab"): 1, ("y", "é"): 2}


def test_language_odd_inputs(spark):
    train = spark.createDataFrame([(i, "der die und nicht", "de") for i in range(5)] + [(9 + i, "the of and not", "en") for i in range(5)] + [(50, "x", None), (None, "y", "en")],
                                  "doc_id long, text string, lang string")
    m = langid.fit(train)
    docs = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (3, "12 !?", "q"), (4, "nicht und " * 40_000, "q"), (None, "the", "q")], "doc_id long, text string, score string")
    got = {x.doc_id: x for x in langid.predict(docs, m).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, None)] == ["und", "und", "und", "de", "en"] and got[1].score == 0
    nothing = langid.fit(train.limit(0))
    assert {x.lang_pred for x in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), m).collect() == []


# --- URLs ------------------------------------------------------------------

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = None
    for v, h, p in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, *(best or (None, None))


def test_rules_match_brute_force(spark):
    urls = [None, "", "no scheme", "http://Example.ORG", "http://example.org/", "http://a.example.org/es/x?y#z", "https://notexample.org/es/", "http://x.com/fr/",
            "http://x.com/de/1", "http://com/de/", "http://x.com?/de/", "a://b://c/d", "http://example.org/en/12#f", "http://example.org/en/2", "http://É.Com/fr/\nx", "//x.org/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {x.page_id: x for x in url_filter.url_filter(df, RULES).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = brute_url(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == verdict or (verdict is None and got[i].verdict in ("allow", "block"))


def test_markov_is_a_distribution():
    from collections import Counter
    c = Counter(g for t in ("abab", "abba", "baab") for g in url_filter.grams(t, 2))
    m = url_filter.Markov(dict(c), 2)
    for ctx in ("", "a", "ab", "zz"):
        seen = sum(np.exp(m.logp(url_filter.START + ctx + x)) for x in "ab")
        rest = np.exp(m.logp(url_filter.START + ctx + "q")) * 254
        assert seen + rest == pytest.approx(1.0)


def test_language_model_separates_unruled_urls(spark):
    r = random.Random(1)
    rows = []
    for i in range(400):
        good = i % 2 == 0
        word = "".join(r.choice("aeiou" if good else "xzqkw") for _ in range(12))
        rows.append((i, f"http://s.{'org' if good else 'com'}/{'' if good else 'de/'}{word}" if i < 300 else f"http://s.net/{word}"))
    got = url_filter.url_filter(spark.createDataFrame(rows, "page_id long, url string"), RULES).filter("rule is null").collect()
    assert len(got) == 100 and sum((x.verdict == "allow") == (x.page_id % 2 == 0) for x in got) > 95


def test_urls_without_a_model(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://a.org/x")], "page_id long, url string")
    assert [(x.verdict, x.lm) for x in url_filter.url_filter(df, RULES).orderBy("page_id").collect()] == [("allow", None), ("allow", None)]
    assert url_filter.url_filter(df.limit(0), RULES).collect() == []
    assert url_filter.calibrate(df.limit(0).select(F.lit(0.0).alias("lm"), F.lit("allow").alias("verdict"))) == 0.0


# --- bounded samples -------------------------------------------------------

def test_samples_are_the_lowest_hashes(spark):
    from docflow.llm.common import sample_ids
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 3 == 0).cast("string").alias("c"))
    low = [r.id for r in df.orderBy(F.xxhash64("id")).limit(300).collect()]
    assert sorted(r.id for r in sample_ids(df, "id", 300).collect()) == sorted(low)
    assert sample_ids(df, "id", 10_000).count() == 5000
    by = sample_ids(df, "id", 200, "c")
    assert {r.c: r["count"] for r in by.groupBy("c").count().collect()} == {"true": 200, "false": 200}
    want = {r.id for r in df.filter("c = 'true'").orderBy(F.xxhash64("id")).limit(200).collect()}
    assert {r.id for r in by.filter("c = 'true'").collect()} == want
    assert sample_ids(df.limit(0), "id", 5).count() == 0 and sample_ids(df.limit(0), "id", 5, "c").count() == 0
