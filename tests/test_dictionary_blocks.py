"""Term search against brute force, in one block and in several."""

import random

import pytest

from docflow.operators import keywords as K
from docflow.operators import term_search
from docflow.operators.term_search import Automaton, search_terms


@pytest.mark.parametrize("most", [2, None])
def test_hits_do_not_depend_on_the_blocks(spark, most):
    docs = spark.createDataFrame([(1, "red fish"), (2, "blue"), (3, None)], "doc_id long, text string")
    terms = spark.createDataFrame([(0, "en", "red"), (1, "fr", "red"), (2, "en", "fish"), (3, "fr", "blue"), (4, "en", ""), (5, "en", None)], "term_id long, lang string, term string")
    got = {r.doc_id: r for r in K.hits_per_lang(docs, "text", terms, most).collect()}
    assert [(x.term_id, x.lang, x.term) for x in got[1].kw_found] == [(0, "en", "red"), (1, "fr", "red"), (2, "en", "fish")]
    assert (got[1].hits_en, got[1].hits_fr, got[2].hits_en, got[2].hits_fr) == (2, 1, 0, 1)
    assert got[3].kw_found == [] and got[3].hits_en == 0


@pytest.mark.parametrize("table", [0, term_search.TABLE])
def test_automaton_finds_what_in_finds(monkeypatch, table):
    monkeypatch.setattr(term_search, "TABLE", table)
    r = random.Random(3)
    for _ in range(120):
        letters = "abé𝄞"[:r.choice([1, 2, 4])]
        word = lambda n: "".join(r.choice(letters) for _ in range(n))
        terms = list({word(r.randint(1, r.choice([3, 9]))) for _ in range(r.randint(1, 15))})
        texts = [word(r.choice([0, 1, 5, 40, 700])) for _ in range(r.randint(1, 8))]
        assert list(zip(*Automaton.build(terms).search(texts), strict=True)) == [
            (i, j) for i, t in enumerate(texts) for j, w in enumerate(terms) if w in t]


@pytest.mark.parametrize("most", [300, None])
def test_search_of_many_terms(spark, most):
    r = random.Random(4)
    word = lambda a, b: "".join(r.choice("abcde ") for _ in range(r.randint(a, b)))
    terms = [(i, r.choice(["x", "y"]), word(1, 6)) for i in range(400)]
    texts = [(i, word(0, 300)) for i in range(40)] + [(99, "e" * 20000 + "abc"), (98, "")]
    docs = spark.createDataFrame(texts, "i long, kw_found string").repartition(3).withColumnRenamed("kw_found", "t")
    got = search_terms(docs, "t", spark.createDataFrame(terms, "term_id int, lang string, term string"), block_chars=most).collect()
    assert {x.i: [tuple(k) for k in x.kw_found] for x in got} == {i: sorted(t for t in terms if t[2] in s) for i, s in texts}


def test_a_large_dictionary_has_no_bound(spark):
    terms = spark.range(200_000).selectExpr("id AS term_id", "'en' AS lang", "concat('t', hex(id), '.') AS term")
    docs = spark.createDataFrame([(1, "t2A. and t1869F."), (2, "t30D40."), (3, "t30D3F.")], "i long, text string")
    out = K.hits_per_lang(docs, "text", terms)
    assert "t1869F" not in out._jdf.queryExecution().toString()      # no term in the plan
    assert {r.i: [k.term_id for k in r.kw_found] for r in out.collect()} == {1: [42, 99_999], 2: [], 3: [199_999]}


def test_no_terms_and_no_texts(spark):
    none = spark.createDataFrame([], "term_id int, lang string, term string")
    docs = spark.createDataFrame([(1, "a")], "i long, text string")
    assert [r.kw_found for r in search_terms(docs, "text", none).collect()] == [[]]
    assert search_terms(docs.limit(0), "text", spark.createDataFrame([(1, "en", "a")], none.schema)).collect() == []
    assert K.any_term(docs, "text", none).first().keyword_flag is False
