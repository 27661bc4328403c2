"""The URL models against dictionaries of all n-grams."""

import random
from collections import Counter

import pytest

from docflow.llm import url_filter as U

RULES = [("allow", "good.org", ""), ("block", "bad.com", "")]


@pytest.mark.parametrize("head", [5, U.HEAD])
def test_every_ngram_counts_in_both_models(spark, head):
    r = random.Random(3)
    urls = [f"http://{r.choice(['good.org', 'bad.com', 'other.net'])}/{''.join(r.choice('abcdé-/') for _ in range(r.randrange(25)))}" for _ in range(120)]
    urls += [None, "", "http://other.net/zzz"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {x.page_id: x for x in U.url_filter(df, RULES, head=head).collect()}
    of = lambda h: U.Markov(dict(Counter(g for u in urls if u and f"//{h}/" in u for g in U.grams(u))))
    good, bad = of("good.org"), of("bad.com")
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        s = U.START + (u or "")
        ends = [s[max(0, k - U.ORDER):k + 1] for k in range(1, len(s))]
        assert got[i].lm == pytest.approx(sum(good.logp(g) - bad.logp(g) for g in ends) / max(1, len(ends)), abs=1e-9)
