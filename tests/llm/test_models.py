"""The models against plain versions: Kneser-Ney numbers, margins of the quality model, accuracy on rows not learnt from."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quirework.llm import kneser_ney, mixing, quality_rules, tokens
from quirework.llm.decontamination import containment_pairs
from quirework.llm.pii import personal_spans
from quirework.llm.quality_rules import fit_quality_model
from quirework.llm.toxicity import toxicity_scores
from quirework.llm.url_filters import link_verdicts

FOLD = {i: i + 32 for i in range(65, 91)}
BLANK = re.compile(r"[\x20\x09-\x0D]+")
NAMES = "node token size place h key rank hashes levels good fold base terms own context part n score hash id _id _hash".split()


def words(text):
    return [w for w in BLANK.split((text or "").translate(FOLD)) if w]


def plain_kneser_ney(texts):
    """log P(text) under the interpolated modified Kneser-Ney model of some texts, by dictionaries."""
    three, two, one = Counter(), defaultdict(set), defaultdict(set)
    for ws in map(words, texts):
        for i, w in enumerate(ws):
            one[w] |= {(ws[i - 1], w)} if i else set()
            if i:
                two[ws[i - 1], w] |= {tuple(ws[i - 2 : i + 1])} if i > 1 else set()
            if i > 1:
                three[tuple(ws[i - 2 : i + 1])] += 1
    n1, n2 = ({k: max(1, len(v)) for k, v in t.items()} for t in (one, two))

    def discounts(counts):
        c = Counter(counts.values())
        if min(c[1], c[2], c[3]) == 0:
            return [0.5] * 3
        y = c[1] / (c[1] + 2 * c[2])
        return [min(max(k - (k + 1) * y * c[k + 1] / c[k], 0.05), k - 0.05) for k in (1, 2, 3)]

    tables = [n1, n2, three]
    d = [discounts(t) for t in tables]
    minus = lambda order, n: d[order][min(n, 3) - 1]
    total, left = sum(n1.values()), sum(minus(0, n) for n in n1.values())
    kinds, gamma = len(n1) + 1, left / total
    sums, lefts = [Counter(), Counter()], [Counter(), Counter()]
    for order in (1, 2):
        for gram, n in tables[order].items():
            sums[order - 1][gram[:-1]] += n
            lefts[order - 1][gram[:-1]] += minus(order, n)

    def chance(gram):
        if len(gram) == 1:
            n = n1.get(gram[0], 0)
            return (n - minus(0, n) if n else 0) / total + gamma / kinds
        order, context = len(gram) - 1, gram[:-1]
        lower = chance(gram[1:])
        if not sums[order - 1][context]:
            return lower
        n = tables[order].get(gram, 0)
        return (n - minus(order, n) if n else 0) / sums[order - 1][context] + lefts[order - 1][context] / sums[order - 1][context] * lower

    return lambda text: sum(math.log(chance(tuple(ws[max(0, i - 2) : i + 1]))) for ws in [words(text)] for i in range(len(ws)))


@pytest.fixture(scope="module")
def docs(spark, small):
    return [(r["doc_id"], r["lang"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang", "text").collect()]


@pytest.mark.parametrize("head", [1 << 18, 100])
def test_op8_perplexities_equal_a_plain_model(spark, docs, head):
    learnt = [t for d, _, t in docs if d % 3 and t]
    rows = spark.createDataFrame([*docs, (-1, "en", "never seen words zq zq"), (-2, "en", None), (-3, "en", learnt[0].split()[0])], "doc_id long, lang string, text string")
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in learnt], "text string").repartition(3), head=head)
    log = plain_kneser_ney(learnt)
    got = {r["doc_id"]: r["perplexity"] for r in kneser_ney.perplexities(rows, model).collect()}
    for d, _, text in rows.collect():
        ws = words(text)
        if not ws:
            assert got[d] is None
        else:
            assert math.isclose(got[d], math.exp(min(-log(text) / len(ws), 700)), rel_tol=1e-6), d
    assert len(got) == len(docs) + 3


def prose(rng, k):
    vocabulary = ["the", "house", "stood", "near", "a", "quiet", "river", "and", "children", "played", "there", "until", "evening", "came"]
    return " ".join(rng.choice(vocabulary) for _ in range(k)).capitalize() + "."


def junk(rng, k):
    return " ".join("".join(rng.choice("xqzj0189$%") for _ in range(rng.randrange(2, 12))) for _ in range(k))


def test_op3_model_tells_rows_apart_that_it_has_not_seen(spark):
    rng = random.Random(1)
    rows = [(k, (prose if k % 2 else junk)(rng, rng.randrange(12, 60))) for k in range(600)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, quality int")
    got = {r["doc_id"]: r["probability"] for r in quality_rules.quality_rules(documents, labels).collect()}
    fresh = [(got[k], k % 2) for k in range(300, 600)]
    assert all((p >= 0.5) == bool(y) for p, y in fresh)
    error = np.mean([(p - y) ** 2 for p, y in fresh])
    assert error < 0.02 and 0 < min(got.values()) and max(got.values()) < 1


def test_op3_margins_equal_plain_sums(spark, docs):
    rng = random.Random(2)
    rows = [(k, (prose if k % 2 else junk)(rng, 30)) for k in range(60)]
    model = fit_quality_model(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int"))
    texts = [t for _, _, t in docs[:40]] + [None, "", "a", "ab", "é ü"]
    got = quality_rules._margins(tokens.words(pa.array(texts, pa.string()), fold=False), model)
    bits = quality_rules._BITS
    for text, margin in zip(texts, got):
        w = tokens.words(pa.array([text], pa.string()), fold=False)
        one = [int(h) >> (64 - bits) for h in w.hash]
        pair = [(int(h) >> (64 - bits)) + (1 << bits) for h in tokens.shingles(w, 2)[0]]
        code = [int.from_bytes(c.encode(), "little") for c in text or ""]
        mask = (1 << 32) - 1
        char = [((((a * 0x9E3779B1 & mask) + b) * 0x9E3779B1 + c & mask) * 0x9E3779B1 & mask) >> (32 - bits) for a, b, c in zip(code, code[1:], code[2:])]
        want = model.bias
        for places in (one, pair, [(x) + (2 << bits) for x in char]):
            want += sum(float(model.weights[p]) for p in places) / max(1, len(places))
        assert math.isclose(margin, want, rel_tol=1e-4, abs_tol=1e-4)


def test_op5_scores_rows_apart_that_it_has_not_seen(spark):
    rng = random.Random(4)
    insults = ["you are a stupid idiot", "shut up you moron", "you disgusting fool", "you pathetic loser"]
    def text(k):
        base = prose(rng, rng.randrange(15, 40))
        return f"{base} {rng.choice(insults)}! {prose(rng, 5)} {rng.choice(insults)}" if k % 5 == 0 else base
    rows = [(k, text(k), "en") for k in range(1500)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(1500)], "doc_id long, toxic int")
    got = toxicity_scores(documents, labels).collect()
    held = [(r["score"], r["doc_id"] % 5 == 0) for r in got if r["held_out"]]
    assert len(held) > 200 and sum((s >= 0.3) == y for s, y in held) > 0.97 * len(held)
    error = np.mean([(s - y) ** 2 for s, y in held])
    assert error < 0.03


def test_ties_repeats_and_orders_of_rows_give_one_result(spark):
    rng = random.Random(6)
    base = [(k, prose(rng, 25) if k % 3 else junk(rng, 25), "en") for k in range(60)]
    rows = base + [(100 + k, base[k % 4][1], "en") for k in range(12)] + base[:5]
    labels = [(k, int(k % 3 > 0), int(k % 3 == 0)) for k in range(60)]
    a, b = (spark.createDataFrame(x, "doc_id long, text string, lang string").repartition(n) for x, n in ((rows, 1), (rows[::-1], 4)))
    la, lb = (spark.createDataFrame(x, "doc_id long, quality int, toxic int").repartition(n) for x, n in ((labels, 1), (labels[::-1], 3)))
    items = spark.createDataFrame([(1, base[1][1]), (2, base[1][1]), (3, base[2][1])], "item_id long, text string")
    said = lambda df: sorted(map(repr, df.collect()))
    assert said(quality_rules.quality_rules(a, la).selectExpr("doc_id", "kept", "round(probability, 4)")) == said(quality_rules.quality_rules(b, lb).selectExpr("doc_id", "kept", "round(probability, 4)"))
    assert said(kneser_ney.perplexity_filter(a, la)) == said(kneser_ney.perplexity_filter(b, lb))
    assert said(containment_pairs(a, items)) == said(containment_pairs(b, items))
    pages = [(k, f"http://h{k % 3}.net/{k}", f'<a href="http://h{(k + 1) % 3}.net/">') for k in range(9)] * 2 + [(90, "http://x.org/", '<a href="http://h1.net/">')]
    pa_, pb = (spark.createDataFrame(x, "page_id long, url string, html string").repartition(n) for x, n in ((pages, 1), (pages[::-1], 3)))
    assert said(link_verdicts(pa_).select("page_id", "host", "rule", "verdict")) == said(link_verdicts(pb).select("page_id", "host", "rule", "verdict"))


def test_clashing_columns_on_every_table_change_nothing(spark, small, tmp_path):
    read = lambda name: spark.read.parquet(f"{small}/{name}.parquet")
    documents, labels, items, pages = (read(n) for n in ("documents", "labels", "benchmark", "pages"))
    more = lambda df: df.withColumns({c: F.lit("x") for c in NAMES if c not in df.columns})
    said = lambda df: sorted(map(repr, df.collect()))
    assert said(kneser_ney.perplexity_filter(more(documents), more(labels))) == said(kneser_ney.perplexity_filter(documents, labels))
    assert said(containment_pairs(more(documents), more(items))) == said(containment_pairs(documents, items))
    cut = lambda df: said(df.select("page_id", "host", "path", "rule", "verdict"))
    assert cut(link_verdicts(more(pages))) == cut(link_verdicts(pages))
    for name, table in (("documents", more(documents)), ("labels", more(labels)), ("benchmark", more(items))):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    want = {(r["doc_id"], r["copies"]) for r in corpus_pipeline.run(spark, small).collect()}
    assert {(r["doc_id"], r["copies"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want and want


def test_op9_recalls_planted_terms_and_leaves_common_words(spark):
    rng = random.Random(8)
    rows = [(k, prose(rng, 30)) for k in range(400)]
    for person in range(12):
        for k in range(8):
            rows.append((1000 + 10 * person + k, f"{prose(rng, rng.randrange(5, 15))} {prose(rng, 3)[:-1]} Nick{person}name {prose(rng, 4)} p{person}@mail.org {prose(rng, 6)}"))
    got = {r["doc_id"]: r["terms"] for r in personal_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    planted = hit = wrong = 0
    for d, text in rows:
        spans = {(t["start"], t["end"]) for t in got[d]}
        names = {m.span() for m in re.finditer(r"Nick\d+name", text)}
        planted, hit, wrong = planted + len(names), hit + len(names & spans), wrong + len(spans - names)
    assert planted == 96 and hit >= 0.9 * planted and wrong == 0


def test_op1_rounds_stay_few_on_heavy_tails(spark, monkeypatch):
    rng = np.random.default_rng(3)
    sizes = np.minimum(np.maximum(1, rng.lognormal(3.5, 1.6, 4000)).astype(int), 5000)
    rows = [(int(k), "w " * int(n), f"s{k % 6}") for k, n in enumerate(sizes)]
    rounds, real = [], mixing.stage
    monkeypatch.setattr(mixing, "stage", lambda df, what: (rounds.append(what), real(df, what))[1])
    got = mixing.pareto_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert rounds.count("mix-round") <= 16
    for s in {r["source"] for r in got}:
        of = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= 0.01 * of[0]["target"]
