"""License scan, wavelet search and fill-in-middle against brute-force versions, on awkward rows and tiny chunks."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.llm import fill_middle, registry, wavelet_search
from quirework.llm.fill_middle import fill_in_middle, restored
from quirework.llm.license_scan import TEMPLATES, Template, license_scan
from quirework.llm.wavelet_search import ranked_search

FOLD = {i: i + 32 for i in range(65, 91)}
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CLASHING = "row text at hash words template label place n l ids first last query terms rank score part state units chars form digest h1 h2 doc_id2 spans".split()


def terms(text):
    return [w.translate(FOLD) for w in TERM.findall(text or "")]


@pytest.fixture(scope="module")
def docs(spark, small):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_fill_in_middle"])
def test_queries_equal_their_oracles(spark, small, name):
    con = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = registry.queries()[name](spark, small)
    got = sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())
    result = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    at = [names.index(c) for c in sorted(df.columns)]
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in result.fetchall()) and len(got) > 100


def scanned(text, templates, k, drift=8, reach=64):
    """(base places by label, {(label, first, last, coverage)}) of a text, by plain loops."""
    ws = terms(text)
    grams = {}
    for i in range(len(ws) - k + 1):
        grams.setdefault(tuple(ws[i : i + k]), []).append(i)
    base, spans = [], set()
    for t in templates:
        own = terms(t.text)
        votes = {}
        for j in range(len(own) - k + 1):
            for i in grams.get(tuple(own[j : j + k]), ()):
                votes.setdefault(i - j, []).append((i, j))
        if t.percent == 100:
            for d in votes:
                if ws[max(d, 0) : d + len(own)] == own and d >= 0:
                    spans.add((t.label, d, d + len(own), 1.0))
                    if t.base:
                        base.append((t.label, d))
            continue
        chain, first, group = [], None, {}
        last = None
        for d in sorted(votes):
            if last is None or d - last > drift:
                first = d
            group.setdefault((first, (d - first) // reach), []).extend(votes[d])
            last = d
        for held in group.values():
            covered = {j + x for _, j in held for x in range(k)}
            begin, end = min(i for i, _ in held), max(i for i, _ in held) + k
            if 100 * len(covered) >= t.percent * len(own) and end - begin <= 2 * len(covered):
                spans.add((t.label, begin, end, len(covered) / len(own)))
    return base, spans


def licenses(rng):
    """Texts with whole, cut, changed and repeated templates between other words."""
    out = []
    for n, t in enumerate(TEMPLATES):
        ws = t.text.split()
        noise = lambda k: " ".join(rng.choice(["alpha", "the", "software", "Beta.", "under", "mit"]) for _ in range(k))
        changed = [w if rng.random() > 0.08 else "zzz" for w in ws]
        longer = [x for w in ws for x in ([w, "extra"] if rng.random() < 0.06 else [w])]
        out += [f"{noise(5)} {t.text} {noise(9)}", f"{t.text.upper()}\n\n{t.text}", " ".join(changed), f"{noise(3)} {' '.join(longer)}", " ".join(ws[: len(ws) // 2])]
    out += ["under the mit license under the MIT License!", "under\nthe (mit) license, cc-by-nc; CC BY NC cc by nc", "cc by nc by nc", "a " * 5000 + "apache license version 2 " * 300]
    return [(10_000 + k, t) for k, t in enumerate(out)]


def test_op11_equals_plain_voting(spark, docs):
    rows = docs + licenses(random.Random(3)) + [(-1, None), (-2, ""), (-3, "mit license"), (-4, "cc by nc"), (-4, "cc by nc")]
    got = license_scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert len(got) == len(rows)
    by = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9)) for r in got)
    want = Counter()
    for d, text in rows:
        base, spans = scanned(text, TEMPLATES, 3)
        places = [p for _, p in base]
        want[
            d, len(terms(text)), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for x, _ in base})),
            ",".join(sorted({s[0] for s in spans})), round(max((s[3] for s in spans), default=0.0), 9),
        ] += 1
    assert by == want
    spans = {r["doc_id"]: {(s["label"], s["first"], s["last"], s["coverage"]) for s in r["spans"] or []} for r in got}
    assert all(spans[d] == scanned(text, TEMPLATES, 3)[1] for d, text in rows)
    phrases = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
    for d, text in rows:
        ws, found = terms(text), []
        for label, p in phrases:
            found += [(i, label) for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
        assert any(k[0] == d and k[2] == len(found) and k[5] == ",".join(sorted({x for _, x in found})) for k in by)


def test_op11_merges_diagonals_and_turns_down_templates_that_cannot_vote(spark):
    template = Template("x", " ".join(f"w{k}" for k in range(40)))
    words = [f"w{k}" for k in range(40)]
    moved = " ".join(words[:15] + ["put", "in"] + words[15:28] + words[31:])
    row = license_scan(spark.createDataFrame([(1, moved), (2, " ".join(words[:20]))], "doc_id long, text string"), (template,)).orderBy("doc_id").collect()
    assert (row[0]["labels"], row[1]["labels"]) == ("x", "") and row[0]["score"] == pytest.approx(37 / 40)
    with pytest.raises(ValueError):
        license_scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"), (Template("y", "two words"),))


def plain_search(docs, items, k=10):
    held = [(d, terms(t)) for d, t in docs if terms(t)]
    n, total, df = len(held), sum(len(w) for _, w in held), Counter()
    counted = [(d, len(ws), Counter(ws)) for d, ws in held]
    for _, _, c in counted:
        df.update(c.keys())
    out = []
    for i, text in items:
        asked, scores = Counter(terms(text)), []
        for d, size, c in counted:
            m = 100 - 75 + (75 * size * n) // total
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in asked.items() if c[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_bytes,block_terms", [(1, 1 << 18), (4000, 7), (16 << 20, 1 << 18)])
def test_op12_equals_plain_scores(spark, docs, shard_bytes, block_terms):
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(60)], k=rng.randrange(1, 60))) for _ in range(120)]
    rows = [(1000 - k, t) for k, t in enumerate(texts)] + [(2000 + k, texts[k % 3]) for k in range(40)] + [(None, texts[0]), (1, None), (2, ""), (3, "--"), (4, texts[5]), (4, texts[5])]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 12)))) for k in range(20)] + [(50, texts[0]), (51, "V0 v0 unheard-of"), (52, None), (53, ""), (54, "v59")]
    frame = lambda x, key: spark.createDataFrame(x, f"{key} long, text string")
    got = ranked_search(frame(rows, "doc_id").repartition(4), frame(items, "item_id"), shard_bytes=shard_bytes, block_terms=block_terms).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=repr) == plain_search(rows, items)


def test_op12_trees_keep_postings_by_impact_and_prune(monkeypatch):
    rng = np.random.default_rng(2)
    docs, size = 3000, 40
    row = np.repeat(np.arange(docs), size)
    term = np.concatenate([np.sort(rng.choice(500, size, replace=False)) for _ in range(docs)]).astype(np.uint64)
    tf = rng.integers(1, 9, len(row))
    lengths = np.bincount(row, tf).astype(np.int64)
    total = int(tf.sum())
    made = wavelet_search.build(np.arange(docs), np.zeros(docs, bool), lengths, row, term, tf, docs, total)
    shard = wavelet_search.Shard({k: v.tobytes() for k, v in made.items()}, docs, total)
    for a, b in zip(shard.ends[:-1], shard.ends[1:]):
        assert (np.diff(shard.impact[0, a:b]) <= 0).all()
    asked, weights = np.array([3, 77, 201, 444], np.uint64), np.array([900, 400, 700, 1200])
    got = shard.best(asked, weights, 10, wavelet_search.Best.none())
    impact = wavelet_search.impacts(tf, lengths[row], docs, total)
    score = np.zeros(docs, np.int64)
    for t, w in zip(asked, weights):
        np.add.at(score, row[term == t], w * impact[term == t])
    want = np.lexsort((np.arange(docs), -score))[:10]
    assert got.id.tolist() == want.tolist() and got.score.tolist() == score[want].tolist()
    seen = []
    monkeypatch.setattr(wavelet_search, "_STEP", 8)
    whole = shard.impact

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, tuple) and isinstance(at[1], np.ndarray):
                seen.append(at[1].shape[0])
            return whole[at]

    shard.impact = whole.view(Counted)
    shard.best(asked, weights, 10, wavelet_search.Best.none())
    assert sum(seen) < 2 * docs


def plain_cut(doc_id, text, percent=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return n, form, len(p), len(m), out


@pytest.mark.parametrize("chunk", [7, 600, 1 << 15])
def test_op13_cuts_equal_plain_cuts_in_chunks_of_any_size(spark, docs, chunk):
    rng = random.Random(chunk)
    odd = ["", None, "\n", "\n\n\n", "no end", "end\n", "ä\nö\n漢字\n🙂", "a<P>b\n" * 9, "<", "<P", "<<S>>", "x\n<M", "M>\n<", "x" * 5000, "line\n" * 3000, "é" * 3 + "\n" + "🙂\n" * 700, "\r\n\r\n"]
    odd += ["".join(rng.choice(["a", "\n", "<", "P", ">", "é", "🙂", "S", "M"]) for _ in range(rng.randrange(1, 90))) for _ in range(150)]
    rows = [(500_000 + k, t) for k, t in enumerate(odd)] + [(None, "a\nb\nc"), (3, "a\nb\n"), (3, "a\nb\n")] + (docs if chunk != 7 else docs[:30])
    made = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), chunk=chunk)
    got = made.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    want = Counter((d, *plain_cut(d, t), t or "") for d, t in rows)
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got) == want


def test_op13_shares_and_marks(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["form"] for r in fill_in_middle(frame, percent=60, spm_percent=20).collect()}
    assert got == {d: plain_cut(d, t, 60, 20)[1] for d, t in docs}
    assert 0 < sum(f == "plain" for f in got.values()) < len(got)
    with pytest.raises(ValueError):
        fill_in_middle(frame, marks=("<<P", "<S", "<M"))


def test_op13_automaton_is_smallest_and_composes():
    auto = fill_middle.unit_automaton(("<P>", "<S>", "<M>"))
    assert auto.states == 8 and auto.step[:, 0].shape == (7,)
    data = np.frombuffer(b"ab\n<<P>x\n\n<S" * 40, np.uint8)
    kinds = auto.kind[data]
    state, units = fill_middle.scan(auto, kinds, np.array([0]), np.array([len(data)]))
    cut = np.array([0, 13, 77, 200])
    parts = fill_middle.scan(auto, kinds, cut, np.diff(np.append(cut, len(data))))
    whole = fill_middle.compose(*parts, np.array([True, False, False, False]))
    assert (whole[0][-1] == state[0]).all() and (whole[1][-1] == units[0]).all()


@pytest.mark.parametrize("empty", [False, True], ids=["awkward", "empty"])
def test_awkward_empty_and_clashing(spark, empty):
    rows = [(1, "a b\nc d"), (1, "a b\nc d"), (2, None), (None, ""), (3, "word " * 40_000), (None, "cc by nc")]
    frame = spark.createDataFrame(rows[: 0 if empty else None], "doc_id long, text string")
    clash = frame.withColumns({c: F.lit("x") for c in CLASHING if c not in ("text",)})
    items = spark.createDataFrame([(1, "a word"), (None, "cc"), (2, None)][: 0 if empty else None], "item_id long, text string").withColumns({c: F.lit("x") for c in CLASHING if c not in ("text",)})
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(license_scan(clash)) == key(license_scan(frame)) and license_scan(frame).count() == (0 if empty else 6)
    assert key(fill_in_middle(clash)) == key(fill_in_middle(frame)) and fill_in_middle(frame).count() == (0 if empty else 6)
    found = key(ranked_search(clash, items))
    assert found == key(ranked_search(frame, items.select("item_id", "text"))) and bool(found) != empty
