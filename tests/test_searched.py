"""Index, tokens, alignment, samples and layout against plain versions and fixtures."""

from __future__ import annotations

import re
from collections import Counter
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from quirework.functions.tokens import Phrases, tokens, tokens_at
from quirework.operators import align, layout, sequence
from quirework.operators.search_index import write_index
from quirework.plans import searched

WORD = re.compile(r"[^\W]+")


def test_search_equals_a_plain_search(spark, small):
    index = searched.indexed(spark, small)
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    counts = {d: Counter(t["text"].lower() for t in r["t"] or []) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", tokens_at("text").alias("t")).collect() for d in [r["doc_id"]]}
    for query in ("the", "THE with the", "de la que", "nowhere the", ""):
        terms = dict.fromkeys(query.lower().split())
        want = sorted(((-sum(c[t] for t in terms), d) for d, c in counts.items() if terms and all(c[t] for t in terms)))[:20]
        got = index.search(query).collect()
        assert sorted((-r["score"], r["doc_id"]) for r in got) == want
        for r in got:
            low = docs[r["doc_id"]]["text"].lower()
            first = min(m.start() for m in WORD.finditer(low) if m[0] in terms)
            begin = max(first - 40, 0)
            assert r["snippet"] == docs[r["doc_id"]]["text"][begin : begin + 80] and r["kind"] == docs[r["doc_id"]]["source"]
    page = index.search("the", limit=5).collect()
    last = max((-r["score"], r["doc_id"]) for r in page)
    then = index.search("the", limit=5, cursor=(-last[0], last[1])).collect()
    first_ten = sorted((-r["score"], r["doc_id"]) for r in index.search("the", limit=10).collect())
    assert sorted((-r["score"], r["doc_id"]) for r in [*page, *then]) == first_ten


def test_search_reads_its_terms_postings_alone(spark):
    rows = spark.range(4000).selectExpr("id AS k", "concat('common w', id % 50, ' u', id) AS text")
    from quirework.session import shared_path

    index = write_index(rows, shared_path(spark, "test"), "k", "text")
    found = index.postings(["w7"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [" in plan and "term" in plan.split("PushedFilters: [")[1].split("]")[0]
    found.collect()
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = scan.metrics().apply("numOutputRows").value()
    assert 80 <= read < index.postings().count() / 4 and found.count() == 80


def test_rows_without_terms_or_keys(spark):
    from quirework.session import shared_path

    rows = spark.createDataFrame([(1, None), (2, ""), (3, "... --"), (4, "Ab ab"), (None, "ab")], "k long, text string")
    index = write_index(rows, shared_path(spark, "test"), "k", "text")
    assert [(r["k"], r["score"]) for r in index.search("ab").collect()] == [(4, 2)]
    empty = write_index(rows.limit(0), shared_path(spark, "test"), "k", "text")
    assert empty.search("ab").collect() == []


def test_tokens_of_japanese_thai_and_mixed_text(spark):
    texts = {
        "東京へ行く": ["東", "京", "へ", "行", "く"],
        "コーヒーを2杯、iPhoneで": ["コ", "ー", "ヒ", "ー", "を", "2", "杯", "iPhone", "で"],
        "ภาษาไทย ok": None,
        "naïve cafés": ["naïve", "cafés"],
        "العربية ١٢": ["العربية", "١٢"],
        "がき": ["が", "き"],
        "": [],
        None: None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tokens_at("t").alias("at"), tokens(F.col("t")).alias("own")).collect()
    for r in rows:
        if r["t"] is None:
            assert r["at"] is None
            continue
        assert [x["text"] for x in r["at"]] == r["own"] and all(r["t"][x["start"] : x["end"]] == x["text"] for x in r["at"])
        if texts[r["t"]] is not None:
            assert r["own"] == texts[r["t"]]
    thai = next(r for r in rows if r["t"] and r["t"].endswith("ok"))["own"]
    assert thai[-1] == "ok" and "".join(thai[:-1]) == "ภาษาไทย" and len(thai) > 4


def test_quick_expressions_give_the_same_tokens():
    from quirework.functions import tokens as own

    def slow(text):
        pattern = own._ANY_TOKEN if own._UNSPACED.search(text) else own._SPACED_TOKEN
        return [(*m.span(), m[0]) for m in pattern.finditer(text)]

    for c in map(chr, [*range(0x300), *range(0x2010, 0x2028), *range(0x3000, 0x3100), *range(0x3400, 0x4DC0, 7), *range(0x4E00, 0xA000, 7)]):
        for text in (f"a{c}b{c}{c}1_ あ{c}漢{c}カ", f"a{c}b{c}{c}1_ {c}"):
            assert own.split(text) == slow(text), hex(ord(c))
    for text in ("e\u0301te\u0301 か\u3099", "あ\u200dい ก\u0e31น", ""):
        assert own.split(text) == slow(text)


def test_workers_cut_bounded_portions_of_a_batch():
    import pyarrow as pa

    from quirework.functions import tokens as own

    texts = ["Ab あいう ab " * (k % 90) for k in range(4000)] + [None, "", "x y" * 900_000, "é"]
    for made in (own.tokens_at, own.token_counts):
        parts = list(made.func(iter([pa.array(texts[:3000]), pa.array(texts[3000:]), pa.array([], pa.string())])))
        assert len(parts) > 3 and max(len(p.flatten()) for p in parts if len(p) > 1) < own._AT_ONCE
        rows = [row for p in parts for row in p.to_pylist()]
        assert len(rows) == len(texts)
        for text, row in zip(texts, rows):
            if text is None:
                assert row is None
                continue
            cut = own.split(text)
            if made is own.tokens_at:
                assert [(x["start"], x["end"], x["text"]) for x in row] == cut
            else:
                words = [w.lower() for _, _, w in cut]
                assert {x["text"]: (x["n"], x["start"]) for x in row} == {w: (n, cut[words.index(w)][0]) for w, n in Counter(words).items()}


def test_rows_of_one_key_are_one_text_and_postings_lie_by_hash(spark):
    from quirework.session import shared_path

    rows = spark.createDataFrame([(1, "Ab c ab"), (1, "ab d"), (2, "AB"), (2, None)], "k long, text string")
    index = write_index(rows, shared_path(spark, "test"), "k", "text")
    assert sorted(map(tuple, index.postings().select("term", "key", "n", "first").collect())) == [("ab", 1, 3, 0), ("ab", 2, 1, 0), ("c", 1, 1, 3), ("d", 1, 1, 3)]
    assert sorted(map(tuple, index.terms().collect())) == [("ab", 2, 4), ("c", 1, 1), ("d", 1, 1)]
    wide = write_index(spark.range(3000).selectExpr("id AS k", "concat('all w', id % 400) AS text"), shared_path(spark, "test"), "k", "text")
    placed = spark.read.parquet(f"{wide.path}/postings").select("hash", F.input_file_name().alias("f")).collect()
    lists = {}
    for r in placed:
        lists.setdefault(r["f"], []).append(r["hash"])
    assert len(placed) == 6000 and all(x == sorted(x) for x in lists.values())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = 0
        for j, y in enumerate(b):
            above, row[j + 1] = row[j + 1], max(row[j + 1], row[j], above + 1 if x == y else 0)
    return row[-1]


def test_rising_chains_and_common_tokens_equal_dynamic_programming():
    import random

    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randrange(1, 25))] for _ in range(2))
        found, (at, size) = align.common(a, b)
        assert len(found) == lcs(a, b) and all(a[i] == b[j] for i, j in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))
        match = SequenceMatcher(None, a, b, autojunk=False).find_longest_match()
        assert size == match.size and (not size or "".join(b[at : at + size]) in "".join(a))


def test_alignments_equal_a_plain_search_of_all_pairs(spark, small):
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu".split()
    docs += [
        (9001, "x y " + " ".join(base) + " z"),
        (9002, "x " + " ".join(w for k, w in enumerate(base) if k != 5) + " z"),
        (9003, "Alpha beta, gamma DELTA epsilon zeta eta other words here " * 3),
        (9004, " filler filler filler ".join(" ".join(base[k : k + 4]) for k in (0, 4, 8))),
        (9005, " ".join(base[::-1])),
        (9006, "東京へ行く人は多い。"),
    ]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    items += [(9001, " ".join(base)), (9002, "kappa"), (9003, "へ行く人"), (9004, ""), (9005, None)]
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in align.align_items(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    cut = {r["t"]: [(x["start"], x["end"], x["text"].lower()) for x in r["at"]] for r in spark.createDataFrame([(t or "",) for _, t in docs + items], "t string").distinct().select("t", tokens_at("t").alias("at")).collect()}
    want = set()
    for i, item in items:
        asked = [w for _, _, w in cut[item or ""]]
        if not asked:
            continue
        k = min(3, len(asked))
        grams = [tuple(asked[p : p + k]) for p in range(len(asked) - k + 1)]
        for d, text in docs:
            read = [w for _, _, w in cut[text]]
            shared = set(grams) & {tuple(read[p : p + k]) for p in range(len(read) - k + 1)}
            exact = any(read[p : p + len(asked)] == asked for p in range(len(read)))
            row = got.get((d, i))
            if exact:
                want.add((d, i))
                assert row["status"] == "exact" and row["coverage"] == 1.0
            elif row:
                assert shared
                inside = [w for a, b, w in cut[text] if row["start"] <= a and b <= row["end"]]
                assert lcs(asked, inside) == row["matched"] and row["matched"] >= len(inside) / 3
                assert row["status"] == ("fuzzy" if row["matched"] >= 0.75 * len(asked) else "lesser")
    assert want <= set(got) and {(9001, 9001), (9002, 9001), (9003, 9001), (9001, 9002), (9005, 9002), (9006, 9003)} <= set(got)
    assert got[9002, 9001]["status"] == "fuzzy" and got[9003, 9001]["status"] == "lesser" and (9005, 9001) not in got and (9004, 9001) in got


def test_first_rows_of_a_hot_key_pass_in_bounded_parts(spark):
    rows = spark.range(50_000).selectExpr("CASE WHEN id % 10 < 9 THEN 'hot' ELSE concat('k', id % 100) END AS key", "50000 - id AS line")
    found = sequence.first_k(rows, ["key"], ["line"], 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4
    kept = {}
    for r in sorted(rows.collect(), key=lambda r: r["line"]):
        kept.setdefault(r["key"], []).append(r["line"])
    assert {(r["key"], r["line"]) for r in found.collect()} == {(k, x) for k, v in kept.items() for x in v[:3]}


def test_phrases_at_word_boundaries(spark):
    text = "The cat; concat, THE CAT sat. İthe the_cat the cat"
    rows = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    whole = rows.select(Phrases(["the cat", "cat", "sat. ", " "]).at(F.col("t")).alias("p")).collect()
    want = sorted((m.end(), m.start(), p) for p in ("the cat", "cat") for m in re.finditer(rf"(?<!\w){p}(?!\w)", text, re.I))
    got = [(x["end"], x["start"], x["text"]) for x in whole[0]["p"]]
    assert [x for x in got if x[2] != "sat. "] == want and any(x[2] == "sat. " for x in got)
    assert whole[1]["p"] is None and whole[2]["p"] == []
    loose = rows.select(Phrases(["cat"], whole=False, fold=False).at(F.col("t")).alias("p")).first()["p"]
    assert len(loose) == text.count("cat")
    assert rows.select(Phrases([]).at(F.col("t")).alias("p")).first()["p"] == []


def test_layout_checks(spark):
    pages = spark.createDataFrame([("w", 1, "نص عربي طويل\nwith Latin\nuses the API now\nrapid APIs"), ("w", 2, " \n 12 "), ("w", 3, None), ("v", 1, "نص عربي فقط هنا")], "work_id string, page long, text string")
    sources = spark.createDataFrame([("w", "#qrcode(\n 'x', width: 31mm) #qrcode('y', width: 30mm) #qrcode('z', width: 40.5mm)"), ("v", None)], "work_id string, text string")
    got = {(r["work_id"], r["code"]): (r["severity"], r["n"]) for r in layout.layout_findings(pages, sources).collect()}
    assert got == {
        ("w", "latin_letters_visible"): ("warn", 3),
        ("w", "technical_terms_visible"): ("warn", 1),
        ("w", "code_too_wide"): ("warn", 2),
        ("w", "blank_page"): ("info", 2),
    }
    noise = spark.createDataFrame([("١٢ (3) ـ",), ("  ",), (None,), ("12 a",)], "t string").select(layout.is_body_noise(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in noise] == [True, True, True, False]


def test_folds_longer_than_a_block(spark):
    from quirework.operators import spans

    text = " ".join(f"w{k}" if k % 3 else str(k) for k in range(700))
    row = spark.createDataFrame([(text,)], "t string").select(spans.spans_of(F.col("t"), "[0-9]+", "n").alias("s")).first()["s"]
    assert [(s["start"], s["end"], s["text"]) for s in row] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)]
    given = [(k * 7 % 500, k * 7 % 500 + 1 + k % 9) for k in range(300)]
    kept, last = [], 0
    for a, b in sorted(given):
        if a >= last:
            kept.append((a, b))
            last = b
    swept = spark.createDataFrame([(given,)], "s array<struct<start:int,end:int>>").select(spans.non_overlapping(F.col("s")).alias("k")).first()["k"]
    assert [tuple(s) for s in swept] == kept
    heads = [("w", k, 1 + k * 5 % 4, f"t{k}") for k in range(200)]
    stack, want = [], {}
    for _, k, level, title in heads:
        stack = [*stack[: level - 1], title]
        want[k] = list(stack)
    got = sequence.section_paths(spark.createDataFrame(heads, "work string, at long, level int, title string"), "work", "at", "level", "title").collect()
    assert {r["at"]: r["section_path"] for r in got} == want


def test_short_quotes_are_found_by_one_automaton(spark):
    from quirework.operators import spans

    docs = [(1, "one two three"), (2, "twofold tw o"), (3, "x  y"), (4, None)]
    quotes = [(1, "two"), (2, "e tw"), (3, "x y"), (4, " "), (5, "x  y"), (6, "one two three"), (7, "two")]
    got = spans.grounded(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(quotes, "item_id long, text string")).collect()
    want = {(d, q, t.index(w), t.index(w) + len(w)) for d, t in docs for q, w in quotes if t and w.strip() and w in t}
    assert {tuple(r) for r in got} == want
