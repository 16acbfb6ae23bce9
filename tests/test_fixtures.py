"""Literal rows for semantics that the generated tables do not show."""

from __future__ import annotations

import json
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quirework.functions import text as T
from quirework.operators import annotations, cleaning, editions, fuzzy, matching, quality, records, report, selection, sequence, source_spans
from quirework.plans import annotated
from quirework.sources import readers


def value(spark, col, **row):
    kinds = {str: "string", int: "int", bool: "boolean", list: "array<string>", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], schema).select(col.alias("v")).first()["v"]


def headings(spark, levels, titles=None):
    rows = [("w", k, level, (titles or "ABCDEFGH")[k]) for k, level in enumerate(levels)]
    return spark.createDataFrame(rows, "work string, n long, level int, title string")


def test_skipped_levels_lengthen_a_path_by_one(spark):
    rows = headings(spark, [1, 3, 3, 1])
    paths = {r["n"]: r["section_path"] for r in sequence.section_paths(rows, "work", "n", "level", "title").collect()}
    assert paths == {0: ["A"], 1: ["A", "B"], 2: ["A", "B", "C"], 3: ["D"]}
    assert [r["n"] for r in sequence.level_skips(rows, "work", "n", "level").collect()] == [1]


def test_entries_take_each_heading_once(spark):
    toc, found = spark.createDataFrame([("k",)] * 3, "key string"), spark.createDataFrame([("k",)] * 2, "key string")
    r = matching.multiset_match(toc, found, "key").first()
    assert (r["matched"], r["unmatched"]) == (2, 1)


@pytest.mark.parametrize(("text", "want", "runs"), [("***", "", 1), ("a ** b", "a، b", 1), ("a*b*", "a، b،", 2), ("* *", "،", 2), ("plain", "plain", 0)])
def test_runs_of_stars(spark, text, want, runs):
    tidy, n = T.replace_stars(F.col("t"))
    assert value(spark, tidy, t=text) == want and value(spark, n, t=text) == runs


def test_nearest_rank_percentiles(spark):
    rows = spark.createDataFrame([("w", "x" * n) for n in range(1, 11)], "work string, text string")
    r = quality.length_profile(rows, "text", "work").first()
    assert (r["len_p50"], r["len_p90"], r["len_p95"]) == (5, 9, 10)


def test_truncation_leaves_room_for_its_mark(spark):
    assert value(spark, T.truncate(F.col("t"), 180), t="x" * 181) == "x" * 179 + "…"
    assert value(spark, T.truncate(F.col("t"), 180), t="x" * 180) == "x" * 180


def test_short_passage_is_one_span(spark):
    text = "بسم اللّٰه الرحمن الرحيم"
    (s,) = value(spark, source_spans.source_spans(F.col("t")), t=text)
    assert (s["span_id"], s["start"], s["end"], s["kind"], s["reason"]) == ("S1", 0, len(text), "matn", "short_whole_passage")


def test_spans_in_their_order_and_bounds_of_display(spark):
    text = "x" * 270 + " قال الله } كلام بين الأقواس { ثم قال السخاوي قولا. " + "قال رسول الله هذا قول طويل يكفي."
    spans = value(spark, source_spans.source_spans(F.col("t")), t=text)
    assert [s["reason"] for s in spans] == ["brace_quran_candidate", "hadith_opener", "quote_source:قال السخاوي"]
    assert all(text[s["start"] : s["end"]] == s["text"] for s in spans)
    shown = value(spark, source_spans.display_bounds(F.col("t"), F.lit("ayah"), F.lit(spans[0]["start"]), F.lit(spans[0]["end"])), t=text)
    assert text[shown["start"]] == "}" and text[shown["end"] - 1] == "{"


def test_length_outliers(spark):
    odd = T.length_outlier(F.col("target"), F.col("source"))
    got = [value(spark, odd, target="x" * n, source="x" * m) for n, m in ((20, 100), (25, 100), (400, 100), (401, 100), (401, 79), (400, 79))]
    assert got == [True, False, False, True, True, False]


def test_print_markers_and_line_cleaning(spark):
    lines = ["## عنوان  ( x )", "اــب‎ ج", "Microsoft VBScript runtime error", "إِ نَّ الكلام", "ا  َ", "a b"]
    rows = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    got = {r["n"]: r for r in cleaning.clean_lines(rows).collect()}
    assert [got[k]["cleaned"] for k in range(6)] == ["## عنوان (x)", "اب ج", "", "إِنَّ الكلام", "اَ", "a b"]
    assert got[0]["changes"]["paren_spacing_fixed"] == 2 and got[1]["changes"]["tatweel_removed"] == 2 and got[1]["changes"]["bidi_controls_removed"] == 1
    assert got[2]["changes"]["drop_runtime_error_lines"] == 1 and got[3]["changes"]["common_particle_joined"] == 1 and got[5]["changes"]["nbsp_replaced"] == 1
    report_ = {r["counter"]: r["n"] for r in cleaning.change_report(cleaning.clean_lines(rows)).collect()}
    assert report_["lines"] == 6 and report_["stars_replaced"] == 0 and "bad_glyph_removed" not in report_
    assert value(spark, cleaning.fix_print_markers(F.col("t")), t="كلام ط(، آخر") == "كلام، آخر"
    assert cleaning.profile_rules({"default": ["a"], "x": ["a", "b"]}, "x") == ["a", "b"] and cleaning.profile_rules({"default": ["a"]}, "?") == ["a"]


def test_suspicious_lines_stop_at_their_limit(spark):
    rows = spark.createDataFrame([("w", k, "a * {x} word") for k in range(5)], "work string, n int, line string")
    found = cleaning.suspicious(rows, "work", "n", "line", limit=4).collect()
    assert {(r["n"], r["pattern"]) for r in found} == {(k, p) for k in (0, 1) for p in ("star_leftover", "latin_word", "brace_marker")}


def test_drafts_by_opener(spark):
    rows = [(1, "قال تعالى كلام", []), (2, "اللهم صل", []), (3, "قال النبي كذا", []), (4, "بيت أول\nبيت ثان", ["قصيدة البردة"]), (5, "صَلِّ على", ["الصلاة على النبي"]), (6, "كلام", None)]
    got = {r["doc_id"]: r for r in annotations.draft(spark.createDataFrame(rows, "doc_id int, text string, path array<string>"), section="path").collect()}
    assert [(got[k]["kind"], got[k]["layout"], got[k]["confidence"]) for k in range(1, 7)] == [
        ("ayah", "ayah_text_block", 0.68),
        ("matn", "matn_block", 0.8),
        ("quote", "quote_block", 0.72),
        ("poem", "poem_block", 0.64),
        ("matn", "matn_block", 0.8),
        ("body", "body", 0.52),
    ]
    assert got[6]["signals"] == ["default_body"] and got[2]["signals"] == ["matn_opening_or_shalawat_section", "short_devotional_opening"]


def test_merge_gate_and_merge(spark):
    drafts = spark.createDataFrame([(k, "body", "body", "body", 0.52, ["default_body"]) for k in "abcd"], "id string, kind string, role string, layout string, confidence double, signals array<string>")
    proposals = spark.createDataFrame([(k, "hadith", "hadith_block", 0.9) for k in "abcx"], "id string, kind string, layout string, confidence double")
    found = spark.createDataFrame([("a", "warn"), ("b", "warn"), ("c", "fail")], "id string, severity string")
    gate = annotations.merge_gate(drafts, proposals, found, approved=["b", "c"])
    assert {r["id"]: r["reason"] for r in gate.collect()} == {"a": "needs_approval", "b": "accepted", "c": "has_failures", "x": "no_draft"}
    got = {r["id"]: r for r in annotations.merged(drafts, proposals, gate, approved=["b"]).collect()}
    assert (got["b"]["kind"], got["b"]["role"], got["b"]["layout"], got["b"]["status"]) == ("hadith", "quote", "quote_block", "reviewed")
    assert got["b"]["signals"] == ["default_body", "llm_component:hadith_block", "llm_semantic_proposal"] and got["a"]["kind"] == "body" and len(got) == 4
    role = annotations.resolved_role(F.col("r"), F.col("k"), F.col("l"))
    assert [value(spark, role, r=r, k=k, l=x) for r, k, x in (("ayat", "x", "x"), ("?", "dua", "x"), (None, None, "poem_block"), (None, "?", "poem_block"))] == ["ayat", "matn", "poem", None]


def test_segment_index_out_of_range_gives_no_segment(spark):
    found = spark.createDataFrame([("p", "invalid_segment", "fail", 5, None), ("p", "x", "warn", None, "s")], "id string, code string, severity string, segment_index long, sample string")
    proposals = spark.createDataFrame([("p", "quote", [("quote", "r", "t")])], "id string, kind string, segments array<struct<kind:string,ref:string,text:string>>")
    rows = annotations.queue_items(found, proposals, spark.createDataFrame([("p", 3)], "id string, sequence int")).orderBy(*annotations.queue_order()).collect()
    assert [(r["queue_id"], r["segment_kind"], r["priority_rank"], r["issue_type"]) for r in rows] == [("p:s5:invalid_segment", None, 40, "invalid_segment"), ("p:row:x", None, 40, "x")]


def test_translation_of_another_language(spark):
    rows = spark.createDataFrame([("A.en", "A", "id", "draft", "kata", 1)], "id string, source_id string, lang string, status string, text string, source_sequence int")
    source = spark.createDataFrame([("A", 1, "كلمة")], "id string, sequence int, text string")
    assert {r["code"] for r in editions.translation_findings(rows, source).collect()} == {"id_shape"}


def test_json_lines_with_a_broken_one(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": \n{"a": 2}\n')
    schema = StructType.fromDDL("a long")
    rows = readers.read_jsonl_with_errors(spark, str(tmp_path / "x.jsonl"), schema).collect()
    assert [(r["line_no"], r["row"] and r["row"]["a"], r["error"]) for r in rows] == [(1, 1, None), (3, None, "invalid JSON"), (4, 2, None)]
    assert [r["line_no"] for r in readers.read_jsonl_with_errors(spark, str(tmp_path / "no.jsonl"), schema).collect()] == [0]
    assert readers.read_jsonl_or_empty(spark, str(tmp_path / "no.jsonl"), schema).count() == 0
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), schema).collect()


def test_manuscript_elements_sections_and_profile(spark):
    lines = ["---", "title: x", "---", "# A", "lost", '::passage{id="P-1"}', "one", "two", "### B", "### B", '::passage{id="P-2"}', "", '::passage{id="P-3"}', "three", "# C"]
    rows = spark.createDataFrame([("w", k, x) for k, x in enumerate(lines)], "work_id string, line_no long, line string")
    elements = readers.manuscript_elements(rows)
    got = [(r["kind"], r["id"] or r["title"], r["section_path"], r["text"]) for r in elements.orderBy("at").collect()]
    assert got == [
        ("heading", "A", ["A"], None),
        ("passage", "P-1", ["A"], "one\ntwo"),
        ("heading", "B", ["A", "B"], None),
        ("heading", "B", ["A", "B", "B"], None),
        ("passage", "P-3", ["A", "B", "B"], "three"),
        ("heading", "C", ["C"], None),
    ]
    assert [r["passage_ids"] for r in readers.manuscript_sections(elements).orderBy("at").collect()] == [["P-1"], [], ["P-3"], []]
    p = readers.manuscript_profile(elements).first()
    assert (p["headings"], p["h1"], p["h3"], p["passages"], p["skipped_levels"], p["adjacent_duplicates"]) == (4, 2, 2, 2, 1, 1)
    written = readers.manuscript_lines(elements).orderBy("at", "part")
    again = readers.manuscript_elements(written.select("work_id", F.row_number().over(Window.orderBy("at", "part")).alias("line_no"), "line").withColumn("line_no", F.col("line_no").cast("long")))
    assert {r["id"]: r["text"] for r in again.where("kind = 'passage'").collect()} == {"P-1": "one\ntwo", "P-3": "three"}


def test_heading_levels_by_profile(spark):
    toc = spark.createDataFrame([("w", 1, 1, "preface"), ("w", 2, 2, "part one"), ("w", 3, 9, "Life of A"), ("w", 4, 3, "note")], "work_id string, index int, level int, title string")
    got = readers.heading_levels(toc, [(2, "^part", 1), (None, "^note", 0)], start="^Life", before=2, after=3).orderBy("index").collect()
    assert [(r["level"], r["level_source"]) for r in got] == [(2, "default"), (1, "rule"), (3, "default"), (1, "rule")]
    assert [r["level"] for r in readers.heading_levels(toc, []).orderBy("index").collect()] == [1, 2, 6, 3]


def test_a_second_sync_changes_nothing(spark):
    passages = spark.createDataFrame([("a",), ("b",)], "id string").withColumn("edition_refs", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<type:string,label:string,page:bigint>>")))
    pages = spark.createDataFrame([("e", "a", 1, None)], "edition string, id string, page long, label string")
    once = editions.sync_refs(passages, pages, "e")
    twice = editions.sync_refs(once, pages, "e")
    flat = lambda df: df.select("id", F.col("edition_refs")["e"]["label"].alias("label"))
    assert matching.synced(flat(once), flat(twice), "id", ["label"]).count() == 0 and matching.synced(flat(passages), flat(once), "id", ["label"]).count() == 1


def test_noise_and_punctuation(spark):
    assert [value(spark, T.is_noise(F.col("t")), t=t) for t in ("١٢ - 3.", "", "a1", "(5)")] == [True, False, False, True]
    assert [value(spark, T.is_punctuation(F.col("t")), t=t) for t in (" ، ", "", "a")] == [True, False, False]


def test_proposal_findings_by_type(spark):
    text = "abcdef"
    good = {"id": "p", "primary_kind": "quote", "layout_component": "quote_block", "confidence": 1, "segments": [{"kind": "quote", "text": "bc", "source_span": {"start": 1, "end": 3}}]}
    cases = [
        (good, set()),
        ({**good, "confidence": True}, {"invalid_confidence"}),
        ({**good, "confidence": "1"}, {"invalid_confidence"}),
        ({**good, "segments": None}, set()),
        ({**good, "segments": {}}, {"invalid_segments"}),
        ({**good, "segments": ["x"]}, {"invalid_segment"}),
        ({**good, "segments": [{"kind": "prose", "text": "bc", "source_span": {"start": 0, "end": 2}}]}, {"source_span_text_mismatch"}),
        ({**good, "segments": [{"kind": "prose", "text": "ef", "source_span": {"start": 4, "end": 99}}]}, set()),
        ({**good, "segments": [{"kind": "ayah", "text": "a", "ref": "r", "review_required": True}]}, set()),
        ({**good, "reason_ar": "the PDF file"}, {"latin_technical_term_in_arabic_label"}),
        ({**good, "reason_ar": "rolex"}, set()),
    ]
    raw = spark.createDataFrame([(json.dumps({**c, "id": f"p{k}"}),) for k, (c, _) in enumerate(cases)], "raw string")
    passages = spark.createDataFrame([(f"p{k}", text) for k in range(len(cases))], "id string, text string")
    got = {}
    for r in annotations.proposal_findings(raw, passages).collect():
        got.setdefault(r["id"], set()).add(r["code"])
    assert [got.get(f"p{k}", set()) for k in range(len(cases))] == [want for _, want in cases]


def test_records(spark):
    comment = {"target_type": "revision", "target_id": "t", "work_id": "w", "body": "b", "status": "active", "created_by": "u", "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"}
    check = lambda doc: value(spark, records.violations(F.col("t"), records.COMMENT), t=json.dumps(doc))
    assert check(comment) == [] and check({**comment, "passage_id": None}) == []
    assert check({**comment, "body": "", "x": 1}) == ["unknown:x", "empty:body"] and check({**comment, "status": 5}) == ["type:status"]
    role = {"uid": "u", "roles": {"editor": True, "king": False, "admin": "yes"}, "active": True, "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-01T00:00:00Z"}
    assert value(spark, records.role_violations(F.col("t")), t=json.dumps(role)) == ["role:admin", "role:king"]
    edit = lambda a, b: value(spark, records.may_edit_revision(F.col("a"), F.col("b"), F.lit("u")), a=json.dumps(a), b=json.dumps(b))
    old = {"created_by": "u", "status": "draft", "target": "toc.entry", "proposed_value": "x"}
    assert edit(old, {**old, "proposed_value": "y", "status": "submitted"}) and not edit(old, {**old, "target": "passage.text"}) and not edit(old, {**old, "status": "applied"})


def test_selection(spark):
    rows = spark.createDataFrame([(f"p{k}", k, f"t{k}") for k in range(10)], "id string, sequence int, text string")
    assert selection.parse_ids(["p3,p1", " p3 "]) == ["p3", "p1"]
    assert [r["id"] for r in selection.by_ids(rows, ["p3", "p1"], requested_order=True).collect()] == ["p3", "p1"]
    assert [r["id"] for r in selection.by_ids(rows, ["p3", "p1"]).collect()] == ["p1", "p3"]
    with pytest.raises(ValueError, match="p99"):
        selection.by_ids(rows, ["p99", "p1"], strict=True)
    assert [r["id"] for r in selection.sliced(rows, "sequence", 2, 2).collect()] == ["p2", "p3"]
    reason = F.when(F.col("sequence") == 7, "why")
    assert [(r["id"], r["reason"]) for r in selection.candidates(rows, reason, "sequence", 3).collect()] == [("p7", "why"), ("p0", "sequence spread sample"), ("p3", "sequence spread sample")]
    places = spark.createDataFrame([("p4", 0), ("p2", 1)], "id string, place long")
    assert [r["id"] for r in selection.by_list(rows.where("sequence < 5"), "id", places, "sequence").collect()] == ["p4", "p2", "p0", "p1", "p3"]
    keys = spark.createDataFrame([("10",), ("9",), ("x",)], "k string")
    assert [r["k"] for r in keys.orderBy(*selection.numeric_order("k")).collect()] == ["9", "10", "x"]
    pages = spark.createDataFrame([(1, "author"), (2, "x"), (3, "y")], "page int, kind string")
    toc = spark.createDataFrame([(3,)], "page int")
    assert [r["page"] for r in selection.without_front_pages(pages, toc, keep=F.col("kind") == "author").orderBy("page").collect()] == [1, 3]


def test_report_of_an_empty_corpus(spark):
    passages = spark.createDataFrame([], "work_id string, id string, sequence long, lang string, text string, review_status string, source_blocks array<struct<pdf_page:int,block_id:string,bbox:array<double>>>")
    assert report.report(report.passages_report(passages)).count() == 0


def test_page_headings_equal_plain_scores(spark, small):
    """Keys, scores and the greedy choice written plainly, on pages of ASCII text."""
    titles, blocks = annotated.heading_blocks(spark, small)
    held = {}
    for r in blocks.collect():
        held.setdefault(r["page"], []).append((r["block_no"], r["text"]))
    key = lambda t: re.sub(r"[^\w]", "", t)

    def score(title, text):
        a, b = key(title), key(text)
        if not a or not b or len(a) <= 14 and a in b and len(b) > len(a) + 6:
            return 0.0
        s = 1 - min(0.35, (len(b) - len(a)) / len(a) * 0.12) if a in b else 0.88 if b in a and len(b) >= 8 else SequenceMatcher(None, a, b).ratio()
        numbered = bool(re.search(r"\s[0-9]+(\.[0-9]+)+\s*$", text.strip()))
        if text.strip() == title.strip():
            s = 1.0
        elif text.strip().startswith(title.strip()) and not numbered:
            s = max(s, 0.99)
        return max(0.0, min(1.0, s - 0.35 * text.strip().startswith(".") - 0.55 * numbered + 0.08 * (len(b) <= len(a) + 8)))

    want = {}
    for r in titles.orderBy("page", "toc_index").collect():
        used = {b for (p, _), (b, _) in want.items() if p == r["page"]}
        scored = [(-score(r["title"], t), b) for b, t in held[r["page"]] if b not in used]
        if scored and -min(scored)[0] >= 0.62:
            want[r["page"], r["toc_index"]] = (min(scored)[1], -min(scored)[0])
    got = {(r["page"], r["toc_index"]): (r["block_no"], r["score"]) for r in annotated.page_headings(spark, small).collect()}
    assert got.keys() == want.keys() and len(got) > 10
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in got)


def test_titles_of_the_exact_family_and_inline(spark):
    score = fuzzy.title_score(F.col("a"), F.col("b"))
    assert [value(spark, score, a="الصلاة الأولى", b=b) for b in ("الصلاة الأولى", "الصلاة الأولى وشرحها", "الصلاة الثانية", "الصلاة الأولى ١.٢")] == [1.0, 0.99, 0.0, 0.0]
    texts = spark.createDataFrame([(1, 1, "Intro here"), (1, 2, "see الصلاة الأولى now"), (1, 3, "an Intro")], "page int, block_no int, text string")
    titles = spark.createDataFrame([(1, 1, "Intro"), (1, 2, "Intro here"), (1, 3, "الصلاة الأولى")], "page int, toc_index int, title string")
    got = {r["block_no"]: (r["toc_index"], r["start"], r["end"]) for r in fuzzy.inline_title(texts, titles).collect()}
    assert got == {1: (2, 0, 10), 2: (3, 4, 17)}


def test_fuzzy_grounding_holds_what_it_promises(spark, small):
    """Every turn has a row; exact places hold the quote, fuzzy ones three quarters of its words in order, and dense."""
    turns = {(r["conv_id"], r["turn"]): r["text"] for r in spark.read.parquet(f"{small}/conversations.parquet").collect()}
    rows = annotated.fuzzy_grounding(spark, small).collect()
    assert {(r["conv_id"], r["turn"]) for r in rows} == set(turns)
    seen = set()
    for r in rows:
        text = turns[r["conv_id"], r["turn"]] or ""
        quote = re.sub(r"^([^ ]+) [^ ]+", r"\1 changed", re.match(r"[^.]*", text)[0])
        seen.add(r["status"])
        if r["status"] == "exact":
            assert quote and text[r["start"] : r["end"]] == quote
        elif r["status"] == "fuzzy":
            place, words = text[r["start"] : r["end"]].lower().split(), quote.lower().split()
            common = [[0] * (len(words) + 1) for _ in range(len(place) + 1)]
            for i, a in enumerate(place):
                for j, b in enumerate(words):
                    common[i + 1][j + 1] = common[i][j] + 1 if a == b else max(common[i][j + 1], common[i + 1][j])
            assert common[-1][-1] >= 0.75 * len(words) and 3 * len(words) >= len(place)
        else:
            assert quote not in text or not quote
    assert {"fuzzy", "none"} <= seen


def test_new_passages_by_gap_and_indent(spark):
    opens = sequence.new_passage(F.col("t"), F.col("y0"), F.col("y1"), F.col("x0"))
    row = lambda t, y0, y1, x0: spark.createDataFrame([(t, y0, y1, x0)], "t string, y0 double, y1 double, x0 double").select(opens.alias("v")).first()["v"]
    assert [row("a", 118.0, 100.0, 10.0), row("a", 118.1, 100.0, 10.0)] == [False, True]
    assert [row("a", 101.0, 100.0, 150.0), row("a", 101.0, 100.0, 150.1)] == [False, True]
    assert row("قال x", 101.0, 100.0, 10.0) and row("a", None, None, None) and not row("a", 20.0, 700.0, 10.0)


def test_places_and_even_filling(spark):
    rows = spark.createDataFrame([(x,) for x in (5, 70_000, 3, 200_000, 5, 70_001)], "n long")
    assert sorted((r["n"], r["place"]) for r in sequence.placed(rows, "n").collect()) == [(3, 0), (5, 1), (5, 2), (70_000, 3), (70_001, 4), (200_000, 5)]
    ten = spark.range(10).withColumnRenamed("id", "n")
    # two are missing: every third row, the first not counted
    assert sorted(r["n"] for r in sequence.spread_fill(ten, ten.where("n = 3"), "n", 3).collect()) == [3, 6, 9]
    assert [r["n"] for r in sequence.spread_fill(ten, ten.where("n = 3"), "n", 1).collect()] == [3]


def test_entities_in_a_text_without_spaces(spark):
    rows = spark.createDataFrame([("東京都で山田が会社株式会社を", q) for q in ("東京都", "山田", "会社株式会社")], "text string, quote string")
    assert [(r["start"], r["end"], r["status"]) for r in fuzzy.align(rows).collect()] == [(0, 3, "exact"), (4, 6, "exact"), (7, 13, "exact")]
