"""Core operators on literal fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import annotations, editions, fuzzy, matching, quality, selection, sequence, spans
from quirework.sources import readers
from quirework.streaming import ingest


def value(spark, col, **row):
    return spark.createDataFrame([tuple(row.values())], list(row)).select(col.alias("v")).first()["v"]


def test_text_functions(spark):
    t = F.col("t")
    assert value(spark, T.clean_extracted(t), t="‎ا  َ ب ،") == "اَ ب،"
    assert value(spark, T.to_ascii_digits(t), t="١٢٣") == "123"
    assert value(spark, T.truncate(t, 5), t="abcdefg") == "abcd…"
    assert value(spark, T.truncate(t, 7), t=" abc \n def ") == "abc def"
    assert value(spark, T.replace_stars(t)[0], t="***") == ""
    assert value(spark, T.replace_stars(t)[0], t="a ** b *** c") == "a، b، c"
    assert value(spark, T.slug(t), t="a/b:c d.e") == "a__b-c-d-e"
    assert value(spark, T.is_noise(t), t="١٢ - 3.") is True
    assert value(spark, T.title_prefix(F.lit(""), t), t="one-two-three") == "OTT"
    assert value(spark, T.salvage_json(t).isNotNull(), t='so: {"a": 1} end') is True


def test_front_matter_and_segments(spark):
    lines = ["---", "title: x", "---", "# A", "lost", '::passage{id="P-1"}', "one", "two", "---", "# B", "lost too", '::passage{id="P-2"}', "three"]
    rows = spark.createDataFrame([("w", i, x) for i, x in enumerate(lines)], "work_id string, line_no long, line string")
    got = {r["segment_id"]: r["text"] for r in readers.manuscript_passages(rows).collect()}
    assert got == {"P-1": "one\ntwo\n---", "P-2": "three"}


def test_spans(spark):
    text = "ab 12 cd 345"
    found = value(spark, spans.spans_of(F.col("t"), "[0-9]+", "n"), t=text)
    assert [(s["start"], s["end"], s["text"]) for s in found] == [(3, 5, "12"), (9, 12, "345")]
    whole = value(spark, spans.interleaved(F.col("t"), spans.spans_of(F.col("t"), "[0-9]+", "n")), t=text)
    assert "".join(p["text"] for p in whole) == text and [p["kind"] for p in whole] == ["gap", "n", "gap", "n"]
    assert tuple(value(spark, spans.stripped(F.col("t"), F.lit(0), F.lit(4)), t=" ab ")) == (1, 3, "ab")
    assert tuple(value(spark, spans.sentence_window(F.col("t"), F.lit(6), F.lit(7)), t="One. Two x. Three")) == (4, 11)
    rows = spark.createDataFrame([(1, 1, 0, 5, "k", "a"), (1, 2, 3, 8, "k", "b"), (1, 2, 6, 9, "k", "c")], "id int, pass int, start int, end int, kind string, text string")
    assert sorted(r["text"] for r in spans.merged_passes(rows, "id").collect()) == ["a", "c"]


def test_matching(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w")], "id int, v string")
    assert {(r["side"], r["id"]) for r in matching.id_difference(a, b, "id").collect()} == {("left", 3), ("right", 4)}
    assert [tuple(r) for r in matching.field_drift(a, b, "id", ["v"]).collect()] == [(2, "v", None, "y")]
    assert {r["id"]: (r["v"], r["changed"]) for r in matching.overlay(a, b, "id", "v").collect()} == {1: ("x", False), 2: ("y", True), 3: ("z", False)}
    counts = {r["v"]: r["matched"] for r in matching.multiset_match(a, b, "v").collect()}
    assert counts["x"] == 1 and counts["w"] == 0


def test_gaps_and_breaks(spark):
    seq = spark.createDataFrame([(x,) for x in (2, 3, 7, 200_000)], "v long")
    assert sorted(map(tuple, sequence.sequence_gaps(seq, "v").collect())) == [(1, 1), (4, 6), (8, 199_999)]
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate((1, 2, 9, 10))], "k string, i int, v int")
    grouped = sequence.seen_before(rows, "k", "i", F.col("v") == 9).orderBy("i").collect()
    assert [r["seen"] for r in grouped] == [False, False, True, True]


def test_quality_and_gate(spark):
    rows = spark.createDataFrame([(1, None, "en", "s"), (2, "12", "en", "s"), (3, "a good long sentence", None, "s")], "doc_id int, text string, lang string, source string")
    codes = {(r["doc_id"], r["code"]) for r in quality.findings(rows, "doc_id", quality.passage_rules()).collect()}
    assert codes == {(1, "missing_text"), (2, "numeric_only"), (2, "short_passage"), (3, "missing_lang")}
    found = spark.createDataFrame([(1, "fail"), (2, "warn"), (3, "warn")], "id int, severity string")
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5)], "id int")
    gate = annotations.merge_gate(ids.where("id < 5"), ids, found, approved=[3])
    assert {r["id"]: r["reason"] for r in gate.collect()} == {1: "has_failures", 2: "needs_approval", 3: "accepted", 4: "accepted", 5: "no_draft"}


def test_titles_and_alignment(spark):
    scored = spark.createDataFrame([(1, 0, 5, 0.9), (1, 0, 6, 0.95), (1, 1, 6, 0.99), (1, 1, 5, 0.7)], "page int, toc_index int, block_no int, score double")
    assert sorted(map(tuple, fuzzy.assign_titles(scored).collect())) == [(1, 0, 6, 0.95), (1, 1, 5, 0.7)]
    rows = spark.createDataFrame([("the quick brown fox jumps", "quick brown"), ("the quick brown fox jumps", "quick red brown fox"), ("abc", "xyz uvw")], "text string, quote string")
    assert [r["status"] for r in fuzzy.align(rows).collect()] == ["exact", "fuzzy", "none"]


def test_edition_sync_replaces_a_key(spark):
    rows = spark.sql("SELECT 1 AS id, map('print', named_struct('type', 'page', 'label', 'old', 'page', 9L)) AS edition_refs")
    pages = spark.sql("SELECT 'print' AS edition, 1 AS id, 3L AS page, cast(null AS string) AS label")
    ref = editions.sync_refs(rows, pages, "print").first()["edition_refs"]
    assert list(ref) == ["print"] and ref["print"]["label"] == "3"


def test_tolerant_reader_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": 1, "t": "x"}\n\n{bad\n{"id": 2, "t": "y"}\n')
    schema = spark.createDataFrame([], "id int, t string").schema
    rows = readers.read_jsonl(spark, str(tmp_path / "in"), schema, strict=False).collect()
    assert sorted((r["id"] or 0, r["_corrupt_record"]) for r in rows) == [(0, "{bad"), (1, None), (2, None)]
    (tmp_path / "in" / "a.jsonl").write_text('{"id": 1, "t": "x"}\n{"id": 2, "t": "y"}\n')
    query = ingest.append_batches(ingest.stream_jsonl(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_grounded_finds_every_word_for_word_occurrence(spark):
    texts = ['He said: "The old man went to sea.', "x\tone two three four five six", "l1 l2\nl3 l4 l5 l6 l7", "so be it.", "none", None]
    quotes = ["The old man went to sea", "one two three four five six", "l1 l2\nl3 l4 l5 l6 l7", "be it", "so be it", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(quotes)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["start"], r["end"]) for r in spans.grounded(docs, items).collect()}
    assert got == {(d, q, t.find(x), t.find(x) + len(x)) for d, t in enumerate(texts) for q, x in enumerate(quotes) if t and x and x in t}
    assert len(got) == 5


def test_model_summary_lists_all_latencies_in_order(spark):
    rows = [(5000 - k, None if k % 7 == 0 else f"m{k % 3}", k % 4 > 0, None if k % 11 == 0 else k % 97) for k in range(5000)]
    frame = spark.createDataFrame(rows, "sample_id long, model string, ok boolean, latency_seconds long").repartition(7)
    got = {r["model"]: r for r in selection.model_summary(frame).collect()}
    for model in (None, "m0", "m1", "m2"):
        mine = sorted((r for r in rows if r[1] == model), key=lambda r: r[0])
        assert got.pop(model)["latencies"] == " / ".join(str(r[3]) for r in mine if r[3] is not None)
    assert not got
