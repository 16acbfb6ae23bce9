"""Personal data: spans found by form, and terms that reveal them, by information-theoretic sanitisation.

Spans by form are emails, IPv4 addresses, card numbers (13 to 19 digits that pass Luhn) and phone numbers (9 to 15
digits). Protected entities are each found value, each kind as a whole, and personal data of any kind. The corpus then says
how strongly a term t (a word outside the spans, of more than two letters or digits) reveals an entity e:

    PMI(t; e) = log2(N * df(t, e) / (df(t) * df(e))),  IC(e) = log2(N / df(e))

N counts rows, and each df rows that hold the term, the entity or both; all of a row's text counts, however far apart
they stand. A term whose PMI is at least ``disclosure`` * IC(e), and which stands between different words in ``support``
or more of the entity's rows, gives e away: copies of a row repeat its words and add nothing to the support, and a word
that meets an entity by chance has too little of it. All its occurrences in the rows that hold e are spans of kind
``term``. In ``sanitise``, terms with digits are generalised to ``[number]``, others are removed, and entities are
replaced by ``[kind]``.

Defined results: null text is empty and has no spans; a null id is an id of its own; overlapping spans of different kinds
are all reported, and replaced as one by the first (of equal starts, the one that ends first); rows equal in id and text
share their spans, and count each; texts of any length are searched whole; terms are equal if 64 bits of their hashes
are; empty tables give empty results; other columns are ignored, and kept by ``sanitise`` whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm import tokens
from quirework.llm.shared import fixed_bitmap, in_bitmap, release, slices, stage

KINDS = ("email", "ip", "card", "phone")
# Patterns of the base spans: fixed values. An email is found by its domain and extended left over its local part, and
# an address begins where a run of digits begins; both keep long runs without a match linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_HELD = np.zeros(256, bool)
_HELD[48:58] = _HELD[65:91] = _HELD[97:123] = _HELD[128:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_DROP = bytes(np.flatnonzero(~_HELD).astype(np.uint8))
_FOLD_TABLE = bytes(_FOLD)

_FOUND = (
    "doc_id long, doc_hash long, n_email long, n_ip long, n_card long, n_phone long, base array<string>, base_sha256 string, "
    "entities array<string>, terms array<struct<term:long,context:long,number:boolean,at:array<struct<start:long,end:long>>>>"
)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def form_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    out = []
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            begin = m.start()
            while begin > last and text[begin - 1] in _LOCAL_CHARS:
                begin -= 1
            if begin < m.start():
                out.append(("email", begin, m.end()))
                last = m.end()
    for m in _IP.finditer(text):
        if all(len(x) < 4 and int(x or 0) <= 255 for x in (y.lstrip("0") for y in m.group().split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def _normal(word: str) -> bytes:
    return word.encode().translate(_FOLD_TABLE, _DROP)


def _value(kind: str, text: str) -> str:
    return text.lower() if kind == "email" else text if kind == "ip" else _digits(text)


def _terms(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
    """Each distinct term outside the spans: hash, hash of the words on both sides of its first place, and all its places."""
    taken = sorted((a, b) for _, a, b in spans)
    words, k = [], 0
    for m in _WORD.finditer(text):
        a, b = m.span()
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        words.append((_normal(m.group()), a, b, any(x < b for x, _ in taken[k : k + 1])))
    held: dict[bytes, tuple[str, list]] = {}
    for i, (word, a, b, inside) in enumerate(words):
        if len(word) <= 2 or inside:
            continue
        if word not in held:
            before, after = words[i - 1][0] if i else b"", words[i + 1][0] if i + 1 < len(words) else b""
            held[word] = ((before + b"_" + after).decode(errors="replace"), [])
        held[word][1].append({"start": a, "end": b})
    names = [w.decode(errors="replace") for w in held]
    hashes = tokens.hash_words(names, fold=False).view(np.int64).tolist()
    contexts = tokens.hash_words([c for c, _ in held.values()], fold=False).view(np.int64).tolist()
    return [
        {"term": h, "context": c, "number": any(48 <= x < 58 for x in w), "at": at} for h, c, (w, (_, at)) in zip(hashes, contexts, held.items())
    ]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    held = pa.list_(pa.struct([("term", pa.int64()), ("context", pa.int64()), ("number", pa.bool_()), ("at", place)]))
    for batch in slices(batches):
        rows = []
        for text in batch.column("text").to_pylist():
            spans = form_spans(text)
            base = [f"{kind}:{a}:{b}" for kind, a, b in spans]
            entities = sorted({kind for kind, _, _ in spans} | {f"{kind}:{_value(kind, text[a:b])}" for kind, a, b in spans} | ({"any"} if spans else set()))
            counts = [sum(s[0] == kind for s in spans) for kind in KINDS]
            rows.append((counts, base, hashlib.sha256(",".join(base).encode()).hexdigest(), entities, _terms(text, spans) if spans else []))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("doc_hash"),
                *(pa.array([r[0][k] for r in rows], pa.int64()) for k in range(4)),
                pa.array([r[1] for r in rows], pa.list_(pa.string())),
                pa.array([r[2] for r in rows], pa.string()),
                pa.array([r[3] for r in rows], pa.list_(pa.string())),
                pa.array([r[4] for r in rows], held),
            ],
            ["doc_id", "doc_hash", "n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "entities", "terms"],
        )


def _document_counts(bitmap):
    """(term, n): in how many documents of each slice a wanted term stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bitmap.value
        for batch in slices(batches):
            text = tokens.Text.of(batch.column("text"))
            row, start, end, _ = tokens.spans(text)
            keep = _HELD[text.data]
            upto = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])
            h = tokens.hashed(_FOLD[text.data][keep], upto[start], upto[end])
            found = np.flatnonzero(in_bitmap(wanted, h))
            pairs = np.unique(np.stack([h[found], row[found].astype(np.uint64)]), axis=1) if len(found) else np.zeros((2, 0), np.uint64)
            term, n = np.unique(pairs[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], ["term", "n"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("doc_hash"), text.alias("text"))


def telling_terms(found: DataFrame, texts: DataFrame, support: int, disclosure: float) -> DataFrame:
    """(entity, term) of the terms that give entities away; ``found`` as ``_find`` gives it, ``texts``: text of all rows."""
    spark = found.sparkSession
    total = float(max(texts.count(), 1))
    held = found.where(F.size("entities") > 0).select(F.explode("entities").alias("entity"), "terms")
    entities = stage(held.groupBy("entity").agg(F.count("*").alias("df_e")).where(F.col("df_e") >= support), "pii-entities")
    met = held.join(entities, "entity").select("entity", "df_e", F.explode("terms").alias("t"))
    met = met.groupBy("entity", "df_e", F.col("t.term").alias("term"), F.col("t.context").alias("context")).agg(F.count("*").alias("n"))
    met = met.groupBy("entity", "df_e", "term").agg(F.sum("n").alias("df_te"), F.count("*").alias("contexts"))
    candidates = stage(met.where(F.col("contexts") >= support), "pii-candidates")
    bitmap = spark.sparkContext.broadcast(fixed_bitmap(candidates.select("term"), "term"))
    seen = texts.mapInArrow(_document_counts(bitmap), "term long, n long").groupBy("term").agg(F.sum("n").alias("df_t"))
    pmi = F.log2(total * F.col("df_te") / (F.col("df_t") * F.col("df_e")))
    content = F.log2(total / F.col("df_e"))
    telling = stage(candidates.join(seen, "term").where((content > 0) & (pmi >= disclosure * content)).select("entity", "term"), "pii-telling")
    release(entities, candidates)
    return telling


def personal_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    support: int = 5,
    disclosure: float = 0.75,
) -> DataFrame:
    """doc_id, doc_hash, n_email, n_ip, n_card, n_phone, base_sha256, base (spans by form) and terms (spans that reveal
    them: start, end, number) for each document."""
    rows = _keyed(docs, id_col, text_col)
    found = stage(rows.mapInArrow(_find, _FOUND), "pii")
    telling = telling_terms(found, rows.select("text"), support, disclosure)
    places = found.where(F.size("entities") > 0).select("doc_id", "doc_hash", F.explode("entities").alias("entity"), "terms")
    places = places.join(telling.select("entity").distinct(), "entity", "left_semi").select("doc_id", "doc_hash", "entity", F.explode("terms").alias("t"))
    marked = (
        places.select("doc_id", "doc_hash", "entity", "t.*")
        .join(telling, ["entity", "term"])
        .select("doc_id", "doc_hash", "number", F.explode("at").alias("p"))
        .groupBy("doc_id", "doc_hash")
        .agg(F.array_sort(F.collect_set(F.struct("p.start", "p.end", "number"))).alias("terms"))
    )
    same = F.col("f.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("f.doc_hash") == F.col("m.doc_hash"))
    none = F.array().cast("array<struct<start:long,end:long,number:boolean>>")
    marked = stage(marked, "pii-terms")
    return found.drop("entities", "terms").alias("f").join(marked.alias("m"), same, "left").select("f.*", F.coalesce("m.terms", none).alias("terms"))


def span_strings(base: Column, terms: Column) -> Column:
    """All spans as ``kind:start:end``, comma-joined."""
    extra = F.transform(terms, lambda t: F.concat(F.lit("term:"), t["start"].cast("string"), F.lit(":"), t["end"].cast("string")))
    return F.array_join(F.concat(base, extra), ",")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with entities replaced by ``[kind]``, telling terms generalised or removed; all columns stay."""
    spans = personal_spans(docs, id_col, text_col, **options).where((F.size("base") > 0) | (F.size("terms") > 0))
    form = F.transform(
        "base",
        lambda s: F.struct(
            F.split(s, ":")[1].cast("int").alias("start"), F.split(s, ":")[2].cast("int").alias("end"), F.concat(F.lit("["), F.split(s, ":")[0], F.lit("]")).alias("by")
        ),
    )
    term = F.transform(
        "terms", lambda t: F.struct(t["start"].cast("int").alias("start"), t["end"].cast("int").alias("end"), F.when(t["number"], "[number]").otherwise("").alias("by"))
    )
    parts = spans.select(
        F.col("doc_id").alias("_quirework_id"), F.col("doc_hash").alias("_quirework_hash"), F.array_sort(F.concat(form, term)).alias("_quirework_parts")
    ).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_quirework_id")) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("_quirework_hash"))
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    folded = F.aggregate(
        "_quirework_parts",
        empty,
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(F.col(text_col), acc["at"] + 1, s["start"] - acc["at"]), s["by"]).alias("out"))
        ),
        lambda acc: F.concat(acc["out"], F.substring(F.col(text_col), acc["at"] + 1, F.length(text_col))),
    )
    text = F.when(F.col("_quirework_hash").isNull(), F.col(text_col)).otherwise(folded)
    return docs.join(parts, same, "left").withColumn(text_col, text).select(*docs.columns)
