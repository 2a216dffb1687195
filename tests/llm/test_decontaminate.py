"""Decontamination against a brute-force window search."""

import re

from tessera.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, bench):
    w, hit, items = words(text), set(), set()
    for item, t in bench:
        b = words(t)
        n = min(13, len(b))
        for i in range(len(b) - n + 1 if b else 0):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == b[i : i + n]:
                    hit.update(range(j, j + n))
                    items.add(None if item is None else str(item))
    return len(w), sorted(hit), sorted(items, key=lambda x: (x is None, x or ""))


LONG = " ".join(f"tok{i}" for i in range(30))
BENCH = [(1, LONG), (2, "Short ITEM"), (3, None), (4, "..."), (10, LONG[:60] + " tail"), (5, "Größe ist ñ 42"), (6, "a a a a a a a a a a a a a a a"), (2, "Short ITEM"), (None, "no id here")]
DOCS = [
    (1, "x " * 40 + LONG.upper() + " y" * 9),
    (2, "short--item and\nshort item, SHORT!item"),
    (3, None),
    (4, ""),
    (5, "größe IST Ñ 42; größe ist ñ 42"),
    (6, " ".join(f"tok{i}" for i in range(3, 15))),
    (7, " ".join(f"tok{i}" for i in range(3, 16)) + " z" * 500),
    (8, "a " * 14),
    (8, "a " * 14),
    (9, "w short item x short\x00item 'short' item " + "pad " * 100_000),
    (None, "xshort item short itemx"),
]


def test_equals_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in DOCS], "doc_id bigint, text string, items string, n_words int")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    want = sorted(((i, *brute(t, BENCH)) for i, t in DOCS), key=str)
    for limit in (d.MAX_PATTERN_BYTES, 40):  # one automaton, and several passes
        got = d.contamination(docs, bench, max_pattern_bytes=limit).collect()
        assert sorted(((r.doc_id, r.n_words, [k for s in r.spans for k in range(s.first, s["last"] + 1)], r["items"]) for r in got), key=str) == want
        assert all(r.n_hit == sum(s["last"] - s.first + 1 for s in r.spans) for r in got)


def test_spans_map_to_the_original(spark):
    docs = spark.createDataFrame([(1, "é—Über: SHORT,\n  item? end")], "doc_id bigint, text string")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    row = d.contamination(docs, bench).first()
    assert [row and "é—Über: SHORT,\n  item? end"[s.start : s.end] for s in row.spans] == ["SHORT,\n  item"]


def test_filter_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in DOCS], "doc_id bigint, text string, spans string")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    kept = d.decontaminate(docs, bench)
    assert sorted(map(str, d.decontaminate(docs, bench, max_pattern_bytes=40).collect())) == sorted(map(str, kept.collect()))
    assert kept.columns == docs.columns
    clean = [i for i, t in DOCS if not (len(h := brute(t, BENCH)[1]) > 0 and 20 * len(h) >= len(words(t)))]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(clean, key=str)


def test_items_without_an_id_hit(spark):
    docs = spark.createDataFrame([(1, "x no id here short item"), (2, "clean")], "doc_id bigint, text string")
    got = d.contamination(docs, spark.createDataFrame([*BENCH, (None, "Short item")], "item_id bigint, text string")).orderBy("doc_id").collect()
    assert [(r.n_hit, r["items"]) for r in got] == [(5, ["2", None]), (0, [])]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r.n_hit == 0 and r["items"] == [] for r in d.contamination(docs, none).collect())
    assert d.contamination(docs.limit(0), none).count() == 0
