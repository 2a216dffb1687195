"""Benchmark decontamination with an Aho-Corasick automaton.

Texts are lower-cased (A-Z only) and cut into words of digits, a-z and characters beyond ASCII.
A window is ``window`` consecutive words of a benchmark item; an item with fewer words, but at
least one, is a window by itself. All distinct windows go into one automaton over UTF-8 bytes, and
each document is scanned once. A word inside any occurrence of a window is hit.

Results in special cases: null and empty texts have no words, no hits and no items; repeated rows
are judged one by one; windows shared by several items count for each of them; items without an id
hit like any other, and are one null among a document's items, counted in ``n_items`` but with no id
to join; null document ids are allowed; very long texts are scanned whole; an empty benchmark
hits nothing, and an empty table gives no rows; further columns of the input are ignored, whatever
their names.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import in_slices, join_hot, materialize, share, small_batches

WINDOW = 13
#: Bytes of window text in one automaton, which takes some sixty times as much memory in a worker. A benchmark beyond
#: that is matched in several passes over the texts.
MAX_PATTERN_BYTES = 4 << 20

_WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_IN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = re.compile(_IN_WORD)
_SPANS = "array<struct<first:int,last:int,start:int,end:int>>"
_SPAN = pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")])


def words_of(text: str | None) -> list[bytes]:
    """The normalised words, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def windows_of(text: str | None, window: int = WINDOW) -> list[str]:
    """An item's distinct windows as the automaton's patterns: words between single spaces, one character a byte."""
    words = words_of(text)
    return list({f" {b' '.join(words[i : i + window]).decode('latin-1')} ": 0 for i in range(max(1, len(words) - window + 1))}) if words else []


def window_table(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(pattern, items): each distinct window with the ids of its items, as strings."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, i) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for p in windows_of(t, window)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], ["pattern", "item"])

    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return rows.mapInArrow(explode, "pattern string, item string").groupBy("pattern").agg(F.collect_set(F.struct("item")).alias("items")).select("pattern", F.col("items.item").alias("items"))


def _automata(windows: DataFrame, limit: int) -> Iterator[ahocorasick.Automaton]:
    """Automata of at most ``limit`` bytes of patterns and item ids.

    Windows within the limit are collected at once, more of them part by part.
    """
    windows = materialize(windows, "windows")
    item_bytes = F.aggregate("items", F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(F.length(x), F.lit(0)))
    total = windows.agg(F.sum(F.length("pattern") + item_bytes)).first()[0] or 0
    found, size = ahocorasick.Automaton(), 0
    for row in windows.collect() if total <= limit else windows.toLocalIterator():
        found.add_word(row.pattern, (len(row.pattern), tuple(row["items"])))
        size += len(row.pattern) + sum(len(x or "") for x in row["items"])
        if size >= limit:
            found.make_automaton()
            yield found
            found, size = ahocorasick.Automaton(), 0
    if len(found):
        found.make_automaton()
        yield found


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint, sorted and not adjacent ranges over the same words."""
    merged: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _scan(words: list[bytes], automaton: ahocorasick.Automaton) -> tuple[list[tuple[int, int]], set[str]]:
    """The word ranges [first, last] that windows cover, and the items these come from."""
    line = f" {b' '.join(words).decode('latin-1')} "
    ends, sizes, items = [], [], set()
    for end, (size, owners) in automaton.iter(line):
        ends.append(end)
        sizes.append(size)
        items.update(owners)
    if not ends:
        return [], items
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    first = np.searchsorted(spaces, np.array(ends) - np.array(sizes) + 1)
    last = np.searchsorted(spaces, np.array(ends)) - 1
    return _merge(list(zip(first.tolist(), last.tolist()))), items


def _offsets(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges with the code points [start, end) they take in the original text."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    return [{"first": a, "last": b, "start": at[a][0], "end": at[b][1]} for a, b in ranges]


def _in_order(items: Iterable[str | None]) -> list[str | None]:
    return sorted({*items}, key=lambda x: (x is None, x or ""))


def _scanned(rows: DataFrame, automaton: ahocorasick.Automaton) -> DataFrame:
    """The rows, their text replaced by n_words, spans and items."""
    small_batches(rows.sparkSession)
    shared = share(rows.sparkSession, automaton)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared()
        for batch in in_slices(batches):
            n_words, spans, items = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                ranges, owners = _scan(words, found) if words and len(found) else ([], set())
                n_words.append(len(words))
                spans.append(_offsets(text, ranges))
                items.append(_in_order(owners))
            new = [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *new], [*(f.name for f in kept), "n_words", "spans", "items"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(scan, f"{schema}, n_words bigint, spans {_SPANS}, items array<string>")


def _merged(found: DataFrame) -> DataFrame:
    """(key, n, spans, items) of texts that several automata hit, from the spans and items of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            spans, items = [], []
            for parts, owners in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                every = [x for part in parts for x in part]
                start, end = {x["first"]: x["start"] for x in every}, {x["last"]: x["end"] for x in every}
                spans.append([{"first": a, "last": b, "start": start[a], "end": end[b]} for a, b in _merge([(x["first"], x["last"]) for x in every])])
                items.append(_in_order(i for part in owners for i in part))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))], ["key", "n", "spans", "items"])

    grouped = found.groupBy("key").agg(F.max("n").alias("n"), F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    return grouped.mapInArrow(run, f"key string, n bigint, spans {_SPANS}, items array<string>")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", max_pattern_bytes: int = MAX_PATTERN_BYTES, keep_rows: bool = False) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, ``spans`` (hit word ranges and their code points in the original) and ``items``.

    The benchmark's windows are broadcast as one automaton of at most ``max_pattern_bytes``. A
    larger benchmark makes several, each of which scans the texts in a pass of its own; what a pass
    writes to the shared folder is the spans and items of texts that are hit, by the digest of the
    text, and no texts. ``keep_rows`` adds the input row as ``doc``.
    """
    text = F.col(text_col).cast("string")
    kept = [F.col(doc_id).alias("doc_id"), *([F.struct("*").alias("doc")] if keep_rows else [])]
    automata = _automata(window_table(benchmark, window, item_id, item_text), max_pattern_bytes)
    first, second = next(automata, None), next(automata, None)
    if second is None:
        rows = _scanned(documents.select(*kept, text.alias("text")), first or ahocorasick.Automaton())
    else:
        key = F.sha1(F.coalesce(text, F.lit("")))
        found = None
        for automaton in itertools.chain([first, second], automata):
            hits = _scanned(documents.select(key.alias("key"), text.alias("text")), automaton).filter("size(spans) > 0")
            once = hits.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("spans").alias("spans"), F.first("items").alias("items"))
            part = materialize(once, "hits")
            found = part if found is None else found.unionByName(part)
        rows = documents.select(*kept, key.alias("key"), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_IN_WORD)).cast("bigint").alias("n_words"))
        rows = join_hot(rows, materialize(_merged(found), "hits"), "key", F.col("n"), documents.count(), "left")
        rows = rows.withColumns({"spans": F.coalesce("spans", F.array().cast(_SPANS)), "items": F.coalesce("items", F.array().cast("array<string>"))})
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["last"] - x["first"] + 1)
    return rows.withColumn("n_hit", n_hit).select("doc_id", "n_words", "n_hit", "spans", "items", *(["doc"] if keep_rows else []))


def is_contaminated() -> Column:
    """The rule: some word is hit, and the hit words are at least a twentieth of all."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The input rows that are not contaminated, with the input's columns."""
    kept = contamination(documents, benchmark, keep_rows=True, **options).filter(~is_contaminated())
    return kept.select([F.col("doc").getField(c).alias(c) for c in documents.columns])
