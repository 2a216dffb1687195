"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of sampled texts. A text is
lower-cased, everything but letters becomes single spaces, and its UTF-8 bytes are compressed in
blocks with each language's dictionary; the language with the smallest total is chosen. Every byte
of a text counts. The margin is the share by which the runner-up's total is larger. Sizes are whole
bytes, so a margin is known to a byte for each block; a text is rejected if its margin is narrow even
with these bytes granted. That is one rule for all lengths: a long text must be told apart by
``MIN_MARGIN``, one of a few words is too short to be refused.

Results in special cases: null and empty texts and texts without a letter get ``und`` with score 0
and are rejected; ties go to the language learned from more documents, then to the smaller name;
rows with a null language are not learned from; copies of a text count once in learning; repeated
rows are each in the result; very long texts are compressed block by block; without anything to
learn from, every text gets ``und``; an empty table gives no rows; further columns are kept in
``doc``, whatever their names. Any number of languages is scored, ``GROUP`` of them at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import in_slices, share, text_of

UNDETERMINED = "und"
#: Learning takes one fragment of ``FRAGMENT`` characters of each of ``SAMPLE`` different texts of a language, those whose
#: hashes are smallest, from where the text's hash points to. All of them are the dictionary: with whole texts in it, a few
#: long ones would fill what the compressor can look back on, and its words would be those of a few documents.
SAMPLE, FRAGMENT = 192, 384
#: Bytes of the blocks that are compressed.
BLOCK = 1024
LEVEL = 7
#: Languages whose compressors a task holds at once.
GROUP = 128
#: A margin below this is narrow.
MIN_MARGIN = 0.01

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalise(text: str | None) -> bytes:
    """Lower-case letters and single spaces as UTF-8; empty if no character is a letter."""
    found = _NOT_LETTERS.sub(" ", (text or "").lower())
    return found.encode("utf-8", "surrogatepass") if any(map(str.isalpha, found)) else b""


@dataclass(frozen=True)
class Model:
    """Per language: its dictionary and the number of documents it stands for, in order of preference at ties."""

    dictionaries: dict[str, bytes]

    def compressors(self, first: int = 0, n: int | None = None) -> dict[str, zstandard.ZstdCompressor]:
        """The compressors of ``n`` languages from ``first`` on, all by default."""
        found = {}
        for lang, content in list(self.dictionaries.items())[first : None if n is None else first + n]:
            learned = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            learned.precompute_compress(level=LEVEL)
            found[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned, write_checksum=False, write_content_size=False)
        return found


def sizes(text: bytes, compressors: dict[str, zstandard.ZstdCompressor]) -> np.ndarray:
    """Bytes that the whole text takes with each language's dictionary."""
    blocks = [text[at : at + BLOCK] for at in range(0, len(text), BLOCK)]
    return np.array([sum([len(c.compress(b)) for b in blocks]) for c in compressors.values()], float)


def fit(documents: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Learn from the rows where ``learn`` holds and the language is known."""
    text = F.col(text_col).cast("string")
    known = documents.filter(learn & F.col(lang_col).isNotNull() & text.rlike(r"\p{L}")).select(F.col(lang_col).cast("string").alias("lang"), text.alias("text"), F.xxhash64(text).alias("h"))
    texts = known.select("lang", "h").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    counts = {r.lang: r["count"] for r in texts.groupBy("lang").count().collect()}  # a row a language
    # hashes are uniform: the SAMPLE smallest lie among the first three times as many, so no task ranks a whole language
    limits = [(x, -(2**63) + min(2**64, 2**64 * 3 * SAMPLE // n) - 1) for x, n in counts.items()]
    limit = documents.sparkSession.createDataFrame(limits, "lang string, limit bigint")
    chosen = texts.join(F.broadcast(limit), "lang").filter(F.col("h") <= F.col("limit"))
    chosen = chosen.withColumn("n", rank).filter(F.col("n") <= SAMPLE).select("lang", "h")  # SAMPLE rows of each language at most
    start = 1 + F.pmod("h", F.greatest(F.length("text") - FRAGMENT, F.lit(1)))
    fragments = known.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", F.substr("text", start.cast("int"), F.lit(FRAGMENT)).alias("part"))
    parts: dict[str, list[bytes]] = {}
    for row in fragments.groupBy("lang", "h").agg(F.min("part").alias("part")).orderBy("lang", "h").collect():
        parts.setdefault(row.lang, []).append(normalise(row.part))
    order = sorted(parts, key=lambda x: (-counts[x], x))
    return Model({lang: b" ".join(parts[lang]) for lang in order})


def judge(size: np.ndarray, names: list[str], letters: int, min_margin: float = MIN_MARGIN) -> tuple[str, float, float, bool]:
    """The language chosen, its share of the likelihood, its margin, and whether it is accepted."""
    best = int(size.argmin())
    second = np.delete(size, best).min() if len(size) > 1 else np.inf
    margin = float(1 - size[best] / second)
    return names[best], float(1 / np.exp2(size[best] - size).sum()), margin, bool(margin + -(-letters // BLOCK) / second >= min_margin)


def predict(documents: DataFrame, model: Model, text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """Per row: the input row as ``doc``, lang_pred, score (the choice's share of likelihood), margin and accepted."""
    shared = share(documents.sparkSession, model)
    rows, texts = text_of(documents, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = shared()
        names = list(learned.dictionaries)
        groups = range(0, len(names), GROUP)
        held = learned.compressors() if len(groups) == 1 else None
        for batch in in_slices(batches):
            letters = [normalise(t.as_py()) for t in texts(batch)]
            size = np.zeros((len(letters), len(names)))
            for at in groups:
                compressors = held or learned.compressors(at, GROUP)
                for row, text in zip(size, letters):
                    row[at : at + len(compressors)] = sizes(text, compressors)
            out = [(UNDETERMINED, 0.0, 0.0, False) if not text or not names else judge(row, names, len(text), min_margin) for text, row in zip(letters, size)]
            columns = list(zip(*out)) or [()] * 4
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc", "lang_pred", "score", "margin", "accepted"])

    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, lang_pred string, score double, margin double, accepted boolean"
    return rows.mapInArrow(run, schema)


def in_part(doc_id: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text (a null id: empty text) leaves the remainder ``part``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts == part


def identify(documents: DataFrame, doc_id: str = "doc_id", parts: int = 5, held_out: int = 0, **columns: str) -> DataFrame:
    """Learn from the rows not held out, then predict every row; adds ``held_out`` to what ``predict`` gives."""
    held = in_part(doc_id, parts, held_out)
    model = fit(documents, ~held, **columns)
    text_col = columns.get("text_col", "text")
    return predict(documents, model, text_col).withColumn("held_out", in_part(f"doc.{doc_id}", parts, held_out))


def keep_identified(documents: DataFrame, **options) -> DataFrame:
    """The rows whose language is not rejected, with the input's columns."""
    found = identify(documents, **options).filter("accepted")
    return found.select([F.col("doc").getField(c).alias(c) for c in documents.columns])
