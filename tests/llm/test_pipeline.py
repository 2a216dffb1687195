"""The pipeline's rows against plain Python applied stage by stage."""

import corpus_pipeline
from tessera.llm import langid, quality, sentencepiece_nbest
from tessera.llm.queries import PIECES, read
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_decontaminate import words
from tests.llm.test_langid import plain_fit, plain_row
from tests.llm.test_near_copies import brute_kept
from tests.llm.test_quality import plain_score

SF = "/root/testdata/sf0.001"


def test_rows_equal_plain_python(spark):
    docs = read(spark, SF, "documents")
    got = {r.doc_id: (r.ids, r.score) for r in corpus_pipeline.run(spark, SF).collect()}
    rows = [r.asDict() for r in docs.collect()]

    model = quality.fit(docs, read(spark, SF, "labels"), ~langid.in_part("doc_id", 4, 2))
    rows = [r for r in rows if plain_score(r["text"], model) >= quality.THRESHOLD]
    dictionaries = plain_fit([(r["doc_id"], r["text"], r["lang"]) for r in rows])
    rows = [r for r in rows if plain_row(r["text"], dictionaries)[3]]
    rows.sort(key=lambda r: r["doc_id"])
    kept = brute_kept([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if r["doc_id"] in kept]
    bench = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    rows = [r for r in rows if not (len(h := hits(r["text"], bench)[1]) > 0 and 20 * len(h) >= len(words(r["text"])))]
    encoder = sentencepiece_nbest.Encoder(sentencepiece_nbest.Vocabulary.load(PIECES))
    want = {r["doc_id"]: (memoryview(e[0]).cast("i").tolist(), e[1]) for r in rows for e in [encoder.encode(r["text"])]}
    assert 0 < len(want) < docs.count() and got == want


def test_stages_keep_the_columns(spark):
    docs = read(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.simpleString() == docs.schema.simpleString()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "decontamination", "encoding"]


def odd_documents(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, a clashing extra column."""
    docs = read(spark, SF, "documents")
    long = "Words that are plain enough for any reader to follow along. " * 20_000
    rows = [(None, "no id but a plain text of some words", None, None, None, None), (900_001, None, "en", "s", 0, "x"), (900_002, "", None, "s", None, "x"), (900_003, long, "en", None, len(long), None), (900_004, " \n\t ", "en", "s", 3, "x")]
    rows += [rows[0], rows[3], (900_003, "another text under an id that is taken already", "en", "s", 40, "y")]
    schema = docs.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ") + ", doc string"
    return docs.selectExpr("*", "'d' AS doc").limit(60).unionByName(spark.createDataFrame(rows, schema))


def test_stages_on_odd_documents(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        got = out.collect()
        assert len(got) <= docs.count()
        if name != "encoding":
            assert out.columns == docs.columns
        if name in ("near_duplicates", "decontamination"):
            assert {900_001, 900_003} & {r.doc_id for r in got}
    assert len(corpus_pipeline.STAGES[2][1](spark, docs.filter("doc_id = 900003"), SF).collect()) == 2


def test_stages_on_an_empty_table(spark):
    docs = read(spark, SF, "documents").limit(0)
    assert all(stage(spark, docs, SF).count() == 0 for _, stage in corpus_pipeline.STAGES)
