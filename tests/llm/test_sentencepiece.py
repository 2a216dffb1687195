"""N-best segmentation against enumeration of all paths, and exact round trips."""

import itertools
import random

import pytest

from tessera.llm import sentencepiece_nbest as sp

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def small_vocabulary():
    pieces = ["<unk>", *(f"<0x{b:02X}>" for b in range(256)), "▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "▁▁", "é"]
    rng = random.Random(0)
    scores = [0.0] * 257 + [-float(rng.randint(1, 12)) for _ in pieces[257:]]
    return sp.Vocabulary(pieces, scores, {b: b + 1 for b in range(256)}, {0})


def all_paths(v, s):
    """Scores of every segmentation of the marked text, by enumeration."""
    into = v.edges(s)
    into = [[(i, x, tuple(ids)) for i, x, ids in ending] for ending in into]
    paths = {0: [(0.0, ())]}
    for j in range(1, len(s) + 1):
        paths[j] = [(a + score, ids + more) for i, score, more in into[j] for a, ids in paths[i]]
    return sorted(paths[len(s)], key=lambda p: -p[0])


@pytest.mark.parametrize("n", [1, 2, 4, 9])
def test_equals_enumeration(n):
    v = small_vocabulary()
    encoder = sp.Encoder(v, n)
    for text in ("abc", "ab cab", "a  b", "é▁x\nabc ab", " abc abc", "zzz", "ca\n\nbc"):
        want = all_paths(v, sp.MARK + text.replace(sp.MARK, sp._LITERAL_MARK).replace(" ", sp.MARK))
        raw, score, others = encoder.encode(text)
        ids = memoryview(raw).cast("i").tolist()
        got = [(score, ids), *((s, sp.apply_edits(ids, e)) for s, e in others)]
        assert [s for s, _ in got] == [s for s, _ in want[:n]]
        assert len({tuple(i) for _, i in got}) == len(got)
        assert all((s, tuple(i)) in want for s, i in got)
        assert all(encoder.decode(i) == text for _, i in got)


def test_round_trip_with_the_public_vocabulary():
    encoder = sp.Encoder(sp.Vocabulary.load(MODEL))
    rng = random.Random(2)
    texts = ["", " ", "  lead and trail  ", "▁ literal ▁▁ mark", "<s> <0x41> </s>", "tab\tnew\r\nline\x00\x7f", "日本語 😀 \U0010ffff", "x" * 3000, " " * 500, "a b" * 20_000]
    texts += ["".join(chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0xD7FF), 32, 0x2581])) for _ in range(80)) for _ in range(60)]
    for t in texts:
        raw, _, others = encoder.encode(t)
        ids = memoryview(raw).cast("i").tolist()
        assert encoder.decode(ids) == t
        scores = [s for s, _ in others]
        assert scores == sorted(scores, reverse=True)
        assert all(encoder.decode(sp.apply_edits(ids, e)) == t for _, e in others)


def test_no_piece_crosses_a_cut():
    v = sp.Vocabulary.load(MODEL)
    rng = random.Random(8)
    pieces = list(v.of)
    for _ in range(3000):
        text = sp.MARK + "".join(rng.choice(pieces) if rng.random() < 0.5 else rng.choice(["a", ".", ",", "é", "²", "”", "\n", sp.MARK, "7", "ß", "क", "ा", "\t", "Z!"]) for _ in range(rng.randint(1, 8)))
        cuts = v.stretches.findall(text)
        assert "".join(cuts) == text and all(cuts)
        at = 0
        for s in cuts[:-1]:
            at += len(s)
            for i in range(max(0, at - v.longest), at):
                assert not any(text[i:j] in v.of for j in range(at + 1, min(len(text), i + v.longest) + 1)), (text, at)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED", 5)
    v = small_vocabulary()
    a, b = sp.Encoder(v), sp.Encoder(small_vocabulary())
    text = " ".join("".join(p) for p in itertools.product("abc", repeat=4))
    assert a.encode(text) == b.encode(text) and len(a.memory) <= 5 and len(a.memory.before) <= 5


def test_tables(spark):
    rows = [(1, "hello world", "x"), (1, "hello world", "x"), (2, None, "y"), (3, "", None), (None, "wörd " * 20_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = sp.encode(docs, MODEL)
    got = found.collect()
    assert len(got) == len(rows) and all(r.round_trip in (True, None) for r in got)
    assert [r.ids for r in got if r.doc_id == 2] == [None] and [r.ids for r in got if r.doc_id == 3] == [[]]
    back = sp.decode(found, MODEL)
    assert sorted((r.row.doc_id or 0, r.text or "") for r in back.collect()) == sorted((r[0] or 0, r[1] or "") for r in rows)
    assert sp.encode(docs.limit(0), MODEL).count() == 0
