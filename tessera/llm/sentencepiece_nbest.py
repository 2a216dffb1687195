"""N-best encoding and decoding with a SentencePiece vocabulary.

A text is read as the vocabulary reads it: a space is the mark U+2581 and a mark is put in front. A
segmentation is a path over the lattice of pieces, its score the sum of its pieces' scores. The
forward Viterbi pass gives every position the best score from the start; a backward A* search from
the end takes these as its exact heuristic, so complete paths leave the agenda best first, with no
cap on it. The forward pass keeps the second-best score too, which tells where a search is needed. A character that no piece covers becomes its UTF-8 byte pieces at a fixed cost.

No piece spans a place where a non-mark is followed by a mark, nor a character that is in no piece,
nor (if the vocabulary has no such piece) a place where a letter is followed by an ASCII sign or
digit, so every path passes these cuts. The lattice is therefore searched between cuts, once for each
different stretch, and the N best of a whole text are put together exactly from those of its
stretches.

Results in special cases: a null text has null ids and no segmentations; an empty text has one,
without pieces, of score 0; U+2581 in a text becomes byte pieces, so decoding gives back every text
exactly; equal scores order by where paths differ, so results do not depend on partitioning;
repeated rows are each in the result; a very long text is one row, searched stretch by stretch (a
long stretch without a cut takes memory in proportion to it); an empty table gives no rows; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import itertools
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import in_slices, share, small_batches

MARK = "▁"
INFINITE = float("inf")
#: Stands for a literal U+2581 of the text inside the lattice; no UTF-8 text holds a lone surrogate.
_LITERAL_MARK = "\udc00"
N_BEST = 4
#: Characters taken as letters where stretches are cut, as a class of a pattern.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Cost of a character without a piece, below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Scores at or below this mark pieces of last resort, which do not set the cost of unknown characters.
LAST_RESORT = -1e8
#: Stretches remembered at most, twice, and the longest remembered.
REMEMBERED, LONGEST = 150_000, 48

EDITS = "array<struct<score:double,edits:array<struct<at:int,n:int,ids:array<int>>>>>"


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], control: set[int]):
        self.pieces, self.byte_ids = pieces, byte_ids
        usable = [i for i in range(len(pieces)) if i not in control and i not in byte_ids.values() and pieces[i]]
        self.of = {pieces[i]: (i, scores[i]) for i in usable}
        self.longest = max(map(len, self.of), default=1)
        self.trie: dict = {}  # character -> (what may follow, piece or -1, score)
        for p in sorted(self.of, key=len, reverse=True):
            node = self.trie
            for k, c in enumerate(p):
                follow, piece, score = node.get(c, ({}, -1, 0.0))
                node[c] = (follow, *self.of[p]) if k == len(p) - 1 else (follow, piece, score)
                node = follow
        self.unknown = min((s for _, s in self.of.values() if s > LAST_RESORT), default=0.0) - UNKNOWN_PENALTY
        if any(MARK in p.lstrip(MARK) for p in self.of):
            raise ValueError("a piece holds the mark after other characters")
        self.stretches = re.compile(self._stretches())
        self.decoded = [b"" if i in control else p.replace(MARK, " ").encode("utf-8", "surrogatepass") for i, p in enumerate(pieces)]
        for byte, i in byte_ids.items():
            self.decoded[i] = bytes([byte])

    def _stretches(self) -> str:
        """The pattern whose matches are the stretches of a marked text."""
        alphabet = set("".join(self.of))
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in alphabet and chr(c) != " ")
        signs = "".join(re.escape(chr(c)) for c in range(33, 127) if chr(c) in alphabet and not chr(c).isalpha())
        start = f"[{alone}]|{MARK}++(?![^{MARK}{alone}])|{MARK}*" if alone else f"{MARK}++(?![^{MARK}])|{MARK}*"
        if not signs or any(re.search(f"[{LETTERS}][{signs}]", p) for p in self.of):
            return f"{start}[^{MARK}{alone}]+"
        # no letter before a sign, except at the end of a match
        neither, not_letter = f"[^{MARK}{alone}{signs}{LETTERS}]", f"[^{MARK}{alone}{LETTERS}]"
        return f"{start}(?:{not_letter}+(?:[{LETTERS}]+(?:{neither}{not_letter}*)?)*|(?:[{LETTERS}]+(?:{neither}{not_letter}*)?)+)"

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in n]
        byte_ids = {int(pieces[i][3:5], 16): i for i in n if model.is_byte(i)}
        if len(byte_ids) != 256:
            raise ValueError("the vocabulary needs all 256 byte pieces")
        return cls(pieces, [model.get_score(i) for i in n], byte_ids, {i for i in n if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)})

    def unknown_ids(self, c: str) -> list[int]:
        """The byte pieces of a character that no piece covers."""
        return [self.byte_ids[b] for b in (MARK if c == _LITERAL_MARK else c).encode("utf-8", "surrogatepass")]

    def edges(self, s: str) -> list[list[tuple[int, float, list[int]]]]:
        """For each end position the pieces that end there: (start, score, ids)."""
        into: list[list] = [[] for _ in range(len(s) + 1)]
        for i in range(len(s)):
            node, single = self.trie, False
            for j in range(i, len(s)):
                if s[j] not in node:
                    break
                node, piece, score = node[s[j]]
                if piece >= 0:
                    into[j + 1].append((i, score, [piece]))
                    single = single or j == i
            if not single:
                into[i + 1].append((i, self.unknown, self.unknown_ids(s[i])))
        return into

    def viterbi(self, s: str) -> tuple[list[int], float, float]:
        """The best segmentation of a stretch, its score, and that of the second best (-inf if none)."""
        none, n, trie, longest = -INFINITE, len(s), self.trie, self.longest
        best, second, start, last = [none] * (n + 1), [none] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here, other, node, k = best[i], second[i], trie, i
            for c in s[i : i + longest]:
                step = node.get(c)
                if step is None:
                    break
                k += 1
                node, piece, score = step
                if piece >= 0:
                    found, before = here + score, best[k]
                    if found > before:
                        best[k], start[k], last[k] = found, i, piece
                        found = other + score
                        second[k] = found if found > before else before
                    elif found > second[k]:
                        second[k] = found
            if (single := trie.get(s[i])) is None or single[1] < 0:
                found, before = here + self.unknown, best[i + 1]
                if found > before:
                    best[i + 1], start[i + 1], last[i + 1] = found, i, -1
                    second[i + 1] = max(other + self.unknown, before)
                elif found > second[i + 1]:
                    second[i + 1] = found
        ids, at = [], n
        while at:
            i = start[at]
            ids += [last[at]] if last[at] >= 0 else reversed(self.unknown_ids(s[i]))
            at = i
        ids.reverse()
        return ids, best[n], second[n]

    def n_best(self, s: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of a stretch: (score, ids), best first."""
        into = self.edges(s)
        best = [0.0]
        for ending in into[1:]:  # forward Viterbi
            best.append(max([best[i] + score for i, score, _ in ending]))
        found, count = [], 0
        agenda = [(-best[-1], len(s), 0, 0.0, None)]
        push, pop = heapq.heappush, heapq.heappop
        while agenda and len(found) < n:  # backward A*: the rest of a path is worth best[position] exactly
            _, at, _, behind, path = pop(agenda)
            if at == 0:
                ids: list[int] = []
                while path:
                    ids += path[0]
                    path = path[1]
                found.append((behind, tuple(ids)))
                continue
            for i, score, ids in into[at]:
                count += 1
                push(agenda, (-(behind + score + best[i]), i, count, behind + score, (ids, path)))
        return found


class Memory(dict):
    """stretch -> (ids as bytes, score, what its second best loses); keeps what was used lately."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.before = vocabulary, {}

    def __missing__(self, s: str) -> tuple[bytes, float, float]:
        value = self.before.get(s)
        if value is None:
            ids, best, second = self.vocabulary.viterbi(s)
            value = (array("i", ids).tobytes(), best, best - second)
        if len(s) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[s] = value
        return value


def _combine(stretches: list[str], best: tuple[bytes, ...], loss: np.ndarray, vocabulary: Vocabulary, n: int) -> list[tuple[float, list[tuple[int, tuple[int, ...]]]]]:
    """The n best choices over a text's stretches, the best itself left out: (loss, [(stretch, ids)]).

    Only the n-1 stretches whose second best loses least can differ from their best in the result.
    """
    at = np.flatnonzero(loss <= np.partition(loss, n - 2)[n - 2]) if len(loss) >= n else np.arange(len(loss))
    at = at[np.lexsort((at, loss[at]))][: n - 1]
    slots = []
    for k in at[loss[at] < INFINITE].tolist():
        first = tuple(memoryview(best[k]).cast("i"))
        options = vocabulary.n_best(stretches[k], n)  # of equal best ones, that of the Viterbi pass comes first
        slots.append((k, [(options[0][0], first), *(o for o in options if o[1] != first)][:n]))
    lost = [[options[0][0] - o[0] for o in options] for _, options in slots]
    found: list = []
    agenda = [(losses[1], ((k, 1),)) for k, losses in enumerate(lost)]
    heapq.heapify(agenda)
    while agenda and len(found) < n - 1:
        total, chosen = heapq.heappop(agenda)
        found.append((total, sorted((slots[k][0], slots[k][1][o][1]) for k, o in chosen)))
        k, option = chosen[-1]
        if option + 1 < len(lost[k]):
            heapq.heappush(agenda, (total - lost[k][option] + lost[k][option + 1], (*chosen[:-1], (k, option + 1))))
        for later in range(k + 1, len(slots)):
            heapq.heappush(agenda, (total + lost[later][1], (*chosen, (later, 1))))
    return found


class Encoder:
    """Encodes and decodes whole texts; remembers stretches."""

    def __init__(self, vocabulary: Vocabulary, n: int = N_BEST, memory: Memory | None = None):
        self.vocabulary, self.n, self.memory = vocabulary, n, memory if memory is not None else Memory(vocabulary)

    def encode(self, text: str) -> tuple[bytes, float, list[tuple[float, list[dict]]]]:
        """The best ids (int32 as bytes), their score, and the next best as (score, edits to the best ids)."""
        if not text:
            return b"", 0.0, []
        marked = MARK + text.replace(MARK, _LITERAL_MARK).replace(" ", MARK)
        memory = self.memory
        stretches = self.vocabulary.stretches.findall(marked)
        parts = [memory[s] for s in stretches]
        best, scores, loss = zip(*parts)
        ids, score = b"".join(best), float(sum(scores))
        others = []
        if self.n > 1:
            chosen = _combine(stretches, best, np.array(loss), self.vocabulary, self.n)
            places = list(itertools.accumulate(map(len, best), initial=0)) if chosen else []
            for lost, changes in chosen:
                others.append((score - lost, [{"at": places[k] // 4, "n": len(best[k]) // 4, "ids": list(other)} for k, other in changes]))
        return ids, score, others

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        """The UTF-8 that ids stand for; a leading space, the mark put in front, goes."""
        return b"".join(map(self.vocabulary.decoded.__getitem__, ids)).removeprefix(b" ")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of any ids that make UTF-8."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def apply_edits(ids: list[int], edits: list) -> list[int]:
    """The ids of a further segmentation: each edit replaces ``n`` of the best ids from place ``at``."""
    out, done = [], 0
    for e in edits:
        out += [*ids[done : e["at"]], *e["ids"]]
        done = e["at"] + e["n"]
    return [*out, *ids[done:]]


def encode(documents: DataFrame, model_file: str, n_best: int = N_BEST, doc_id: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (the best), n_pieces, score, ``others`` (the next best, as edits to ids) and round_trip.

    round_trip tells whether decoding the ids gives the text back. The model file is read on the
    driver and its vocabulary, of fixed size, broadcast.
    """
    spark = documents.sparkSession
    small_batches(spark)
    shared = share(spark, Memory(Vocabulary.load(model_file)))  # a worker's tasks share the memory
    edit = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])
    other = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared().vocabulary, n_best, shared())
        for batch in in_slices(batches, 1 << 20):
            held, sizes, scores, others, same = [], [], [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                if text is None:
                    for column in (sizes, scores, others, same):
                        column.append(None)
                    continue
                ids, score, more = encoder.encode(text)
                held.append(ids)
                sizes.append(len(ids) // 4)
                scores.append(score)
                others.append([{"score": s, "edits": e} for s, e in more])
                same.append(encoder.decode_bytes(memoryview(ids).cast("i")) == text.encode("utf-8", "surrogatepass"))
            offsets = np.cumsum([0, *(n or 0 for n in sizes)])
            none = np.array([n is None for n in sizes], bool)
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(held), np.int32)), mask=pa.array(none))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, pa.array(sizes, pa.int64()), pa.array(scores, pa.float64()), pa.array(others, other), pa.array(same, pa.bool_())],
                ["doc_id", "ids", "n_pieces", "score", "others", "round_trip"],
            )

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, n_pieces bigint, score double, others {EDITS}, round_trip boolean")


def decode(encoded: DataFrame, model_file: str, id_col: str = "ids", out: str = "text") -> DataFrame:
    """The rows of ``encoded`` (as ``row``) with the text of their ids; null ids give a null text."""
    shared = share(encoded.sparkSession, Vocabulary.load(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared())
        for batch in in_slices(batches, 1 << 20):
            texts = [None if ids is None else encoder.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", out])

    rows = encoded.select(F.struct("*").alias("row"), F.col(id_col).alias("ids"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {out} string")
