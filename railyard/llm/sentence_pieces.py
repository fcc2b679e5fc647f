"""SentencePiece encoding and decoding by Aho-Corasick and Viterbi (operator 7).

An Aho-Corasick automaton over all pieces reads a text once; at each position it follows the output links to the pieces
that end there, each of which relaxes the best score of a segmentation that ends at that position (Viterbi). Scores are
those of the model file; in a BPE model these are merge ranks, so the ids are the Viterbi optimum over them and not the
ids of SentencePiece's own BPE encoder, and the file's normaliser isn't applied. Characters that no piece covers become byte pieces, at a price below every piece. Ties go to
the segmentation whose last piece is longest.

Where no piece holds a word mark after another character, the best segmentation of a text is that of its parts between
word marks, so a task remembers a bounded number of parts. Encoding marks blanks and puts one mark before the text;
decoding undoes both, so ``decode(encode(text)) == text`` for every text without the word mark itself, which reads as a
blank.

Defined cases: a null text gives null ids and a null text again; an empty one gives no ids. Rows are treated one by one,
whatever their ids; other columns take no part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm.common import documents

MARK = "▁"
BYTE_PRICE = 10.0  # below the lowest score, for each byte
REMEMBERED = 500_000
_BYTE = re.compile("<0x([0-9A-F]{2})>")


class Pieces:
    """A model's pieces, their automaton, and ids of parts of text seen so far."""

    def __init__(self, scores: list[tuple[str, float]]):
        """scores: (piece, score) by id; unknown, control and byte pieces are told by their form."""
        self.pieces = [p for p, _ in scores]
        self.byte_ids = {int(m[1], 16): i for i, p in enumerate(self.pieces) if (m := _BYTE.fullmatch(p))}
        special = {"<unk>", "<s>", "</s>", *(self.pieces[i] for i in self.byte_ids.values())}
        usable = {p: (i, s) for i, (p, s) in enumerate(scores) if p and p not in special and s > -1e8}
        lowest = min((s for _, s in usable.values()), default=0.0)
        self.byte_score = lowest - BYTE_PRICE
        self.automaton = ahocorasick.Automaton()
        for p, (i, s) in usable.items():
            self.automaton.add_word(p, (len(p), i, s))
        self.automaton.make_automaton()
        self.by_part = not any(MARK in p.lstrip(MARK) for p in usable)
        self.output = [b"" if p in ("<s>", "</s>") else bytes([int(_BYTE.fullmatch(p)[1], 16)]) if _BYTE.fullmatch(p) else p.encode() for p in self.pieces]
        self.seen: dict[str, bytes] = {}

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation, in one pass over the automaton's output."""
        n = len(text)
        best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        at = 1

        def fall_back(upto: int) -> None:
            """Close positions that no more pieces will end at: the byte way competes there."""
            nonlocal at
            while at <= upto:
                raw = text[at - 1].encode()
                s = best[at - 1] + self.byte_score * len(raw)
                if s > best[at]:
                    best[at], back[at] = s, (at - 1, [self.byte_ids[b] for b in raw])
                at += 1

        for last, (size, i, s) in (self.automaton.iter(text) if len(self.automaton) else ()):
            fall_back(last)  # positions before this one are final
            start = last + 1 - size
            if best[start] + s > best[last + 1] or best[start] + s == best[last + 1] and start < back[last + 1][0]:
                best[last + 1], back[last + 1] = best[start] + s, (start, [i])
        fall_back(n)
        out, x = [], n
        while x:
            x, ids = back[x]
            out.append(ids)
        return [i for ids in reversed(out) for i in ids]

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        if not self.by_part:
            return np.array(self.segment(marked), np.uint32).tobytes()
        out = []
        for part in re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked):
            ids = self.seen.get(part)
            if ids is None:
                ids = np.array(self.segment(part), np.uint32).tobytes()
                if len(self.seen) < REMEMBERED:
                    self.seen[part] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.output.__getitem__, np.frombuffer(ids, np.uint32).tolist()))
        text = raw.decode("utf-8", "replace")
        return text.replace(MARK, " ")[1:] if text.startswith(MARK) else text


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return Pieces([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())])


def _encoded(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = load(path)
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            ids = [None if t is None else pieces.encode(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["row", "ids"])


def _decoded(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces = load(path)
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            texts = [None if b is None else pieces.decode(b) for b in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["row", "text"])


def _apply(docs: DataFrame, column: str, function, result: str) -> DataFrame:
    two = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != column]).alias("row"), F.col(column).alias("value"))
    return two.mapInArrow(function, f"row {two.schema['row'].dataType.simpleString()}, {result}")


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(row, ids): the other columns as a struct, and the ids as little-endian 32-bit binary."""
    return _apply(docs, text_col, partial(_encoded, path), "ids binary")


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """(row, text) from a column of ids."""
    return _apply(rows, ids_col, partial(_decoded, path), "text string")


def _digests(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both ways at once, so that ids and texts needn't leave the task."""
    pieces = load(path)
    for batch in batches:
        out = []
        for text in batch.column(1):
            text = text.as_py()
            ids = pieces.encode(text or "")
            out.append((len(ids) // 4, zlib.crc32(ids), pieces.decode(ids) == (text or "")))
        n, crc, same = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                                         ["doc_id", "n_ids", "ids_crc32", "round_trip"])


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32 of the ids, and whether decoding them gives the text again (null text: empty)."""
    return documents(spark, sf_dir).select("doc_id", "text").mapInArrow(
        partial(_digests, model_path()), "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
