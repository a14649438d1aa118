"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece in a stretch of text; the
best segmentation is carried forward as a score and a piece count, without the
pieces. Ties follow the tokenizer: starts are tried in order and a later one
must be strictly better, so of equal scores the longest last piece wins, and the
unknown piece, tried after the pieces of its start, only wins where it is
strictly better. A character that no single piece covers counts as its bytes if the
vocabulary has byte pieces, else as one unknown piece.

The vocabulary's pieces never hold a white space after another character, so
texts are cut there and stretches counted once; their sums are exact, where a
32-bit sum over a long text would round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.chunks import ChunkEncoder
from lakeloom.llm.common import held, map_arrow, only

SPACE, UNKNOWN_PENALTY, NEVER = "▁", 10.0, -1e8


class UnigramCounter:
    """Counts the pieces of stretches of text."""

    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        if any(a != SPACE and b == SPACE for p, _ in pieces for a, b in zip(p, p[1:], strict=False)):
            raise ValueError("a piece has white space after another character: stretches would not be independent")

    def best(self, text: str) -> tuple[float, int]:
        """Score and count of the best segmentation."""
        score, count = [0.0] + [None] * len(text), [0] + [0] * len(text)
        single, done = False, 0  # whether a piece is just the character before `done`

        def unknown(end: int) -> None:
            s = score[end - 1] + self.unknown
            if not single and (score[end] is None or s > score[end]):
                score[end], count[end] = s, count[end - 1] + (len(text[end - 1].encode()) if self.byte_pieces else 1)

        matches: list[list[tuple[int, float]]] = [[] for _ in range(len(text) + 1)]
        for end, (n, s) in self.machine.iter(text) if len(self.machine) else ():
            matches[end + 1].append((n, s))
        for done in range(1, len(text) + 1):
            single = False
            for n, s in sorted(matches[done], key=lambda x: -x[0]):  # earliest start first
                single |= n == 1
                s += score[done - n]
                if score[done] is None or s > score[done]:
                    score[done], count[done] = s, count[done - n] + 1
            unknown(done)
        return score[-1], count[-1]

    def counts(self, runs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """One number for each stretch."""
        out = np.array([self.best(s.decode().replace(" ", SPACE))[1] for r in runs for s in r], np.uint32)
        return out, np.ones(len(out), np.int64)


def word_cuts(data: np.ndarray) -> np.ndarray:
    """Spaces after another byte."""
    return np.flatnonzero((data[1:] == 32) & (data[:-1] != 32)) + 1


def vocabulary(model_file: str) -> tuple[list[tuple[str, float]], bool]:
    """Normal pieces and scores of a model file, and whether it has byte pieces. Scores that only mark a piece as never to be made (NEVER and less) become one less than the least other."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = [i for i in range(m.get_piece_size()) if not (m.is_unknown(i) or m.is_control(i) or m.is_byte(i) or m.is_unused(i))]
    least = min((m.get_score(i) for i in ids if m.get_score(i) > NEVER), default=0.0) - 1
    return [(m.id_to_piece(i), max(m.get_score(i), least)) for i in ids], any(m.is_byte(i) for i in range(m.get_piece_size()))


def counter(model_file: str) -> ChunkEncoder:
    """One for each worker."""
    return held(("unigram", model_file), lambda: ChunkEncoder(UnigramCounter(*vocabulary(model_file)).counts, word_cuts))


def token_counts(docs: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """doc_id and n_tokens of every whole text, with the dummy space that the tokenizer puts before a text. Null and empty texts have 0; equal texts have equal counts; repeated rows stay, an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model_file)
        for batch in batches:
            for i, j, counts, bounds in own.column(batch.column(1)):
                total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[bounds]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(total))], ["doc_id", "n_tokens"])

    spaced = F.when(F.length("text") > 0, F.concat(F.lit(" "), F.col("text"))).otherwise("")
    return map_arrow(only(docs, doc_id="doc_id", text=text).select(F.col("doc_id").cast("long"), spaced.cast("string").alias("text")), run, "doc_id bigint, n_tokens bigint", holds=True)
