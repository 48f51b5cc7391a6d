"""Token counts: how many pieces the best unigram segmentation of a text has, without making the pieces.

Method: an Aho-Corasick automaton over the vocabulary lists every piece that ends at a position; dynamic programming
carries the best score and its piece count. Tie rules of unigram tokenizers: a later candidate replaces the best
one only with a strictly greater score, and candidates come by ascending start, so of equal scores the one with
the longest last piece stays. A character that is no piece on its own may be unknown, at the smallest vocabulary
score less 10; with byte fallback it counts as many pieces as it has UTF-8 bytes, without it a run of unknown characters is
one piece.

With ``whole`` every character of a text counts: a word mark stands in front of the text and for each blank, and line
feeds and tabs are pieces or bytes. The text is cut where no piece of the vocabulary holds the two neighbouring bytes
side by side, so no piece crosses a cut and the best segmentation is that of the parts. Without it only the words are counted,
each with a word mark in front. Words are ``[^\\x20\\x09-\\x0D]+``; equal words or parts are segmented once.

The vocabulary (pieces and scores of a SentencePiece model file, a parameter) is broadcast: its size is that of
the file. Cases: null or empty text has no words, no tokens and score 0; null ids, repeated rows and extra
columns pass through; an empty table gives an empty result.
"""
from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfwise.llm.common import rows_of, ship, slices, utf8, word_hash, word_spans
from shelfwise.llm.tables import append_column, free_name

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 1 << 18  # a task's table of segmented words is emptied when it gets larger
COUNTS = "struct<n_words: long, n_tokens: long, score: double>"


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a SentencePiece model with their scores (no control, unknown or byte pieces)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Counter:
    """Best score and piece count of words under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.known: dict[int, tuple[float, int, bool, bool]] = {}  # of words, or of parts: a counter is used for one of them
        self.joined = _joined(vocabulary)

    def count(self, word: str) -> tuple[float, int]:
        """Of a word, with a word mark in front."""
        return self.segment(MARK + word)

    def segment(self, word: str) -> tuple[float, int]:
        score, pieces, _, _ = self.best(word)
        return score, pieces

    def best(self, word: str) -> tuple[float, int, bool, bool]:
        """(score, pieces, starts with an unknown run, ends with one); without byte fallback a run of unknowns is one piece."""
        best, pieces = [0.0], [0]
        opens, closes = [False], [False]  # of the best segmentation up to a place: its first and its last piece is unknown
        found = iter(self.automaton.iter(word) if len(self.automaton) else ())
        end, piece = next(found, (-1, None))
        for at, char in enumerate(word):
            top, n, top_start, unknown = None, 0, 0, False
            while end == at:
                start = at + 1 - piece[0]
                score = best[start] + piece[1]
                if top is None or score > top or (score == top and start < top_start):
                    top, n, top_start = score, pieces[start] + 1, start
                end, piece = next(found, (-1, None))
            if char not in self.single:
                score = best[at] + self.unknown
                if top is None or score > top:
                    top, top_start, unknown = score, at, True
                    n = pieces[at] + (len(char.encode()) if self.byte_fallback else not closes[at])
            best.append(top)
            pieces.append(n)
            if not self.byte_fallback:
                opens.append(opens[top_start] if top_start else unknown)
                closes.append(unknown)
        return best[-1], pieces[-1], opens[-1], closes[-1]

    def rows(self, data: np.ndarray, offsets: np.ndarray, whole: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n_words, n_tokens, score) of every row of a slice."""
        starts, ends, first = word_spans(data, offsets)
        n_words = np.diff(first)
        if whole:
            data, starts, ends, first = self.parts(data, offsets)
        distinct, at, which = np.unique(word_hash(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        raw = data.tobytes()
        out = []
        for key, a, b in zip(distinct.tolist(), starts[at].tolist(), ends[at].tolist()):
            found = self.known.get(key)
            if found is None:
                part = raw[a:b].decode()
                found = self.known[key] = self.best(part.replace(" ", MARK) if whole else MARK + part)
            out.append(found)
        table = np.array(out, float).reshape(-1, 4)
        row, n = rows_of(first), len(offsets) - 1
        score, tokens = (np.bincount(row, table[which, i], n) for i in (0, 1))
        if whole and not self.byte_fallback:  # a run of unknowns that goes over a cut is one piece
            opens, closes = table[which, 2] > 0, table[which, 3] > 0
            over = closes[:-1] & opens[1:] & (row[:-1] == row[1:])
            tokens -= np.bincount(row[1:][over], minlength=n)
        return n_words, tokens.astype(np.int64), score

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes with a blank before each row that is not empty, starts and ends of the parts, first part per row."""
        filled = np.diff(offsets) > 0
        marked = np.insert(data[:offsets[-1]], offsets[:-1][filled], 32)
        at = offsets + np.append(0, np.cumsum(filled))
        cut = np.ones(len(marked), bool)
        cut[1:] = ~self.joined[marked[:-1], marked[1:]]
        cut[at[:-1][filled]] = True
        starts = np.flatnonzero(cut)
        return marked, starts, np.append(starts[1:], len(marked))[:len(starts)], np.searchsorted(starts, at)


def _joined(vocabulary: list[tuple[str, float]]) -> np.ndarray:
    """Table of the byte pairs that stand side by side in a piece, a blank for the word mark; characters are never cut."""
    joined = np.zeros((256, 256), bool)
    for piece, _ in vocabulary:
        b = np.frombuffer(piece.replace(MARK, " ").encode(), np.uint8)
        joined[b[:-1], b[1:]] = True
    mark = MARK.encode()  # as a character of the text it is the same symbol as a blank
    joined[mark[-1]] |= joined[32]
    joined[:, mark[0]] |= joined[:, 32]
    joined[:, 0x80:0xC0] = True
    return joined


def with_token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]], byte_fallback: bool = True,
                      whole: bool = False) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (its name is returned): n_words, n_tokens and score of the whole texts or of their words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary file
    held: list[Counter] = []

    def kernel(text):
        if not held:
            held.append(Counter(shared.value, byte_fallback))
        data, off = utf8(text)
        parts = [held[0].rows(data[off[a]:off[b]], off[a:b + 1] - off[a], whole) for a, b in slices(off)]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        columns = [pa.array(np.concatenate([p[i] for p in parts]) if parts else [], k) for i, k in enumerate(kinds)]
        return pa.StructArray.from_arrays(columns, ["n_words", "n_tokens", "score"])
    out = free_name(docs, "token_counts")
    return append_column(docs, out, COUNTS, ["text"], kernel), out


ship(__name__)
