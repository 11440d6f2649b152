"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each
position. Dynamic programming carries the best score and the number of pieces,
no path. The rules are those of the unigram tokenizers: a character without a
piece of its own may be unknown, at the smallest piece score less 10; a later
candidate replaces an earlier one only when strictly better, so of equal scores
the piece that starts first (the longest) wins; an unknown character counts as
its UTF-8 bytes when the vocabulary has byte pieces, else as one.

The text is a blank followed by the text, blanks written as the blank sign. Pieces never cross from
a word to a following blank, which is checked on the vocabulary, so a text's
best path is made of those of its words: words are looked up, and a miss runs the
automaton. Words are cut further at borders between letters, line breaks
and other characters where no piece crosses them. Cutting needs scores that add up exactly:
with other than integer scores the text is one word.

Defined results: null and empty texts have no tokens and score 0; repeated rows
get equal results; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from recspark.llm.common import map_batches, narrow, utf8

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
_CACHE_LIMIT = 150_000  # words per worker; a full table starts again
_PART_LIMIT = 400_000

_KINDS = re.compile(r"(?P<blank>▁)|(?P<letter>[^\W\d_²³¹¼½¾])|(?P<line>[\n\t])|(?P<other>.)",
                    re.S)
_CUT = re.compile(r"▁*[^\W\d_²³¹¼½¾]+|▁*[\n\t]+|▁*(?:(?![▁\n\t])[\W\d_²³¹¼½¾])+|▁+")


def read_vocabulary(path: str) -> tuple[dict[str, float], bool]:
    """Ordinary pieces with their scores, and whether there are byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, by_bytes = {}, False
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            by_bytes = True
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i)] = model.get_score(i)
    return pieces, by_bytes


class Counter(dict):
    """word -> complex(pieces, score) of the blank sign and the word; sums of complex
    numbers add counts and scores at once, exactly for integers."""

    def __init__(self, pieces: dict[str, float], by_bytes: bool):
        super().__init__()
        self.by_bytes = by_bytes
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for p, score in pieces.items():
            self.automaton.add_word(p, (len(p), score))
        if pieces:
            self.automaton.make_automaton()
        self.parts: dict[str, complex] = {}
        exact = all(float(s).is_integer() for s in pieces.values())
        crossed = {(_KINDS.match(a).lastgroup, _KINDS.match(b).lastgroup)
                   for p in pieces for a, b in zip(p, p[1:])}
        kinds = ("letter", "line", "other")
        self.by_word = exact and not any((k, "blank") in crossed for k in kinds)
        self.by_kind = self.by_word and not any(
            (a, b) in crossed for a in kinds for b in kinds if a != b)

    def best(self, s: str) -> complex:
        """Best (pieces, score) of ``s``, the whole dynamic programme."""
        n = len(s)
        score, count, start = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        ends: list[list] = [[] for _ in range(n + 1)]
        if len(self.automaton):
            for at, found in self.automaton.iter(s):
                ends[at + 1].append(found)
        for e in range(1, n + 1):
            best, who, pieces = None, -1, 0
            for length, own in ends[e]:
                b = e - length
                x = score[b] + own
                if best is None or x > best or (x == best and b < who):
                    best, who, pieces = x, b, count[b] + 1
            if s[e - 1] not in self.single:
                x = score[e - 1] + self.unknown
                if best is None or x > best:
                    best, who = x, e - 1
                    pieces = count[e - 1] + (len(s[e - 1].encode()) if self.by_bytes else 1)
            score[e], count[e], start[e] = best, pieces, who
        return complex(count[n], score[n])

    def chunk(self, s: str) -> complex:
        """``s`` is blank signs and a word; cut at borders that no piece crosses."""
        total = 0j
        for part in _CUT.findall(s) if self.by_kind else (s,):
            found = self.parts.get(part)
            if found is None:
                found = self.best(part)
                if len(part) < 64:
                    if len(self.parts) >= _PART_LIMIT:
                        self.parts.clear()
                    self.parts[part] = found
            total += found
        return total

    def __missing__(self, word: str) -> complex:
        found = self.chunk(BLANK + word)
        if len(word) < 64:
            if len(self) >= _CACHE_LIMIT:
                self.clear()
            self[word] = found
        return found

    def text(self, text: str) -> complex:
        if not text:
            return 0j
        if not self.by_word:
            return self.best(BLANK + text.replace(" ", BLANK))
        if BLANK not in text and "  " not in text and text[0] != " ":
            return sum(map(self.__getitem__, text.split(" ")), 0j)
        whole = BLANK + text.replace(" ", BLANK)
        return sum(map(self.chunk, re.findall(f"{BLANK}+[^{BLANK}]*", whole)), 0j)


_LOADED: dict[str, Counter] = {}


def counter(vocabulary: str) -> Counter:
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = Counter(*read_vocabulary(vocabulary))
    return _LOADED[vocabulary]


def count_tokens(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_tokens, score of the best segmentation."""
    def run(batches):
        count = counter(vocabulary)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            raw = data.tobytes()
            found = [count.text(raw[a:b].decode())
                     for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int(x.real) for x in found], pa.int64()),
                 pa.array([x.imag for x in found], pa.float64())],
                names=["doc_id", "n_tokens", "score"])

    rows = narrow(docs, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {id_type}, n_tokens bigint, score double")
