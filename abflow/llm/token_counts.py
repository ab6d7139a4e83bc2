"""Token counts by trie-shared dynamic programming (operator 1).

A text is cut at ASCII white space into pre-tokens, each headed by the piece
vocabulary's word mark. A pre-token's tokens are the segmentation of the
highest unigram score. Distinct pre-tokens are inserted in a trie; the forward
score of a node (best score and fewest tokens of the letters down to it) is
computed once, when the node is made, and so shared by all pre-tokens with that
prefix. The end node's count is stored and summed over the text.

Narrow: each Python worker has a trie over the distinct pre-tokens of its texts, kept from
task to task. A trie over ``NODES`` nodes is replaced by a new one, which bounds memory
and changes no count; the terminal counts of the last one stay until the next is full.

The vocabulary is an argument (piece -> log score). The query takes the pieces of
a public vocabulary file, which has ranks instead of probabilities, and scores rank r by
Zipf's law, -ln(r + 2). A character that no piece covers costs one token for each
of its UTF-8 bytes, each at ``BYTE_SCORE`` below the lowest piece.

Defined cases: null, empty and blank texts have 0; ties in score take the
fewer tokens; a pre-token over ``LONGEST`` letters is counted by the same
recurrence outside the trie; repeated rows and null ids are counted like
others; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table
from .tokens import public_path, some_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARK = "▁"
NODES = 400_000
PART_CHARS = 4 << 20  # text whose distinct pre-tokens are inserted together
LONGEST = 200
BYTE_SCORE = 5.0
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


class Trie:
    """Forward scores by prefix, over a fixed vocabulary."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.lowest = min(scores.values(), default=0.0) - BYTE_SCORE
        # what a piece may end with: a last piece is looked for only as far back as one can reach
        self.tails = {p[i:] for p in scores for i in range(len(p))}
        self.old: dict[str, int] = {}
        self.done: dict[str, int] = {}
        self.fresh()

    def fresh(self) -> None:
        """An empty trie: node 0 is the word mark's parent. Terminal counts stay for one more trie."""
        self.edge: dict[tuple[int, str], int] = {}
        self.best, self.count = [0.0], [0]
        self.old, self.done = self.done, {}

    def forward(self, word: str, i: int, best: list[float], count: list[int]) -> tuple[float, int]:
        """Best score and count of word[:i + 1], given those of the shorter prefixes."""
        c = word[i]
        size = 1 if c < "\x80" else len(c.encode())
        top, n = best[i] + size * self.lowest, count[i] + size
        tails, scores, end = self.tails, self.scores, i + 1
        for j in range(i, -1, -1):
            piece = word[j:end]
            if piece not in tails:
                break
            s = scores.get(piece)
            if s is not None:
                s += best[j]
                if s > top or (s == top and count[j] + 1 < n):
                    top, n = s, count[j] + 1
        return top, n

    def tokens(self, pre_token: str) -> int:
        """Tokens of a pre-token."""
        got = self.done.get(pre_token)
        if got is not None:
            return got
        got = self.old.get(pre_token)
        if got is not None:
            self.done[pre_token] = got
            return got
        word = MARK + pre_token
        if len(self.best) > NODES or len(self.done) > NODES:
            self.fresh()
        edge, scores, counts = self.edge, self.best, self.count
        best, count, node, i = [0.0], [0], 0, 0
        for c in word[:LONGEST]:  # the shared prefix
            after = edge.get((node, c))
            if after is None:
                break
            best.append(scores[after])
            count.append(counts[after])
            node = after
            i += 1
        for i in range(i, len(word)):
            b, n = self.forward(word, i, best, count)
            if i < LONGEST:
                edge[node, word[i]] = len(scores)
                node = len(scores)
                scores.append(b)
                counts.append(n)
            best.append(b)
            count.append(n)
        if len(word) <= LONGEST:
            self.done[pre_token] = count[-1]
        return count[-1]

    def counts(self, words: set[str]) -> dict[str, int]:
        """Tokens of distinct pre-tokens. The new ones go in in order, so that words with one
        prefix lie side by side and a trie that is full and renewed is hardly missed."""
        out = {w: n for w in words if (n := self.done.get(w)) is not None}
        for w in sorted(words.difference(out)):
            out[w] = self.tokens(w)
        return out


_tries: dict[str, Trie] = {}


def _trie(name: str, scores) -> Trie:
    """One trie per Python worker; that of another vocabulary goes."""
    if name not in _tries:
        _tries.clear()
        _tries[name] = Trie(scores.value)
    return _tries[name]


def piece_scores(model_file: str) -> dict[str, float]:
    """Pieces of a sentencepiece vocabulary file by rank; no control or byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): -math.log(r + 2) for r, i in enumerate(plain)}


def token_counts(docs: DataFrame, scores: dict[str, float]) -> DataFrame:
    """doc_id, n_words, n_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(scores)  # a vocabulary: of fixed size
    name = uuid.uuid4().hex

    def run(batches):
        trie = _trie(name, shared)
        for batch in batches:
            names, rows = batch.column("doc_id").to_pylist(), []
            for first, texts in some_texts(batch.column("text").to_pylist(), PART_CHARS):
                words = [WORD.findall(t) if t else [] for t in texts]
                count = trie.counts(set().union(*words)).__getitem__
                rows += [(d, len(w), sum(map(count, w))) for d, w in zip(names[first:first + len(texts)], words, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_OUT)], schema=_OUT)

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op1(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents over the public 32k vocabulary."""
    return token_counts(read_table(spark, sf_dir, "documents"), piece_scores(public_path("piece_bpe_32k.model")))
