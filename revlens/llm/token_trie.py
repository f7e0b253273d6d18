"""Token counts under a unigram model, with scores shared along a trie.

Pre-tokens (white-space chunks behind a word mark) go into a trie. A node is a prefix and keeps
the best score of any split of that prefix into vocabulary pieces and the number of tokens in
it, so a prefix shared by many pre-tokens is scored once; a pre-token's count is read at its
last node. The vocabulary file gives pieces in the order in which they were made; a piece's
probability falls with that place (Zipf): ``-ln(place + 1) - ln(H)``. A character that is no
piece is spelled in bytes, each one token at ``BYTE_SCORE``. Of equal scores the split with
fewer tokens counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.llm.common import slices, worker_state

#: Log score of one fallback byte; below that of any vocabulary piece.
BYTE_SCORE = -24.0
#: Fixed value: the mark that the vocabulary puts before a word.
WORD_MARK = "▁"
#: Trie nodes held by one Python worker; a full trie is dropped and grown anew.
MAX_NODES = 700_000
#: Longer pre-tokens are scored along a path of their own, outside the trie.
MAX_SHARED_CHARS = 48


class TokenTrie:
    """``count(pre_token)`` is the number of tokens of its best split."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self._clear()

    @classmethod
    def load(cls, path: str) -> TokenTrie:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kept = [i for i in range(model.vocab_size())
                if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        total = math.log(sum(1 / (k + 1) for k in range(len(kept))))
        return cls({model.id_to_piece(i): -math.log(k + 1) - total for k, i in enumerate(kept)})

    def _clear(self) -> None:
        self.edges: dict[tuple[int, str], int] = {}
        self.best = [0.0]
        self.tokens = [0]
        self.terminals: dict[str, int] = {}

    def _step(self, text: str, i: int, best: list[float], tokens: list[int]) -> tuple[float, int]:
        """Best score and its tokens for text[:i], from those of the shorter prefixes by their sizes."""
        size = len(text[i - 1].encode())
        top, least = best[i - 1] + size * BYTE_SCORE, tokens[i - 1] + size
        get = self.scores.get
        for at in range(max(0, i - self.longest), i):
            score = get(text[at:i])
            if score is not None:
                score += best[at]
                n = tokens[at] + 1
                if score > top or score == top and n < least:
                    top, least = score, n
        return top, least

    def _grow(self, text: str) -> int:
        edges, best, tokens = self.edges, self.best, self.tokens
        node, scores, counts = 0, [0.0], [0]  # of the prefixes on the path
        for i, char in enumerate(text, 1):
            child = edges.get((node, char))
            if child is None:
                score, n = self._step(text, i, scores, counts)
                child = edges[node, char] = len(best)
                best.append(score)
                tokens.append(n)
            node = child
            scores.append(best[node])
            counts.append(tokens[node])
        return tokens[node]

    def _alone(self, text: str) -> int:
        best, tokens = [0.0], [0]
        for i in range(1, len(text) + 1):
            score, n = self._step(text, i, best, tokens)
            best.append(score)
            tokens.append(n)
        return tokens[-1]

    def count(self, pre_token: str) -> int:
        known = self.terminals.get(pre_token)
        if known is not None:
            return known
        if len(pre_token) > MAX_SHARED_CHARS:
            return self._alone(WORD_MARK + pre_token)
        if len(self.best) >= MAX_NODES:
            self._clear()
        n = self.terminals[pre_token] = self._grow(WORD_MARK + pre_token)
        return n


def token_trie(path: str) -> TokenTrie:
    """One trie for each Python worker, kept from task to task."""
    return worker_state(("trie", path), lambda: TokenTrie.load(path))


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every whole text.

    Null, empty and blank texts have no tokens; repeated rows are counted each; columns other
    than doc_id and text are not read.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_pretokens", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = token_trie(vocabulary)
        for batch in slices(batches):
            words = [(t or "").split() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, words), pa.int64()),
                 pa.array((sum(map(trie.count, w)) for w in words), pa.int64())], names=schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
