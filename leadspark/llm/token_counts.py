"""Token counts under a unigram model, by dynamic programming on a trie of words.

A text is cut into pre-tokens: words with the mark of the space before them. The count of a
pre-token is the number of pieces of its most probable segmentation. The forward scores of
that search depend only on the characters so far, so pre-tokens with a common beginning
share them: a task takes its different pre-tokens in sorted order, which walks their trie
in depth, keeps the scores of the path on a stack, and computes only what lies below the
branching. The count at a terminal goes to every place the pre-token is found.

The vocabulary file names its pieces by rank; their log probabilities follow Zipf's law,
-log(rank + ZIPF). A character that no piece covers costs one token for each of its bytes.

Edge cases: NULL, empty and blank texts count 0; texts are counted whole, a very long word
in time that grows with its length; repeated rows are counted alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"  # stands for a space in the vocabulary
ZIPF = 3.0
#: Log probability of one byte of a character that no piece covers.
BYTE_SCORE = -20.0
#: Characters of texts whose pre-tokens share one trie.
TRIE_CHARS = 16_000_000


class Vocabulary:
    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        read = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        self.scores: dict[str, float] = {}
        for rank in range(read.get_piece_size()):
            if not (read.is_control(rank) or read.is_unknown(rank) or read.is_byte(rank)):
                self.scores[read.id_to_piece(rank)] = -math.log(rank + ZIPF)
        # Lengths of the pieces by their last three characters: only these are looked up.
        found: dict[str, list[int]] = {}
        for piece in self.scores:
            found.setdefault(piece[-3:], []).append(len(piece))
        self.long = {end: sorted(x for x in sizes if x > 2) for end, sizes in found.items()}
        self.by_end: dict[str, tuple[int, ...]] = {}

    def lengths(self, end: str) -> tuple[int, ...]:
        """Lengths a piece may have at an end of up to three characters, shortest first."""
        short = [size for size in (1, 2) if size <= len(end) and end[-size:] in self.scores]
        sizes = self.by_end[end] = (*short, *(self.long.get(end, ()) if len(end) == 3 else ()))
        return sizes


def counts(words: Iterable[str], vocabulary: Vocabulary) -> dict[str, int]:
    """Pieces of the best segmentation of each word. Of equal scores fewer pieces win."""
    scores, by_end = vocabulary.scores, vocabulary.by_end
    found: dict[str, int] = {}
    best, pieces = [0.0], [0]  # of the first characters of the word
    before = ""
    for word in sorted(words):
        shared = 0
        for a, b in zip(before, word, strict=False):
            if a != b:
                break
            shared += 1
        del best[shared + 1 :], pieces[shared + 1 :]
        for at in range(shared, len(word)):
            stop = at + 1
            end = word[at - 2 : stop] if at > 1 else word[:stop]
            sizes = by_end.get(end)
            if sizes is None:
                sizes = vocabulary.lengths(end)
            top, parts = -math.inf, 0
            for size in sizes:
                if size > stop:
                    break
                start = stop - size
                score = scores.get(word[start:stop])
                if score is not None:
                    score += best[start]
                    if score > top or (score == top and pieces[start] + 1 < parts):
                        top, parts = score, pieces[start] + 1
            if not sizes or sizes[0] != 1:  # the character itself is no piece
                size = len(word[at].encode())
                score = best[at] + BYTE_SCORE * size
                if score > top or (score == top and pieces[at] + size < parts):
                    top, parts = score, pieces[at] + size
            best.append(top)
            pieces.append(parts)
        found[word] = pieces[-1]
        before = word
    return found


def pretokens(text: str | None) -> list[str]:
    return [MARK + word for word in text.split()] if text else []


def with_counts(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_pretokens, n_tokens) for every document."""

    def told(rows: list[tuple[object, list[str]]], vocabulary: Vocabulary) -> pd.DataFrame:
        each = counts({word for _, words in rows for word in words}, vocabulary)
        made = [(k, len(words), sum(map(each.__getitem__, words))) for k, words in rows]
        return pd.DataFrame(made, columns=["key", "n_pretokens", "n_tokens"]).astype({"key": "Int64"})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, held, size = Vocabulary(model), [], 0
        for batch in batches:
            for k, whole in zip(batch["key"].astype("Int64"), batch["text"], strict=True):
                held.append((k, pretokens(whole)))
                size += len(whole or "")
                if size > TRIE_CHARS:
                    yield told(held, vocabulary)
                    held, size = [], 0
        if held:
            yield told(held, vocabulary)

    read = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = "key long, n_pretokens long, n_tokens long"
    return read.mapInPandas(count, schema).withColumnRenamed("key", key)

