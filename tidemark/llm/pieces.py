"""Numbers of word pieces by a linear longest-match automaton.

The vocabulary is a trie of byte strings. Greedy longest match on a word would have to go back
whenever the trie has no way on; instead each node has a failure link to the node of the rest that
is left after the pieces that greedy matching must emit there, and the number of those pieces. One
walk over the bytes of a word, adding these numbers up, gives the number of pieces without making
any.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import ALPHABET

KEPT = 500_000
START = b" "


class Automaton:
    """Counts the greedy longest-match pieces of a word over a set of byte strings.

    A word that starts with a byte that no piece starts with, or gets stuck, has no pieces; it
    counts as one unknown piece. That cannot happen where all single bytes are pieces.
    """

    def __init__(self, vocabulary: list[bytes]):
        self.next: list[dict[int, int]] = [{}]
        final = [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                node = self.next[node].get(byte) or self._new(node, byte, final)
            final[node] = True
        final[0] = False
        self.fail = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in self.next[parent].items():
                queue.append(node)
                if final[node]:
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                rest, count = self.fail[parent], self.popped[parent]
                while rest >= 0 and byte not in self.next[rest]:
                    count += self.popped[rest]
                    rest = self.fail[rest]
                if rest >= 0:
                    self.fail[node], self.popped[node] = self.next[rest][byte], count

    def _new(self, node: int, byte: int, final: list[bool]) -> int:
        self.next[node][byte] = len(self.next)
        self.next.append({})
        final.append(False)
        return len(self.next) - 1

    def count(self, word: bytes) -> int:
        step, fail, popped = self.next, self.fail, self.popped
        node = total = 0
        for byte in word:
            while (following := step[node].get(byte)) is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = following
        while node > 0:
            total += popped[node]
            node = fail[node]
        return total if node == 0 else 1


class Counter:
    def __init__(self, path: str):
        back = {letter: byte for byte, letter in ALPHABET.items()}
        tokens = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
        self.automaton = Automaton([bytes(back[c] for c in t) for t in tokens])
        self.known: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > KEPT:
                self.known.clear()
            found = self.known[word] = self.automaton.count(START + word)
        return found

    def count(self, text: bytes) -> tuple[int, int]:
        words = text.split()
        return len(words), sum(map(self._word, words))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per worker process and tokenizer file."""
    return Counter(path)


def _count(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.array([count(t.as_py() or b"") for t in texts], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found[:, 0]), pa.array(found[:, 1])], ["id", "n_words", "n_tokens"]
            )

    return run


def piece_counts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_words`` and ``n_tokens`` of each whole text.

    Words are runs between ASCII white space. Each is matched with a space before it, greedily with
    the longest piece, over the byte strings of the byte-level vocabulary in ``tokenizer``; pieces
    with a leading space thus only start words. A null text is an empty one, with no words and no
    pieces. One row per row, repeated and null identifiers included; an empty table gives no rows;
    other columns are ignored.
    """
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(_count(tokenizer), f"id {kind}, n_words bigint, n_tokens bigint")
    return found.withColumnRenamed("id", id)
