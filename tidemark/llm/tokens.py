"""Fast whole-text encoding with the tokenizers library.

For a tokenizer that drops white space, the ids of a text are the ids of its runs between ASCII
white space, one after the other: neither the normalizer, the splitting pattern, a special token
nor a merge reaches across such a character. So a block of texts is cut into runs, distinct runs
into words, and only distinct words are encoded; array operations put the ids back in order.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

WORDS_KEPT = 300_000
AT_ONCE = 50
BLOCK_BYTES = 4 << 20
# Outside these characters the library itself has to normalise: below U+0250 every character is
# its own NFC and letters are the same in each version of Unicode, but U+0085 and U+00A0 are white
# space, U+0130 becomes two characters in lower case, and "<" may start a special token.
ODD = r"[^\x00-\x7F\x{A1}-\x{12F}\x{131}-\x{24F}]|<"

# Other runs are letters and symbols in turn, unless they have an apostrophe or a digit.
HARD = r"['\p{N}]"


@dataclass
class Pieces:
    """Ids of items, one after the other; item i has ``ids[starts[i] : starts[i] + sizes[i]]``."""

    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, sizes: np.ndarray) -> Pieces:
        sizes = np.asarray(sizes, dtype=np.int64)
        return cls(ids, np.cumsum(sizes) - sizes, sizes)

    def take(self, items: np.ndarray) -> Pieces:
        sizes = self.sizes[items]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[items] - ends + sizes, sizes)
        return Pieces(self.ids[np.arange(len(shift)) + shift], ends - sizes, sizes)

    def joined(self, bounds: np.ndarray) -> Pieces:
        """Neighbours ``bounds[i]`` to ``bounds[i + 1]`` as one item each; ids lie without gaps."""
        ends = np.concatenate([[0], np.cumsum(self.sizes)])[bounds]
        return Pieces(self.ids, ends[:-1], np.diff(ends))

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[self.starts[i] : self.starts[i] + self.sizes[i]]


class Encoder:
    """Encodes blocks of texts exactly as the library does without special tokens added."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        spec = json.loads(self.tokenizer.to_str())
        self.pattern = splitting_pattern(spec)
        if self.pattern is not None:
            self.words: dict[str, bytes] = {}
            self.bare = bare_tokenizer(spec)
            suffix = spec["model"]["end_of_word_suffix"]
            self.ends = np.zeros(size, dtype=bool)
            for token, number in self.tokenizer.get_vocab().items():
                self.ends[number] = token.endswith(suffix)

    def whole(self, texts: list[str]) -> Pieces:
        """By the library, text by text."""
        found = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        ids = np.array([i for f in found for i in f], dtype=self.dtype)
        return Pieces.of(ids, [len(f) for f in found])

    def _learn(self, words: list[str]) -> None:
        """Each word ends with the only one of its tokens that has the end-of-word mark."""
        texts = [" ".join(words[i : i + AT_ONCE]) for i in range(0, len(words), AT_ONCE)]
        found = self.bare.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array([i for e in found for i in e.ids], dtype=self.dtype)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            raise ValueError("the tokenizer does not mark the ends of words as expected")
        data, start = ids.tobytes(), 0
        for word, cut in zip(words, (cuts * ids.itemsize).tolist()):
            self.words[word] = data[start:cut]
            start = cut

    def _words(self, words: list[str]) -> Pieces:
        """``words`` are distinct; the empty one has no ids."""
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        self.words[""] = b""
        self._learn([w for w in words if w not in self.words])
        ids = [self.words[w] for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        return Pieces.of(np.frombuffer(b"".join(ids), self.dtype), sizes)

    def _runs(self, runs: pa.Array) -> Pieces:
        odd = pc.match_substring_regex(runs, ODD)
        plain = pc.utf8_lower(runs.filter(pc.invert(odd)))
        hard = pc.match_substring_regex(plain, HARD)
        spaced = pc.replace_with_mask(
            pc.replace_substring_regex(plain, r"([^\p{L}]+)", r" \1 "),
            hard,
            pc.replace_substring_regex(plain.filter(hard), self.pattern, r"\1 "),
        )
        bounds, words, codes = distinct_parts(pc.ascii_split_whitespace(spaced))
        found = self._words(words.to_pylist()).take(codes).joined(bounds)
        rest = self.whole(runs.filter(odd).to_pylist())
        odd = odd.to_numpy(zero_copy_only=False)
        starts, sizes = np.empty(len(runs), np.int64), np.empty(len(runs), np.int64)
        starts[~odd], sizes[~odd] = found.starts, found.sizes
        starts[odd], sizes[odd] = rest.starts + len(found.ids), rest.sizes
        return Pieces(np.concatenate([found.ids, rest.ids]), starts, sizes)

    def encode(self, texts: pa.Array) -> Pieces:
        """The ids of each whole text."""
        if self.pattern is None:
            return self.whole(texts.to_pylist())
        bounds, runs, codes = distinct_parts(pc.ascii_split_whitespace(texts))
        return self._runs(runs).take(codes).joined(bounds)

    def in_blocks(self, batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, Pieces]]:
        """A batch in blocks of a bounded number of bytes (or one row), each with its ids."""
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, np.cumsum(sizes, dtype=np.int64)
        while start < len(total):
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + BLOCK_BYTES, "right")))
            block = batch.slice(start, end - start)
            yield block, self.encode(pc.fill_null(block.column(text), ""))
            # What a block needed goes back to the system, as executors share their memory with tasks.
            pa.default_memory_pool().release_unused()
            start = end


def distinct_parts(lists: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Bounds of the lists in their values, the distinct values, and each value's number."""
    encoded = pc.list_flatten(lists).dictionary_encode()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    return bounds - bounds[0], encoded.dictionary, encoded.indices.to_numpy()


def bare_tokenizer(spec: dict) -> Tokenizer:
    """The merges alone, for words that are lower-cased and split already."""
    level = spec["pre_tokenizer"]["pretokenizers"][1]
    parts = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, level]}
    return Tokenizer.from_str(
        json.dumps(spec | {"normalizer": None, "added_tokens": [], "pre_tokenizer": parts})
    )


def splitting_pattern(spec: dict) -> str | None:
    """The pattern whose matches are encoded apart, if the tokenizer lower-cases NFC text, turns
    white space into spaces, drops all that does not match and marks the ends of words."""
    normalizer, splitter = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    steps = [(s["type"], s.get("pattern"), s.get("content")) for s in normalizer.get("normalizers", [])]
    parts = splitter.get("pretokenizers", [])
    wanted = [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
    if steps != wanted or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
        return None
    split, level = parts
    if (split["behavior"], split["invert"]) != ("Removed", True):
        return None
    if level["add_prefix_space"] or level["use_regex"] or r"[^\s" not in split["pattern"]["Regex"]:
        return None
    if spec["model"]["type"] != "BPE" or not spec["model"]["end_of_word_suffix"]:
        return None
    for token in spec["added_tokens"]:
        if token["normalized"] or token["single_word"] or token["lstrip"] or token["rstrip"]:
            return None
        if "<" not in token["content"] or any(c.isspace() for c in token["content"]):
            return None
    return f"({split['pattern']['Regex']})"


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and tokenizer file."""
    return Encoder(path)
