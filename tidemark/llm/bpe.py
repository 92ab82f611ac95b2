"""BPE encoding by forced boundaries, and decoding.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be merged
across: every merge makes a token, which would hold the pair. So a word is cut at all such pairs,
the fragments are encoded independently, and their ids are concatenated. The same holds for the
ends of words. Only the last fragment of a word carries the end-of-word mark; the others are
encoded by the same merges without it. Distinct fragments of a block are encoded once.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.tokens import WORDS_KEPT, Encoder, Pieces

# Byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(0x100) if b not in set(_PRINTABLE)]
ALPHABET = {b: chr(b) for b in _PRINTABLE} | {b: chr(0x100 + i) for i, b in enumerate(_OTHERS)}
_LETTERS = "".join(ALPHABET[b] for b in range(0x100))


def byte_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_LETTERS)


class ForcedEncoder(Encoder):
    """Encodes words fragment by fragment; texts, blocks and words are cut as in :class:`Encoder`."""

    def __init__(self, path: str):
        super().__init__(path)
        spec = json.loads(self.tokenizer.to_str())
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        alone = {"normalizer": None, "added_tokens": [], "pre_tokenizer": None, "decoder": None}
        self.last = Tokenizer.from_str(json.dumps(spec | alone))
        model = spec["model"] | {"end_of_word_suffix": None}
        self.inner = Tokenizer.from_str(json.dumps(spec | alone | {"model": model}))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(names)})") if names else None
        inside = set()
        for token in spec["model"]["vocab"]:
            token = token.removesuffix(self.suffix) if self.suffix else token
            inside.update(zip(token, token[1:]))
        self.inside = frozenset(a + b for a, b in inside)
        self.known: dict[tuple[str, bool], bytes] = {}

    def fragments(self, word: str) -> list[str]:
        """``word``, in byte letters, cut at the pairs that no token holds."""
        inside = self.inside
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in inside]
        if not cuts:
            return [word]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def _fragment(self, text: str, last: bool) -> bytes:
        found = self.known.get((text, last))
        if found is None:
            if len(self.known) > WORDS_KEPT:
                self.known.clear()
            ids = (self.last if last else self.inner).encode(text, add_special_tokens=False).ids
            found = self.known[text, last] = np.array(ids, self.dtype).tobytes()
        return found

    def word(self, word: str) -> bytes:
        *inner, last = self.fragments(word)
        if not inner:
            return self._fragment(last, True)
        return b"".join([*(self._fragment(f, False) for f in inner), self._fragment(last, True)])

    def _learn(self, words: list[str]) -> None:
        for word in words:
            self.words[word] = self.word(byte_letters(word.encode()))

    def whole(self, texts: list[str]) -> Pieces:
        """Texts that the library has to normalise and split; special tokens are taken out first."""
        found = [self._whole(t) for t in texts]
        sizes = [len(f) // self.dtype.itemsize for f in found]
        return Pieces.of(np.frombuffer(b"".join(found), self.dtype), sizes)

    def _whole(self, text: str) -> bytes:
        out = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.added:
                out.append(np.array([self.added[part]], self.dtype).tobytes())
            elif part:
                if self.tokenizer.normalizer is not None:
                    part = self.tokenizer.normalizer.normalize_str(part)
                out += [self.word(w) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part) if w]
        return b"".join(out)


class Decoder:
    """Decodes as the library does for a tokenizer without a decoder: tokens joined by a space."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        if tokenizer.decoder is not None:
            raise ValueError("only tokenizers without a decoder of their own are decoded here")
        size = max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.tokens = [tokenizer.id_to_token(i) or "" for i in range(size)]
        self.numbers = [str(i) for i in range(size)]

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))

    def decimals(self, ids: list[int]) -> str:
        return " ".join(map(self.numbers.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def forced_encoder(path: str) -> ForcedEncoder:
    """One per worker process and tokenizer file."""
    return ForcedEncoder(path)


@functools.lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _coded(tokenizer: str, rows):
    fields = _SCHEMAS[rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, dec = forced_encoder(tokenizer), decoder(tokenizer)
        for batch in batches:
            for block, found in enc.in_blocks(batch, "text"):
                out = [rows(found[i], dec) for i in range(block.num_rows)]
                columns = zip(*out) if out else [[] for _ in fields]
                arrays = [pa.array(c, t) for c, (_, t) in zip(columns, fields.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([block.column("id"), *arrays], ["id", *fields])

    return run


def _ids(ids: np.ndarray, dec: Decoder) -> tuple:
    ids = ids.tolist()
    return ids, dec.decode(ids)


def _digests(ids: np.ndarray, dec: Decoder) -> tuple:
    ids = ids.tolist()
    hashes = (hashlib.sha256(t.encode()).hexdigest() for t in (dec.decimals(ids), dec.decode(ids)))
    return len(ids), *hashes


_SCHEMAS = {
    _ids: {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string())},
    _digests: {
        "n_tokens": ("bigint", pa.int64()),
        "ids_sha256": ("string", pa.string()),
        "decoded_sha256": ("string", pa.string()),
    },
}


def _apply(docs: DataFrame, tokenizer: str, id: str, text: str, rows) -> DataFrame:
    kind = docs.schema[id].dataType.simpleString()
    schema = ", ".join([f"id {kind}", *(f"{n} {t}" for n, (t, _) in _SCHEMAS[rows].items())])
    pairs = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return pairs.mapInArrow(_coded(tokenizer, rows), schema).withColumnRenamed("id", id)


def encode(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, the ``ids`` of each whole text and the text ``decoded`` from them.

    A null text is an empty one, which has no ids. One row per row, repeated and null identifiers
    included; an empty table gives no rows; other columns are ignored.
    """
    return _apply(docs, tokenizer, id, text, _ids)


def digests(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`encode`, with the number of ids and digests instead of ids and text."""
    return _apply(docs, tokenizer, id, text, _digests)
