"""Token ids of whole texts by a public tokenizer file, with each distinct word encoded once per worker."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

from saltmarsh.llm.common import slices, word_hashes, worker_cache

END_ID = 1
MEMO_WORDS = 800_000


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write bytes: printable ones as they are, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Ids of texts under a ``tokenizers`` file that drops white space and cuts at it.

    Such a tokenizer never lets a token cross white space, so the ids of a text
    are the ids of its parts between ASCII white space in a row.  The library
    encodes each distinct part once; which parts of a batch are the same is
    found by sorting 64-bit hashes.  The ids of the parts seen are kept in flat
    arrays up to ``MEMO_WORDS`` parts; then only those of the last batch stay.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs one worker per core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        split = settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in settings["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # texts are cut at the special names before; other spellings are plain text
        self.pieces = regex.compile(split).findall
        self.letters = _byte_letters()
        self.tokenize = self.library.model.tokenize
        self.small: dict[str, list[int]] = {}
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)  # of each key, where its ids start
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _piece(self, piece: str) -> list[int]:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenize(piece)]

    def _part(self, raw: bytes) -> list[int]:
        """Ids of one part.  Below U+0100 normalising is lower case alone; other parts and control characters take the whole library."""
        text = raw.decode("utf-8", "replace")
        if not text.isprintable():
            return self.library.encode(text, add_special_tokens=False).ids
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.library.encode(text, add_special_tokens=False).ids
        text = text.lower()
        if text.isalpha():
            return self._piece(text)
        if text[-1] in ",." and text[:-1].isalpha():
            return self._piece(text[:-1]) + self._piece(text[-1])
        ids: list[int] = []
        for piece in self.pieces(text):
            if len(piece) < 4:  # marks, digits and endings
                if piece not in self.small:
                    self.small[piece] = self._piece(piece)
                ids += self.small[piece]
            else:
                ids += self._piece(piece)
        if len(self.small) > 50_000:
            self.small.clear()
        return ids

    def _add(self, keys: np.ndarray, parts: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        at = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, np.fromiter((i for p in parts for i in p), np.uint32, int(sizes.sum()))])
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = (np.insert(old, place, new) for old, new in
                                         ((self.keys, keys), (self.at, at), (self.size, sizes)))

    def _forget(self, but: np.ndarray) -> None:
        """Only the keys that are in ``but`` stay."""
        stay = np.isin(self.keys, but, assume_unique=True)
        keys, at, size = self.keys[stay], self.at[stay], self.size[stay]
        ids = self.ids[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        self.keys, self.at, self.size, self.ids = keys, np.cumsum(size) - size, size, ids

    def encode(self, values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, without end ids, and their number before each text; null counts as empty.

        The name of a special token in a text is that token, as the library has
        it; the texts before and after it are encoded by themselves.
        """
        if not any(v is not None and name in v for name in self.special for v in values):
            return self._encode_plain(values)
        cuts = [self.at_special(v or "") for v in values]  # text, name, text, name, ..., text
        ids, before = self._encode_plain([text for parts in cuts for text in parts[::2]])
        out, counts, at = [], [], 0
        for parts in cuts:
            n = 0
            for k, part in enumerate(parts):
                if k % 2:
                    found = np.array([self.special[part]], np.uint32)
                else:
                    found, at = ids[before[at]:before[at + 1]], at + 1
                out.append(found)
                n += len(found)
            counts.append(n)
        return np.concatenate(out), np.concatenate([[0], np.cumsum(counts)])

    def _encode_plain(self, values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        joined, before, hashes, starts, ends = word_hashes(values, lower=None)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > MEMO_WORDS:
            self._forget(keys)
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[place] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._add(keys[new], [self._part(joined[i:j]) for i, j in spans])
            place = np.searchsorted(self.keys, keys)
        sizes = self.size[place][which]
        at = self.at[place][which]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(at - total[:-1], sizes) + np.arange(total[-1])] if len(sizes) else np.zeros(0, np.uint32)
        return ids, total[before]


def encoder(path: str) -> WordEncoder:
    return worker_cache(("words", path), lambda: WordEncoder(path))


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Per slice of the batches: document ids, and of each document the token ids with the end id."""
    for part in slices(batches):
        ids, before = encoder(path).encode(part.column("text").to_pylist())
        cuts = before.tolist()
        yield part.column("doc_id").to_pylist(), [np.append(ids[i:j], np.uint32(END_ID)) for i, j in zip(cuts, cuts[1:])]


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
