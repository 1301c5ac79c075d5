"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A sequence of tokens is the BPE result of its bytes exactly when each two
neighbours are: merging the bytes of both gives these two again.  So a
non-deterministic transducer reads bytes down a trie of tokens and may start a
new token wherever the finished one fits the one before.  All its runs over
the bytes read so far are carried at once as one state; what all runs agree on
is emitted, which needs no more lookahead than one token is long.  States and
steps are made when first met and kept up to a bound, also within one piece.
With the memo a worker held up to 370 MB of them over 132,000 documents.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from saltmarsh.llm.common import slices, texts, worker_cache

STEPS = 650_000  # each with its share of the states takes about 250 bytes
FITS = 300_000
MEMO_BYTES = 48 << 20  # of one generation
SLOT_BYTES = 80  # of a dictionary, for one entry
LONG_PART = 200


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.child: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]  # token that ends at a trie node
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.child[node].setdefault(byte, len(self.child))
                if node == len(self.ends):
                    self.child.append({})
                    self.ends.append(-1)
            self.ends[node] = rank
        self.fit: dict[int, bool] = {}  # by tokens, the one before in the upper bits
        self.merges: dict[int, tuple[list[int], list[bytes], list[bytes]] | None] = {}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}  # by 256 * state + byte
        self._restart()

    def _restart(self) -> None:
        """States: their runs by trie node, each as node, number of tokens held back, these, and the last token."""
        self.states = [struct.pack("3i", 0, 0, -1)]
        self.number = {self.states[0]: 0}
        self.steps.clear()

    def _merges(self, token: bytes) -> tuple[list[int], list[bytes], list[bytes]] | None:
        """Ranks of the merges that make a token of its bytes, and its first and last part before each and after all; None if others come first.

        The neighbours of least rank are joined first, from the left.
        """
        rank = self.ranks.get
        none = 1 << 60
        parts = [token[i:i + 1] for i in range(len(token))]
        ranked = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        made, first, last = [], [parts[0]], [parts[-1]]
        while ranked:
            least = min(ranked)
            if least == none:
                return None
            i = ranked.index(least)
            parts[i] += parts.pop(i + 1)
            del ranked[i]
            if i:
                ranked[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(ranked):
                ranked[i] = rank(parts[i] + parts[i + 1], none)
            made.append(least)
            first.append(parts[0])
            last.append(parts[-1])
        made.append(none)
        return made, first, last

    def _fits(self, before: int, after: int) -> bool:
        """Whether ``after`` may follow ``before``; -1 stands for the start of a piece.

        The merges within both tokens are replayed in their common order; the
        parts at the border must not be joined in between or at the end.
        """
        pair = before << 32 | after
        known = self.fit.get(pair)
        if known is None:
            for token in (before, after):
                if token not in self.merges:
                    self.merges[token] = self._merges(self.token[token]) if token >= 0 else ([1 << 60], [b""], [b""])
            left, right = self.merges[before], self.merges[after]
            known = left is not None and right is not None
            if known and before >= 0:
                (a_ranks, _, a_last), (b_ranks, b_first, _) = left, right
                i = j = 0
                while True:
                    a, b = a_ranks[i], b_ranks[j]
                    across = self.ranks.get(a_last[i] + b_first[j])
                    if across is not None and across < a and across <= b:
                        known = False
                        break
                    if a <= b:
                        i += 1
                        if i == len(a_ranks):  # both are whole
                            break
                    else:
                        j += 1
            if len(self.fit) >= FITS:
                self.fit.clear()
            self.fit[pair] = known
        return known

    def _runs(self, state: int) -> tuple[int, ...]:
        raw = self.states[state]
        return struct.unpack(f"{len(raw) // 4}i", raw)

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after one more byte, and the tokens that are certain now."""
        here = self._runs(state)
        if len(self.steps) >= STEPS:  # only the state that the piece is in goes on; its step is made again when next met
            self._restart()
            state = -1
        child, runs, final, at, end = self.child, [], None, 0, len(here)
        while at < end:
            until = at + 2 + here[at + 1]
            below = child[here[at]].get(byte)
            if below is not None:
                token = self.ends[below]
                if token >= 0 and final is None and self._fits(here[until], token):
                    final = (*here[at + 2:until], token)
                    runs.append((0, final, token))
                if child[below]:
                    runs.append((below, here[at + 2:until], here[until]))
            at = until + 1
        if len(runs) == 1:
            (node, sure, last), = runs
            made = struct.pack("3i", node, 0, last)
        else:
            held = [run[1] for run in runs]
            sure, most, shared = min(held), max(held), 0
            for token, other in zip(sure, most):
                if token != other:
                    break
                shared += 1
            sure = sure[:shared]
            flat: list[int] = []
            for node, held, last in sorted(runs):
                held = held[shared:]
                flat += (node, len(held), *held, last)
            made = struct.pack(f"{len(flat)}i", *flat)
        target = self.number.get(made)
        if target is None:
            target = self.number[made] = len(self.states)
            self.states.append(made)
        found = (target, sure)
        if state >= 0:
            self.steps[256 * state + byte] = found
        return found

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece; a piece that is a token itself is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, steps = 0, self.steps
        for byte in piece:
            state, sure = steps.get(256 * state + byte) or self._step(state, byte)
            if sure:
                out += sure
        runs = self._runs(state)
        if runs[0] == 0:  # the run that has just ended a token
            out += runs[2:2 + runs[1]]
        return out


class Memo:
    """Ids of strings or of their bytes, bounded in bytes: a full young generation becomes the old one, whose entries come back when met again."""

    def __init__(self) -> None:
        self.young: dict[str | bytes, bytes] = {}
        self.old: dict[str | bytes, bytes] = {}
        self.held = 0

    def get(self, key: str | bytes) -> bytes | None:
        raw = self.young.get(key)
        if raw is None:
            raw = self.old.get(key)
            if raw is not None:
                self.keep(key, raw)
        return raw

    def keep(self, key: str | bytes, raw: bytes) -> None:
        if len(key) >= LONG_PART:
            return
        size = getsizeof(key) + getsizeof(raw) + SLOT_BYTES
        if self.held + size > MEMO_BYTES:
            self.young, self.old, self.held = {}, self.young, 0
        self.young[key] = raw
        self.held += size


class TextEncoder:
    """Ids of whole texts: cut by the pattern, each piece encoded by the transducer.

    Between two single spaces a text is cut alike wherever it stands, so these
    parts, without the space before them, are looked up in a bounded memo first.
    It serves pieces that begin with a space as well; other pieces have their bytes for a key.
    """

    def __init__(self, ranks_path: str, pattern: str) -> None:
        self.transducer = Transducer(load_ranks(ranks_path))
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.memo = Memo()

    def _encoded(self, piece: str) -> bytes:
        ids = self.transducer.encode(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _tokens(self, pieces: list[str]) -> bytes:
        out = []
        for piece in pieces:
            key = piece[1:] if piece[0] == " " else piece.encode()
            raw = self.memo.get(key)
            if raw is None:
                raw = self._encoded(piece)
                self.memo.keep(key, raw)
            out.append(raw)
        return b"".join(out)

    def _part(self, part: str) -> bytes:
        """Ids of a part and the space before it."""
        raw = self.memo.get(part)
        if raw is None:
            pieces = self.pieces(" " + part)
            raw = self._tokens(pieces) if len(pieces) > 1 else self._encoded(pieces[0])
            self.memo.keep(part, raw)
        return raw

    def encode(self, values: Iterable[str | None]) -> list[np.ndarray]:
        out = []
        for value in values:
            value = value or ""
            if not value or value[0] == " " or value[-1] == " " or "  " in value:
                out.append(np.frombuffer(self._tokens(self.pieces(value)), "<u4"))
                continue
            parts = (" " + value).split(" ")[1:]
            first = self._tokens(self.pieces(parts[0]))
            found = list(map(self.memo.young.get, parts[1:]))
            for i, raw in enumerate(found):
                if raw is None:
                    found[i] = self._part(parts[i + 1])
            out.append(np.frombuffer(first + b"".join(found), "<u4"))
        return out


def utf8_tail(raw: bytes) -> int:
    """How many bytes at the end belong to a character that is not complete.

    The states are the bytes a character still lacks; only its lead byte, at
    most three places back, sets that number.
    """
    for back in range(1, min(3, len(raw)) + 1):
        byte = raw[-back]
        if byte < 0x80:
            return 0
        if byte >= 0xC0:
            lacks = (2 if byte < 0xE0 else 3 if byte < 0xF0 else 4) - back
            return back if lacks > 0 else 0
    return 0


class StreamDecoder:
    """Ids to text, chunk by chunk: complete characters come out, a cut one waits for the next chunk."""

    def __init__(self, token: dict[int, bytes]) -> None:
        self.token, self.waiting = token, b""

    def feed(self, ids: Iterable[int]) -> bytes:
        raw = self.waiting + b"".join(map(self.token.__getitem__, ids))
        tail = utf8_tail(raw)
        self.waiting = raw[len(raw) - tail:]
        return raw[:len(raw) - tail]

    def finish(self) -> bytes:
        rest, self.waiting = self.waiting, b""
        return rest


def text_encoder(ranks_path: str, pattern: str) -> TextEncoder:
    return worker_cache(("transducer", ranks_path, pattern), lambda: TextEncoder(ranks_path, pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian 4-byte ids) of every whole text; null counts as empty.

    Equal rows give equal ids, an empty table gives no rows, and columns other
    than ``doc_id`` and ``text`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids = text_encoder(ranks_path, pattern).encode(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([x.tobytes() for x in ids], pa.binary())], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, chunk: int = 4096) -> DataFrame:
    """``doc_id`` and ``text`` of ids from ``encode``; bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = worker_cache(("tokens", ranks_path), lambda: {r: t for t, r in load_ranks(ranks_path).items()})
        for batch in batches:
            found = []
            for raw in batch.column("ids").to_pylist():
                stream = StreamDecoder(token)
                ids = np.frombuffer(raw or b"", "<u4").tolist()
                pieces = [stream.feed(ids[i:i + chunk]).decode("utf-8", "replace") for i in range(0, len(ids), chunk)]
                found.append("".join(pieces) + stream.finish().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "text"])

    return encoded.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = 4096) -> DataFrame:
    """Per document: ``doc_id``, ``n_tokens``, digest of the decimal ids, and digest of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_path, pattern)
        token = encoder.transducer.token
        decimal = worker_cache(("decimal", ranks_path), lambda: {i: str(i) for i in token})
        for part in slices(batches):
            rows = []
            for ids in encoder.encode(part.column("text").to_pylist()):
                listed = ids.tolist()
                stream, digest = StreamDecoder(token), hashlib.sha256()
                for i in range(0, len(listed), chunk):
                    digest.update(stream.feed(listed[i:i + chunk]))
                digest.update(stream.finish())
                written = ",".join(map(decimal.__getitem__, listed)).encode()
                rows.append((len(listed), hashlib.sha256(written).hexdigest(), digest.hexdigest()))
            n, ids_sum, text_sum = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sum, pa.string()), pa.array(text_sum, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
