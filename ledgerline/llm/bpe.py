"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Encoding. For every prefix of a piece the merge rules give one encoding, and a sequence of tokens is
an encoding exactly if each adjacent pair is (two tokens are *compatible* when merging their joined
bytes gives these two again). So the transducer's non-deterministic states are the open positions
of a piece: where a position still starts a proper prefix of a token, as a node of the tokens' trie,
with the last token before it. The deterministic state is the set of open positions; it is made when
first reached and kept. Each move tells which token the encoding of the prefix so far ends with. The
tokens that all open positions share can no longer change: they are emitted, at the end of short
pieces and once a block in long ones, so the lookahead is bounded by the longest token.

Decoding maps ids to bytes and feeds them, block by block, to an incremental UTF-8 state machine.

Rules and states that were made are kept per Python worker, whatever task they were made in.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import in_arrow, kept_by_worker

#: Pieces (in two generations) and states that one Python worker keeps; beyond, it starts anew. They bound memory only.
PIECES_KEPT, STATES_KEPT = 80_000, 200_000
#: Rows of an outgoing Arrow batch, ids that a decoder takes at once, bytes after which a long piece emits its sure tokens.
ROWS_OUT, IDS_AT_ONCE, BLOCK = 256, 1 << 16, 1 << 12
#: Rank of a pair that never merges; the last token at the start of a piece.
NEVER, START = 1 << 40, -1


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Encodes pieces to ids by the ranks.

    A state is a dict: under -1 its open positions (node, last token, node, last token, ..., oldest
    first), under a byte the move (next state, token that the prefix ends with).
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {r: t for t, r in ranks.items()}
        self.lengths = {r: len(t) for r, t in self.tokens.items()}
        self.kids: dict[int, int] = {}
        self.depth, self.ends, self.inner = [0], [-1], set()
        for token, rank in ranks.items():
            at = 0
            for b in token:
                below = self.kids.get(at << 8 | b)
                if below is None:
                    below = self.kids[at << 8 | b] = len(self.ends)
                    self.depth.append(self.depth[at] + 1)
                    self.ends.append(-1)
                    self.inner.add(at)
                at = below
            self.ends[at] = rank
        self.pairs: dict[int, bool] = {}
        self.known: dict[int, tuple[list, list] | None] = {}
        self._reset()

    def _reset(self) -> None:
        opened = (0, START)
        self.first: dict = {-1: opened}
        self.states: dict[tuple[int, ...], dict] = {opened: self.first}

    def _edges(self, token: bytes) -> tuple[list, list] | None:
        """How the token's last and first part grow while it is merged: pairs of the part and the rank at
        which it is merged on, smallest part first. None if merging does not lead to the token.

        The merge rules as such: the adjacent pair of least rank first, leftmost among equals.
        """
        parts = [token[i : i + 1] for i in range(len(token))]
        right, left, got = [], [], self.ranks.get
        while len(parts) > 1:
            ranks = [got(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            rank = min(ranks)
            if rank == NEVER:
                return None
            at = ranks.index(rank)
            if at == 0:
                left.append((parts[0], rank))
            if at == len(parts) - 2:
                right.append((parts[-1], rank))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [*right, (token, NEVER)], [*left, (token, NEVER)]

    def edges(self, token: int) -> tuple[list, list] | None:
        if token not in self.known:
            self.known[token] = self._edges(self.tokens[token])
        return self.known[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging gives ``right`` at all and no merge crosses the border of the two tokens.

        Ranks of successive merges rise, so both sides' parts at the border grow in the order of their
        ranks; the border falls when the pair of these parts has its turn first.
        """
        found = True if left == START and self.edges(right) else None if self.edges(right) else False
        if found is None:
            a, b, i, j = self.edges(left)[0], self.edges(right)[1], 0, 0
            while found is None:
                (x, mine), (y, other) = a[i], b[j]
                cross = self.ranks.get(x + y, NEVER)
                if cross < mine and cross <= other and cross != NEVER:
                    found = False
                elif mine == other == NEVER:
                    found = True
                elif mine <= other:
                    i += 1
                else:
                    j += 1
        if len(self.pairs) > STATES_KEPT:
            self.pairs.clear()
        self.pairs[left << 32 | right] = found
        return found

    def _move(self, state: dict, byte: int) -> tuple[dict, int]:
        kids, ends, inner, pairs = self.kids, self.ends, self.inner, self.pairs
        opened, live, here = state[-1], [], -1
        for i in range(0, len(opened), 2):
            node = kids.get(opened[i] << 8 | byte)
            if node is None:
                continue
            last = opened[i + 1]
            if here < 0 and ends[node] >= 0:
                fits = pairs.get(last << 32 | ends[node])
                if fits is None:
                    fits = self.compatible(last, ends[node])
                if fits:
                    here = ends[node]
            if node in inner:
                live.append(node)
                live.append(last)
        if here < 0:
            raise ValueError(f"no token ends with byte {byte}: the ranks lack single bytes")
        live.append(0)
        live.append(here)
        target = tuple(live)
        found = self.states.get(target)
        if found is None:
            found = self.states[target] = {-1: target}
        move = state[byte] = (found, here)
        return move

    def _back(self, ends: list[int], at: int, stop: int) -> list[int]:
        """Tokens between two positions, by the token that ends at each."""
        out, lengths = [], self.lengths
        while at > stop:
            out.append(ends[at - 1])
            at -= lengths[ends[at - 1]]
        out.reverse()
        return out

    def _sure(self, ends: list[int], state: dict) -> int:
        """The last position that the encodings of all open positions pass through."""
        at = {len(ends) - self.depth[node] for node in state[-1][::2]}
        while len(at) > 1:
            last = max(at)
            at.remove(last)
            at.add(last - self.lengths[ends[last - 1]] if last > 0 else 0)
        return at.pop()

    def encode(self, piece: bytes) -> bytes:
        """Ids of a piece, each as a little-endian unsigned 32-bit integer."""
        if len(self.states) > STATES_KEPT:
            self._reset()
        state, out, ends = self.first, array("I"), []
        for begin in range(0, len(piece), BLOCK):
            for byte in piece[begin : begin + BLOCK]:
                try:
                    state, token = state[byte]
                except KeyError:
                    state, token = self._move(state, byte)
                ends.append(token)
            if begin + BLOCK < len(piece):
                sure = max(0, self._sure(ends, state))
                out.extend(self._back(ends, sure, 0))
                del ends[:sure]
        if piece:
            out.extend(self._back(ends, len(ends), 0))
        return out.tobytes()


class Kept(dict):
    """Ids by text, computed by ``make`` when missing. When full, it goes on with what is used again."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            found = self.make(part)
        if len(part) <= 64:
            if len(self) >= PIECES_KEPT:
                self.older = dict(self)
                self.clear()
            self[part] = found
        return found


class Encoder:
    """Ids of texts, cut into pieces by the pattern."""

    def __init__(self, transducer: Transducer, pattern: str):
        self.cut, self.tokens = regex.compile(pattern), transducer.tokens
        self.pieces = Kept(lambda piece: transducer.encode(piece.encode()))

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut.findall(text)))


def _encoder(path: str, pattern: str) -> Encoder:
    return kept_by_worker(("bpe", path, pattern), lambda: Encoder(Transducer(read_ranks(path)), pattern))


class Utf8Stream:
    """Incremental UTF-8 state machine: text out of bytes that may be cut anywhere.

    The state is the number of continuation bytes still due and the range of the next one. Malformed
    input gives U+FFFD for each maximal part, as Python's decoder does.
    """

    def __init__(self):
        self.held = b""

    @staticmethod
    def step(state: tuple[int, int, int], byte: int) -> tuple[int, int, int] | None:
        """The next state, (0, 0, 0) after a whole character, None for a malformed one."""
        due, low, high = state
        if due:
            return ((due - 1, 0x80, 0xBF) if due > 1 else (0, 0, 0)) if low <= byte <= high else None
        if byte < 0x80:
            return (0, 0, 0)
        if 0xC2 <= byte <= 0xDF:
            return (1, 0x80, 0xBF)
        if 0xE0 <= byte <= 0xEF:
            return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
        if 0xF0 <= byte <= 0xF4:
            return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
        return None

    def feed(self, data: bytes) -> str:
        """Text of all characters that are whole by now; only the last bytes run through the states."""
        data = self.held + data
        cut = len(data)
        for start in range(max(0, len(data) - 3), len(data)):
            if data[start] >= 0xC0:
                state: tuple[int, int, int] | None = (0, 0, 0)
                for b in data[start:]:
                    state = self.step(state, b) if state else None
                cut = start if state and state[0] else len(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        left, self.held = self.held, b""
        return left.decode("utf-8", "replace")


@contextmanager
def _uncollected() -> Iterator[None]:
    """States hold no cycles, so the search for cycles among them only takes time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _encoded(encoder: Encoder, texts: pa.Array) -> list[bytes]:
    with _uncollected():
        return [encoder.ids(t) if t else b"" for t in texts.to_pylist()]


def _decoded(tokens: dict[int, bytes], encoded: list[bytes | None]) -> list[str]:
    texts = []
    for packed in encoded:
        ids, stream, chars = array("I", packed or b""), Utf8Stream(), []
        for k in range(0, len(ids), IDS_AT_ONCE):
            chars.append(stream.feed(b"".join(map(tokens.__getitem__, ids[k : k + IDS_AT_ONCE]))))
        chars.append(stream.finish())
        texts.append("".join(chars))
    return texts


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ids (binary, little-endian unsigned 32-bit).

    Null and empty texts have no ids; repeated rows and ids are encoded each; texts of any length are
    encoded whole; other columns, whatever their names, are not read. ``ranks_path`` is read by every
    executor. ``pattern`` cuts a text into pieces that are encoded apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_encoded(encoder, part.column(1)), pa.binary())], ["__id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return in_arrow(_id_and_text(docs, id_col, text_col), run, f"__id {kind}, ids binary", keeps=True).withColumnRenamed("__id", id_col)


def _id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))


def decode_documents(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` (id, ids) with text: the characters that the ids' bytes stand for.

    No ids, or null, give an empty text; bytes that are no UTF-8 give U+FFFD; an id without a token is
    an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = kept_by_worker(("tokens", ranks_path), lambda: {r: t for t, r in read_ranks(ranks_path).items()})
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_decoded(tokens, part.column(1).to_pylist()), pa.string())], ["__id", "ids", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return in_arrow(encoded.select(F.col(id_col).alias("__id"), "ids"), run, f"__id {kind}, ids binary, text string", keeps=True).withColumnRenamed("__id", id_col)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids and text as ``decode_documents`` of ``encode_documents`` gives them, in one pass: in Spark each of
    these would hold a Python worker of its own, with the rules in both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = _encoded(encoder, part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(_decoded(encoder.tokens, ids), pa.string())], ["__id", "ids", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    return in_arrow(_id_and_text(docs, id_col, text_col), run, f"__id {kind}, ids binary, text string", keeps=True).withColumnRenamed("__id", id_col)


def token_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of encoding every row and decoding it by the state machine.

    Null and empty texts have no tokens and the digests of no bytes; equal rows give equal rows.
    """
    back = round_trip(docs, ranks_path, pattern, id_col, text_col)
    return back.select(id_col, F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"))
