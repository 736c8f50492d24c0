"""Byte-level BPE by a finite-state transducer that is built while it reads.

The encoding of a prefix ends in exactly one token: the token t that ends there and forms a valid pair with
the last token of the prefix before t, where a pair is valid if its bytes encode to that pair. Only
prefixes whose following bytes begin a longer token can still matter; as soon as all of them agree on the
first token, it is sent out, so the lookahead is bounded by the longest token. States and transitions are
made when first needed and kept, so that most bytes cost one lookup.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.llm.store import freeing

#: Limits of what a worker remembers. Common pieces come early, so they are what is kept; beyond the limits
#: the same steps are taken and not remembered. After RENEWED misses a worker starts afresh.
STATES = 60_000
CHUNKS = 300_000
PAIRS = 300_000
RENEWED = 5_000_000
_BATCH_BYTES = 4 << 20


def read_ranks(path: str) -> bytes:
    """The lines of a rank file (base64 of a token, a space, its rank)."""
    with open(path, "rb") as file:
        return file.read()


class Transducer:
    def __init__(self, lines: bytes):
        pairs = (line.split() for line in lines.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.heads = {token[:k] for token in self.ranks for k in range(1, len(token))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.split()
        self.clear()

    def clear(self) -> None:
        """Forgets all states. A state has, for each prefix after which a token may still go on, the bytes
        read since, the last token of the prefix, and the ids of the prefix that are not sent out yet."""
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: dict[int, tuple[int, bytes]] = {}
        self.number(((b"", None, b""),))

    def number(self, state: tuple) -> int:
        at = self.numbers.get(state)
        if at is None:
            at = self.numbers[state] = len(self.states)
            self.states.append(state)
        return at

    def split(self) -> None:
        """halves: what each token was merged from; unions: the token of each such pair."""
        self.halves: dict[int, tuple[int, int]] = {}
        self.unions: dict[tuple[int, int], int] = {}
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut], rank), self.ranks.get(token[cut:], rank)
                if left < rank and right < rank and self.apart(left, right, rank):
                    self.halves[rank] = (left, right)
                    self.unions[left, right] = rank
                    break

    def apart(self, left: int, right: int, below: int) -> bool:
        """Whether two neighbours stay apart under all merges ranked below this one.

        A merge across the border can only join a token on the right edge of left's merge tree to one on
        the left edge of right's, while both stand there: after each was made, before either was used up.
        So the two edges are walked from the roots down, taking apart what was made last each time.
        """
        until = below
        while True:
            across = self.unions.get((left, right))
            if across is not None and across < until:
                return False
            made_left = left if left in self.halves else -1
            made_right = right if right in self.halves else -1
            if made_left < 0 and made_right < 0:
                return True
            # of equal ranks the merge further left came first
            if made_left > made_right:
                until, left = left, self.halves[left][1]
            else:
                until, right = right + 1, self.halves[right][0]

    def valid(self, first: int | None, second: int) -> bool:
        if first is None:
            return second in self.halves or len(self.tokens[second]) == 1
        known = self.pairs.get((first, second))
        if known is None:
            known = self.apart(first, second, 1 << 40)
            if len(self.pairs) < PAIRS:
                self.pairs[first, second] = known
        return known

    def move(self, at: int, byte: int) -> tuple[int, bytes]:
        after, new, token = bytes((byte,)), [], None
        for read, before, ids in self.states[at]:
            read += after
            if token is None:
                token = self.ranks.get(read)
                if token is not None:
                    if self.valid(before, token):
                        whole = ids + token.to_bytes(4, "little")
                    else:
                        token = None
            if read in self.heads:
                new.append((read, before, ids))
        if token is None:
            raise ValueError("a byte has no token of its own")
        new.append((b"", token, whole))
        sent = b""
        while first := new[0][2][:4]:
            if any(ids[:4] != first for _, _, ids in new):
                break
            sent += first
            new = [(read, before, ids[4:]) for read, before, ids in new]
        done = self.moves[at << 8 | byte] = (self.number(tuple(new)), sent)
        return done

    def finished(self, at: int, rest: bytes) -> bytes:
        """What is still to be sent after the rest of a piece, without making states."""
        ranks, heads, valid = self.ranks, self.heads, self.valid
        live = self.states[at]
        for byte in rest:
            after, new, token = bytes((byte,)), [], None
            for read, before, ids in live:
                read += after
                if token is None:
                    token = ranks.get(read)
                    if token is not None:
                        if valid(before, token):
                            whole = ids + token.to_bytes(4, "little")
                        else:
                            token = None
                if read in heads:
                    new.append((read, before, ids))
            if token is None:
                raise ValueError("a byte has no token of its own")
            new.append((b"", token, whole))
            live = new
        return live[-1][2]

    def encode(self, piece: bytes) -> bytes:
        """Ids of one match of the pattern, as little-endian unsigned 32-bit integers."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return whole.to_bytes(4, "little")
        at, out, moves = 0, [], self.moves
        for k, byte in enumerate(piece):
            step = moves.get(at << 8 | byte)
            if step is None:
                if len(self.states) >= STATES:
                    out.append(self.finished(at, piece[k:]))
                    return b"".join(out)
                step = self.move(at, byte)
            at, sent = step
            if sent:
                out.append(sent)
        out.append(self.states[at][-1][2])
        return b"".join(out)


class Encoder:
    """Texts to ids. Between two other characters a single space begins a match of the usual patterns, so
    what stands between such spaces is encoded once and remembered; any other text is matched as a whole."""

    def __init__(self, lines: bytes, pattern: str):
        self.transducer = Transducer(lines)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.missed = 0

    def matched(self, text: str) -> bytes:
        encode = self.transducer.encode
        return b"".join([encode(m.encode()) for m in self.find(text)])

    def chunk(self, chunk: str) -> bytes:
        self.missed += 1
        if self.missed > RENEWED:
            self.known.clear()
            self.transducer.clear()
            self.missed = 0
        out = self.matched(" " + chunk)
        if len(self.known) < CHUNKS:
            self.known[chunk] = out
        return out

    def encode(self, text: str) -> bytes:
        first, *chunks = text.split(" ")
        known = self.known
        if first and not first[-1].isspace():
            found = [known.get(c) for c in chunks]
            if None not in found:
                return self.matched(first) + b"".join(found)
            if all(c and not c[0].isspace() and not c[-1].isspace() for c in chunks):
                return self.matched(first) + b"".join([f if f is not None else self.chunk(c) for f, c in zip(found, chunks)])
        return self.matched(text)


class Utf8Stream:
    """Text of bytes that come in pieces: what ends inside a character waits for the next piece."""

    #: bytes still missing after a lead byte
    MISSING = [0] * 0xC2 + [1] * 0x1E + [2] * 0x10 + [3] * 5 + [0] * 11

    def __init__(self) -> None:
        self.waiting = b""

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                cut -= back if self.MISSING[byte] >= back else 0
                break
            if byte < 0x80:
                break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        out, self.waiting = self.waiting.decode("utf-8", "replace"), b""
        return out


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(lines: bytes, pattern: str) -> Encoder:
    """The encoder of this worker; a task finds what earlier tasks remembered."""
    key = (hash(lines), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(lines, pattern)
    return _ENCODERS[key]


def _batches(columns: Iterator[tuple], schema: pa.Schema, weight: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; weight: the column whose bytes count."""
    rows, held = [], 0
    for row in columns:
        rows.append(row)
        held += len(row[weight]) + 64
        if held > _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers as binary) of every whole text.

    A null text is empty and has no ids. Each row is encoded by itself, in any order and number of copies;
    the ranks are the file of a vocabulary (under 1 MB), which every task receives.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        rows = ((d.as_py(), encoder.encode(t.as_py() or "")) for b in batches for d, t in zip(b.column(0), b.column(1)))
        return _batches(rows, schema, 1)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(freeing(run), "doc_id long, ids binary")


def _decoder(lines: bytes) -> Callable[[bytes], str]:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    pairs = (line.split() for line in lines.splitlines() if line)
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}.__getitem__

    def text(ids: bytes) -> str:
        stream, out = Utf8Stream(), []
        for at in range(0, len(ids), 1 << 16):
            out.append(stream.feed(b"".join(map(tokens, memoryview(ids[at : at + (1 << 16)]).cast("I")))))
        return "".join([*out, stream.end()])

    return text


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """encoded (doc_id, ids) with text, the decoded ids. Bytes that are no UTF-8 become U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = _decoder(shared.value)
        rows = ((d.as_py(), i := ids.as_py() or b"", text(i)) for b in batches for d, ids in zip(b.column(0), b.column(1)))
        return _batches(rows, schema, 1)

    return encoded.select("doc_id", "ids").mapInArrow(freeing(run), "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """decode(encode(docs)) with one Python worker a task: of two in a row each would come to hold an encoder."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, text = _encoder(shared.value, pattern), _decoder(shared.value)
        rows = ((d.as_py(), i := encoder.encode(t.as_py() or ""), text(i)) for b in batches for d, t in zip(b.column(0), b.column(1)))
        return _batches(rows, schema, 1)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(freeing(run), "doc_id long, ids binary, text string")
