"""Operator 3, byte-level BPE as a lazily determinised transducer.

The merges define, for every byte prefix, one last token: the token that ends
there and forms a valid pair with the last token of the prefix it extends.  A
state of the transducer therefore holds, for every start position that some
token may still extend, the trie node reached, the last token before it and
the tokens not yet emitted.  Tokens common to all positions are emitted at
once, so look-ahead is bounded by the longest token.  States and transitions
are made when first met and kept in bounded tables (cleared when full, which
changes nothing but the time).

Decoding is a stream: ids give bytes, and an incremental UTF-8 state machine
holds back an incomplete last character until its other bytes arrive.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcorpus.llm.store import in_batches

# White space of the pattern below, as Unicode lists it (fixed values).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
MEMO, TABLE = 400_000, 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id from a rank file: ``base64 id`` per line.  A
    vocabulary is of fixed size and travels with the tasks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """BPE of one pre-token by bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.vocab = dict.fromkeys(range(max(ranks.values(), default=-1) + 1), b"")
        self.vocab.update((i, t) for t, i in ranks.items())
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner: list[bool] = [False]
        for t, i in ranks.items():
            node = 0
            for b in t:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = nxt
            self.token[node] = i
        self.valid: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, bool], tuple] = {}
        self._clear()

    def _clear(self) -> None:
        first = ((0, -1, ()),)
        self.start = {-1: first}
        self.states = {first: self.start}
        gc.collect()  # states point at each other

    def merge(self, data: bytes, least: int = 1) -> list[int]:
        """The merges applied one by one, lowest rank first, until ``least``
        parts are left (short inputs)."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > least:
            found = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
            lowest = min(found)
            if lowest == 1 << 60:
                break
            best = found.index(lowest)
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[p] for p in parts]

    def _spine(self, token: int, right: bool) -> tuple[int, ...]:
        """The tokens at one edge of a token while it grows, smallest first."""
        kept = self.spines.get((token, right))
        if kept is None:
            data = self.vocab[token]
            if len(data) == 1:
                kept = (token,)
            else:
                last = self.merge(data, 2)[1 if right else 0]
                kept = (*self._spine(last, right), token)
            self.spines[token, right] = kept
        return kept

    def follows(self, a: int, b: int) -> bool:
        """Whether ``b`` directly after ``a`` is left as it is by the merges.

        Both tokens grow in order of rank; the pair fails if the two edges could
        merge with each other before either has grown on."""
        if a < 0:
            return True
        got = self.valid.get((a, b))
        if got is None:
            if len(self.valid) >= TABLE:
                self.valid.clear()
            left, right, vocab, rank = self._spine(a, True), self._spine(b, False), self.vocab, self.ranks.get
            i = j = 0
            got, never = True, 1 << 60
            while True:
                grow_a = left[i + 1] if i + 1 < len(left) else never
                grow_b = right[j + 1] if j + 1 < len(right) else never
                across = rank(vocab[left[i]] + vocab[right[j]], never)
                if across < grow_a and across <= grow_b:
                    got = False
                    break
                if grow_a == grow_b == never:
                    break
                if grow_a <= grow_b:
                    i += 1
                else:
                    j += 1
            self.valid[a, b] = got
        return got

    def _step(self, state: dict, byte: int) -> tuple[dict, tuple]:
        """The next state and the tokens emitted; a state is a table from bytes
        to both, with what it stands for under -1."""
        child, token, inner, follows = self.child.get, self.token, self.inner, self.follows
        live, found, ours = [], False, ()
        for node, last, pending in state[-1]:
            nxt = child(node << 8 | byte)
            if nxt is None:
                continue
            if not found:
                t = token[nxt]
                if t >= 0 and follows(last, t):
                    found, ours, ending = True, (*pending, t), t
            if inner[nxt]:
                live.append((nxt, last, pending))
        common = len(ours)
        for _, _, other in live:
            same, limit = 0, min(common, len(other))
            while same < limit and other[same] == ours[same]:
                same += 1
            common = same
            if not common:
                break
        if common:
            live = [(n, a, p[common:]) for n, a, p in live]
        live.append((0, ending, ours[common:]))
        key = tuple(live)
        known = self.states.get(key)
        if known is None:
            known = self.states[key] = {-1: key}
        out = state[byte] = (known, ours[:common])
        return out

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Token ids of one pre-token."""
        if len(self.states) > TABLE:
            self._clear()
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        out, state, step = [], self.start, self._step
        for at in range(0, len(data), 1 << 16):
            if at and len(self.states) > TABLE:
                kept = state[-1]
                self._clear()
                state = self.states.setdefault(kept, {-1: kept})
            for b in data[at:at + (1 << 16)]:
                nxt = state.get(b)
                state, ids = nxt if nxt is not None else step(state, b)
                if ids:
                    out += ids
        out += state[-1][-1][2]
        return tuple(out)


@contextmanager
def few_collections():
    """The tables grow by very many small objects; Python's collector would
    walk all of them again and again while they stay in use."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Encoder:
    """Ids of whole texts; every match of the pattern is encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        pattern = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
        self.find = regex.compile(pattern).findall
        # a single space between two other characters always begins a match
        self.cut = regex.compile(f"(?<![{SPACE}]) (?![{SPACE}])").split
        self.double = regex.compile(f"[{SPACE}][{SPACE}]").search
        self.machine = Transducer(ranks)
        self.memo: dict[str, tuple] = {}

    def _chunk(self, text: str) -> tuple:
        memo = self.memo
        if len(memo) >= MEMO:
            memo.clear()
        pieces = self.find(text)
        if len(pieces) == 1:
            ids = self.machine.encode(text.encode())
        else:
            out = []
            for p in pieces:
                ids = memo.get(p)
                if ids is None:
                    ids = self.machine.encode(p.encode())
                    if len(p) <= 40:
                        memo[p] = ids
                out += ids
            ids = tuple(out)
        if len(text) <= 40:
            memo[text] = ids
        return ids

    def __call__(self, text: str) -> list[int]:
        if not text:
            return []
        if text[0] == " " or text[-1] == " " or self.double(text):
            parts = self.cut(text)
        else:
            parts = text.split(" ")
        get, chunk = self.memo.get, self._chunk
        out = list(get(parts[0]) or chunk(parts[0]))
        for p in parts[1:]:
            p = " " + p
            out += get(p) or chunk(p)
        return out


class Utf8Stream:
    """Bytes to text in pieces; a character cut by the end of a piece waits."""

    def __init__(self):
        self.rest = b""

    @staticmethod
    def pending(data: bytes) -> int:
        """Bytes of an unfinished last character (0 to 3), by the states of
        UTF-8: a lead byte says how many continuation bytes are due."""
        due = seen = 0
        for b in data[-3:]:
            if due and 0x80 <= b < 0xC0:
                due -= 1
                seen += 1
            else:
                due = 1 if 0xC2 <= b < 0xE0 else 2 if 0xE0 <= b < 0xF0 else 3 if 0xF0 <= b < 0xF5 else 0
                seen = 1
        return seen if due else 0

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        wait = self.pending(data) if data else 0
        self.rest = data[len(data) - wait:]
        return data[:len(data) - wait].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.rest = self.rest, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids, vocab, piece: int = 1 << 16):
    """Text pieces of an id sequence."""
    stream = Utf8Stream()
    for i in range(0, len(ids), piece):
        yield stream.feed(b"".join(map(vocab.__getitem__, ids[i:i + piece])))
    yield stream.close()


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` per row; null text is empty and has no ids."""
    def run(batches):
        with few_collections():
            yield from encode(batches)

    def encode(batches):
        encoder = Encoder(ranks, pattern)
        for b in batches:
            out, rows, size = [], [], 0
            for i, text in enumerate(b.column(1)):
                out.append(encoder(text.as_py() or ""))
                rows.append(i)
                size += len(out[-1])
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])
                    out, rows, size = [], [], 0
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .transform(in_batches, run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; null ids are empty."""
    vocab = {i: t for t, i in ranks.items()}

    def run(batches):
        for b in batches:
            for at in range(0, max(1, b.num_rows), 64):
                part = b.slice(at, 64)
                texts = ["".join(decode_stream(ids.as_py() or [], vocab)) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").transform(in_batches, run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text in one pass, without moving ids:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Null text counts as empty; rows are independent, so repeated rows give
    repeated results; other columns are not read."""
    def run(batches):
        with few_collections():
            yield from both_ways(batches)

    def both_ways(batches):
        encoder = Encoder(ranks, pattern)
        vocab = {i: t for t, i in ranks.items()}
        name = {i: str(i) for i in vocab}
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for text in b.column(1):
                ids = encoder(text.as_py() or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(name.__getitem__, ids)).encode()).hexdigest())
                digest = hashlib.sha256()
                for part in decode_stream(ids, vocab):
                    digest.update(part.encode())
                text_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .transform(in_batches, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
