"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens. It starts with one state and a loop for each base symbol, so it accepts every spelling of
a text in base symbols. Each merge (u, v) -> w, in rank order, applies one merge gadget:

* the state entered by u is copied without its arc for v, and the arcs for u lead to the copy;
* every state with an arc for u gets an arc for w, which leads where v led.

Afterwards it accepts exactly the token sequences that the merges produce, and a word has one accepted path whose
labels spell it. All arcs for a token enter one state, so the states are named by tokens. A state's missing arcs are
stored as intervals: tokens are numbered in post-order of the forest "left part of", children in rank order, so what a
gadget takes away (v, and all that would later have grown from v on its right side) is one interval of numbers.

All states and the spellings of the labels are compiled into flat tables of integers, once, on the driver. Encoding
reads a word's bytes through the tables' transitions, place by place; decoding emits arc labels.

Defined results: null and empty texts have no ids and decode to the empty string; added special tokens are cut out of
the text first, as the library does; ids outside the vocabulary emit nothing.
"""

from __future__ import annotations

import json
import struct
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby, islice

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from . import common

#: How byte-level vocabularies split a text into words before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Characters after which a long text is cut where white space begins.
PART_CHARS = 1_000_000
#: Bytes that either generation of words and ids kept by a worker may take, by an estimate of so many bytes an entry
#: besides its own.
CACHE_BYTES = 72_000_000
ENTRY_BYTES = 200
_EDGE = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})")


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies use for each byte: printable bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """The compiled merges of a vocabulary, in flat tables.

    ``vocabulary`` maps each token's label to its id; ``merges`` lists pairs of labels in rank order. Labels are bytes.
    A token is known by its post-order number, and so is the state that its arcs enter; state ``len(ids)`` is the start.

    * ``spans``: state ``s`` has no arc for the tokens within ``low[i]`` to ``high[i]``, ``spans[s] <= i < spans[s+1]``;
    * ``first``, ``byte``: the spellings of all tokens as one byte-by-byte transition table. The nodes that node ``n``
      leads to are numbered from ``first[n]`` to before ``first[n+1]``, each by the byte in ``byte``;
    * ``spelt``: the token that is spelt on reaching a node, or -1; ``ids``: the vocabulary's id of each token.
    """

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        rank = {t: -1 for t in vocabulary if len(t) == 1}
        left: dict[bytes, bytes] = {}
        right: dict[bytes, bytes] = {}
        grown: dict[bytes, list[bytes]] = {}
        for k, (u, v) in enumerate(merges):
            w = u + v
            if w in rank:
                raise ValueError(f"two merges make {w!r}")
            rank[w], left[w], right[w] = k, u, v
            grown.setdefault(u, []).append(w)
        number, lowest = _post_order(sorted(t for t in rank if rank[t] < 0), grown)
        usable = {t for t in rank if rank[t] < 0}
        gadgets: dict[bytes, list[tuple[int, int, int]]] = {}
        taken_at: dict[tuple[bytes, bytes], int] = {}
        for k, (u, v) in enumerate(merges):
            if u in usable and v in usable and _has_arc(u, v, k, rank, left, right, taken_at):
                later = next((c for c in grown.get(v, ()) if rank[c] >= k), None)
                gadgets.setdefault(u, []).append((k, lowest[later] if later else number[v], number[v]))
                taken_at[u, v] = k
                usable.add(u + v)
        self._compile_states(number, gadgets, rank, right)
        self._compile_spelling({t: number[t] for t in usable})
        self.ids = array("i", [0] * len(number))
        for t in usable:
            self.ids[number[t]] = vocabulary[t]

    def _compile_states(self, number: dict, gadgets: dict, rank: dict, right: dict) -> None:
        """What every state lacks: the gadgets of its token, and of the token's right parts up to the rank at which
        they grew, in disjoint ascending intervals."""
        self.spans, self.low, self.high = array("i", [0]), array("i"), array("i")
        for token in sorted(number, key=number.__getitem__):
            found: list[tuple[int, int]] = []
            until, a = len(rank), token
            while a is not None:
                found += [(low, high) for k, low, high in gadgets.get(a, ()) if k < until]
                until, a = rank[a], right.get(a)
            begin = len(self.low)
            for low, high in sorted(found):
                if len(self.low) > begin and low <= self.high[-1] + 1:
                    self.high[-1] = max(self.high[-1], high)
                else:
                    self.low.append(low)
                    self.high.append(high)
            self.spans.append(len(self.low))
        self.spans.append(len(self.low))  # the start lacks nothing
        self.spans = self.spans.tolist()

    def _compile_spelling(self, tokens: dict[bytes, int]) -> None:
        level = [(b"", sorted(tokens))]
        self.first, self.spelt, reading = array("i"), array("i"), bytearray(1)
        made = 1
        while level:
            deeper = []
            for prefix, below in level:
                self.first.append(made)
                self.spelt.append(tokens.get(prefix, -1))
                n = len(prefix)
                for byte, group in groupby((t for t in below if len(t) > n), key=lambda t: t[n]):  # noqa: B023
                    deeper.append((prefix + bytes((byte,)), list(group)))
                    reading.append(byte)
                    made += 1
            level = deeper
        self.first.append(made)
        self.byte = bytes(reading)
        self.first, self.spelt = self.first.tolist(), self.spelt.tolist()

    def encode_word(self, word: bytes) -> list[int]:
        """The ids on the accepted path that spells the word.

        Every state accepts, so each prefix of the word has exactly one accepted path. From the state at each place,
        the bytes that follow drive the spelling table; where a token is spelt and the state has an arc for it, the
        path to that place is found.
        """
        first, byte, spelt, spans, low, high = self.first, self.byte, self.spelt, self.spans, self.low, self.high
        n = len(word)
        start = len(self.ids)
        # lists are faster, arrays smaller
        came, entered = ([-1] * (n + 1), [start] * (n + 1)) if n < 4096 else (array("i", [-1]) * (n + 1), array("i", [start]) * (n + 1))
        find = byte.find
        for at in range(n):
            state = entered[at]
            if at and state == start:
                raise ValueError(f"no path spells {word!r}")
            begin, end = spans[state], spans[state + 1]
            node, to = 0, at
            while to < n:
                node = find(word[to], first[node], first[node + 1])
                if node < 0:
                    break
                to += 1
                if came[to] < 0:  # a place is entered by one arc only
                    token = spelt[node]
                    if token >= 0:
                        i = bisect_right(low, token, begin, end) - 1
                        if i < begin or token > high[i]:
                            came[to], entered[to] = at, token
            if not at and came[n] == 0:
                break
        out, at = [], n
        while at > 0:
            if came[at] < 0:
                raise ValueError(f"no path spells {word!r}")
            out.append(self.ids[entered[at]])
            at = came[at]
        return out[::-1]


def _post_order(roots: list[bytes], grown: dict[bytes, list[bytes]]) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """Post-order numbers of the tokens, and the lowest number below each."""
    number: dict[bytes, int] = {}
    lowest: dict[bytes, int] = {}
    for root in roots:
        stack = [(root, False)]
        while stack:
            t, done = stack.pop()
            if done:
                number[t] = len(number)
            else:
                lowest[t] = len(number)
                stack.append((t, True))
                stack += [(c, False) for c in reversed(grown.get(t, ()))]
    return number, lowest


def _has_arc(u: bytes, v: bytes, now: int, rank: dict, left: dict, right: dict, taken_at: dict) -> bool:
    """Whether, before the gadget of rank ``now``, the state entered by u has an arc for v."""
    a: bytes | None = u
    until = now
    while a is not None:
        b: bytes | None = v
        grew = now
        while b is not None:
            k = taken_at.get((a, b))
            if k is not None and k < until and k <= grew:
                return False
            grew, b = rank[b], left.get(b)
        until, a = rank[a], right.get(a)
    return True


class Codec:
    """Encodes and decodes texts with the compiled tables of a byte-level vocabulary."""

    def __init__(self, automaton: Automaton, labels: list[bytes | None], special: dict[str, int]):
        self.automaton = automaton
        self.labels = labels
        self.special = special
        self._ready()

    def _ready(self) -> None:
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}  # what follows a blank, with the blank's ids
        self.words: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.words_before: dict[str, bytes] = {}
        self.held = 0

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("automaton", "labels", "special")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    @classmethod
    def of_file(cls, path: str) -> Codec:
        """Compile a vocabulary file of the tokenizers library."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        as_bytes = lambda s: bytes(symbols[c] for c in s)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        labels: list[bytes | None] = [None] * (1 + max([*vocabulary.values(), *special.values()], default=0))
        for t, i in vocabulary.items():
            labels[i] = t
        for name, i in special.items():
            labels[i] = name.encode()
        return cls(Automaton(vocabulary, [(as_bytes(a), as_bytes(b)) for a, b in pairs]), labels, special)

    def encode_text(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers.

        No word of the split spans from other characters into white space, so a long text is cut where white space
        begins and needs bounded memory beside its ids; a part without runs of blanks is cut at its blanks, and what
        follows each blank is encoded once with the blank before it.
        """
        if len(text) <= PART_CHARS:
            return self._part(text)
        out, at = bytearray(), 0
        while at < len(text):
            end = _EDGE.search(text, at + PART_CHARS)
            to = end.start() if end else len(text)
            out += self._part(text[at:to])
            at = to
        return bytes(out)

    def _part(self, text: str) -> bytes:
        if self.cut is not None and self.cut.search(text):
            parts = self.cut.split(text)
            return b"".join([struct.pack("<I", self.special[p]) if p in self.special else self._part(p) for p in parts])
        find = self.split.findall
        if "  " in text or text[-1:] == " ":
            return b"".join([self._word(m[0]) for m in self.split.finditer(text)])
        chunks = text.split(" ")
        get, word = self.known.get, self._word
        out = [b"".join(map(word, find(chunks[0])))]
        for c in islice(chunks, 1, None):
            found = get(c)
            if found is None:
                found = self.known_before.get(c)
                if found is None:
                    words = find(" " + c)
                    found = self._encode(words[0]) if len(words) == 1 else b"".join(map(word, words))
                self._keep(self.known, c, found)
                get = self.known.get
            out.append(found)
        return b"".join(out)

    def _keep(self, cache: dict[str, bytes], key: str, value: bytes) -> None:
        size = len(key) + len(value) + ENTRY_BYTES
        if size > 4 * ENTRY_BYTES:
            return
        cache[key] = value
        self.held += size
        if self.held > CACHE_BYTES:  # the young generation becomes the old one, and the older is forgotten
            self.known_before, self.words_before = self.known, self.words
            self.known, self.words, self.held = {}, {}, 0

    def _encode(self, word: str) -> bytes:
        ids = self.automaton.encode_word(word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = self.words_before.get(word)
            if found is None:
                found = self._encode(word)
            self._keep(self.words, word, found)
        return found

    def decode_ids(self, packed: bytes) -> str:
        ids, labels = memoryview(packed).cast("I"), self.labels
        try:
            return b"".join([labels[i] for i in ids]).decode("utf-8", "replace")
        except (IndexError, TypeError):  # ids outside the vocabulary emit nothing
            return b"".join([labels[i] or b"" if i < len(labels) else b"" for i in ids]).decode("utf-8", "replace")


_compiled: dict[str, Codec] = {}
_sent: dict = {}


def codec(path: str) -> Codec:
    """The compiled tables of a vocabulary file, once per process."""
    if path not in _compiled:
        _compiled[path] = Codec.of_file(path)
    return _compiled[path]


def tables(spark: SparkSession, path: str) -> Broadcast[Codec]:
    """The compiled tables for the workers. Their size is that of the vocabulary and does not grow with the data; the
    file is read and compiled by the driver alone."""
    key = (path, spark.sparkContext.applicationId)
    if key not in _sent:
        common.tune(spark)
        _sent[key] = spark.sparkContext.broadcast(codec(path))
        del _compiled[path]
    return _sent[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(df: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ids (binary: little-endian unsigned 32-bit integers) of every whole text."""
    sent = tables(df.sparkSession, vocabulary)
    schema = df.select(*keep).schema.simpleString()[7:-1] + ", ids binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            ids = [own.encode_text(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.binary())], [*batch.schema.names[:-1], "ids"])

    return common.in_arrow(df.select(*keep, common.text_or_empty(text).alias("__text")), work, schema)


def decode(df: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``decoded``, the text that the arc labels of ``ids`` spell, to a table that ``encode`` made."""
    sent = tables(df.sparkSession, vocabulary)
    schema = df.schema.simpleString()[7:-1] + ", decoded string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            texts = [own.decode_ids(x.as_py() or b"") for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return common.in_arrow(df, work, schema)


def encode_checked(df: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256 and, ``with_ids``, the ids: each text is encoded, its ids
    are decoded again in the same worker, and the decoded text is digested there, so neither it nor a second worker
    takes an executor's memory."""
    sent = tables(df.sparkSession, vocabulary)
    made = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string", "ids binary"][: 4 if with_ids else 3]
    schema = ", ".join([df.select(*keep).schema.simpleString()[7:-1], *made])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        types = [pa.int64(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for t in batch.column(batch.num_columns - 1):
                ids = own.encode_text(t.as_py())
                columns[0].append(len(ids) // 4)
                columns[1].append(sha256(ids).hexdigest())
                columns[2].append(sha256(own.decode_ids(ids).encode()).hexdigest())
                if with_ids:
                    columns[3].append(ids)
            arrays = [pa.array(columns[i], types[i]) for i in range(len(made))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], [*batch.schema.names[:-1], *[m.split()[0] for m in made]])

    return common.in_arrow(df.select(*keep, common.text_or_empty(text).alias("__text")), work, schema)


def op4_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_checked(common.table(spark, sf_dir, "documents"), default_vocabulary(), with_ids=False)
