"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at ASCII white space, which no token of the vocabulary can cross, so a text of any length is
encoded piece by piece with the result of the whole text. Texts are taken together up to ``TEXT_BYTES``; equal pieces
among them are encoded once. Where the vocabulary's own rules leave a word of Latin letters whole, pieces are cut again,
between letters and signs, and the library's model gets the distinct words directly, without the rules.

Defined results: null and empty texts have 0 tokens; rows are counted one by one, so repeats and ties need no rule.
"""

from __future__ import annotations

import json
import os
import re
import threading
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LIMIT = 2048
#: Bytes of pieces that one call of the library encodes.
BATCH_BYTES = 64_000
#: Letters of words that one call of the library's model encodes.
WORD_BYTES = 200_000
#: Rare words, of which one that is a single token stands between pieces.
MARKS = ("■", "►", "✓", "€", "©")
#: Bytes of text whose pieces are held at a time.
TEXT_BYTES = 20_000_000

#: Rules under which a word of Latin letters is lower-cased and reaches the model whole, as its bytes; a run of other signs
#: that follows is a word of its own.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Between one of these signs and a letter, words end; none is part of a special token.
SIGNS = b".,;:!?#%$&*"
#: What a byte of a piece is: a letter, one of ``SIGNS``, another sign that letters and ``SIGNS`` around it leave as it is in
#: either case, or anything else.
LETTER, SIGN, PLAIN, ELSE = 1, 2, 4, 8
_KINDS = np.array([LETTER if chr(b).isalpha() else SIGN if b in SIGNS else ELSE if b == ord("<") else PLAIN for b in range(128)] + [ELSE] * 128, np.uint8)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: The byte level's letter for each byte of a word; bytes that are not printable have letters of their own.
_BYTES = np.array([162 + b if 127 <= b <= 160 else 323 if b == 173 else b for b in range(256)], "<u2")

_loaded: dict = {}


def _whole_words(tokenizer):
    """The model of a tokenizer under ``RULES`` as a tokenizer of words between spaces, and for each id if it ends a word;
    else none. The special tokens must all hold ``<`` and none of ``SIGNS``, and all bytes must have tokens."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    said = json.loads(tokenizer.to_str())
    model = said["model"]
    end = model.get("end_of_word_suffix")
    if model["type"] != "BPE" or model.get("dropout") or not end or any(said[k] != v for k, v in RULES.items()):
        return None, None
    if any("<" not in t["content"] or set(t["content"].encode()) & set(SIGNS) for t in said["added_tokens"]):
        return None, None
    letters = _BYTES.tobytes().decode("utf-16-le")
    if not all(c in model["vocab"] and c + end in model["vocab"] for c in letters[128:] + letters[97:123]):
        return None, None
    ends = np.zeros(max(model["vocab"].values()) + 1, bool)
    ends[[i for t, i in model["vocab"].items() if t.endswith(end)]] = True
    words = Tokenizer(tokenizer.model)
    words.pre_tokenizer = WhitespaceSplit()
    return words, ends


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids or lengths of whole texts (UTF-8), by the tokenizers library on their pieces between ASCII white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        ids = {m: self.tokenizer.encode(m, add_special_tokens=False).ids for m in MARKS}
        self.mark = next((m for m in MARKS if len(ids[m]) == 1), None)
        self.mark_id = ids[self.mark][0] if self.mark else -1
        self.words, self.ends = _whole_words(self.tokenizer)

    def _by_rules(self, pieces: list[bytes]) -> pa.LargeBinaryArray:
        """The packed ids of each piece. Pieces are encoded side by side, with a word between them that is one token and
        that none of them holds."""
        out: dict[bytes, bytes] = {}
        held = self.mark.encode() if self.mark else b""
        apart = [p for p in pieces if held in p]
        joined = [p for p in pieces if held not in p]
        for i, j in common.byte_slices([len(p) for p in joined], BATCH_BYTES):
            part = joined[i:j]
            text = f" {self.mark} ".join([p.decode() for p in part])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            at = (4 * np.flatnonzero(ids == self.mark_id)).tolist()
            raw = ids.tobytes()
            if len(at) != len(part) - 1:
                raise ValueError("pieces and marks do not agree")
            out.update(zip(part, [raw[x:y] for x, y in zip([0, *[x + 4 for x in at]], [*at, len(raw)], strict=True)], strict=True))
        for p in apart:
            out[p] = np.array(self.tokenizer.encode(p.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return pa.array([out[p] for p in pieces], pa.large_binary())

    def _by_model(self, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The packed ids of each word, which is lower-case letters only. An id says if it ends a word."""
        data, bounds = _flat(words)
        n = np.arange(len(words) + 1)
        spaced = np.full(len(data) + len(words), ord(" "), "<u2")
        spaced[np.arange(len(data)) + np.repeat(n[:-1], np.diff(bounds))] = _BYTES[data]
        found = [np.zeros(0, "<u4")]
        # from the first word that starts in a stretch of WORD_BYTES to that of the next
        cuts = np.unique((bounds + n)[np.searchsorted(bounds, np.arange(0, len(data) + WORD_BYTES, WORD_BYTES).clip(max=len(data)))])
        for i, j in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            text = spaced[i:j].tobytes().decode("utf-16-le")
            found.append(np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or len(ends) and ends[-1] != len(ids):
            raise ValueError("words and their ends do not agree")
        return _binary(np.concatenate([[0], 4 * ends]), pa.py_buffer(ids))

    def _learn(self, pieces: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The packed ids of each of the distinct pieces."""
        if self.words is None:
            return self._by_rules(pieces.to_pylist())
        parts, kinds, ends = _parts(pieces)
        parts = parts.dictionary_encode()
        places, parts = parts.indices.to_numpy(), parts.dictionary
        kind = np.empty(len(parts), np.uint8)
        kind[places] = kinds
        whole = kind == LETTER
        ids = pa.concat_arrays([self._by_model(parts.filter(pa.array(whole))), self._by_rules(parts.filter(pa.array(~whole)).to_pylist())])
        order = np.empty(len(parts), np.int64)
        order[np.concatenate([np.flatnonzero(whole), np.flatnonzero(~whole)])] = np.arange(len(parts))
        ids = ids.take(pa.array(order[places]))
        return _binary(_flat(ids)[1][ends], ids.buffers()[2])

    def count(self, texts: list[bytes]) -> list[int]:
        """The number of tokens of each text."""
        out: list[int] = []
        for i, j in common.byte_slices([len(t) for t in texts], TEXT_BYTES):
            pieces, places, ends = _distinct(texts[i:j])
            n = np.diff(_flat(self._learn(pieces))[1]) // 4
            out += np.diff(np.concatenate([[0], np.cumsum(n[places])])[ends]).tolist()
        return out

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        for i, j in common.byte_slices([len(t) for t in texts], TEXT_BYTES):
            pieces, places, ends = _distinct(texts[i:j])
            ids, bounds = _flat(self._learn(pieces).take(pa.array(places)))
            cuts = bounds[ends].tolist()
            out += [ids[x:y].tobytes() for x, y in zip(cuts, cuts[1:], strict=False)]
        return out


def _binary(bounds: np.ndarray, data: pa.Buffer) -> pa.LargeBinaryArray:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), data])


def _flat(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and where each begins and the last ends."""
    bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0] if bounds[0] else bounds


def _distinct(texts: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """The distinct pieces between ASCII white space, the place among them of every piece, and where the pieces of each
    text end, from 0 on. The vocabulary ignores case; in ASCII text without a marker of special tokens it can be dropped
    here, which makes more pieces equal. White space at the ends of a text leaves empty pieces, which have no tokens."""
    low = [t.lower() if t.isascii() and b"<|" not in t else t for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in low], dtype=np.int64)])
    cut = pc.ascii_split_whitespace(_binary(bounds, pa.py_buffer(b"".join(low))).view(pa.large_string()))
    pieces = cut.flatten().dictionary_encode()
    return pieces.dictionary.view(pa.large_binary()), pieces.indices.to_numpy(), cut.offsets.to_numpy()


def _cut(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    pieces, places, ends = _distinct(texts)
    return pieces.to_pylist(), places, ends


def _parts(pieces: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """Pieces cut between letters and ``SIGNS``, where words end under ``RULES``: the parts, the kinds of bytes in each, and
    where the parts of each piece end, from 0 on. Case is dropped except beside ``ELSE``, which a letter may be composed
    with or make a special token with. Letters of Latin-1 have one code point in either case, and so one form."""
    data, bounds = _flat(pieces)
    kinds, low = _KINDS[data], _LOWER[data]
    lead = np.flatnonzero(data == 0xC3)
    last = data[lead + 1]
    lead, last = lead[(last != 0x97) & (last != 0xB7)], last[(last != 0x97) & (last != 0xB7)]  # not the signs of times and division
    kinds[lead] = kinds[lead + 1] = LETTER
    low[lead + 1] = last + np.where(last <= 0x9E, 32, 0).astype(np.uint8)
    starts = np.zeros(len(data) + 1, bool)
    starts[1:-1] = (kinds[1:] | kinds[:-1]) == LETTER | SIGN
    starts[bounds] = True
    starts = np.flatnonzero(starts)
    kinds = np.bitwise_or.reduceat(kinds, starts[:-1]) if len(data) else kinds
    if (kinds >= ELSE).any():
        low = np.where(np.repeat(kinds >= ELSE, np.diff(starts)), data, low)
    return _binary(starts, pa.py_buffer(low)), kinds, np.searchsorted(starts, bounds)


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = (path, os.getpid(), threading.get_ident())
    if key not in _loaded:
        _loaded[key] = Encoder(path)
    return _loaded[key]


def token_counts(df: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every whole text; the tokens themselves never leave the workers."""
    source = df.select(key, F.encode(common.text_or_empty(text), "UTF-8").alias("__text"))
    schema = source.select(key).schema.simpleString()[7:-1] + ", n_bytes long, n_tokens long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for held in common.together(batches, 1, TEXT_BYTES):
            texts = [t for batch in held for t in batch.column(1).to_pylist()]
            sizes = [len(t) for t in texts]
            keys = pa.concat_arrays([batch.column(0) for batch in held])
            yield pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64()), pa.array(own.count(texts), pa.int64())], [held[0].schema.names[0], "n_bytes", "n_tokens"])

    return common.in_arrow(source, work, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.table(spark, sf_dir, "documents"), default_vocabulary())
