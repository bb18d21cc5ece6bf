"""Token ids of whole texts, with ids of repeated pre-tokens kept.

A byte-level pre-tokenizer cuts a text by the classes of its characters (letter,
number, white space, other) and at seven English contractions, and no token
crosses a cut. The cuts of a batch of texts are found in its bytes at once; a
character's class is asked of the library's pre-tokenizer, once a worker. Arrow
finds the batch's distinct pre-tokens and those known already, the others go to
the library's BPE model, and the ids of a text are gathered from its pre-tokens'
ids. Texts with the string of an added token are encoded whole. With any other
kind of tokenizer, all texts are.

Equality with the library on whole texts is tested, whatever was encoded before."""

from __future__ import annotations

import itertools
import json
import operator
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
#: Pre-tokens of more bytes are encoded each time, not kept.
MAX_PIECE = 48

_ENCODERS: dict[int, Encoder] = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def load(path: str | None = None) -> str:
    """The tokenizer file's text, read on the driver (2 MB) and broadcast."""
    with open(path or default_path(), encoding="utf-8") as f:
        return f.read()


def encoder(definition: str) -> Encoder:
    """This worker's encoder; it outlives a task, so its words do too."""
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


#: The byte-level rule for bytes as characters (a fixed value): printable ones
#: stand for themselves, the others for 256, 257 ...
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: b for b in _PLAIN} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_BYTE_TABLE = np.array([_BYTE_CHARS[b] for b in range(256)], dtype="<u4")
#: Classes of characters to the pre-tokenizer; 0 is not asked yet.
_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4
_ID = operator.attrgetter("id")


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string or binary column without nulls."""
    _, bounds, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    bounds = np.frombuffer(bounds, dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def _code_points(data: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, sizes in bytes) of the characters of two to four bytes
    that begin at the places ``lead``."""
    first = data[lead].astype(np.int64)
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    point = first & (0x7F >> size)
    for i in range(1, 4):
        more = size > i
        point[more] = point[more] << 6 | data[lead[more] + i] & 0x3F
    return point, size


class Encoder:
    """Encodes batches of texts; keeps the ids of about ``limit`` pre-tokens,
    each of at most MAX_PIECE bytes (40 to 150 bytes with its ids). When there
    are more, those in the most batches stay."""

    def __init__(self, definition: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        spec = json.loads(definition)
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        pre = spec.get("pre_tokenizer") or {}
        self.byte_level = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                           and not spec.get("normalizer") and spec["model"].get("type", "BPE") == "BPE" and not spec["model"].get("dropout")
                           and not spec["model"].get("ignore_merges"))
        self.limit = limit
        self.known = pa.array([b""], pa.binary())  # the end mark: no pre-token is empty
        self.ids = np.array([END_ID], dtype=np.uint32)
        self.length = np.array([1], dtype=np.int64)
        self.batches = np.array([1], dtype=np.int32)
        self.classes = np.zeros(0x110000, dtype=np.uint8)
        if self.byte_level:
            for c in range(128):
                self.classes[c] = self._class_of(chr(c))

    def _class_of(self, c: str) -> int:
        """A character's class: that of the characters it makes a pre-token with."""
        if c == " ":
            return _SPACE  # it would start a pre-token of any class
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        return next((k for k, other in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")) if len(cut(c + other)) == 1), _SPACE)

    def _forget(self) -> None:
        """Keeps half of ``limit``, those in the most batches; older uses count
        less."""
        kept = np.concatenate([[0], 1 + np.argsort(-self.batches[1:], kind="stable")[:self.limit // 2]])
        ends = np.cumsum(self.length)
        ids, self.length = _gather(self.ids, (ends - self.length)[kept], self.length[kept]), self.length[kept]
        self.known, self.ids, self.batches = self.known.take(pa.array(kept)), ids, self.batches[kept] // 2

    def _byte_classes(self, data: np.ndarray) -> np.ndarray:
        """For each byte, its character's class."""
        out = self.classes[:256][data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            point, size = _code_points(data, lead)
            for c in np.unique(point[self.classes[point] == 0]).tolist():
                self.classes[c] = self._class_of(chr(c))
            found = self.classes[point]
            for i in range(4):
                out[lead[size > i] + i] = found[size > i]
        return out

    def _cuts(self, data: np.ndarray, bounds: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Where pre-tokens start, and the end; texts are the bytes between
        bounds, those numbered in ``whole`` are not cut."""
        kind = self._byte_classes(data)
        edge = np.zeros(len(data) + 1, dtype=bool)  # a text starts or ends here
        edge[bounds] = True
        start = edge.copy()
        start[1:-1] |= kind[1:] != kind[:-1]
        # the last of several spaces before a word is cut off; a plain one goes with the word
        space = kind == _SPACE
        word = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        word = word[~edge[word]]
        last = word - 1
        while len(inner := np.flatnonzero(data[last] & 0xC0 == 0x80)):
            last[inner] -= 1
        start[last] = True
        start[word[data[word - 1] == 0x20]] = False
        # 's 't 'm 'd 're 've 'll, where the apostrophe starts a pre-token
        mark = np.flatnonzero(data == 0x27)
        mark = mark[start[mark]]
        mark = mark[~edge[mark + 1]]
        a = data[mark + 1]
        short = np.isin(a, np.frombuffer(b"stmd", dtype=np.uint8))
        longer = mark[~edge[mark + 2]]
        a, b = data[longer + 1], data[longer + 2]
        longer = longer[((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))]
        start[mark[short] + 1] = start[longer + 1] = False
        start[mark[short] + 2] = start[longer + 3] = True
        for i in whole.tolist():
            start[bounds[i] + 1:bounds[i + 1]] = False
        return np.flatnonzero(start)

    def _ids_of(self, text: str) -> list[int]:
        """Ids of a whole text, from the library."""
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, new: pa.Array, whole: bool) -> None:
        """Adds pre-tokens and, with ``whole``, texts that hold an added
        token's string."""
        data, bounds = _buffers(new)
        mapped = _BYTE_TABLE[data].tobytes().decode("utf-32-le")
        places = bounds.tolist()
        ids, lengths, tokenize = [], [], self.model.tokenize
        for i in range(0, len(new), 20_000):
            found = [tokenize(mapped[a:b]) for a, b in itertools.pairwise(places[i:i + 20_001])]
            if whole:
                found = [self._ids_of(text.decode()) if self.added.search(text.decode()) else list(map(_ID, x))
                         for x, text in zip(found, new[i:i + 20_000].to_pylist())]
            every = itertools.chain.from_iterable(found)
            count = list(map(len, found))
            ids.append(np.fromiter(every if whole else map(_ID, every), dtype=np.uint32, count=sum(count)))
            lengths += count
        self.known = pa.concat_arrays([self.known, new])
        self.ids = np.concatenate([self.ids, *ids])
        self.length = np.concatenate([self.length, np.array(lengths, dtype=np.int64)])
        self.batches = np.concatenate([self.batches, np.zeros(len(new), dtype=np.int32)])

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each text followed by END_ID; where each text
        starts among them, and the end). Texts are a list or an Arrow array;
        null is empty."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.string()).fill_null("")
        if not self.byte_level:
            found = [[*e.ids, END_ID] for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            bounds = np.cumsum([0, *map(len, found)])
            return np.fromiter(itertools.chain.from_iterable(found), dtype=np.uint32, count=int(bounds[-1])), bounds
        if len(self.known) > self.limit:
            self._forget()
        data, bounds = _buffers(texts)
        whole = np.zeros(0, dtype=np.int64)
        if self.added:
            whole = np.flatnonzero(pc.match_substring_regex(texts, self.added.pattern).to_numpy(zero_copy_only=False))
        cuts = self._cuts(data, bounds, whole)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        number = pc.index_in(distinct, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(number < 0)
        kept = len(self.known)
        if len(missing):
            long = pc.greater(pc.binary_length(distinct), MAX_PIECE).to_numpy(zero_copy_only=False)[missing]
            missing = np.concatenate([missing[~long], missing[long]])
            number[missing] = kept + np.arange(len(missing))
            kept += int((~long).sum())
            self._learn(distinct.take(pa.array(missing)), len(whole) > 0)
        self.batches[number] += 1
        # by distinct pre-token, then the end mark
        number = np.append(number, 0)
        lengths = self.length[number]
        starts = (np.cumsum(self.length) - self.length)[number]
        at = np.searchsorted(cuts, bounds)  # each text's first pre-token
        code = np.insert(coded.indices.to_numpy(), at[1:], len(distinct))
        flat = _gather(self.ids, starts[code], (sizes := lengths[code]))
        if kept < len(self.known):
            self.known, self.length, self.batches = self.known[:kept], self.length[:kept], self.batches[:kept]
            self.ids = self.ids[:self.length.sum()]
        return flat, np.concatenate([[0], np.cumsum(sizes)])[at + np.arange(len(at))]


def _gather(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``ids`` that begin at ``starts``, one after the other."""
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    at += np.arange(len(at))
    return ids[at]
