"""Token counts and token ids of a public byte-level BPE vocabulary.

A text is cut into pre-tokens by vectorised character classes.  Two facts make
the rest cheap and are established once per worker, before any document:

* a vocabulary string that is reached by merging only its own parts encodes
  alone as one token, so every pre-token equal to it counts 1 unseen;
* any other pre-token is merged by the library itself, once per distinct
  pre-token, and remembered in a bounded memory.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orfloom.llm.text import SLICE_BYTES, slices, with_text

#: Distinct merged pre-tokens that a worker remembers.
MEMORY = 400_000
_OTHER, _LETTER, _NUMBER, _SPACE, _UNSURE = range(5)
_loaded: dict[str, Vocabulary] = {}
_classes: np.ndarray | None = None


def _class_table() -> np.ndarray:
    """Class of each code point below U+3000; beyond it and where Unicode versions may differ: unsure."""
    global _classes
    if _classes is None:
        table = np.full(0x3000, _UNSURE, dtype=np.uint8)
        for c in [*range(0x0250), *range(0x2010, 0x2070)]:
            kind = unicodedata.category(chr(c))
            table[c] = _LETTER if kind[0] == "L" else _NUMBER if kind[0] == "N" else _OTHER
            if kind == "Cn":
                table[c] = _UNSURE
        for c in [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x2028, 0x2029, 0x202F, 0x205F]:
            table[c] = _SPACE
        _classes = table
    return _classes


def pretoken_starts(points: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pre-tokens start.  ``first``: where texts start, without empty ones; kinds: classes of ``points``.

    Runs of letters, of numbers and of other marks are pre-tokens and take one
    blank before them along; of a run of white space before text the last
    character stands alone (or goes along); a contraction after an apostrophe
    is a pre-token of its own.
    """
    n = len(points)
    at_first = np.zeros(n + 1, dtype=bool)
    at_first[first] = True
    at_first[n] = True
    change = at_first[:n].copy()
    change[1:] |= kinds[1:] != kinds[:-1]
    start = change.copy()
    space = kinds == _SPACE
    last = space & ~at_first[1:]
    last[:-1] &= ~space[1:]
    start |= last
    goes = last & (points == 32)
    start[1:][goes[:-1]] = False
    mark = change & (points == 39)
    where = np.flatnonzero(mark[:-1]) if n else np.zeros(0, np.int64)
    where = where[start[where] & ~at_first[where + 1]]
    if len(where):
        padded = np.concatenate([points[: n + 1], np.zeros(3, points.dtype)])
        one, two = padded[where + 1], padded[where + 2]
        inside = where + 2 < n
        inside[inside] &= ~at_first[where[inside] + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = inside & (((two == ord("e")) & np.isin(one, [ord("r"), ord("v")])) | ((one == ord("l")) & (two == ord("l"))))
        for hit, size in ((short, 2), (pair & ~short, 3)):
            w = where[hit]
            start[w + 1] = False
            if size == 3:
                start[w + 2] = False
            w = w + size
            start[w[w < n]] = True
    return start


class Vocabulary:
    """The library's tokenizer with the whole-token table and the memory of merged pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        pre = self.spec.get("pre_tokenizer") or {}
        model = self.spec["model"]
        self.direct = not (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not self.spec.get("normalizer")
            and model.get("type") == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        )
        self.special = [x["content"] for x in self.spec.get("added_tokens", [])]
        self.merge = self.library.model
        whole = {} if self.direct else whole_tokens(self.spec)
        self.whole = pa.array(list(whole), pa.string()), np.ones(len(whole), np.int64), np.fromiter((i for x in whole.values() for i in x), np.uint32)
        self.forget()

    def forget(self) -> None:
        self.words, self.sizes, self.flat = self.whole

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def find(self, pretokens: pa.Array) -> np.ndarray:
        """Place of each distinct pre-token in ``words``, ``sizes``; those not there yet are merged by the library's model."""
        if len(self.words) > MEMORY:
            self.forget()
        at = pc.index_in(pretokens, value_set=self.words)
        if at.null_count:
            new = pretokens.filter(pc.is_null(at))
            ids = [[t.id for t in self.merge.tokenize(w.encode().decode("latin-1").translate(_TO_PRINTABLE))] for w in new.to_pylist()]
            at = pc.if_else(pc.is_null(at), len(self.words), at).to_numpy(zero_copy_only=False).astype(np.int64)
            fresh = at == len(self.words)
            at[fresh] += np.arange(len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, ids), np.int64, len(ids))])
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.uint32)])
            return at
        return at.to_numpy(zero_copy_only=False).astype(np.int64)


def whole_tokens(spec: dict) -> dict[str, tuple[int]]:
    """Vocabulary strings proved to encode alone as one token, with their id.

    Proof: replay the merge rule on the string: repeatedly join the adjacent
    pair of lowest rank.  Only a string whose replay ends in one symbol is
    listed; added tokens are not, they never reach the merges.
    """
    vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
    rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(merges)}
    added = {x["content"] for x in spec.get("added_tokens", [])}
    to_byte = {c: b for b, c in enumerate(_byte_alphabet())}
    out = {}
    for token, number in vocabulary.items():
        if token in added:
            continue
        parts = list(token)
        while len(parts) > 1:
            best, at = min((rank.get(p, len(rank)), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if best == len(rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 1:
            try:
                out[bytes(to_byte[c] for c in token).decode("utf-8")] = (number,)
            except (UnicodeDecodeError, KeyError):  # part of a character: never a pre-token of valid text
                continue
    return out


def _byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


_TO_PRINTABLE = dict(enumerate(_byte_alphabet()))


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _encoded(column: pa.Array, vocab: Vocabulary, want_ids: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None]]:
    """(first row, end row, tokens of each row, all ids in row order or None)."""
    kinds_of = _class_table()
    for lo, hi, raw, offsets in slices(column, 2 * SLICE_BYTES):
        rows = hi - lo
        counts = np.zeros(rows, dtype=np.int64)
        text = raw.tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        kinds = np.full(len(points), _UNSURE, dtype=np.uint8)
        low = points < len(kinds_of)
        kinds[low] = kinds_of[points[low]]
        head = (raw & 0xC0) != 0x80
        char_at = np.concatenate([[0], np.cumsum(head)])[offsets]
        odd = np.zeros(rows, dtype=bool)
        odd[np.searchsorted(char_at, np.flatnonzero(kinds == _UNSURE), "right") - 1] = True
        for s in vocab.special:
            at = text.find(s)
            while at >= 0:
                odd[np.searchsorted(char_at, at, "right") - 1] = True
                at = text.find(s, at + 1)
        odd |= vocab.direct
        if not len(points):
            yield lo, hi, counts, np.zeros(0, np.uint32) if want_ids else None
            continue
        filled = np.diff(char_at) > 0
        start = pretoken_starts(points, char_at[:-1][filled], kinds)
        byte_of = np.flatnonzero(head)
        cuts = np.append(byte_of[start], len(raw)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(raw.tobytes()))
        if odd.all():
            which, sizes = np.zeros(len(words), np.int64), np.zeros(1, np.int64)
        else:
            coded = words.dictionary_encode()
            which = vocab.find(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
            sizes = vocab.sizes
        bounds = np.searchsorted(cuts[:-1], offsets)
        total = np.concatenate([[0], np.cumsum(sizes[which])])
        counts = total[bounds[1:]] - total[bounds[:-1]]
        strange = np.flatnonzero(odd & filled)
        by_library = {}
        if len(strange):
            for i, got in zip(strange, vocab.encode([raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8") for i in strange]), strict=True):
                by_library[i] = got
                counts[i] = len(got)
        if not want_ids:
            yield lo, hi, counts, None
            continue
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1][which]
        out = vocab.flat[np.repeat(begin - total[:-1], sizes[which]) + np.arange(total[-1])] if total[-1] else np.zeros(0, np.uint32)
        if by_library:
            pieces = np.split(out, total[bounds[1:-1]])
            out = np.concatenate([np.asarray(by_library[i], np.uint32) if i in by_library else p for i, p in enumerate(pieces)])
        yield lo, hi, counts, out


def count_column(column: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text of an Arrow column."""
    if path.endswith(".model"):
        import sentencepiece

        if path not in _loaded:
            _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        return np.array([len(x) for x in _loaded[path].encode(pc.fill_null(column, "").to_pylist(), num_threads=1)], dtype=np.int64)
    parts = [counts for _, _, counts, _ in _encoded(column, vocabulary(path), False)]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def token_counts(df: DataFrame, vocabulary_path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to ``df``, in one narrow pass.

    Counts equal the library's for a ``.json`` (tokenizers) or ``.model``
    (sentencepiece) file without begin, end or added special tokens; special
    strings inside a text count as the library takes them.  Null and empty
    texts have 0 bytes and 0 tokens.  Texts with characters on which Unicode
    versions may differ go to the library whole.  Columns of ``df`` with the
    names of the results are replaced; repeated rows each get their counts.
    """
    names = ("n_bytes", "n_tokens", "over_limit")
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType([*kept, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    keep = [f.name for f in kept]

    rows, at = with_text(df, keep, text)

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            n = count_column(column, vocabulary_path)
            size = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), size, pa.array(n), pa.array(n > limit)], names=[*keep, *names])

    return rows.mapInArrow(run, schema)
