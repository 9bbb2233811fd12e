"""Ids of whole texts, each word part encoded once."""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, compress

import numpy as np
import pyarrow as pa

#: Word parts of one generation a worker remembers, and the longest of them.
GENERATION, LONGEST = 1 << 18, 48
#: Characters of the texts that are cut into parts together.
TOGETHER = 1 << 20
#: The characters of a part: letters, or one number, or anything else but white space (fixed value of the vocabulary file).
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_KINDS = (r"\s", "[a-zªµºß-öø-ſ]", "[0-9²³¹¼½¾]", ".")
#: Texts whose lower case and normal form are plain: letters up to U+017F whose lower case is no further, so without the dotted capital I.
_PLAIN = r"[\t\n\r -~¡-įı-ſ]*"


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    Right for vocabularies that drop white space, never join across parts and
    mark the last id of each part: the ids of a text are then those of its
    parts one after the other. Texts with other characters or with marks of
    special ids are encoded whole, and so are texts with a part whose ids do
    not end in one such mark. Two generations of parts are remembered; when the
    younger is full, the older goes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = re.compile(_PLAIN)
        characters = [chr(c) for c in range(0x180)]
        kinds = [next(k for k, kind in enumerate(_KINDS) if re.fullmatch(kind, c, re.DOTALL)) for c in characters]
        self.kinds = np.array(kinds, np.uint8)
        self.widths = np.array([0 if kind == _SPACE else len(c.encode()) for c, kind in zip(characters, kinds)], np.uint8)
        # The model knows bytes by stand-in characters.
        stand_in = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.stand_ins = {ord(c): stand_in(c)[0][0] for c in characters}
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(1 + max(vocabulary.values()), bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return array("I", ids).tobytes()

    def _new(self, parts: list[str]) -> list[bytes] | None:
        """Ids of parts, if the last id of each and no other is marked as such."""
        tokenize, table = self.model.tokenize, self.stand_ins
        ids = [[token.id for token in tokenize(part if part.isascii() else part.translate(table))] for part in parts]
        flat = np.fromiter(chain.from_iterable(ids), np.int64)
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        if not np.array_equal(np.flatnonzero(self.last[flat]), ends - 1):
            return None
        return [array("I", i).tobytes() for i in ids]

    def _remember(self, part: str, ids: bytes) -> None:
        if len(part) <= LONGEST:
            if len(self.young) >= GENERATION:
                self.old, self.young = self.young, {}
            self.young[part] = ids

    def _ids(self, parts: list[str]) -> list[bytes] | None:
        """Ids of different parts; None if one can't be encoded alone."""
        out = list(map(self.young.get, parts))
        unseen = [k for k, known in enumerate(out) if known is None]
        for k in unseen:
            out[k] = self.old.get(parts[k])
        missing = [k for k in unseen if out[k] is None]
        new = self._new([parts[k] for k in missing])
        if new is None:
            return None
        for k, ids in zip(missing, new):
            out[k] = ids
        for k in unseen:
            self._remember(parts[k], out[k])
        return out

    def _starts(self, codes: np.ndarray) -> np.ndarray:
        """Where parts begin; white space stands after the last."""
        kinds = self.kinds[codes]
        begins = np.empty(len(codes), bool)
        begins[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
        begins |= kinds == _NUMBER
        # 's, 't, 'm, 'd, 're, 've and 'll are parts if nothing of their kind stands before them.
        quote = np.flatnonzero(begins & (codes == ord("'")))
        one, two = codes[quote + 1], codes[quote + 2]
        short = quote[np.isin(one, [ord(c) for c in "stmd"])]
        long = quote[np.logical_or.reduce([(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")])]
        begins[short + 1] = begins[long + 1] = False
        begins[short + 2] = begins[long + 3] = True
        return np.flatnonzero(begins & (kinds != _SPACE))

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts: their different parts are looked up once."""
        joined = "\n".join([*texts, "\n\n"]).lower()
        codes = np.frombuffer(joined.encode("utf-16-le"), "<u2")
        starts = self._starts(codes)
        widths = self.widths[codes]
        after = np.cumsum(widths, dtype=np.int64)
        places = np.append(after[starts] - widths[starts], after[-1])
        unspaced = joined.encode().translate(None, b"\t\n\r ")
        parts = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(unspaced)).dictionary_encode()
        known = self._ids(parts.dictionary.to_numpy(zero_copy_only=False).tolist())
        if known is None:
            return [self._whole(text) for text in texts]
        ids = pa.array(known, pa.large_binary()).take(parts.indices)
        heads = np.fromiter(accumulate((len(text) + 1 for text in texts), initial=0), np.int64, len(texts) + 1)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        cuts = ends[np.searchsorted(starts, heads)].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]

    def batch(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of every text, in the order of the texts; texts of ``TOGETHER`` characters, or a longer one, are held."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text) + 1
            if size >= TOGETHER:
                yield from self._held(held)
                held, size = [], 0
        yield from self._held(held)

    def _held(self, texts: list[str]) -> Iterator[bytes]:
        plain = ["<|" not in text and bool(self.plain.fullmatch(text)) for text in texts]
        together = iter(self._together(list(compress(texts, plain))))
        for text, short in zip(texts, plain):
            yield next(together) if short else self._whole(text)

    def __call__(self, text: str) -> bytes:
        return next(self.batch([text]))


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder; it lasts from task to task."""
    return WordEncoder(path)
