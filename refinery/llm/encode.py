"""Token ids of whole texts by the ``tokenizers`` library, a memo over its pre-tokens.

The byte-level pre-tokenizer never lets a piece run from a non-space character
into white space, and looks ahead only. So a text may be cut before a white-space
run, and every cut part encodes as it does inside the text. Some texts at a time
are cut by Arrow, their distinct parts are numbered, and only distinct parts go
through Python: ids come from the memo, or from the library where they are new.
numpy then lays the ids out in the order of the parts.

``memo`` and ``unit`` bound a worker's memory. The memo holds ``MEMO`` parts at most: two generations, of which the older goes
when the newer is full, and parts that are met again move to the newer one.

Strings of added tokens in a text become their ids, as in the library as it is
loaded; with ``added=False`` they are ordinary text.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import STRETCH, hold, small, stretches

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
MEMO = 500_000
UNIT = 1 << 23              # characters whose parts are looked up together

# White space other than single blanks and line feeds, and "\0", which marks parts: such texts are encoded whole.
_ODD = r"\x00|[\t\x0b-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|  | \n|\n |\n\n"
# ASCII marks; an apostrophe could begin a contraction.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 onwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in table)
    return table | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """``encode(text)`` gives the little-endian unsigned 32-bit ids of a text, end id appended."""

    def __init__(self, path: str, end_id: int = END_ID, memo: int | None = None, added: bool = True,
                 unit: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = not added
        self.vocab = self.lib.get_vocab_size()
        tokens = [t.content for t in self.lib.get_added_tokens_decoder().values()] if added else []
        self.odd = "|".join([_ODD, *map(re.escape, tokens)])
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.end = np.array([end_id], "<u4").tobytes()
        self.most = MEMO if memo is None else memo
        self.unit = unit                 # None: UNIT
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))

    def documents(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
        """(id, ids) of every row of Arrow batches (doc_id, text), in order."""
        waiting: deque = deque()

        def texts():
            for batch in small(batches):
                waiting.extend(batch.column(0).to_pylist())
                yield from batch.column(1).to_pylist()

        for ids in self.encode_all(texts()):
            yield waiting.popleft(), ids

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text in turn; texts of ``UNIT`` characters together share one look-up of their parts."""
        unit, size = [], 0
        for text in texts:
            text = text or ""
            if unit and size + len(text) > (self.unit or UNIT):
                yield from self._unit(unit)
                unit, size = [], 0
            unit.append(text)
            size += len(text)
        yield from self._unit(unit)

    def _unit(self, texts: list[str]) -> Iterator[bytes]:
        apart = pc.match_substring_regex(pa.array(texts, pa.string()), self.odd).to_pylist()
        cut = [[] if a else list(stretches(t, STRETCH)) for t, a in zip(texts, apart)]
        found = self._stretches([s for part in cut for s in part])
        for text, alone, part in zip(texts, apart, cut):
            yield (self.whole(text) if alone else b"".join(next(found) for _ in part)) + self.end

    def _stretches(self, pieces: list[str]) -> Iterator[bytes]:
        """Ids of stretches, about ``UNIT`` characters at a time; a later stretch of a text begins with its blank."""
        group, size = [], 0
        for piece in pieces:
            group.append(piece)
            size += len(piece)
            if size >= (self.unit or UNIT):
                yield from self._ids(group)
                group, size = [], 0
        if group:
            yield from self._ids(group)

    def _ids(self, pieces: list[str]) -> list[bytes]:
        # "\0" marks a part that no blank stands before; a line feed is a part of its own
        lists = pc.split_pattern(pa.array(["\0" + p.replace("\n", " \n \0") for p in pieces]), " ")
        coded = lists.flatten().dictionary_encode()
        table = self._table(coded.dictionary)
        sizes = np.fromiter(map(len, table), np.int32, len(table)) >> 2
        flat, starts = np.frombuffer(b"".join(table), "<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        part = coded.indices.to_numpy()
        n = sizes[part]
        ends = np.cumsum(n, dtype=np.int32)              # a group of stretches has far less than 2^31 ids
        ids = flat[np.repeat(starts[part] - (ends - n), n) + np.arange(ends[-1], dtype=np.int32)]
        cuts = np.append(0, ends)[lists.offsets.to_numpy()]
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    def _table(self, parts: pa.Array) -> list[bytes]:
        """Ids of distinct parts. Marks at the end of letters and digits are looked up apart from them."""
        stems = pc.utf8_rtrim(parts, characters=_MARKS)
        marked = pc.and_(pc.utf8_is_alnum(pc.utf8_ltrim(stems, characters="\0")), pc.less(pc.binary_length(stems), pc.binary_length(parts)))
        coded = pc.if_else(marked, stems, parts).dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        table = [known[i] for i in coded.indices.to_pylist()]
        rows = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        cuts = pc.binary_length(stems.take(rows)).to_pylist()
        for row, part, cut in zip(rows.tolist(), parts.take(rows).cast(pa.binary()).to_pylist(), cuts):
            marks = part[cut:]
            if (ids := self.marks.get(marks)) is None:
                ids = self.marks[marks] = self.whole(marks.decode())
            table[row] += ids
        if len(self.marks) > self.most:
            self.marks = {}
        return table

    def _known(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, each as it stands after a blank."""
        get, old, tokenize = self.memo.get, self.older.get, self.lib.model.tokenize
        table = [get(p) for p in parts]
        new = [i for i, ids in enumerate(table) if ids is None]
        for i in new:
            p = parts[i]
            if (ids := old(p)) is None:
                after = p[:1] != "\0"
                word = p if after else p[1:]
                if word.isalpha() or word.isdecimal():               # one pre-token: the model alone is enough
                    raw = (" " + word if after else word).encode().decode("latin-1").translate(self.letters)
                    ids = np.array([t.id for t in tokenize(raw)], "<u4").tobytes()
                else:
                    ids = self.whole(" " + word if after and word != "\n" else word)
            table[i] = ids
        self._keep({parts[i]: table[i] for i in new})
        return table

    def _keep(self, found: dict[str, bytes]) -> None:
        if len(self.memo) + len(found) > self.most // 2:
            self.memo, self.older = {}, self.memo
        if len(found) <= self.most // 2:
            self.memo |= found


@lru_cache(maxsize=1)
def _loaded(name: str, end_id: int, memo: int | None, added: bool, unit: int | None) -> Encoder:
    import public_tokenizers
    return Encoder(public_tokenizers.path(name), end_id, memo, added, unit)


def encoder(name: str = TOKENIZER, end_id: int = END_ID, memo: int | None = None, added: bool = True,
            unit: int | None = None) -> Encoder:
    """One encoder a worker process, as long as it encodes."""
    hold("encode", _loaded.cache_clear)
    return _loaded(name, end_id, memo, added, unit)
