"""Token ids of whole texts, with a public tokenizer's vocabulary file.

Most tokenizers never join characters across a gap of white space. For those, a batch is cut into
pieces, each distinct piece is encoded once, and the ids are gathered: ``word`` for tokenizers that
drop white space, ``spaced`` for byte-level ones that keep it with the word behind it, ``whole`` for any
other. Both also part letters from other characters, so words are cut there too; left as they are: words
with an apostrophe (contractions are one match) or with characters beyond ASCII and the Latin-1 letters.
In ``spaced`` texts with other than ASCII white space are encoded whole. Strings of special tokens in a
text are ordinary text.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

from . import words as W

#: Pieces kept from batch to batch in a worker.
KEPT_PIECES = 400_000
#: Pieces encoded in one call.
JOINED = 2_000
SLICE_BYTES = 4 << 20
_GAP = ~W.SPACED
_OTHER_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_coders: dict[tuple[str, str], Coder] = {}


def _class_changes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where letters and other characters meet inside words that may be cut there. Words are the runs
    ``start`` to ``end``, maybe led by white space."""
    letter = _ASCII_LETTER[data]
    latin = data[:-1] == 0xC3
    latin &= (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter[:-1] |= latin
    letter[1:] |= latin
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = letter[1:] != letter[:-1]
    cut[1:] &= ~_GAP[data[:-1]] & ~_GAP[data[1:]]
    odd = (data == 0x27) | ((data >= 0x80) & ~letter)
    if odd.any():
        sums = np.concatenate([[0], np.cumsum(odd)])
        for word in np.flatnonzero(sums[end] - sums[start]):
            cut[start[word] : end[word]] = False
    return cut


def id_kind(vocabulary: int) -> str:
    """The little-endian integer type that holds every id."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class Coder:
    """One vocabulary file in one worker process."""

    def __init__(self, path: str, cut: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut = cut
        self.kept: dict[bytes, bytes] = {}
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.marks = {text[:1].encode() for text in special.values()}
        self.mark_id, self.mark = next(iter(special.items()), (None, None))

    @classmethod
    def get(cls, path: str, cut: str) -> Coder:
        if (path, cut) not in _coders:
            _coders[path, cut] = cls(path, cut)
        return _coders[path, cut]

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as bytes. Many short texts are encoded as one, parted by a special token;
        texts with a character that begins a special token are encoded on their own."""
        ids: list[bytes] = [b""] * len(texts)
        alone = range(len(texts))
        if self.mark is not None and self.cut != "whole":
            alone = [i for i, text in enumerate(texts) if any(m in text for m in self.marks)]
            apart = set(alone)
            joined = [i for i in range(len(texts)) if i not in apart]
            self.tokenizer.encode_special_tokens = False
            runs = [joined[at : at + JOINED] for at in range(0, len(joined), JOINED)]
            found = self.tokenizer.encode_batch_fast(
                [self.mark.join([texts[i].decode() for i in run]) for run in runs],
                add_special_tokens=False,
            )
            for run, encoded in zip(runs, found):
                flat = np.array(encoded.ids, dtype=np.uint32)
                raw, edges = flat.tobytes(), np.flatnonzero(flat == self.mark_id).tolist()
                begin = 0
                for i, end in zip(run, [*edges, len(flat)]):
                    ids[i] = raw[4 * begin : 4 * end]
                    begin = end + 1
        self.tokenizer.encode_special_tokens = True
        found = self.tokenizer.encode_batch_fast(
            [texts[i].decode() for i in alone], add_special_tokens=False
        )
        for i, encoded in zip(alone, found):
            ids[i] = array("I", encoded.ids).tobytes()
        return ids

    def _pieces(self, column: pa.Array) -> W.Words:
        data, offsets = W.buffers(column)
        if self.cut == "word":
            found = W.split(data, offsets, W.SPACED, lower=False)
            opening = np.zeros(len(data), dtype=bool)
            opening[found.start] = True
            start = np.flatnonzero(opening | _class_changes(data, found.start, found.end))
            closing = np.append(start[1:], len(data))
            word = np.searchsorted(found.start, start, side="right") - 1
            return W.Words(
                data, start, np.minimum(closing, found.end[word]), np.searchsorted(start, offsets)
            )
        if self.cut == "whole":
            filled = np.flatnonzero(np.diff(offsets) > 0)
            start, end = offsets[filled], offsets[filled + 1]
            return W.Words(data, start, end, np.searchsorted(start, offsets))
        gap = _GAP[data]
        opening = gap.copy()
        opening[1:] &= ~gap[:-1]
        if len(data):
            for other in _OTHER_SPACE.finditer(data.tobytes()):
                text = np.searchsorted(offsets, other.start(), side="right") - 1
                opening[offsets[text] : offsets[text + 1]] = False
        begins = offsets[:-1]
        opening[begins[begins < len(data)]] = True
        start = np.flatnonzero(opening)
        end = np.append(start[1:], len(data))
        start = np.flatnonzero(opening | _class_changes(data, start, end))
        end = np.append(start[1:], len(data))
        return W.Words(data, start, end, np.searchsorted(start, offsets))

    def ids(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and the places where each text begins."""
        pieces = self._pieces(column)
        _, sample, which = np.unique(pieces.hashes(), return_index=True, return_inverse=True)
        spelled = pieces.spelled(sample)
        kept = self.kept
        known = [kept.get(piece) for piece in spelled]
        missing = [i for i, ids in enumerate(known) if ids is None]
        new = self._encode([spelled[i] for i in missing])
        for i, ids in zip(missing, new):
            known[i] = ids
        room = max(KEPT_PIECES - len(kept), 0)
        kept.update(zip([spelled[i] for i in missing[:room] if len(spelled[i]) < 64],
                        [known[i] for i in missing[:room] if len(spelled[i]) < 64]))
        flat = np.frombuffer(b"".join(known), np.uint32)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        from_ = np.cumsum(sizes) - sizes
        size = sizes[which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        texts = len(column)
        bounds = np.concatenate([[0], ends])[pieces.first] + np.arange(texts + 1)
        out = np.full(total + texts, end_id, dtype=np.uint32)
        inside = np.ones(len(out), dtype=bool)
        inside[bounds[1:] - 1] = False
        out[inside] = flat[np.arange(total) + np.repeat(from_[which] - (ends - size), size)]
        return out, bounds
