"""Fill-in-the-middle: texts cut into prefix, middle and suffix and put in another order, and back again.

A text is cut between tokens (runs of ASCII letters, any other character alone). The work is done in one
bytearray per text: the cuts are scanned, sentinels inserted where prefix, middle and suffix begin, and then
two neighbouring blocks change places by three reversals (each block in itself, then both together). The
``psm`` form swaps middle and suffix, ``spm`` takes the suffix before both. A rotation is undone by the
opposite rotation, so ``restored`` finds the sentinels, rotates back and takes them out again, which gives
the text byte for byte from output and form alone. A sentinel begins and ends with characters that it holds
nowhere else, so none can arise across a border with a text that holds none.

Whether a text changes, its form and its cuts follow from a SHA-256 of seed and id: a lost task gives the
same rows again, and rows never depend on their neighbours.

Defined cases: a null text counts as empty; an empty text, or one that holds a sentinel already, stays plain;
a document without id is hashed as one of empty id; repeated rows give equal rows; empty pieces are kept (the
cuts may meet, or lie at either end); an empty table gives no rows. Columns other than id and text are not
carried, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

#: The sentinels of prefix, suffix and middle, and the names of the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

LETTERS = ~W.not_in((0x41, 0x5A), (0x61, 0x7A))
_CHANGED = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
)


def rotate(buffer: bytearray, begin: int, border: int, end: int) -> None:
    """Exchange the blocks ``[begin, border)`` and ``[border, end)`` in place by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    for first, last in ((begin, border), (border, end), (begin, end)):
        half = (last - first) // 2
        if half:
            front, back = view[first : first + half], view[last - half : last][::-1]
            kept = front.copy()
            front[:] = back
            back[:] = kept


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text in ``psm`` or ``spm`` order; it is cut at two byte offsets."""
    buffer = bytearray(text)
    for place, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[place:place] = mark
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, middle if form == PSM else 0, suffix, len(buffer))
    return buffer


def rebuild(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given."""
    buffer = bytearray(output)
    if form == PSM:
        suffix = buffer.index(SUFFIX)
        middle = buffer.index(MIDDLE, suffix)
        rotate(buffer, suffix, middle, len(buffer))
        middle, suffix = suffix, suffix + len(buffer) - middle
    else:
        prefix = buffer.index(PREFIX)
        rotate(buffer, 0, prefix, len(buffer))
        suffix = len(buffer) - prefix
        middle = buffer.index(MIDDLE)
    for place, mark in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[place : place + len(mark)]
    return bytes(buffer)


def _token_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens begin, and where characters do: marks per byte."""
    characters = (data & 0xC0) != 0x80
    letters = LETTERS[data]
    follows = np.zeros(len(data), dtype=bool)
    follows[1:] = letters[1:] & letters[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    follows[begins] = False
    return characters & ~follows, characters


def _texts(parts: list[bytes]) -> pa.Array:
    """A text column of bytes that are known to be whole characters."""
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int64)
    data = pa.py_buffer(b"".join(parts))
    column = pa.LargeStringArray.from_buffers(len(parts), pa.py_buffer(ends.tobytes()), data)
    return column.cast(pa.string())


def _arranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in W.slices(batch, "text"):
            data, offsets = W.buffers(part.column("text"))
            tokens, characters = _token_places(data, offsets)
            places = np.append(np.flatnonzero(tokens), len(data))
            first = np.searchsorted(places, offsets)
            before = np.concatenate([[0], np.cumsum(characters)])
            n = np.diff(first)
            cuts = np.stack([part.column(c).to_numpy() % (n + 1) for c in ("cut_a", "cut_b")])
            cuts = first[:-1] + np.sort(cuts, axis=0)
            last = offsets[1:]  # a cut behind the last token is the end of its text
            one, two = (np.minimum(places[np.minimum(c, len(places) - 1)], last) for c in cuts)
            raw = data.tobytes()
            plain = part.column("is_plain").to_numpy(zero_copy_only=False)
            spm = part.column("is_spm").to_numpy(zero_copy_only=False)
            forms, outputs = [], []
            for row, (low, a, b, high) in enumerate(zip(offsets.tolist(), one.tolist(), two.tolist(), last.tolist())):
                text = raw[low:high]
                held = not text or PREFIX in text or SUFFIX in text or MIDDLE in text
                form = PLAIN if plain[row] or held else SPM if spm[row] else PSM
                forms.append(form)
                outputs.append(text if form == PLAIN else bytes(arrange(text, a - low, b - low, form)))
            unchanged = np.array([form == PLAIN for form in forms], dtype=bool)
            yield pa.record_batch(
                {
                    "doc_id": part.column("doc_id"),
                    "n": pa.array(n, pa.int64()),
                    "form": pa.array(forms, pa.string()),
                    "prefix_chars": pa.array(before[one] - before[offsets[:-1]], pa.int64(), mask=unchanged),
                    "middle_chars": pa.array(before[two] - before[one], pa.int64(), mask=unchanged),
                    "output": _texts(outputs),
                }
            )


def rearranged(
    documents: DataFrame, seed: str = "1", changed_percent: int = 90, spm_percent: int = 20
) -> DataFrame:
    """Per document its number of tokens, its form and the text in that form.

    ``changed_percent`` of the documents are rearranged, ``spm_percent`` of those suffix first. Prefix and
    middle are given in characters, null for plain texts.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = documents.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        draws[0].alias("cut_a"),
        draws[1].alias("cut_b"),
        (draws[2] % 100 >= changed_percent).alias("is_plain"),
        (draws[3] % 100 < spm_percent).alias("is_spm"),
    )
    return rows.mapInArrow(_arranged, _CHANGED)


def restored(changed: DataFrame) -> DataFrame:
    """The rows of ``rearranged`` with a column ``text``, rebuilt from ``output`` and ``form`` alone."""

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "output"):
                data, offsets = W.buffers(part.column("output"))
                raw, ends = data.tobytes(), offsets.tolist()
                texts = [
                    raw[a:b] if form == PLAIN else rebuild(raw[a:b], form)
                    for a, b, form in zip(ends, ends[1:], part.column("form").to_pylist())
                ]
                yield pa.record_batch([*part.columns, _texts(texts)], names=[*part.schema.names, "text"])

    columns = ", ".join(f"`{name}` {kind}" for name, kind in changed.dtypes)
    return changed.mapInArrow(restore, f"{columns}, text string")
