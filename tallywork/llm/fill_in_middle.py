"""Fill-in-the-middle: a document becomes a piece table over buffers that never change.

A piece says (buffer, start, stop); the buffers are the document and the three sentinels. Cutting a
document splits a piece in two, an arrangement puts pieces and sentinels in another order, the inverse
arrangement restores the document, and hashes read piece after piece. Text is copied once, when an
output is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.common import field

SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
TEXT = "T"
# Order of parts in an output. A capital is a sentinel, p, s and m are the parts of the document.
FORMS = {"psm": "PpSsMm", "spm": "SsPpMm"}
PLAIN = "plain"

_PIECES = "array<struct<buffer:string,start:long,stop:long>>"
_ARRANGED = f"doc_id long, n long, form string, prefix_chars long, middle_chars long, pieces {_PIECES}, output string, output_sha256 string"
_RESTORED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, text string, restored_sha256 string"
_PIECE_TYPE = pa.list_(pa.struct([("buffer", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
_BATCH = 16 << 20  # bytes of output that one batch gathers before it is passed on

Piece = tuple[str, int, int]


def fill_in_middle(
    docs: DataFrame, rate: int = 100, spm_rate: int = 50, salt: int = 7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document rearranged: (doc_id, n, form, prefix_chars, middle_chars, pieces, output, output_sha256).

    A document is cut at ends of lines (a line keeps its line feed; ``n`` counts them). Both cuts, whether it is rearranged at all
    (``rate`` of 100) and whether the suffix comes first (``spm_rate`` of 100) follow from the SHA-256 of ``salt:doc_id``, so reruns agree.
    ``pieces`` are the descriptors of the output; offsets count UTF-8 bytes of the document or of a sentinel; empty pieces are left out.
    Lengths count code points and are NULL where the form is plain.

    NULL and empty texts are plain with n = 0, and so is a text that holds a sentinel. A NULL id is hashed as an empty
    one. Repeated rows give equal rows, texts of any length are cut whole, an empty table gives no
    rows; other columns are ignored. One row is worked on at a time: no shuffle, and memory for the longest document.
    """
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(field(id_col).cast("long").cast("string"), F.lit(""))), 256)
    drawn = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(
        field(id_col).cast("long").alias("doc_id"), F.coalesce(field(text_col).cast("string"), F.lit("")).cast("binary").alias("text"), *drawn
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for doc_id, text, h1, h2, h3, h4 in zip(*(_values(c) for c in batch.columns), strict=True):
                n, pieces, form, chars = _arranged(text, (h1, h2, h3, h4), rate, spm_rate)
                out.append((doc_id, n, form, *chars, pieces, _written(pieces, text), _hashed(pieces, text)))
                held += len(text)
                if held > _BATCH:
                    yield _batch(out, _ARRANGED)
                    out, held = [], 0
            yield _batch(out, _ARRANGED)

    return rows.mapInArrow(work, _ARRANGED)


def restore(arranged: DataFrame) -> DataFrame:
    """The documents back from the outputs and forms of :func:`fill_in_middle`, and nothing else.

    Returns (doc_id, n, form, prefix_chars, middle_chars, output_sha256, text, restored_sha256). An output is cut at the first of each sentinel in the order of its form; the inverse
    arrangement leaves the sentinels out. Outputs of plain form are the documents. NULL outputs restore to the empty text.
    """
    kept = [c.split()[0] for c in _RESTORED.split(", ")[:6]]
    rows = arranged.select(*kept, F.coalesce("output", F.lit("")).cast("binary").alias("output"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for *known, output in zip(*(_values(c) for c in batch.columns), strict=True):
                pieces = _inverse(output, known[2])
                out.append((*known, _written(pieces, output), _hashed(pieces, output)))
                held += len(output)
                if held > _BATCH:
                    yield _batch(out, _RESTORED)
                    out, held = [], 0
            yield _batch(out, _RESTORED)

    return rows.mapInArrow(work, _RESTORED)


def cut(pieces: list[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces before and after ``at`` bytes; a piece that reaches across is split."""
    left, right = [], []
    for buffer, start, stop in pieces:
        here = min(max(at, 0), stop - start)
        if here:
            left.append((buffer, start, start + here))
        if here < stop - start:
            right.append((buffer, start + here, stop))
        at -= stop - start
    return left, right


def arrange(parts: dict[str, list[Piece]], form: str) -> list[Piece]:
    """Parts and sentinels in the order of ``form``."""
    out: list[Piece] = []
    for name in FORMS[form]:
        out += [(name, 0, len(SENTINELS[name]))] if name in SENTINELS else parts[name]
    return out


def _arranged(text: bytes, drawn: tuple[int, int, int, int], rate: int, spm_rate: int):
    h1, h2, h3, h4 = drawn
    view = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(view == 10) + 1
    if len(text) and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    n = len(ends)
    whole: list[Piece] = [(TEXT, 0, len(text))] if text else []
    if not text or h3 % 100 >= rate or any(mark in text for mark in SENTINELS.values()):
        return n, whole, PLAIN, (None, None)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    offsets = [int(ends[k - 1]) if k else 0 for k in (first, second)]
    head, suffix = cut(whole, offsets[1])
    prefix, middle = cut(head, offsets[0])
    form = "spm" if h4 % 100 < spm_rate else "psm"
    begins = (view & 0xC0) != 0x80  # bytes that begin a code point
    chars = int(begins[: offsets[0]].sum()), int(begins[offsets[0] : offsets[1]].sum())
    return n, arrange({"p": prefix, "m": middle, "s": suffix}, form), form, chars


def _inverse(output: bytes, form: str) -> list[Piece]:
    """Pieces of ``output`` that make up the document."""
    pieces: list[Piece] = [(TEXT, 0, len(output))] if output else []
    if form == PLAIN:
        return pieces
    marks = [name for name in FORMS[form] if name in SENTINELS]
    at, places = 0, []
    for name in marks:
        begin = output.index(SENTINELS[name], at)
        at = begin + len(SENTINELS[name])
        places.append((begin, at))
    parts = {}
    for name, (_, start), (stop, _) in zip(marks, places, [*places[1:], (len(output), 0)], strict=True):
        parts[name.lower()] = cut(cut(pieces, stop)[0], start)[1]
    return parts["p"] + parts["m"] + parts["s"]


def _slices(pieces: list[Piece], text: bytes) -> Iterator[memoryview]:
    for buffer, start, stop in pieces:
        yield memoryview(text if buffer == TEXT else SENTINELS[buffer])[start:stop]


def _hashed(pieces: list[Piece], text: bytes) -> str:
    sha = hashlib.sha256()
    for part in _slices(pieces, text):
        sha.update(part)
    return sha.hexdigest()


def _written(pieces: list[Piece], text: bytes) -> bytes:
    return b"".join(_slices(pieces, text))


def _values(column: pa.Array) -> list:
    return column.to_pylist()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in (schema.replace(_PIECES, "pieces")).split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    kinds = {"doc_id": pa.int64(), "n": pa.int64(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "pieces": _PIECE_TYPE}
    arrays = []
    for name, values in zip(names, columns, strict=True):
        if name in ("output", "text"):  # valid UTF-8: whole code points of a valid text
            arrays.append(pa.array(values, pa.binary()).cast(pa.string(), safe=False))
        elif name == "pieces":
            arrays.append(pa.array([[dict(zip(("buffer", "start", "stop"), p, strict=True)) for p in v] for v in values], _PIECE_TYPE))
        else:
            arrays.append(pa.array(values, kinds.get(name, pa.string())))
    return pa.RecordBatch.from_arrays(arrays, names=names)
