"""Members of JSON objects as they are written, byte for byte.

A scan of the flat bytes of many objects at once: a quote counts if an even number of backslashes
stands before it, what lies between quotes is text, and brackets outside text give the depth. A
member of the object itself is what follows a colon at depth one, up to the next comma there or
the end of the object. Nothing is parsed, so numbers keep all digits and their spelling.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

AT_ONCE = 1 << 22  # bytes scanned at once, and those of one more object


def json_members(column: Column, names: list[str]) -> Column:
    """A struct of the texts of the members called ``names``, without blanks around them.

    An absent member and ``null`` are null, and so are all members of a null. Of a repeated name the
    last counts. The objects must be valid JSON; for others the texts are arbitrary.
    """
    fields = ", ".join(f"m{i} string" for i in range(len(names)))

    @F.arrow_udf(f"struct<{fields.replace(' string', ': string')}>")
    def run(objects: pa.Array) -> pa.Array:
        found: list[list[pa.Array]] = [[] for _ in names]
        for part in _parts(objects):
            for own, values in zip(found, members(part, names), strict=True):
                own.append(values)
        columns = [pa.concat_arrays(own) if own else pa.array([], pa.string()) for own in found]
        return pa.StructArray.from_arrays(columns, [f"m{i}" for i in range(len(names))])

    return run(column)


def _parts(objects: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(objects), 0).to_numpy(zero_copy_only=False))
    bounds = np.append(np.unique(ends // AT_ONCE, return_index=True)[1], len(objects))
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield objects.slice(low, high - low)


def _taken(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """The spans of ``data`` as a text array; null where not ``valid``."""
    sizes = np.maximum(ends - starts, 0)
    bounds = np.append(0, np.cumsum(sizes))
    chosen = data[np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])]
    mask = None if valid is None else pa.array(valid).buffers()[1]
    buffers = [mask, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(chosen))]
    return pa.Array.from_buffers(pa.string(), len(starts), buffers)


def members(objects: pa.Array, names: list[str]) -> list[pa.Array]:
    """One text array per name."""
    objects = pa.compute.fill_null(objects.cast(pa.large_string()), "")
    offsets = np.frombuffer(objects.buffers()[1], np.int64)[objects.offset : objects.offset + len(objects) + 1]
    raw = objects.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    n, size = len(objects), len(data)
    row = np.repeat(np.arange(n), np.diff(offsets))
    index = np.arange(size)

    def since_row(running: np.ndarray) -> np.ndarray:
        """A running sum, from the row's start instead of the slice's."""
        return running - np.append(0, running)[offsets[:-1]][row]

    plain = np.maximum.accumulate(np.where(data != 92, index, -1)) if size else index  # last byte but a backslash
    before = np.append(-1, plain[:-1]) if size else index
    slashes = np.minimum(index - 1 - before, index - offsets[:-1][row])
    quote = (data == 34) & (slashes % 2 == 0)
    text = since_row(np.cumsum(quote)) % 2 == 1  # from an opening quote up to its end
    bare = ~text & ~quote
    opens, closes = bare & ((data == 123) | (data == 91)), bare & ((data == 125) | (data == 93))
    depth = since_row(np.cumsum(opens.astype(np.int64) - closes))
    ended = since_row(np.cumsum(closes & (depth == 0)))  # what follows the object doesn't count
    colon = np.flatnonzero(bare & (data == 58) & (depth == 1) & (ended == 0))
    stop = np.flatnonzero((bare & (data == 44) & (depth == 1)) | (closes & (depth == 0)))
    stop = np.append(stop, size)
    blank = (data == 32) | (data == 9) | (data == 10) | (data == 13)
    full = np.flatnonzero(~blank)

    end = np.minimum(stop[np.searchsorted(stop, colon)], offsets[1:][row[colon]])
    first = np.append(full, size)[np.searchsorted(full, colon + 1)]
    last = full[np.maximum(np.searchsorted(full, end) - 1, 0)] + 1 if len(full) else end
    quotes = np.append(np.flatnonzero(quote), [size, size])
    closing = np.searchsorted(quotes, colon) - 1
    if len(colon) and closing.min() < 1:  # a colon without a name: not JSON
        good = closing >= 1
        colon, end, first, last, closing = colon[good], end[good], first[good], last[good], closing[good]
    name_start, name_end = quotes[closing - 1] + 1, quotes[closing]
    keys = _taken(data, name_start, name_end)
    escaped = np.add.reduceat(np.append(data == 92, False), np.stack([name_start, name_end], 1).ravel())[::2] if len(
        colon
    ) else np.zeros(0)
    found = pa.compute.index_in(keys, value_set=pa.array(names, pa.string())).fill_null(-1).to_numpy().copy()
    for i in np.flatnonzero(escaped).tolist():  # names spelled with escapes, which writers rarely do
        try:
            key = json.loads(f'"{keys[i].as_py()}"')
        except ValueError:
            continue
        found[i] = names.index(key) if key in names else -1
    out = []
    for number in range(len(names)):
        own = np.flatnonzero(found == number)
        place = np.full(n, -1)
        place[row[colon[own]]] = own  # the last of a repeated name
        has = place >= 0
        starts, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
        starts[has], ends[has] = first[place[has]], last[place[has]]
        is_null = has & (ends - starts == 4)
        if is_null.any():
            at = starts[is_null]
            is_null[is_null] = (data[at[:, None] + np.arange(4)] == np.frombuffer(b"null", np.uint8)).all(1)
        out.append(_taken(data, starts, np.maximum(ends, starts), has & ~is_null))
    return out
