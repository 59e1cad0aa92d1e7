"""Loading of delimited text with reasoned rejects.

All records of an Arrow batch lie in one byte buffer. Quote masks and the parity of their prefix sums locate the delimiters outside
quotes and, in whole texts, the record ends outside quotes; counts per record and checks of whole columns then give either
typed rows or the reasons for their rejection. No record is parsed by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

QUOTE, NEWLINE, RETURN = 34, 10, 13

# The two delivered layouts (delimiter, number of fields) and the accepted split names.
LAYOUTS = {"dev.csv": (",", 3), "audioset_train_strong.tsv": ("\t", 4)}
SPLITS = ("train", "val")

NUMBER = r"^(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
DIGITS = "^[0-9]+$"

VALUES = "reasons array<string>, fname string, labels array<string>, split string, segment_id string, start_time_seconds double, end_time_seconds double, label string"
SCHEMA = f"line_id bigint, file_name string, line_no bigint, {VALUES}"
RECORDS = f"file_name string, record_no bigint, record string, {VALUES}"


def laid_out(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``lines`` (nulls are empty), each followed by a line end, and the positions of those ends."""
    full = pc.fill_null(lines.cast(pa.large_binary()), b"")
    full = full.combine_chunks() if isinstance(full, pa.ChunkedArray) else full
    offsets = np.frombuffer(full.buffers()[1], np.int64)[full.offset : full.offset + len(full) + 1]
    data = np.frombuffer(full.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(full) else np.zeros(0, np.uint8)
    size = np.diff(offsets)
    buf = np.full(len(data) + len(size), NEWLINE, np.uint8)
    buf[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = data
    return buf, np.cumsum(size + 1) - 1


def record_ends(buf: np.ndarray) -> np.ndarray:
    """Positions of the line ends outside quotes in a whole text that ends with one; what an open quote leaves over ends with the text."""
    inside = np.cumsum(buf == QUOTE) & 1
    at = np.flatnonzero((buf == NEWLINE) & (inside == 0))
    return at if len(at) and at[-1] == len(buf) - 1 or not len(buf) else np.r_[at, len(buf) - 1]


def structural_index(buf: np.ndarray, ends: np.ndarray, delimiter: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(begins, cuts, bad)`` of the records that end at ``ends``.

    ``cuts`` are the positions of delimiters outside quotes, ``bad`` marks records whose quoting is broken: a quote
    may only open a field, close it, or be doubled inside it.
    """
    begins = np.r_[0, ends[:-1] + 1].astype(np.int64)[: len(ends)]
    record = np.repeat(np.arange(len(ends)), ends - begins + 1)
    isq = buf == QUOTE
    total = np.cumsum(isq, dtype=np.int64)
    ahead = total - isq  # quotes before each byte
    base = ahead[begins] if len(begins) else np.zeros(0, np.int64)
    inside = ((ahead - base[record]) & 1).astype(bool)  # parity within the record
    last = np.zeros(len(buf), bool)
    last[ends] = True
    cut = (buf == ord(delimiter)) & ~inside & ~last
    at = np.flatnonzero(isq)
    bad = np.zeros(len(ends), bool)
    if len(at):
        opens = ~inside[at]
        prev = np.where(at > 0, at - 1, 0)
        first = np.isin(at, begins) | ((at > 0) & cut[prev])
        again = (at > 0) & isq[prev] & inside[prev] & (record[prev] == record[at])  # the second of a doubled quote
        nxt = at + 1  # the buffer ends with a line end, so this exists
        stops = last[nxt] | cut[nxt] | isq[nxt]
        wrong = np.where(opens, ~(first | again), ~stops)
        bad[record[at[wrong]]] = True
        odd = (total[ends] - base) & 1
        bad |= odd.astype(bool)
    return begins, np.flatnonzero(cut), bad


def gathered(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """The stretches [a, b) of the buffer as strings."""
    size = b - a
    offsets = np.r_[0, np.cumsum(size)].astype(np.int64)
    data = buf[np.arange(offsets[-1]) + np.repeat(a - offsets[:-1], size)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(a), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.large_string()).cast(pa.string())


def field(buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Field values: enclosing quotes dropped, doubled ones halved (quotes stand in quoted fields only)."""
    quoted = (b - a >= 2) & (buf[a] == QUOTE)
    return pc.replace_substring(gathered(buf, a + quoted, b - quoted), '""', '"')


def _every(lists: pa.Array, ok: np.ndarray) -> np.ndarray:
    """Per list (none is empty) whether ``ok`` holds for all its items."""
    at = np.asarray(lists.offsets)[:-1] - np.asarray(lists.offsets)[0] if len(lists) else np.zeros(0, np.int64)
    return np.logical_and.reduceat(ok, at) if len(at) else np.zeros(0, bool)


def _bools(x) -> np.ndarray:
    return np.asarray(x.to_numpy(zero_copy_only=False), bool)


def _dev(v: list[pa.Array], classes: pa.Array) -> tuple[dict[str, np.ndarray], dict[str, pa.Array]]:
    labels = pc.split_pattern(v[1], ",")
    known = _every(labels, _bools(pc.is_in(labels.flatten(), value_set=classes)))
    wrong = {"fname_value": ~_bools(pc.match_substring_regex(v[0], DIGITS)), "labels_value": ~known, "split_value": ~_bools(pc.is_in(v[2], value_set=pa.array(SPLITS)))}
    return wrong, {"fname": v[0], "labels": labels, "split": v[2]}


def _strong(v: list[pa.Array], mids: pa.Array) -> tuple[dict[str, np.ndarray], dict[str, pa.Array]]:
    shaped = _bools(pc.match_substring_regex(v[1], NUMBER)) & _bools(pc.match_substring_regex(v[2], NUMBER))
    a, b = (np.where(shaped, np.array(pc.if_else(pa.array(shaped), x, "nan").to_pylist() or [], "U").astype(float) if len(x) else np.zeros(0), np.nan) for x in v[1:3])
    wrong = {"time_value": ~(np.isfinite(a) & np.isfinite(b) & (a < b)), "label_value": ~_bools(pc.is_in(v[3], value_set=mids))}
    return wrong, {"segment_id": v[0], "start_time_seconds": pa.array(a), "end_time_seconds": pa.array(b), "label": v[3]}


_CHECKS = {"dev.csv": _dev, "audioset_train_strong.tsv": _strong}
_TYPES = {"fname": pa.string(), "labels": pa.list_(pa.string()), "split": pa.string(), "segment_id": pa.string(), "start_time_seconds": pa.float64(), "end_time_seconds": pa.float64(), "label": pa.string()}


def parse_block(buf: np.ndarray, ends: np.ndarray, file_name: str, names: pa.Array) -> dict[str, pa.Array]:
    """Reasons and typed values of the records of one layout, as columns; ``names`` are the class names or the mids.

    Records of an unknown layout have the reason ``file_name``.
    """
    n = len(ends)
    if file_name not in LAYOUTS:
        wrong, values, good = {"file_name": np.ones(n, bool)}, {}, np.zeros(0, np.int64)
    else:
        delimiter, width = LAYOUTS[file_name]
        begins, cuts, bad = structural_index(buf, ends, delimiter)
        lo = np.searchsorted(cuts, begins)
        counted = np.searchsorted(cuts, ends) - lo + 1 == width
        good = np.flatnonzero(~bad & counted)
        inner = cuts[lo[good][:, None] + np.arange(width - 1)[None, :]] if len(good) else np.zeros((0, width - 1), np.int64)
        a, b = np.column_stack([begins[good], inner + 1]), np.column_stack([inner, ends[good]])
        found, values = _CHECKS[file_name]([field(buf, a[:, k], b[:, k]) for k in range(width)], names)
        wrong = {"quoting": bad, "column_count": ~bad & ~counted}
        for reason, w in found.items():
            wrong[reason] = np.zeros(n, bool)
            wrong[reason][good] = w
    table = np.column_stack(list(wrong.values())) if n else np.zeros((0, len(wrong)), bool)
    row, col = np.nonzero(table)
    reasons = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(table.sum(1))], pa.int32()), pa.array(np.array(list(wrong), object)[col], pa.string()))
    # Values of rejected records are null.
    place = np.full(n, -1, np.int64)
    place[good] = np.arange(len(good))
    place[table.any(1)] = -1
    take = pa.array(place, mask=place < 0)
    return {"reasons": reasons} | {k: values[k].take(take).cast(t) if k in values else pa.nulls(n, t) for k, t in _TYPES.items()}


def vocabulary(labels: DataFrame) -> dict[str, pa.Array]:
    """Accepted names per layout, from a class vocabulary (class_name, mid).

    A fixed table of some tens of rows, so it travels with the tasks; more than MAX_LABELS rows are refused.
    """
    got = labels.select("class_name", "mid").limit(MAX_LABELS + 1).collect()
    if len(got) > MAX_LABELS:
        raise ValueError(f"the class vocabulary has more than {MAX_LABELS} rows")
    return {name: pa.array(sorted({r[k] for r in got if r[k] is not None}), pa.string()) for k, name in enumerate(LAYOUTS)}


def load_lines(lines: DataFrame, labels: DataFrame) -> DataFrame:
    """Typed rows and rejects of ``lines`` (line_id, file_name, line_no, line), one row per line; every line is a record.

    ``reasons`` is empty for a row that loads; otherwise the typed columns are null. A null line counts as an
    empty one (``column_count``), a file of unknown layout gives ``file_name``. ``labels`` is the class ``vocabulary``.
    """
    names = vocabulary(labels)
    schema = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            files = pc.fill_null(b.column("file_name"), "")
            for name in pc.unique(files).to_pylist():
                part = b.filter(pc.equal(files, name))
                got = parse_block(*laid_out(part.column("line")), name, names.get(name))
                yield pa.RecordBatch.from_arrays([(got[f.name] if f.name in got else part.column(f.name)).cast(f.type) for f in schema], schema=schema)

    return lines.select("line_id", "file_name", "line_no", "line").mapInArrow(run, SCHEMA)


def load_texts(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Typed rows and rejects of whole texts (file_name, content as string or binary), one row per record; records may span lines.

    Record ends are the line ends outside quotes (a carriage return before one does not count); a quote that is never closed makes all
    after it one record with the reason ``quoting``. A text is indexed in one task, so texts are of the size of one task's memory. Null and
    empty texts have no records. ``record`` is the record as delivered, null for one that loads.
    """
    names = vocabulary(labels)
    schema = to_arrow_schema(StructType.fromDDL(RECORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("file_name").to_pylist(), b.column("content").to_pylist()):
                raw = content.encode() if isinstance(content, str) else bytes(content or b"")
                if not raw:
                    continue
                raw = raw.replace(b"\r\n", b"\n").decode("utf-8", "replace").encode()
                buf = np.frombuffer(raw if raw.endswith(b"\n") else raw + b"\n", np.uint8)
                ends = record_ends(buf)
                got = parse_block(buf, ends, name or "", names.get(name or ""))
                whole = gathered(buf, np.r_[0, ends[:-1] + 1], ends)
                got |= {"file_name": pa.array([name] * len(ends)), "record_no": pa.array(np.arange(len(ends))), "record": pc.if_else(pc.equal(pc.list_value_length(got["reasons"]), 0), pa.scalar(None, pa.string()), whole)}
                yield pa.RecordBatch.from_arrays([got[f.name].cast(f.type) for f in schema], schema=schema)

    return texts.select("file_name", "content").mapInArrow(run, RECORDS)


#: Largest class vocabulary that is sent along with the tasks.
MAX_LABELS = 100_000


def rejects(loaded: DataFrame) -> DataFrame:
    """One row per rejected line and reason."""
    return loaded.select("line_id", F.explode("reasons").alias("reason"))


def valid_rows(loaded: DataFrame) -> DataFrame:
    """The lines that load, typed."""
    return loaded.where(F.size("reasons") == 0).drop("reasons")
