"""DBF (dBase III) record scan as a Spark Python data source.

Planning only lists files; a file is cut into byte ranges, and the task that
reads a range reads the file's header first and takes the records that begin
in its range, in bounded chunks, with numpy.  Every column lands as text (the
all-string landing schema):

* ``C``: stripped latin1 text, empty -> null
* ``N`` / ``F``: number text, exact for whole numbers of any length; other
  numbers as the nearest double prints; unparsable -> null
* ``D``: valid ``YYYYMMDD`` -> ``YYYY-MM-DD``; invalid -> null
* ``L``: ``T y t`` -> ``True``, ``N n F f`` -> ``False``; else null
* records whose deletion flag is not a space are skipped; a file whose header
  makes no sense or that ends before its last record is an error, or is left
  out whole with ``on_error="skip"`` (``read_report`` tells which and why).

Only fields that the schema names are decoded.  Comparisons, prefixes and
lists on a field (pushed down by Spark) and ``prefixes`` (see ``scan``) are
settled first, on that field alone; the other fields are decoded for the
records that are left.  Small files share a partition.

Usage::

    scan(spark, path, schema="...", lineage="ARQUIVO_ORIGEM")

With a ``schema`` no header is read outside the tasks; without one it is the
union of all headers by name.
"""

from __future__ import annotations

import json
import math
import posixpath
import re
import struct
from dataclasses import dataclass

from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith)

from .files import list_files, open_store, store_options, write_named

BYTES_PER_PARTITION = 64 << 20
OPEN_COST = 1 << 20  # what opening one more file counts for
KINDS = "CNFDL"
_WHOLE = re.compile(r"[+-]?\d+$")


@dataclass
class Header:
    nrec: int
    header_len: int
    record_len: int
    fields: list  # (name, type, size)


def read_header(fs, path: str) -> Header:
    with fs.open_input_file(path) as f:
        head = f.read(32)
        nrec, hlen, rlen = struct.unpack("<IHH", head[4:12])
        raw = f.read(hlen - 32)
    fields = []
    for i in range(0, len(raw) - 1, 32):
        d = raw[i:i + 32]
        if d[0] == 0x0D:
            break
        name = d[:11].split(b"\x00", 1)[0].decode("latin1").strip()
        fields.append((name, chr(d[11]), d[16]))
    return Header(nrec, hlen, rlen, fields)


def fault(store, path: str, size: int) -> tuple[Header | None, str | None]:
    """(header, what is wrong) of a file, from its header and its size alone,
    so every task that reads a part of it comes to the same answer."""
    try:
        h = read_header(store, path)
    except (struct.error, IndexError):
        return None, "no whole header"
    if h.nrec and (1 + sum(n for _, _, n in h.fields) != h.record_len or h.header_len > size):
        return h, "header and fields do not agree"
    odd = sorted({kind for _, kind, _ in h.fields} - set(KINDS))
    if odd:
        return h, f"field type {odd[0]!r} not supported"
    held = (size - h.header_len) // h.record_len if h.nrec else 0
    if held < h.nrec:
        return h, f"ends in record {held} of {h.nrec}"
    return h, None


class DbfPartition(InputPartition):
    """Parts (path, size of the file, first byte, last byte) of one task."""

    def __init__(self, parts: list):
        self.parts = parts


def number_text(s: str) -> str | None:
    """The landing text of a numeric field, whatever stands around it."""
    if _WHOLE.match(s):
        return str(int(s))
    try:
        v = float(s)
    except ValueError:
        return None
    if not math.isfinite(v):
        return None
    return str(int(v)) if v == math.floor(v) else repr(v)


def _text(col):
    import numpy as np

    return np.char.strip(np.char.decode(col, "latin1"))


def _convert(kind: str, raw):
    """One field of all records -> list of landing text values."""
    import numpy as np
    import pandas as pd

    s = pd.Series(_text(raw), dtype=object)
    blank = s == ""
    if kind == "C":
        return s.where(~blank, None)
    if kind in ("N", "F"):
        return s.map({v: number_text(v) for v in s.unique()}).astype(object).where(~blank, None)
    if kind == "D":
        d = pd.to_datetime(s, format="%Y%m%d", errors="coerce")
        return d.dt.strftime("%Y-%m-%d").where(d.notna(), None)
    if kind == "L":
        first = s.str[:1]
        return pd.Series(np.where(first.isin(list("TyTt")) & ~blank, "True",
                                  np.where(first.isin(list("NnFf")) & ~blank, "False", None)), dtype=object)
    raise ValueError(f"DBF field type {kind!r} not supported")


_TESTS = {
    EqualTo: lambda s, v: s == v, EqualNullSafe: lambda s, v: s == v if v is not None else s.isna(),
    In: lambda s, v: s.isin([x for x in v if x is not None]), StringStartsWith: lambda s, v: s.str.startswith(v, na=False),
    GreaterThan: lambda s, v: s.map(lambda x: x is not None and x > v), GreaterThanOrEqual: lambda s, v: s.map(lambda x: x is not None and x >= v),
    LessThan: lambda s, v: s.map(lambda x: x is not None and x < v), LessThanOrEqual: lambda s, v: s.map(lambda x: x is not None and x <= v),
    IsNotNull: lambda s, v: s.notna(),
}


class DbfReader(DataSourceReader):
    def __init__(self, options, schema):
        self.options = options
        self.schema = schema
        self.tests: list = []  # (column, kind of filter, value), all settled here

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            value = getattr(f, "value", None)
            if column and type(f) in _TESTS and (value is not None or type(f) in (IsNotNull, EqualNullSafe)):
                self.tests.append((column, type(f), value))
            else:
                yield f

    def partitions(self):
        step, only = int(self.options.get("bytesPerPartition", BYTES_PER_PARTITION)), self.options.get("files")
        names = set(json.loads(only)) if only else None
        out, held, weight = [], [], 0
        for path, size in list_files(self.options["path"], self.options.get("suffix", ".dbf"), self.options.get("store")):
            if names is not None and posixpath.basename(path) not in names:
                continue
            if size > step:
                out += [DbfPartition([(path, size, at, at + step)]) for at in range(0, size, step)]
                continue
            cost = size + min(OPEN_COST, step // 16)
            if held and weight + cost > step:
                out.append(DbfPartition(held))
                held, weight = [], 0
            held.append((path, size, 0, max(size, 1)))
            weight += cost
        return out + [DbfPartition(held)] if held or not out else out

    def read(self, partition: DbfPartition):
        """The records that begin in the parts' bytes, chunk by chunk."""
        for path, size, first, last in partition.parts:
            if self._named(posixpath.basename(path)):
                yield from self._part(path, size, first, last)

    def _named(self, name: str) -> bool:
        """Whether the filters on the lineage column let the file through."""
        import pandas as pd

        one = pd.Series([name], dtype=object)
        return all(bool(_TESTS[kind](one, v).iloc[0]) for c, kind, v in self.tests if c == self.options.get("lineage"))

    def _part(self, path: str, size: int, first: int, last: int):
        import numpy as np
        import pyarrow as pa

        names, lineage = [f.name for f in self.schema.fields], self.options.get("lineage")
        store, own = open_store(path, self.options.get("store"))
        h, wrong = fault(store, own, size)
        if wrong is not None:
            if self.options.get("on_error") == "skip":
                return
            raise OSError(f"{path}: {wrong}")
        if not h.nrec:
            return
        spots, off = {}, 1
        for name, kind, width in h.fields:
            spots[name.upper()] = (kind, off, width)
            off += width
        begun = lambda at: min(h.nrec, max(0, -(-(at - h.header_len) // h.record_len)))
        at, stop = begun(first), begun(last)
        chunk = int(self.options.get("recordsPerBatch", 65_536))
        with store.open_input_file(own) as f:
            f.seek(h.header_len + at * h.record_len)
            while at < stop:
                take = min(chunk, stop - at)
                buf = f.read(take * h.record_len)
                if len(buf) < take * h.record_len:
                    raise OSError(f"{path}: ends in record {at + len(buf) // h.record_len} of {h.nrec}")
                at += take
                rec = np.frombuffer(buf, dtype=np.uint8).reshape(take, h.record_len)
                rec = self._kept(rec[rec[:, 0] == ord(" ")], spots)
                if not len(rec):
                    continue
                arrays = [pa.array([posixpath.basename(path)] * len(rec) if lineage and nm == lineage else list(_field(rec, spots, nm)), pa.string())
                          for nm in names]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    def _kept(self, rec, spots):
        """The records that pass every test, one field decoded at a time."""
        tests = [(c, _TESTS[kind], v) for c, kind, v in self.tests if c != self.options.get("lineage")]
        for column, firsts in json.loads(self.options.get("prefixes") or "{}").items():
            tests.append((column, lambda s, v: s.str.strip().str.upper().str.startswith(v, na=False), tuple(firsts)))
        for column, test, value in tests:
            if not len(rec):
                break
            rec = rec[test(_field(rec, spots, column), value).to_numpy(dtype=bool)]
        return rec


def _field(rec, spots: dict, name: str):
    """The landing text of one field; null throughout where the file has none."""
    import numpy as np
    import pandas as pd

    if name.upper() not in spots:
        return pd.Series([None] * len(rec), dtype=object)
    kind, off, width = spots[name.upper()]
    return _convert(kind, np.ascontiguousarray(rec[:, off:off + width]).view(f"S{width}").ravel())


class DbfDataSource(DataSource):
    """``spark.read.format("dbf")``: every field as a string column."""

    @classmethod
    def name(cls):
        return "dbf"

    def schema(self):
        store = self.options.get("store")
        files = list_files(self.options["path"], self.options.get("suffix", ".dbf"), store)
        names: list[str] = []
        # layouts drift between deliveries: the schema is the union of all
        # headers by name (case-insensitive), in order of first appearance
        for p, size in files if self.options.get("mergeSchema", "true") == "true" else files[:1]:
            h, wrong = fault(*open_store(p, store), size)
            if h is None or wrong is not None and self.options.get("on_error") == "skip":
                continue
            for name, _, _ in h.fields:
                if name.upper() not in {x.upper() for x in names}:
                    names.append(name)
        if self.options.get("lineage"):
            names.append(self.options["lineage"])
        return ", ".join(f"`{n}` string" for n in names)

    def reader(self, schema):
        return DbfReader(self.options, schema)


def register(spark) -> None:
    from ..session import ship_package

    ship_package(spark)
    spark.dataSource.register(DbfDataSource)


def scan(spark, path: str, schema: str | None = None, prefixes: dict | None = None, files: list | None = None, **options):
    """The DBF files under ``path``.  A path without a scheme is taken where
    Spark would take it, so executors open what the driver listed.
    ``prefixes`` ({field: [beginnings]}) keeps records whose field, stripped
    and upper-cased, begins with one of them; ``files`` keeps files by name;
    ``suffix`` is the ending of the files' names (``.dbf``)."""
    from ..session import qualified

    register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    if prefixes:
        options["prefixes"] = json.dumps(prefixes)
    if files is not None:
        options["files"] = json.dumps(sorted(files))
    reader = spark.read.format("dbf").options(store=store_options(spark), **options)
    return (reader.schema(schema) if schema else reader).load(qualified(spark, path))


REPORT = "ARQUIVO string, CAMINHO string, TAMANHO long, REGISTROS long, MOTIVO string"


def read_report(spark, path: str, suffix: str = ".dbf"):
    """One row for each file under ``path``: name, path, size, records by its
    header, and why it cannot be read (null where it can).  Headers are read
    in the tasks; ``scan`` with ``on_error="skip"`` reads the same files."""
    from ..session import qualified

    register(spark)
    options = store_options(spark)
    listed = list_files(qualified(spark, path), suffix, options)
    frame = spark.createDataFrame(listed, "CAMINHO string, TAMANHO long").repartition(min(max(1, len(listed)), 200))

    def look(batches):
        import pandas as pd

        for pdf in batches:
            told = [fault(*open_store(p, options), size) for p, size in zip(pdf["CAMINHO"], pdf["TAMANHO"])]
            yield pd.DataFrame({"ARQUIVO": pdf["CAMINHO"].map(posixpath.basename), "CAMINHO": pdf["CAMINHO"], "TAMANHO": pdf["TAMANHO"],
                                "REGISTROS": pd.array([h.nrec if h else None for h, _ in told], dtype="Int64"),
                                "MOTIVO": pd.Series([w for _, w in told], dtype=object, index=pdf.index)})

    return frame.mapInPandas(look, REPORT)


# --- writer (test fixtures): one DBF file per Spark partition -----------------------------

def dbf_bytes(columns: dict, fields: list, deleted=None) -> bytes:
    """Encode ``columns`` (name -> list of str/None) as a dBase III file.
    ``fields`` = [(name, type, size)]; ``deleted`` = per-record bool."""
    import pandas as pd

    n = len(next(iter(columns.values()))) if columns else 0
    flags = pd.Series(["*" if d else " " for d in deleted] if deleted is not None else [" "] * n, dtype=object)
    return _head(n, fields) + "".join(_lines(flags, columns, fields)).encode("latin1", "replace") + END


END = b"\x1a"


def _head(n: int, fields: list) -> bytes:
    """Header of a file of ``n`` records."""
    rlen = 1 + sum(s for _, _, s in fields)
    out = bytearray(struct.pack("<BBBBIHH20x", 3, 124, 1, 1, n, 32 + 32 * len(fields) + 1, rlen))
    for name, kind, size in fields:
        out += struct.pack("<11sc4xBB14x", name.encode("latin1")[:11], kind.encode(), size, 0)
    return bytes(out + b"\r")


def _lines(flags, columns: dict, fields: list):
    """The records as text, behind their deletion flags."""
    import pandas as pd

    lines = flags
    for name, kind, size in fields:
        text = pd.Series(columns[name], dtype=object).map(lambda v: "" if v is None else str(v)).str.slice(0, size)
        lines = lines + (text.str.rjust(size) if kind in ("N", "F") else text.str.ljust(size))
    return lines


def write_partitions(df, folder: str, fields: list, deleted_col: str | None = None):
    """Write each partition of ``df`` as DBF files under ``folder`` (executor
    side, via ``mapInPandas``); returns the (file, rows) DataFrame.  File
    names come from the partition id and batch number, so a task retried
    after a lost executor overwrites its own files instead of adding copies."""

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext

        fs, root = open_store(folder)
        part = TaskContext.get().partitionId()
        for i, pdf in enumerate(batches):
            if len(pdf) == 0:
                continue
            cols = {name: [None if pd.isna(x) else x for x in pdf[name]] for name, _, _ in fields}
            deleted = list(pdf[deleted_col]) if deleted_col else None
            name = f"part-{part:05d}-{i:05d}.dbf"
            with fs.open_output_stream(posixpath.join(root, name)) as f:
                f.write(dbf_bytes(cols, fields, deleted))
            yield pd.DataFrame({"arquivo": [name], "linhas": [len(pdf)]})

    fs, root = open_store(folder)
    fs.create_dir(root, recursive=True)
    return df.mapInPandas(write, "arquivo string, linhas long")


def write_files(df, folder: str, fields: list, name: str):
    """Write the rows of each value of ``name`` as the DBF file of that name
    under ``folder``, over what is there; returns the (file, rows) DataFrame.
    Records are encoded where the rows lie, batch by batch, and one task per
    file puts them behind the header (``files.write_named``)."""
    from pyspark.sql import functions as F

    def encode(batches):
        import pandas as pd

        for pdf in batches:
            cols = {n: [None if pd.isna(x) else x for x in pdf[n]] for n, _, _ in fields}
            lines = _lines(pd.Series([" "] * len(pdf), dtype=object), cols, fields)
            yield pd.DataFrame({"arquivo": pdf[name], "registro": [x.encode("latin1", "replace") for x in lines]})

    sizes = df.groupBy(F.col(name).alias("arquivo")).agg(F.count("*").alias("total"))
    return write_named(df.mapInPandas(encode, "arquivo string, registro binary"), folder, sizes, lambda n: _head(n, fields), END)
