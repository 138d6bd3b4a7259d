"""Byte access to files outside Spark's readers, for headers and footers.

Spark names object stores by Hadoop's schemes.  The same files are opened here
through Arrow, with Hadoop's names mapped to Arrow's, so the DBF tasks and the
catalogue read the paths that Spark reads.  Credentials come from the
machine's environment; an endpoint or region that the session has for
``s3a://`` is passed on by ``store_options``.
"""

from __future__ import annotations

import json
import posixpath
import re

#: Hadoop's schemes -> Arrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "abfs": "abfss", "wasbs": "abfss"}
#: Hadoop's setting -> the argument of Arrow's S3 file system.
S3_SETTINGS = {"fs.s3a.endpoint": "endpoint_override", "fs.s3a.endpoint.region": "region"}


def open_store(uri: str, options: str | None = None):
    """(file system, path in it) of a path as Spark writes it."""
    from pyarrow import fs as pafs

    scheme, _, rest = uri.partition(":")
    if not rest.startswith("/") or len(scheme) < 2:
        return pafs.LocalFileSystem(), uri
    if scheme == "file":
        return pafs.LocalFileSystem(), re.sub(r"^/+", "/", rest)
    scheme = SCHEMES.get(scheme, scheme)
    if scheme == "s3":
        return pafs.S3FileSystem(**json.loads(options or "{}")), rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{scheme}:{rest}")


def store_options(spark) -> str:
    """What tasks need of the session's settings to open its stores, as JSON."""
    conf = spark._jsc.hadoopConfiguration()
    found = {name: conf.get(key) for key, name in S3_SETTINGS.items()}
    return json.dumps({k: v for k, v in found.items() if v})


def list_files(uri: str, suffix: str = "", options: str | None = None) -> list[tuple[str, int]]:
    """(path as Spark writes it, size) under a file or folder, sorted; names
    that begin with a stop or underscore are left out, as Spark does."""
    from pyarrow import fs as pafs

    store, root = open_store(uri, options)
    info = store.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(root, recursive=True))
    lead = uri[: uri.index("://") + 3] if "://" in uri else ""
    return sorted((lead + (i.path if lead != "file://" else "/" + i.path.lstrip("/")), i.size) for i in found
                  if i.type == pafs.FileType.File and i.path.lower().endswith(suffix) and not posixpath.basename(i.path).startswith((".", "_")))


def write_named(df, folder: str, sizes=None, head=None, tail: bytes = b""):
    """Write ``df`` (arquivo, registro binary): the rows of each name, in
    their order, as the file of that name under ``folder``, over what is
    there; returns the (arquivo, linhas) DataFrame.  ``head`` makes the bytes
    before the rows from their number, which ``sizes`` (arquivo, total) tells;
    ``tail`` ends the file.  One task writes a file, row by row: its memory
    does not follow the file's size."""
    from pyspark.sql import functions as F

    spark = df.sparkSession
    options = store_options(spark)
    store, root = open_store(folder, options)
    store.create_dir(root, recursive=True)
    rows = df.select("arquivo", F.lit(None).cast("long").alias("total"), F.monotonically_increasing_id().alias("o"), "registro")
    if sizes is not None:
        # as a row before the name's others, not by a join: one that becomes a broadcast while it runs
        # reads its rows where they were written, after Spark has left out the repartition below
        first = sizes.select("arquivo", "total", F.lit(-1).cast("long").alias("o"), F.lit(None).cast("binary").alias("registro"))
        rows = first.unionByName(rows)
    # as many parts as asked for: few small rows can be very many files
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "arquivo").sortWithinPartitions("arquivo", "o").drop("o")

    def write(batches):
        import pyarrow as pa

        store, root = open_store(folder, options)
        out, name, told, n = None, None, None, 0
        done: tuple = ([], [])

        def end():
            if told is not None and n != told:
                raise OSError(f"{name}: {n} rows, {told} counted")
            out.write(tail)
            out.close()
            done[0].append(name)
            done[1].append(n)

        for batch in batches:
            at, names = 0, batch.column(0).to_pylist()
            while at < len(names):
                if out is None or names[at] != name:
                    if out is not None:
                        end()
                    if names[at] is None:
                        raise ValueError("a row without the name of its file")
                    name, told, n = names[at], batch.column(1)[at].as_py(), 0
                    out = store.open_output_stream(posixpath.join(root, name))
                    out.write(head(told) if head is not None else b"")
                    if told is not None:  # the row of the number itself
                        at += 1
                        continue
                to = at + 1
                while to < len(names) and names[to] == name:
                    to += 1
                out.write(b"".join(batch.column(2).slice(at, to - at).to_pylist()))
                n, at = n + to - at, to
            if len(done[0]) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.string()), pa.array(done[1], pa.int64())], names=["arquivo", "linhas"])
                done = ([], [])
        if out is not None:
            end()
        if done[0]:
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.string()), pa.array(done[1], pa.int64())], names=["arquivo", "linhas"])

    return rows.mapInArrow(write, "arquivo string, linhas long")
