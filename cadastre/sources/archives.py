"""S7 expand_archives as a Spark job.

Input: a DataFrame with one row per archive path.  Each task opens one archive
through ``pyarrow.fs`` (local, HDFS, S3, GCS, Azure) and streams every member
into ``<target>/<archive stem>/<member>`` in fixed-size chunks, so a multi-GB
member never sits in memory and never passes through the driver
(``binaryFile`` would cap a row at 2 GB).  A member is written under a name of
its own attempt and then renamed, so a retried or speculative task never
touches what another attempt writes, and a half-written file is never seen.
Directories and names that clean to a leading ``..`` are skipped.  Output:
(archive, member, path, bytes).

An archive is one unit.  With ``errors`` one that cannot be expanded whole (no zip
file, a cut or damaged member, a wrong checksum, not there) gives a single row
without a member that says why, and the others' rows stand; without, it fails
the job.  Faults of the storage itself fail the task, which Spark retries.
"""

from __future__ import annotations

import posixpath
import re
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Task code of this module travels by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 8 * 1024 * 1024
#: Names of files that readers decompress as they are.
COMPRESSED = (".gz", ".gzip", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd", ".lzo", ".xz")
MEMBER_SCHEMA = "archive string, member string, path string, bytes bigint"


#: Schemes of Hadoop connectors, under the names that pyarrow has for the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _fs(uri: str):
    """File system and path of a URI; no scheme, or ``file:``, is local."""
    from pyarrow import fs

    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]+):(.*)", uri)
    scheme, rest = found.groups() if found else ("file", uri)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if rest.startswith("/") else rest
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def stem_of(archive: str) -> str:
    """The name of the folder that an archive is expanded into."""
    stem = posixpath.basename(archive)
    return stem[:-4] if stem.lower().endswith(".zip") else stem


def safe_member(name: str) -> str | None:
    """Cleaned relative member path, or None for directories and escapes."""
    if name.endswith("/"):
        return None
    clean = posixpath.normpath(name.replace("\\", "/")).lstrip("/")
    if clean.startswith("..") or clean in ("", "."):
        return None
    return clean


def _expand(target: str, column: str, errors: bool, compress: int):
    def members(archive: str, out_fs, out_root: str):
        import zipfile
        import zlib

        in_fs, in_path = _fs(archive)
        stem = stem_of(in_path)
        with in_fs.open_input_file(in_path) as fh, zipfile.ZipFile(fh) as zf:
            for info in zf.infolist():
                rel = safe_member(info.filename)
                if rel is None or info.is_dir():
                    continue
                pressed = info.file_size <= compress and not rel.lower().endswith(COMPRESSED)
                name = f"{rel}.gz" if pressed else rel
                dest = f"{out_root.rstrip('/')}/{stem}/{name}"
                out_fs.create_dir(posixpath.dirname(dest), recursive=True)
                n = 0
                attempt = f"{posixpath.dirname(dest)}/_{uuid.uuid4().hex}"
                try:
                    with zf.open(info) as src, out_fs.open_output_stream(attempt) as dst:
                        gzip = zlib.compressobj(1, zlib.DEFLATED, 31) if pressed else None
                        while True:
                            buf = src.read(CHUNK)
                            if not buf:
                                break
                            dst.write(gzip.compress(buf) if gzip else buf)
                            n += len(buf)
                        if gzip:
                            dst.write(gzip.flush())
                except Exception:
                    out_fs.delete_file(attempt)
                    raise
                out_fs.move(attempt, dest)
                yield archive, rel, f"{target.rstrip('/')}/{stem}/{name}", n, None

    def run(batches):
        import zipfile
        import zlib

        import pandas as pd
        import pyarrow as pa

        # (a seek before a short file's start is ArrowInvalid)
        damaged = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, FileNotFoundError, pa.ArrowInvalid)
        out_fs, out_root = _fs(target)
        for pdf in batches:
            rows = []
            for archive in pdf[column]:
                try:
                    rows += list(members(archive, out_fs, out_root))
                except damaged as e:
                    if not errors:
                        raise
                    rows.append((archive, None, None, 0, f"{type(e).__name__}: {e}"))
            out = pd.DataFrame(rows, columns=["archive", "member", "path", "bytes", "error"])
            yield out if errors else out.drop(columns="error")

    return run


def _spread(df: DataFrame, column: str) -> DataFrame:
    """One file per task: a range with one id in each partition, to which the
    list (metadata-sized) is joined by its row number.  A hash of the name, or a
    round robin from several partitions, would put several into one task."""
    listed = df.withColumn("_n", F.row_number().over(Window.orderBy(column)) - 1)
    n = max(1, df.count())
    ids = df.sparkSession.range(0, n, 1, n).withColumnRenamed("id", "_n")
    return ids.join(F.broadcast(listed), "_n").drop("_n").select(*df.columns)


def expand_archives(archives: DataFrame, target_dir: str, column: str = "archive", errors: bool = False, compress: int = -1) -> DataFrame:
    """One output row per extracted member (one archive per task); with
    ``errors`` also one of each archive that cannot be expanded, and why.  A member
    of up to ``compress`` bytes is written with gzip, as ``<member>.gz``: for files that
    one task reads whole anyway."""
    schema = MEMBER_SCHEMA + (", error string" if errors else "")
    return _spread(archives.select(column), column).mapInPandas(_expand(target_dir, column, errors, compress), schema)


def list_files(root: str, suffix: str = "") -> list[str]:
    """Driver-side listing of file names under ``root`` (metadata only)."""
    from pyarrow import fs

    f, base = _fs(root)
    infos = f.get_file_info(fs.FileSelector(base, recursive=True))
    return sorted(
        root.rstrip("/") + i.path[len(base.rstrip("/")) :]
        for i in infos
        if i.type == fs.FileType.File and i.path.endswith(suffix) and not posixpath.basename(i.path).startswith(("_", "."))
    )


PACK_SCHEMA = "archive string, member string, bytes bigint"


def _pack(column_src: str, column_archive: str, column_member: str):
    def run(batches):
        import zipfile

        import pandas as pd

        for pdf in batches:
            rows = []
            for src, arc, mem in zip(pdf[column_src], pdf[column_archive], pdf[column_member]):
                in_fs, in_path = _fs(src)
                out_fs, out_path = _fs(arc)
                out_fs.create_dir(posixpath.dirname(out_path), recursive=True)
                n = 0
                with out_fs.open_output_stream(out_path) as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as zf:
                    with in_fs.open_input_stream(in_path, compression="detect") as fh, zf.open(mem, "w", force_zip64=True) as dst:
                        while True:
                            buf = fh.read(CHUNK)
                            if not buf:
                                break
                            dst.write(buf)
                            n += len(buf)
                rows.append((arc, mem, n))
            yield pd.DataFrame(rows, columns=["archive", "member", "bytes"])

    return run


def pack_archives(files: DataFrame, src: str = "src", archive: str = "archive", member: str = "member") -> DataFrame:
    """Inverse of S7 (used to stage test months): zip each source file (of a ``.gz`` what
    it holds) into its own archive under the given member name, one file per task."""
    return _spread(files.select(src, archive, member), archive).select(src, archive, member).mapInPandas(_pack(src, archive, member), PACK_SCHEMA)
