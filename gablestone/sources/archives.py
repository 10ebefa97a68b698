"""Members of ZIP archives: directories are read from the archives' ends, members by their own ranges.

An archive's path travels, not its bytes: a task opens it as a seekable file and reads the directory or the members that it
has been dealt, so that an archive of any size is many tasks and no value. A path that only Spark can open is read
as a whole, in the task. What is broken (an archive, a member, a name that leaves the archive) is a row with an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBERS = "archive string, path string, ordinal int, member string, suffix string, size long, packed long, error string"
#: Members of a task.
DEALT = 256


def opened(path: str):
    """The archive at a path of the local or a remote file system that pyarrow knows."""
    import zipfile
    from urllib.parse import unquote

    from pyarrow import fs

    where, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), unquote(path.removeprefix("file:")))
    return zipfile.ZipFile(where.open_input_file(unquote(inner) if where.type_name == "local" else inner))


def directory(spark: SparkSession, path: str) -> DataFrame:
    """archive, path, ordinal, member, suffix, size, packed and error of the files in archives; a broken archive has one row."""

    def run(batches):
        from pathlib import PurePosixPath

        import pandas as pd

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                name = path.rpartition("/")[2]
                try:
                    with opened(path) as archive:
                        found = [m for m in archive.infolist() if not m.is_dir()]
                except Exception as e:  # whatever is wrong with it, the others are read
                    rows.append((name, path, None, None, None, None, None, f"{type(e).__name__}: {e}"))
                    continue
                for k, m in enumerate(found):
                    p = PurePosixPath(m.filename.replace("\\", "/"))
                    outside = p.is_absolute() or ".." in p.parts
                    rows.append((name, path, k, m.filename, p.suffix.lower(), m.file_size, m.compress_size, "outside the archive" if outside else None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in MEMBERS.split(", ")]).astype({"ordinal": "Int32", "size": "Int64", "packed": "Int64"})

    return spark.read.format("binaryFile").load(path).select("path").mapInPandas(run, MEMBERS)


def contents(members: DataFrame, most: int = 1 << 28) -> DataFrame:
    """members (of directory(), all or some) with their content and the error of those that cannot be read or have more than
    `most` bytes. They are dealt out DEALT to a task, those of one archive side by side."""
    tasks = max(1, -(-members.count() // DEALT))
    kinds = ", ".join(f"`{c}` {t}" for c, t in members.dtypes if c != "error")
    own = [c for c in members.columns if c != "error"]

    def run(batches):
        import pandas as pd

        archive, at = None, None
        for pdf in batches:
            data, errors = [], []
            for path, member, size, error in pdf[["path", "member", "size", "error"]].itertuples(index=False):
                content = None
                if error is None and size > most:
                    error = f"more than {most} bytes"
                if error is None:
                    try:
                        if path != at:
                            archive, at = opened(path), path
                        content = archive.read(member)
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                data.append(content)
                errors.append(error)
            yield pdf[own].assign(content=data, error=errors)

    dealt = members.repartitionByRange(tasks, "path", "ordinal") if tasks > 1 else members.coalesce(1)
    return dealt.mapInPandas(run, f"{kinds}, content binary, error string")
