"""Sets of files written by data source writers, which count once their job has committed.

Every task attempt writes a file under a name of its own.  The commit on the driver writes one manifest that
names the files of the attempts that succeeded; files of lost or repeated attempts stay unnamed and are never
read.  Nothing is renamed, which object stores cannot do at once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

MANIFEST = "_committed-"


def located(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and plain path of an address; addresses of local files come as /x, file:/x or file:///x."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return arrow_fs.FileSystem.from_uri(path)
    return arrow_fs.LocalFileSystem(), path


def listed(path: str, suffixes: tuple[str, ...]) -> list[tuple[str, int]]:
    """(path, bytes) of the committed files below an address, or of all with these suffixes where no job committed.

    A single file stands for itself; names beginning with ``_`` or ``.`` are not data.
    """
    fs, root = located(path)
    info = fs.get_file_info(root)
    if info.type == arrow_fs.FileType.File:
        return [(root, info.size)]
    if info.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [f for f in fs.get_file_info(arrow_fs.FileSelector(root, recursive=True)) if f.type == arrow_fs.FileType.File]
    names = [f for f in found if f.base_name.startswith(MANIFEST)]
    if not names:
        data = [f for f in found if f.base_name.endswith(suffixes) and not f.base_name.startswith(("_", "."))]
        return sorted((f.path, f.size) for f in data)
    jobs = {}
    for f in names:
        with fs.open_input_stream(f.path) as source:
            jobs[f.base_name] = json.loads(source.read())
    replaced = {name for job in jobs.values() for name in job["replaces"]}
    return sorted((f"{root}/{f['name']}", f["bytes"]) for name, job in jobs.items() if name not in replaced for f in job["files"])


def manifests(path: str) -> list[str]:
    fs, root = located(path)
    found = fs.get_file_info(arrow_fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name.startswith(MANIFEST))


def packed(files: list[tuple[str, int]], most_bytes: int) -> list[list[str]]:
    """Whole files in partitions of up to ``most_bytes``; a larger file has one of its own."""
    parts: list[list[str]] = []
    filled = 0
    for path, size in files:
        if not parts or filled + size > most_bytes:
            parts.append([])
            filled = 0
        parts[-1].append(path)
        filled += size
    return parts


@dataclass
class Stored(WriterCommitMessage):
    """The file of one task attempt; a task without rows writes none."""

    name: str | None
    size: int = 0
    rows: int = 0


class FileSetWriter(DataSourceArrowWriter):
    """One file a task; ``encoded`` turns a record batch into bytes and their number of rows."""

    suffix = ""

    def __init__(self, path: str, overwrite: bool = False):
        self.path = path
        self.replaces = manifests(path) if overwrite else []

    def encoded(self, batch) -> tuple[bytes, int]:
        raise NotImplementedError

    def write(self, iterator) -> Stored:
        fs, root = located(self.path)
        name, out, rows = f"part-{uuid.uuid4().hex}{self.suffix}", None, 0
        for batch in iterator:
            data, n = self.encoded(batch)
            if not n:
                continue
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            out.write(data)
            rows += n
        if out is None:
            return Stored(None)
        size = out.tell()
        out.close()
        return Stored(name, size, rows)

    def commit(self, messages) -> None:
        fs, root = located(self.path)
        files = [{"name": m.name, "bytes": m.size, "rows": m.rows} for m in messages if m is not None and m.name]
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"replaces": self.replaces, "files": files}).encode())

    def abort(self, messages) -> None:
        fs, root = located(self.path)
        for m in messages:
            if m is not None and m.name:
                fs.delete_file(f"{root}/{m.name}")
