"""One JSON file for each key, through a data source that shows files only once the whole write has succeeded."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

STAGING = "_staging"
NO_VALUE, EMPTY = "%00", "%20%00"
KEYS = ("category", "year", "month", "subcategory")


def file_name(value: str | None) -> str:
    """A key value as one path part: what would break a path, or hide a file, is percent-encoded. A dot ends a name, so it is too."""
    if value is None:
        return NO_VALUE
    if not value:
        return EMPTY
    kept = "".join("%2E" if c == "." else quote(c, safe="") if c in '/\\%:?#*<>|"{}[]' or ord(c) < 32 else c for c in value)
    return "%5F" + kept[1:] if kept[0] == "_" else kept


def decoded(path) -> Column:
    """A path as it was written, from the form in which Spark reports it; plus signs stay."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def original(name: Column) -> Column:
    """The key value of a path part."""
    return F.when(name == NO_VALUE, F.lit(None)).when(name == EMPTY, F.lit("")).otherwise(decoded(name))


@dataclass
class Written(WriterCommitMessage):
    """Files of one task, relative to its staging folder and to the root alike."""

    folder: str
    files: list[str]


def _file_system(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root.removeprefix("file:"))


class KeyedJsonWriter(DataSourceWriter):
    """Tasks write below a staging folder of this run; the commit moves what successful tasks report and drops the rest."""

    def __init__(self, options: dict, columns: list[str], overwrite: bool):
        self.root, self.overwrite = options["path"].rstrip("/"), overwrite
        self.keys = json.loads(options["keys"])
        self.rest = [c for c in columns if c not in self.keys]
        self.run = uuid.uuid4().hex

    def _record(self, row: Row) -> bytes:
        def plain(value):
            if isinstance(value, Row):
                return {k: plain(v) for k, v in value.asDict().items()}
            if isinstance(value, dict):
                return {str(k): plain(v) for k, v in value.items()}
            if isinstance(value, (list, tuple)):
                return [plain(v) for v in value]
            return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)

        return json.dumps({c: plain(row[c]) for c in self.rest}, ensure_ascii=False).encode()

    def write(self, iterator: Iterator[Row]) -> Written:
        files, base = _file_system(self.root)
        # a repeated or speculative attempt writes elsewhere and is never reported
        folder = f"{STAGING}/{self.run}/{uuid.uuid4().hex}"
        done, key, out = [], None, None
        try:
            for row in iterator:
                here = tuple(row[c] for c in self.keys)
                if out is None or here != key:
                    if out is not None:
                        out.write(b"]")
                        out.close()
                    key, parts = here, [file_name(None if v is None else str(v)) for v in here]
                    done.append("/".join(parts) + ".json")
                    files.create_dir("/".join([base, folder, *parts[:-1]]), recursive=True)
                    out = files.open_output_stream(f"{base}/{folder}/{done[-1]}")
                    out.write(b"[" + self._record(row))
                else:
                    out.write(b"," + self._record(row))
            if out is not None:
                out.write(b"]")
        finally:
            if out is not None:
                out.close()
        return Written(folder, done)

    def commit(self, messages: list[Written | None]) -> None:
        files, base = _file_system(self.root)
        moves = [(m.folder, name) for m in messages if m for name in m.files]
        if len({name for _, name in moves}) < len(moves):
            raise ValueError("a key was written by two tasks: deal the rows by their keys first")
        if self.overwrite:
            self._clear(files, base)
        for folder in sorted({f"{base}/{name}".rsplit("/", 1)[0] for _, name in moves}):
            files.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda m: files.move(f"{base}/{m[0]}/{m[1]}", f"{base}/{m[1]}"), moves))
        self._drop(files, base)
        with files.open_output_stream(f"{base}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        self._drop(*_file_system(self.root))

    def _clear(self, files, base: str) -> None:
        """Remove the files of earlier writes, but for anyone's staging."""
        from pyarrow import fs

        for entry in files.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            if entry.base_name != STAGING:
                (files.delete_dir if entry.type == fs.FileType.Directory else files.delete_file)(entry.path)

    def _drop(self, files, base: str) -> None:
        from pyarrow import fs

        staging = f"{base}/{STAGING}"
        if files.get_file_info(f"{staging}/{self.run}").type == fs.FileType.Directory:
            files.delete_dir(f"{staging}/{self.run}")
        if files.get_file_info(staging).type == fs.FileType.Directory and not files.get_file_info(fs.FileSelector(staging)):
            files.delete_dir(staging)


class KeyedJson(DataSource):
    """``df.write.format("keyed_json")`` with options path and keys (a JSON list of columns, the last names the file)."""

    @classmethod
    def name(cls) -> str:
        return "keyed_json"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return KeyedJsonWriter(dict(self.options), schema.names, overwrite)


def write_file_per_key(df: DataFrame, root: str, keys: Sequence[str] = KEYS, order: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Write ``root/key1/key2/.../last key.json``, a JSON list of the key's rows (without the keys), sorted by ``order``.

    Rows are dealt by key and sorted inside their task, which streams one file after the other, so a large key costs no more
    memory than a small one. Nothing is visible below ``root`` before all tasks are done, and a write that fails leaves
    nothing behind. ``append`` adds or replaces files by key, ``overwrite`` removes all files of earlier writes as well.
    Names that a path can't carry are percent-encoded; :func:`original` turns them back. ``root`` is a folder that driver and
    executors share, or an address that pyarrow opens (hdfs, s3, gs).
    """
    df.sparkSession.dataSource.register(KeyedJson)
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    dealt.write.format("keyed_json").option("path", root).option("keys", json.dumps(list(keys))).mode(mode).save()
    return root
