"""File listing, partition folders and byte-range splits shared by every LAS source."""

from __future__ import annotations

import fnmatch
import json
import os
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import quote, unquote

import pyarrow.fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import InputPartition

from lidarframe.sources.journal import overlay, pending

MIB = 1024 * 1024
DEFAULT_SPLIT_BYTES = 128 * MIB  # like spark.sql.files.maxPartitionBytes
OPEN_COST = MIB  # what opening a file weighs when files are packed into tasks
MAX_SPLITS = 100_000
LIST_THREADS = 16
FILES_PER_TASK = 512  # headers read by one task
_listed: ContextVar[dict | None] = ContextVar("listed", default=None)
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def flag(options, name: str, default: bool = False) -> bool:
    value = options.get(name)
    return default if value is None else str(value).strip().lower() == "true"


@lru_cache(maxsize=64)
def filesystem(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and its inner path; a path without a scheme is on the (shared) local mount."""
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    if "://" not in root:
        return pafs.LocalFileSystem(), os.path.abspath(root)
    scheme, host, path, query = _uri_parts(root)
    # spaces and wildcards are plain characters in Spark paths but not in URIs
    fs, inner = pafs.FileSystem.from_uri(f"{scheme}://{host}{quote(path)}{query}")
    return fs, inner


def _uri_parts(uri: str) -> tuple[str, str, str, str]:
    """Scheme, host, path and connection options (``?region=..``) of a URI."""
    scheme, _, rest = uri.partition("://")
    query = re.search(r"\?\w+=.*$", rest)
    rest, query = (rest[: query.start()], query[0]) if query else (rest, "")
    host, slash, path = rest.partition("/")
    return re.sub("^s3[an]$", "s3", scheme), host, slash + path, query


@dataclass(frozen=True)
class FileEntry:
    root: str  # as given by the user; names the file system
    path: str  # inside that file system
    size: int
    mtime_ns: int
    keys: tuple[tuple[str, str | None], ...]  # k=v folders below the root

    @property
    def name(self) -> str:
        """Path as users see it: with scheme and host unless it is local."""
        if "://" not in self.root or self.root.startswith("file:"):
            return self.path
        scheme, host, _, _ = _uri_parts(self.root)
        return f"{scheme}://{host if self.path.startswith('/') else ''}{self.path}"


@dataclass(frozen=True)
class ByteRange:
    file: FileEntry
    start: int
    end: int


@dataclass
class RangePartition(InputPartition):
    """Byte ranges read by one task: part of a large file, or several small files."""

    ranges: list[ByteRange]


@dataclass
class FilePartition(InputPartition):
    files: list[FileEntry]


def given_paths(options) -> list[str]:
    if options.get("paths"):
        return list(json.loads(options["paths"]))
    if options.get("path"):
        return [options["path"]]
    raise ValueError("no path: use load(path) or the option 'path'")


def hidden(name: str) -> bool:
    return name.startswith((".", "_")) and "=" not in name


def _alternatives(pattern: str) -> list[str]:
    found = re.search(r"\{([^{}]*)\}", pattern)
    if not found:
        return [pattern]
    head, tail = pattern[: found.start()], pattern[found.end():]
    return [p for part in found[1].split(",") for p in _alternatives(head + part + tail)]


def expand(fs: pafs.FileSystem, path: str) -> list[pafs.FileInfo]:
    """File infos of a path, which may hold the wildcards * ? [..] {a,b}."""
    if not re.search(r"[*?\[{]", path):
        return [fs.get_file_info(path)]
    # a file may carry a wildcard character in its own name
    literal = fs.get_file_info(path)
    if literal.type != pafs.FileType.NotFound:
        return [literal]
    found: dict[str, pafs.FileInfo] = {}
    for pattern in _alternatives(path):
        segments = pattern.split("/")
        fixed = next((i for i, s in enumerate(segments) if re.search(r"[*?\[]", s)), len(segments))
        level = [fs.get_file_info("/".join(segments[:fixed]) or "/")]
        for segment in segments[fixed:]:
            level = [
                child
                for parent in level
                if parent.type == pafs.FileType.Directory
                for child in fs.get_file_info(pafs.FileSelector(parent.path))
                if fnmatch.fnmatchcase(child.base_name, segment)
                and not hidden(child.base_name)
            ]
        found.update((i.path, i) for i in level if i.type != pafs.FileType.NotFound)
    return [found[p] for p in sorted(found)]


@contextmanager
def one_listing() -> Iterator[None]:
    """Within it, the same paths are listed once: a query's columns, pruning and modes see the same files."""
    known = _listed.get()
    token = _listed.set({} if known is None else known)
    try:
        yield
    finally:
        _listed.reset(token)


def list_files(options) -> list[FileEntry]:
    """Data files below the given paths in path order; names starting with _ or . are skipped."""
    known = _listed.get()
    if known is None:
        return _list_files(options)
    key = (*given_paths(options), options.get("pathGlobFilter"), options.get("basePath"))
    if key not in known:
        known[key] = _list_files(options)
    return known[key]


def _list_files(options) -> list[FileEntry]:
    name_filter = options.get("pathGlobFilter")
    entries: list[FileEntry] = []
    with ThreadPoolExecutor(LIST_THREADS) as pool:
        for root in given_paths(options):
            fs, inner = filesystem(root)
            tops = expand(fs, inner)
            if not tops or tops[0].type == pafs.FileType.NotFound:
                raise FileNotFoundError(f"path does not exist: {root}")
            for top in tops:
                base = base_folder(options, top)
                found = []
                for info, path in _visible(fs, top, pool):
                    below = path[len(base):].split("/")
                    if info is not top and any(hidden(part) for part in below):
                        continue
                    if name_filter and not fnmatch.fnmatchcase(below[-1], name_filter):
                        continue
                    keys = folder_keys(below[:-1])
                    found.append(FileEntry(root, info.path, info.size, info.mtime_ns or 0, keys))
                entries.extend(sorted(found, key=lambda e: e.path))
    return entries


def base_folder(options, top: pafs.FileInfo) -> str:
    """Folder below which k=v folders count: the option ``basePath``, else the path that is read."""
    if options.get("basePath"):
        base = filesystem(options["basePath"])[1].rstrip("/") + "/"
        if not top.path.startswith(base):
            raise ValueError(f"{top.path} is not below basePath {options['basePath']}")
        return base
    return (top.path if top.type == pafs.FileType.Directory else os.path.dirname(top.path)).rstrip("/") + "/"


def _visible(
    fs: pafs.FileSystem, top: pafs.FileInfo, pool: ThreadPoolExecutor
) -> Iterable[tuple[pafs.FileInfo, str]]:
    """Files of a folder and the paths they count as, with regard to commits whose files are still being moved."""
    journals = pending(fs, top.path) if top.type == pafs.FileType.Directory else []
    if not journals:
        return ((info, info.path) for info in _files_below(fs, top, pool))
    staged = fs.get_file_info(pafs.FileSelector(f"{top.path}/_temporary", recursive=True, allow_not_found=True))
    return overlay(fs, top.path, journals, staged, list(_files_below(fs, top, pool)))


def _files_below(
    fs: pafs.FileSystem, top: pafs.FileInfo, pool: ThreadPoolExecutor
) -> Iterator[pafs.FileInfo]:
    """All files of a folder; its sub-folders are listed side by side."""
    level = fs.get_file_info(pafs.FileSelector(top.path)) if top.type == pafs.FileType.Directory else [top]
    folders = [i.path for i in level if i.type == pafs.FileType.Directory and not hidden(i.base_name)]
    deeper = pool.map(lambda p: fs.get_file_info(pafs.FileSelector(p, recursive=True)), folders)
    for infos in (level, *deeper):
        yield from (i for i in infos if i.type == pafs.FileType.File)


def folder_keys(folders: list[str]) -> tuple[tuple[str, str | None], ...]:
    pairs = (f.split("=", 1) for f in folders if "=" in f[1:])
    return tuple((k, None if v == NULL_PARTITION else unquote(v)) for k, v in pairs)


def folder_choice(options) -> set | None:
    """The option ``folders``: the combinations of k=v folders to read, None for all."""
    text = options.get("folders")
    return {tuple(tuple(pair) for pair in keys) for keys in json.loads(text)} if text else None


def has_key_folders(options) -> bool:
    """Cheap look at the first folder level, so that plain folders are not listed twice."""
    if options.get("basePath"):
        return True
    for root in given_paths(options):
        fs, inner = filesystem(root)
        for top in expand(fs, inner):
            if top.type == pafs.FileType.Directory and any(
                "=" in child.base_name for child in fs.get_file_info(pafs.FileSelector(top.path))
            ):
                return True
    return False


def partition_fields(options) -> list[T.StructField]:
    """Columns named by k=v folders, typed int, long, double or string by all their values."""
    if not has_key_folders(options):
        return []
    values: dict[str, set[str]] = {}
    for entry in list_files(options):
        for key, value in entry.keys:
            values.setdefault(key, set()).update([] if value is None else [value])
    return [T.StructField(k, _value_type(v), True) for k, v in values.items()]


def _value_type(values: set[str]) -> T.DataType:
    if values and all(re.fullmatch(r"-?(0|[1-9]\d{0,17})", v) for v in values):
        fits = all(-(2**31) <= int(v) < 2**31 for v in values)
        return T.IntegerType() if fits else T.LongType()
    if values and all(re.fullmatch(r"-?\d+\.\d+([eE]-?\d+)?|-?(0|[1-9]\d*)", v) for v in values):
        return T.DoubleType()
    return T.StringType()


def split_files(files: list[FileEntry], options) -> list[RangePartition]:
    """Cut large files and pack small ones, without opening any file.

    An explicit ``splitBytes`` is taken as it is. Otherwise ranges shrink until every core has
    one (``minSplits``) and grow until the job has at most ``maxSplits`` tasks.
    """
    total = sum(f.size + OPEN_COST for f in files)
    if options.get("splitBytes"):
        target = max(1, int(options["splitBytes"]))
    else:
        cores = int(options.get("minSplits") or os.cpu_count() or 1)
        target = min(DEFAULT_SPLIT_BYTES, max(OPEN_COST, -(-total // cores)))
        target = max(target, -(-total // int(options.get("maxSplits") or MAX_SPLITS)))
    partitions: list[RangePartition] = []
    pack: list[ByteRange] = []
    weight = 0
    for file in files:
        pieces = max(1, -(-file.size // target))
        step = -(-file.size // pieces) if not options.get("splitBytes") else target
        for start in range(0, max(file.size, 1), max(step, 1)):
            piece = ByteRange(file, start, min(file.size, start + step))
            cost = piece.end - piece.start + OPEN_COST
            if pack and weight + cost > target:
                partitions.append(RangePartition(pack))
                pack, weight = [], 0
            pack.append(piece)
            weight += cost
    if pack:
        partitions.append(RangePartition(pack))
    return partitions


def chunk_files(files: list[FileEntry], options, most_bytes: int | None = None) -> list[FilePartition]:
    """Share files among the cores, with at most ``filesPerPartition`` for one task, and with at most
    ``most_bytes``, where given, unless one file has more."""
    most = int(options.get("filesPerPartition") or FILES_PER_TASK)
    cores = int(options.get("minSplits") or os.cpu_count() or 1)
    size = max(1, min(most, max(8, -(-len(files) // cores))))
    chunks: list[list[FileEntry]] = []
    held = 0
    for file in files:
        full = not chunks or len(chunks[-1]) == size or (most_bytes is not None and held + file.size > most_bytes)
        if full:
            chunks.append([])
            held = 0
        chunks[-1].append(file)
        held += file.size
    return [FilePartition(chunk) for chunk in chunks]


def read_head(file: FileEntry, length: int) -> bytes:
    fs, _ = filesystem(file.root)
    with fs.open_input_file(file.path) as stream:
        return stream.read(min(length, file.size))
