"""Publication of written files: a journal makes a commit, moves and deletions follow.

Tasks write below ``_temporary/<job>``. A commit writes one file there, the journal, which names the
places that the files go to and the files that they replace. From that moment readers see the
new files, at whichever of their two places, and no longer the replaced ones (``overlay``). Moves and deletions are done afterwards,
by threads or by a Spark job. Each may be done twice or be left half done: whoever comes next goes on, and
the journal goes last.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow.fs as pafs

JOURNAL = "journal.json"
THREADS = 16


@dataclass
class Journal:
    """Moves (from, to) and files that they replace, as paths below ``base``."""

    base: str
    name: str
    moves: list[tuple[str, str]] = field(default_factory=list)
    gone: list[str] = field(default_factory=list)

    @property
    def folder(self) -> str:
        return f"{self.base}/_temporary/{self.name}"

    def write(self, fs: pafs.FileSystem) -> None:
        """The commit: appears whole or not at all."""
        fs.create_dir(self.folder, recursive=True)
        draft = f"{self.folder}/draft"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps({"moves": self.moves, "gone": self.gone}).encode())
        fs.move(draft, f"{self.folder}/{JOURNAL}")

    def drop(self, fs: pafs.FileSystem, *jobs: str) -> None:
        """Removes what is left of the jobs that wrote the files, then the journal."""
        for name in (*jobs, self.name):
            folder = f"{self.base}/_temporary/{name}"
            if fs.get_file_info(folder).type == pafs.FileType.Directory:
                fs.delete_dir(folder)
        shared = f"{self.base}/_temporary"
        if not fs.get_file_info(pafs.FileSelector(shared, allow_not_found=True)):
            if fs.get_file_info(shared).type == pafs.FileType.Directory:
                fs.delete_dir(shared)


def pending(fs: pafs.FileSystem, base: str) -> list[Journal]:
    """Journals below a folder whose work is not done."""
    jobs = fs.get_file_info(pafs.FileSelector(f"{base}/_temporary", allow_not_found=True))
    found = []
    for job in sorted(i.base_name for i in jobs if i.type == pafs.FileType.Directory):
        if (journal := read_journal(fs, base, job)) is not None:
            found.append(journal)
    return found


def read_journal(fs: pafs.FileSystem, base: str, name: str) -> Journal | None:
    try:
        with fs.open_input_file(f"{base}/_temporary/{name}/{JOURNAL}") as stream:
            data = json.loads(stream.read())
    except FileNotFoundError:
        return None
    return Journal(base, name, [tuple(pair) for pair in data["moves"]], data["gone"])


def make_folders(fs: pafs.FileSystem, base: str, moves: Iterable[tuple[str, str]]) -> None:
    for folder in {os.path.dirname(to) for _, to in moves} - {""}:
        fs.create_dir(f"{base}/{folder}", recursive=True)


def move(fs: pafs.FileSystem, base: str, pair: Sequence[str]) -> None:
    """Moves a file to its place, unless it is there already."""
    source, target = (f"{base}/{p}" for p in pair)
    try:
        fs.move(source, target)
    except FileNotFoundError:
        if fs.get_file_info(target).type != pafs.FileType.File:
            raise


def remove(fs: pafs.FileSystem, base: str, name: str) -> None:
    """Deletes a file, unless it is gone already."""
    if fs.get_file_info(f"{base}/{name}").type == pafs.FileType.File:
        fs.delete_file(f"{base}/{name}")


def side_by_side(work: Callable, items: Sequence) -> None:
    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(work, items))


def overlay(
    fs: pafs.FileSystem, base: str, journals: Sequence[Journal], staged: Sequence[pafs.FileInfo], listed: Sequence[pafs.FileInfo]
) -> list[tuple[pafs.FileInfo, str]]:
    """(file, path that it counts as) of a folder with pending journals: new files once, replaced ones not.

    ``staged`` must have been listed before ``listed``, so that a file moved in between is in one of the two.
    """
    gone = {f"{base}/{name}" for j in journals for name in j.gone}
    waiting = {f"{base}/{source}": f"{base}/{target}" for j in journals for source, target in j.moves}
    found = {info.path: (info, info.path) for info in listed if info.path not in gone}
    for info in staged:
        if info.path in waiting and waiting[info.path] not in found:
            found[waiting[info.path]] = info, waiting[info.path]
    return list(found.values())
