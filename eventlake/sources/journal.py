"""The partition directories that landings have written to since upkeep last looked."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from eventlake.sources.folder import Folder

JOURNAL_DIR = "_touched"
OPEN, TAKEN = "open-", "taken-"


class TouchedDirectories:
    """A set of directory names in ``<table>/_touched/``, for the holder of the table's lease.

    A landing adds the directories it is about to write to; one that only writes where others did
    before changes nothing, so the set is as small as the dates at work. Upkeep takes the set, which
    starts a new one, and settles it when these directories are done. A set whose upkeep was cut
    short is taken again by the next one. A crash while adding leaves two versions; both count.
    """

    def __init__(self, folder: Folder):
        self.folder = folder

    def add(self, directories: Iterable[str]) -> None:
        versions = self._names(OPEN)
        known = self._read(versions)
        wanted = known | set(directories)
        if wanted == known:
            return
        self.folder.make(JOURNAL_DIR)
        last = int(versions[-1].removeprefix(OPEN).removesuffix(".json")) if versions else 0
        name = f"{JOURNAL_DIR}/{OPEN}{last + 1:09d}.json"
        self.folder.write_new_text(name, json.dumps(sorted(wanted)))
        for old in versions:
            self.folder.remove(f"{JOURNAL_DIR}/{old}")

    def take(self) -> tuple[set[str], list[str]]:
        """The directories touched, and what to :meth:`settle` when they are done."""
        for name in self._names(OPEN):
            taken = f"{TAKEN}{uuid.uuid4().hex}.json"
            self.folder.move(f"{JOURNAL_DIR}/{name}", f"{JOURNAL_DIR}/{taken}")
        names = self._names(TAKEN)
        return self._read(names), names

    def settle(self, names: Iterable[str]) -> None:
        for name in names:
            self.folder.remove(f"{JOURNAL_DIR}/{name}")

    def _names(self, prefix: str) -> list[str]:
        names = self.folder.names(JOURNAL_DIR)
        return [n for n in names if n.startswith(prefix) and n.endswith(".json")]

    def _read(self, names: Iterable[str]) -> set[str]:
        texts = [self.folder.read_text(f"{JOURNAL_DIR}/{name}") for name in names]
        return {directory for text in texts for directory in json.loads(text)}
