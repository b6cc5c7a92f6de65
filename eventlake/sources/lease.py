"""A fenced lease on a table: one writer at a time, each with a higher epoch than all before it.

``<table>/_lease/<epoch>.json`` is created by the writer that takes the lease, and by nobody else:
the file system lets one of several create a name. The holder alone rewrites its own file, to renew
and to release it. Whoever finds the newest epoch released, not renewed in time, or of a dead
process of the same machine takes the next number. So a writer that was stalled sees a higher
epoch, and ``check`` stops it before it puts anything in place.
"""

from __future__ import annotations

import json
import os
import socket
import threading
import time
import uuid
from collections.abc import Callable

from eventlake.sources.folder import Folder

LEASE_DIR = "_lease"
LEASE_SECONDS, WAIT_SECONDS, POLL_SECONDS = 60.0, 900.0, 0.5


class LeaseHeld(RuntimeError):
    """Another writer holds the table and did not give it up in time."""


class LeaseLost(RuntimeError):
    """This writer no longer holds the table; it has put nothing in place since it lost it."""


class Lease:
    """Held in a ``with`` block; entered again by the same handle, it only counts.

    While held it is renewed four times in ``seconds``. A renewal that fails is tried again until
    the lease has run out; then the holder has lost it, whether or not another writer came.
    """

    def __init__(
        self,
        folder: Folder,
        seconds: float = LEASE_SECONDS,
        wait: float = WAIT_SECONDS,
        on_taken: Callable[[], None] | None = None,
    ):
        self.folder, self.seconds, self.wait = folder, seconds, wait
        self.on_taken = on_taken
        self.epoch = 0  # of the lease held now, or held last
        self._depth = 0
        self._lost = ""
        self._renewed = 0.0
        self._writing = threading.Lock()
        self._stop = threading.Event()
        self._thread: threading.Thread | None = None
        self._token = ""

    def __enter__(self) -> Lease:
        if self._depth == 0:
            self._acquire()
            self._depth = 1
            try:
                if self.on_taken:
                    self.on_taken()
            except BaseException:
                self.__exit__()
                raise
        else:
            self._depth += 1
        return self

    def __exit__(self, *exc_info) -> None:
        self._depth -= 1
        if self._depth:
            return
        self._stop.set()
        if self._thread is not None:
            self._thread.join()
        with self._writing:
            if not self._lost and self._is_newest():
                self.folder.replace_text(self._name(self.epoch), self._text(released=True))

    @property
    def held(self) -> bool:
        return self._depth > 0

    def check(self) -> None:
        """Raise :class:`LeaseLost` unless this writer holds the newest epoch; renews it first.

        To be called right before anything is put in place. Whoever takes the lease after this
        has waited for it to run out since the renewal.
        """
        if not self.held:
            raise LeaseLost(f"{self.folder.path} is written without its lease")
        if not self._lost:
            try:
                self._renew_once()
            except Exception as failure:  # noqa: BLE001  whatever the store raised
                self._lose(f"it could not be renewed: {failure}")
        if self._lost:
            raise LeaseLost(f"epoch {self.epoch} of {self.folder.path} is over: {self._lost}")

    def _acquire(self) -> None:
        self._token, self._lost = uuid.uuid4().hex, ""
        self.folder.make(LEASE_DIR)
        deadline = time.monotonic() + self.wait
        while not self._take_next():
            if time.monotonic() > deadline:
                owner = self._read(max(self._epochs(), default=0)).get("owner", "another job")
                raise LeaseHeld(
                    f"{self.folder.path} is being written by {owner}; waited {self.wait:.0f} s"
                )
            time.sleep(min(POLL_SECONDS, self.wait))
        self._renewed = time.monotonic()
        self._stop.clear()
        self._thread = threading.Thread(target=self._renew, daemon=True)
        self._thread.start()

    def _take_next(self) -> bool:
        """Create the next epoch if the newest one is over; True if this writer has it now."""
        newest = max(self._epochs(), default=0)
        if newest and not self._is_over(newest):
            return False
        if not self.folder.create_text(self._name(newest + 1), self._text()):
            return False  # someone else was faster
        self.epoch = newest + 1
        epochs = self._epochs()
        if max(epochs) != self.epoch:  # the listing was old: others have come and gone since
            self.folder.remove(self._name(self.epoch))
            return False
        if newest in epochs and not self._is_over(newest):
            self.folder.remove(self._name(self.epoch))  # renewed at the last moment: not over
            return False
        for old in epochs:
            if old < self.epoch:
                self.folder.remove(self._name(old))
        return True

    def ever_held(self) -> bool:
        return bool(self._epochs())

    def is_over(self) -> bool:
        """True if nobody holds the lease: never taken, released, or run out."""
        newest = max(self._epochs(), default=0)
        return not newest or self._is_over(newest)

    def _is_over(self, epoch: int) -> bool:
        seen = self._read(epoch)
        if seen.get("released") or _owner_is_dead(seen):
            return True
        modified = self.folder.modified(self._name(epoch))
        return modified is not None and time.time() - modified > self.seconds

    def _renew(self) -> None:
        pause = self.seconds / 4
        while not self._stop.wait(pause):
            try:
                self._renew_once()
            except Exception as failure:  # noqa: BLE001  tried again while there is time
                if time.monotonic() - self._renewed > self.seconds:
                    self._lose(f"it could not be renewed: {failure}")
            if self._lost:
                return
            late = time.monotonic() - self._renewed > self.seconds / 4
            pause = self.seconds / (20 if late else 4)

    def _renew_once(self) -> None:
        with self._writing:
            if not self._is_newest():
                self._lose("another writer has taken over")
                return
            began = time.monotonic()
            self.folder.replace_text(self._name(self.epoch), self._text())
            # Taken over between the two: the other writer removes this file when it next can.
            if not self._is_newest():
                self._lose("another writer has taken over")
                return
            self._renewed = began

    def _lose(self, reason: str) -> None:
        self._lost = self._lost or reason

    def _is_newest(self) -> bool:
        return max(self._epochs(), default=0) == self.epoch and (
            self._read(self.epoch).get("token") == self._token
        )

    def _epochs(self) -> list[int]:
        names = [n.removesuffix(".json") for n in self.folder.names(LEASE_DIR)]
        return [int(n) for n in names if n.isdigit()]

    def _name(self, epoch: int) -> str:
        return f"{LEASE_DIR}/{epoch:012d}.json"

    def _read(self, epoch: int) -> dict:
        """The lease on file; empty while it is being written or if there is none."""
        try:
            return json.loads(self.folder.read_text(self._name(epoch)))
        except Exception:  # noqa: BLE001  absent, or half written: either way not ours
            return {}

    def _text(self, released: bool = False) -> str:
        host, pid = socket.gethostname(), os.getpid()
        return json.dumps(
            {
                "owner": f"{host}:{pid}",
                "host": host,
                "pid": pid,
                "token": self._token,
                "released": released,
            }
        )


def _owner_is_dead(seen: dict) -> bool:
    """True if the owner was a process of this machine that has ended: a restart need not wait."""
    if seen.get("host") != socket.gethostname():
        return False
    try:
        os.kill(seen["pid"], 0)
    except ProcessLookupError:
        return True
    except PermissionError:
        return False
    return False
