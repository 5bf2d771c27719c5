"""Positions in a log, and stores of small state with a lifetime."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Position:
    """File, byte position and transactions seen; a transaction counts as seen once it has ended."""

    file: str = ""
    pos: int = 0
    ts: int = 0
    seen: dict[str, int] = field(default_factory=dict)
    open: str = ""

    def rotated(self, file: str, pos: int) -> Position:
        return replace(self, file=file, pos=pos)

    def at(self, pos: int, ts: int) -> Position:
        return replace(self, pos=pos, ts=ts)

    def begun(self, gtid: str) -> Position:
        return replace(self, open=gtid)

    def ended(self) -> Position:
        if not self.open:
            return self
        sid, _, tx = self.open.partition(":")
        return replace(self, seen={**self.seen, sid: max(int(tx), self.seen.get(sid, 0))}, open="")

    def replayed(self, gtid: str) -> bool:
        """Whether a transaction lies wholly before what was seen; that at the mark itself is read again."""
        sid, sep, tx = gtid.partition(":")
        if not sep or not tx.isdigit():
            raise ValueError(f"invalid transaction id: {gtid!r}")
        return int(tx) < self.seen.get(sid, 0)

    def to_json(self) -> str:
        return json.dumps({"file": self.file, "pos": self.pos, "ts": self.ts, "seen": self.seen}, sort_keys=True)

    @classmethod
    def of_json(cls, text: str) -> Position:
        return cls(**json.loads(text))


class StateFile:
    """A map in one JSON file, written whole and put in place by renaming."""

    def __init__(self, path: str):
        self.path = path
        self.data: dict = json.load(open(path)) if os.path.exists(path) else {}

    def get(self, key: str):
        return self.data.get(key)

    def set(self, key: str, value) -> None:
        self.data[key] = value
        with open(f"{self.path}.new", "w") as f:
            json.dump(self.data, f)
        os.replace(f"{self.path}.new", self.path)


class HistoryFile:
    """Entries as JSON lines, appended."""

    def __init__(self, path: str):
        self.path = path

    def push(self, entry: dict) -> None:
        with open(self.path, "a") as f:
            f.write(json.dumps(entry) + "\n")

    def entries(self) -> list[dict]:
        if not os.path.exists(self.path):
            return []
        with open(self.path) as f:
            return [json.loads(line) for line in f if line.strip()]


class TtlMap:
    """Keys with a lifetime; some entries stay out of the file."""

    def __init__(self, clock: Callable[[], float] = time.time, store: StateFile | None = None):
        self.clock, self.store = clock, store
        self.held: dict[str, tuple[object, float, bool]] = {k: (v["value"], v["until"], True) for k, v in (store.data if store else {}).items()}

    def set(self, key: str, value, seconds: float, keep: bool = True) -> None:
        self.held[key] = (value, self.clock() + seconds, keep)

    def get(self, key: str):
        found = self.held.get(key)
        return found[0] if found and found[1] > self.clock() else None

    def sweep(self) -> None:
        now = self.clock()
        self.held = {k: v for k, v in self.held.items() if v[1] > now}

    def flush(self) -> None:
        if self.store:
            self.sweep()
            self.store.data = {}
            for k, (value, until, keep) in self.held.items():
                if keep:
                    self.store.data[k] = {"value": value, "until": until}
            with open(f"{self.store.path}.new", "w") as f:
                json.dump(self.store.data, f)
            os.replace(f"{self.store.path}.new", self.store.path)
