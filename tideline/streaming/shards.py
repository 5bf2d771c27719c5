"""Shards of a log: lineage, state, and which may be read next."""

from __future__ import annotations

from dataclasses import dataclass

from tideline.streaming.offsets import TtlMap

LIFETIME = 72 * 3600.0


@dataclass(frozen=True)
class Shard:
    id: str
    parent: str | None = None


class ShardStates:
    """seen, processed and last sequence by shard, each for 72 hours; processing only in memory."""

    def __init__(self, states: TtlMap):
        self.states = states

    def see(self, shard: str) -> None:
        if not self.states.get(f"seen:{shard}"):
            self.states.set(f"seen:{shard}", True, LIFETIME)

    def seen(self, shard: str) -> bool:
        return bool(self.states.get(f"seen:{shard}"))

    def start(self, shard: str) -> bool:
        """Whether the caller may read the shard: nobody else does, and it isn't done."""
        if self.states.get(f"processing:{shard}") or self.processed(shard):
            return False
        self.states.set(f"processing:{shard}", True, LIFETIME, keep=False)
        return True

    def finish(self, shard: str) -> None:
        self.states.set(f"processed:{shard}", True, LIFETIME)

    def processed(self, shard: str) -> bool:
        return bool(self.states.get(f"processed:{shard}"))

    def move(self, shard: str, sequence: str) -> None:
        self.states.set(f"sequence:{shard}", sequence, LIFETIME)

    def start_at(self, shard: str) -> tuple[str, str | None]:
        """Where reading begins: after the last sequence, or at the oldest record."""
        last = self.states.get(f"sequence:{shard}")
        return ("AFTER_SEQUENCE_NUMBER", last) if last else ("TRIM_HORIZON", None)

    def waits(self, shard: Shard) -> bool:
        return bool(shard.parent) and self.seen(shard.parent) and not self.processed(shard.parent)


def ordered(pages: list[list[Shard]]) -> list[Shard]:
    """Shards of all pages, each once, parents first."""
    every = [s for page in pages for s in page]
    known, out, done = {s.id: s for s in every}, [], set()
    for s in every:
        line = []
        while s is not None and s.id not in done:
            done.add(s.id)
            line.append(s)
            s = known.get(s.parent)
        out += reversed(line)
    return out


def discover(pages: list[list[Shard]], states: ShardStates) -> list[Shard]:
    """Shards of all pages in an order that has parents first; all are marked as seen before any is handed out."""
    found = ordered(pages)
    for s in found:
        states.see(s.id)
    return [s for s in found if not states.processed(s.id)]
