"""Published states of a warehouse: numbered records, each created once.

A record names the table versions that belong together.  A writer may only
publish the number after the state it started from; whoever comes second finds
the number taken and is refused.  States stay readable for a stated time after
they were followed by a newer one.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from chronomart.sources.shared_files import SharedFiles
from chronomart.sources.storage import Version

FIRST = 0  # the number of an empty warehouse, which has no record


class PublishConflict(RuntimeError):
    """Another writer has published since this one read its state."""


@dataclass(frozen=True)
class State:
    """What one record holds.

    ``folded`` names the folder of folded batch-log rows, ``covered`` the small
    log files that it holds.
    """

    number: int
    buckets: int
    versions: dict[str, Version]
    folded: str | None = None
    covered: list[str] = field(default_factory=list)
    published_at: str = ""

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> State:
        values = json.loads(text)
        values["versions"] = {name: Version(**v) for name, v in values["versions"].items()}
        return cls(**values)

    @property
    def time(self) -> datetime:
        return datetime.fromisoformat(self.published_at)


class Records:
    """The numbered records under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.files = SharedFiles(spark)
        self.folder = f"{root}/log/published"

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def numbers(self) -> list[int]:
        names = [e.name for e in self.files.entries(self.folder) if not e.is_folder]
        return [int(n.removesuffix(".json")) for n in names if not n.startswith((".", "_")) and n.endswith(".json")]

    def last_number(self) -> int:
        return max(self.numbers(), default=FIRST)

    def read(self, number: int) -> State:
        return State.from_json(self.files.read(self._path(number)))

    def last(self) -> State | None:
        number = self.last_number()
        return None if number == FIRST else self.read(number)

    def publish(self, state: State) -> State:
        """Create the record of ``state`` under its number, or refuse."""
        stamped = State(**{**state.__dict__, "published_at": datetime.now(timezone.utc).isoformat()})
        if self.last_number() >= state.number or not self.files.create(self._path(state.number), stamped.to_json()):
            raise PublishConflict(f"state {state.number} was published by another writer")
        return stamped

    def readable(self, retention: timedelta) -> tuple[list[State], list[int]]:
        """The last state and those that were the last one within ``retention``; and the numbers of older records."""
        states = [self.read(n) for n in sorted(self.numbers())]
        since = datetime.now(timezone.utc) - retention
        followed = [*(s.time for s in states[1:]), None]
        kept = [s for s, after in zip(states, followed, strict=True) if after is None or after > since]
        return kept, [s.number for s in states if s not in kept]

    def forget(self, numbers: list[int]) -> None:
        for number in numbers:
            self.files.delete(self._path(number))
