"""Progress of batch and streaming runs."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def counted(df: DataFrame, name: str = "problems") -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its row count, known once an action has run."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def bar(done: int, total: int, label: str = "", width: int = 20) -> str:
    """``label [done / total] (p%) [bar]``, done held within 0 and total."""
    done = max(0, min(total, done))
    share = done / total if total else 0.0
    full = int(width * share + 0.5)
    return f"{label} [{done} / {total}] ({int(100 * share + 0.5)}%) [{chr(0x2588) * full}{chr(0x2591) * (width - full)}]"


class Bars:
    """Several labelled counts; done when all are."""

    def __init__(self) -> None:
        self.items: dict[str, list[int]] = {}

    def add(self, label: str, total: int) -> None:
        self.items[label] = [0, total]

    def count(self, label: str, n: int = 1) -> None:
        self.items[label][0] += n

    def done(self) -> bool:
        return all(done >= total for done, total in self.items.values())

    def render(self) -> str:
        return "\n".join(bar(done, total, label) for label, (done, total) in self.items.items())


class RowCounter(StreamingQueryListener):
    """Rows that streams have read so far."""

    def __init__(self) -> None:
        self.rows = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows += event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class Count:
    """A label with a count; done from ``least`` on."""

    def __init__(self, label: str = "Label: ", least: int = 20) -> None:
        self.label, self.least, self.value = label, least, 0

    def add(self, n: int = 1) -> None:
        self.value += n

    def done(self) -> bool:
        return self.value >= self.least

    def render(self) -> str:
        return f"{self.label} {self.value}"


class Ticker:
    """Calls ``show`` every ``every`` seconds while a block runs, and once when it ends."""

    def __init__(self, show: Callable[[], None], every: float = 0.3) -> None:
        self.show, self.every = show, every
        self._stop, self._thread = threading.Event(), None

    def _run(self) -> None:
        while not self._stop.wait(self.every):
            self.show()

    def __enter__(self) -> Ticker:
        self._thread = threading.Thread(target=self._run, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join()
        self.show()


def collected(run: Callable[[], int], ident: str) -> str:
    """Runs a job that returns its count; a line with count and elapsed milliseconds."""
    began = time.monotonic()
    n = run()
    return f"Collected {n} problems in {int(1000 * (time.monotonic() - began))}ms from {ident}"
