"""The state of one group of candles: its newest bars, each as it arrived last."""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor

# Tasks get this module by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class NewestRows(StatefulProcessor):
    """Keeps ``n`` bars in a map state: bar time to (arrival, body). Bar times and arrivals are
    text that orders like what it says.

    A bar that is cut has ``n`` newer bars, so it is out for good, also when it is sent again:
    cutting early never changes the outcome.
    """

    NAME = "newest"

    def __init__(self, n):
        self.n = n

    def init(self, handle):
        self.state = handle.getMapState(self.NAME, "bar string", "arrival string, body string")

    def _cut(self, rows):
        return {bar: rows[bar] for bar in sorted(rows, reverse=True)[: self.n]}

    def handleInputRows(self, key, rows, timerValues):
        sent = {}
        for frame in rows:
            for bar, arrival, body in zip(frame["bar"], frame["arrival"], frame["body"]):
                if bar not in sent or arrival > sent[bar][0]:
                    sent[bar] = (arrival, body)
            if len(sent) > 4 * self.n:
                sent = self._cut(sent)
        stored = {bar[0]: tuple(row) for bar, row in self.state.iterator()} if self.state.exists() else {}
        changed = {bar: row for bar, row in sent.items() if bar not in stored or row[0] > stored[bar][0]}
        kept = self._cut({**stored, **changed})
        for bar in stored.keys() - kept.keys():
            self.state.removeKey((bar,))
        changed = {bar: row for bar, row in changed.items() if bar in kept}
        for bar, row in changed.items():
            self.state.updateValue((bar,), row)
        if changed:
            yield pd.DataFrame({"symbol": key[0], "bar": list(changed), "body": [row[1] for row in changed.values()]})

    def close(self):
        pass
