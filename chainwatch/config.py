"""Run parameters for training, scoring and streaming.

One frozen dataclass replaces the properties file the three entry points of
the original application read separately.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values that must equal the original application's for identical
# results: the 18 Markov states in dictionary order (the position in this list
# is the state index, which decides arg-max ties and the row order of the dense
# model file), the window size, the alert threshold and the default scorer.
DEFAULT_STATES: tuple[str, ...] = (
    "LNL", "LNN", "LNS", "LHL", "LHN", "LHS", "NNL", "NNN", "NNS",
    "NHL", "NHN", "NHS", "HNL", "HNN", "HNS", "HHL", "HHN", "HHS",
)
DEFAULT_WINDOW = 5
DEFAULT_THRESHOLD = 0.96
DEFAULT_ALGORITHM = "MissProbability"
DEFAULT_BATCH_INTERVAL = "10 seconds"
# topic names of the three message streams (input, history out, alerts out)
DEFAULT_INPUT_TOPIC = "real-time-cc"
DEFAULT_HISTORY_TOPIC = "user-trans-history"
DEFAULT_ALERTS_TOPIC = "candidate-fraud-trans"

# Sequences are cut into chunks of this many positions for every ordered
# operator (lead, running sum, line export), so no task ever holds more than
# one chunk plus a small halo of one customer, however long its history.  Every
# hand-off keeps the chunk's first position, so nothing is lost at a cut.
DEFAULT_CHUNK = 1 << 18

# Upper bound on the number of rows of any model-derived lookup table that is
# broadcast or inlined.  A dictionary whose dense table, (S + 1)**2 cells, lies
# within it is looked up by position in literal arrays; a larger one by joins with
# the seen cells, which are broadcast only if their counted number lies within it.
MAX_BROADCAST_CELLS = 1 << 20


@dataclass(frozen=True)
class MarkovConfig:
    states: tuple[str, ...] = DEFAULT_STATES
    window: int = DEFAULT_WINDOW
    threshold: float = DEFAULT_THRESHOLD
    algorithm: str = DEFAULT_ALGORITHM
    batch_interval: str = DEFAULT_BATCH_INTERVAL
    chunk: int = DEFAULT_CHUNK
    # "error": unknown tokens fail the job (the original behaviour);
    # "null": an unknown current state gives a NULL score;
    # "drop_sequence": training skips customers that have any unknown token.
    on_unknown: str = "error"
    # Entropy scorer: "undefined" reproduces 0*ln(0) = NaN (score NULL),
    # "limit" uses the limit 0*ln(0) = 0.
    zero_cell: str = "undefined"
    input_topic: str = DEFAULT_INPUT_TOPIC
    history_topic: str = DEFAULT_HISTORY_TOPIC
    alerts_topic: str = DEFAULT_ALERTS_TOPIC
    # paths of a properties file; the command line's options take precedence
    model_path: str | None = None
    transactions_path: str | None = None
    sequences_path: str | None = None
    brokers: str | None = None

    def __post_init__(self):
        if self.window < 2:
            raise ValueError("window must hold at least one transition")
        if len(set(self.states)) != len(self.states):
            raise ValueError("duplicate state in dictionary")
        if self.chunk < self.window:
            raise ValueError("chunk must be at least the window size")
        if self.on_unknown not in ("error", "null", "drop_sequence"):
            raise ValueError(f"on_unknown={self.on_unknown!r}")
        if self.zero_cell not in ("undefined", "limit"):
            raise ValueError(f"zero_cell={self.zero_cell!r}")

    @property
    def n_states(self) -> int:
        return len(self.states)

    @property
    def dense(self) -> bool:
        """Whether the dense lookup table is small enough to be inlined."""
        return (self.n_states + 1) ** 2 <= MAX_BROADCAST_CELLS

    def with_(self, **kw) -> "MarkovConfig":
        return replace(self, **kw)


def parse_states(line: str) -> tuple[str, ...]:
    """The dictionary file is one comma-separated line; position = index."""
    return tuple(s for s in line.strip().split(",") if s != "")


# properties keys of the original configuration file: those that change
# results, then its topics, paths and brokers
_PROPERTY_KEYS = {
    "scorer.algorithm": ("algorithm", str),
    "state.seq.windowSize": ("window", int),
    "metric.threshold": ("threshold", float),
    "batch.duration": ("batch_interval", lambda v: f"{int(v)} seconds"),
    "kafka.inputtopic": ("input_topic", str),
    "kafka.xacttopic": ("history_topic", str),
    "kafka.fraudtopic": ("alerts_topic", str),
    "model.path": ("model_path", str),
    "transaction.file": ("transactions_path", str),
    "sequence.file": ("sequences_path", str),
    "metadata.broker.list": ("brokers", str),
}


def config_from_properties(text: str, states_line: str | None = None) -> MarkovConfig:
    """Build a config from ``key=value`` properties text (unknown keys, such
    as connection settings, are ignored); a bad value raises ``ValueError``
    instead of ending the process."""
    kw = {}
    for raw in text.splitlines():
        line = raw.strip()
        if not line or line.startswith(("#", "!")) or "=" not in line:
            continue
        k, v = (s.strip() for s in line.split("=", 1))
        if k in _PROPERTY_KEYS:
            name, conv = _PROPERTY_KEYS[k]
            try:
                kw[name] = conv(v)
            except ValueError as e:
                raise ValueError(f"bad value for {k}: {v!r}") from e
    if states_line is not None:
        kw["states"] = parse_states(states_line)
    return MarkovConfig(**kw)
