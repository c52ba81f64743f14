"""Declared columns, charts and run parameters, checked before any job starts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, fields

# Declared types and the Spark types behind them.
DATA_TYPES = {"string": "string", "integer": "bigint", "float": "double"}

# Chart types and the column each plots.
CHART_VALUE = {
    "real_time_line_graph_values": "metric_value",
    "real_time_line_graph_average": "computed_metric",
    "real_time_bar_chart_values": "metric_value",
    "real_time_bar_chart_average": "computed_metric",
    "real_time_scatter_values": "metric_value",
    "real_time_scatter_average": "computed_metric",
}

SEQUENCE, AVERAGE = "priority_index", "computed_metric"
STAGES = ("raw", "intermediate", "processed")


def _text(name: str, value) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"{name} must be a non-empty string, got {value!r}")
    return value


def whole_number(name: str, value, least: int = 1) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < least:
        raise ValueError(f"{name} must be an integer of at least {least}, got {value!r}")
    return value


@dataclass(frozen=True)
class Column:
    """One declared input column: its header name, the name used inside, and its type."""

    source_name: str
    internal_mapping: str
    data_type: str

    def __post_init__(self):
        _text("source_name", self.source_name)
        _text("internal_mapping", self.internal_mapping)
        if self.data_type not in DATA_TYPES:
            raise ValueError(
                f"data_type must be one of {sorted(DATA_TYPES)}, got {self.data_type!r}"
            )


@dataclass(frozen=True)
class Chart:
    """One chart. ``y_axis`` is a label only: the type decides which column is plotted."""

    type: str
    title: str
    x_axis: str
    y_axis: str

    def __post_init__(self):
        for name in ("title", "x_axis", "y_axis"):
            _text(name, getattr(self, name))
        if self.type not in CHART_VALUE:
            raise ValueError(f"chart type must be one of {sorted(CHART_VALUE)}, got {self.type!r}")


def check_declared(columns: Sequence[Column]) -> Sequence[Column]:
    """Refuse declarations that name a column twice or hide a derived one."""
    if not columns:
        raise ValueError("at least one column must be declared")
    for kind in ("source_name", "internal_mapping"):
        names = [getattr(c, kind).lower() for c in columns]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"{kind} declared more than once (case ignored): {twice}")
    taken = {SEQUENCE, AVERAGE} & {c.internal_mapping.lower() for c in columns}
    if taken:
        raise ValueError(f"reserved for derived columns: {sorted(taken)}")
    return columns


@dataclass(frozen=True)
class RunSpec:
    """Everything one run needs. Field rules are the argument checks of the whole package."""

    dataset_path: str
    columns: Sequence[Column]
    secret_key: str = field(repr=False)
    iterations: int
    window: int
    charts: Sequence[Chart] = ()
    queue_max_size: int = 50
    show: Mapping[str, bool] = field(default_factory=lambda: dict.fromkeys(STAGES, True))
    value_col: str = "metric_value"
    signature_col: str = "security_hash"
    multiline: bool = False

    def __post_init__(self):
        _text("dataset_path", self.dataset_path)
        _text("secret_key", self.secret_key)
        whole_number("iterations", self.iterations)
        whole_number("window", self.window)
        whole_number("queue_max_size", self.queue_max_size)
        check_declared(self.columns)
        kinds = {c.internal_mapping: c.data_type for c in self.columns}
        if kinds.get(self.value_col) not in ("integer", "float"):
            raise ValueError(f"{self.value_col!r} must be declared as integer or float")
        if kinds.get(self.signature_col) != "string":
            raise ValueError(f"{self.signature_col!r} must be declared as string")
        for stage, shown in self.show.items():
            if stage not in STAGES or not isinstance(shown, bool):
                raise ValueError(f"show must map {STAGES} to booleans, got {stage!r}: {shown!r}")

    @classmethod
    def from_mapping(cls, config: Mapping) -> RunSpec:
        """Build the spec from a loaded JSON configuration; every broken section is reported."""
        problems: list[str] = []

        def part(label, build):
            try:
                return build()
            except KeyError as missing:
                problems.append(f"[{label}] lacks the key {missing}")
            except (TypeError, ValueError, AttributeError) as wrong:
                problems.append(f"[{label}] {wrong}")

        # fixed values: the keys of the configuration
        columns = part(
            "schema_mapping",
            lambda: check_declared([_build(Column, c) for c in config["schema_mapping"]["columns"]]),
        )
        charts = part(
            "visualizations.data_charts",
            lambda: [_build(Chart, c) for c in config["visualizations"]["data_charts"]],
        )
        if charts == []:
            problems.append("[visualizations.data_charts] must be a non-empty list")
        show = part(
            "visualizations.telemetry",
            lambda: {s: config["visualizations"]["telemetry"][f"show_{s}_stream"] for s in STAGES},
        )
        task = part("processing.stateless_tasks", lambda: config["processing"]["stateless_tasks"])
        part("processing.stateless_tasks", lambda: [_text(k, task[k]) for k in ("operation", "algorithm")])
        rolling = part("processing.stateful_tasks", lambda: config["processing"]["stateful_tasks"])
        part("processing.stateful_tasks", lambda: _text("operation", rolling["operation"]))
        flow = part("pipeline_dynamics", lambda: config["pipeline_dynamics"])
        part("pipeline_dynamics", lambda: whole_number("core_parallelism", flow["core_parallelism"]))
        part("pipeline_dynamics", lambda: _delay(flow["input_delay_seconds"]))
        spec = part(
            "config",
            lambda: cls(
                dataset_path=config["dataset_path"],
                columns=columns,
                secret_key=task["secret_key"],
                iterations=task["iterations"],
                window=rolling["running_average_window_size"],
                charts=charts,
                queue_max_size=flow["stream_queue_max_size"],
                show=show,
                multiline=_flag("multiline", config.get("multiline", False)),
            ),
        )
        if problems:
            raise ValueError("\n".join(problems))
        return spec


def _build(kind, entry: Mapping):
    """Entries may hold more keys than are needed."""
    return kind(**{f.name: entry[f.name] for f in fields(kind)})


def _flag(name: str, value) -> bool:
    """``multiline`` is our own, optional key: whether cells may hold line breaks."""
    if not isinstance(value, bool):
        raise ValueError(f"{name} must be true or false, got {value!r}")
    return value


def _delay(value) -> float:
    """Pacing has no meaning for a Spark job; the rule is kept so that bad configs are refused."""
    if isinstance(value, bool) or not isinstance(value, (int, float)) or value < 0:
        raise ValueError(f"input_delay_seconds must be a number of at least 0, got {value!r}")
    return value
