"""Names, headers and labels that other tools read back."""

# Counting strategies, their numeric aliases and display names.
STRATEGY_NAMES = {
    "groupbykey": "GroupByKey",
    "aggregatebykey": "AggregateByKey",
    "reducebykey": "ReduceByKey",
}
STRATEGY_NUMBERS = {
    "1": "groupbykey",
    "2": "aggregatebykey",
    "3": "reducebykey",
}
DEFAULT_STRATEGY = "groupbykey"
UNKNOWN_STRATEGY_NAME = "Unknown"

# Columns of an event table.
EVENT_COLUMNS = ("latitude", "longitude", "date")
DAY_KEY_LENGTH = 10

# Columns of the metrics table, in file order.
METRIC_COLUMNS = (
    "approach",
    "num_workers",
    "num_partitions",
    "total_events",
    "unique_events",
    "co_occurrences",
    "load_time_ms",
    "analysis_time_ms",
    "total_time_ms",
    "max_count",
    "timestamp",
)

# Folders of the metrics files below the result folder.
METRICS_FOLDER = "metrics"
REPORT_FOLDER = "metrics-readable"

# Partition counts swept for each number of workers.
SWEEP_PARTITIONS = {
    2: (8, 16, 32, 48),
    3: (16, 32, 48),
    4: (16, 32, 48),
}
