from clickvault.sinks.writers import (
    ledger_overwrite,
    run_concurrently,
    sink_gold,
    sink_perf_append,
    sink_quality,
    sink_silver,
    write_table,
)

__all__ = ["ledger_overwrite", "run_concurrently", "sink_gold", "sink_perf_append", "sink_quality", "sink_silver", "write_table"]
