"""Sources and sinks: table registry, driver-table adapters, copy jobs, CSV."""
