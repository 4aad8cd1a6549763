"""arrears: a Spark-native collections data warehouse.

Parametric DataFrame operators for incremental table loads (run-log
watermarks, high-water extraction, change detection, insert-if-absent,
upsert, missing-row flags), the daily snapshot of open contracts with its
bands, the fact marts hanging off it, and run / volume / error / purge logs
kept as tables.  Every job takes an explicit ``as_of`` instead of reading
the clock.
"""

__version__ = "0.1.0"
