"""DataFrame -> DataFrame operators: skew-safe ordered scans (``scan``),
island aggregation by segment combination (``segments``), distances, trips,
stats, periods, SOC trips (``battery``), locations and clusters (``geo``),
rankings, rollups and profiles."""
