"""Query plans and outputs: the registered queries with their DuckDB
oracles (``queries``, ``sqlfrag``), publishing and the batch ledger
(``publish``), bulk-index export (``export``) and the daily jobs (``jobs``)."""
