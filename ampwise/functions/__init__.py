"""Column-level building blocks: row predicates (``predicates``), scalar
column functions (``scalar``) and whole-frame cleaning/renaming helpers
(``columns``). All are built-in Spark expressions."""
