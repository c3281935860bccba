"""tallybook: change logs, statement pages and price bars as keyed Spark tables."""
