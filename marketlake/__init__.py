"""Market-data tape, signals, ledger and quality operators on Spark."""
