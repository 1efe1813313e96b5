"""Agent-trace analytics on Spark: spans to runs, runs to verdicts, verdicts to gates."""
