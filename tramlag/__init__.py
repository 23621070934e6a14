"""Public-transport delay warehouse on Spark: schedules, facts, aggregates, reports."""
