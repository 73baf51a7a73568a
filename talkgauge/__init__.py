"""Push-to-talk service analytics as Spark DataFrame transforms."""
