"""agentlake: coding-agent session analytics as plain PySpark DataFrame jobs."""
