"""Query catalogue: test tables mapped to job inputs, the jobs, and their SQL twins."""
