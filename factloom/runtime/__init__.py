"""Settings, run reports, preflight checks, jobs and the command line."""
