"""Where pages, targets, formats, jobs and settings come from, and where tables go."""
