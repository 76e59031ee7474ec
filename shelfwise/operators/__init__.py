"""Row-level and set-level operators, each DataFrame -> DataFrame and lazy."""
