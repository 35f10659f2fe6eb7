"""DataFrame operators: lazy, no collect, no session handling, column names bound by ``ReviewColumns``."""
