"""Plan-level building blocks: the global row order (``order``) and the
registered query set used by ``__spark_entry__`` and ``bench.py``."""
