from lodestar.sources.documents import documents, read_documents, rejects, stamp
from lodestar.sources.runlog import log_run, read_run_log, recent_runs

__all__ = ["documents", "read_documents", "rejects", "stamp", "log_run", "read_run_log", "recent_runs"]
