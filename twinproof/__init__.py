"""twinproof: copy tables with Spark, keep the copy in step, prove both sides equal."""

from twinproof.operators.scope import Scope
from twinproof.session import get_session, work_dir

__all__ = ["Scope", "get_session", "work_dir"]
