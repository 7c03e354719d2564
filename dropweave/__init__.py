"""Record-drop processing on Spark: scan, count, split, merge, sort and group mixed-type files."""

from dropweave.functions.registry import RecordType, Registry
from dropweave.session import build_session, size_shuffles, stage

__all__ = ["RecordType", "Registry", "build_session", "size_shuffles", "stage"]
