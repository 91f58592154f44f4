"""Sources: delimited text with a header, and headerless label-first matrices."""

from clinlake.sources.delimited import read_delimited, write_delimited
from clinlake.sources.inference import read_profiled
from clinlake.sources.label_matrix import read_label_matrix, write_label_matrix
from clinlake.sources.quarantine import read_checked

__all__ = ["read_checked", "read_delimited", "read_label_matrix", "read_profiled", "write_delimited", "write_label_matrix"]
